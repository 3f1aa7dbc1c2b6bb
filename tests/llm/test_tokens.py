"""Encoding, token files, packing and token counts against the tokenizer itself."""

import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

import public_tokenizers
from llm.edge import bag, edge_docs, empty_docs, texts
from tablelift.llm import attribution, encoding, packing, tokenfile

TOKENIZER = Tokenizer.from_file(encoding.default_tokenizer())


def ids_of(text, end):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, end]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


PIECES = st.sampled_from(
    ["a", "B", "é", "é", "́", " ", "\n", " ", " ", "\x1c", "\x85", "'s", "'", "<|endoftext|>", "<|END|>", "<|", "1",
     "½", "★", "漢", "×", "÷,", "é.", "…,", "İ", "ß", "Σ", "ς", "\x00", "-", "ﬁ", "K", "ñ", ",", ".", "the", "word,"]
)


@settings(max_examples=400, deadline=None)
@given(st.lists(PIECES, max_size=20).map("".join))
def test_word_encoder_equals_whole_text(text):
    (ids,) = encoding.encoder(encoding.default_tokenizer()).encode([text.encode()])
    assert np.frombuffer(ids, "<u4").tolist() == ids_of(text, 1)[:-1]


def test_word_encoder_forgets(monkeypatch):
    monkeypatch.setattr(encoding, "MAX_WORDS", 3)
    one = encoding.WordEncoder(encoding.default_tokenizer())
    for text in ["a b c d e", "b c f g", "a b c d e"]:
        assert np.frombuffer(one.encode([text.encode()])[0], "<u4").tolist() == ids_of(text, 1)[:-1]


def test_token_file(spark, tmp_path):
    docs = edge_docs(spark)
    tokenfile.write_tokens(docs, str(tmp_path / "t"), files=4)
    tokens = tokenfile.read_tokens(spark, str(tmp_path / "t"))
    got = tokens.orderBy("start").collect()
    want = [(i, ids_of(t, 1)) for i, t in texts()]
    assert bag((r.doc_id, r.ids) for r in got) == bag(want)
    at = 0
    for r in got:
        assert r.start == at and r.n_tokens == len(r.ids)
        at += r.n_tokens
    known = [r.doc_id for r in got]
    assert known == sorted(known, key=lambda x: (x is not None, x or 0))
    digests = tokenfile.with_crc(tokens).collect()
    assert bag((r.doc_id, r.ids_crc32) for r in digests) == bag((i, crc(ids)) for i, ids in want)
    assert tokens.where("doc_id = 7").count() == 1
    plan = tokens.where("doc_id = 7")._jdf.queryExecution().toString()
    assert "EqualTo(doc_id,7)" in plan


def test_token_file_of_nothing(spark, tmp_path):
    tokenfile.write_tokens(empty_docs(spark), str(tmp_path / "t"), files=2)
    assert tokenfile.with_crc(tokenfile.read_tokens(spark, str(tmp_path / "t"))).count() == 0


def test_assign_fills_everything():
    r = random.Random(4)
    for _ in range(200):
        lengths = [r.randint(1, 16) for _ in range(r.randint(0, 30))]
        room = [16] * (sum(lengths) // 16)
        placed, rest = packing.assign(lengths, room)
        used = [0] * len(room)
        covered = []
        for piece, start, n, k in placed:
            used[k] += n
            covered += [(piece, x) for x in range(start, start + n)]
        for piece, start in rest:
            covered += [(piece, x) for x in range(start, lengths[piece])]
        assert used == room
        assert sorted(covered) == [(i, x) for i, n in enumerate(lengths) for x in range(n)]


def test_longest_first_to_the_cheapest():
    placed, rest = packing.assign([5, 9, 8, 5], [16, 16])
    assert not rest and [(p, k) for p, _, _, k in placed] == [(1, 0), (2, 1), (0, 1), (3, 0)]


@pytest.mark.parametrize("block", [4096, 1 << 20])
def test_packing(spark, block):
    docs = edge_docs(spark).repartition(3)
    pieces = packing.pack(docs, block=block).collect()
    own = [ids_of(t, 2) for _, t in texts()]
    assert sum(p.length for p in pieces) == sum(map(len, own))
    sequences = {}
    for p in pieces:
        sequences.setdefault(p.sequence_id, []).append(p)
    for parts in sequences.values():
        at = 0
        for p in sorted(parts, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == 4096 or at & (at - 1) == 0 and at < 4096
    by_id = {}
    for doc_id, text in texts():
        by_id.setdefault(doc_id, []).append(ids_of(text, 2))
    for doc_id, several in by_id.items():
        mine = [p for p in pieces if p.doc_id == doc_id]
        assert sum(p.length for p in mine) == sum(map(len, several))
        for p in mine:
            assert any(len(ids) == p.doc_tokens and crc(ids[p.start : p.start + p.length]) == p.ids_crc32 for ids in several)
    assert packing.pack(empty_docs(spark)).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 6), min_size=1, max_size=12), st.data())
def test_interval_join(tokens, data):
    total = sum(tokens)
    cuts = sorted(data.draw(st.sets(st.integers(1, total), max_size=6)) | {total})
    ends = np.cumsum(tokens)
    owner = [next(i for i, b in enumerate(cuts) if x < b) for x in range(total)]
    for rule in attribution.RULES:
        got, crossing = attribution.attribute(ends, np.array(cuts), rule)
        for k, (a, b) in enumerate(zip([0, *ends[:-1].tolist()], ends.tolist())):
            mine = owner[a:b]
            want = {"first": mine[0], "last": mine[-1], "largest": max(sorted(set(mine)), key=mine.count)}[rule]
            assert got[k] == want and crossing[k] == (len(set(mine)) > 1)


def test_token_counts(spark):
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    plain.encode_special_tokens = True
    rows = attribution.count_tokens(edge_docs(spark).where("doc_id not in (3, 9, 16)")).collect()
    docs = [r for r in edge_docs(spark).collect() if r.doc_id not in (3, 9, 16, None)]
    for doc in docs:
        mine = sorted((r for r in rows if r.doc_id == doc.doc_id), key=lambda r: r.section_no)
        rendered = f"source: {doc.source or ''}\nlang: {doc.lang or ''}\n\n{doc.text or ''}"
        found = plain.encode(rendered, add_special_tokens=False)
        assert {r.doc_tokens for r in mine} == {len(found.ids)} and sum(r.n_tokens for r in mine) == len(found.ids)
        assert mine[0].start == 0 and mine[-1].end == len(rendered) and all(a.end == b.start for a, b in zip(mine, mine[1:]))
        if rendered.isascii():
            for r in mine:
                assert r.n_tokens == sum(r.start <= a < r.end for a, _ in found.offsets)
                assert r.n_crossing == sum(r.start <= a < r.end < b for a, b in found.offsets)
    assert attribution.count_tokens(empty_docs(spark)).count() == 0


def test_long_white_space_is_encoded():
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    one = attribution.encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    for text in ["x" + " " * 7001 + "y", "\n" * 6000, " " * 5000 + "'s"]:
        assert one.ids(text) == plain.encode(text, add_special_tokens=False).ids
