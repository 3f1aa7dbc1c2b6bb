"""Filter audit, prefix trie and language identification against plain versions."""

import hashlib
import os
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest

from llm.edge import bag, edge_docs, empty_docs, prose, texts
from tablelift.llm import common, filter_audit, language, prefix_trie


# filter audit

def slow_audit(docs, labels):
    """docs: (doc_id, text, source); labels: (doc_id, quality, toxic)."""
    rows = []
    for doc_id, text, source in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text), "D": any(c in "#$%&*|" for c in text),
            "E": any((o[1] or "") == text and None not in (o[0], doc_id) and o[0] < doc_id for o in docs),
        }
        of = [label for label in labels if label[0] == doc_id and doc_id is not None]
        rows.append((source or "", fails, any(label[1] == 1 for label in of), any(label[2] == 1 for label in of)))
    out = []
    for part in {r[0] for r in rows}:
        mine = [r[1:] for r in rows if r[0] == part]
        removed_by = Counter()
        steps = []
        for order in map("".join, permutations("ABCDE")):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [r for r in left if r[0][f]]
                left = [r for r in left if not r[0][f]]
                removed_by[f] += len(gone)
                alone = sum(r[0][f] and sum(r[0].values()) == 1 for r in mine)
                redundant = sum(r[0][f] for r in mine) - len(gone)
                steps.append((part, order, step, f, len(left), len(gone), redundant, alone, sum(r[1] for r in gone), sum(r[2] for r in gone)))
        out += [(*s, removed_by[s[3]]) for s in steps]
    return out


def test_audit_of_all_orders(spark):
    r = random.Random(3)
    docs = [(i, t, r.choice(["s0", "s0", "s1", None])) for i, (_, t) in enumerate(texts())]
    docs += [(100 + i, prose(i % 9, r.choice([30, 90])) + r.choice(["", " $", " AAAAAAAAAAAAAAAA BBBBBBBBB"]), r.choice(["s0", "s2", ""])) for i in range(80)]
    docs += [(100, prose(0, 90), "s1"), (None, docs[-1][1], "s0"), (7, docs[-3][1], "s0"), (7, docs[-3][1], "s0")]
    labels = [(i, r.choice([0, 1, None]), r.choice([0, 1, None])) for i in range(0, 180, 2)] + [(100, 1, 1), (100, 0, 0), (None, 1, 1)]
    got = filter_audit.filter_interactions(
        spark.createDataFrame([(*d, True, 1) for d in docs], "doc_id long, text string, source string, mask boolean, part int"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )
    assert bag(got.collect()) == bag(slow_audit(docs, labels))


def test_audit_edges(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = edge_docs(spark)
    plain = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    assert bag(filter_audit.filter_interactions(docs, labels).collect()) == bag(slow_audit(plain, []))
    assert filter_audit.filter_interactions(empty_docs(spark), labels).collect() == []


def test_packed_counters_do_not_overflow():
    most = (1 << 63) - 1
    wide = filter_audit.packed()
    sums = filter_audit.unpacked(most * wide[0b10110])
    one = filter_audit.unpacked(wide[0b10110])
    assert (sums == most * one).all() and one.shape == (3, 120, 5) and set(one.ravel().tolist()) == {0, 1}
    both = filter_audit.unpacked((1 << 62) * wide[31] + (1 << 61) * wide[1])
    assert both[1, :, 0].max() == (1 << 62) + (1 << 61)


# prefix trie

def slow_trie(rebuilt):
    """rebuilt: {conv: [(role, text), ...]}."""
    members = defaultdict(set)
    for conv, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].add(conv)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        own = (len(members[p]) - 1) * (len(p[-1][1]) if p else 0)
        saved[p] = own + sum(saved[c] for c in children[p])
        leaves[p] = sum(leaves[c] for c in children[p]) if children[p] else 1
    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(rebuilt[c]) == len(p))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return out


def ordered(rows):
    def place(r):
        role, text = r[2] or "", r[3] or ""
        return (r[1] is not None, r[1] or 0, hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest())

    out = defaultdict(list)
    for r in sorted((r for r in rows if r[0] is not None), key=place):
        out[r[0]].append((r[2] or "", r[3] or ""))
    return dict(out)


def slow_rebuilt(turns):
    out = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = turns.get(c - c % 100, [])[:h] + own[h:]
    return out


def conversations():
    r = random.Random(5)
    rows = []
    for c in [*range(0, 40), *range(90, 130), 205, 206, 399, 400, 401]:
        for t in range(r.choice([1, 2, 3, 6, 9, 14])):
            rows.append((c, t, r.choice(["user", "assistant"]), r.choice(["a", "bb", "ccc"]) if t else "hello", "x"))
    rows += [(c, t, "user", "turn" + str(t % 3), "x") for c in (300, 350) for t in range(150)]
    rows += [(7, None, None, "first", "x"), (7, 0, None, None, "x"), (8, 1, "user", "tie", "x"), (8, 1, "user", "other", "x"), (8, 1, "user", "other", "x")]
    rows += [(None, 1, "user", "nobody", "x"), (12, 99, "us", "er:x", "x"), (13, 99, "user", ":x", "x"), (14, 3, "ü", "漢字 " * 5000, "x")]
    r.shuffle(rows)
    return rows


CONVERSATION = "conv_id long, turn long, role string, text string, name string"


@pytest.mark.parametrize("small", [False, True])
def test_prefix_trie(spark, monkeypatch, small):
    if small:  # few ids in a run, few ancestors in a slice, every key hot
        monkeypatch.setattr(prefix_trie, "IDS_PER_ROW", 3)
        monkeypatch.setattr(prefix_trie, "GRAFT_ROWS", 5)
        monkeypatch.setattr(common, "HOT_KEYS", 20)
    rows = conversations()
    df = spark.createDataFrame(rows, CONVERSATION)
    turns = ordered(rows)
    assert bag(prefix_trie.rebuilt_trie(df).collect()) == bag(slow_trie(slow_rebuilt(turns)))
    if not small:
        assert bag(prefix_trie.prefix_trie(df).collect()) == bag(slow_trie(turns))


def test_prefix_trie_edges(spark):
    assert prefix_trie.rebuilt_trie(spark.createDataFrame([], CONVERSATION)).collect() == []
    # h is 5 for conversation 1: its turns go, its base is not there, so it is the root alone
    assert zlib.crc32(b"1") % 6 == 5
    one = [(1, t, "user", "x", None) for t in range(4)]
    got = prefix_trie.rebuilt_trie(spark.createDataFrame(one, CONVERSATION)).collect()
    assert bag(got) == bag(slow_trie({1: []})) and len(got) == 1
    same = [(c, t, "user", "same", None) for c in range(200, 230) for t in range(8)]
    got = prefix_trie.prefix_trie(spark.createDataFrame(same, CONVERSATION))
    assert bag(got.collect()) == bag(slow_trie(ordered(same)))


def test_lookup_splits_hot_keys(spark, monkeypatch):
    monkeypatch.setattr(common, "HOT_KEYS", 3)
    rows = spark.createDataFrame([(i % 7 if i < 20 else 1, i) for i in range(100)], "k long, i long")
    values = rows.groupBy("k").count()
    got = common.lookup(rows, values, "k", "count")
    assert bag(got.select("k", "i", "count").collect()) == bag(rows.join(values, "k").select("k", "i", "count").collect())


# language

def speech(lang, seed, n):
    r = random.Random(f"{lang}{seed}")
    syllables = [random.Random(f"{lang}-{i}").choice("bcdfgklmnprst") + random.Random(f"{lang}+{i}").choice("aeiouäéøñ") for i in range(12)]
    return " ".join("".join(r.choices(syllables, k=r.randint(1, 4))) for _ in range(n)) + r.choice([".", "!", " 42"])


def test_language_of_held_out_texts(spark):
    langs = [f"l{i:02d}" for i in range(11)]  # more than one byte of languages
    rows = [(i, speech(langs[i % 11], i, 60), langs[i % 11], "s", 1) for i in range(660)]
    rows += [(1000 + i, speech(langs[i], f"x{i}", 80), None, "s", 1) for i in range(11)]
    out = {r.doc_id: r for r in language.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, score int")).collect()}
    truth = {i: langs[i % 11] for i in range(660)} | {1000 + i: langs[i] for i in range(11)}
    assert len(out) == len(rows)
    assert all(out[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i in out)
    unseen = [i for i in out if out[i].held_out or i >= 1000]
    assert len(unseen) > 100 and np.mean([out[i].lang_pred == truth[i] for i in unseen]) > 0.97
    assert all(0 <= r.score <= 1 for r in out.values())


def test_held_out_labels_and_ids_are_not_read(spark):
    r = random.Random(1)
    rows = [(i, speech("ab"[i % 2], i, 40), "ab"[i % 2]) for i in range(200)]
    wrong = [(i, t, "zz" if zlib.crc32(str(i).encode()) % 4 == 2 else l) for i, t, l in rows]
    r.shuffle(wrong)
    schema = "doc_id long, text string, lang string"
    first, second = (bag(language.identify(spark.createDataFrame(x, schema)).collect()) for x in (rows, wrong))
    assert first == second


def test_language_edges(spark):
    out = language.identify(edge_docs(spark)).collect()
    assert len(out) == edge_docs(spark).count()
    for r, d in zip(sorted(out, key=repr), sorted(edge_docs(spark).collect(), key=lambda d: repr((d.doc_id,)))):
        assert 0 <= r.score <= 1
    answers = defaultdict(set)
    for r in out:
        answers[r.doc_id].add(r.lang_pred)
    assert answers[4] == answers[5] == answers[6] == answers[12] == answers[18] == {"und"}
    assert answers[1] == {"en"} and answers[10] == {"en"}
    assert language.identify(empty_docs(spark)).collect() == []
    nothing = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert [r.lang_pred for r in language.identify(nothing).collect()] == ["und"]


def test_filters_have_no_misses_and_false_positives_are_corrected():
    r = np.random.default_rng(2)
    keys = r.integers(0, 1 << 64, 40_000, dtype=np.uint64)
    masks = np.zeros((1, 1 << 16), np.uint8)
    for i, mine in enumerate((keys[:20_000], keys[20_000:25_000])):
        for place in language.slots(mine, 16):
            masks[0, place] |= 1 << i
    model = language.Model(["x", "y"], masks)
    model.slots_log2 = 16
    counts = model.popcounts(keys, np.zeros(len(keys), np.int64), 1)[0]
    assert counts[0] >= 20_000 and counts[1] >= 5_000
    real = (counts - len(keys) * model.false) / (1 - model.false)
    assert abs(real[0] - 20_000) < 400 and abs(real[1] - 5_000) < 200


def test_grams_of_blocks_equal_those_of_whole_texts(monkeypatch):
    texts_ = [prose(i, 200 + i).encode() for i in range(20)] + [b"", "é漢 x".encode()]
    masks = np.random.default_rng(1).integers(0, 16, (1, 1 << 12)).astype(np.uint8)
    model = language.Model(list("abcd"), masks)
    whole = model.judge(texts_)
    monkeypatch.setattr(language, "BLOCK", 37)
    assert model.judge(texts_) == whole and [model.judge([t])[0] for t in texts_] == whole


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables here")
def test_languages_of_the_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r.lang == r.lang_pred for r in out]) > 0.99
