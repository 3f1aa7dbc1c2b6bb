"""SimHash, Golay keys and components against brute force."""

import random

import numpy as np
import xxhash

from llm.edge import bag, edge_docs, empty_docs, prose, texts
from tablelift.llm import simhash


def slow_print(text):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace("\x0b", " ").replace("\x0c", " ").replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(rows):
    """rows: (doc_id, fp); the smallest reachable id per row."""
    todo, out = list(range(len(rows))), [None] * len(rows)
    while todo:
        group, front = set(), [todo[0]]
        while front:
            i = front.pop()
            if i not in group:
                group.add(i)
                front += [j for j in range(len(rows)) if j not in group and (rows[i][1] ^ rows[j][1]).bit_count() <= 4]
        least = min((rows[i][0] for i in group if rows[i][0] is not None), default=None)
        for i in group:
            out[i] = least
        todo = [i for i in todo if i not in group]
    return out


def test_golay_code_is_perfect():
    decoder = simhash.golay_decoder()
    assert np.bincount(decoder).tolist() == [2048] * 4096
    # zero is a codeword: everything within three bits of it has its key, nothing at four
    own = decoder[0]
    weights = np.array([int(x).bit_count() for x in np.flatnonzero(decoder == own)])
    assert weights.max() == 3


def test_keys_meet_up_to_four_bits():
    r = random.Random(7)
    a = np.array([r.getrandbits(64) for _ in range(3000)], np.uint64)
    b = a.copy()
    for k in range(len(b)):
        for bit in r.sample(range(64), r.randint(1, 4)):
            b[k] ^= np.uint64(1 << bit)

    def keys(prints):
        out = [set() for _ in prints]
        for row, side, key in zip(*(x.tolist() for x in simhash.join_keys(prints))):
            out[row].add((side, key))
        return out

    for x, y in zip(keys(a), keys(b)):
        meets = any((1, k) in y for s, k in x if s == 0) or any((0, k) in y for s, k in x if s == 1)
        assert meets or any(p in y for p in x if p[0] == 2)


def test_fingerprints():
    for _, text in texts():
        if text is None or len(text) < 20_000:
            assert simhash.fingerprint((text or "").encode()) == slow_print(text)
    long = prose(3, 70_000)
    assert simhash.fingerprint(long.encode()) == slow_print(long)


def family(seed, n, words=300):
    r = random.Random(seed)
    base = prose(seed, words).split()
    out = []
    for _ in range(n):
        copy = list(base)
        for _ in range(r.randint(0, 3)):
            copy[r.randrange(len(copy))] = r.choice(["alpha", "beta", "gamma"])
        out.append(" ".join(copy))
    return out


def test_near_duplicates(spark):
    known = [(100 + i, t) for i, t in enumerate(family(1, 40) + family(2, 30) + family(3, 20))]
    known += [(None, family(1, 1)[0]), (5, ""), (3, None), (9, " "), (7, prose(8, 50)), (7, prose(8, 50)), (8, prose(9, 3))]
    rows = [(i, slow_print(t)) for i, t in known]
    want = [(i, f"{fp:016x}", c) for (i, fp), c in zip(rows, slow_components(rows))]
    got = simhash.near_duplicates(spark.createDataFrame(known, "doc_id long, text string"))
    assert bag(got.collect()) == bag(want)


def test_edges(spark):
    docs = edge_docs(spark)
    got = simhash.near_duplicates(docs).collect()
    rows = [(i, slow_print(t)) for i, t in texts() if i not in (9,)]
    assert len(got) == len(texts())
    want = bag((i, f"{fp:016x}") for i, fp in rows)
    assert bag((r.doc_id, r.fingerprint) for r in got if r.doc_id != 9) == want
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    groups = {(r.component_id if r.component_id is not None else r.fingerprint) for r in got}
    assert kept.count() == len(groups)
    assert bag(r.doc_id for r in kept.collect() if r.doc_id is not None) == bag({r.component_id for r in got if r.component_id is not None})
    assert simhash.near_duplicates(empty_docs(spark)).count() == 0
    assert simhash.drop_near_duplicates(empty_docs(spark)).count() == 0


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(0, 200) if i != 100]
    random.Random(1).shuffle(edges)
    got = {r.node: r.root for r in simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 if i <= 100 else 101 for i in range(1, 201) if i != 101}
