"""Quality rules, decontamination, personal data, secrets and licenses against plain versions."""

import hashlib
import random
import re

import pytest
from hypothesis import given, settings, strategies as st

from llm.edge import bag, edge_docs, empty_docs, prose, texts
from oracle import connect, differences
from tablelift.llm import decontaminate, licenses, pii, quality, secrets

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


# Quality

def counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    seen, hit = {}, set()
    for i in range(len(words) - 2):
        seen.setdefault(tuple(words[i : i + 3]), []).append(i)
    for places in seen.values():
        if len(places) > 1:
            hit.update(p + k for p in places for k in range(3))
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(hit)


def test_quality_counts(spark):
    got = quality.rules(edge_docs(spark)).collect()
    want = []
    for doc_id, text in texts():
        own = counts(text)
        want.append((doc_id, *own, own[0] < 50 or 100 * own[4] > 50 * own[0]))
    assert bag(tuple(r)[:-1] for r in got) == bag(want)
    assert all(not (r.kept and r.base_failed) for r in got)
    assert quality.rules(empty_docs(spark)).count() == 0


def quality_docs(spark):
    """A clean and a symbol-laden half in one source, small groups, null groups."""
    r = random.Random(2)
    rows = []
    for i in range(400):
        text = " ".join("".join(r.choice("abcdefgh") for _ in range(r.randint(2, 9))) for _ in range(r.randint(40, 90)))
        if i % 10 == 0:
            text = " ".join(w + "###" for w in text.split())
        if i % 11 == 0:
            text = "\n".join([text[:300]] * 2 + [text])
        rows.append((i, text, [None, "en", "de"][i % 3] if i > 300 else "en", "s0" if i < 300 else [None, "s1"][i % 2], len(text)))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def test_quality_equals_sql(spark, tmp_path):
    import duckdb

    docs = quality_docs(spark)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    got = quality.rules(docs)
    assert differences(got, connection, quality.ORACLE) == []
    kept = {r.doc_id for r in got.collect() if r.kept}
    assert 100 < len(kept) < 400 and not any(i % 10 == 0 for i in kept)
    assert {r.doc_id for r in quality.keep_good(docs).collect()} == kept


def test_keep_good_keeps_columns(spark):
    docs = edge_docs(spark)
    good = quality.keep_good(docs)
    assert good.schema == docs.schema
    want = bag(r.doc_id for r in quality.rules(docs).collect() if r.kept)
    assert bag(r.doc_id for r in good.collect()) == want
    assert quality.keep_good(empty_docs(spark)).count() == 0


# Decontamination

def slow_hits(text, items, window=10):
    words, hit, ids = WORD.findall(lower(text)), set(), set()
    for item, other in items:
        own = WORD.findall(lower(other))
        n = min(window, len(own))
        windows = {tuple(own[k : k + n]) for k in range(len(own) - n + 1)} if n else set()
        for k in range(len(words) - n + 1):
            if n and tuple(words[k : k + n]) in windows:
                hit.update(range(k, k + n))
                ids.add(item)
    return words, hit, ids


@settings(max_examples=300, deadline=None)
@given(st.integers(1, 4), st.integers(2, 6), st.data())
def test_automaton(letters, window, data):
    word = st.sampled_from("abcd"[:letters])
    items = [(i, " ".join(w)) for i, w in enumerate(data.draw(st.lists(st.lists(word, max_size=12), max_size=4)))]
    text = " ".join(data.draw(st.lists(word, max_size=30)))
    automaton = decontaminate.Automaton.build([(i, decontaminate.words_of(t.encode())) for i, t in items], window)
    spans, ids = [], set()
    for a, b, own in automaton.runs(decontaminate.words_of(text.encode())):
        spans.append((a, b))
        ids.update(own)
    _, hit, want = slow_hits(text, items, window)
    assert {x for a, b in decontaminate.merge(spans) for x in range(a, b)} == hit and ids == want


def benchmark_rows():
    return [(1, prose(50, 25)), (2, "short item only"), (3, None), (4, "..."), (5, prose(1, 30)), (5, "again five"), (None, prose(52, 15)), (22, prose(50, 25))]


@pytest.mark.parametrize("block_bytes", [1 << 20, 150])
def test_contamination(spark, block_bytes):
    benchmark = spark.createDataFrame(benchmark_rows(), "item_id long, text string")
    extra = [(50, "Start. " + prose(50, 25).upper() + " end"), (51, "a SHORT, item-only b"), (52, prose(52, 15)), (53, prose(50, 9))]
    docs = edge_docs(spark).unionByName(spark.createDataFrame(extra, "doc_id long, text string"), allowMissingColumns=True)
    got = decontaminate.contamination(docs, benchmark, block_bytes=block_bytes).collect()
    want = []
    for doc_id, text in texts() + extra:
        words, hit, ids = slow_hits(text, benchmark_rows())
        named = sorted(str(i) for i in ids if i is not None)
        want.append((doc_id, len(words), len(hit), len(named), hashlib.sha256(",".join(named).encode()).hexdigest(), bool(hit)))
    assert bag(got) == bag(want)


def test_no_benchmark_and_no_documents(spark):
    benchmark = spark.createDataFrame([], "item_id long, text string")
    assert not any(r.contaminated for r in decontaminate.contamination(edge_docs(spark), benchmark).collect())
    benchmark = spark.createDataFrame(benchmark_rows(), "item_id long, text string")
    assert decontaminate.contamination(empty_docs(spark), benchmark).count() == 0
    assert decontaminate.remove_passages(empty_docs(spark), benchmark).count() == 0


def test_remove_passages(spark):
    benchmark = spark.createDataFrame(benchmark_rows(), "item_id long, text string")
    clean, passage = prose(90, 40).replace("the", "none"), prose(50, 25)
    docs = spark.createDataFrame(
        [(1, f"{clean} {passage} tail", 5, "x"), (2, passage, 6, "y"), (3, clean, 7, "z"), (4, None, None, None)],
        "doc_id long, text string, n_chars int, `a.b` string",
    )
    got = {r.doc_id: r for r in decontaminate.remove_passages(docs, benchmark).collect()}
    assert sorted(got) == [1, 3, 4] and got[3] == docs.where("doc_id = 3").first() and got[4].text is None
    assert got[1].text == f"{clean} tail" and got[1].n_chars == len(got[1].text)
    assert not slow_hits(got[1].text, benchmark_rows())[1]


# Personal data

def slow_personal(text):
    digits = lambda s: [int(c) for c in s if c in "0123456789"]

    def luhn(d):
        return sum(d[::-1][::2] + [sum(divmod(2 * x, 10)) for x in d[::-1][1::2]]) % 10 == 0

    find = lambda p: re.finditer(p, text)
    return {
        "email": [m.span() for m in find(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")],
        "ip": [m.span() for m in find(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)") if all(int(x) <= 255 for x in m.group().split("."))],
        "card": [m.span() for m in find(r"[0-9]([\x20\-]?[0-9])+") if 13 <= len(digits(m.group())) <= 19 and luhn(digits(m.group()))],
        "phone": [m.span() for m in find(r"\+[0-9][\x20().0-9-]+[0-9]") if 9 <= len(digits(m.group())) <= 15],
    }


@settings(max_examples=500, deadline=None)
@given(st.sampled_from(["a1@.- ", "12.-+ ()", "0123456789 -", "a@.b-@", "+12 (5).-é"]).flatmap(lambda a: st.text(alphabet=a, max_size=40)))
def test_plain_personal_data(text):
    assert pii.base_spans(text) == slow_personal(text)


@pytest.mark.parametrize(
    "text, kind, found",
    [
        ("write to john.smith (at) example (dot) com now", "email", "john.smith (at) example (dot) com"),
        ("jane at mail dot example dot org today", "email", "jane at mail dot example dot org"),
        ("x john[at]mail.example.com y", "email", "john[at]mail.example.com"),
        ("anne{at}host{dot}de", "email", "anne{at}host{dot}de"),
        ("jоhn@exаmple.com is Cyrillic", "email", "jоhn@exаmple.com"),
        ("a@b​.com", "email", "a@b​.com"),
        ("4 ４１１１ １１１１ １１１１ １１１１ x", None, None),
        ("pay ４１１１ １１１１ １１１１ １１１１ x", "card", "４１１１ １１１１ １１１１ １１１１"),
        ("host 192 dot 168 dot 1 dot 20 up", "ip", "192 dot 168 dot 1 dot 20"),
        ("call plus one five five five two three four five six seven eight", "phone", "plus one five five five two three four five six seven eight"),
        ("we met at noon. Then it was a dot on a map", None, None),
        ("see it at example.com or at home", None, None),
    ],
)
def test_disguises(text, kind, found):
    _, added = pii.scan(text)
    spans = [(k, text[a:b]) for k, own in added.items() for a, b in own]
    assert spans == ([(kind, found)] if kind else [])


@pytest.mark.parametrize(
    "text, kind, found",
    [
        ("pay 4111 1111 1111 one one one one now", "card", "4111 1111 1111 one one one one"),
        ("pay 4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 one now", "card", "4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 one"),
        ("call +49 151 two three four five six please", "phone", "+49 151 two three four five six"),
        ("call plus four nine 151 2345 six please", "phone", "plus four nine 151 2345 six"),
        ("host one nine two dot one six eight dot one dot one up", "ip", "one nine two dot one six eight dot one dot one"),
        ("host 10 dot zero dot 0 dot 7 up", "ip", "10 dot zero dot 0 dot 7"),
        ("jane at mail dot example dot berlin today", "email", "jane at mail dot example dot berlin"),
        ("jane at example dot one", "email", "jane at example dot one"),
        ("one of two, three or four things, then 5 more", None, None),
    ],
)
def test_spelled_digits_in_groups(text, kind, found):
    _, added = pii.scan(text)
    assert [(k, text[a:b]) for k, own in added.items() for a, b in own] == ([(kind, found)] if kind else [])


@pytest.mark.parametrize(
    "text, kind, found, rest",
    [
        ("x j\u043ehn@example.com y", "email", "j\u043ehn@example.com", "x [EMAIL] y"),
        ("x john@example.c\u043em y", "email", "john@example.c\u043em", "x [EMAIL] y"),
        ("x jo\u200bhn@example.com y", "email", "jo\u200bhn@example.com", "x [EMAIL] y"),
        ("x +49 151 23456789\uff11\uff12 y", "phone", "+49 151 23456789\uff11\uff12", "x [PHONE] y"),
        ("a@b.com j\u043ehn@example.com c@d.org", "email", "j\u043ehn@example.com", "[EMAIL] [EMAIL] [EMAIL]"),
    ],
)
def test_disguise_around_a_plain_part(text, kind, found, rest):
    base, added = pii.scan(text)
    assert [(k, text[a:b]) for k, own in added.items() for a, b in own] == [(kind, found)]
    assert base == slow_personal(text) and pii.masked(text) == rest


def test_personal_data_rows(spark):
    got = pii.find(edge_docs(spark)).collect()
    want = []
    for doc_id, text in texts():
        own = slow_personal(text or "")
        plain = ",".join(f"{k}:{a}:{b}" for k in pii.KINDS for a, b in own[k])
        want.append((doc_id, *(len(own[k]) for k in pii.KINDS), hashlib.sha256(plain.encode()).hexdigest()))
    assert bag(tuple(r)[:6] for r in got) == bag(want)
    assert all(r.n_added == 0 for r in got if r.doc_id != 10)
    assert pii.find(empty_docs(spark)).count() == 0
    assert pii.masked("a@b.com or c (at) d (dot) org.") == "[EMAIL] or [EMAIL]."


def test_long_personal_data_is_linear():
    for text in ["1" * 300_000, "a" * 300_000 + "@", "1." * 150_000, "+1" * 100_000, "a.b" * 100_000, "1 " * 150_000, "at dot " * 40_000, "([" * 100_000]:
        pii.scan(text)


# Secrets

ASSIGN = r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


def slow_secrets(text):
    spans = [("assign", *m.span()) for m in re.finditer(ASSIGN, text) if len(m[2]) >= 8]
    spans += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 16]
    spans += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 32]
    order = ["assign", "access", "hex"]
    return sorted(spans, key=lambda s: (s[1], order.index(s[0])))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(["PassWord", "token", "api_key", "APIKEY", "secret", "ſecret", "=", ":", " ", '"', "'", "abc", "0af3", "AKIA", "Z9", "f" * 20, "\n", "é"]), max_size=20).map("".join))
def test_plain_secrets(text):
    base = secrets.base_spans(text)
    got = [(k, *s) for k in secrets.KINDS for s in base[k]]
    assert sorted(got, key=lambda s: (s[1], secrets.KINDS.index(s[0]))) == slow_secrets(text)


def sample():
    r = random.Random(6)
    hexes = [("hex", "".join(r.choice("0123456789abcdef") for _ in range(40))) for _ in range(300)]
    keys = [("access", "AKIA" + "".join(r.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") for _ in range(16))) for _ in range(300)]
    mixed = [("assign", "".join(r.choice("ABCDEFGHIJabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(24))) for _ in range(300)]
    return hexes + keys + mixed + [("word", w * 2) for w in prose(4, 400).replace(",", "").replace(".", "").split()]


def test_inferred_formats_on_held_out_values():
    r = random.Random(9)
    formats = secrets.Formats(sample())
    held_out = ["".join(r.choice("ABCDEFGHIJabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(24)) for _ in range(200)]
    found = sum(formats.likeness(v) > secrets.MARGIN for v in held_out)
    words = ["".join(r.choice(prose(i, 5).replace(",", "").replace(".", "").split()) for _ in range(4)) for i in range(200)]
    wrong = sum(secrets.mixed(w) and formats.likeness(w) > secrets.MARGIN for w in words)
    assert found >= 190 and wrong == 0


def test_every_candidate_is_scored(spark):
    r = random.Random(21)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
    key = lambda n, alphabet=letters + "0123456789+/": "".join(r.choice(alphabet) for _ in range(n))
    compound = lambda: " ".join(r.choice(prose(1, 99).split()).strip(",.") + r.choice(["ing", "ed", "s", "less", "ly", "man"]) for _ in range(20))
    labels = [f'token = "{key(40)}" {compound()}' for _ in range(600)]
    held_out = [key(n) for n in (20, 32, 40, 64) for _ in range(100)] + [key(32, letters) for _ in range(100)]
    jwt = ".".join(["eyJhbGciOiJIUzI1NiIsInR5cCI6IkpXVCJ9", key(60, letters + "0123456789-_"), key(43, letters + "0123456789-_")])
    hidden = "/the/quick/brown/fox" * 20 + "/" + key(40, letters + "0123456789")
    plain = ["/".join(prose(i, 6).replace(",", "").replace(".", "").split()) for i in range(100)]
    plain += ["-" * 40, "1234567890123456", "brownFoxJumpsOverLazyDog", "seven.wizards.hum.old.songs", "fires_and_rivers_2024_01"]
    rows = [(i, t) for i, t in enumerate([*labels, *(f"see {v} there" for v in [*held_out, jwt, hidden, *plain])])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    texts_of, added = dict(rows), {}
    for row in secrets.find(docs).collect():
        spans = [s.split(":") for s in row.spans.split(",") if s.startswith("format")]
        added[row.doc_id] = [texts_of[row.doc_id][int(a) : int(b)] for _, a, b in spans]
    first = len(labels)
    whole = [added[first + i] == [v] for i, v in enumerate(held_out)]
    assert all(sum(whole[k : k + 100]) >= 97 for k in range(0, 500, 100)), [sum(whole[k : k + 100]) for k in range(0, 500, 100)]
    first += len(held_out)
    assert added[first] == [jwt] and added[first + 1] and added[first + 1][0].endswith(hidden[-40:]) and len(added[first + 1][0]) < 100
    assert not any(added[first + 2 + i] for i in range(len(plain))), [added[first + 2 + i] for i in range(len(plain)) if added[first + 2 + i]]


def test_automaton_merges_what_is_alike():
    r = random.Random(3)
    strings = ["".join(r.choice("ab") for _ in range(r.randint(1, 20))) for _ in range(2000)]
    merged = secrets.Automaton.infer(strings)
    assert len(merged.step) < len(secrets.Automaton.tree(strings).step) / 50
    two_phase = secrets.Automaton.infer(["ab" * r.randint(2, 8) for _ in range(2000)])
    assert two_phase.score("abababab") > two_phase.score("aabbaabb") + 0.5


def test_secret_rows(spark):
    got = secrets.find(edge_docs(spark)).collect()
    want = []
    for doc_id, text in texts():
        own = slow_secrets(text or "")
        plain = ",".join(f"{k}:{a}:{b}" for k, a, b in own)
        want.append((doc_id, *(sum(k == kind for k, _, _ in own) for kind in secrets.KINDS), hashlib.sha256(plain.encode()).hexdigest()))
    assert bag(tuple(r)[:5] for r in got) == bag(want)
    assert secrets.find(empty_docs(spark)).count() == 0


def test_mask_secrets(spark):
    docs = edge_docs(spark)
    got = secrets.mask_secrets(docs)
    assert got.columns == docs.columns and got.count() == docs.count()
    old, new = {r.doc_id: r for r in docs.collect()}, {r.doc_id: r for r in got.collect()}
    assert new[15].text == 'password = "[SECRET]" and [SECRET] and [SECRET]' and new[15].n_chars == len(new[15].text)
    assert new[1] == old[1] and new[4].text is None
    assert secrets.mask_secrets(empty_docs(spark)).count() == 0


# Licenses

def slow_phrases(text):
    words = WORD.findall(lower(text))
    places = []
    for phrase, label in licenses.PHRASES:
        own = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i : i + len(own)] == own]
    return len(words), places


def test_license_rows(spark):
    extra = [
        (50, "x " * 30 + "Released under the MIT License. " + "y " * 30), (51, "cc by cc by; all rights reserved"), (52, "CC BY and K"),
        (53, "Permission is hereby granted, free of charge, to any other person obtaining a copy of this software and associated documentation files"),
        (54, "released under the great license"), (55, "Released under the MIT License. " * 50),
    ]
    docs = edge_docs(spark).unionByName(spark.createDataFrame(extra, "doc_id long, text string"), allowMissingColumns=True)
    got = licenses.scan(docs).collect()
    want = []
    for doc_id, text in texts() + extra:
        n, places = slow_phrases(text)
        at = [i for i, _ in places]
        want.append((doc_id, n, len(places), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))))
    assert bag(tuple(r)[:6] for r in got) == bag(want)
    named = {r.doc_id: r for r in got}
    assert named[50].labels == named[53].labels == named[55].labels == "mit" and named[54].labels == ""
    assert named[50].score == 1.0 and 0.75 <= named[53].score < 1.0 and named[54].score == 0.0
    assert all(0 <= r.score <= 1 for r in got)
    assert licenses.scan(empty_docs(spark)).count() == 0


def test_neighbouring_diagonals_merge(spark):
    words = licenses.TEMPLATES[13][1].split()
    broken = " ".join([*words[:9], "really", *words[9:]])  # a word more moves the second half one diagonal on
    docs = spark.createDataFrame([(1, broken), (2, " ".join(words[:9]))], "doc_id long, text string")
    got = {r.doc_id: r for r in licenses.scan(docs).collect()}
    assert got[1].labels == "mit" and got[2].labels == ""


def test_license_sql(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert differences(licenses.scan(docs), connect(sf_dir), licenses.ORACLE) == []


def test_license_edits(spark):
    """One word inserted, deleted or changed at every place of every template; the license's name stays."""
    rows, want = [], {}
    for label, text in licenses.TEMPLATES:
        own = text.split()
        name = {i for i, w in enumerate(own) if w in label.split("-")}
        edits = [("insert", [*own[:i], "verily", *own[i:]]) for i in range(1, len(own))]
        edits += [("delete", own[:i] + own[i + 1 :]) for i in range(len(own)) if i not in name]
        edits += [("change", [*own[:i], "verily", *own[i + 1 :]]) for i in range(len(own)) if i not in name]
        for kind, edited in edits:
            want[len(rows)] = (kind, label)
            rows.append((len(rows), "some words before " + " ".join(edited) + " and after it"))
    found = {r.doc_id: r.labels.split(",") for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for kind in ("insert", "delete", "change"):
        hits = [label in found[i] for i, (k, label) in want.items() if k == kind]
        assert sum(hits) >= 0.97 * len(hits), kind
    for label, text in licenses.TEMPLATES:
        hits = [label in found[i] for i, (_, mine) in want.items() if mine == label]
        assert sum(hits) >= 0.9 * len(hits), label


def test_other_names_are_other_licenses(spark):
    texts_ = ["licensed under the acme license", "released under the great license", "licensed under cc by nc 4 0", "of the license under the terms of the mit " * 30]
    got = [r.labels for r in licenses.scan(spark.createDataFrame(enumerate(texts_), "doc_id long, text string")).orderBy("doc_id").collect()]
    assert got[:2] == ["", ""] and got[2] == "cc-by,cc-by-nc" and got[3] == ""
    with pytest.raises(ValueError):
        licenses.templates(spark, [("x", "word " * 63)])
