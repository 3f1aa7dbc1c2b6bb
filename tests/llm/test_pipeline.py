"""Each stage of the pipeline on its own input, and all of them."""

import random

import pytest

import corpus_pipeline
from llm.edge import bag, prose
from tablelift.llm import queries
from test_duplicates import slow_components, slow_print
from test_filters import slow_hits


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("sf")
    r = random.Random(11)
    vocabulary = ["".join(r.choice("abcdefghij") for _ in range(r.randint(2, 8))) for _ in range(3000)]
    item = lambda i: " ".join(random.Random(1000 + i).choices(vocabulary, k=30))
    docs = []
    for i in range(120):
        text = " ".join(r.choices(vocabulary, k=r.randint(60, 300)))
        if i % 7 == 0:
            text += " " + item(i % 3)
        if i % 9 == 0:
            text += ' token = "0123456789abcdef0123456789abcdef"'
        if i % 10 == 0:
            text = " ".join(w + "%%%" for w in text.split())
        docs.append((i, text, "en", f"s{i % 2}", len(text), f"extra{i}"))
    docs += [(200 + d[0], d[1], *d[2:]) for d in docs[:30]] + [(300, None, None, None, None, None), (301, "", "en", "s0", 0, None), (None, prose(5, 100), "en", "s0", 1, "x")]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long, `clash.kept` string").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, item(i)) for i in range(3)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def test_stages(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{tables}/benchmark.parquet").collect()]
    columns, before = docs.columns, docs.collect()

    good = corpus_pipeline.quality_rules(spark, docs, tables)
    kept = {r.doc_id for r in good.collect()}
    assert good.columns == columns and kept == {r.doc_id for r in before if r.text and "%%%" not in r.text}

    one = corpus_pipeline.near_duplicates(spark, good, tables)
    rows = [(r.doc_id, slow_print(r.text)) for r in good.collect()]
    assert one.columns == columns
    assert bag(r.doc_id for r in one.collect() if r.doc_id is not None) == bag({c for c in slow_components(rows) if c is not None})

    clean = corpus_pipeline.benchmark_passages(spark, one, tables)
    old, new = {r.doc_id: r for r in one.collect()}, {r.doc_id: r for r in clean.collect()}
    assert clean.columns == columns
    for doc_id, row in old.items():
        words, hit, _ = slow_hits(row.text, items)
        if not hit:
            assert new[doc_id] == row
        elif 2 * len(hit) > len(words):
            assert doc_id not in new
        else:
            assert not slow_hits(new[doc_id].text, items)[1]

    safe = corpus_pipeline.mask_secrets(spark, clean, tables).collect()
    assert len(safe) == len(new) and not any("0123456789abcdef" in r.text for r in safe)
    assert all(r == new[r.doc_id] for r in safe if "token" not in new[r.doc_id].text)


def test_whole_pipeline(spark, tables):
    out = corpus_pipeline.run(spark, tables)
    assert "sequence_id" in out.columns and out.count() > 0
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "benchmark_passages", "secrets", "packing"]


def test_every_operator_is_registered():
    assert [name.split("_")[0] for name in queries.QUERIES] == [f"op{n}" for n in range(1, 14)]
