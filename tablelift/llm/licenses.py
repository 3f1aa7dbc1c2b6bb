"""License statements in texts: phrases, and templates found by diagonal voting.

Hashes of all windows of ``GRAM`` words of a text are joined to the positions of the same hashes in the
templates.  Matches of one statement lie on one diagonal (place in the text minus place in the template),
or on neighbouring ones where a word is missing or added.  Votes are summed by diagonal for each stretch of the
text, stretches that go on on a neighbouring diagonal are merged, and a span that covers enough words of its
template, the license's name among them, is a find.

Only DataFrame functions are used.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tablelift.llm.common import free_names
from tablelift.session import materialize

GRAM = 2
#: Diagonals of one statement are at most this far apart, and its windows so many words.
DRIFT = 2
GAP = 4
#: Hundredths of a template's words that must be covered by its windows.
COVERAGE = 60
#: Words of a template at most: the covered ones are bits of a number.
MAX_TEMPLATE = 62

# Phrases and statements of common licenses, in words.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
TEMPLATES = (
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("apache-2.0", "you may not use this file except in compliance with the license"),
    ("apache-2.0", "distributed under the license is distributed on an as is basis without warranties or conditions of any kind"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd", "licensed under the bsd license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    ("gpl", "licensed under the gnu general public license version 3"),
    ("gpl", "it under the terms of the gnu general public license as published by the free software foundation"),
    ("mit", "released under the mit license"),
    ("mit", "licensed under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
)

BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words of ASCII letters in lower case, digits and all characters beyond ASCII."""
    # The Kelvin sign alone would become an ASCII letter in lower case.
    return F.filter(F.split(F.lower(F.replace(text, F.lit("\u212a"), F.lit("\u03ba"))), BREAKS), lambda w: w != "")


def _windows(w: Column) -> Column:
    """(at, h) of every window."""
    rest = lambda i: [F.get(w, i + n) for n in range(1, GRAM)]
    return F.transform(
        F.slice(w, 1, F.size(w) - (GRAM - 1)), lambda x, i: F.struct(i.alias("at"), F.xxhash64(x, *rest(i)).alias("h"))
    )


def _key_bits(label: str, own: list[str]) -> int:
    """The words of a template that are parts of its label: without them it would be another license."""
    return sum(1 << i for i, word in enumerate(own) if word in label.split("-"))


def templates(spark: SparkSession, texts=TEMPLATES) -> DataFrame:
    """h, template, label, place, n (words of the template) and key (bits of its name); a row for each window."""
    rows = []
    for i, (label, text) in enumerate(texts):
        own = [w for w in re.split(BREAKS, text.lower()) if w]
        if len(own) > MAX_TEMPLATE:
            raise ValueError(f"a template has {MAX_TEMPLATE} words at most; cut it into several")
        rows.append((i, label, text, len(own), _key_bits(label, own)))
    df = spark.createDataFrame(rows, "template int, label string, text string, n int, key long").withColumn("w", words(F.col("text")))
    df = df.where(F.size("w") >= GRAM).withColumn("s", _windows(F.col("w")))
    return df.select("template", "label", "n", "key", F.explode("s").alias("p")).select(
        F.col("p.h").alias("h"), "template", "label", F.col("p.at").alias("place"), "n", "key"
    )


def _phrases(w: Column) -> Column:
    """(at, label) of every place where a phrase stands."""
    def stands(words_of_phrase, x, i):
        test = x == words_of_phrase[0]
        for n, word in enumerate(words_of_phrase[1:], 1):
            test = test & F.coalesce(F.get(w, i + n) == word, F.lit(False))
        return test

    def mark(x, i):
        case = F
        for phrase, label in PHRASES:
            case = case.when(stands(phrase.split(), x, i), F.struct(i.alias("at"), F.lit(label).alias("label")))
        return case

    return F.filter(F.transform(w, mark), lambda m: m.isNotNull())


def finds(matches: DataFrame, known: DataFrame) -> DataFrame:
    """row, label, coverage of verified statements, from the windows (row, at, h) of texts."""
    votes = (
        matches.join(F.broadcast(known), "h")
        .select("row", "template", "label", "n", "key", "place", "at", (F.col("at") - F.col("place")).alias("diagonal"))
    )
    key = ["row", "template"]
    running = lambda w: F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0))
    along = Window.partitionBy(*key, "diagonal").orderBy("at")
    apart = F.coalesce(F.col("at") - F.lag("at").over(along) > GAP, F.lit(True))
    stretches = (
        votes.withColumn("new", apart.cast("int")).withColumn("stretch", running(along))
        .groupBy(*key, "label", "n", "key", "diagonal", "stretch")
        .agg(F.min("at").alias("low"), F.max("at").alias("high"), F.bit_or(F.expr("shiftleft(3L, place)")).alias("covered"))
    )
    order = Window.partitionBy(*key).orderBy("low", "diagonal")
    before = {c: F.lag(c).over(order) for c in ("high", "diagonal")}
    near = (F.abs(F.col("diagonal") - before["diagonal"]) <= DRIFT) & (F.abs(F.col("low") - before["high"]) <= GAP)
    bands = (
        stretches.withColumn("new", (~F.coalesce(near, F.lit(False))).cast("int")).withColumn("band", running(order))
        .groupBy(*key, "label", "n", "key", "band")
        .agg(F.min("low").alias("low"), F.max("high").alias("high"), F.bit_or("covered").alias("covered"))
    )
    length, found = F.col("high") - F.col("low") + GRAM, F.bit_count("covered")
    named = F.col("covered").bitwiseAND(F.col("key")) == F.col("key")
    sure = bands.where((100 * found >= COVERAGE * F.col("n")) & named & (length < 2 * F.col("n")))
    return sure.groupBy("row", "label").agg(F.max(found / F.greatest(F.col("n"), length)).alias("coverage"))


def scan(docs: DataFrame, texts=TEMPLATES) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels and score of every row of ``docs``.

    score is 1 where a phrase stands, else the best share of a template's words (of the text's, where these are
    more) in a find, else 0.

    Null and empty texts have no words and no labels (empty text).  A null ``doc_id`` is carried along,
    repeated rows get a row each, an empty table gives no rows, other columns are not read.
    """
    known = materialize(templates(docs.sparkSession, texts), "templates")
    hashes = [r.h for r in known.select("h").distinct().collect()]  # of the templates, whose number is fixed
    text, w, base = free_names(docs.select("doc_id"), "text_", "w_", "base_")
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias(text))
    rows = rows.withColumn(w, words(F.col(text)))
    low = F.lower(text)
    may = low.contains("cc") | low.contains("general") | low.contains("rights")
    none = F.array().cast("array<struct<at:int,label:string>>")
    slim = rows.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", F.size(w).cast("long").alias("n_words"),
        F.when(may, _phrases(F.col(w))).otherwise(none).alias(base),
        F.when(F.size(w) >= GRAM, F.filter(_windows(F.col(w)), lambda s: s["h"].isin(hashes))).alias("windows"),
    )
    # A find has several windows close together; one that stands alone votes for nothing.
    def beside(x, i):
        close = lambda j: F.coalesce(F.abs(F.get("windows", j)["at"] - x["at"]) <= GAP, F.lit(False))
        return close(i - 1) | close(i + 1)

    slim = slim.withColumn("windows", F.filter("windows", beside))
    slim = materialize(slim, "license-words")  # fixes the row numbers; texts are not in it
    matches = slim.select("row", F.explode("windows").alias("s")).select("row", F.col("s.at").alias("at"), F.col("s.h").alias("h"))
    found = finds(matches, known).groupBy("row").agg(
        F.collect_set("label").alias("more"), F.max("coverage").alias("coverage")  # as many as there are labels at most
    )
    own = F.array_distinct(F.transform(base, lambda b: b["label"]))
    both = F.array_union(own, F.coalesce("more", F.array().cast("array<string>")))
    at = F.transform(base, lambda b: b["at"].cast("long"))
    return slim.join(found, "row", "left").select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(at).alias("first_word"), F.array_max(at).alias("last_word"),
        F.array_join(F.array_sort(own), ",").alias("base_labels"), F.array_join(F.array_sort(both), ",").alias("labels"),
        F.when(F.size(base) > 0, 1.0).otherwise(F.coalesce("coverage", F.lit(0.0))).alias("score"),
    )


def _template_sql() -> str:
    rows = []
    for i, (label, text) in enumerate(TEMPLATES):
        own = re.findall("[0-9a-z]+", text)
        grams = [" ".join(own[k : k + GRAM]) for k in range(len(own) - GRAM + 1)]
        rows += [f"({i}, '{label}', '{g}', {k}, {len(own)}, {_key_bits(label, own)})" for k, g in enumerate(grams)]
    return ", ".join(rows)


def _phrase_sql() -> str:
    out = []
    for phrase, label in PHRASES:
        own = phrase.split()
        test = " AND ".join(f"w[i + {n}] = '{word}'" for n, word in enumerate(own))
        out.append(f"SELECT k, i - 1 AS spot, '{label}' AS label FROM p WHERE {test}")
    return " UNION ALL ".join(out)


ORACLE = rf"""
WITH t AS (
    SELECT row_number() OVER () AS k, doc_id, list_filter(regexp_split_to_array(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
p AS (SELECT k, w, unnest(range(1, len(w) + 1)) AS i FROM t),
b AS ({_phrase_sql()}),
bb AS (SELECT k, count(*) AS n_base, min(spot) AS first_word, max(spot) AS last_word,
              string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM b GROUP BY k),
g AS (SELECT k, i - 1 AS spot, array_to_string(w[i:i + {GRAM - 1}], ' ') AS g FROM p WHERE i + {GRAM - 1} <= len(w)),
m(template, label, g, place, n, key) AS (VALUES {_template_sql()}),
v AS (SELECT k, template, label, n, key, place, spot, spot - place AS diagonal FROM g JOIN m USING (g)),
d AS (SELECT *, CASE WHEN spot - lag(spot) OVER (PARTITION BY k, template, diagonal ORDER BY spot) <= {GAP} THEN 0 ELSE 1 END AS new FROM v),
e AS (SELECT *, sum(new) OVER (PARTITION BY k, template, diagonal ORDER BY spot ROWS UNBOUNDED PRECEDING) AS stretch FROM d),
s AS (SELECT k, template, label, n, key, diagonal, stretch, min(spot) AS low, max(spot) AS high, bit_or(3::BIGINT << place) AS covered
      FROM e GROUP BY ALL),
f AS (SELECT *, CASE WHEN abs(diagonal - lag(diagonal) OVER w) <= {DRIFT} AND abs(low - lag(high) OVER w) <= {GAP} THEN 0 ELSE 1 END AS new
      FROM s WINDOW w AS (PARTITION BY k, template ORDER BY low, diagonal)),
h AS (SELECT *, sum(new) OVER (PARTITION BY k, template ORDER BY low, diagonal ROWS UNBOUNDED PRECEDING) AS band FROM f),
j AS (SELECT k, template, label, n, key, band, min(low) AS low, max(high) AS high, bit_or(covered) AS covered FROM h GROUP BY ALL),
o AS (SELECT k, label, bit_count(covered)::BIGINT / greatest(n, high - low + {GRAM}) AS coverage FROM j
      WHERE 100 * bit_count(covered)::BIGINT >= {COVERAGE} * n AND covered & key = key AND high - low + {GRAM} < 2 * n),
l AS (SELECT k, max(coverage) AS coverage FROM o GROUP BY k),
a AS (SELECT k, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT k, label FROM b UNION SELECT k, label FROM o) GROUP BY k)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(coverage, 0.0)::DOUBLE END AS score
FROM t LEFT JOIN bb USING (k) LEFT JOIN l USING (k) LEFT JOIN a USING (k)
"""
