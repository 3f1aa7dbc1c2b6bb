"""Quality rules whose limits follow the data: quantile sketches per language and source.

Each feature of a text is a whole number (a share in thousandths, that of symbols in steps of five, or the mean
word length on a scale of sixteenths between powers of two).  The sketch of a group is the number of its texts per
number: it has at most about a thousand entries per feature, merging two is adding them, and its quantiles are
right to the width of a bin.  Sketches are kept per (language, source) and merged into those of the language and
of all.  A limit is an outer quantile of the group, drawn towards that of its language (and this one towards that
of all texts) as if these had added ``WEIGHT`` texts, and widened by ``MARGIN`` bins.  There are no fixed cutoffs.

Only DataFrame functions are used.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tablelift.llm.common import all_columns, free_names, same
from tablelift.session import materialize

MIN_WORDS = 50
#: A group's limits are drawn to those of its language as by so many texts.
WEIGHT = 100
#: Thousandths of a group's texts that may lie beyond its quantile.  Ordinary texts repeat lines and words now and
#: then, so only the far tails of these are cut; most texts of a group have hardly any symbols.
TAILS = {"symbols": 250, "lines": 5, "repeats": 5, "length": 5}
#: Bins between the quantile and the limit, so that very even groups do not reject ordinary texts.
MARGIN = 2
SYMBOL_STEP = 5
FEATURES = tuple(TAILS)
#: Only the word length has a lower limit too: none of the others can be too small.
TWO_SIDED = ("length",)
#: Rows of limits that are broadcast at most; more are joined by a shuffle.
BROADCAST_GROUPS = 100_000

SPACE = r"[\x20\x09-\x0D]+"


def _repeat_words(grams: Column) -> Column:
    """Words covered by windows that occur twice or more, from the windows' hashes in order."""
    def covered(pairs):
        again = F.filter(
            pairs,
            lambda p, i: (F.get(pairs, i - 1)["h"] == p["h"]) | (F.get(pairs, i + 1)["h"] == p["h"]),
        )
        places = F.sort_array(F.transform(again, lambda p: p["i"]))
        start = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("sum"))
        return F.aggregate(
            places, start,
            lambda a, p: F.struct(p.alias("last"), (a["sum"] + F.least(F.lit(3), p - a["last"])).alias("sum")),
        )["sum"]

    pairs = F.sort_array(F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    once = F.transform(F.array(pairs), covered)[0]  # the array of one binds the sorted pairs to a name
    return F.when(F.size(F.array_distinct(grams)) < F.size(grams), once).otherwise(F.lit(0).cast("long"))


def measured(docs: DataFrame, names: dict[str, str]) -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words under ``names``.

    Windows are compared by 64-bit hashes within one text.
    """
    text, words, lines, grams = free_names(docs, "t_", "w_", "l_", "g_")
    rows = docs.withColumn(text, F.coalesce(F.col("text").cast("string"), F.lit("")))
    rows = rows.withColumns(
        {
            words: F.filter(F.split(text, SPACE), lambda w: w != ""),
            lines: F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
        }
    )
    w = F.col(words)
    windows = F.transform(F.slice(w, 1, F.size(w) - 2), lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))
    rows = rows.withColumn(grams, F.when(F.size(w) >= 3, windows).otherwise(F.array().cast("array<bigint>")))
    return rows.withColumns(
        {
            names["n_words"]: F.size(w).cast("long"),
            names["word_chars"]: F.length(F.array_join(w, "")).cast("long"),
            names["n_symbols"]: F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long"),
            names["n_lines"]: F.size(lines).cast("long"),
            names["n_dup_lines"]: (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
            names["n_repeat_words"]: _repeat_words(F.col(grams)),
        }
    ).drop(text, words, lines, grams)


COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def _share(part: str, whole: str) -> Column:
    return F.expr(f"(1000 * {part}) div greatest({whole}, 1)")


def bins(names: dict[str, str]) -> dict[str, Column]:
    """The whole numbers of the features."""
    n = {k: f"`{v}`" for k, v in names.items()}
    tenths = f"greatest((10 * {n['word_chars']}) div greatest({n['n_words']}, 1), 1)"
    power = f"(length(bin({tenths})) - 1)"
    return {
        "symbols": F.expr(f"(1000 * {n['n_symbols']}) div ({SYMBOL_STEP} * greatest({n['word_chars']}, 1))"),
        "lines": _share(n["n_dup_lines"], n["n_lines"]),
        "repeats": _share(n["n_repeat_words"], n["n_words"]),
        "length": F.expr(f"cast(16 * {power} + (16 * {tenths}) div shiftleft(1L, {power}) - 16 as bigint)"),
    }


def base_failed(names: dict[str, str]) -> Column:
    n, r = F.col(names["n_words"]), F.col(names["n_repeat_words"])
    return (n < MIN_WORDS) | (100 * r > 50 * n)


def sketches(rows: DataFrame, names: dict[str, str]) -> DataFrame:
    """lang, source, feature, bin, n: the sketches of all groups, over the rows that pass the base rules."""
    pairs = F.array(*[F.struct(F.lit(k).alias("feature"), v.alias("bin")) for k, v in bins(names).items()])
    return (
        rows.where(~base_failed(names))
        .select("lang", "source", F.explode(pairs).alias("p"))
        .groupBy("lang", "source", F.col("p.feature").alias("feature"), F.col("p.bin").alias("bin"))
        .agg(F.count("*").alias("n"))
    )


def merged(sketch: DataFrame, *keys: str) -> DataFrame:
    """The sum of sketches over all but ``keys``."""
    return sketch.groupBy(*keys, "feature", "bin").agg(F.sum("n").alias("n"))


def quantiles(sketch: DataFrame, *keys: str) -> DataFrame:
    """keys, feature, total, low, high: the bins at which the tail of the feature begins at either end."""
    group = Window.partitionBy(*keys, "feature")
    rows = sketch.select(
        *keys, "feature", "bin", F.sum("n").over(group).alias("total"),
        F.sum("n").over(group.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)).alias("upto"),
    )
    tail = reduce(lambda c, kv: c.when(F.col("feature") == kv[0], kv[1]), TAILS.items(), F.when(F.lit(False), 0))
    return rows.groupBy(*keys, "feature").agg(
        F.max("total").alias("total"),
        F.min(F.when(1000 * F.col("upto") >= tail * F.col("total"), F.col("bin"))).alias("low"),
        F.min(F.when(1000 * F.col("upto") >= (1000 - tail) * F.col("total"), F.col("bin"))).alias("high"),
    )


def limits(sketch: DataFrame, weight: int = WEIGHT) -> DataFrame:
    """lang, source and ``<feature>_low``, ``<feature>_high`` for every group."""
    def named(df, suffix, *keys):
        return df.select(
            *[F.col(k).alias(f"{k}{suffix}") for k in keys], F.col("feature").alias(f"feature{suffix}"),
            *[F.col(c).alias(f"{c}{suffix}") for c in ("total", "low", "high")],
        )

    own = quantiles(sketch, "lang", "source")
    lang = named(quantiles(merged(sketch, "lang"), "lang"), "_l", "lang")
    everyone = named(quantiles(merged(sketch)), "_a")
    rows = own.join(lang, same(F.col("lang"), F.col("lang_l")) & (F.col("feature") == F.col("feature_l")))
    rows = rows.join(everyone, F.col("feature") == F.col("feature_a"))

    def drawn(end):
        of_lang = f"((total_l * {end}_l + {weight} * {end}_a) div (total_l + {weight}))"
        return F.expr(f"(total * {end} + {weight} * {of_lang}) div (total + {weight})")

    high, low = drawn("high") + MARGIN, drawn("low") - MARGIN
    return rows.groupBy("lang", "source").agg(
        *[F.max(F.when(F.col("feature") == f, high)).alias(f"{f}_high") for f in FEATURES],
        *[F.max(F.when(F.col("feature") == f, low)).alias(f"{f}_low") for f in TWO_SIDED],
    )


def judged(rows: DataFrame, names: dict[str, str], sketch: DataFrame, failed: str, kept: str, weight: int = WEIGHT) -> DataFrame:
    """``rows`` (with the counts under ``names``) with the columns ``failed`` and ``kept``."""
    found = materialize(limits(sketch, weight), "limits")
    columns = [c for c in found.columns]
    new = free_names(rows, *[f"limit_{c}" for c in columns])
    at = dict(zip(columns, new))
    table = found.select(*[F.col(c).alias(at[c]) for c in columns])
    if found.count() <= BROADCAST_GROUPS:
        table = F.broadcast(table)
    joined = rows.join(table, same(F.col("lang"), F.col(at["lang"])) & same(F.col("source"), F.col(at["source"])), "left")
    value = bins(names)
    inside = [value[f] <= F.col(at[f"{f}_high"]) for f in FEATURES] + [value[f] >= F.col(at[f"{f}_low"]) for f in TWO_SIDED]
    return joined.withColumn(failed, base_failed(names)).withColumn(
        kept, ~F.col(failed) & reduce(lambda a, b: a & b, inside)
    ).withColumn(kept, F.coalesce(F.col(kept), F.lit(False))).drop(*new)


def rules(docs: DataFrame, weight: int = WEIGHT) -> DataFrame:
    """doc_id, the counts, base_failed and kept of every row of ``docs``.

    Null and empty texts have no words and fail the base rules.  Null languages and sources are groups of
    their own.  Repeated rows get a row each and count each; a null ``doc_id`` is carried along; an empty
    table gives no rows; other columns are not read.
    """
    names = {c: c for c in COUNTS}
    rows = materialize(measured(docs.select("doc_id", "lang", "source", "text"), names).drop("text"), "quality")
    out = judged(rows, names, sketches(rows, names), "base_failed", "kept", weight)
    return out.select("doc_id", *[c for c in COUNTS if c != "n_lines"], "base_failed", "kept")


def keep_good(docs: DataFrame, weight: int = WEIGHT) -> DataFrame:
    """The rows of ``docs`` that ``rules`` keeps, with all their columns, whatever these are called."""
    names = dict(zip(COUNTS, free_names(docs, *COUNTS)))
    failed, kept = free_names(docs, "base_failed", "kept")
    few = docs.select("lang", "source", "text")
    own = {c: c for c in COUNTS}
    # Counts are written first: a filter on them would be pushed down and count anew for every word.
    sketch = materialize(sketches(materialize(measured(few, own).drop("text"), "quality"), own), "sketches")
    return judged(measured(docs, names), names, sketch, failed, kept, weight).where(F.col(kept)).select(*all_columns(docs))


ORACLE = rf"""
WITH t AS (SELECT row_number() OVER () AS k, doc_id, lang, source, coalesce(text, '') AS text FROM documents),
w AS (
    SELECT k, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
           list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
    FROM t),
g AS (
    SELECT k, unnest(range(1, len(w) - 1)) AS i, w[unnest(range(1, len(w) - 1))] || ' ' || w[unnest(range(1, len(w) - 1)) + 1]
           || ' ' || w[unnest(range(1, len(w) - 1)) + 2] AS g
    FROM w WHERE len(w) >= 3),
r AS (SELECT k, i FROM g QUALIFY count(*) OVER (PARTITION BY k, g) > 1),
c AS (SELECT k, count(DISTINCT p) AS n_repeat_words FROM (SELECT k, unnest([i, i + 1, i + 2]) AS p FROM r) GROUP BY k),
m AS (
    SELECT t.k, doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
           CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(l) AS BIGINT) AS n_lines,
           CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
    FROM t JOIN w USING (k) LEFT JOIN c USING (k)),
x AS (SELECT *, greatest((10 * word_chars) // greatest(n_words, 1), 1) AS tenths,
             n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
b AS (
    SELECT *, (1000 * n_symbols) // ({SYMBOL_STEP} * greatest(word_chars, 1)) AS symbols, (1000 * n_dup_lines) // greatest(n_lines, 1) AS lines,
           (1000 * n_repeat_words) // greatest(n_words, 1) AS repeats,
           16 * (length(bin(tenths)) - 1) + (16 * tenths) // (1::BIGINT << (length(bin(tenths)) - 1)::INTEGER) - 16 AS length
    FROM x),
u AS (
    SELECT lang, source, 'symbols' AS feature, symbols AS bin FROM b WHERE NOT base_failed
    UNION ALL SELECT lang, source, 'lines', lines FROM b WHERE NOT base_failed
    UNION ALL SELECT lang, source, 'repeats', repeats FROM b WHERE NOT base_failed
    UNION ALL SELECT lang, source, 'length', length FROM b WHERE NOT base_failed),
q AS (
    SELECT 1 AS level, lang, source, feature, count(*) AS total, list_sort(list(bin)) AS s FROM u GROUP BY ALL
    UNION ALL SELECT 2, lang, NULL, feature, count(*), list_sort(list(bin)) FROM u GROUP BY lang, feature
    UNION ALL SELECT 3, NULL, NULL, feature, count(*), list_sort(list(bin)) FROM u GROUP BY feature),
a AS (SELECT *, CASE feature {' '.join(f"WHEN '{k}' THEN {v}" for k, v in TAILS.items())} END AS tail FROM q),
z AS (SELECT level, lang, source, feature, total, s[greatest((tail * total + 999) // 1000, 1)] AS low,
             s[((1000 - tail) * total + 999) // 1000] AS high FROM a),
y AS (
    SELECT g.lang, g.source, g.feature,
           (g.total * g.low + {WEIGHT} * ((l.total * l.low + {WEIGHT} * e.low) // (l.total + {WEIGHT}))) // (g.total + {WEIGHT}) - {MARGIN} AS low,
           (g.total * g.high + {WEIGHT} * ((l.total * l.high + {WEIGHT} * e.high) // (l.total + {WEIGHT}))) // (g.total + {WEIGHT}) + {MARGIN} AS high
    FROM z g JOIN z l ON l.level = 2 AND l.feature = g.feature AND l.lang IS NOT DISTINCT FROM g.lang
    JOIN z e ON e.level = 3 AND e.feature = g.feature WHERE g.level = 1),
h AS (
    SELECT lang, source, {', '.join(f"max(CASE WHEN feature = '{f}' THEN high END) AS {f}_high" for f in FEATURES)},
           max(CASE WHEN feature = 'length' THEN low END) AS length_low
    FROM y GROUP BY lang, source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       coalesce(NOT base_failed AND {' AND '.join(f'b.{f} <= {f}_high' for f in FEATURES)} AND b.length >= length_low, false) AS kept
FROM b LEFT JOIN h ON b.lang IS NOT DISTINCT FROM h.lang AND b.source IS NOT DISTINCT FROM h.source
"""
