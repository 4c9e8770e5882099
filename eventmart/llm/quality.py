"""Quality rules with adaptive thresholds.

Each text gets a few whole-number measures. Per language and source, mergeable quantile sketches of these measures give
the thresholds, which are joined back to the texts. A sketch is a histogram over values kept to their leading
SKETCH_BITS bits: sketches merge by adding counts, and the outcome does not depend on how rows are dealt out.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

SYMBOLS = "#*$%&|<>"
SPACES = "\x20\t\n\x0b\x0c\r"
WINDOW = 8  # words
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

SKETCH_BITS = 7  # a value is off by less than 1 part in 64
PRIOR = 30  # a group's quantiles are drawn towards those of its language, and these towards the corpus's, with the weight of so many rows
FENCE = 3.0  # thresholds lie so many quartile ranges beyond the quartiles
LOW_FENCE = 11  # the same distance for a normal distribution, from the first quartile in ranges between it and the first octile
# rates per thousand, with the least distance of the threshold from the quartile
RATES = {"symbol_rate": 60, "dup_line_rate": 300, "repeat_rate": 150, "word_length": 300}

QUANTILES = {"e1": 1, "q1": 2, "q2": 4, "q3": 6}  # in eighths

_TYPE = StructType([StructField(c, LongType()) for c in (*BASE, "n_lines")])


def measure(text: str) -> tuple[int, ...]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, and the lines that hold a word."""
    words = text.encode().split()
    n = len(words)
    chars = len(text) - sum(map(text.count, SPACES))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [x for x in text.split("\n") if x.strip(SPACES)] if n else []
    repeats = 0
    if n > WINDOW:
        number: dict[bytes, int] = {}
        ids = np.array([number.setdefault(w, len(number)) for w in words], np.uint64)
        if len(number) < n:
            # windows are equal if and only if their numbers are: each pass names pairs of equal halves
            names, span = ids, 1
            while span < WINDOW:
                pairs = names[:-span] * np.uint64(n + 1) + names[span:]
                names = np.unique(pairs, return_inverse=True)[1].astype(np.uint64)
                span *= 2
            counts = np.bincount(names.astype(np.int64))
            found = np.flatnonzero(counts[names.astype(np.int64)] > 1)
            if len(found):
                edges = np.zeros(n + 1, np.int64)
                np.add.at(edges, found, 1)
                np.add.at(edges, found + WINDOW, -1)
                repeats = int(np.count_nonzero(np.cumsum(edges)))
    return n, chars, symbols, len(lines) - len(set(lines)), repeats, len(lines)


@F.arrow_udf(_TYPE)
def _measures(texts: pa.Array) -> pa.Array:
    rows = [measure(t or "") for t in texts.to_pylist()]
    columns = np.array(rows, np.int64).reshape(len(rows), len(BASE) + 1).T
    return pa.StructArray.from_arrays([pa.array(c) for c in columns], [*BASE, "n_lines"])


def measures(text: Column) -> Column:
    """The measures of a text as a struct; null counts as empty."""
    return _measures(F.coalesce(text, F.lit("")))


def base_failed(m: Column) -> Column:
    return (m["n_words"] < 20) | (100 * m["n_repeat_words"] > 30 * m["n_words"])


def rates(m: Column) -> dict[str, Column]:
    """Whole numbers, so that every engine agrees on them; 0 where there is nothing to divide by."""
    def share(part: str, whole: str, per: int = 1000) -> Column:
        return F.when(m[whole] > 0, F.call_function("div", per * m[part], m[whole])).otherwise(0).cast("bigint")

    return {
        "symbol_rate": share("n_symbols", "word_chars"), "dup_line_rate": share("n_dup_lines", "n_lines"),
        "repeat_rate": share("n_repeat_words", "n_words"),
        "word_length": share("word_chars", "n_words", 100),
    }


def _bin(value: Column) -> Column:
    """The value with all but its leading bits set to zero."""
    cut = F.greatest(F.length(F.bin(value)) - SKETCH_BITS, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, cut), cut)


def sketches(docs: DataFrame) -> DataFrame:
    """(lang, source, rate, value, n) of ``docs`` (lang, source, m): one row per bin, counted before the shuffle.

    Texts that fail the base rules tell nothing of what is usual and are left out.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(k).alias("rate"), v.alias("value")) for k, v in rates(F.col("m")).items()]))
    found = docs.where(~base_failed(F.col("m"))).select("lang", "source", pairs.alias("x"))
    return found.groupBy("lang", "source", F.col("x.rate").alias("rate"), _bin(F.col("x.value")).alias("value")).agg(F.count("*").alias("n"))


def _quartiles(bins: DataFrame, *group: str) -> DataFrame:
    """n, first octile e1 and quartiles q1, q2 and q3 of each group and rate from merged sketches."""
    merged = bins.groupBy(*group, "rate", "value").agg(F.sum("n").alias("n"))
    within = Window.partitionBy(*group, "rate")
    placed = merged.withColumn("upto", F.sum("n").over(within.orderBy("value"))).withColumn("all", F.sum("n").over(within))
    at = lambda q: F.min(F.when(F.col("upto") * 8 >= F.col("all") * q, F.col("value")))
    return placed.groupBy(*group, "rate").agg(F.max("all").alias("n"), *[at(k).alias(q) for q, k in QUANTILES.items()])


def thresholds(bins: DataFrame) -> DataFrame:
    """One row per language and source: the bounds of every rate.

    ``bins`` has a bounded number of rows per group (some 500 for each rate), whatever the number of texts. A group's quantiles are
    its own and those of its language, weighted by its rows and PRIOR, so that a few rows decide little and many nearly all.

    Bad texts must not move the bounds. Those of shares are told from the lower quarter of a group's texts alone, so that three
    fifths may be bad. Word lengths may be bad on either side: their fence is as wide as the narrower half of the quartile range
    tells, and a quartile counts up to a bounded distance from the median, so that nearly half may be bad.
    """
    groups = bins.select("lang", "source").distinct()
    rate = F.explode(F.array(*map(F.lit, RATES))).alias("rate")
    own, lang, all_ = _quartiles(bins, "lang", "source"), _quartiles(bins, "lang"), _quartiles(bins)
    same = lambda a, b, *keys: reduce(lambda x, y: x & y, [a[k].eqNullSafe(b[k]) for k in keys])
    g = groups.select("lang", "source", rate).alias("g")
    o, lg, al = own.alias("o"), lang.alias("l"), all_.alias("a")
    col = lambda t: {k: F.col(f"{t}.{k}") for k in ("lang", "source", "rate")}
    joined = g.join(o, same(col("g"), col("o"), "lang", "source", "rate"), "left").join(
        lg, same(col("g"), col("l"), "lang", "rate"), "left").join(al, same(col("g"), col("a"), "rate"), "left")
    drawn = lambda t, q, to: F.call_function("div", F.col(f"{t}.n") * F.col(f"{t}.{q}") + PRIOR * to, F.col(f"{t}.n") + PRIOR)
    pick = lambda q: drawn("o", q, drawn("l", q, F.col(f"a.{q}")))
    slack = F.element_at(F.create_map(*[F.lit(x) for pair in RATES.items() for x in pair]), F.col("rate"))
    picked = joined.select("g.lang", "g.source", "g.rate", *[pick(q).alias(q) for q in QUANTILES])
    e1, q1, q2, q3 = map(F.col, QUANTILES)
    far = lambda width: F.greatest((FENCE * width).cast("bigint"), slack.cast("bigint"))
    spread = far(2 * F.least(q3 - q2, q2 - q1))
    low = F.greatest(q1, q2 - far(q3 - q2)) - spread
    high = F.when(F.col("rate") == "word_length", F.least(q3, q2 + far(q2 - q1)) + spread).otherwise(q1 + F.greatest(LOW_FENCE * (q1 - e1), slack.cast("bigint")))
    bounds = picked.select("lang", "source", "rate", F.struct(low.alias("low"), high.alias("high")).alias("b"))
    found = bounds.groupBy("lang", "source").agg(*[F.first(F.when(F.col("rate") == k, F.col("b")), ignorenulls=True).alias(k) for k in RATES])
    return found.select(F.col("lang").alias("t_lang"), F.col("source").alias("t_source"), F.struct(*RATES).alias("bounds"))


def judge(docs: DataFrame, limits: DataFrame) -> DataFrame:
    """``docs`` (lang, source, m, ...) with ``base_failed`` and ``kept``.

    Rates above their upper bound reject a text, a word length below its lower bound too. A group without thresholds
    (all its texts failed the base rules) has nothing to keep.
    """
    joined = docs.join(limits, docs["lang"].eqNullSafe(limits["t_lang"]) & docs["source"].eqNullSafe(limits["t_source"]), "left")
    found = rates(F.col("m"))
    inside = reduce(lambda a, b: a & b, [found[k] <= F.col(f"bounds.{k}.high") for k in RATES]) & (found["word_length"] >= F.col("bounds.word_length.low"))
    failed = base_failed(F.col("m"))
    return joined.withColumn("base_failed", failed).withColumn("kept", ~failed & F.coalesce(inside, F.lit(False))).drop("t_lang", "t_source", "bounds")


def quality(docs: DataFrame, area) -> DataFrame:
    """Measures and verdict of each row (doc_id, text, lang, source).

    A null or empty text has no words and fails. A null language or source is a group of its own. Rows that repeat are
    judged each. Columns that do not concern the rules are not read.
    """
    measured = area.table(docs.select("doc_id", "lang", "source", measures(F.col("text")).alias("m")), "quality_measures")
    limits = area.table(thresholds(sketches(measured)), "quality_limits")
    return judge(measured, limits).select("doc_id", *[F.col(f"m.{c}").alias(c) for c in BASE], "base_failed", "kept")


def keep_good(docs: DataFrame, area) -> DataFrame:
    """The rows of ``docs`` that pass, with their columns. Texts are measured twice, which is cheaper than to shuffle them."""
    m = measures(docs["text"])
    limits = area.table(thresholds(sketches(docs.select("lang", "source", m.alias("m")))), "quality_limits")
    packed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs["lang"].alias("lang"), docs["source"].alias("source"), m.alias("m"))
    return judge(packed, limits).where("kept").select("row.*")
