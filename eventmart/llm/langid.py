"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Document frequencies are counted over all training texts. The classifier is fitted on a sample of PER_LANGUAGE texts of
each language (in expectation), which bounds what the driver holds; every text is then scored where it lies.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType, IntegerType, StringType, StructField, StructType

from eventmart.llm.linear import Softmax, train

FEATURES = 1 << 15  # hashed n-grams
ORDERS = (1, 2, 3)
FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)  # odd, with mixed bits
SHIFT = np.uint32(32 - 15)
PER_LANGUAGE = 400  # texts of each language that the classifier is fitted on
UNKNOWN = "und"


def grams(text: str) -> np.ndarray:
    """Hashed character n-grams of the lower-cased text; whatever is ASCII and no letter counts as a space."""
    points = np.frombuffer(f" {text} ".lower().encode("utf-32-le"), np.uint32)
    spaces = (points < 97) | ((points > 122) & (points < 128))
    kept = ~spaces
    kept[1:] |= ~spaces[:-1]
    kept[0] = True  # one space between words
    points = np.where(spaces, np.uint32(32), points)[kept]
    out, held = [], np.uint32(0)
    for n, factor in zip(range(1, max(ORDERS) + 1), FACTORS):
        if len(points) < n:
            break
        held = (held if n == 1 else held[:-1]) + points[n - 1 :] * factor
        if n in ORDERS:
            out.append((held + np.uint32(int(factor) * n & 0xFFFFFFFF)) >> SHIFT)
    return np.concatenate(out)


def counts(text: str) -> np.ndarray:
    return np.bincount(grams(text), minlength=FEATURES)


def tf_idf(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    c = counts(text)
    at = np.flatnonzero(c)
    x = (1.0 + np.log(c[at])) * idf[at]
    norm = np.sqrt(x @ x)
    return at, x / norm if norm > 0 else x


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def inverse_frequencies(texts: DataFrame) -> np.ndarray:
    """Smoothed inverse document frequency of each feature over all ``texts`` (text).

    A partition adds up its own counts, so the shuffle gets at most FEATURES rows from each.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, n = np.zeros(FEATURES, np.int64), 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                found += counts(text) > 0
                n += 1
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array([*at, -1], pa.int32()), pa.array([*found[at], n], pa.int64())], ["feature", "n"])

    rows = texts.select("text").mapInArrow(count, "feature int, n bigint").groupBy("feature").agg(F.sum("n").alias("n")).toArrow()
    at, n = rows["feature"].to_numpy(), rows["n"].to_numpy()
    total = int(n[at == -1].sum())
    df = np.zeros(FEATURES)
    df[at[at >= 0]] = n[at >= 0]
    return np.log((1.0 + total) / (1.0 + df)) + 1.0


def fit(training: DataFrame, per_language: int = PER_LANGUAGE) -> tuple[Softmax | None, np.ndarray]:
    """The model from ``training`` (doc_id, text, lang), and the frequencies it goes with; no model where there are no rows."""
    usable = training.where("text is not null and lang is not null")
    sizes = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # a row per language
    idf = inverse_frequencies(usable)
    if not sizes:
        return None, idf
    share = F.element_at(F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, min(1.0, per_language / n))]), F.col("lang"))
    picked = usable.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < share * 1_000_000)

    @F.arrow_udf(StructType([StructField("at", ArrayType(IntegerType())), StructField("x", ArrayType(FloatType()))]))
    def row_of(texts: pa.Array) -> pa.Array:
        rows = [tf_idf(t, idf) for t in texts.to_pylist()]
        return pa.StructArray.from_arrays([pa.array([r[0] for r in rows], pa.list_(pa.int32())), pa.array([r[1] for r in rows], pa.list_(pa.float32()))], ["at", "x"])

    found = sorted(picked.select("doc_id", "lang", row_of("text").alias("r")).toArrow().to_pylist(), key=lambda r: (r["doc_id"] is None, r["doc_id"], r["lang"], r["r"]["at"]))
    labels = sorted(sizes)
    rows = [(np.array(r["r"]["at"], np.int64), np.array(r["r"]["x"], float)) for r in found]
    return train(rows, [labels.index(r["lang"]) for r in found], labels, FEATURES, rate=1.0, l1=0.005, l2=0.001), idf


def predicted(text: Column, model: Softmax | None, idf: np.ndarray, df: DataFrame) -> Column:
    """(lang, score) of each text: the likeliest language and its calibrated probability; UNKNOWN and 0 without a letter."""
    held = df.sparkSession.sparkContext.broadcast((model and model.parts(), idf))
    kind = StructType([StructField("lang", StringType()), StructField("score", DoubleType())])

    @F.arrow_udf(kind)
    def predict(texts: pa.Array) -> pa.Array:
        parts, idf = held.value
        model = Softmax(*parts) if parts else None
        langs, scores = [], []
        for text in texts.to_pylist():
            lang, score = UNKNOWN, 0.0
            if model is not None and text and has_letter(text):
                p = model.chances(tf_idf(text, idf))
                lang, score = model.labels[int(p.argmax())], float(min(1.0, p.max()))
            langs.append(lang)
            scores.append(score)
        return pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["lang", "score"])

    return predict(F.coalesce(text, F.lit("")))


def identify(docs: DataFrame) -> DataFrame:
    """Language of every row of ``docs`` (doc_id, text, lang), learned from those that are not held out.

    Null or letterless text: UNKNOWN with score 0. A null lang is never learned from; a row without doc_id neither, and it is not
    held out. With no training row every text is UNKNOWN. Repeated rows get equal results.
    """
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    base = docs.select("doc_id", "text", "lang", F.coalesce(fold == 2, F.lit(False)).alias("held_out"))
    model, idf = fit(base.where("not held_out and doc_id is not null"))
    found = base.select("doc_id", "held_out", predicted(F.col("text"), model, idf, docs).alias("p"))
    return found.select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"))
