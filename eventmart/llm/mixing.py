"""Mixing to target weights with soft domain membership.

A classifier trained on the labelled table gives every document its probabilities over the domains. Nonnegative document
rates are then fitted by projected gradient so that the expected tokens of each domain meet their targets.
"""

from __future__ import annotations

import logging

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType

from eventmart.llm.common import WordHash
from eventmart.llm.linear import Softmax, train

log = logging.getLogger(__name__)

FEATURES = 1 << 16  # hashed words
PER_DOMAIN = 1_500  # labelled texts of each domain that the classifier is fitted on
GRID = 1024  # documents whose memberships agree to one part in so many share a rate: at most (GRID + 1) * (GRID + 2) / 2 rates
TOLERANCE = 1e-3  # the fit ends when each domain is within this share of the whole target
SMALL = 1e-4  # or when the projected gradient would change a token's rate by less than this on average
MAX_RATE = 2.0  # no document is wanted more often than this: without a bound, targets out of reach go to a few texts in very many copies
SHARE_OFF = 0.01  # a share that is further off its weight is warned of
DOMAINS = ("fine", "poor", "toxic")
#: Target shares of expected tokens. A domain of weight 0 is to vanish.
WEIGHTS = {"fine": 0.97, "poor": 0.03, "toxic": 0.0}
MAX_REPEAT = 1.2  # no domain is asked for more than this multiple of its own tokens
HEADROOM = 1.1  # target total at most, as a multiple of the tokens that the wanted domains have


def domain(quality: Column, toxic: Column) -> Column:
    """toxic comes first; a row without labels belongs to no domain."""
    return F.when(toxic == 1, "toxic").when(quality == 1, "fine").when(quality == 0, "poor")


def features(text: str, words: WordHash) -> np.ndarray:
    """Distinct hashed words, and some marks of how the text is built: symbols, repetition, length."""
    found = [w.strip(b".,!?;:").lower() for w in text.encode().split()]
    n = max(len(found), 1)
    marks = [
        ("symbols", sum(map(text.count, "#*$%&|<>")) * 20 // max(len(text), 1)), ("distinct", len(set(found)) * 10 // n),
        ("repeats", sum(a == b for a, b in zip(found, found[1:])) * 10 // n), ("long", int(np.log2(n))),
    ]
    names = [*set(found), *(f"\x00{k}={min(v, 20)}".encode() for k, v in marks)]
    return np.unique((words.of(names) % np.uint64(FEATURES)).astype(np.int32))


def fit(docs: DataFrame, labels: DataFrame, per_domain: int = PER_DOMAIN) -> Softmax | None:
    """The domain classifier from ``docs`` (doc_id, text) and ``labels`` (doc_id, quality, toxic); none where no text is labelled.

    A sample of ``per_domain`` texts of each domain (in expectation) bounds what the driver holds; an id that is labelled
    twice takes its largest labels.
    """
    known = labels.where("doc_id is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    known = known.select("doc_id", domain(F.col("quality"), F.col("toxic")).alias("domain")).where("domain is not null")
    sizes = {r["domain"]: r["n"] for r in known.groupBy("domain").agg(F.count("*").alias("n")).collect()}  # one row per domain
    if not sizes:
        return None
    share = F.element_at(F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, min(1.0, per_domain / n))]), F.col("domain"))
    picked = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < share * 1_000_000)
    words = WordHash()

    @F.arrow_udf(ArrayType(IntegerType()))
    def row_of(texts: pa.Array) -> pa.Array:
        return pa.array([features(t, words) for t in texts.to_pylist()], pa.list_(pa.int32()))

    # the picked ids are a bounded sample, so they go to the texts and not the texts to them
    texts = docs.where("text is not null").select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    found = sorted(texts.select("doc_id", "domain", row_of("text").alias("at")).toArrow().to_pylist(), key=lambda r: (r["doc_id"], r["domain"], r["at"]))
    if not found:
        return None
    rows = [(np.array(r["at"], np.int64), np.ones(len(r["at"]))) for r in found]
    return train(rows, [DOMAINS.index(r["domain"]) for r in found], [*DOMAINS], FEATURES, epochs=6, rate=1.0, l1=9.0, l2=0.01)


def memberships(text: Column, model: Softmax | None, df: DataFrame) -> Column:
    """Probabilities over DOMAINS; without a model, or without a word, all of it lies on the first."""
    held = df.sparkSession.sparkContext.broadcast(model and model.parts())
    words = WordHash()

    @F.arrow_udf(ArrayType(DoubleType()))
    def of(texts: pa.Array) -> pa.Array:
        model, out = Softmax(*held.value) if held.value else None, []
        for text in texts.to_pylist():
            if model is None or not text.strip():
                out.append([1.0] + [0.0] * (len(DOMAINS) - 1))
            else:
                at = features(text, words)
                out.append(model.chances((at, np.ones(len(at)))))
        return pa.array(out, pa.list_(pa.float64()))

    return of(F.coalesce(text, F.lit("")))


def n_tokens(text: Column) -> Column:
    """Words, as a stand-in for tokens."""
    return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), r"[ \t\n\x0B\f\r]+"), lambda w: w != "")).cast("bigint")


def cell_of(p: Column) -> Column:
    """The number of the grid cell that the memberships lie in, all but the first domain's rounded."""
    return sum((F.round(F.get(p, F.lit(k)) * GRID).cast("int") * (GRID + 1) ** (k - 1) for k in range(1, len(DOMAINS))), F.lit(0))


def fit_rates(soft: DataFrame, area, weights: dict[str, float] | None = None, headroom: float = HEADROOM) -> tuple[DataFrame, dict]:
    """(cell, rate) for ``soft`` (n_tokens, p), and what the rates reach.

    Least squares over the domains by accelerated projected gradient: expected tokens sum(rate x n_tokens x p) against targets, in the
    metric of the memberships' spread, with rates from 0 to MAX_RATE. A gradient is scaled by length, so that equal memberships get equal
    rates; documents of one cell of a fine grid share theirs. A cell keeps the exact sum of its documents' tokens by domain, so the totals
    are exact too. Spark adds up the cells; as their number has a bound that no input changes, the steps over them, some hundreds, are
    taken on the driver.

    Where the heaviest domain that has tokens is too scarce for its target, the whole mix gets smaller, so that the weights hold. A
    lighter domain that is short gets what MAX_REPEAT allows; no other one makes up for it. Targets that no rates within their bounds
    meet are met as closely as these allow. The outcome tells.
    """
    weights = weights or WEIGHTS
    w = np.array([weights[k] for k in DOMAINS], float) / sum(weights.values())
    k_all = range(len(DOMAINS))
    part = [F.sum(F.col("n_tokens") * F.coalesce(F.get("p", F.lit(k)), F.lit(0.0))).alias(f"s{k}") for k in k_all]
    cells = soft.where("n_tokens > 0").groupBy(cell_of(F.col("p")).alias("cell")).agg(F.sum("n_tokens").alias("weight"), *part)
    held = cells.toArrow().sort_by("cell")
    weight = held["weight"].to_numpy().astype(float)
    sums = np.array([held[f"s{k}"].to_numpy() for k in k_all]).reshape(len(DOMAINS), -1).T
    supply = sums.sum(axis=0)
    rate, expected, target = np.ones(len(weight)), supply, supply
    if supply.sum():
        total = headroom * sum(supply[k] for k in k_all if w[k] > 0)
        heaviest = int(np.argmax(np.where(supply > 0, w, -1.0)))
        if w[heaviest] > 0:
            total = min(total, MAX_REPEAT * supply[heaviest] / w[heaviest])
        target = np.minimum(w * total, MAX_REPEAT * supply)
        rate, expected = _descend(weight, sums, target, TOLERANCE * total)
    found = soft.sparkSession.createDataFrame(pa.table({"cell": held["cell"], "rate": rate}))
    return area.table(found, "mixing_rates"), {"weights": w, "supply": supply, "expected": expected, "target": target}


def _descend(weight: np.ndarray, sums: np.ndarray, target: np.ndarray, near: float) -> tuple[np.ndarray, np.ndarray]:
    """The rates of cells, and the tokens by domain that they reach, from all rates at 1 until every domain is ``near`` its target.

    A step goes ahead by the momentum, takes off the product with the cell's mean memberships, and never leaves the bounds. Momentum
    starts again where it points uphill.
    """
    mean = sums / weight[:, None]
    # the metric in which all directions are equally steep, so that the step is 1
    spread = mean.T @ sums
    metric = np.linalg.inv(spread + 1e-6 * np.trace(spread) * np.eye(len(DOMAINS)))
    rate = last = np.ones(len(weight))
    now = before = sums.sum(axis=0)
    run, move = 1, 1.0
    while np.abs(now - target).max() > near and move > SMALL:
        momentum = (run - 1) / (run + 2)
        ahead = rate + momentum * (rate - last)
        last, rate = rate, np.clip(ahead - mean @ (metric @ (now + momentum * (now - before) - target)), 0.0, MAX_RATE)
        before, now = now, rate @ sums
        down = ahead - rate
        move = np.sqrt((weight * down * down).sum() / weight.sum())
        run = 1 if (weight * down * (rate - last)).sum() > 0 else run + 1
    return rate, now


def with_rate(df: DataFrame, rates: DataFrame) -> DataFrame:
    """``df`` (p, ...) with the rate of its cell. The table is broadcast: GRID bounds its rows. A cell without tokens has rate 1."""
    found = df.withColumn("cell", cell_of(F.col("p"))).join(F.broadcast(rates), "cell", "left")
    return found.withColumn("rate", F.coalesce("rate", F.lit(1.0))).drop("cell")


def copies(rate: Column, key: Column) -> Column:
    """Whole copies: the rate rounded down, and one more where the key's hash falls into the rest."""
    chance = F.pmod(F.xxhash64(F.lit("mixing"), key), F.lit(1 << 20)) / float(1 << 20)
    return (F.floor(rate) + F.when(chance < rate - F.floor(rate), 1).otherwise(0)).cast("bigint")


def mix(docs: DataFrame, labels: DataFrame, area, weights: dict[str, float] | None = None) -> DataFrame:
    """Tokens, memberships, rate and copies of every row of ``docs`` (doc_id, text).

    A null or empty text has no tokens and counts as of the first domain. Repeated rows get equal results. Without labelled texts all lie in the
    first domain. Empty tables give an empty result. The metadata of ``rate`` tell for each domain its weight, the tokens that it
    has, those asked for and those expected at the rates.
    """
    soft, _, rates, reached = _solve(docs, labels, area, weights)
    found = with_rate(soft, rates).withMetadata("rate", {"domains": [*DOMAINS], **{k: [float(x) for x in v] for k, v in reached.items()}})
    return found.select("doc_id", "n_tokens", *[F.get("p", F.lit(k)).alias(f"p_{d}") for k, d in enumerate(DOMAINS)], "rate",
                        copies(F.col("rate"), F.col("doc_id")).alias("copies"))


def _solve(docs: DataFrame, labels: DataFrame, area, weights):
    model = fit(docs, labels)
    soft = area.table(docs.select("doc_id", n_tokens(F.col("text")).alias("n_tokens"), memberships(F.col("text"), model, docs).alias("p")), "mixing_soft")
    rates, reached = fit_rates(soft, area, weights)
    shares = reached["expected"] / max(reached["expected"].sum(), 1e-9)
    if np.abs(shares - reached["weights"]).max() > SHARE_OFF and reached["supply"].sum():
        log.warning("shares %s of %s are off their weights %s", shares.round(4).tolist(), [*DOMAINS], reached["weights"].round(4).tolist())
    return soft, model, rates, reached


def mixed(docs: DataFrame, labels: DataFrame, area, weights: dict[str, float] | None = None) -> DataFrame:
    """The rows of ``docs`` in their copies: none, one or more. Memberships are computed again, so texts are not shuffled."""
    _, model, rates, _ = _solve(docs, labels, area, weights)
    packed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), memberships(docs["text"], model, docs).alias("p"))
    n = copies(F.col("rate"), F.col("row.doc_id"))
    times = F.explode(F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<bigint>")))
    return with_rate(packed, rates).select("row", times.alias("n")).select("row.*")
