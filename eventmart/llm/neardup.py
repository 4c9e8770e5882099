"""Near-duplicate groups by HyperMinHash.

Every distinct shingle set gets REGISTERS registers. A register is the least hash of the set under its own hash function,
kept as the count of its leading zeros and the MANTISSA bits that follow. Bands of registers are the candidate keys; a
candidate pair is estimated from its registers, corrected for chance collisions, and what may reach the threshold is
verified on the full sets. Groups are the components of the verified links.

Copies never meet in pairs: rows with equal shingle sets are one class from the start. Within a band's bucket, classes are
first held against the leading class of the bucket; only classes that are still in different groups afterwards are paired,
and of those only pairs that share one of their rarest shingles, which every link does.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.llm.common import M1, WordHash, mix, sift, split_words, windows_of
from eventmart.session import staging

SHINGLE = 5  # words
PERCENT = 75  # linked from this Jaccard similarity on
BANDS, ROWS = 48, 5  # a pair at the threshold is missed by all bands with a chance of 2 in a million
REGISTERS = BANDS * ROWS
MANTISSA = 10  # bits kept after the leading zeros, so a register takes 16 bits
#: Pairs are verified if the estimate is no more than this many standard deviations below the threshold.
DEVIATIONS = 5.0
LEADER_ROUNDS = 2

_SEEDS = mix(np.arange(1, REGISTERS + 1, dtype=np.uint64) * M1) | np.uint64(1)


def shingles(text: str | None, words: WordHash) -> np.ndarray:
    """The sorted distinct hashes of the shingles of a text."""
    return np.unique(windows_of(words.of(split_words(text or "", lower=True)), SHINGLE))


def registers(hashes: np.ndarray) -> np.ndarray:
    """Leading zeros and mantissa of the least value under each hash function, as 16-bit numbers."""
    least = np.empty(REGISTERS, np.uint64)
    step = max(1, (1 << 16) // max(len(hashes), 1))
    for k in range(0, REGISTERS, step):
        x = hashes[None, :] * _SEEDS[k : k + step, None]
        x ^= x >> np.uint64(32)
        x *= M1
        least[k : k + step] = x.min(axis=1)
    zeros = 63 - np.floor(np.log2(np.maximum(least >> np.uint64(11), 1).astype(float))).astype(np.int64) - 11
    zeros = np.minimum(zeros, 52)
    rest = (least << (zeros + 1).astype(np.uint64)) >> np.uint64(64 - MANTISSA)
    return (zeros.astype(np.uint16) << np.uint16(MANTISSA)) | rest.astype(np.uint16)


def chance_collision(n: int, m: int) -> float:
    """Probability that registers of two sets of n and m without a common element agree."""
    cells = 2.0**MANTISSA
    zeros = np.arange(0, 53)[:, None]
    low = (1 + np.arange(cells)[None, :] / cells) * 2.0 ** (-zeros - 1.0)
    high = low + 2.0 ** (-zeros - 1.0) / cells
    within = lambda k: np.exp(k * np.log1p(-low)) - np.where(high < 1, np.exp(k * np.log1p(-np.minimum(high, 1 - 1e-16))), 0.0)
    return float((within(n) * within(m)).sum())


def estimate(equal: np.ndarray, collision: np.ndarray) -> np.ndarray:
    """Jaccard similarity from the share of equal registers, less what chance makes equal."""
    return np.clip((equal - collision) / (1.0 - collision), 0.0, 1.0)


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, set_a, set_b, registers): two 64-bit sums name the shingle set."""
    words = WordHash()

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, a, b, r = [], [], [], []
            for text in batch.column("text").to_pylist():
                found = shingles(text, words)
                n.append(len(found))
                a.append(int(mix(found).sum(dtype=np.uint64).view(np.int64)) if len(found) else 0)
                b.append(int(mix(found ^ M1).sum(dtype=np.uint64).view(np.int64)) if len(found) else 0)
                r.append(registers(found).tobytes() if len(found) else b"")
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(r, pa.binary())],
                ["doc_id", "n_shingles", "set_a", "set_b", "registers"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(sign, "doc_id bigint, n_shingles bigint, set_a bigint, set_b bigint, registers binary")


def band_keys(classes: DataFrame) -> DataFrame:
    """(id, band key) of each class: a band's registers and its number, hashed."""

    @F.arrow_udf("array<bigint>")
    def keys(packed: pa.Array) -> pa.Array:
        out = []
        for x in packed.to_pylist():
            bands = np.frombuffer(x, np.uint16).reshape(BANDS, ROWS).astype(np.uint64)
            h = np.arange(1, BANDS + 1, dtype=np.uint64)
            for k in range(ROWS):
                h = mix(h * M1 + bands[:, k])
            out.append(h.view(np.int64))
        return pa.array(out, pa.list_(pa.int64()))

    return classes.select("id", F.explode(keys("registers")).alias("key"))


def likely(classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """Those of ``pairs`` (a, b) that share a band and whose estimate leaves the threshold within reach.

    Sets too different in size are out at once. Registers travel only of classes that may be in a pair: pass staged pairs.
    """
    classes, _ = sift(classes, "id", pairs.select(F.explode(F.array("a", "b")).alias("id")))
    side = lambda s: classes.select(F.col("id").alias(s), F.col("n_shingles").alias(f"n_{s}"), F.col("registers").alias(f"r_{s}"))
    joined = pairs.join(side("a"), "a").join(side("b"), "b").where(
        100 * F.least("n_a", "n_b") >= PERCENT * F.greatest("n_a", "n_b"))
    known: dict[tuple[int, int], float] = {}

    @F.arrow_udf("double")
    def estimated(n_a: pa.Array, n_b: pa.Array, r_a: pa.Array, r_b: pa.Array) -> pa.Array:
        out = []
        for n, m, x, y in zip(n_a.to_pylist(), n_b.to_pylist(), r_a.to_pylist(), r_b.to_pylist()):
            same = np.frombuffer(x, np.uint16) == np.frombuffer(y, np.uint16)
            if not same.reshape(BANDS, ROWS).all(axis=1).any():
                out.append(-1.0)
                continue
            equal = np.count_nonzero(same) / REGISTERS
            at = (1 << int(np.log2(n)), 1 << int(np.log2(m)))  # the correction hardly moves within a factor of two
            if at not in known:
                known[at] = chance_collision(*at)
            out.append(float(estimate(np.array(equal), np.array(known[at]))))
        return pa.array(out, pa.float64())

    level = PERCENT / 100
    least = level - DEVIATIONS * (level * (1 - level) / REGISTERS) ** 0.5
    return joined.where(estimated("n_a", "n_b", "r_a", "r_b") >= least).select("a", "b")


def full_sets(docs: DataFrame, asked: DataFrame) -> DataFrame:
    """(id, s): the shingle sets of the documents ``asked`` (id), a staged table. An id that stands on several rows has several sets."""
    words = WordHash()

    @F.arrow_udf("array<bigint>")
    def sets(texts: pa.Array) -> pa.Array:
        return pa.array([shingles(t, words).view(np.int64) for t in texts.to_pylist()], pa.list_(pa.int64()))

    texts, _ = sift(docs.select(F.col("doc_id").cast("bigint").alias("id"), "text"), "id", asked)
    texts = texts.join(asked, "id", "left_semi")
    return texts.select("id", sets("text").alias("s"))


def rare_pairs(full: DataFrame, roots: DataFrame, area, name: str) -> DataFrame:
    """Pairs (a, b) of the sets ``full`` (id, s) in different groups of ``roots`` (id, root) that may be linked.

    Shingles are ordered by how many of the sets hold them, rarest first. A link shares at least 6/7 of the smaller set and
    3/4 of the larger one, so it shares a shingle among the first n - 6/7 n + 1 of the smaller and n - 3/4 n + 1 of the
    larger; and from the first one that it shares on, both have as many shingles left as the link needs. A text that its
    group's hub does not reach has about as many shingles of its own as the first of these numbers, so in a large group of
    texts just below the threshold hardly any pair is left. No link is lost.
    """
    held = full.withColumn("row", F.monotonically_increasing_id())
    held = area.table(held.select("row", "id", F.size("s").cast("bigint").alias("n"), F.explode("s").alias("e")), f"{name}_held")
    # shingles of one set only link nothing, but they take their place in the order
    often = area.table(held.groupBy("e").agg(F.count("*").alias("f")).where("f > 1"), f"{name}_often")
    ordered = held.join(often, "e", "left").groupBy("row", "id", "n").agg(
        F.sort_array(F.collect_list(F.struct(F.coalesce("f", F.lit(1)).alias("f"), "e"))).alias("s"))
    # whole numbers: n - ceil(6 n / 7) = n div 7, n - ceil(3 n / 4) = n div 4
    first = ordered.select("id", "n", F.posexplode(F.slice("s", F.lit(1), F.expr("int(n div 4) + 1"))).alias("p", "x"))
    first = first.where("x.f > 1").select("id", "n", F.col("x.e").alias("e"), (F.col("n") - F.col("p")).alias("left"), (F.col("p") <= F.expr("n div 7")).alias("short"))
    first = area.table(first.join(roots, "id"), f"{name}_first")
    side = lambda s: first.select("e", "short", *[F.col(c).alias(f"{c}_{s}") for c in ("id", "n", "root", "left")])
    pairs = side("a").where("short").drop("short").join(side("b").drop("short"), "e").where(
        f"root_a <> root_b and (n_a < n_b or n_a = n_b and id_a < id_b) and 100 * n_a >= {PERCENT} * n_b"
        " and 7 * least(left_a, left_b) >= 3 * (n_a + n_b)")
    return pairs.select(F.col("id_a").alias("a"), F.col("id_b").alias("b"))


def verify(docs: DataFrame, classes: DataFrame, pairs: DataFrame, area, name: str) -> DataFrame:
    """Those of ``pairs`` (a, b: smallest doc_id of a class) that are linked by their full sets."""
    asked = area.table(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), f"{name}_asked")
    # an id that stands on several rows has several sets; the class was named after one of them
    full = area.table(full_sets(docs, asked), f"{name}_sets")
    of = lambda s: full.select(F.col("id").alias(s), F.col("s").alias(f"s_{s}"))
    size = F.size(F.array_intersect("s_a", "s_b"))
    linked = pairs.join(of("b"), "b").join(of("a"), "a").where(100 * size >= PERCENT * (F.size("s_a") + F.size("s_b") - size))
    links = area.table(linked.select("a", "b").distinct(), f"{name}_links")
    area.forget(f"{name}_sets", f"{name}_asked")
    return links


def components(nodes: DataFrame, links: DataFrame, area, name: str) -> DataFrame:
    """(id, root): the smallest id that each of ``nodes`` (id) reaches over ``links`` (a, b).

    Each round, every node takes the least root among its own and its neighbours', and then the root of that root. Rounds go
    on until nothing changes; their number grows with the logarithm of the longest path.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = area.table(both, f"{name}_edges")
    roots = area.table(both.select(F.col("a").alias("id")).distinct().withColumn("root", F.col("id")), f"{name}_roots0")
    turn = 0
    while True:
        turn += 1
        near = both.join(roots.withColumnRenamed("id", "b"), "b").groupBy(F.col("a").alias("id")).agg(F.min("root").alias("near"))
        low = roots.join(near, "id").select("id", "root", F.least("root", "near").alias("low"))
        # the root that a whole tree hangs on moves with the least that any of its nodes saw
        hook = low.groupBy("root").agg(F.min("low").alias("hook"))
        moved = low.join(hook, "root").select("id", F.col("root").alias("before"), F.least("low", "hook").alias("root"))
        moved = area.table(moved, f"{name}_roots{turn}")
        area.forget(f"{name}_roots{turn - 1}")
        roots = moved.select("id", "root")
        if moved.where("root <> before").limit(1).count() == 0:
            break
    return nodes.select("id").join(roots.select("id", "root"), "id", "left").select("id", F.coalesce("root", "id").alias("root"))


def group(docs: DataFrame, area) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of each row of ``docs`` (doc_id, text).

    Null and empty texts have an empty set, which is linked with nothing: they stay. Rows that repeat an id share its component.
    A row without doc_id is in no component and counts as not kept.
    """
    rows = area.table(signatures(docs), "neardup_rows")
    filled = rows.where("n_shingles > 0 and doc_id is not null")
    # one row per distinct set; counted before the shuffle, so thousands of copies are no hot key
    classes = area.table(filled.groupBy("set_a", "set_b").agg(
        F.min("doc_id").alias("id"), F.first("n_shingles").alias("n_shingles"), F.first("registers").alias("registers")), "neardup_classes")
    # registers are kept once for each class; a step's tables go as soon as the next one is written
    rows = area.table(rows.drop("registers"), "neardup_docs")
    area.forget("neardup_rows")
    keys = area.table(band_keys(classes), "neardup_keys")
    buckets = keys.groupBy("key").agg(F.count("*").alias("n"), F.min("id").alias("leader")).where("n > 1")
    members = area.table(keys.join(buckets.select("key", "leader"), "key"), "neardup_members")
    area.forget("neardup_keys")
    links, roots, tried = None, None, None
    for turn in range(LEADER_ROUNDS + 1):
        name = f"neardup{turn}"
        if turn == 0:
            # one pair for each class: the least leader of all its buckets
            pairs = members.where("id <> leader").groupBy(F.col("id").alias("b")).agg(F.min("leader").alias("a")).select("a", "b")
        else:
            placed = area.table(members.select("key", "id").join(roots, "id"), f"{name}_placed")
            mixed = placed.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.min(F.struct("root", "id")).alias("first"),
                                              F.max(F.struct("root", "id")).alias("last")).where("low <> high")
            open_ = area.table(placed.join(mixed.select("key", "first", "last"), "key"), f"{name}_open")
            if turn < LEADER_ROUNDS:
                # another leader for each open bucket: a class of its last group
                pairs = open_.where("root <> last.root").select(F.col("last.id").alias("a"), F.col("id").alias("b"))
            else:
                full = full_sets(docs, area.table(open_.select("id").distinct(), f"{name}_apart"))
                pairs = rare_pairs(full, roots, area, name)
            pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = area.table(likely(classes, area.table(pairs, f"{name}_met")), f"{name}_pairs")
        found = verify(docs, classes, pairs, area, name)
        links, tried = (found, pairs) if links is None else (links.unionByName(found), tried.unionByName(pairs))
        area.forget(*[f"{name}_{step}" for step in ("placed", "open", "apart", "held", "often", "first", "met")])
        if turn == 0 or found.limit(1).count():
            roots = area.table(components(classes, links, area, name), f"{name}_components")
    area.forget("neardup_members")
    sets = classes.select("set_a", "set_b", "id").join(roots, "id").select("set_a", "set_b", "root")
    own = rows.join(sets, ["set_a", "set_b"], "left")
    own = own.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "doc_id")).alias("component_id"))
    return own.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def keep_one(docs: DataFrame, area) -> DataFrame:
    """The rows of ``docs`` that stay: one of each group, with all columns; rows without doc_id stay.

    Where an id stands on several rows, one of them stays.
    """
    with staging(docs.sparkSession) as work:
        verdict = area.table(group(docs, work), "neardup_verdict")
    gone = area.table(verdict.where("not kept and doc_id is not null").select(F.col("doc_id").alias("id")).distinct(), "neardup_gone")
    doubtful, left = sift(docs, "doc_id", gone)
    left = left.unionByName(doubtful.join(gone.withColumnRenamed("id", "doc_id"), "doc_id", "left_anti").select(docs.columns))
    repeated = verdict.where("kept").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id")
    if repeated.limit(1).count() == 0:
        return left
    repeated = area.table(repeated, "neardup_repeated")
    once = left.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return left.join(repeated, "doc_id", "left_anti").unionByName(once).select(docs.columns)
