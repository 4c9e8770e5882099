"""Benchmark decontamination with DataFrame operations only.

Windows of a document, as long as a benchmark item and dense enough in shingles of items of that length, get a 64-bit
SimHash. Fingerprints within RADIUS bits agree on at least one of RADIUS + 1 blocks, so an equality join on blocks
finds all of them. Exact similarity of the weighted shingle sets then decides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHINGLE = 5  # words
SIMILARITY = 0.75  # weighted Jaccard; the weight of a shingle is the number of times it occurs
BITS = 64
#: At similarity 0.75 fingerprints differ in 11 bits on average, with a deviation of 3; this is four deviations beyond.
RADIUS = 23
BROADCAST_SHINGLES = 1_000_000  # benchmark shingles up to this count are broadcast, beyond they are shuffled


def words_of(text: Column) -> Column:
    """Hashes of the words between ASCII white space, all letters lower-cased and not only A-Z; none for null."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[ \t\n\x0B\f\r]+"), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, also where the optimiser copies the expression into a lambda or a filter."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def shingles_of(words: Column) -> Column:
    """A hash for each run of SHINGLE word hashes; a shorter text counts as one run; none without words."""

    def runs(w: Column) -> Column:
        n = F.size(w)
        whole = F.when(n > 0, F.array(F.xxhash64(w))).otherwise(F.array().cast("array<bigint>"))
        each = F.transform(F.sequence(F.lit(0), n - SHINGLE), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(SHINGLE)]))
        return F.when(n < SHINGLE, whole).otherwise(each)

    return let(words, runs)


def numbered(shingles: Column) -> Column:
    """The multiset as a set, in any order: a shingle's repeats become hashes of their own, by its hash and their number."""

    def each(s: Column) -> Column:
        # equal hashes lie together once sorted, so the first one's place tells a repeat's number
        repeats = let(F.array_sort(s), lambda x: F.transform(x, lambda h, i: let(
            i + 1 - F.array_position(x, h), lambda k: F.when(k > 0, F.xxhash64(h, k)).otherwise(h))))
        return F.when(F.size(F.array_distinct(s)) == F.size(s), s).otherwise(repeats)

    return let(shingles, each)


def simhash(shingles: Column) -> Column:
    """Bit b is set where more than half of the shingles have it set.

    Repeated shingles are numbered first. One hash with a great weight would move many bits at once; so each unit of weight moves
    them by itself, and distances tell of the weighted similarity as they do for sets.
    """

    def bits(s: Column) -> Column:
        ones = lambda b: F.aggregate(s, F.lit(0), lambda n, h: n + F.call_function("shiftright", h, b).bitwiseAND(F.lit(1)).cast("int"))
        bit = lambda b: F.when(ones(b) * 2 > F.size(s), F.call_function("shiftleft", F.lit(1).cast("bigint"), b)).otherwise(F.lit(0).cast("bigint"))
        return F.aggregate(F.sequence(F.lit(0), F.lit(BITS - 1)), F.lit(0).cast("bigint"), lambda acc, b: acc.bitwiseOR(bit(b)))

    return let(numbered(shingles), bits)


def block_masks() -> list[int]:
    """RADIUS + 1 masks that share the bits of a fingerprint out, as signed 64-bit numbers."""
    edges = [k * BITS // (RADIUS + 1) for k in range(RADIUS + 2)]
    masks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def weighted_similarity(a: Column, b: Column) -> Column:
    """Sum of the lesser weights over the sum of the greater ones."""
    times = lambda s, h: F.size(F.filter(s, lambda x: x == h))
    least = F.aggregate(F.array_distinct(a), F.lit(0), lambda n, h: n + F.least(times(a, h), times(b, h)))
    return least / (F.size(a) + F.size(b) - least)


def items_of(benchmark: DataFrame) -> DataFrame:
    """(item_id, item_words, item_shingles, item_hash); null and empty items are left out."""
    rows = benchmark.select("item_id", words_of(F.col("text")).alias("w")).where(F.size("w") > 0)
    rows = rows.select("item_id", F.size("w").alias("item_words"), shingles_of(F.col("w")).alias("item_shingles"))
    return rows.withColumn("item_hash", simhash(F.col("item_shingles")))


def width_of(words: Column) -> Column:
    """Shingles of a text of so many words."""
    return F.greatest(words - SHINGLE + 1, F.lit(1))


def starts(at: Column, n: Column, item_words: Column) -> Column:
    """Where the windows of a document of ``n`` words begin that can be similar to an item of ``item_words`` words.

    ``at`` has the places, in order, of shingles that items of that length have. A window is laid at the beginning, and so that
    it ends in each place. It must hold the number of places that the similarity takes at least, which one look into ``at`` tells.
    """

    def of(x: Column) -> Column:
        places, width = x["at"], x["width"]
        least = F.ceil(SIMILARITY / (1 + SIMILARITY) * (F.least(width, x["have"]) + width) - 1e-6).cast("int")
        # ``get`` gives null outside of the array, which is not true
        first = F.when(F.get(places, least - 1) < width, F.array(F.lit(0))).otherwise(F.array().cast("array<int>"))
        ends = F.filter(places, lambda p, j: (p >= width) & (j >= least - 1) & (F.get(places, j - least + 1) > p - width))
        return F.concat(first, F.transform(ends, lambda p: p - width + 1))

    return let(F.struct(at.alias("at"), width_of(n).alias("have"), width_of(item_words).alias("width")), of)


def matches(docs: DataFrame, benchmark: DataFrame, area) -> DataFrame:
    """(doc_id, item_id, start, distance, similarity): each document and item that is similar to one of its windows.

    The best window counts, the first of equals. A document shorter than the item is one window. Null and empty texts match
    nothing; repeated rows match alike and are told once. The first best window for an item either begins the document or
    ends in a shingle of the item, or else the window one word before it would be as good; so only such windows are laid.
    """
    items = area.table(items_of(benchmark), "decontam_items")
    places = items.select("item_words", F.explode("item_shingles").alias("shingle")).distinct()
    few = items.agg(F.sum(F.size("item_shingles"))).first()[0] or 0
    # a shingle that many items share comes once for each item length
    places = F.broadcast(places) if few <= BROADCAST_SHINGLES else places
    text = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("key"), "text")
    worded = text.select("doc_id", "key", words_of(F.col("text")).alias("w"))
    # only keys go through the join with the benchmark, one row for each item length that has the shingle
    hits = worded.select("doc_id", "key", F.size("w").alias("n"), F.posexplode_outer(shingles_of(F.col("w"))).alias("at", "shingle")).join(places, "shingle")
    hits = hits.groupBy("doc_id", "key", "n", "item_words").agg(F.array_sort(F.collect_set("at")).alias("at"))
    lists = hits.select("doc_id", "key", "item_words", starts(F.col("at"), F.col("n"), F.col("item_words")).alias("starts")).where(F.size("starts") > 0)
    lists = area.table(lists.groupBy("doc_id", "key").agg(F.collect_list(F.struct("item_words", "starts")).alias("hits")), "decontam_hits")
    found = text.withColumnRenamed("doc_id", "id").join(lists, (F.col("id").eqNullSafe(F.col("doc_id"))) & (text["key"] == lists["key"]))
    laid = F.flatten(F.transform("hits", lambda h: F.transform(h["starts"], lambda p: F.struct(h["item_words"].alias("item_words"), p.alias("start")))))
    cut = lambda s: F.transform(laid, lambda x: F.struct(x["item_words"].alias("item_words"), x["start"].alias("start"), F.slice(s, x["start"] + 1, width_of(x["item_words"])).alias("w")))
    # texts are cut before the explode, so that no row of a window holds the whole text
    found = found.select("doc_id", let(shingles_of(words_of(F.col("text"))), cut).alias("windows"))
    windows = found.select("doc_id", F.explode_outer("windows").alias("x")).select("doc_id", "x.*")
    # items of fewer words than a shingle are one run of their own length
    for length in sorted(r[0] for r in items.where(F.col("item_words") < SHINGLE).select("item_words").distinct().collect()):
        runs = let(F.col("w"), lambda w: F.transform(  # noqa: B023
            F.sequence(F.lit(0), F.size(w) - length), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(length)])))  # noqa: B023
        short = worded.where(F.size("w") >= length).select("doc_id", F.posexplode_outer(runs).alias("start", "shingle"))
        short = short.join(places.where(F.col("item_words") == length).select("shingle", "item_words"), "shingle")
        windows = windows.unionByName(short.select("doc_id", "item_words", "start", F.array("shingle").alias("w")))
    windows = windows.distinct()
    windows = area.table(windows.withColumn("hash", simhash(F.col("w"))), "decontam_windows")
    blocks = F.array(*map(F.lit, block_masks()))
    keyed = lambda df, value: df.select("*", F.posexplode(F.transform(blocks, lambda m: F.col(value).bitwiseAND(m))).alias("block", value + "_part"))
    apart = F.col("hash").bitwiseXOR(F.col("item_hash"))
    earliest = F.array_position(F.transform(blocks, lambda m: apart.bitwiseAND(m) == 0), F.lit(True)) - 1
    left, right = keyed(windows, "hash").alias("w"), keyed(items, "item_hash").alias("i")
    near = left.join(right, (F.col("w.block") == F.col("i.block")) & (F.col("hash_part") == F.col("item_hash_part"))
                     & (F.col("w.item_words") == F.col("i.item_words")) & (F.bit_count(apart) <= RADIUS) & (earliest == F.col("w.block")))
    found = near.select("doc_id", "item_id", "start", F.bit_count(apart).alias("distance"), weighted_similarity(F.col("w"), F.col("item_shingles")).alias("similarity"))
    found = found.where(F.col("similarity") >= SIMILARITY)
    best = F.max_by(F.struct("start", "distance", "similarity"), F.struct("similarity", -F.col("start")))
    return found.groupBy("doc_id", "item_id").agg(best.alias("b")).select("doc_id", "item_id", "b.*")


def clean(docs: DataFrame, benchmark: DataFrame, area) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item; a row without doc_id that matches goes with all such rows that match."""
    leaks = matches(docs, benchmark, area).select("doc_id").distinct()
    return docs.alias("d").join(leaks.alias("l"), F.col("d.doc_id").eqNullSafe(F.col("l.doc_id")), "left_anti")
