"""Removal of byte strings that occur elsewhere, by blockwise suffix sorting with a difference cover.

A string of LENGTH bytes is a window. Its anchor is the least hash among the GRAM-byte strings within it, so equal windows
have equal anchors, and neighbouring windows mostly share one. A run of windows with one anchor, and the bytes it spans,
is a context. Windows can be equal only within the bucket of an anchor, and only where the anchor occurs twice.

Contexts that occur twice are repeats throughout. The suffixes of the others are sorted, one block of buckets at a time:
by their first PERIOD bytes, and long ties by the ranks of cover samples. For any two positions some shift below PERIOD
brings both to sampled ones, whose next LENGTH - PERIOD bytes were ranked before. Memory is bounded by a block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.llm.common import M1, M2

LENGTH = 200
GRAM = 48
PERIOD = 32
RUN = 512  # windows of a context at most; a longer run is cut
BUCKET = 2_000  # contexts up to which a bucket is sorted in one block; beyond, its windows are counted one by one
SLICE = 32  # windows that are counted together in a larger bucket
BLOCK_BYTES = 1 << 20  # contexts of a block


def difference_cover(period: int) -> np.ndarray:
    """Residues of which some pair has each difference, added one by one, the one that brings most new differences first."""
    cover, known = [0], {0}
    while len(known) < period:
        new = lambda r: len(({(r - c) % period for c in cover} | {(c - r) % period for c in cover}) - known)
        best = max(range(period), key=new)
        known |= {(best - c) % period for c in cover} | {(c - best) % period for c in cover}
        cover.append(best)
    return np.array(sorted(set(cover)))


def shift_table(period: int) -> np.ndarray:
    """For two residues the least shift that brings both into the cover."""
    inside = np.isin(np.arange(2 * period) % period, difference_cover(period))
    both = lambda a, b: next(t for t in range(period) if inside[a + t] and inside[b + t])
    return np.array([[both(a, b) for b in range(period)] for a in range(period)])


def _double(h: np.ndarray, step: int, more: np.ndarray | None = None) -> np.ndarray:
    """Hashes of strings put together from two neighbours, ``step`` bytes apart."""
    right = h if more is None else more
    n = len(right) - step
    x = h[:n] * M1 + right[step:] * M2
    x ^= x >> np.uint64(29)
    x *= M2
    x ^= x >> np.uint64(32)
    return x


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the GRAM = 32 + 16 bytes from each position on."""
    h = (data.astype(np.uint64) + np.uint64(1)) * M1
    for step in (1, 2, 4, 8):
        h = _double(h, step)
    return _double(_double(h, 16), 32, h)


def window_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the LENGTH = 128 + 64 + 8 bytes from each position on."""
    levels, h = {}, (data.astype(np.uint64) + np.uint64(3)) * M2
    for step in (1, 2, 4, 8, 16, 32, 64):
        h = _double(h, step)
        levels[2 * step] = h
    return _double(_double(levels[128], 128, levels[64]), 192, levels[8])


def _sliding(x: np.ndarray, size: int, pick) -> np.ndarray:
    span = 1
    while span * 2 <= size:
        x = pick(x[:-span], x[span:])
        span *= 2
    return pick(x[: len(x) - (size - span)], x[size - span :]) if size > span else x


def runs_of(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, first window, number of windows, and weight of each run: 2 where the anchor occurs twice in the text."""
    grams, inner = gram_hashes(data), LENGTH - GRAM + 1
    least = _sliding(grams, inner, np.minimum)
    begin = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
    size = np.diff(np.append(begin, len(least)))
    if size.max() > RUN:
        begin = np.concatenate([np.arange(b, b + s, RUN) for b, s in zip(begin.tolist(), size.tolist())])
        size = np.diff(np.append(begin, len(least)))
    pad = np.zeros(inner - 1, np.uint64)
    anchors = grams[grams == _sliding(np.concatenate((pad, least, pad)), inner, np.maximum)]
    value = least[begin]
    names, counts = np.unique(anchors, return_counts=True)
    again = names[counts > 1]
    return value, begin, size, 1 + np.isin(value, again).astype(np.int64)


def twins_in_block(contexts: list[bytes], buckets: np.ndarray) -> list[np.ndarray]:
    """For each context, which of its windows equal another window of the same bucket."""
    lengths = np.array([len(c) for c in contexts])
    text = np.frombuffer(b"".join(contexts) + bytes(8), np.uint8).astype(np.uint64)
    starts = np.cumsum(lengths) - lengths
    n = int(lengths.sum())
    word = np.zeros(n, np.uint64)  # eight bytes from each position on, as a number that sorts like them
    for k in range(8):
        word = (word << np.uint64(8)) | text[k : n + k]
    sample = np.flatnonzero(np.isin(np.arange(max(0, n - (LENGTH - PERIOD) + 1)) % PERIOD, _COVER))
    keys = [word[sample + 8 * k] for k in range((LENGTH - PERIOD) // 8)]
    order = np.lexsort(keys[::-1])
    rank = np.full(n, -1, np.int64)
    if len(order):
        differs = np.zeros(len(order), bool)
        for k in keys:
            differs[1:] |= k[order][1:] != k[order][:-1]
        rank[sample[order]] = np.cumsum(differs)
    windows = lengths - LENGTH + 1
    at = np.concatenate([np.arange(s, s + w) for s, w in zip(starts.tolist(), windows.tolist())])
    bucket = np.repeat(buckets, windows)
    # the suffixes of each bucket in the order of their first bytes
    heads = [word[at + 8 * k] for k in range(PERIOD // 8)]
    order = np.lexsort([*heads[::-1], bucket])
    new = np.ones(len(at), bool)
    new[1:] = bucket[order][1:] != bucket[order][:-1]
    for k in heads:
        new[1:] |= k[order][1:] != k[order][:-1]
    tie = np.cumsum(new) - 1
    found = np.zeros(n, bool)
    open_ = np.bincount(tie)[tie] > 1
    p, tie = at[order][open_], tie[open_]
    tails = range(LENGTH - PERIOD, LENGTH, 8)
    while len(p):
        # every suffix of a tie against the first one left in it
        first = np.flatnonzero(np.concatenate(([True], tie[1:] != tie[:-1])))
        lead = p[np.repeat(first, np.diff(np.append(first, len(p))))]
        shift = _SHIFTS[lead % PERIOD, p % PERIOD]
        same = rank[lead + shift] == rank[p + shift]
        for k in tails:
            same &= word[lead + k] == word[p + k]
        group = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(p))))
        many = np.bincount(group, weights=same) > 1
        found[p[same & many[group]]] = True
        p, tie = p[~same], tie[~same]
    return [found[s : s + w] for s, w in zip(starts.tolist(), windows.tolist())]


_COVER, _SHIFTS = difference_cover(PERIOD), shift_table(PERIOD)


def spans_of(flags: np.ndarray) -> tuple[list[int], list[int]]:
    """Begins and ends of the runs of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    return edges[::2].tolist(), edges[1::2].tolist()


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with two hashes that name the row; rows with equal id and text share them, and all else."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return rows.select("doc_id", F.xxhash64("doc_id", "text").alias("k1"), F.xxhash64("text", F.lit("row"), "doc_id").alias("k2"), "text")


def runs(rows: DataFrame) -> DataFrame:
    """(k1, k2, anchor, context, begin, size, weight) of every run of every text."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            held: list[list[np.ndarray]] = [[] for _ in range(7)]
            for k1, k2, text in zip(*(batch.column(c).to_pylist() for c in ("k1", "k2", "text"))):
                data = text.encode()
                if len(data) < LENGTH:
                    continue
                value, begin, size, weight = runs_of(np.frombuffer(data, np.uint8))
                name = np.fromiter((xxhash.xxh3_64_intdigest(data[b : b + s + LENGTH - 1]) for b, s in zip(begin.tolist(), size.tolist())), np.uint64, len(begin))
                for column, part in zip(held, (np.full(len(begin), k1), np.full(len(begin), k2), value.view(np.int64), name.view(np.int64), begin, size, weight)):
                    column.append(part)
            if held[0]:
                columns = [np.concatenate(c) for c in held]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 4 + [pa.int32()] * 3)],
                                                 ["k1", "k2", "anchor", "context", "begin", "size", "weight"])

    return rows.select("k1", "k2", "text").where(F.octet_length("text") >= LENGTH).mapInArrow(
        cut, "k1 bigint, k2 bigint, anchor bigint, context bigint, begin int, size int, weight int")


def context_bytes(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The bytes of ``wanted`` contexts (k1, k2, begin, size, ...), cut from their texts."""
    lists = wanted.groupBy("k1", "k2").agg(F.collect_list(F.struct("anchor", "context", "n", "m", "begin", "size")).alias("wanted"))
    once = rows.select("k1", "k2", "text").join(lists, ["k1", "k2"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                data = row["text"].encode()
                yield pa.RecordBatch.from_pylist(
                    [w | {"k1": row["k1"], "k2": row["k2"], "data": data[w["begin"] : w["begin"] + w["size"] + LENGTH - 1]} for w in row["wanted"]], kind)

    kind = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("anchor", pa.int64()), ("context", pa.int64()), ("n", pa.int64()), ("m", pa.int64()), ("begin", pa.int32()), ("data", pa.binary())])
    # a row that is there twice gives its contexts twice
    return once.mapInArrow(cut, "k1 bigint, k2 bigint, anchor bigint, context bigint, n bigint, m bigint, begin int, data binary").dropDuplicates(["anchor", "context"])


_SPANS = "k1 bigint, k2 bigint, a int, b int"


def _found(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), [pa.int64(), pa.int64(), pa.int32(), pa.int32()])], ["k1", "k2", "a", "b"])


def sorted_twins(contexts: DataFrame) -> DataFrame:
    """(k1, k2, a, b): windows from a to before b that equal another window, of contexts in buckets of at most BUCKET."""

    def of_block(held: list[dict]) -> list[tuple]:
        names = {a: k for k, a in enumerate(dict.fromkeys(r["anchor"] for r in held))}
        flags = twins_in_block([r["data"] for r in held], np.array([names[r["anchor"]] for r in held]))
        return [(r["k1"], r["k2"], r["begin"] + a, r["begin"] + b) for r, f in zip(held, flags) if r["n"] == 1 for a, b in zip(*spans_of(f))]

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for row in batch.to_pylist():
                if size >= BLOCK_BYTES and row["anchor"] != held[-1]["anchor"]:
                    if found := of_block(held):
                        yield _found(found)
                    held, size = [], 0
                held.append(row)
                size += len(row["data"])
        if held and (found := of_block(held)):
            yield _found(found)

    small = contexts.where(F.col("m") <= BUCKET).select("anchor", "n", "k1", "k2", "begin", "data")
    return small.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(sort, _SPANS)


def counted_twins(contexts: DataFrame, area) -> DataFrame:
    """The same for larger buckets, by counts that are added up before each shuffle.

    Contexts are cut into slices of SLICE windows, counted from the anchor. A slice that occurs twice is a repeat as a whole;
    of all equal slices one goes on, and its windows are counted one by one.
    """

    def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            out = []
            for row in batch.to_pylist():
                data = row["data"]
                windows = len(data) - LENGTH + 1
                anchor = int(np.argmin(gram_hashes(np.frombuffer(data[: windows - 1 + LENGTH], np.uint8))))
                cuts = [0, *range(anchor % SLICE or SLICE, windows, SLICE), windows]
                for a, b in zip(cuts, cuts[1:]):
                    part = data[a : b - 1 + LENGTH]
                    out.append((row["k1"], row["k2"], row["anchor"], row["n"], row["begin"] + a, b - a, xxhash.xxh3_64_intdigest(part, seed=b - a) - (1 << 63), part))
            if out:
                types = [pa.int64()] * 4 + [pa.int32()] * 2 + [pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], ["k1", "k2", "anchor", "n", "at", "size", "slice", "data"])

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                h = window_hashes(np.frombuffer(row["data"], np.uint8))
                k = len(h)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(k, row[c]), pa.int64()) for c in ("k1", "k2", "anchor", "n")] + [pa.array(row["at"] + np.arange(k), pa.int32()), pa.array(h.view(np.int64), pa.int64())],
                    ["k1", "k2", "anchor", "n", "at", "window"])

    large = contexts.where(F.col("m") > BUCKET).select("anchor", "n", "k1", "k2", "begin", "data")
    parts = area.table(large.mapInArrow(slices, "k1 bigint, k2 bigint, anchor bigint, n bigint, at int, size int, slice bigint, data binary"), "suffix_slices")
    distinct = area.table(parts.groupBy("anchor", "slice").agg(F.sum("n").alias("times"), F.min(F.struct("k1", "k2", "at", "data")).alias("one")), "suffix_distinct")
    shared = parts.where("n = 1").join(distinct.where("times > 1").select("anchor", "slice"), ["anchor", "slice"], "left_semi")
    shared = shared.select("k1", "k2", F.col("at").alias("a"), (F.col("at") + F.col("size")).alias("b"))
    each = distinct.select("anchor", F.col("times").alias("n"), "one.*").mapInArrow(windows, "k1 bigint, k2 bigint, anchor bigint, n bigint, at int, window bigint")
    each = area.table(each, "suffix_windows")
    twice = each.groupBy("anchor", "window").agg(F.sum("n").alias("times")).where("times > 1").select("anchor", "window")
    found = each.where("n = 1").join(twice, ["anchor", "window"], "left_semi")
    return shared.unionByName(found.select("k1", "k2", F.col("at").alias("a"), (F.col("at") + 1).alias("b")))


def twin_windows(rows: DataFrame, area) -> DataFrame:
    """(k1, k2, a, b): for each row, stretches of windows that start anywhere else too."""
    every = area.table(runs(rows), "suffix_runs")
    anchors = every.groupBy("anchor").agg(F.sum("weight").alias("times")).where("times > 1").select("anchor")
    candidates = area.table(every.join(anchors, "anchor", "left_semi"), "suffix_candidates")
    contexts = area.table(candidates.groupBy("anchor", "context").agg(
        F.count("*").alias("n"), F.max("weight").alias("weight"), F.min(F.struct("k1", "k2", "begin", "size")).alias("one")), "suffix_contexts")
    whole = candidates.join(contexts.where("n > 1").select("anchor", "context"), ["anchor", "context"], "left_semi")
    whole = whole.select("k1", "k2", F.col("begin").alias("a"), (F.col("begin") + F.col("size")).alias("b"))
    buckets = contexts.groupBy("anchor").agg(F.count("*").alias("m"), F.count_if(F.col("n") == 1).alias("single"), F.max("weight").alias("weight"))
    buckets = buckets.where("single > 0 and (m > 1 or weight > 1)").select("anchor", "m")
    wanted = contexts.select("anchor", "context", "n", "one.*").join(buckets, "anchor")
    cut = area.table(context_bytes(rows, wanted), "suffix_bytes")
    return whole.unionByName(sorted_twins(cut)).unionByName(counted_twins(cut, area))


def removed(docs: DataFrame, area) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept) of each row of ``docs`` (doc_id, text); ``kept`` are the bytes left.

    Null and empty texts have no bytes. Texts shorter than LENGTH lose nothing. Rows that repeat lose all windows, since each
    is also in the other.
    """
    rows = keyed(docs)
    found = area.table(twin_windows(rows, area), "suffix_twins")
    lists = found.groupBy("k1", "k2").agg(F.collect_list(F.struct("a", "b")).alias("spans"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                data = row["text"].encode()
                gone = np.zeros(len(data) + 1, np.int32)
                for s in row["spans"] or []:
                    gone[s["a"]] += 1
                    gone[s["b"] - 1 + LENGTH] -= 1
                gone = np.cumsum(gone)[:-1] > 0
                begins, ends = spans_of(gone)
                left = b"".join(data[a:b] for a, b in zip([0, *ends], [*begins, len(data)]))
                out.append((row["doc_id"], len(data), len(data) - len(left), len(begins), hashlib.sha256(left).hexdigest(), left))
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)] if out else [pa.array([], t) for t in types],
                                             ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    joined = rows.join(lists, ["k1", "k2"], "left").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", "spans")
    return joined.mapInArrow(cut, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary")
