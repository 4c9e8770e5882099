"""Stupid-backoff scores of documents under n-gram counts of all other documents.

Documents are packed into blocks of bounded size. A block's distinct n-grams, with their counts in it, go to the partition
of their hash; there they add up to that part of the count table and are joined with it, and each block gets back the
totals of its own n-grams. A document's own occurrences are taken off the totals, so every n-gram is judged by the rest of
the corpus. An n-gram of half of all documents is still one row per block: no key is hot.

Words and pairs go first. A longer n-gram that another document has too is made of two shorter ones that it has as well, so only
those n-grams are sent whose two parts came back with occurrences elsewhere: the others have none, whatever the corpus.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.llm.common import M1, WordHash, mix, split_words

ORDER = 2  # unless asked for another; the query takes 3
ALPHA = 0.4
BLOCK_CHARS = 4 << 20  # characters of text in a block; a longer document is a block of its own
PART_GRAMS = 1_000_000  # n-grams of a partition of the count table, about
BEGIN = np.uint64(0x5851F42D4C957F2D)  # stands before the first word


def narrow(a: np.ndarray) -> np.ndarray:
    """The same numbers in as few bytes each as the largest takes."""
    return a.astype(np.min_scalar_type(int(a.max()))) if len(a) else a.astype(np.uint8)


def numbers(data: bytes, n: int) -> np.ndarray:
    """The ``n`` numbers of a narrow array."""
    return np.frombuffer(data, f"u{len(data) // n}") if n else np.empty(0, np.uint8)


def shut(texts: list[str]) -> bytes:
    """Texts as one compressed value. Spark holds whole rows in its readers, sorts and exchanges, several copies at a time."""
    batch, sink = pa.record_batch([pa.array(texts, pa.large_string())], ["text"]), pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 1), use_threads=False)) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def opened(data: bytes) -> list[str]:
    return pa.ipc.open_stream(data, options=pa.ipc.IpcReadOptions(use_threads=False)).read_all()["text"].to_pylist()


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Row after row: a block with its answers is large, and a batch may hold several."""
    for batch in batches:
        for k in range(batch.num_rows):
            yield batch.slice(k, 1).to_pylist()[0]


def block_rows(docs: DataFrame) -> DataFrame:
    """(block, doc_ids, texts, n_words): neighbouring rows packed together, the texts shut."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, number = TaskContext.get().partitionId(), 0
        ids, texts, size = [], [], 0

        def flush():
            words = sum(len(split_words(t)) for t in texts)
            return pa.RecordBatch.from_arrays(
                [pa.array([(task << 32) + number], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([shut(texts)], pa.binary()), pa.array([words], pa.int64())],
                ["block", "doc_ids", "texts", "n_words"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if ids and size + len(text) > BLOCK_CHARS:
                    yield flush()
                    number, ids, texts, size = number + 1, [], [], 0
                ids.append(doc_id)
                texts.append(text)
                size += len(text)
        if ids:
            yield flush()

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(pack, "block bigint, doc_ids array<bigint>, texts binary, n_words bigint")


def packed(names: np.ndarray) -> bytes:
    """Ascending hashes as their differences, the lowest byte of each, then the next: the high bytes are nearly all zero."""
    return np.diff(names, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.tobytes()


def unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view(np.uint64).ravel(), dtype=np.uint64)


def block_words(texts: list[str], words: WordHash) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all words of a block, text after text: the hash, the number of the text, and the place in it."""
    each = [words.of(split_words(t, lower=True)) for t in texts]
    sizes = np.array([len(w) for w in each], np.int64)
    place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return np.concatenate([np.empty(0, np.uint64), *each]), np.repeat(np.arange(len(texts)), sizes), place


def others(grams: np.ndarray, sent: np.ndarray, text: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """At each place the occurrences of its n-gram in other texts; ``totals`` go with the distinct n-grams sent, in order."""
    left = np.zeros(len(grams), np.int64)
    at = np.flatnonzero(sent)
    if len(at):
        at = at[np.argsort(grams[at], kind="stable")]  # texts stay in order, so a text's own occurrences are neighbours
        g, t = grams[at], text[at]
        other = np.concatenate(([False], g[1:] != g[:-1]))
        run = np.concatenate(([True], other[1:] | (t[1:] != t[:-1])))
        own = np.diff(np.concatenate((np.flatnonzero(run), [len(at)])))
        left[at] = totals.astype(np.int64)[np.cumsum(other)] - own[np.cumsum(run) - 1]
    return left


def levels(w: np.ndarray, text: np.ndarray, place: np.ndarray, totals: dict[int, np.ndarray], order: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray | None]]:
    """For each n up to ``order``: the n-gram that ends at each word, whether it is sent, and its count elsewhere where totals tell it.

    Sent are n-grams of n words whose two (n-1)-grams occur elsewhere; words and pairs are sent without that question.
    """
    grams, left = w, None
    for n in range(1, order + 1):
        sent = place >= n - 1
        if n > 1:
            past = np.roll(w, n - 1)
            past[~sent] = BEGIN
            grams = mix(grams * M1 + mix(past + np.uint64(n)))
        if n > 2:
            sent = sent & (left > 0) & (np.roll(left, 1) > 0)
        left = others(grams, sent, text, totals[n]) if n in totals else None
        yield grams, sent, left


def answers_of(answers: list[dict] | None, first: int, last: int) -> dict[int, np.ndarray]:
    """The totals of a block's n-grams for each n from ``first`` to ``last``."""
    return {n: np.concatenate([np.empty(0, np.uint64), *(numbers(a["totals"], a["size"]) for a in answers or [] if a["n"] == n)]) for n in range(first, last + 1)}


def gathered(blocks: DataFrame, bits: int, lengths: range) -> DataFrame:
    """(n, part, block, grams, counts): a block's n-grams of ``lengths``, cut by the leading ``bits`` of their hash.

    For n above 2 ``blocks`` have the answers for the lengths below.
    """
    words, first = WordHash(), np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits) if bits else np.zeros(1, np.uint64)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            totals = answers_of(row["answers"], 2, lengths.start - 1)
            for n, (grams, sent, _) in enumerate(levels(*block_words(opened(row["texts"]), words), totals, lengths.stop - 1), 1):
                if n not in lengths:
                    continue
                names, counts = np.unique(grams[sent], return_counts=True)
                edges = [*np.searchsorted(names, first).tolist(), len(names)]
                rows = [(k, packed(names[a:b]), narrow(counts[a:b]).tobytes()) for k, (a, b) in enumerate(zip(edges, edges[1:])) if a < b]
                if rows:
                    k, g, c = zip(*rows)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([n] * len(k), pa.int32()), pa.array(k, pa.int32()), pa.array([row["block"]] * len(k), pa.int64()), pa.array(g, pa.binary()), pa.array(c, pa.binary())],
                        ["n", "part", "block", "grams", "counts"])

    return blocks.select("block", "texts", "answers").mapInArrow(emit, "n int, part int, block bigint, grams binary, counts binary")


def joined(parts: DataFrame) -> DataFrame:
    """(block, n, part, size, totals): each partition's count table, joined to the n-grams of every block.

    A group is one partition of the table, about PART_GRAMS n-grams, and once more for each block they occur in.
    """

    def join(table: pa.Table) -> pa.Table:
        grams = [unpacked(g) for g in table["grams"].to_pylist()]
        counts = [numbers(c, len(g)) for g, c in zip(grams, table["counts"].to_pylist())]
        names, at = np.unique(np.concatenate(grams), return_inverse=True)
        totals = np.bincount(at, weights=np.concatenate(counts), minlength=len(names)).astype(np.uint64)[at]
        cuts = np.cumsum([len(g) for g in grams])[:-1]
        return pa.table({"block": table["block"], "n": table["n"], "part": table["part"], "size": pa.array([*map(len, grams)], pa.int32()), "totals": pa.array([narrow(t).tobytes() for t in np.split(totals, cuts)], pa.binary())})

    return parts.groupBy("n", "part").applyInArrow(join, "block bigint, n int, part int, size int, totals binary")


def score_block(texts: list[str], totals: dict[int, np.ndarray], n_words: int, words: WordHash, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Words and log score of each text; ``totals`` are the answers for the block."""
    w, text, place = block_words(texts, words)
    sizes = np.bincount(text, minlength=len(texts))
    left = [found for _, _, found in levels(w, text, place, totals, order)]
    seen, score = np.zeros(len(w), bool), np.zeros(len(w))
    for n in range(order, 1, -1):
        # the n-gram was seen elsewhere, and so was its context, which ends at the word before
        held = np.roll(left[n - 2], 1)
        hit = ~seen & (place >= n - 1) & (left[n - 1] > 0) & (held > 0)
        score[hit] = math.log(ALPHA) * (order - n) + np.log(left[n - 1][hit] / held[hit])
        seen |= hit
    # a word that no other document has counts as one occurrence
    rest = np.maximum(n_words - sizes, 1)[text]
    score[~seen] = math.log(ALPHA) * (order - 1) + np.log(np.maximum(left[0], 1)[~seen] / rest[~seen])
    return sizes, np.bincount(text, weights=score, minlength=len(texts))


def scores(docs: DataFrame, area, order: int = ORDER) -> DataFrame:
    """(doc_id, n_words, log_score, mean_score) of each row of ``docs`` (doc_id, text).

    log_score sums over the words the log of c(w1..wn) / c(w1..wn-1), counts without the document's own, or ALPHA for each step
    down to a shorter n-gram that other documents have. Null and empty texts: no words, 0 and no mean. Repeated rows count as
    documents of their own. Empty tables give an empty result.
    """
    blocks = area.table(block_rows(docs), "backoff_blocks")
    n_words = blocks.agg(F.sum("n_words")).first()[0] or 0
    bits = max(0, math.ceil(math.log2(max(1, n_words * order / PART_GRAMS))))
    asking, answered = blocks.withColumn("answers", F.lit(None).cast("array<struct<n:int,part:int,size:int,totals:binary>>")), []
    for lengths in (range(1, min(order, 2) + 1), *(range(n, n + 1) for n in range(3, order + 1))):
        answered.append(area.table(joined(gathered(asking, bits, lengths)), f"backoff_totals_{lengths.start}"))
        totals = reduce(DataFrame.unionByName, answered)
        answers = totals.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("n", "part", "size", "totals"))).alias("answers"))
        asking = blocks.join(answers, "block", "left")
    words = WordHash()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            n, s = score_block(opened(row["texts"]), answers_of(row["answers"], 1, order), n_words, words, order)
            yield pa.RecordBatch.from_arrays([pa.array(row["doc_ids"], pa.int64()), pa.array(n, pa.int64()), pa.array(s, pa.float64())], ["doc_id", "n_words", "log_score"])

    found = asking.select("doc_ids", "texts", "answers").mapInArrow(score, "doc_id bigint, n_words bigint, log_score double")
    return found.withColumn("mean_score", F.when(F.col("n_words") > 0, F.col("log_score") / F.col("n_words")))
