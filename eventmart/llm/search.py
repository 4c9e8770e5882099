"""Ranked lexical search: every document scored for every item of a query set, by dense matrix products.

Documents are read once into narrow rows of the terms that the items have. Items and documents are then laid out in tiles: a tile
of items has a compact vocabulary of its own, and its dense weights are multiplied with the dense impacts of a tile of documents
in float64. All numbers are whole and a product's sums are kept below 2^53, so float64 is exact. Each task keeps the best of all
its tiles for each item, ties at the last place included, and Spark takes the best of the tasks in two steps.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BATCH_ITEMS, BATCH_BYTES = 4096, 16 << 20  # items whose terms the driver and each task hold at once, and their text
ITEM_TILE = 64  # items
TERM_TILE = 4096  # columns of a product
DOC_TILE = 512  # documents
EXACT = 1 << 53
SALTS = 64  # parts of an item's results before the last step

# Fixed values of the ranking rule.
SCALE, SLOPE, SATURATION = 25, 12, 1000
IMPACT = 10**9
MOST = IMPACT // SATURATION  # no impact reaches it

# a term is a run of bytes that are ASCII letters or digits, or belong to other characters; only A-Z are lower-cased
_TERMS = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256)).lower()


def terms_of(text: str) -> list[bytes]:
    """Maximal runs of ``[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]`` as UTF-8."""
    return text.encode().translate(_TERMS).split()


@dataclass
class Tile:
    """Some items, the terms that they have, and the dense weights (items x terms)."""

    items: np.ndarray  # places in the batch
    terms: np.ndarray  # places in the batch's vocabulary
    weights: np.ndarray


def item_batches(items: DataFrame) -> Iterator[list[tuple[object, str]]]:
    """(item_id, text) in batches of bounded size; a longer item is a batch of its own."""
    batch, size = [], 0
    for item in items.select("item_id", F.coalesce("text", F.lit("")).alias("text")).toLocalIterator():
        if batch and (len(batch) == BATCH_ITEMS or size + len(item.text) > BATCH_BYTES):
            yield batch
            batch, size = [], 0
        batch.append((item.item_id, item.text))
        size += len(item.text)
    if batch:
        yield batch


def narrow_docs(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, tfs): the number of all terms of a document, and those of ``vocabulary`` with their occurrences."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            n, terms, tfs = [], [], []
            for text in batch.column("text").to_pylist():
                found = terms_of(text)
                held = Counter(map(known.get, found))
                held.pop(None, None)
                n.append(len(found))
                terms.append([*held.keys()])
                tfs.append([*held.values()])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int32()))],
                                             ["doc_id", "n", "terms", "tfs"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(read, "doc_id bigint, n bigint, terms array<int>, tfs array<int>")


def document_frequencies(rows: DataFrame, size: int) -> np.ndarray:
    """In how many rows each term of the vocabulary occurs; added up per task before the shuffle."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(batch.column("terms").flatten().to_numpy(), minlength=size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], ["term", "df"])

    out = np.zeros(size, np.int64)
    for row in rows.select("terms").mapInArrow(add, "term int, df bigint").groupBy("term").agg(F.sum("df").alias("df")).toLocalIterator():
        out[row.term] = row.df
    return out


def weights_of(df: np.ndarray, n_docs: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)


def tiles_of(counts: list[dict[int, int]], weights: np.ndarray) -> list[Tile]:
    """The items' terms in dense tiles; a row of weights times the greatest impact stays below EXACT."""
    tiles = []
    for first in range(0, len(counts), ITEM_TILE):
        part = counts[first : first + ITEM_TILE]
        # terms of the same items next to each other: a term's column is taken in by its tile if no row gets too heavy
        vocabulary = sorted({t for c in part for t in c if weights[t] > 0})
        columns, heavy = [], np.zeros(len(part), np.int64)

        def close():
            if columns:
                # rows without a weight in these columns need no product
                used = sorted({i for _, entries in columns for i, _ in entries})
                place = {i: k for k, i in enumerate(used)}
                dense = np.zeros((len(used), len(columns)))
                for k, (_, entries) in enumerate(columns):
                    for i, w in entries:
                        dense[place[i], k] = w
                tiles.append(Tile(np.array(used) + first, np.array([t for t, _ in columns]), dense))
            columns.clear()
            heavy[:] = 0

        for t in vocabulary:
            left = {i: c[t] for i, c in enumerate(part) if t in c}
            while left:
                # an item may repeat a term so often that one column cannot hold its weight: the rest goes to the next tile
                room = (EXACT // MOST - 1 - heavy) // weights[t]
                now = [(i, min(n, int(room[i]))) for i, n in left.items() if room[i] > 0]
                if now and len(columns) < TERM_TILE:
                    columns.append((t, [(i, n * int(weights[t])) for i, n in now]))
                    for i, n in now:
                        heavy[i] += n * int(weights[t])
                        left[i] -= n
                    left = {i: n for i, n in left.items() if n}
                if left:
                    close()
        close()
    return tiles


def impacts(rows: list[tuple[int, np.ndarray, np.ndarray]], size: int, n_docs: int, n_terms: int) -> np.ndarray:
    """Dense impacts (terms x documents) of rows (n, terms, tfs), whole numbers below MOST."""
    out = np.zeros((size, len(rows)))
    for k, (n, terms, tfs) in enumerate(rows):
        m = 100 - SCALE + (SCALE * n * n_docs) // n_terms
        tf = tfs.astype(np.int64)
        out[terms, k] = (IMPACT * tf) // (SATURATION * tf + SLOPE * m)
    return out


def best(scores: np.ndarray, ids: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``top`` highest scores above 0 and their ids, equal scores by ascending id."""
    if len(scores) > top:
        # everything that ties with the last place is looked at
        least = max(1, int(np.partition(scores, len(scores) - top)[len(scores) - top]))
    else:
        least = 1
    at = np.flatnonzero(scores >= least)
    at = at[np.lexsort((ids[at], -scores[at]))[:top]]
    return scores[at], ids[at]


NO_ID = np.iinfo(np.int64).max  # a null doc_id while scores are compared


def best_of_tasks(rows: DataFrame, tiles: list[Tile], size: int, n_items: int, n_docs: int, n_terms: int, top: int) -> DataFrame:
    """(item, doc_id, score): for each item the best documents of each task."""
    shared = rows.sparkSession.sparkContext.broadcast(tiles)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.empty(0, np.int64)
        kept = [(none, none)] * n_items

        def take(part: list, ids: list[int]):
            dense, own = impacts(part, size, n_docs, n_terms), np.array(ids, np.int64)
            total = np.zeros((n_items, len(part)), np.int64)
            for tile in shared.value:
                columns = dense[tile.terms]
                total[tile.items] += (tile.weights @ columns).astype(np.int64)
            for i in np.flatnonzero(total.max(axis=1) > 0).tolist():
                last = kept[i][0][-1] if len(kept[i][0]) == top else 0
                at = np.flatnonzero((total[i] > 0) & (total[i] >= last))
                if len(at):
                    kept[i] = best(np.concatenate((kept[i][0], total[i][at])), np.concatenate((kept[i][1], own[at])), top)

        part, ids = [], []
        for batch in batches:
            terms, tfs, n = batch.column("terms"), batch.column("tfs"), batch.column("n").to_pylist()
            for k, doc_id in enumerate(batch.column("doc_id").to_pylist()):
                t = terms[k].values
                if len(t):
                    part.append((n[k], t.to_numpy(), tfs[k].values.to_numpy()))
                    ids.append(NO_ID if doc_id is None else doc_id)
                if len(part) == DOC_TILE:
                    take(part, ids)
                    part, ids = [], []
        if part:
            take(part, ids)
        item = np.repeat(np.arange(n_items), [len(s) for s, _ in kept])
        found_ids = np.concatenate([i for _, i in kept])
        yield pa.RecordBatch.from_arrays(
            [pa.array(item, pa.int32()), pa.array(found_ids, pa.int64(), mask=found_ids == NO_ID), pa.array(np.concatenate([s for s, _ in kept]), pa.int64())],
            ["item", "doc_id", "score"])

    return rows.select("doc_id", "n", "terms", "tfs").mapInArrow(score, "item int, doc_id bigint, score bigint")


def search(docs: DataFrame, items: DataFrame, area, top: int = 20) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents with a score above 0 for each row of ``items`` (item_id, text).

    Null and empty texts have no terms: such documents count in no statistic and are never found, such items find nothing. Equal
    scores rank by ascending doc_id, rows without one last; rows that repeat an id are ranked each. Texts of any length are read
    whole. Rows of items that repeat an id are ranked each. Other columns are ignored; empty tables give an empty result.
    """
    spark, result = docs.sparkSession, None
    for number, batch in enumerate(item_batches(items)):
        vocabulary: dict[bytes, int] = {}
        counts = [dict(Counter(vocabulary.setdefault(t, len(vocabulary)) for t in terms_of(text))) for _, text in batch]
        rows = area.table(narrow_docs(docs, vocabulary), f"search_docs{number}")
        n_docs, n_terms = rows.where("n > 0").agg(F.count("*"), F.sum("n")).first()
        if not n_docs or not vocabulary:
            continue
        tiles = tiles_of(counts, weights_of(document_frequencies(rows, len(vocabulary)), n_docs))
        found = best_of_tasks(rows, tiles, len(vocabulary), len(batch), n_docs, n_terms, top)
        found = area.table(found, f"search_found{number}")
        order = [F.desc("score"), F.asc_nulls_last("doc_id")]
        # an item has a few rows of each task: they are thinned out in parts before they meet
        salt = F.pmod(F.xxhash64("doc_id", "score"), F.lit(SALTS))
        some = found.withColumn("salt", salt).withColumn("rank", F.row_number().over(Window.partitionBy("item", "salt").orderBy(*order))).where(F.col("rank") <= top)
        last = some.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= top)
        names = spark.createDataFrame([(k, item_id) for k, (item_id, _) in enumerate(batch)], f"item int, item_id {items.schema['item_id'].dataType.simpleString()}")
        part = last.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
        result = part if result is None else result.unionByName(part)
    if result is None:
        result = items.select("item_id", F.lit(1).alias("rank"), F.lit(None).cast("bigint").alias("doc_id"), F.lit(None).cast("bigint").alias("score")).limit(0)
    return result
