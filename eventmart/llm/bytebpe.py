"""Byte-level BPE encoding and decoding under a file of ranks.

Texts are packed into blocks of bounded size that name each distinct word once. The distinct words of a block are merged by turns
over all words of one length, and the block's texts are put together from those of their words. All this is one pass over the
rows of a task: nothing is shuffled, and no key can be hot.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Callable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

BLOCK_BYTES = 4 << 20  # UTF-8 bytes of text in a block; a longer document is a block of its own
LONG = 64  # bytes of a word that is merged beside others of its length
NONE = np.iinfo(np.int64).max  # the rank of a pair that is no piece
SLICE = 1 << 16  # identifiers that are decoded, and words that are put together, at once
MERGED_BYTES = 1 << 19  # bytes of words that are merged at once
# Letters and numbers that Unicode has taken in since version 16, which the vocabularies' own library goes by.
NEW_LETTERS = (
    r"\u0558\u058B-\u058C\u088F\u0C5C\u0CDC\u208F\u209D-\u209F\uA7CE-\uA7CF\uA7D2\uA7D4\uA7DD\uA7E2\uA7F1\uAB6C-\uAB6D"
    r"\U000107BB-\U000107BF\U00010940-\U00010959\U00010EC5-\U00010EC7\U00010ED9-\U00010EEE\U00011B0A\U00011DB0-\U00011DDB"
    r"\U00011DF1\U00016EA0-\U00016EB8\U00016EBB-\U00016ED3\U00016FF2-\U00016FF3\U000187F8-\U000187FF\U00018CD6-\U00018CDA"
    r"\U00018D09-\U00018D20\U00018D80-\U00018DF2\U00018E00-\U00019191\U000191A0-\U000191D2\U0001B123-\U0001B128\U0001B168"
    r"\U0001D6A6\U0001DF1F-\U0001DF24\U0001DF2B-\U0001DF81\U0001DF90-\U0001DF96\U0001DFCD-\U0001DFFF\U0001E6C0-\U0001E6DE"
    r"\U0001E6E0-\U0001E6E2\U0001E6E4-\U0001E6E5\U0001E6E7-\U0001E6ED\U0001E6F0-\U0001E6F4\U0001E6FE-\U0001E6FF"
    r"\U0002B73A-\U0002B73F\U0002B81E\U0002CEA2-\U0002CEAD\U000323B0-\U00033479\U0003D000-\U0003FC3F"
)
NEW_NUMBERS = r"\U00011DE0-\U00011DE9\U0001246F\U00012475-\U0001247F\U00012550-\U00012686\U00016FF4-\U00016FF6"


def read_ranks(path: str) -> dict[bytes, int]:
    """Rank of each piece; lines of base64 and a number."""
    with open(path, "rb") as file:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, file)}


def cutter(pattern: str) -> Callable[[str], list[str]]:
    """All matches of ``pattern``. Letters and numbers newer than the library's tables are neither, as they are to the library."""
    fresh = regex.compile(f"[{NEW_LETTERS}{NEW_NUMBERS}]")
    plain = regex.compile(pattern)

    def cut(text: str) -> list[str]:
        if text.isascii() or not fresh.search(text):
            return plain.findall(text)
        # cut where a text would be that has an unassigned character in their places
        return [text[m.start() : m.end()] for m in plain.finditer(fresh.sub("\uFFFE", text))]

    return cut


def count_pieces(piece: bytes, ranks: dict[bytes, int]) -> int:
    """Pieces that merging leaves of a piece."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        rank, k = min((ranks.get(x + y, len(ranks)), k) for k, (x, y) in enumerate(zip(parts, parts[1:])))
        if rank == len(ranks):
            break
        parts[k : k + 2] = [parts[k] + parts[k + 1]]
    return len(parts)


def merge_long(ids: list[int], pairs: dict[tuple[int, int], int]) -> list[int]:
    """``ids`` after merging, by a heap over a linked list: a long word takes about as many steps as it has bytes."""
    after, before = [*range(1, len(ids)), -1], [*range(-1, len(ids) - 1)]
    heap = [(pairs[p], i, *p) for i, p in enumerate(zip(ids, ids[1:])) if p in pairs]
    heapq.heapify(heap)
    while heap:
        new, i, a, b = heapq.heappop(heap)
        j = after[i]
        if ids[i] != a or j < 0 or ids[j] != b:
            continue  # one of the two was merged meanwhile
        ids[i], ids[j] = new, -1
        h, k = before[i], after[j]
        after[i] = k
        if k >= 0:
            before[k] = i
            if (p := (new, ids[k])) in pairs:
                heapq.heappush(heap, (pairs[p], i, *p))
        if h >= 0 and (p := (ids[h], new)) in pairs:
            heapq.heappush(heap, (pairs[p], h, *p))
    return [x for x in ids if x >= 0]


class RankMaps:
    """The ranks as arrays; their size depends on the vocabulary alone.

    ``keys`` are the pairs that can be merged, sorted, as left * 2^32 + right, both as ranks; ``merged`` has the rank of each pair
    together. ``bytes`` has the rank of each byte. ``whole`` are the pieces that merging their bytes does not lead to, but a word
    that is one is one identifier all the same.
    """

    def __init__(self, path: str):
        ranks = read_ranks(path)
        pairs = [(ranks[piece[:i]] << 32 | ranks[piece[i:]], rank) for piece, rank in ranks.items()
                 for i in range(1, len(piece)) if piece[:i] in ranks and piece[i:] in ranks]
        self.keys, self.merged = np.array(sorted(pairs), np.int64).reshape(-1, 2).T.copy()
        self.keys, self.merged = np.append(self.keys, np.iinfo(np.int64).max), np.append(self.merged, NONE)
        self.bytes = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self.whole = {piece: rank for piece, rank in ranks.items() if count_pieces(piece, ranks) > 1}

    def value(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair together, or NONE."""
        key = left << 32 | right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.merged[at], NONE)

    @cached_property
    def pairs(self) -> dict[tuple[int, int], int]:
        return {(key >> 32, key & 0xFFFFFFFF): rank for key, rank in zip(self.keys[:-1].tolist(), self.merged[:-1].tolist())}


def merge_equal(words: np.ndarray, maps: RankMaps) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The identifiers of words of one length, the rows of ``words``: (row numbers, identifiers) of those that end with as many.

    A turn merges the leftmost pair of the lowest rank in every row, so that rows that go on keep having one length.
    """
    at, ids = np.arange(len(words)), maps.bytes[words]
    values = maps.value(ids[:, :-1], ids[:, 1:])
    while ids.shape[1] > 1:
        k = values.argmin(axis=1)
        go = values[np.arange(len(at)), k] != NONE
        if not go.all():
            yield at[~go], ids[~go]
            at, ids, values, k = at[go], ids[go], values[go], k[go]
        if not len(at):
            return
        row = np.arange(len(at))
        new = values[row, k]
        width = ids.shape[1] - 1
        ids = np.where(np.arange(width) < k[:, None], ids[:, :-1], ids[:, 1:])
        ids[row, k] = new
        values = np.where(np.arange(width - 1) < k[:, None], values[:, :-1], values[:, 1:])
        left, right = np.flatnonzero(k > 0), np.flatnonzero(k < width - 1)
        values[left, k[left] - 1] = maps.value(ids[left, k[left] - 1], new[left])
        values[right, k[right]] = maps.value(new[right], ids[right, k[right] + 1])
    yield at, ids


def merge_words(spelled: np.ndarray, length: np.ndarray, maps: RankMaps) -> tuple[np.ndarray, np.ndarray]:
    """The identifiers of words, and how many each has: two adjacent pieces are merged, lowest rank and leftmost first, while any can be.

    ``spelled`` are the bytes of the words, one after the other, and ``length`` the bytes of each. Identifiers come back in the same way.
    """
    begin = np.cumsum(length) - length
    # never more identifiers than bytes: each word's lie where its bytes begin
    ids, n = np.zeros(len(spelled), np.int32), np.zeros(len(length), np.int64)
    for size in np.unique(length[(length > 0) & (length <= LONG)]):
        mine = np.flatnonzero(length == size)
        step = MERGED_BYTES // int(size)
        for k in range(0, len(mine), step):
            some = mine[k : k + step]
            for rows, found in merge_equal(spelled[begin[some, None] + np.arange(size)], maps):
                ids[begin[some[rows], None] + np.arange(found.shape[1])] = found
                n[some[rows]] = found.shape[1]
    for w in np.flatnonzero(length > LONG):
        found = merge_long(maps.bytes[spelled[begin[w] : begin[w] + length[w]]].tolist(), maps.pairs)
        ids[begin[w] : begin[w] + len(found)], n[w] = found, len(found)
    if maps.whole:
        data, most = spelled.tobytes(), max(map(len, maps.whole))
        for w in np.flatnonzero(length <= most):
            rank = maps.whole.get(data[begin[w] : begin[w] + length[w]])
            if rank is not None:
                ids[begin[w]], n[w] = rank, 1
    return ids[np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))], n


def lists_of(flat: np.ndarray, n: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()), pa.array(flat, pa.int32()))


def encode_word(word: Column, maps: RankMaps) -> Column:
    """The identifiers of a word, an array of its bytes; null stays null."""

    @F.arrow_udf("array<int>")
    def encoded(words: pa.Array) -> pa.Array:
        length = pc.fill_null(words.value_lengths(), 0).to_numpy().astype(np.int64)
        lists = lists_of(*merge_words(words.flatten().to_numpy().astype(np.uint8), length, maps))
        return pc.if_else(words.is_valid(), lists, None)

    return encoded(word)


def block_rows(docs: DataFrame, pattern: str) -> DataFrame:
    """(rows, sizes, places, spelled, lengths): neighbouring rows packed together.

    ``rows`` are the doc_ids, ``sizes`` their numbers of words, ``places`` (32-bit) the place of each word among the distinct ones,
    whose bytes lie in ``spelled``, one word after the other, ``lengths`` of each.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = cutter(pattern)
        ids, sizes, places, words, size = [], [], [], {}, 0

        def flush():
            packed = np.concatenate([np.empty(0, np.uint32), *places]).tobytes()
            spelled = [w.encode() for w in words]
            return pa.RecordBatch.from_arrays(
                [pa.array([ids], pa.list_(pa.int64())), pa.array([sizes], pa.list_(pa.int32())), pa.array([packed], pa.binary()),
                 pa.array([b"".join(spelled)], pa.binary()), pa.array([list(map(len, spelled))], pa.list_(pa.int32()))],
                ["rows", "sizes", "places", "spelled", "lengths"])

        for batch in batches:
            for doc_id, n_bytes, text in zip(*(c.to_pylist() for c in batch.columns)):
                if ids and size + n_bytes > BLOCK_BYTES:
                    yield flush()
                    ids, sizes, places, words, size = [], [], [], {}, 0
                found = cut(text)
                ids.append(doc_id)
                sizes.append(len(found))
                places.append(np.fromiter((words.setdefault(w, len(words)) for w in found), np.uint32, len(found)))
                size += n_bytes
        if ids:
            yield flush()

    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.octet_length(text).alias("n_bytes"), text.alias("text"))
    return rows.mapInArrow(pack, "rows array<bigint>, sizes array<int>, places binary, spelled binary, lengths array<int>")


def put_together(blocks: DataFrame, maps: RankMaps) -> DataFrame:
    """(doc_id, ids): the texts of blocks (rows, sizes, places, spelled, lengths), each distinct word merged once."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                rows, sizes, places, spelled, lengths = (batch.column(c)[k] for c in ("rows", "sizes", "places", "spelled", "lengths"))
                flat, length = merge_words(np.frombuffer(spelled.as_buffer(), np.uint8), lengths.values.to_numpy().astype(np.int64), maps)
                begin = np.cumsum(length) - length
                at = np.frombuffer(places.as_buffer(), np.uint32)
                ends = np.cumsum(sizes.values.to_numpy(), dtype=np.int64)
                # some texts of a block at a time, or one longer one
                first = done = 0
                while first < len(ends):
                    last = max(first + 1, int(np.searchsorted(ends, done + SLICE, "right")))
                    mine = at[done : ends[last - 1]]
                    n = length[mine]
                    # the identifiers of a word lie next to each other
                    ids = flat[np.repeat(begin[mine] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
                    total = np.concatenate([[0], np.cumsum(n)])[ends[first:last] - done]
                    texts = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], total]), pa.int32()), pa.array(ids, pa.int32()))
                    yield pa.RecordBatch.from_arrays([rows.values.slice(first, last - first), texts], ["doc_id", "ids"])
                    first, done = last, int(ends[last - 1])

    return blocks.mapInArrow(join, "doc_id bigint, ids array<int>")


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids) of each row of ``docs`` (doc_id, text) under the ranks at ``path``, each match of ``pattern`` for itself.

    Null and empty texts, and texts without a match, have no identifiers. Rows that repeat an id, and rows without one, are
    encoded each. Very long texts are blocks of their own. Other columns are ignored; an empty table gives an empty result. Every
    single byte must have a rank. The ranks travel with the task: their size does not depend on the data.
    """
    return put_together(block_rows(docs, pattern), RankMaps(path))


def decoder(path: str) -> Callable[[Column], Column]:
    """Identifiers (array<int>) to the bytes they stand for; null stays null."""
    pieces = {rank: piece for piece, rank in read_ranks(path).items()}

    @F.arrow_udf(BinaryType())
    def decode(lists: pa.Array) -> pa.Array:
        out = []
        for ids in lists:
            if not ids.is_valid:
                out.append(None)
                continue
            at = ids.values
            out.append(b"".join(b"".join(map(pieces.__getitem__, at.slice(k, SLICE).to_numpy().tolist())) for k in range(0, len(at), SLICE)))
        return pa.array(out, pa.binary())

    return decode


@F.arrow_udf(BinaryType())
def little_endian(lists: pa.Array) -> pa.Array:
    """Identifiers as unsigned 32-bit numbers, lowest byte first; null stays null."""
    return pa.array([x.values.to_numpy(zero_copy_only=False).astype("<u4").tobytes() if x.is_valid else None for x in lists], pa.binary())
