"""Token counts by byte-pair merging.

A text is cut at special strings and into pieces; each distinct piece is merged once with a heap over a linked list, and
its count is its symbols less the merges made. No identifiers are looked up.
"""

from __future__ import annotations

import heapq
import json
from collections import Counter
from collections.abc import Callable

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

# How byte-level vocabularies cut a text into pieces.
PIECES = r"'(?:s|t|re|ve|m|ll|d)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CACHED_PIECES = 200_000  # pieces that a worker remembers; beyond, it starts afresh
CACHED_LENGTH = 64  # longer pieces are merged each time


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself where it prints, else the next one from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    free = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(free)) for b in range(256)]


def read_merges(path: str) -> tuple[dict[tuple[str, str], int], list[str]]:
    """Rank of each pair, and the special strings, of a byte-level BPE file."""
    with open(path, encoding="utf-8") as file:
        found = json.load(file)
    pairs = [tuple(p.split(" ")) if isinstance(p, str) else tuple(p) for p in found["model"]["merges"]]
    return {p: rank for rank, p in enumerate(pairs)}, [t["content"] for t in found["added_tokens"]]


def count_merged(symbols: list[str], ranks: dict[tuple[str, str], int]) -> int:
    """Symbols left when the adjacent pair of the lowest rank, the leftmost of equals, is merged again and again."""
    n = left = len(symbols)
    if n < 2:
        return n
    after, before = [*range(1, n), -1], [*range(-1, n - 1)]
    heap = [(ranks[p], i, *p) for i in range(n - 1) if (p := (symbols[i], symbols[i + 1])) in ranks]
    heapq.heapify(heap)
    while heap:
        _, i, a, b = heapq.heappop(heap)
        j = after[i]
        if symbols[i] != a or j < 0 or symbols[j] != b:
            continue  # one of the two was merged meanwhile
        symbols[i], symbols[j] = a + b, ""
        left -= 1
        after[i] = k = after[j]
        if k >= 0:
            before[k] = i
            if (p := (a + b, symbols[k])) in ranks:
                heapq.heappush(heap, (ranks[p], i, *p))
        h = before[i]
        if h >= 0 and (p := (symbols[h], a + b)) in ranks:
            heapq.heappush(heap, (ranks[p], h, *p))
    return left


def text_counter(ranks: dict[tuple[str, str], int], special: list[str]) -> Callable[[str], int]:
    cut = regex.compile(PIECES)
    specials = regex.compile("|".join(regex.escape(s) for s in sorted(special, key=len, reverse=True))) if special else None
    symbols = byte_symbols()
    held: dict[str, int] = {}

    def of_piece(piece: str) -> int:
        found = held.get(piece)
        if found is None:
            found = count_merged([symbols[b] for b in piece.encode()], ranks)
            if len(piece) <= CACHED_LENGTH:
                if len(held) >= CACHED_PIECES:
                    held.clear()
                held[piece] = found
        return found

    def of_text(text: str) -> int:
        total, parts = 0, [text]
        if specials:
            parts = specials.split(text)
            total = len(parts) - 1
        for part in parts:
            total += sum(n * of_piece(p) for p, n in Counter(cut.findall(part)).items())
        return total

    return of_text


def token_count(text: Column, path: str, df: DataFrame) -> Column:
    """Tokens of each text under the vocabulary at ``path``; null counts as empty.

    The file is read once on the driver and sent to the workers; its size does not depend on the data.
    """
    model = df.sparkSession.sparkContext.broadcast(read_merges(path))
    state: dict = {}

    @F.arrow_udf(LongType())
    def counted(texts: pa.Array) -> pa.Array:
        if "count" not in state:
            state["count"] = text_counter(*model.value)
        count = state["count"]
        return pa.array([count(t) for t in texts.to_pylist()], pa.int64())

    return counted(F.coalesce(text, F.lit("")))


def count_tokens(docs: DataFrame, path: str, limit: int = 1024) -> DataFrame:
    """Bytes and tokens of every text. Null and empty texts: 0 and 0. Repeated rows are counted each; other columns are ignored."""
    counted = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    counted = counted.select("doc_id", F.octet_length("text").cast("bigint").alias("n_bytes"), token_count(F.col("text"), path, docs).alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
