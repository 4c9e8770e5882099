"""Placement of documents on shards by a lookup table filled from permutations.

Every shard has a preference order over the slots of a table of prime size. Shards take turns, each claiming its next
preferred slot that is free, until the table is full: shares differ by one slot at most, and few slots change when a
shard is added. A document's key is hashed to a slot; the table is broadcast, so a placement is one lookup.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHARDS = 64
TABLE_SIZE = 65_537  # prime, over a hundred slots a shard; it bounds the broadcast, whatever the data


def preference(shard: str, size: int) -> tuple[int, int]:
    """Start and step of the walk of a shard through the table; any step from 1 to size - 1 visits all slots of a prime table."""
    digest = hashlib.md5(shard.encode()).hexdigest()
    return int(digest[:15], 16) % size, int(digest[16:31], 16) % (size - 1) + 1


def fill(shards: list[str], size: int) -> list[int]:
    """The position in ``shards`` that holds each slot."""
    if size < 2 or any(size % k == 0 for k in range(2, int(size**0.5) + 1)):
        raise ValueError("the table size must be prime")
    if not 0 < len(shards) <= size or len(set(shards)) != len(shards):
        raise ValueError("shards must be distinct, at least one and no more than slots")
    walks = [preference(s, size) for s in shards]
    at, steps, table, free = [start for start, _ in walks], [step for _, step in walks], [-1] * size, size
    while free:
        for k in range(len(shards)):
            while table[at[k]] >= 0:
                at[k] = (at[k] + steps[k]) % size
            table[at[k]] = k
            free -= 1
            if not free:
                break
    return table


def lookup(spark: SparkSession, shards: list[str], size: int = TABLE_SIZE) -> DataFrame:
    """(slot, shard): the filled table, of ``size`` rows."""
    owners = F.split(F.lit(",".join(map(str, fill(shards, size)))), ",")
    names = F.array(*map(F.lit, shards))
    return spark.range(1).select(F.posexplode(owners).alias("slot", "owner")).select(
        "slot", F.get(names, F.col("owner").cast("int")).alias("shard"))


def slot_of(key: Column, size: int = TABLE_SIZE) -> Column:
    """The slot of a key: 60 bits of its digest, modulo the table size. A null key counts as an empty one."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return (F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("bigint") % size).cast("int")


def place(docs: DataFrame, shards: list[str], key: str = "doc_id", size: int = TABLE_SIZE) -> DataFrame:
    """``docs`` with their slot and shard, without a shuffle; clashing columns ``slot`` and ``shard`` are replaced.

    Equal keys, repeated rows among them, meet on one shard.
    """
    placed = docs.drop("shard").withColumn("slot", slot_of(docs[key], size))
    placed = placed.join(F.broadcast(lookup(docs.sparkSession, shards, size)), "slot")
    return placed.select(*[c for c in docs.columns if c not in ("slot", "shard")], "slot", "shard")


def shard_names(n: int = SHARDS) -> list[str]:
    return [f"shard-{k:05d}" for k in range(n)]
