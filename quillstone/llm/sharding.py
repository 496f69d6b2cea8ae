"""Sharding by a permutation-filled lookup table.

Every shard has its own preference order over the slots of a prime-sized table (an offset and a
skip, both from its name); shards take turns claiming their next free slot until the table is full.
Placing a row is one lookup of its key's slot, so adding or removing a shard moves few keys.

Defined results: a null key counts as an empty one; callers that expect many give them another key,
as the query does with the text; repeated rows go to the same shard; a table with no rows gives none.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Primes; the table has SLOTS rows whatever the data, which bounds the broadcast.
SLOTS = 65_537


def fill(shards: list[str], slots: int = SLOTS) -> list[int]:
    """The shard's number for each slot."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shard names must be distinct, and at least one")
    if slots < 2 or any(slots % i == 0 for i in range(2, int(slots**0.5) + 1)):
        raise ValueError("slots must be prime")
    walks = []
    for name in shards:
        d = hashlib.md5(name.encode()).digest()
        walks.append([int.from_bytes(d[:8], "big") % slots, int.from_bytes(d[8:], "big") % (slots - 1) + 1])
    owner, left = [-1] * slots, slots
    while left:
        for k, walk in enumerate(walks):
            while owner[walk[0]] >= 0:
                walk[0] = (walk[0] + walk[1]) % slots
            owner[walk[0]] = k
            left -= 1
            if not left:
                break
    return owner


def lookup(spark: SparkSession, shards: list[str], slots: int = SLOTS) -> DataFrame:
    """slot, shard: the filled table."""
    return spark.createDataFrame(list(enumerate(fill(shards, slots))), "slot int, shard int")


def slot(key: Column, slots: int = SLOTS) -> Column:
    """The first 32 bits of the key's MD5, modulo slots."""
    return (F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 8), 16, 10).cast("long") % slots).cast("int")


def place(df: DataFrame, key: Column, shards: list[str], slots: int = SLOTS, columns: list | None = None) -> DataFrame:
    """columns (all of df's by default) with slot and shard after them; columns of those names in df give way."""
    table = F.broadcast(lookup(df.sparkSession, shards, slots).select(F.col("slot").alias("__slot"), F.col("shard").alias("__shard")))
    keyed = df.select(*(columns or [df[c] for c in df.columns if c not in ("slot", "shard")]), slot(key, slots).alias("__at"))
    joined = keyed.join(table, keyed["__at"] == table["__slot"])
    names = [c for c in keyed.columns if c != "__at"]
    return joined.select(*[keyed[c] for c in names], F.col("__at").alias("slot"), F.col("__shard").alias("shard"))
