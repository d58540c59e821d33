"""Shard placement by a lookup table that the shards fill in turns.

Each shard has its own order of preference over the slots of a table of prime size: an offset and a step from the
digest of its name.  The shards take turns; whose turn it is claims the first free slot of its order, until the table is full.
So every shard holds the same number of slots up to one, and when a shard goes, few slots of the others move.

A row's slot is the hash of its key modulo the table's size.  The table is bounded by its size parameter (not by the
data) and is broadcast: placement is one probe, no shuffle.  Filling it takes about
size * ln(size) steps in the program, once; the main path is SQL functions and a broadcast join.

Results for odd input: a null key has the slot of the empty key; repeated rows go to the same shard; an empty table
gives an empty table; extra columns are not looked at.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

SLOTS = 65_537
SHARDS = tuple(f"shard-{i:03d}" for i in range(64))


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def preference(shard: str, slots: int) -> tuple[int, int]:
    """Offset and step of a shard's walk over the slots."""
    digest = hashlib.sha256(shard.encode()).digest()
    return int.from_bytes(digest[:8], "big") % slots, int.from_bytes(digest[8:16], "big") % (slots - 1) + 1


def lookup_table(shards=SHARDS, slots: int = SLOTS) -> list[int]:
    """Number of the shard that holds each slot."""
    names = list(shards)
    if not _is_prime(slots) or not 0 < len(set(names)) == len(names) <= slots:
        raise ValueError("needs a prime number of slots and at most as many shards, with different names")
    held = [-1] * slots
    walks = [list(preference(name, slots)) for name in names]
    free = slots
    while True:
        for number, walk in enumerate(walks):
            while held[walk[0]] >= 0:
                walk[0] = (walk[0] + walk[1]) % slots
            held[walk[0]] = number
            free -= 1
            if not free:
                return held


def table_frame(spark: SparkSession, shards=SHARDS, slots: int = SLOTS) -> DataFrame:
    """The lookup table as (slot, shard_no, shard), made by SQL functions from one literal."""
    names = F.split(F.lit("\n".join(shards)), "\n")
    numbers = F.split(F.lit(",".join(map(str, lookup_table(shards, slots)))), ",")
    one = spark.range(1).select(F.posexplode(numbers).alias("slot", "number"))
    return one.select("slot", F.col("number").cast("int").alias("shard_no"), F.element_at(names, F.col("number").cast("int") + 1).alias("shard"))


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """Slot of a key: the first 15 hexadecimal digits of its digest, modulo the number of slots."""
    digest = F.substring(F.sha2(F.coalesce(key.cast("string"), F.lit("")), 256), 1, 15)
    return (F.conv(digest, 16, 10).cast("bigint") % slots).cast("int")


def place(rows: DataFrame, key: str = "doc_id", shards=SHARDS, slots: int = SLOTS) -> DataFrame:
    """The key, slot, shard_no and shard of every row."""
    table = table_frame(rows.sparkSession, shards, slots)
    keyed = rows.select(F.col(key), slot_of(F.col(key), slots).alias("slot"))
    return keyed.join(F.broadcast(table), "slot").select(key, "slot", "shard_no", "shard")
