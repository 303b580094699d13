"""Sharding with a permutation-filled lookup table.

Every shard has its own permutation of the slots of a table of prime size. Shards take turns: each claims the
first slot of its permutation that is still free, until no slot is. A key goes to the shard of its slot. All
shards get nearly the same number of slots, and when one is removed few other slots change hands.

The table has a fixed size, so it is broadcast (at most ``MOST_SLOTS`` rows of two integers) and placing a key
takes one lookup, whatever the number of rows.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLOTS = 65_537
MOST_SLOTS = 655_373
SHARDS = 64


def shard_names(n: int = SHARDS) -> list[str]:
    return [f"shard-{k:05d}" for k in range(n)]


def is_prime(n: int) -> bool:
    return n > 1 and all(n % k for k in range(2, int(n**0.5) + 1))


def fill(shards: list[str], slots: int = SLOTS) -> np.ndarray:
    """Index of the shard of every slot. The order of the names does not matter: turns go by name."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards need one name each")
    if not is_prime(slots) or slots > MOST_SLOTS or slots < len(shards):
        raise ValueError(f"the table needs a prime size from the number of shards up to {MOST_SLOTS}")
    turns = sorted(range(len(shards)), key=lambda k: shards[k])
    digests = {k: sha256(shards[k].encode()).digest() for k in turns}
    place = {k: int.from_bytes(d[:8], "big") % slots for k, d in digests.items()}
    skip = {k: int.from_bytes(d[8:16], "big") % (slots - 1) + 1 if slots > 2 else 1 for k, d in digests.items()}
    owner = [-1] * slots
    left = slots
    while left:
        for k in turns:
            at = place[k]
            while owner[at] >= 0:
                at = (at + skip[k]) % slots
            owner[at] = k
            place[k] = (at + skip[k]) % slots
            left -= 1
            if not left:
                break
    return np.array(owner)


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """Slot of a key: the first 60 bits of the MD5 of its text. Null has slot 0."""
    digest = F.md5(key.cast("string").cast("binary"))
    return F.coalesce(F.conv(F.substring(digest, 1, 15), 16, 10).cast("long") % slots, F.lit(0)).cast("int")


def lookup_table(spark: SparkSession, shards: list[str], slots: int = SLOTS) -> DataFrame:
    owner = fill(shards, slots)
    rows = [(k, shards[s]) for k, s in enumerate(owner.tolist())]
    return spark.createDataFrame(rows, "slot int, shard string")


def place(df: DataFrame, key: str, shards: list[str], slots: int = SLOTS, column: str = "shard", slot: str = "slot") -> DataFrame:
    """``df`` with the shard (and slot) of every row. No row moves; equal keys, null ones too, share a shard.

    Columns of ``df`` named like the new ones are replaced. An empty table stays empty.
    """
    table = lookup_table(df.sparkSession, shards, slots).select(F.col("slot").alias(slot), F.col("shard").alias(column))
    df = df.drop(*[c for c in df.columns if c.lower() in (column.lower(), slot.lower()) and c != key])
    return df.withColumn(slot, slot_of(F.col(key), slots)).join(F.broadcast(table), slot, "left")


def write_shards(df: DataFrame, path: str, column: str = "shard", rows_per_file: int = 1_000_000) -> None:
    """Write one folder a shard. A large shard is spread over tasks by the engine's rebalancing, files stay bounded."""
    df.hint("rebalance", column).write.partitionBy(column).option("maxRecordsPerFile", rows_per_file).parquet(path)
