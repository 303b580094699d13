"""Joins against a side that is unique on the key, safe against hot keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALTS = 16
HOT_ROWS = 1_000_000
MOST_HOT_KEYS = 10_000
SMALL_TABLE_ROWS = 10_000
#: Bits of the filter of ``possible_rows``: at most half a million rows of a word of 64 bits are broadcast.
FILTER_BITS = 1 << 25


def salted_lookup(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    spread_by: list[str],
    how: str = "left",
    salts: int = SALTS,
) -> DataFrame:
    """``left JOIN right`` for a narrow ``right`` with one row per key.

    The rows of a key on the left are spread over ``salts`` partitions by the hash of ``spread_by``,
    columns that tell the rows of one key apart; each row on the right is repeated once per salt. A
    key that holds a third of the left side then costs a task a third / ``salts`` of it. Spark may
    still broadcast the right side where it is small.
    """
    salt = F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int")
    repeated = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.withColumn("_salt", salt).join(repeated, [*on, "_salt"], how).drop("_salt")


def hot_key_lookup(
    left: DataFrame,
    right: DataFrame,
    on: str,
    counts: DataFrame,
    spread_by: list[str],
    how: str = "left",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``left JOIN right`` for a wide ``right`` with one row per key: only hot keys are salted.

    ``counts`` holds ``on, n``, the rows per key on the left. A key is hot above ``hot_rows`` rows and
    above one part in ``MOST_HOT_KEYS`` of all rows, so there are never more than ``MOST_HOT_KEYS``
    of them and the broadcast list of hot keys is bounded. All other keys join unsalted, once.
    """
    total = counts.agg(F.sum("n")).scalar()
    part = F.greatest(F.lit(float(hot_rows)), total / F.lit(float(MOST_HOT_KEYS)))
    hot = F.broadcast(
        counts.filter(F.col("n") > part).select(F.col(on), F.ceil(F.col("n") / F.lit(hot_rows)).cast("int").alias("_parts"))
    )
    parts = F.coalesce("_parts", F.lit(1))
    left = left.join(hot, on, "left").withColumn("_salt", F.pmod(F.xxhash64(*spread_by), parts).cast("int"))
    right = right.join(hot, on, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), parts - 1)))
    return left.drop("_parts").join(right.drop("_parts"), [on, "_salt"], how).drop("_salt")


def possible_rows(table: DataFrame, on: str, wanted: DataFrame) -> DataFrame:
    """Rows of ``table`` whose ``on`` may be among that of ``wanted``; an equality join has to follow.

    A Bloom filter of ``FILTER_BITS`` bits is built by an aggregate (words of 64 bits, or-ed) and broadcast as
    rows, so its size is fixed at any number of ids. Rows are tested where they are read. Up to some ten million ids it keeps few
    others; with very many more it keeps most rows, and costs a lookup each. Rows with a null ``on`` go.
    """
    kind = wanted.schema[on].dataType
    slot = F.pmod(F.xxhash64(F.col(on).cast(kind)), F.lit(FILTER_BITS))
    words = (
        wanted.where(F.col(on).isNotNull())
        .select(slot.alias("_slot"))
        .groupBy(F.expr("_slot div 64").alias("_word"))
        .agg(F.expr("bit_or(shiftleft(1L, int(_slot % 64)))").alias("_bits"))
    )
    marked = table.where(F.col(on).isNotNull()).withColumn("_slot", slot).withColumn("_word", F.expr("_slot div 64"))
    found = marked.join(F.broadcast(words), "_word").where("bit_get(_bits, int(_slot % 64)) = 1")
    return found.drop("_word", "_bits", "_slot")


def rows_if_small(table: DataFrame, limit: int = SMALL_TABLE_ROWS) -> list | None:
    """The rows of a table that has at most ``limit`` of them, else None; never fetches more."""
    rows = table.limit(limit + 1).collect()
    return rows if len(rows) <= limit else None
