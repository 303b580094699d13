"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lorespan.session import materialize, scratch_path

#: Bits of the membership filter of ``IdFilter`` for each id, and its least and greatest size: 2 MB and 32 MB.
BITS_PER_ID, LEAST_BITS, MOST_BITS = 8, 1 << 24, 1 << 28


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def arrow_map(df: DataFrame, function: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` for a function of one batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from function(batch)

    return df.mapInArrow(run, schema)


def list_array(values: np.ndarray, lengths: list[int] | np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from the concatenated values and the length of each list."""
    offsets = np.zeros(len(lengths) + 1, dtype=np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


@contextmanager
def discarded(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """``df`` written to the scratch folder for use inside the block, and deleted after it."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def signed(hashes: np.ndarray) -> np.ndarray:
    return hashes.view(np.int64)


class IdFilter:
    """A membership filter over ids in a bit array of bounded size, for skipping rows before costly work.

    It may let other rows pass, so a join on the ids has to follow; it never stops a member. The bit
    array is built by a Spark aggregate and sent to tasks; its size follows the number of ids up to ``MOST_BITS``.
    """

    def __init__(self, ids: DataFrame, column: str, bits: int | None = None) -> None:
        if bits is None:
            bits = min(max(LEAST_BITS, 1 << (BITS_PER_ID * ids.count()).bit_length()), MOST_BITS)
        self.bits = bits
        slot = self.slot(F.col(column))
        rows = (
            ids.select(slot.alias("slot"))
            .groupBy(F.expr("bitmap_bucket_number(slot)").alias("bucket"))
            .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(slot))").alias("bitmap"))
            .collect()  # at most bits / 32768 rows of 4 KB
        )
        packed = np.zeros(bits // 8 + 4096, dtype=np.uint8)
        for row in rows:
            start = (row["bucket"] - 1) * 4096
            packed[start : start + 4096] = np.frombuffer(row["bitmap"], np.uint8)
        self._packed = ids.sparkSession.sparkContext.broadcast(packed)

    def slot(self, column: Column) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(self.bits)) + F.lit(1)

    def tester(self) -> Callable[[np.ndarray], np.ndarray]:
        """A function for tasks: which of these slots are marked. ``bitmap_bit_position`` counts from 0 for slot 1."""
        packed = self._packed

        def test(slots_: np.ndarray) -> np.ndarray:
            place = slots_ - 1
            return (packed.value[place >> 3] >> (place & 7) & 1).astype(bool)

        return test


__all__ = ["IdFilter", "arrow_map", "list_array", "discarded", "materialize", "signed", "table"]
