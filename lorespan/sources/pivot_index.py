"""Vectors stored by their nearest pivot and the distance to it, for exact search that skips row groups.

Files hold runs of (pivot, reach), so the minima and maxima of a row group are a cell and a narrow range of
distances to its pivot. By the triangle inequality a vector within r of a question q lies, in the cell of pivot p, at a
reach from d(q, p) - r to d(q, p) + r; and as its own pivot is nearest, the cell of p holds such a vector only if
d(q, p) - d(q, nearest pivot) is at most 2 r. The radius r is a bound of the k-th distance from stored samples.
These ranges are a filter on plain columns, which reaches the scan. Hits are those of the flat search: what is skipped
can't be a hit. How much is skipped depends on the vectors: clusters are, vectors without any structure are not.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from lorespan.operators import knn
from lorespan.operators.knn import MICRO, matrix_of
from lorespan.session import materialize, slots

#: Vectors that pivots are chosen from (those with the smallest hashes of their ids), and pivots at most.
CHOSEN_FROM, PIVOTS = 4096, 64
#: Bytes of a row group, and ranges of reach a cell is asked for at most.
ROW_GROUP_BYTES, RANGES = 1 << 20, 8
#: Rows whose differences from a pivot are held together.
_ROWS = 1024


def choose_pivots(vectors: DataFrame, count: int = PIVOTS) -> np.ndarray:
    """Vectors far from one another: each next one is the farthest from those before, among a bounded sample."""
    order = [F.xxhash64("vid"), F.col("vid").cast("string")]
    sample = vectors.where("vid IS NOT NULL").orderBy(*order).limit(CHOSEN_FROM).toArrow()
    x = matrix_of(sample.column("vvec"), sample.column("vid")).astype(np.float64)
    if not len(x):
        return x
    chosen, far = [0], np.linalg.norm(x - x[0], axis=1)
    while len(chosen) < count and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, np.linalg.norm(x - x[chosen[-1]], axis=1))
    return x[chosen]


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances of rows to pivots, by differences so that small ones are exact too; a few rows at a time."""
    far = np.empty((len(x), len(pivots)))
    for at in range(0, len(x), _ROWS):
        for cell, p in enumerate(pivots):
            far[at : at + _ROWS, cell] = np.linalg.norm(x[at : at + _ROWS] - p, axis=1)
    return far


def build(vectors: DataFrame, path: str, vector_id: str = "chunk_id", embedding: str = "embedding", pivots: int = PIVOTS) -> None:
    """Write ``path/vectors`` (``vid, vvec, pivot, reach``), ``path/pivots`` and the sample ``path/sample``.

    Every vector is read three times and shuffled once. A cell, and a run of equal vectors, is dealt to as many files as its
    size asks for, since ids take part in the order.
    """
    spark = vectors.sparkSession
    plain = vectors.select(F.col(vector_id).alias("vid"), F.col(embedding).cast("array<float>").alias("vvec"))
    chosen = choose_pivots(plain, pivots)
    rows = [(k, p.tolist()) for k, p in enumerate(chosen)]
    spark.createDataFrame(rows, "pivot int, vector array<double>").coalesce(1).write.mode("overwrite").parquet(f"{path}/pivots")

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                far = _distances(matrix_of(batch.column("vvec"), batch.column("vid")).astype(np.float64), chosen)
                own = far.argmin(axis=1)
                columns = [*batch.columns, pa.array(own.astype(np.int32)), pa.array(far[np.arange(len(own)), own])]
                yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "pivot", "reach"])

    schema = StructType([*plain.schema.fields, StructField("pivot", IntegerType()), StructField("reach", DoubleType())])
    placed = plain.mapInArrow(assign, schema)
    order = ["pivot", "reach", "vid"]
    files = max(slots(spark), plain.rdd.getNumPartitions())
    (
        placed.repartitionByRange(files, *order)
        .sortWithinPartitions(*order)
        .write.mode("overwrite")
        .option("parquet.block.size", str(ROW_GROUP_BYTES))
        .parquet(f"{path}/vectors")
    )
    sample = plain.where(F.pmod(F.xxhash64("vid"), F.lit(knn.SAMPLE_RATIO)) == 0)
    sample.write.mode("overwrite").parquet(f"{path}/sample")


def _merged(low: np.ndarray, high: np.ndarray) -> list[list[float]]:
    """Ranges that overlap or touch as one, in ascending order."""
    if not len(low):
        return []
    order = np.argsort(low, kind="stable")
    low, high = low[order], np.maximum.accumulate(high[order])
    first = np.flatnonzero(np.r_[True, low[1:] > high[:-1]])
    return [list(pair) for pair in zip(low[first].tolist(), high[np.r_[first[1:] - 1, len(high) - 1]].tolist())]


def wanted_ranges(questions: np.ndarray, radius: np.ndarray, pivots: np.ndarray) -> dict[int, list[tuple[float, float]]]:
    """Ranges of reach, a few of every cell, outside of which no vector is within ``radius`` of its question."""
    far = _distances(questions, pivots)
    slack = 1e-6 * (1.0 + far.max(initial=0.0))
    near = far.min(axis=1)
    out: dict[int, list[tuple[float, float]]] = {}
    for cell in range(len(pivots)):
        open_ = far[:, cell] - near <= 2 * radius + slack
        low, high = far[open_, cell] - radius[open_] - slack, far[open_, cell] + radius[open_] + slack
        merged = _merged(low, high)
        while len(merged) > RANGES:  # close the smallest gap
            at = min(range(len(merged) - 1), key=lambda k: merged[k + 1][0] - merged[k][1])
            merged[at : at + 2] = [[merged[at][0], merged[at + 1][1]]]
        if merged:
            out[cell] = [(a, b) for a, b in merged]
    return out


def range_filter(ranges: dict[int, list[tuple[float, float]]]) -> Column:
    parts = [
        (F.col("pivot") == cell) & (F.col("reach") >= max(a, 0.0)) & (F.col("reach") <= min(b, 1e300))
        for cell, own in ranges.items()
        for a, b in own
    ]

    def either(ways: list[Column]) -> Column:  # balanced, so that the expression stays flat
        return ways[0] if len(ways) == 1 else either(ways[: len(ways) // 2]) | either(ways[len(ways) // 2 :])

    return either(parts) if parts else F.lit(False)


def search(
    questions: DataFrame,
    path: str,
    k: int,
    question_id: str = "question_id",
    vector_id: str = "chunk_id",
    embedding: str = "embedding",
    broadcast_bytes: int = knn.BROADCAST_BYTES,
) -> DataFrame:
    """The k nearest vectors of each question, as ``knn_join`` gives them: ``question_id, rank, vector_id, distance``.

    Questions are cut into blocks of ``broadcast_bytes`` in the order of their nearest pivots, so that a block asks for few
    cells; a block is one filtered scan.
    """
    spark = questions.sparkSession
    stored, sample = spark.read.parquet(f"{path}/vectors"), spark.read.parquet(f"{path}/sample")
    left = materialize(questions.select(F.col(question_id).alias("qid"), F.col(embedding).cast("array<float>").alias("qvec")), "questions")
    schema = StructType(
        [StructField("question_id", left.schema["qid"].dataType), StructField("id", stored.schema["vid"].dataType), StructField("micros", LongType())]
    )
    pivots = np.array([r["vector"] for r in spark.read.parquet(f"{path}/pivots").orderBy("pivot").collect()])
    flat = stored.select("vid", "vvec")
    found: list[DataFrame] = []
    for part in _parts(left, pivots, broadcast_bytes):
        bounds = knn._bounds(part, [sample], k, schema)
        radius = np.sqrt((bounds + 1) / MICRO)
        matrix = matrix_of(part.column("qvec"), part.column("qid")).astype(np.float64)
        rows = flat
        if len(pivots) and part.num_rows:
            rows = stored.where(range_filter(wanted_ranges(matrix, radius, pivots))).select("vid", "vvec")
        found.append(knn._search_in_place(part, rows, k, schema, bounds))
    return knn.ranked(reduce(DataFrame.unionByName, found), k, question_id, vector_id)


def _parts(left: DataFrame, pivots: np.ndarray, broadcast_bytes: int) -> Iterator[pa.Table]:
    """The questions in blocks of bounded size; a block holds those of the same or of neighbouring nearest pivots."""

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                own = _distances(matrix_of(batch.column("qvec"), batch.column("qid")).astype(np.float64), pivots).argmin(axis=1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own.astype(np.int32))], [*batch.schema.names, "cell"])

    twice = left.groupBy("qid").agg(F.count("*").alias("n")).where("n > 1").first()
    if twice is not None:
        raise ValueError(f"question id {twice['qid']!r} comes more than once")
    if not len(pivots):
        yield left.toArrow()
        return
    placed = materialize(left.mapInArrow(nearest, StructType([*left.schema.fields, StructField("cell", IntegerType())])), "placed")
    size = F.size("qvec") * 4 + F.octet_length(F.col("qid").cast("string")) + 16
    cells = placed.groupBy("cell").agg(F.sum(size).alias("bytes")).orderBy("cell").collect()  # a row a pivot at most
    if not cells:
        yield left.toArrow()
    together: list[int] = []
    held = 0
    for at, (cell, total) in enumerate((r["cell"], r["bytes"]) for r in cells):
        together.append(cell)
        held += total
        if at + 1 < len(cells) and held + cells[at + 1]["bytes"] <= broadcast_bytes:
            continue
        own = placed.where(F.col("cell").isin(together)).drop("cell")
        blocks = max(1, -(-held // broadcast_bytes))  # more than one for a single large cell only
        for block in range(blocks):
            part = own if blocks == 1 else own.where(F.pmod(F.xxhash64("qid"), F.lit(blocks)) == block)
            table = part.toArrow()
            if table.num_rows:
                yield table
        together, held = [], 0
