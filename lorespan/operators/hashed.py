"""Approximate k-nearest-neighbour join by sign hashes, with measured recall. The exact search is the default elsewhere.

A table of the hash is a few random planes through the middle of the vectors; a vector's code in it is the side of each
plane it lies on. A question asks for its own code and for the neighbouring ones, those of the planes it is
closest to first. No pair becomes a row: blocks of questions go to the tasks, which sort the vectors they read by their
codes, table by table, and compare those of a code with the questions that ask for it. Exact distances decide.

How many codes a question asks for is fitted: for a bounded sample of questions the exact hits are found, and the smallest number
that reaches ``FITTED`` of them is taken. The recall of that sample is returned with every row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from lorespan.operators import knn
from lorespan.operators.knn import NearestK, _hit_batches, matrix_of
from lorespan.session import materialize, spread

TABLES, SEED = 6, 17
#: Vectors of a code on average; the number of planes follows the number of vectors.
CODE_ROWS, MOST_PLANES = 128, 16
#: Questions whose exact hits are found (those with the smallest hashes of their ids), and the share of hits to reach.
SAMPLE_QUESTIONS, FITTED, RECALL = 512, 0.95, 0.9
#: Vectors that a task sorts by their codes at a time, and values of a matrix of costs.
HELD_ROWS, COST_VALUES = 1 << 16, 1 << 22


@dataclass(frozen=True)
class Planes:
    """``normals`` of all tables (tables x planes x dimensions) through ``middle``."""

    normals: np.ndarray
    middle: np.ndarray

    def margins(self, x: np.ndarray) -> np.ndarray:
        """Distance of every row to every plane: rows x tables x planes."""
        return np.einsum("nd,tpd->ntp", x - self.middle, self.normals)

    def codes(self, x: np.ndarray) -> np.ndarray:
        """The code of every row in every table."""
        return (self.margins(x) > 0) @ (1 << np.arange(self.normals.shape[1]))

    def costs(self, x: np.ndarray) -> np.ndarray:
        """What a row pays to ask for the code that flips the given planes: rows x tables x flips."""
        flips = np.arange(1 << self.normals.shape[1])
        return (self.margins(x) ** 2) @ ((flips[:, None] >> np.arange(self.normals.shape[1])) & 1).T.astype(float)

    def cost_of(self, margins: np.ndarray, code: int) -> np.ndarray:
        """What rows pay to ask for a code of one table, from their margins in it."""
        bits = ((int(code) >> np.arange(margins.shape[1])) & 1).astype(bool)
        return np.where((margins > 0) != bits, margins**2, 0.0).sum(axis=1)

    def rows_together(self) -> int:
        """Rows whose costs are held at a time."""
        return max(1, COST_VALUES // (self.normals.shape[0] << self.normals.shape[1]))

    def asked(self, x: np.ndarray) -> np.ndarray:
        """All codes of every table, rows x tables x codes, in the order a row asks for them: least margins flipped first."""
        planes = self.normals.shape[1]
        flips = np.arange(1 << planes)
        flipped = (flips[:, None] >> np.arange(planes)) & 1
        margins = self.margins(x)
        cost = (margins**2) @ flipped.T.astype(float)
        order = np.argsort(cost, axis=2, kind="stable")
        own = (margins > 0) @ (1 << np.arange(planes))
        return own[:, :, None] ^ flips[order]


def fit_planes(vectors: DataFrame, rows: int, tables: int = TABLES) -> Planes:
    """Planes through the mean of the vectors; their number gives codes of about ``CODE_ROWS`` vectors."""
    planes = int(np.clip(np.ceil(np.log2(max(rows, 1) / CODE_ROWS)), 1, MOST_PLANES))
    means = vectors.select(F.posexplode("vvec").alias("at", "x")).groupBy("at").agg(F.avg("x").alias("mean")).orderBy("at").collect()
    middle = np.array([r["mean"] for r in means])  # a row a dimension
    normals = np.random.default_rng(SEED).standard_normal((tables, planes, len(middle)))
    return Planes(normals / np.linalg.norm(normals, axis=2, keepdims=True), middle)


def _with_limits(left: DataFrame, planes: Planes, probes: int) -> DataFrame:
    """Questions with ``limits``: per table the cost up to which they ask for codes, that of the last of ``probes``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = planes.rows_together()
        for batch in batches:
            for a in range(0, batch.num_rows, step):
                rows = batch.slice(a, step)
                costs = planes.costs(matrix_of(rows.column("qvec"), rows.column("qid")).astype(np.float64))
                limits = np.partition(costs, probes - 1, axis=2)[:, :, probes - 1]
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(list(limits))], [*rows.schema.names, "limits"])

    return left.mapInArrow(run, StructType([*left.schema.fields, StructField("limits", ArrayType(DoubleType()))]))


def _search_by_codes(block: pa.Table, right: DataFrame, k: int, planes: Planes, schema: StructType) -> DataFrame:
    """One pass over the vectors with the questions broadcast."""
    ids = block.column("qid").combine_chunks()
    limits = np.array(block.column("limits").combine_chunks().flatten()).reshape(len(ids), planes.normals.shape[0])
    shared = right.sparkSession.sparkContext.broadcast((ids, matrix_of(block.column("qvec"), ids), limits))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        question_ids, matrix, most = shared.value
        best = NearestK(matrix, k)
        margins = planes.margins(matrix.astype(np.float64)) if len(matrix) else None

        def offer(held: list[pa.RecordBatch]) -> None:
            vids = pa.concat_arrays([b.column("vid") for b in held])
            x = np.concatenate([matrix_of(b.column("vvec"), b.column("vid")) for b in held])
            codes = planes.codes(x.astype(np.float64))
            for table in range(codes.shape[1]):
                order = np.argsort(codes[:, table], kind="stable")
                found, starts = np.unique(codes[order, table], return_index=True)
                for code, a, b in zip(found, starts, [*starts[1:], len(order)]):
                    asking = np.flatnonzero(planes.cost_of(margins[:, table], code) <= most[:, table] * (1 + 1e-12))
                    if len(asking):
                        best.offer_to(asking, x[order[a:b]], vids.take(pa.array(order[a:b])))

        held: list[pa.RecordBatch] = []
        for batch in batches:
            if batch.num_rows and len(matrix):
                held.append(batch)
                if sum(b.num_rows for b in held) >= HELD_ROWS:
                    offer(held)
                    held = []
        if held:
            offer(held)
        if best.pending:
            yield from _hit_batches(best, question_ids).to_batches(max_chunksize=10_000)

    return spread(right, "vid").mapInArrow(search, schema)


def hashed_knn(
    questions: DataFrame,
    vectors: DataFrame,
    k: int,
    question_id: str = "question_id",
    vector_id: str = "chunk_id",
    embedding: str = "embedding",
    least_recall: float = RECALL,
    broadcast_bytes: int = knn.BROADCAST_BYTES,
) -> DataFrame:
    """Up to k near vectors of each question: ``question_id, rank, vector_id, distance, recall``.

    ``recall`` is the share of the exact hits of a sample of the questions that the result holds; below ``least_recall`` the
    call fails. Ids have to be unique. Without questions or vectors the result is empty.
    """
    right = vectors.select(F.col(vector_id).alias("vid"), F.col(embedding).cast("array<float>").alias("vvec"))
    left = questions.select(F.col(question_id).alias("qid"), F.col(embedding).cast("array<float>").alias("qvec"))
    left = materialize(left, "questions")
    planes = fit_planes(right, right.count())
    chosen = left.orderBy(F.xxhash64("qid"), F.col("qid").cast("string")).limit(SAMPLE_QUESTIONS)
    exact = materialize(knn.knn_join(chosen, right, k, "qid", "vid", embedding="qvec", vector_embedding="vvec"), "exact")
    probes = _probes(left, right, exact, planes)

    left = materialize(_with_limits(left, planes, probes), "asked")
    schema = StructType(
        [StructField("question_id", left.schema["qid"].dataType), StructField("id", right.schema["vid"].dataType), StructField("micros", LongType())]
    )
    size = left.agg(F.sum(F.size("qvec") * 4 + F.size("limits") * 8 + F.octet_length(F.col("qid").cast("string")) + 16)).first()[0] or 0
    blocks = max(1, -(-size // broadcast_bytes))
    found = []
    for block in range(blocks):
        own = left if blocks == 1 else left.where(F.pmod(F.xxhash64("qid"), F.lit(blocks)) == block)
        part = own.toArrow()
        if part.num_rows or blocks == 1:
            found.append(_search_by_codes(part, right, k, planes, schema))
    near = materialize(knn.ranked(reduce(DataFrame.unionByName, found), k, "qid", "vid"), "near")
    met = exact.join(near.select("qid", "vid"), ["qid", "vid"], "left_semi").count()
    recall = met / max(exact.count(), 1)
    if recall < least_recall and not exact.isEmpty():
        raise ValueError(f"recall {recall:.3f} of the hashed search is below {least_recall}")
    return near.select(F.col("qid").alias(question_id), "rank", F.col("vid").alias(vector_id), "distance", F.lit(recall).alias("recall"))


def _probes(left: DataFrame, right: DataFrame, exact: DataFrame, planes: Planes) -> int:
    """Codes of each table to ask for, so that ``FITTED`` of the exact hits share one with their question."""
    hits = exact.select("qid", "vid").join(left, "qid").join(right, "vid").toArrow()  # hits of the sample
    if not hits.num_rows:
        return 1
    asking = matrix_of(hits.column("qvec"), hits.column("qid").combine_chunks()).astype(np.float64)
    codes = planes.codes(matrix_of(hits.column("vvec"), hits.column("vid").combine_chunks()).astype(np.float64))
    step = planes.rows_together()
    first = np.concatenate(
        [(planes.asked(asking[a : a + step]) == codes[a : a + step, :, None]).argmax(axis=2).min(axis=1) + 1 for a in range(0, len(codes), step)]
    )
    return int(np.quantile(first, FITTED, method="higher"))
