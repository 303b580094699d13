"""Exact top-k search by inner product without random access (sorted lists with score bounds).

Every component is a list of the vectors sorted by its value. For a query, the lists are read from their best
end in equal steps; what has been read of a vector gives a lower bound (unread components count with the
list's worst value) and an upper bound (unread components count with the value reached in the list). A vector
leaves when its upper bound is below the k-th best lower bound, reading stops when few enough can still
qualify, and their final scores are computed in full.

Tasks do this for blocks of vectors and of queries at once: the state of all lists after a step is a matrix, so
the bounds of all queries are matrix products. Vectors never move; each pass over them serves one block of
queries of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lorespan.llm.common import materialize

SCALE = 1024
#: Queries sent to the tasks at a time, and vectors whose lists are sorted together.
QUERY_BLOCK, VECTOR_BLOCK = 2048, 8192
#: Shares of the lists read before the bounds are looked at.
STEPS = (0.25, 0.5, 0.75)


def whole_vectors(column: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    """(rows that take part, their integer vectors): floor(SCALE * x), without null, empty or non-finite ones."""
    rows, vectors = [], []
    ends = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False).astype(np.float64)  # null components become NaN
    fine = np.isfinite(values)
    for row, (a, b) in enumerate(zip(ends[:-1], ends[1:])):
        if column[row].is_valid and b > a and fine[a:b].all():
            rows.append(row)
            vectors.append(np.floor(values[a:b] * SCALE))
    return np.array(rows, dtype=np.int64), vectors


def bounded_search(x: np.ndarray, queries: np.ndarray, k: int, floor: np.ndarray, own: tuple[np.ndarray, np.ndarray]) -> list[np.ndarray]:
    """Rows of ``x`` that may be among the ``k`` best of each query, given that scores below ``floor`` are of no use.

    ``floor`` is raised to the k-th best lower bound found here. ``own``: (query, row) pairs that don't count.
    """
    n, width = x.shape
    order = np.argsort(x, axis=0, kind="stable")
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.arange(n)[:, None], axis=0)
    ascending = np.take_along_axis(x, order, axis=0)
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)  # read from the top, from the bottom
    worst = up @ ascending[0] + down @ ascending[-1]
    alive = [np.arange(n)] * len(queries)
    for share in STEPS:
        depth = min(n, int(np.ceil(share * n)))
        high, low = rank >= n - depth, rank < depth
        reached_top, reached_bottom = ascending[max(n - depth, 0)], ascending[depth - 1]
        # What has been read, over the value that an unread component can have at most (upper) or at least (lower).
        upper = up @ np.where(high, x, reached_top).T + down @ np.where(low, x, reached_bottom).T
        gain = up @ np.where(high, x - ascending[0], 0).T + down @ np.where(low, x - ascending[-1], 0).T
        lower = gain + worst[:, None]
        lower[own] = -np.inf
        if n >= k:
            floor[:] = np.maximum(floor, np.partition(lower, n - k, axis=1)[:, n - k])
        alive = [np.flatnonzero(row >= f) for row, f in zip(upper, floor)]
        if sum(map(len, alive)) <= 0.05 * n * len(queries):
            break
    return alive


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` best vectors of every query, ties to the smaller vec_id.

    Both tables: ``vec_id long, embedding array<float or double>``. A query meets every row but those with its own
    vec_id, of its own length. Vectors that are null or empty or hold a null or non-finite component take no
    part, nor do rows with a null vec_id. Rows that repeat a vec_id count as rows of their own among the
    candidates; of a repeated query id the largest vector counts. Empty tables give an empty result. Other columns
    are ignored.
    """
    spark = vectors.sparkSession
    shape = [F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")]
    vectors = vectors.select(*shape).where("vec_id IS NOT NULL AND embedding IS NOT NULL")
    queries = queries.select(*shape).where("vec_id IS NOT NULL AND embedding IS NOT NULL")
    queries = materialize(queries.groupBy("vec_id").agg(F.max("embedding").alias("embedding")), "queries")
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    passes = []
    for block in range(blocks):
        part = queries.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == block).toArrow()  # about QUERY_BLOCK rows
        rows, found = whole_vectors(part.column("embedding").combine_chunks()) if part.num_rows else (np.zeros(0, np.int64), [])
        ids = part.column("vec_id").to_numpy()[rows]
        sent = spark.sparkContext.broadcast((ids, found))
        passes.append(materialize(vectors.mapInArrow(_searched(sent, k), "query_id long, vec_id long, score long"), "hits"))
    hits = passes[0]
    for more in passes[1:]:
        hits = hits.unionByName(more)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _searched(sent, k: int):
    def best(ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, q: np.ndarray, floor: np.ndarray) -> list[tuple]:
        out = []
        own = np.nonzero(query_ids[:, None] == ids[None, :])
        for row, alive in enumerate(bounded_search(x, q, k, floor, own)):
            alive = alive[ids[alive] != query_ids[row]]
            scores = (x[alive] @ q[row]).astype(np.int64)
            order = np.lexsort((ids[alive], -scores))[:k]
            out += [(query_ids[row], i, s) for i, s in zip(ids[alive][order].tolist(), scores[order].tolist())]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, queries = sent.value
        widths = sorted({len(v) for v in queries})
        of_width = {w: [j for j, v in enumerate(queries) if len(v) == w] for w in widths}
        floors = {w: np.full(len(of_width[w]), -np.inf) for w in widths}
        held: dict[int, tuple[list, list]] = {}

        def flushed(width: int) -> pa.RecordBatch:
            ids, rows = held.pop(width)
            own = of_width[width]
            found = []
            for a in range(0, len(own), 256):
                part = own[a : a + 256]
                q = np.stack([queries[j] for j in part])
                floor = floors[width][a : a + 256]
                found += best(np.array(ids), np.stack(rows), query_ids[part], q, floor)
            columns = list(zip(*found)) or [(), (), ()]
            return pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], ["query_id", "vec_id", "score"])

        for batch in batches:
            rows, found = whole_vectors(batch.column("embedding"))
            ids = batch.column("vec_id").to_numpy()[rows]
            for i, v in zip(ids.tolist(), found):
                if len(v) not in of_width:
                    continue
                mine = held.setdefault(len(v), ([], []))
                mine[0].append(i)
                mine[1].append(v)
                if len(mine[0]) >= VECTOR_BLOCK:
                    yield flushed(len(v))
        for width in list(held):
            yield flushed(width)

    return run
