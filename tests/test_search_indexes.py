"""The pivot index and the hashed search against the flat one."""

import glob

import numpy as np
import pyarrow.parquet as pq
import pytest

from lorespan.operators import hashed, knn
from lorespan.sources import pivot_index


def frames(spark, questions, vectors):
    asked = spark.createDataFrame([(k, q.tolist()) for k, q in enumerate(questions)], "question_id long, embedding array<float>")
    index = spark.createDataFrame([(f"v{k}", v.tolist()) for k, v in enumerate(vectors)], "chunk_id string, embedding array<float>")
    return asked, index.repartition(4)


def clusters(seed=1, n=3000, groups=12, dim=10):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(groups, dim)) * 12
    vectors = (middles[rng.integers(groups, size=n)] + rng.normal(size=(n, dim))).astype(np.float32)
    vectors[: n // 3] = vectors[0]  # a third of the rows is one vector
    return vectors, (vectors[rng.integers(n, size=25)] + rng.normal(size=(25, dim)) * 0.3).astype(np.float32)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("limit", [knn.BROADCAST_BYTES, 500])
def test_pivot_search_equals_the_flat_one(spark, tmp_path, monkeypatch, limit):
    monkeypatch.setattr(knn, "SAMPLE_RATIO", 8)
    vectors, questions = clusters()
    asked, index = frames(spark, questions, vectors)
    pivot_index.build(index, str(tmp_path / "p"), pivots=16)
    assert rows(pivot_index.search(asked, str(tmp_path / "p"), 5, broadcast_bytes=limit)) == rows(knn.knn_join(asked, index, 5))


def test_pivot_search_without_structure(spark, tmp_path):
    rng = np.random.default_rng(2)
    asked, index = frames(spark, rng.normal(size=(20, 16)).astype(np.float32), rng.normal(size=(400, 16)).astype(np.float32))
    pivot_index.build(index, str(tmp_path / "p"))
    assert rows(pivot_index.search(asked, str(tmp_path / "p"), 5)) == rows(knn.knn_join(asked, index, 5))


def test_odd_pivot_indexes(spark, tmp_path):
    vectors, questions = clusters(n=40)
    asked, index = frames(spark, questions, vectors)
    pivot_index.build(index.limit(0), str(tmp_path / "none"))
    assert pivot_index.search(asked, str(tmp_path / "none"), 5).count() == 0
    pivot_index.build(index, str(tmp_path / "few"))
    assert pivot_index.search(asked.limit(0), str(tmp_path / "few"), 5).count() == 0
    assert rows(pivot_index.search(asked, str(tmp_path / "few"), 5)) == rows(knn.knn_join(asked, index, 5))
    with pytest.raises(ValueError, match="question id 3 "):
        pivot_index.search(asked.unionByName(asked.filter("question_id = 3")), str(tmp_path / "few"), 5)


def test_ranges_reach_the_scan_and_skip_row_groups(spark, tmp_path, monkeypatch):
    """On clustered vectors one question reads a part of the row groups only."""
    monkeypatch.setattr(knn, "SAMPLE_RATIO", 8)
    monkeypatch.setattr(pivot_index, "ROW_GROUP_BYTES", 4 << 10)
    vectors, questions = clusters(n=12_000)
    asked, index = frames(spark, questions, vectors)
    path = str(tmp_path / "p")
    pivot_index.build(index, path, pivots=16)
    one = asked.filter("question_id = 4")
    plan = pivot_index.search(one, path, 5)._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters: ")[1].split("]")[0]
    assert "GreaterThanOrEqual(reach" in pushed and "LessThanOrEqual(reach" in pushed and "EqualTo(pivot" in pushed
    pivots = np.array([r["vector"] for r in spark.read.parquet(f"{path}/pivots").orderBy("pivot").collect()])
    part = one.selectExpr("question_id AS qid", "embedding AS qvec").toArrow()
    sample = spark.read.parquet(f"{path}/sample")
    bound = knn._bounds(part, [sample], 5, "question_id long, id string, micros long")
    ranges = pivot_index.wanted_ranges(questions[4:5].astype(float), np.sqrt((bound + 1) / knn.MICRO), pivots)
    total = read = 0
    for name in glob.glob(f"{path}/vectors/*.parquet"):
        meta = pq.ParquetFile(name).metadata
        at = {meta.schema.column(k).path: k for k in range(meta.num_columns)}
        for g in range(meta.num_row_groups):
            cell, reach = (meta.row_group(g).column(at[c]).statistics for c in ("pivot", "reach"))
            total += 1
            read += any(cell.min <= p <= cell.max and (cell.min != cell.max or any(a <= reach.max and b >= reach.min for a, b in r)) for p, r in ranges.items())
    assert total >= 8 and read <= total / 2  # 48 of 124 when this was written


def test_hashed_search_reaches_its_recall(spark):
    vectors, questions = clusters(n=4000)
    vectors[: len(vectors) // 3] += np.random.default_rng(0).normal(size=(len(vectors) // 3, 10)).astype(np.float32)
    asked, index = frames(spark, questions, vectors)
    exact = {(r["question_id"], r["chunk_id"]): r["distance"] for r in knn.knn_join(asked, index, 5).collect()}
    got = hashed.hashed_knn(asked, index, 5).collect()
    met = [r for r in got if (r["question_id"], r["chunk_id"]) in exact]
    assert len(met) / len(exact) >= 0.9 and {r["recall"] for r in got} == {len(met) / len(exact)}
    assert all(r["distance"] == exact[r["question_id"], r["chunk_id"]] for r in met)


def test_hashed_search_asks_for_part_of_clustered_vectors(spark):
    vectors, questions = clusters(n=4000)
    right = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(vectors)], "vid long, vvec array<float>")
    planes = hashed.fit_planes(right, 4000)
    assert planes.normals.shape[:2] == (hashed.TABLES, 5)
    asked, codes = planes.asked(questions.astype(float)), planes.codes(vectors.astype(float))
    assert (asked[:, :, 0] == planes.codes(questions.astype(float))).all()
    assert (np.sort(asked, axis=2) == np.arange(32)).all()
    shared = (codes[None, :, :] == asked[:, None, :, 0]).any(axis=2)
    assert shared.mean() < 0.7


def test_hashed_search_on_small_and_empty_tables(spark):
    vectors, questions = clusters(n=9)
    asked, index = frames(spark, questions, vectors)
    assert hashed.hashed_knn(asked.limit(0), index, 5).count() == 0
    assert hashed.hashed_knn(asked, index, 3).count() == 25 * 3
    with pytest.raises(ValueError, match="below"):
        hashed.hashed_knn(asked, index, 3, least_recall=1.1)


def test_ranges_that_overlap_become_one():
    def plain(pairs):
        out = []
        for a, b in sorted(pairs):
            if out and a <= out[-1][1]:
                out[-1][1] = max(out[-1][1], b)
            else:
                out.append([a, b])
        return out

    rng = np.random.default_rng(23)
    for n, width in ((0, 1.0), (1, 1.0), (5, 0.5), (200, 0.002), (200, 0.05), (50, np.inf)):
        low = rng.integers(0, 1000, n) / 1000 - (width if np.isinf(width) else 0)
        high = low + width if np.isfinite(width) else np.full(n, np.inf)
        assert pivot_index._merged(low, high) == plain(zip(low.tolist(), high.tolist()))


def test_few_rows_are_held_against_a_pivot(monkeypatch):
    """Millions of questions meet the pivots on the driver; what is held beside the distances is a few rows."""
    x, pivots = np.random.default_rng(29).normal(size=(5000, 6)), np.random.default_rng(31).normal(size=(7, 6))
    norm, most = np.linalg.norm, []
    monkeypatch.setattr(pivot_index.np.linalg, "norm", lambda gap, axis: (most.append(len(gap)), norm(gap, axis=axis))[1])
    far = pivot_index._distances(x, pivots)
    monkeypatch.undo()
    assert max(most) <= 1024 and np.array_equal(far, np.stack([norm(x - p, axis=1) for p in pivots], axis=1))
