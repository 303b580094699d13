import numpy as np
import pytest

from lorespan.llm import topk

SCHEMA = "vec_id long, embedding array<float>, score long, rank int"


def brute(rows, queries, k):
    def whole(e):
        if e is None or not e or any(x is None or not np.isfinite(x) for x in e):
            return None
        return np.floor(np.array([np.float32(x) for x in e], dtype=np.float64) * 1024)

    fine = [(i, v) for i, e in rows if i is not None and (v := whole(e)) is not None]
    out = set()
    for q, v in {i: v for i, v in fine if i in queries}.items():
        scores = sorted((-int(x @ v), i) for i, x in fine if i != q and len(x) == len(v))
        out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])}
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, e, 1, 2) for i, e in rows], SCHEMA)


@pytest.mark.parametrize("block", [8192, 16])
def test_matches_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "VECTOR_BLOCK", block)
    draw = np.random.default_rng(4)
    rows = [(k, draw.normal(size=6).round(3).tolist()) for k in range(150)]
    rows += [(200 + k, rows[3][1]) for k in range(20)]  # ties
    rows += [(300, None), (301, []), (302, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (303, [float("nan")] * 6), (304, [float("inf")] + [0.0] * 5)]
    rows += [(305, [0.0] * 6), (306, [1e6] * 6), (307, [1.0, 2.0]), (308, [2.0, 1.0]), (None, rows[0][1])]
    df = frame(spark, rows)
    ids = {0, 3, 50, 200, 300, 302, 303, 304, 305, 306, 307}
    queries = df.where(df.vec_id.isin(*ids))
    got = topk.top_k(df, queries, 5)
    assert {tuple(r) for r in got.collect()} == brute(rows, ids, 5)


def test_repeated_rows_and_blocks_of_queries(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_BLOCK", 7)
    draw = np.random.default_rng(9)
    rows = [(k, draw.normal(size=4).round(2).tolist()) for k in range(60)]
    rows += [rows[7], rows[7]]
    df = frame(spark, rows)
    got = topk.top_k(df, df.where("vec_id % 3 = 0"), 4).collect()
    want = brute(rows, set(range(0, 60, 3)), 4)
    assert len(got) == 80 and {tuple(r) for r in got} == want


def test_few_vectors_and_empty_tables(spark):
    df = frame(spark, [(0, [1.0]), (1, [0.5])])
    assert {tuple(r) for r in topk.top_k(df, df.where("vec_id = 0")).collect()} == {(0, 1, 1, 1024 * 512)}
    assert topk.top_k(df, df.limit(0)).collect() == []
    assert topk.top_k(df.limit(0), df).collect() == []


def test_reading_stops_before_the_lists_end():
    draw = np.random.default_rng(1)
    x = np.floor(draw.normal(size=(4000, 8)) * 1024)
    x[:20] += 4000
    alive = topk.bounded_search(x, np.ones((1, 8)), 5, np.full(1, -np.inf), (np.array([], int), np.array([], int)))
    assert set(np.argsort(-x.sum(axis=1))[:5]) <= set(alive[0]) and len(alive[0]) < 300
