import numpy as np
import pyarrow as pa
import pytest

from lorespan.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, component string, n string, x int"


def frame(spark, vectors, parts=3):
    rows = [(i, None if v is None else [None if c is None else float(c) for c in v], 1, "c", "n", 2) for i, v in vectors]
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def brute(vectors, most=4):
    """The contract by plain integers and a dense decomposition."""
    whole = [
        (i, [int(np.floor(256 * float(np.float32(c)))) for c in v])
        for i, v in vectors
        if v is not None and all(c is not None and np.isfinite(c) for c in v)
    ]
    fit = sorted({tuple(x) for _, x in whole})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    y = np.array([[(n * a - s) / n for a, s in zip(x, sums)] for x in fit])
    cov = y.T @ y / n
    values, q = np.linalg.eigh(cov)
    values, q = values[::-1][:most], q[:, ::-1][:, :most]
    out = {}
    for i, x in whole:
        deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums))
        white = (np.array(x) - np.array(sums) / n) @ q / np.sqrt(values)
        for c in range(len(values)):
            out[i, c + 1] = (n, deviation, white[c], values[c] / np.trace(cov))
    return out


def checked(spark, vectors):
    df = frame(spark, vectors)
    rows = whitening.whiten(df, whitening.fit(df)).collect()
    want = brute(vectors)
    assert {(r.vec_id, r.component) for r in rows} == set(want)
    for component in {c for _, c in want}:
        own = sorted((r for r in rows if r.component == component), key=lambda r: r.vec_id)
        mine = np.array([r.whitened for r in own])
        plain = np.array([want[r.vec_id, component][2] for r in own])
        assert min(np.abs(mine - plain).max(), np.abs(mine + plain).max()) < 1e-9
    for r in rows:
        n, deviation, _, explained = want[r.vec_id, r.component]
        assert (r.n, r.deviation) == (n, deviation) and r.explained == pytest.approx(explained, rel=1e-10)
        assert abs(r.identity_error) < 1e-9
    return rows


def test_equals_the_dense_decomposition(spark):
    rng = np.random.default_rng(5)
    points = rng.standard_normal((300, 12)) * np.linspace(2, 0.5, 12) @ np.linalg.qr(rng.standard_normal((12, 12)))[0]
    vectors = [(i, p) for i, p in enumerate(points.tolist())]
    vectors += [(300 + k, points[7].tolist()) for k in range(150)]  # a third of the rows is one vector
    vectors += [(500, None), (501, [None] + [0.0] * 11), (502, [float("nan")] * 12), (503, [float("inf")] + [1.0] * 11)]
    checked(spark, vectors)


def test_close_eigenvalues_keep_their_order(spark):
    rng = np.random.default_rng(6)
    checked(spark, list(enumerate(rng.standard_normal((900, 24)).tolist())))


def test_fewer_dimensions_than_components(spark):
    rng = np.random.default_rng(7)
    rows = checked(spark, list(enumerate(rng.standard_normal((40, 2)).tolist())))
    assert {r.component for r in rows} == {1, 2}


def test_odd_tables(spark):
    empty = frame(spark, [])
    assert whitening.whiten(empty, whitening.fit(empty)).count() == 0
    same = frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])
    assert whitening.whiten(same, whitening.fit(same)).count() == 0
    # A line: one component. Vectors of other lengths and empty ones take no part, a null id stays.
    line = frame(spark, [(None, [1.0, 1.0]), (2, [2.0, 2.0]), (3, [3.0, 3.0]), (3, [3.0, 3.0]), (4, []), (5, [1.0] * 3)])
    rows = whitening.whiten(line, whitening.fit(line)).collect()
    assert sorted((str(r.vec_id), r.component, r.n) for r in rows) == [("2", 1, 3), ("3", 1, 3), ("3", 1, 3), ("None", 1, 3)]
    assert all(r.explained == pytest.approx(1.0) for r in rows)


def test_bytes_hold_any_whole_vector():
    column = pa.array([[0.5, -0.001], [1e30, -1e30], None, [], [200.0, 0.0], [1.0]], pa.list_(pa.float64()))
    rows, lengths, packed = whitening.pack(column)
    assert rows.tolist() == [0, 1, 4, 5] and lengths.tolist() == [2, 2, 2, 1]
    x = whitening.unpack(pa.array(packed[:3], pa.binary()), 2)
    assert x.tolist() == [[128, -1], [2**63 - 1, -(2**63)], [51200, 0]]


def test_deviations_are_exact_or_null():
    n, sums = 3, [10, -7]
    x = np.array([[5, 2], [2**40, 0], [2**31, 1]])
    got = whitening.deviations(x, n, sums)
    want = [sum((n * int(a) - s) ** 2 for a, s in zip(row, sums)) for row in x]
    assert got == [w if w < 2**63 else None for w in want]
    edge = np.array([[1_012_333_499, 0]])
    assert whitening.deviations(edge, n, [0, 0]) == [(3 * 1_012_333_499) ** 2 if (3 * 1_012_333_499) ** 2 < 2**63 else None]


def test_minres_solves_symmetric_systems():
    rng = np.random.default_rng(8)
    a = rng.standard_normal((20, 20))
    a = a + a.T
    b = rng.standard_normal((20, 3))
    x = whitening.minres(lambda v: a @ v, b, 60, 1e-12)
    assert np.abs(a @ x - b).max() < 1e-8
