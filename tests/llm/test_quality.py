import random

import numpy as np
import pyarrow as pa
from helpers import odd_documents

from lorespan.llm import quality
from lorespan.llm.models import decision, fit_logistic, sigmoid


def test_logistic_finds_the_maximum():
    draw = np.random.default_rng(2)
    x = draw.normal(size=(400, 3))
    y = (sigmoid(x @ np.array([1.0, -2.0, 0.5]) + 0.3) > draw.random(400)).astype(float)
    beta = fit_logistic(x, y, ridge=1.0)

    def loss(b):
        z = decision(x, b)
        return (np.logaddexp(0, z) - y * z).sum() + 0.5 * (b[:-1] ** 2).sum()

    best = loss(beta)
    assert all(loss(beta + draw.normal(size=4) * 0.01) >= best - 1e-6 for _ in range(50))


def test_views_count_whole_texts():
    view = quality.text_view(pa.array(["AB cd\n12!", None, "", "  ", "x" * 3_000_000 + " y"]))
    assert view[0][:6].round(4).tolist() == [round(2 / 9, 4), round(2 / 9, 4), round(2 / 9, 4), 0, round(1 / 9, 4), round(1 / 9, 4)]
    assert view[1:4, -1].tolist() == [1, 1, 1] and view[4, -1] == 0
    assert view[4, 1] > 0.99
    meta = quality.metadata_view(["en", None], ["s", None], [5, None])
    assert meta.sum(axis=1).round(3).tolist() == [round(2 + np.log1p(5) / 10, 3), 3.0]


def rows_of(spark):
    draw = random.Random(4)
    rows, labels = [], []
    for k in range(600):
        good = k % 3 > 0
        words = ["".join(draw.choices("abcdefghij", k=draw.randrange(2, 9))) for _ in range(draw.randrange(5, 60))]
        if not good:
            words = [w.upper() + "!!" for w in words] if k % 2 else [w + "***" for w in words]
        rows.append(" ".join(words))
        if k % 5:
            labels.append((k, int(good), "clash"))
    labels += [(None, 1, ""), (3, None, "")]
    return rows, spark.createDataFrame(labels, "doc_id long, quality int, lang string")


def test_unlabelled_rows_are_scored_right(spark):
    texts, labels = rows_of(spark)
    df, every = odd_documents(spark, texts)
    model = quality.fit(df, labels)
    got = quality.score(df, model).collect()
    assert len(got) == len(every) and all(0 <= r.score <= 1 for r in got)
    right = [(r.score >= 0.5) == (r.doc_id % 3 > 0) for r in got if r.doc_id is not None and r.doc_id < 600 and r.doc_id % 5 == 0]
    assert len(right) == 120 and np.mean(right) > 0.97
    assert quality.score(df.limit(0), model).collect() == []
    assert len(quality.score(df.select("doc_id", "text"), model).collect()) == len(every)


def two_views(n=3000):
    draw = np.random.default_rng(6)
    y = (draw.random(n) < 0.5).astype(float)
    text = (y[:, None] * 2 - 1) * 1.2 + draw.normal(size=(n, 2))
    metadata = (y[:, None] * 2 - 1) * 1.2 + draw.normal(size=(n, 3))
    return y, text, metadata, np.where(np.arange(n) < 150, y, np.nan), np.arange(n) % 3 == 0


def plain_rounds(text, metadata, y, apart):
    """Co-training on the driver with everything in memory: labels handed over are kept in arrays."""
    views, other = {"text": text, "metadata": metadata}, quality.OTHER
    taught = {v: np.full(len(y), np.nan) for v in views}
    pool = np.isnan(y) & ~apart
    fitted = {}
    for round_ in range(quality.ROUNDS + 1):
        for view, x in views.items():
            used = ~apart & (~np.isnan(y) | ~np.isnan(taught[view]))
            target = np.where(np.isnan(y), taught[view], y)[used]
            weight = np.where(np.isnan(y), quality.TAUGHT_WEIGHT, 1.0)[used]
            fitted[view] = fit_logistic(x[used], target, weight, ridge=quality.RIDGE)
        if round_ == quality.ROUNDS:
            break
        handed = {}
        for view, x in views.items():
            free = pool & np.isnan(taught[other[view]])
            odds = decision(x, fitted[view])
            most, sure = quality.SHARE * free.sum(), np.log(quality.SURE / (1 - quality.SURE))
            new = np.full(len(y), np.nan)
            for sign, value in ((-1, 0.0), (1, 1.0)):
                side = np.sort((sign * odds)[free & (odds >= 0 if sign > 0 else odds < 0)])
                edges = np.arange(quality.N_BINS) * quality.BIN
                from_edge = len(side) - np.searchsorted(np.floor(side / quality.BIN), np.arange(quality.N_BINS), "left")
                fine = np.flatnonzero(from_edge <= most)
                last = int(np.floor(side[-1] / quality.BIN))
                least = max(edges[min(fine[0], last)], sure)
                new[free & (sign * odds >= least)] = value
            handed[other[view]] = new
        for view, new in handed.items():
            taught[view] = np.where(np.isnan(taught[view]), new, taught[view])
    return fitted, taught


def test_rounds_equal_plain_co_training(spark):
    y, text, metadata, known, apart = two_views()
    table = [(k, None if np.isnan(v) else int(v), bool(a), t.tolist(), m.tolist()) for k, (v, a, t, m) in enumerate(zip(known, apart, text, metadata))]
    df = spark.createDataFrame(table, "k int, y int, apart boolean, text array<double>, metadata array<double>").repartition(5)

    matrix = quality._matrix

    def views(batch):
        label = batch.column("y").to_numpy(zero_copy_only=False).astype(float)
        return label, batch.column("apart").to_numpy(zero_copy_only=False), {"text": matrix(batch.column("text"), 2), "metadata": matrix(batch.column("metadata"), 3)}

    fitted, rules = quality.CoTraining(df, views, {"text": 2, "metadata": 3}).run()
    want, taught = plain_rounds(text, metadata, known, apart)
    for view in quality.VIEWS:
        assert np.abs(fitted[view] - want[view]).max() < 1e-4
        mine = quality.taught_labels({"text": text, "metadata": metadata}[quality.OTHER[view]], rules[view])
        pool = np.isnan(known) & ~apart
        assert np.mean((mine == taught[view]) | (np.isnan(mine) & np.isnan(taught[view])), where=pool) > 0.999
        assert np.isfinite(taught[view][pool]).mean() > 0.05 and (taught[view] == y)[np.isfinite(taught[view])].mean() > 0.95


def test_what_is_handed_over_grows_with_the_table():
    counts = np.array([0, 5, 3, 2, 1, 0])
    assert quality.threshold(counts, 3) == 3 and quality.threshold(counts, 6) == 2 and quality.threshold(counts, 100) == 0
    assert quality.threshold(counts * 1000, 3000) == 3
    assert quality.threshold(counts, 0.5) == 4  # never less than the surest bin
    assert quality.threshold(np.zeros(6), 3) == 0


def test_all_unlabelled_rows_take_part(spark):
    """A kind of text that has no labels is learned from the metadata, however small its ids' hashes are."""
    draw = random.Random(9)
    rows, labels = [], []
    for k in range(3000):
        good = k % 2 == 0
        style = (lambda w: w) if good else (lambda w: w + "***")
        words = [style("".join(draw.choices("abcdef", k=6))) for _ in range(20)]
        rows.append((k, " ".join(words), "en", "clean" if good else "dirty", 100))
        if k < 300:
            labels.append((k, int(good)))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    model = quality.fit(df, spark.createDataFrame(labels, "doc_id long, quality int"))
    got = {r.doc_id: r.score for r in quality.score(df, model).collect()}
    assert np.mean([(s >= 0.5) == (i % 2 == 0) for i, s in got.items()]) > 0.99


def test_one_label_only_scores_one_half(spark):
    df, _ = odd_documents(spark, ["some text"])
    labels = spark.createDataFrame([(0, 1)], "doc_id long, quality int")
    assert {r.score for r in quality.score(df, quality.fit(df, labels)).collect()} == {0.5}
