import hashlib
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lorespan.functions import text as txt
from lorespan.operators import evaluate

SCHEMA = "run_id string, question_id string, question string, outputs struct<answer:string,source:string,output_metadata:string>, wanted string"


def results(spark, rows):
    return spark.createDataFrame([(r, q, "q", (a, None, None), w) for r, q, a, w in rows], SCHEMA)


def f1(answer, wanted):
    a, b = (Counter(w.lower() for w in (t or "").replace(",", " ").split()) for t in (answer, wanted))
    n = sum(a.values()) + sum(b.values())
    return 0 if answer is None or not n else 2_000_000 * sum((a & b).values()) // n


def weight(question_id, draw):
    u = int(hashlib.md5(f"{question_id}:{draw}".encode()).hexdigest()[:8], 16)
    share, total, n = math.exp(-1), 0.0, 0
    while n < 10:
        total += share
        if u < math.floor(total * 2**32):
            return n
        n += 1
        share /= n
    return n


def brute(rows, draws):
    runs = {}
    for run, q, a, w in rows:
        runs.setdefault(run, {})[q] = {
            "answered": 1_000_000 * (a is not None),
            "exact": None if w is None else 1_000_000 * (a == w),
            "f1": None if w is None else f1(a, w),
        }
    out = {}
    for x in sorted(runs):
        for y in sorted(runs):
            for metric in ("answered", "exact", "f1") if x < y else ():
                gaps = {q: runs[y][q][metric] - runs[x][q][metric] for q in runs[x] if q in runs[y] and runs[x][q][metric] is not None}
                if not gaps:
                    continue
                means = []
                for draw in range(1, draws + 1):
                    total = sum(weight(q, draw) for q in gaps)
                    if total:
                        means.append(sum(weight(q, draw) * g for q, g in gaps.items()) / total / 1e6)
                means.sort()
                side = math.floor(len(means) * evaluate.OUTSIDE / 2)
                out[x, y, metric] = (len(gaps), sum(gaps.values()) / len(gaps) / 1e6, means[side], means[-1 - side])
    return out


def test_comparison_equals_a_plain_bootstrap(spark):
    texts = ["the cat sat", "The cat, the CAT", "a dog", None, "", "cat cat cat dog"]
    rows = [("a", f"q{k}", texts[k % 6], texts[(k * 5 + 1) % 6]) for k in range(40)]
    rows += [("b", f"q{k}", texts[(k * 3 + 2) % 6], texts[(k * 5 + 1) % 6]) for k in range(5, 45)]
    rows += [("c", f"q{k}", texts[(k * 5 + 1) % 6], texts[(k * 5 + 1) % 6]) for k in range(40)]
    got = {
        (r["run_a"], r["run_b"], r["metric"]): (r["n_questions"], r["difference"], r["low"], r["high"])
        for r in evaluate.compare(results(spark, rows).repartition(3), "wanted", 80).collect()
    }
    want = brute(rows, 80)
    assert set(got) == set(want)
    for key, values in want.items():
        assert got[key] == pytest.approx(values, abs=2e-9), key
        assert got[key][2] <= got[key][3]


def test_words_are_shared_as_multisets(spark):
    rows = [("a a b", ["a 0", "a 1", "b 0"]), ("", []), ("b", ["b 0"]), ("c A c a c", ["a 0", "a 1", "c 0", "c 1", "c 2"])]
    df = spark.createDataFrame([(t,) for t, _ in rows], "t string").withColumn("w", F.array_sort(txt.words(F.col("t"))))
    assert [r["n"] for r in df.select(evaluate.numbered_words(F.col("w")).alias("n")).collect()] == [w for _, w in rows]


def test_weights_are_poisson(spark):
    drawn = spark.range(20_000).select(evaluate.draw_weight(F.col("id"), F.lit(3)).alias("w")).groupBy("w").count().collect()
    shares = {r["w"]: r["count"] / 20_000 for r in drawn}
    for n in range(4):
        assert abs(shares[n] - math.exp(-1) / math.factorial(n)) < 0.015
    assert [r["w"] for r in spark.range(30).select(evaluate.draw_weight(F.col("id"), F.lit(9)).alias("w")).collect()] == [weight(k, 9) for k in range(30)]


def test_one_run_compares_with_nothing(spark):
    assert evaluate.compare(results(spark, [("a", "q", "x", "x")]), "wanted").count() == 0
    assert evaluate.compare(results(spark, []), "wanted").count() == 0
