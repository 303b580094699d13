import random

from lorespan.llm.components import connected_components


def brute(pairs):
    up = {}

    def top(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in pairs:
        x, y = top(a), top(b)
        up[max(x, y)] = min(x, y)
    return {x: top(x) for x in list(up)}


def run(spark, pairs):
    rows = connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()
    assert len({r.node for r in rows}) == len(rows)
    return {r.node: r.component for r in rows}


def test_random_links_paths_and_stars(spark):
    draw = random.Random(5)
    pairs = [(draw.randrange(60), draw.randrange(60)) for _ in range(35)]
    pairs += [(100 + k, 101 + k) for k in range(30)] + [(300, 200 + k) for k in range(40)]
    real = [(a, b) for a, b in pairs if a != b]
    assert run(spark, pairs + pairs[:5]) == brute(real)


def test_nulls_loops_and_no_links(spark):
    assert run(spark, [(None, 1), (2, None), (3, 3)]) == {}
    assert run(spark, []) == {}
    assert run(spark, [(-5, 4), (4, None)]) == {-5: -5, 4: -5}
