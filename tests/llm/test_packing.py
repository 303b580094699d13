import random
from collections import defaultdict

from helpers import odd_documents
from hypothesis import given, settings
from hypothesis import strategies as st

from lorespan.llm import packing


def brute(pieces, capacity):
    """The tightest bin without a conflict by looking at every bin; the first opened of equals."""
    bins, placed = [], []
    for length, source, cluster in pieces:
        fits = [
            (b["left"], k) for k, b in enumerate(bins)
            if b["left"] >= length and b["left"] > 0 and (source < 0 or source not in b["s"]) and (cluster < 0 or cluster not in b["c"])
        ]
        if fits:
            k = min(fits)[1]
        else:
            k = len(bins)
            bins.append({"left": capacity, "s": set(), "c": set()})
        b = bins[k]
        placed.append((k, capacity - b["left"]))
        b["left"] -= length
        b["s"].add(source)
        b["c"].add(cluster)
    return placed


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 20), st.integers(-1, 3), st.integers(-1, 5)), max_size=40))
def test_best_fit_matches_brute_force(pieces):
    assert packing.best_fit(pieces, 20) == brute(pieces, 20)


def checked(rows, capacity):
    bins = defaultdict(list)
    for r in rows:
        if r.bin_id is not None:
            bins[r.bin_id].append(r)
    for own in bins.values():
        spans = sorted((r.bin_offset, r.bin_offset + r.length) for r in own)
        assert spans[0][0] == 0 and spans[-1][1] <= capacity
        assert all(a[1] == b[0] for a, b in zip(spans[:-1], spans[1:]))
        sources = [r.source for r in own if r.source is not None]
        assert len(sources) == len(set(sources))
    return bins


def test_all_words_are_packed_once_without_conflicts(spark):
    draw = random.Random(2)
    texts = [" ".join(["w%d" % draw.randrange(99)] * draw.randrange(1, 90)) for _ in range(80)] + ["a copy of it"] * 20
    df, rows = odd_documents(spark, texts)
    got = packing.pack(df, capacity=64, group_rows=30).collect()
    bins = checked(got, 64)
    total = sum(len((t or "").split()) for _, t in rows)
    assert sum(r.length for r in got) == total
    copies = {80 + k for k in range(20)}
    assert all(sum(r.doc_id in copies for r in own) <= 1 for own in bins.values())
    pieces = [(r.doc_id, r.piece) for r in got if r.doc_id is not None and r.doc_id < 100]
    assert len(pieces) == len(set(pieces))
    assert sorted(r.doc_id is None for r in got if r.length == 0) == [False] * 3 + [True]
    assert sorted(map(tuple, packing.pack(df, capacity=64, group_rows=30).collect()), key=str) == sorted(map(tuple, got), key=str)


def test_one_group_is_the_sequential_result(spark):
    rows = [(k, " ".join(["x"] * n), f"s{s}") for k, (n, s) in enumerate([(5, 0), (7, 0), (3, 1), (2, 2), (9, 1), (1, 0), (4, 2)])]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: (r.bin_id, r.bin_offset) for r in packing.pack(df, capacity=10).collect()}
    order = sorted(rows, key=lambda r: (-len(r[1].split()), r[0]))
    sources = {}
    pieces = [(len(r[1].split()), sources.setdefault(r[2], len(sources)), r[0]) for r in order]
    assert [got[r[0]] for r in order] == brute(pieces, 10)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string, source string")
    assert packing.pack(df).collect() == []
