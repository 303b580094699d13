import random

import pytest
from helpers import odd_documents, shingles

from lorespan.llm import jaccard_join


def brute(rows):
    sets = {}
    for i, t in rows:
        if i is not None:
            sets[i] = shingles(t)
    up = {i: i for i in sets}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[:x]:
            s, t = sets[a], sets[b]
            if s and t and 100 * len(s & t) >= 75 * len(s | t):
                p, q = top(a), top(b)
                up[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), top(i)) for i in sets}


def near_copies(draw, base, n, edits):
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(draw.randrange(edits + 1)):
            words[draw.randrange(len(words))] = f"new{draw.randrange(10**6)}"
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("sample", [0, 64])
def test_matches_brute_force_whatever_the_order(spark, sample):
    draw = random.Random(3)
    vocabulary = [f"w{k}" for k in range(300)]
    base = draw.choices(vocabulary, k=60)
    texts = near_copies(draw, base, 60, 3)  # a group of near copies: long lists, some of them unlinked
    texts += [" ".join(draw.choices(vocabulary, k=draw.randrange(1, 40))) for _ in range(40)]
    passage = " ".join(draw.choices(vocabulary, k=20))
    texts += [passage + " " + " ".join(draw.choices(vocabulary, k=draw.randrange(1, 12))) for _ in range(40)]
    texts += ["One two three", "one two THREE", "one two", texts[0].upper()] + [texts[5]] * 4
    df, rows = odd_documents(spark, texts)
    got = jaccard_join.similar_components(df, sample=sample).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == brute(rows)
    assert all(r.component_id is None for r in got if r.doc_id is None)


def test_one_document_of_each_group_stays(spark):
    df, rows = odd_documents(spark, ["a b c d e f g", "A b c d e f g", "h i j k l m"])
    kept = jaccard_join.keep_one(df)
    assert kept.columns == df.columns
    ids = sorted((r.doc_id for r in kept.collect()), key=lambda i: (i is None, i))
    assert ids == [0, 2, 3, 4, 5, 6, 7, None, None]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard_join.similar_components(df).collect() == []


def test_threshold_is_exact(spark):
    # 8 words make 4 shingles: 3 of 4 shared shingles is exactly three quarters of the union's 4.
    a, b, c = "a b c d e f g h", "a b c d e f g", "a b c d e f x"
    df = spark.createDataFrame([(1, a), (2, b), (3, c)], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard_join.similar_components(df).collect()}
    assert got == {1: 1, 2: 1, 3: 3}


def brute_links(rows):
    sets = {i: shingles(t) for i, t in rows}
    different = set(sets.values()) - {frozenset()}
    return {i: sum(s != t and 100 * len(s & t) >= 75 * len(s | t) for t in different) if s else 0 for i, s in sets.items()}


@pytest.mark.parametrize("size, block_rows", [(9, 1024), (40, 7)])
def test_all_links_count_whatever_the_group_size(spark, monkeypatch, size, block_rows):
    monkeypatch.setattr(jaccard_join, "COUNT_ROWS", block_rows)
    draw = random.Random(size)
    vocabulary = [f"w{k}" for k in range(300)]
    base = draw.choices(vocabulary, k=100)
    # Mutually similar texts that share their first columns, and texts of falling length, of which neighbours link.
    texts = [" ".join([*base, f"tail{k}"]) for k in range(size)]
    texts += near_copies(draw, draw.choices(vocabulary, k=80), size, 3)
    texts += [" ".join(base[:k]) for k in range(100, 100 - 2 * size, -2)] + texts[:2]
    rows = list(enumerate(texts)) + [(0, texts[0])]
    got = jaccard_join.similar_components(spark.createDataFrame(rows, "doc_id long, text string"), sample=0).collect()
    assert {r.doc_id: r.n_links for r in got} == brute_links(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(rows)


def test_different_long_words_do_not_link(spark):
    from test_shingles import parity_words

    a, b = parity_words(1024)
    docs = spark.createDataFrame([(1, a), (2, b), (3, a)], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard_join.similar_components(docs).collect()}
    assert got == {1: 1, 2: 2, 3: 1}
