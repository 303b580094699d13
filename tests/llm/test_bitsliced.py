import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from helpers import LOWER, odd_documents

from lorespan.llm import bitsliced
from lorespan.llm.decontaminate import texts_of

RULE = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms_of(text):
    return RULE.findall((text or "").translate(LOWER)) if text else []


def brute(docs, items, k=20):
    """The contract with plain integers: every document scored."""
    own = [(i, terms_of(t)) for i, t in docs]
    own = [(i, t) for i, t in own if t]
    n_docs, n_terms = len(own), sum(len(t) for _, t in own)
    df = {}
    for _, t in own:
        for term in set(t):
            df[term] = df.get(term, 0) + 1
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for t, n in df.items()}
    last = {}
    for i, t in items:
        if i is not None:
            last[i] = max(t, last[i]) if last.get(i) is not None and t is not None else t or last.get(i)
    out = []
    for item, text in last.items():
        scores = []
        for doc_id, t in own:
            if doc_id is None:
                continue
            m = 75 + (25 * len(t) * n_docs) // n_terms
            score = sum(weight[x] * ((10**9 * t.count(x)) // (1000 * t.count(x) + 12 * m)) for x in terms_of(text) if x in df)
            if score > 0:
                scores.append((-score, doc_id))
        out += [(item, r + 1, doc_id, -s) for r, (s, doc_id) in enumerate(sorted(scores)[:k])]
    return sorted(out)


def collected(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(tuple(r) for r in df.collect())


def corpus(n=400, seed=3):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(300)]
    weights = [1 / (k + 1) for k in range(300)]
    docs = [(k, " ".join(rng.choices(words, weights, k=rng.choice([3, 30, 60, 400])))) for k in range(n)]
    docs += [(n + k, docs[5][1]) for k in range(n // 2)]  # a third of the rows is one text
    items = [(k, " ".join(rng.choices(words, k=rng.choice([1, 5, 40])))) for k in range(30)]
    items += [(30, docs[5][1]), (31, "W1 w1 w1 w250"), (32, "unknown words only"), (33, None), (34, ""), (35, "?!")]
    return docs, items


@pytest.mark.parametrize("small", [False, True])
def test_equals_brute_force(spark, monkeypatch, small):
    docs, items = corpus()
    if small:  # many batches of items, small blocks, few probes: more false hits, the same result
        for name, value in {"ITEMS_AT_ONCE": 10, "BLOCK_DOCUMENTS": 16, "PROBES": 1, "BITS_PER_ENTRY": 2, "TERM_STEP": 7}.items():
            monkeypatch.setattr(bitsliced, name, value)
        docs, items = docs[:150], items[::2]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    i = spark.createDataFrame(items, "item_id long, text string")
    assert collected(bitsliced.search(d, i)) == brute(docs, items)


def test_odd_rows(spark):
    docs, rows = odd_documents(spark, ["alpha beta gamma", "Alpha alpha beta", "straße ÄÖ äö x", "ipsum once"])
    odd = [(1, "alpha gamma nothing"), (1, "alpha beta"), (2, None), (None, "alpha"), (3, "LOREM ipsum ÄÖ straße"), (4, "some words row")]
    items = spark.createDataFrame([(i, t, 1, "s") for i, t in odd], "item_id long, text string, doc_id int, score string")
    got = collected(bitsliced.search(docs, items, 5))
    assert got == brute(rows, odd, 5)
    assert len([r for r in got if r[0] == 4 and r[2] == rows[-3][0]]) == 2  # a repeated row ranks twice


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert bitsliced.search(docs.limit(0), items).count() == 0
    assert bitsliced.search(docs, items.limit(0)).count() == 0
    assert bitsliced.search(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string"), items).count() == 0


def test_bounds_are_never_too_low_and_exclude_most():
    docs, items = corpus(300)
    blocks = {}
    known = np.unique(np.concatenate([w for _, w, _ in texts_of(pa.array([t for _, t in items]))]))
    length = {}
    for start, words, bounds in texts_of(pa.array([t for _, t in docs])):
        for k in range(len(bounds) - 1):
            own = words[bounds[k] : bounds[k + 1]]
            hashes = bitsliced.entries(*np.unique(own, return_counts=True))
            length[start + k] = (len(own), hashes)
    wanted = [np.searchsorted(known, np.concatenate([w for _, w, _ in texts_of(pa.array([t]))] or [known[:0]])) for _, t in items]
    filled = np.full((len(items), max(map(len, wanted))), len(known))
    for row, w in zip(filled, wanted):
        row[: len(w)] = w
    queries = bitsliced.Queries([i for i, _ in items], known, filled, len(docs), sum(n for n, _ in length.values()), np.full(len(known), 700))
    block = bitsliced._Block(1 << 13)
    block.most = len(docs) + 8
    block.bits = np.zeros((1 << 13, block.most // 8 + 1), np.uint8)
    for row, (n, hashes) in length.items():
        block.add(row, n, hashes)
    lengths = np.array(block.lengths)
    got = bitsliced.upper_bounds(block.bits[:, : -(-len(docs) // 8)], lengths, queries, queries.matrix())
    exact = np.zeros_like(got)
    for row, (_, text) in enumerate(items):
        for col, (_, doc) in enumerate(docs):
            t = terms_of(doc)
            m = int(queries.damping(lengths[col : col + 1])[0])
            exact[row, col] = sum(700 * ((10**9 * t.count(x)) // (1000 * t.count(x) + 12 * m)) for x in terms_of(text))
    assert (got >= exact).all()
    assert np.median(got[exact > 0] / exact[exact > 0]) < 1.2
    assert not blocks
