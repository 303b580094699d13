import random
import re
from hashlib import sha256

from helpers import LOWER, odd_documents

from lorespan.llm import decontaminate

RULE = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return RULE.findall((text or "").translate(LOWER))


def brute(rows, items, width=10):
    windows = []
    for i, t in items:
        w = words(t)
        n = min(width, len(w))
        windows += [(i, w[k : k + n]) for k in range(len(w) - n + 1)] if n else []
    out = {}
    for i, t in rows:
        w, hit, names = words(t), set(), set()
        for item, win in windows:
            for k in range(len(w) - len(win) + 1):
                if w[k : k + len(win)] == win:
                    hit |= set(range(k, k + len(win)))
                    names |= {str(item)} if item is not None else set()
        digest = sha256(",".join(sorted(names)).encode()).hexdigest()
        out.setdefault(i, set()).add((len(w), len(hit), len(names), digest, bool(hit)))
    return out


def test_matches_brute_force(spark):
    draw = random.Random(11)
    vocabulary = ["the", "of", "and"] * 8 + [f"w{k}" for k in range(60)]
    items = [(k, " ".join(draw.choices(vocabulary, k=draw.randrange(8, 30)))) for k in range(12)]
    items += [(20, "Short ITEM, here!"), (21, "one"), (22, None), (23, "..."), (24, items[0][1]), (None, "no id but ten words one two three four five six seven")]
    texts = []
    for _ in range(40):
        w = draw.choices(vocabulary, k=draw.randrange(0, 40))
        if draw.random() < 0.6:
            source = words(draw.choice(items[:12])[1])
            a = draw.randrange(len(source))
            w[draw.randrange(len(w) + 1) : 0] = source[a : a + draw.randrange(5, 25)]
        texts.append(" - ".join(w).upper())
    texts += ["x short item HERE y short item here", items[3][1] * 2, "one one-one"]
    df, rows = odd_documents(spark, texts)
    # The frame's long text is checked apart: brute force takes too long on it.
    rows = [r for r in rows if len(r[1] or "") < 10_000]
    df = df.where("text IS NULL OR length(text) < 10000")
    bench = spark.createDataFrame([(*i, "clash") for i in items], "item_id long, text string, window string")
    got = {}
    for r in decontaminate.contamination(df, bench).collect():
        if r.doc_id is not None:
            got.setdefault(r.doc_id, set()).add((r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated))
    want = brute(rows, items)
    want.pop(None)
    assert got == want
    assert sum(any(x[4] for x in v) for v in want.values()) > 10


def test_blocks_of_terms_give_the_same(spark, monkeypatch):
    df = spark.createDataFrame([(1, "a b c d e f g h i j k"), (2, "j i h g"), (3, "z a b c")], "doc_id long, text string")
    bench = spark.createDataFrame([(7, "b c d e f g h i j k"), (8, "h g")], "item_id long, text string")
    whole = sorted(decontaminate.contamination(df, bench).collect())
    monkeypatch.setattr(decontaminate, "TERM_BLOCK", 3)
    assert sorted(decontaminate.contamination(df, bench).collect()) == whole
    assert [(r.doc_id, r.n_hit, r.n_items) for r in whole] == [(1, 10, 1), (2, 2, 1), (3, 0, 0)]


def test_long_texts_and_empty_tables(spark):
    df, _ = odd_documents(spark)
    bench = spark.createDataFrame([(1, "ipsum dolor sit amet lorem ipsum dolor sit amet lorem ipsum")], "item_id long, text string")
    long_row = [r for r in decontaminate.contamination(df, bench).collect() if r.n_words == 100_000]
    assert [(r.n_hit, r.n_items) for r in long_row] == [(99_999 - 2, 1)] or long_row[0].n_hit > 99_000
    none = spark.createDataFrame([], "item_id long, text string")
    assert {r.contaminated for r in decontaminate.contamination(df, none).collect()} == {False}
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert decontaminate.contamination(empty, bench).collect() == []


def test_proximity(spark):
    df = spark.createDataFrame([(1, "the quick red brown fox"), (2, "quick a b c d e brown"), (3, "brown quick"), (4, None)], "doc_id long, text string")
    phrases = spark.createDataFrame([("p", "quick brown"), ("q", None), ("r", "the quick")], "phrase_id string, text string")
    got = sorted((r.phrase_id, r.doc_id, r.start) for r in decontaminate.proximity_matches(df, phrases, slop=3).collect())
    assert got == [("p", 1, 1), ("r", 1, 0)]


def plain_proximity(docs, phrases, slop):
    out = []
    for phrase_id, phrase in phrases:
        wanted = words(phrase)
        for doc_id, text in docs:
            own = words(text)
            for first in range(len(own)) if wanted and doc_id is not None else ():
                last, alive = first, own[first] == wanted[0]
                for term in wanted[1:]:
                    last = next((k for k in range(last + 1, len(own)) if own[k] == term), None) if alive else last
                    alive = alive and last is not None
                    last = last or 0
                if alive and last - first < len(wanted) + slop:
                    out.append((phrase_id, doc_id, first))
    return sorted(out)


def test_proximity_equals_brute_force(spark):
    draw = random.Random(3)
    vocabulary = ["the", "the", "the", "of", "of", "red", "fox", "quick", "rare"]
    docs = [(k, " ".join(draw.choices(vocabulary, k=draw.randrange(0, 25)))) for k in range(60)] + [(None, "the red fox"), (70, None)]
    docs += [(5, "the quick red of fox"), (71, "the " * 3000 + "red x fox")]
    phrases = [("a", "the red fox"), ("b", "red red"), ("c", "rare the of"), ("d", "the"), ("e", ""), ("f", None), ("g", "missing the"), ("h", "the red fox")]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    p = spark.createDataFrame(phrases, "phrase_id string, text string")
    for slop in (0, 2):
        got = sorted((r.phrase_id, r.doc_id, r.start) for r in decontaminate.proximity_matches(d, p, slop).collect())
        assert got == plain_proximity(docs, phrases, slop)


def test_proximity_reads_the_lists_of_the_rarest_terms(spark, monkeypatch):
    asked = []
    whole = decontaminate.positional_index
    monkeypatch.setattr(decontaminate, "positional_index", lambda docs, terms: asked.append(terms.count()) or whole(docs, terms))
    d = spark.createDataFrame([(k, f"a b c d e word{k}") for k in range(20)], "doc_id long, text string")
    p = spark.createDataFrame([(1, "a b c d e word7")], "phrase_id int, text string")
    assert [tuple(r) for r in decontaminate.proximity_matches(d, p).collect()] == [(1, 7, 0)]
    assert asked == [decontaminate.ANCHORS]


def test_different_long_words_are_no_hit(spark):
    from test_shingles import parity_words

    a, b = parity_words(1024)
    docs = spark.createDataFrame([(1, a), (2, b)], "doc_id long, text string")
    items = spark.createDataFrame([(7, a)], "item_id long, text string")
    got = {r.doc_id: r.n_hit for r in decontaminate.contamination(docs, items).collect()}
    assert got == {1: 1, 2: 0}
