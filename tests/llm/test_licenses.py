import re

import pytest
from helpers import LOWER, odd_documents

from lorespan.llm import licenses

RULE = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
GPL = "This work is licensed under the GNU General Public License, version 3."
MIT = dict(licenses.TEMPLATES)["mit"]

TEXTS = [
    "Released under the MIT License.",
    "Licensed under CC BY-NC 4.0. cc by nc cc by nc",
    "Licensed under the Apache License, Version 2.0.",
    GPL,
    "filler words " * 40 + GPL + " more words" * 40,
    "x " * 100 + MIT.upper() + " y" * 500,
    "permission free of charge software",
    "the gnu general public was licensed by version under a work",
    "under the mıt license under the mit license",
    "underthe mit license, UNDER THE MIT LICENSE",
    "é " * 31 + MIT,
    "word " * 30_000 + "cc by nc",
    "copyright 2020 someone, all rights reserved",
]


def words_of(text):
    return RULE.findall((text or "").translate(LOWER))


def brute(rows, phrases=licenses.PHRASES, templates=licenses.TEMPLATES, percent=licenses.PERCENT):
    out = []
    for doc_id, text in rows:
        w = words_of(text)
        base, labels, share = [], set(), 0.0
        for phrase, label in phrases.items():
            p = words_of(phrase)
            places = [k for k in range(len(w) - len(p) + 1) if p and w[k : k + len(p)] == p]
            base += places
            labels |= {label} if places else set()
        more = set()
        for label, template in templates:
            t = words_of(template)
            half = 16
            while half < len(t):
                half *= 2
            for k in range(0, max(len(w) - half, 1 if w else 0), half):
                held = 100 * len(set(t) & set(w[k : k + 2 * half]))
                if t and held >= percent * len(set(t)):
                    more.add(label)
                    share = max(share, held / 100 / len(set(t)))
        score = 1.0 if base else share
        first, last = (min(base), max(base)) if base else (None, None)
        out.append((doc_id, len(w), len(base), first, last, ",".join(sorted(labels)), ",".join(sorted(labels | more)), score))
    return sorted(out, key=repr)


def collected(df):
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    assert df.columns == names
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_equals_brute_force_on_odd_rows(spark):
    docs, rows = odd_documents(spark, TEXTS)
    got = collected(licenses.scan(docs))
    assert got == brute(rows)
    by_id = {r[0]: r for r in got}
    assert by_id[0][2:6] == (1, 1, 1, "mit") and by_id[1][2:5] == (3, 2, 10)
    assert by_id[3][5:] == ("", "gpl-3", 1.0) and by_id[4][6] == "gpl-3" and by_id[5][6] == "mit"
    assert by_id[6][6] == "" and by_id[7][6] == "" and by_id[8][2] == 1


def test_blocks_at_any_place(spark):
    """A template is found wherever it begins."""
    rows = [(k, "w " * k + MIT + " w" * 200) for k in range(0, 140, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.labels for r in licenses.scan(docs).collect()} == {"mit"}


def test_thresholds_phrases_and_templates_of_the_caller(spark):
    rows = [(1, "a b a b a"), (2, "one two three four"), (3, "one two three"), (4, "one two"), (5, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    phrases, templates = {"a b a": "aba", "?!": "nothing"}, (("four", "one two three four"), ("none", " ... "))
    for percent in (50, 75, 100):
        assert collected(licenses.scan(docs, phrases, templates, percent)) == brute(rows, phrases, templates, percent)
    assert collected(licenses.scan(docs, phrases, (), 75)) == brute(rows, phrases, (), 75)
    assert collected(licenses.scan(docs, {}, templates, 75)) == brute(rows, {}, templates, 75)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, row long, words string, blocks int")
    assert licenses.scan(docs).count() == 0


def test_only_column_expressions_and_joins(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    plan = licenses.scan(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("shuffled", [False, True])
def test_large_sets_of_templates_are_joined_by_shuffling(spark, monkeypatch, shuffled):
    if shuffled:
        monkeypatch.setattr(licenses, "BROADCAST_BYTES", 0)
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(TEXTS)], "doc_id long, text string")
    assert collected(licenses.scan(docs)) == brute(list(enumerate(TEXTS)))
