from helpers import odd_documents

import numpy as np

from lorespan.llm import quality, toxicity


def test_rows_are_kept_by_their_scores_in_all_columns(spark):
    df, rows = odd_documents(spark, ["a clean text of words", "you idiot idiot idiot"])
    model = toxicity.Model({"idiot": 5.0}, np.array([1.0, 1.0, 1.0, 0.0, 0.0, -4.0]))
    kept = toxicity.without_toxic(df, model)
    assert kept.columns == df.columns and kept.schema == df.schema
    assert sorted(map(str, kept.collect())) == sorted(map(str, df.where("doc_id IS NULL OR doc_id <> 1").collect()))
    assert toxicity.without_toxic(df.limit(0), model).collect() == []


def test_quality_filter_agrees_with_the_scores(spark):
    df, rows = odd_documents(spark, ["short", "LOUD!! LOUD!! LOUD!!", "plain words of a text"])
    width = quality.N_CLASSES * 2 + 7
    text = np.zeros(width + 1)
    text[0] = -30.0  # capitals
    text[-1] = 1.0
    one = np.array([1.0, 0.0])
    model = quality.Model(text, np.zeros(quality.SOURCE_BUCKETS + 19), (np.zeros(width), np.ones(width)), one, one, np.array([1.0, 0.0, 0.0]))
    kept = quality.without_bad(df, model)
    assert kept.schema == df.schema
    bad = {r.doc_id for r in quality.score(df, model).collect() if r.score < 0.5}
    assert bad == {1}
    assert kept.where("doc_id = 1").count() == 0 and kept.count() == len(rows) - 1
    narrow = df.select("text", "doc_id")
    assert quality.without_bad(narrow, model).count() == len(rows) - 1
