import numpy as np
import pytest

import __spark_entry__ as entry
import check
import corpus_pipeline
from lorespan.llm import oracles, queries


@pytest.fixture(scope="module")
def db(folder):
    return check.open_tables(folder)


@pytest.mark.parametrize("name", list(oracles.SQL))
def test_query_matches_sql(spark, db, folder, name):
    same, note = check.compare(spark, db, folder, name)
    assert same, note


def test_all_are_registered():
    names = set(entry.queries())
    assert "pipeline" in names and {n.split("_")[0] for n in queries.registered()} == {f"op{k}" for k in range(1, 14)}
    assert set(oracles.SQL) <= set(queries.registered())


def labels_of(db):
    return {r[0]: (r[1], r[2]) for r in db.execute("SELECT doc_id, quality, toxic FROM labels").fetchall()}


@pytest.mark.parametrize("name, column, least", [("op5_quality_co_training", 0, 0.95), ("op6_toxicity_grammar", 1, 0.93)])
def test_held_out_accuracy(spark, name, column, least):
    folder = "/root/testdata/sf0.01"
    db = check.open_tables(folder)
    labels = labels_of(db)
    rows = entry.queries()[name](spark, folder).collect()
    assert len(rows) == 1000 and {r.predicted for r in rows} <= {0, 1}
    right = [labels[r.doc_id][column] == r.predicted for r in rows if r.held_out and r.doc_id in labels]
    assert len(right) > 50 and np.mean(right) >= least


def test_pages_lose_everything_but_the_article(spark, db, folder):
    import re
    from html import unescape

    got = {r.page_id: r.text for r in entry.queries()["op9_html_extraction"](spark, folder).collect()}
    for page, html in db.execute("SELECT page_id, html FROM pages").fetchall():
        body = re.search(r"<article>(.*?)(</article>|$)", html, re.S).group(1)
        parts = [" ".join(unescape(re.sub("<[^>]*>", "", p.replace("<br>", " "))).split()) for p in re.split("</?(?:p|h1)>", body)]
        assert got[page] == "\n\n".join(p for p in parts if p)


def test_stages_decide_for_the_next(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "quality_classifier", "ngram_jaccard_join", "benchmark_decontamination", "best_fit_packing"]
    from test_decontaminate import brute as leaks
    from test_jaccard_join import brute as groups

    bench = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]
    for name, stage in corpus_pipeline.STAGES:
        before = [tuple(r) for r in docs.select("doc_id", "text").collect()]
        out = stage(spark, docs, folder)
        if name == "best_fit_packing":
            assert {r.doc_id for r in out.collect()} == {i for i, _ in before}
            continue
        assert out.columns == docs.columns
        path = spark.conf.get("spark.checkpoint.dir", None)
        kept = {r.doc_id for r in out.collect()}
        if name == "ngram_jaccard_join":
            assert kept == {c for _, c in groups(before).values()}
        if name == "benchmark_decontamination":
            hit = leaks([r for r in before if len(r[1]) < 3000], bench)
            assert {i for i, _ in before if i in hit and not any(x[4] for x in hit[i])} == {i for i in kept if i in hit}
        assert kept <= {i for i, _ in before} and len(kept) > 0.5 * len(before), path
        docs = docs.where(docs.doc_id.isin(*kept))
    final = {r.doc_id for r in corpus_pipeline.run(spark, folder).collect()}
    assert final == {r.doc_id for r in docs.select("doc_id").collect()}
