from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from lorespan import schemas
from lorespan.operators import evaluate
from lorespan.plans import queries
from lorespan.session import clear_scratch, materialize, scratch_path, scratch_root
from lorespan.sources import index_store, tables, versions


def test_table_round_trip(spark, folder):
    tables.use_namespace(spark, "lorespan_test")
    sources = tables.sources_from(tables.test_table(spark, folder, "documents"))
    tables.save_table(sources, "sources")
    assert spark.table("sources").schema.names == schemas.SOURCES.names
    assert tables.row_count(spark.table("sources")).first()["n_rows"] == 200
    tables.save_table(sources.select("doc_id"), "sources")
    assert spark.table("sources").columns == ["doc_id"]
    assert tables.preview(spark.table("sources"), 3).count() == 3
    spark.sql("DROP TABLE sources")
    spark.sql("DROP DATABASE lorespan_test CASCADE")
    spark.sql("USE default")


@pytest.mark.parametrize("file_format", ["parquet", "json", "orc", "csv"])
def test_formats(spark, tmp_path, file_format):
    df = spark.createDataFrame([(1, "a", "s"), (2, "b", None)], schemas.SOURCES)
    path = str(tmp_path / file_format)
    df.write.format(file_format).option("header", "true").save(path)
    assert sorted(map(tuple, tables.scan(spark, path, schemas.SOURCES, file_format).collect())) == [(1, "a", "s"), (2, "b", None)]


def test_index_round_trip_and_listing(spark, folder, tmp_path):
    sources = tables.sources_from(tables.test_table(spark, folder, "documents"))
    path = str(tmp_path / "index")
    index_store.save_index(index_store.build_index(sources, 100, 10), path)
    index = index_store.load_index(spark, path)
    assert index.count() == 980 and index.select("chunk_id").distinct().count() == 980
    listing = tables.list_files(spark, path)
    assert listing.columns == ["path", "length", "modificationTime"]
    assert listing.filter("path LIKE '%.parquet' AND length > 0").count() > 0


def test_bucketed_index_is_not_shuffled(spark, folder):
    sources = tables.sources_from(tables.test_table(spark, folder, "documents"))
    index_store.save_index_table(index_store.build_index(sources, 100, 10), "lorespan_bucketed", 4)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        wanted = spark.table("lorespan_bucketed").select("chunk_id").limit(5)
        joined = spark.table("lorespan_bucketed").select("chunk_id", "response").join(wanted, "chunk_id")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        side = plan[: plan.index("Exchange")] if "Exchange" in plan else plan
        assert "lorespan_bucketed" in side and joined.count() == 5
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        spark.sql("DROP TABLE lorespan_bucketed")


def test_longest(spark):
    df = spark.createDataFrame([(1, "aa"), (2, "ééé"), (3, "abc"), (4, None)], "doc_id long, response string")
    assert tuple(tables.longest(df, "response", "doc_id").first()) == (2, 3, "ééé")


def test_version_log(spark, tmp_path):
    log = versions.VersionLog(spark, str(tmp_path / "log"))
    made = [log.register("main.qa.index", f"/index/{i}") for i in range(1, 11)]
    assert made == list(range(1, 11))
    assert log.register("other", "/o/1") == 1
    assert tuple(versions.latest(log.versions(), "main.qa.index").first()) == ("main.qa.index", 10, "/index/10")
    log.set_alias("main.qa.index", 9)
    log.set_alias("main.qa.index", 2)
    assert log.path("main.qa.index@Production") == "/index/2"
    log.set_alias("main.qa.index", 10)
    assert log.path("main.qa.index@Production") == "/index/10"
    with pytest.raises(ValueError):
        log.set_alias("main.qa.index", 77)
    with pytest.raises(ValueError):
        log.path("other@Production")


def test_evaluation_runs(spark, tmp_path):
    answers = spark.createDataFrame(
        [("1", "b?", "Some words. Here.", "s", None), ("2", "a?", None, None, None), ("3", "c?", "", "s", None)],
        "question_id string, question string, answer string, source string, output_metadata string",
    )
    path = str(tmp_path / "eval")
    evaluate.append_results(evaluate.run_outputs(answers, "r1"), path)
    evaluate.append_results(evaluate.run_outputs(answers.withColumn("answer", F.lit("same")), "r2"), path)
    results = tables.scan(spark, path, schemas.EVAL_RESULTS, "json")
    shown = [(r["question"], r["run_id"], r["answer"]) for r in evaluate.compare_runs(results).collect()]
    assert [q for q, _, _ in shown] == ["a?", "a?", "b?", "b?", "c?", "c?"]
    assert ("a?", "r1", None) in shown and ("a?", "r2", "same") in shown
    metrics = {r["run_id"]: r for r in evaluate.summarize(results.withColumn("target", F.lit("same")), "target").collect()}
    assert metrics["r1"]["n_answered"] == 2 and metrics["r1"]["answered_rate"] == pytest.approx(2 / 3, abs=1e-6)
    assert metrics["r1"]["mean_tokens"] == 1.5 and metrics["r1"]["exact_match"] == 0
    assert metrics["r1"]["mean_ari"] == pytest.approx(4.71 * 13 / 3 + 0.5 * 3 / 2 - 21.43, abs=1e-6)
    assert metrics["r2"]["exact_match"] == 1


def session_like(master, **conf):
    context = SimpleNamespace(master=master, applicationId=f"app-{master}")
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: conf.get(key, default)), sparkContext=context)


def test_scratch_folder_comes_from_the_session():
    named = session_like("spark://somewhere", **{"spark.checkpoint.dir": "hdfs:///shared"})
    assert scratch_root(named) == "hdfs:///shared"


def test_scratch_folder_of_a_cluster_has_to_be_named():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_root(session_like("spark://somewhere"))


def test_local_scratch_folder_is_made_once():
    local = session_like("local[2]")
    assert scratch_root(local) == scratch_root(local)


def test_materialized_rows(spark):
    assert sorted(r["id"] for r in materialize(spark.range(3), "x").collect()) == [0, 1, 2]


def test_clearing_the_scratch_folder(spark):
    before = scratch_path(spark, "x")
    materialize(spark.range(3), "x")
    clear_scratch(spark)
    assert not Path(before).parent.exists()
    assert materialize(spark.range(3), "x").count() == 3
