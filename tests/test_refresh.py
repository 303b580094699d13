import pytest
from pyspark.sql import functions as F

from lorespan.sources import index_refresh, index_store

SIZES = {"size": 6, "overlap": 1}


def sources(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, response string, source string")


def same_as_rebuilt(spark, path, rows):
    got = index_refresh.read_index(spark, path)
    want = index_store.build_index(sources(spark, rows), **SIZES)
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_refreshes_equal_a_rebuild_and_embed_changes_only(spark, tmp_path):
    path = str(tmp_path / "ix")
    text = " ".join(f"word{k}" for k in range(20))
    rows = [(k, f"{text} {k}", f"s{k}") for k in range(12)] + [(12, None, "s"), (13, "", None)]
    assert index_refresh.refresh_index(sources(spark, rows), path, **SIZES) == 1
    same_as_rebuilt(spark, path, rows)
    # One text is new, one source, one was added, two are gone; a null text gets words, an empty one becomes null.
    later = [(0, "entirely new words", "s0"), (1, rows[1][1], "other"), *rows[2:10], (12, "now there", "s"), (13, None, None), (50, text, "s50")]
    assert index_refresh.refresh_index(sources(spark, later), path, **SIZES) == 2
    same_as_rebuilt(spark, path, later)
    taken_up = spark.read.parquet(f"{path}/chunks/generation=2")
    changed = [r for r in later if r not in rows]
    assert {r[0] for r in changed} == {0, 1, 12, 13, 50}
    assert taken_up.count() == index_store.build_index(sources(spark, changed), **SIZES).count()
    assert {(r["doc_id"], r["gone"]) for r in spark.read.parquet(f"{path}/documents/generation=2").collect()} == {(0, False), (1, False), (12, False), (13, False), (50, False), (10, True), (11, True)}
    # Nothing changed; then a document comes back as it was.
    index_refresh.refresh_index(sources(spark, later), path, **SIZES)
    assert spark.read.parquet(f"{path}/chunks/generation=3").count() == 0
    index_refresh.refresh_index(sources(spark, later + [rows[10]]), path, **SIZES)
    same_as_rebuilt(spark, path, later + [rows[10]])


def test_compaction_and_what_breaks_off(spark, tmp_path):
    path = str(tmp_path / "ix")
    rows = [(k, f"some words of text {k}", "s") for k in range(8)]
    index_refresh.refresh_index(sources(spark, rows), path, **SIZES)
    later = [(0, "changed", "s"), *rows[2:]]
    # Chunks without their documents are of a refresh that broke off.
    index_store.build_index(sources(spark, [(0, "half done", "s")]), **SIZES).write.parquet(f"{path}/chunks/generation=2")
    same_as_rebuilt(spark, path, rows)
    assert index_refresh.refresh_index(sources(spark, later), path, **SIZES) == 2
    same_as_rebuilt(spark, path, later)
    assert index_refresh.compact(spark, path) == 3
    same_as_rebuilt(spark, path, later)
    assert sorted(p.name for p in (tmp_path / "ix" / "documents").iterdir()) == ["generation=3"]
    index_refresh.refresh_index(sources(spark, rows), path, **SIZES)
    same_as_rebuilt(spark, path, rows)
    assert spark.read.parquet(f"{path}/chunks/generation=4").select("doc_id").distinct().count() == 2


def test_odd_sources(spark, tmp_path):
    path = str(tmp_path / "ix")
    assert index_refresh.compact(spark, path) == 0
    assert index_refresh.read_index(spark, path).count() == 0
    index_refresh.refresh_index(sources(spark, []), path, **SIZES)
    assert index_refresh.read_index(spark, path).count() == 0
    for rows in ([(1, "a", "s"), (1, "b", "s")], [(None, "a", "s")]):
        with pytest.raises(Exception, match="more than once or is null"):
            index_refresh.refresh_index(sources(spark, rows), str(tmp_path / "bad"), **SIZES)


def test_only_changed_texts_move(spark, tmp_path):
    """Digests meet in a join; texts are thinned where they are read."""
    path = str(tmp_path / "docs")
    sources(spark, [(k, f"text {k}", "s") for k in range(50)]).write.parquet(path)
    stored = spark.read.parquet(path)
    index_refresh.refresh_index(stored, str(tmp_path / "ix"), **SIZES)
    changed = stored.withColumn("response", F.when(F.col("doc_id") == 7, "other").otherwise(F.col("response")))
    index_refresh.refresh_index(changed, str(tmp_path / "ix"), **SIZES)
    assert [r["doc_id"] for r in spark.read.parquet(str(tmp_path / "ix/chunks/generation=2")).collect()] == [7]
