from pyspark.sql import functions as F

from lorespan.operators.lookup import hot_key_lookup, possible_rows, rows_if_small, salted_lookup


def skewed(spark):
    """A third of the rows under one key."""
    left = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 500).alias("k"))
    right = spark.range(400).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    return left, right


def same(a, b):
    columns = sorted(a.columns)
    assert sorted(map(tuple, a.select(columns).collect()), key=str) == sorted(map(tuple, b.select(columns).collect()), key=str)


def test_salted_lookup_is_a_join(spark):
    left, right = skewed(spark)
    for how in ("left", "inner"):
        same(salted_lookup(left, right, ["k"], ["id"], how), left.join(right, "k", how))


def test_hot_key_lookup_is_a_join(spark):
    left, right = skewed(spark)
    counts = left.groupBy("k").agg(F.count("*").alias("n"))
    for how in ("left", "inner"):
        for hot_rows in (50, 10**6):
            same(hot_key_lookup(left, right, "k", counts, ["id"], how, hot_rows), left.join(right, "k", how))


def test_hot_key_is_split(spark):
    """With broadcasting off, the rows of the hot key arrive in more than one partition."""
    left, right = skewed(spark)
    counts = left.groupBy("k").agg(F.count("*").alias("n"))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        def parts(df):
            return df.filter("k = 7").select(F.spark_partition_id().alias("p")).distinct().count()

        assert parts(left.join(right, "k", "left")) == 1
        assert parts(hot_key_lookup(left, right, "k", counts, ["id"], "left", 50)) > 1
        assert parts(salted_lookup(left, right, ["k"], ["id"])) > 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_rows_if_small(spark):
    assert len(rows_if_small(spark.range(5), 5)) == 5
    assert rows_if_small(spark.range(6), 5) is None


def test_possible_rows_hold_all_wanted_and_few_others(spark):
    table = spark.range(50_000).selectExpr("CAST(id AS STRING) AS k", "id").unionByName(spark.createDataFrame([(None, -1)], "k string, id long"))
    wanted = spark.range(0, 50_000, 500).selectExpr("CAST(id AS STRING) AS k", "id AS n").unionByName(spark.createDataFrame([(None, 1)], "k string, n long"))
    got = {r["id"] for r in possible_rows(table, "k", wanted).collect()}
    assert set(range(0, 50_000, 500)) <= got and len(got) < 150 and -1 not in got
    assert possible_rows(table, "k", wanted.limit(0)).count() == 0


def test_texts_of_hits_take_one_scan(spark, tmp_path):
    from lorespan.operators.retrieve import fetch_texts

    path = str(tmp_path / "index")
    spark.range(3000).selectExpr("CAST(id AS STRING) AS chunk_id", "concat('text ', id) AS response", "'s' AS source").write.parquet(path)
    index = spark.read.parquet(path)
    hits = spark.range(9000).selectExpr("id AS question_id", "CAST(IF(id % 3 = 0, 7, id % 4000) AS STRING) AS chunk_id")
    found = fetch_texts(hits, index)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("response#") and sum("Relation" in line and "response" in line for line in plan.splitlines()) == 1
    want = hits.join(index, "chunk_id").select("question_id", "chunk_id", "response", "source")
    same(found.select(*want.columns), want)
