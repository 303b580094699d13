import hashlib
from hashlib import md5

import pytest
from pyspark.sql import functions as F

from lorespan import fixed_values as fixed
from lorespan.operators import tuning


def ids(spark, n, partitions=4):
    return spark.range(n, numPartitions=partitions).select(F.concat(F.lit("e"), "id").alias("example_id"))


def wanted_test(n, size, seed=68):
    keyed = sorted((hashlib.md5(f"{seed}:e{i}".encode()).hexdigest(), f"e{i}") for i in range(n))
    return {key for _, key in keyed[:size]}


def test_rows(df, split):
    return {r["example_id"] for r in df.filter(F.col("split") == split).collect()}


test_rows.__test__ = False


@pytest.mark.parametrize("size", [0, 1, 50, 1000, 4999])
def test_exact_size(spark, size):
    out = tuning.exact_split(ids(spark, 5000), "example_id", size)
    test, train = test_rows(out, "test"), test_rows(out, "train")
    assert test == wanted_test(5000, size)
    assert len(train) == 5000 - size and not test & train


def test_shared_hash_prefixes(spark, monkeypatch):
    monkeypatch.setattr(tuning, "_HISTOGRAM_DIGITS", 1)
    assert test_rows(tuning.exact_split(ids(spark, 300), "example_id", 123), "test") == wanted_test(300, 123)


def test_fraction_is_rounded_up(spark):
    assert len(test_rows(tuning.exact_split(ids(spark, 11), "example_id", 0.2), "test")) == 3


@pytest.mark.parametrize("partitions", [1, 4, 17])
def test_membership_ignores_partitioning(spark, partitions):
    assert test_rows(tuning.exact_split(ids(spark, 200, partitions), "example_id", 30, 7), "test") == wanted_test(200, 30, 7)


@pytest.mark.parametrize("size", [10, 11])
def test_too_large_a_test_split(spark, size):
    with pytest.raises(Exception, match="fewer rows"):
        tuning.exact_split(ids(spark, 10), "example_id", size).collect()


def test_complement(spark):
    df = ids(spark, 50)
    chosen = df.limit(7)
    test, train = tuning.complement(df, chosen, "example_id")
    assert test.count() == 7 and train.count() == 43 and test.intersect(train).count() == 0


TALK = [
    (1, 0, "system", "be kind"),
    (1, 1, "user", "q1"),
    (1, 2, "assistant", "a1"),
    (1, 3, "user", "q2"),
    (1, 4, "user", "q3"),
    (1, 5, "assistant", "a3"),
    (2, 0, "user", "q4"),
    (2, 1, "assistant", "a4"),
    (3, 0, "assistant", "a5"),
]


def test_pairs(spark):
    turns = spark.createDataFrame(TALK, "conv_id long, turn long, role string, text string")
    pairs = tuning.with_contexts(tuning.turn_pairs(turns), turns)
    rows = {r["example_id"]: (r["instruction"], r["context"], r["response"]) for r in pairs.collect()}
    assert rows == {"1-1": ("q1", "be kind", "a1"), "1-4": ("q3", "be kind", "a3"), "2-0": ("q4", None, "a4")}


@pytest.mark.parametrize("n", [0, 511, 512, 513])
def test_truncation(spark, n):
    df = spark.createDataFrame([(" ".join(["w"] * n),)], "text string")
    row = tuning.tokenize(df).first()
    assert len(row["input_ids"]) == min(n, 512)
    assert row["truncated"] == (n > 512)
    assert set(row["input_ids"]) <= {1 + int(hashlib.md5(b"w").hexdigest()[:8], 16) % 49999}


def test_plugged_byte_pair_tokenizer(spark):
    tokenizers = pytest.importorskip("tokenizers")
    public = pytest.importorskip("public_tokenizers")
    path = public.path("byte_bpe_50k.json")
    whole = tokenizers.Tokenizer.from_file(path)

    def load():
        import tokenizers

        tokenizer = tokenizers.Tokenizer.from_file(path)
        return lambda texts: [tokenizer.encode(t).ids for t in texts]

    df = spark.createDataFrame([("lowest slow",)], "text string")
    row = tuning.tokenize(df, max_tokens=2, load_tokenizer=load).first()
    assert row["input_ids"] == whole.encode("lowest slow").ids[:2] and row["truncated"]


def test_collation(spark):
    rows = [(f"e{i}", list(range(1, i + 2))) for i in range(21)] + [("z", [3, 0, 4])]
    df = spark.createDataFrame(rows, "example_id string, input_ids array<int>")
    out = tuning.collate(df, "example_id", batch_rows=4, range_rows=5).collect()
    assert {r["example_id"] for r in out} == {r[0] for r in rows}
    order = sorted(source := dict(rows), key=lambda i: (md5(f"{fixed.TRAIN_SEED}:{i}".encode()).hexdigest(), i))
    assert {r["example_id"]: r["batch"] for r in out} == {i: at // 4 for at, i in enumerate(order)}
    batches = {}
    for r in out:
        batches.setdefault(r["batch"], []).append(r)
    for batch, members in batches.items():
        assert len(members) == 4 or batch == max(batches)
        longest = max(len(source[r["example_id"]]) for r in members)
        for r in members:
            own = source[r["example_id"]]
            pad = longest - len(own)
            assert r["input_ids"] == own + [0] * pad
            assert r["attention_mask"] == [1] * len(own) + [0] * pad
            assert r["labels"] == [t if t else -100 for t in own] + [-100] * pad


def test_marker_ids(spark):
    vocabulary = spark.createDataFrame([("<|endoftext|>", 0), ("<pad>", 9)], "token string, id int")
    row = spark.range(1).select(tuning.marker_id().alias("a"), tuning.marker_id("<pad>", vocabulary).alias("b")).first()
    assert tuple(row) == (0, 9)


def test_dataset(spark, tmp_path):
    rows = [(f"e{i}", "do it", "facts" if i % 2 else None, "done") for i in range(20)]
    examples = spark.createDataFrame(rows, "example_id string, instruction string, context string, response string")
    built = tuning.build_dataset(examples, str(tmp_path / "sft"), 5)
    assert built.filter("split = 'test'").count() == 5 and built.count() == 20
    assert {p.name for p in (tmp_path / "sft").iterdir() if p.is_dir()} == {"split=test", "split=train"}


def test_running_numbers_are_those_of_one_sorted_table(spark):
    rows = [(f"e{i}",) for i in range(700)]
    df = spark.createDataFrame(rows, "example_id string").repartition(5)
    order = sorted((r[0] for r in rows), key=lambda i: md5(f"{fixed.TRAIN_SEED}:{i}".encode()).hexdigest())
    for range_rows in (1 << 20, 100, 8):
        got = {r["example_id"]: r["row_number"] for r in tuning.running_numbers(df, "example_id", range_rows=range_rows).collect()}
        assert got == {i: at + 1 for at, i in enumerate(order)}
    assert tuning.running_numbers(df.limit(0), "example_id").count() == 0


def test_no_task_numbers_more_than_a_range(spark):
    """Only counts of ranges meet in one task; rows are numbered by range."""
    df = spark.createDataFrame([(f"e{i}", [1]) for i in range(300)], "example_id string, input_ids array<int>")
    plan = tuning.collate(df, "example_id", range_rows=8)._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    by_range = [w for w in windows if "row_number() windowspecdefinition(_range" in w]
    by_batch = [w for w in windows if "windowspecdefinition(batch" in w]
    sums = [w for w in windows if "windowspecdefinition(_range" in w and "sum(" in w]  # over the counts of ranges
    assert len(windows) == 3 and len(by_range) == len(by_batch) == len(sums) == 1


def test_gaps_between_turns_are_found(spark):
    turns = spark.createDataFrame([(1, 0), (1, 1), (2, 0), (2, 2), (3, 5)], "conv_id long, turn int")
    assert [r["conv_id"] for r in tuning.turn_gaps(turns).collect()] == [2]
