import pytest
from pyspark.sql import functions as F

from lorespan.functions import text as txt
from lorespan.operators import answer, dictionary, lookup, retrieve
from lorespan.sources import index_store

DOCS = [
    (1, "Tables keep rows. Rows have columns.", "s1"),
    (2, "Streams are unbounded tables. A sink writes them.", "s2"),
    (3, "Cats sleep a lot. They purr.", "s3"),
]
SCHEMA = "doc_id long, response string, source string"


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("index"))
    index_store.save_index(index_store.build_index(spark.createDataFrame(DOCS, SCHEMA), 50, 5), path)
    return index_store.load_index(spark, path)


def candidates(spark, n=300, hot=True):
    """Ranked candidates; key 0 holds a third of them, its only good one far down the list."""
    rows = []
    for key in range(1, 41):
        for rank in range(1, 6):
            good = (key + rank) % 7 == 0
            rows.append((key, rank, "fine" if good else "わかりません" if rank % 2 else None, f"s{rank}", None))
    if hot:
        for rank in range(1, 101):
            rows.append((0, rank, "fine" if rank == 77 else "わかりません", f"s{rank}", None))
    return spark.createDataFrame(rows, "key long, rank int, answer string, source string, output_metadata string")


@pytest.mark.parametrize("growth", [1, 2])
def test_cascade_equals_one_pass(spark, growth):
    df = candidates(spark, hot=growth == 2)
    good = txt.is_good_answer(F.col("answer"))
    one_pass = answer.first_good(df, ["key"], good)
    looped = answer.cascade(df, "key", lambda rows: rows, good, growth)
    keys = df.select("key").distinct()
    a = answer.with_defaults(keys, one_pass, "key").collect()
    b = answer.with_defaults(keys, looped, "key").collect()
    assert sorted(map(tuple, a), key=str) == sorted(map(tuple, b), key=str)
    assert len(a) == keys.count()
    assert any(r["answer"] is None for r in a) and any(r["answer"] for r in a)
    if growth == 2:
        assert [r["source"] for r in a if r["key"] == 0] == ["s77"]


def test_cascade_without_hits(spark):
    good = txt.is_good_answer(F.col("answer"))
    assert answer.cascade(candidates(spark).limit(0), "key", lambda rows: rows, good).count() == 0


def questions(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "question_id long, question string")


def test_extractive_end_to_end(spark, index):
    asked = questions(spark, ["Do cats purr", "What do tables keep", "zzz", None, "Do cats purr"])
    rows = {r["question_id"]: r for r in answer.answer_questions(asked, index, k=2).collect()}
    assert rows[0]["answer"] == "They purr" or rows[0]["answer"] == "Cats sleep a lot"
    assert rows[0]["source"] == "s3"
    assert rows[1]["answer"] == "Tables keep rows" and rows[1]["source"] == "s1"
    assert rows[2]["answer"] is None and rows[2]["source"] is None and rows[2]["output_metadata"] is None
    assert rows[3]["answer"] is None
    assert tuple(rows[4])[2:] == tuple(rows[0])[2:]
    assert len(rows) == 5


def test_model_is_asked_as_little_as_possible(spark, index):
    """Equal questions are asked once, and a question stops at its first good answer."""
    calls = spark.sparkContext.accumulator(0)

    def load():
        def model(prompts, options):
            calls.add(len(prompts))
            return [("purr" if "Cats" in p else "わかりません", "m") for p in prompts]

        return model

    asked = questions(spark, ["cats sleep"] * 20 + ["tables rows columns"])
    rows = answer.answer_questions(asked, index, k=3, load_model=load).collect()
    assert len(rows) == 21
    assert all(r["answer"] == "purr" and r["source"] == "s3" and r["output_metadata"] == "m" for r in rows)
    assert 2 < calls.value <= 4  # one call for the cats, up to three ranks for the tables


def test_failed_calls(spark, index):
    def load():
        def model(prompts, options):
            if any("Cats" in p for p in prompts):
                raise ValueError("no cats")
            return [("other", None) for _ in prompts]

        return model

    asked = questions(spark, ["cats sleep a lot they purr"])
    answers, failed = answer.answer_with_failures(asked, index, load, k=3)
    assert answers.first()["answer"] == "other"
    assert [(r["asked"], r["error"]) for r in failed.collect()] == [("cats sleep a lot they purr", "ValueError: no cats")]
    with pytest.raises(Exception, match="no cats"):
        answer.answer_questions(asked, index, k=3, load_model=load).collect()


def test_null_questions_take_no_part_in_the_join(spark, index):
    asked = questions(spark, [None] * 50 + ["cats purr"])
    rows = answer.answer_questions(asked, index, k=1).collect()
    assert len(rows) == 51 and sum(r["answer"] is not None for r in rows) == 1


def test_cascade_tries_rank_zero_and_steps_over_gaps(spark):
    rows = [(1, 0, "fine", "s0", None), (1, 5, "fine", "s5", None), (2, 1_000_000, "fine", "far", None), (3, None, "fine", "never", None), (3, -2, None, "s", None)]
    df = spark.createDataFrame(rows, "key long, rank int, answer string, source string, output_metadata string")
    rounds = []

    def produce(todo):
        rounds.append(1)
        return todo

    found = answer.cascade(df, "key", produce, txt.is_good_answer(F.col("answer")))
    assert {r["key"]: r["source"] for r in found.collect()} == {1: "s0", 2: "far"}
    assert len(rounds) == 4


def test_abbreviations_reach_the_search(spark, index):
    asked = questions(spark, ["zq"])
    row = answer.answer_questions(asked, index, k=1, abbreviations={"ZQ": "cats purr"}).first()
    assert row["source"] == "s3" and row["question"] == "zq"


def test_dictionary_table_both_ways(spark):
    df = spark.createDataFrame([(1, "ml and hms, ML!"), (2, "nothing"), (3, ""), (4, None)], "id long, t string")
    entries = spark.createDataFrame([(1, "ML", "Machine Learning"), (2, "HMS", "Hive Metastore")], "position int, abbreviation string, full_text string")
    small = dictionary.expand_with_table(df, "t", entries)
    large = dictionary.expand_with_table(df, "t", entries, limit=1)
    literal = df.withColumn("t", txt.expand_abbreviations(F.col("t"), {"ML": "Machine Learning", "HMS": "Hive Metastore"}))
    wanted = sorted(map(tuple, literal.select("id", "t").collect()))
    assert sorted(map(tuple, small.select("id", "t").collect())) == wanted
    assert sorted(map(tuple, large.select("id", "t").collect())) == wanted


@pytest.mark.parametrize("limit", [1, 100])
def test_chained_repeated_and_broken_entries(spark, limit):
    rows = [(1, "aa zz"), (2, "CC bb"), (None, "aa"), (1, "dd"), (5, None), (6, "")]
    df = spark.createDataFrame(rows, "id long, t string")
    entries = [(1, "AA", "uses BB and AA"), (2, "BB", "then CC, not AA"), (3, "CC", "second"), (4, "aa", "never"), (4, "BB", "never"), (None, "ZZ", "x"), (5, "ZZ", None), (6, None, "x"), (7, "DD", "")]
    table = spark.createDataFrame(entries, "position int, abbreviation string, full_text string")
    got = dictionary.expand_with_table(df, "t", table, limit=limit)
    assert got.columns == df.columns
    bb = "BB (then CC (second), not AA)"
    assert sorted((r["t"] or "") for r in got.collect()) == sorted([f"AA (uses {bb} and AA) zz", f"CC (second) {bb}", f"AA (uses {bb} and AA)", "DD ()", "", ""])


def test_chains_equal_the_literal_form(spark):
    words = {"AA": "BB CC dd", "BB": "CC AA", "CC": "DD and EE", "DD": "EE", "EE": "end"}
    entries = spark.createDataFrame([(k, a, t) for k, (a, t) in enumerate(words.items())], "position int, abbreviation string, full_text string")
    got = {r["word"]: r["replacement"] for r in dictionary.replacement_table(entries).collect()}
    assert got == txt.expansion_table(words)


@pytest.mark.parametrize("limit", [1, 100])
def test_entries_that_are_no_words_are_refused(spark, limit):
    df = spark.createDataFrame([(1, "a b")], "id long, t string")
    table = spark.createDataFrame([(1, "A B", "x"), (2, "C++", "y")], "position int, abbreviation string, full_text string")
    with pytest.raises(Exception, match="begin and end with a word"):
        dictionary.expand_with_table(df, "t", table, limit=limit).collect()


WAYS = [{"limit": 100}, {"limit": 1}, {"limit": 1, "block_bytes": 150}, {"limit": 1, "block_bytes": 150, "driver_limit": 1}]


def longest_first(text, table):
    """A plain left-to-right loop over runs: at every word the entry of most runs."""
    runs, out, at = txt.word_runs(text), [], 0
    while at < len(runs):
        best = max((n for n in range(1, 12) if at + n <= len(runs) and "".join(runs[at : at + n]).lower() in table), default=0)
        out.append(table["".join(runs[at : at + best]).lower()] if best else runs[at])
        at += best or 1
    return "".join(out)


@pytest.mark.parametrize("way", WAYS)
def test_entries_of_several_words(spark, way):
    words = {"machine learning": "uses data", "Machine Learning model": "a fit model", "learning": "study", "data": "facts", "deep machine": "x", "a-b c": "hyphens", "ÄÖ ü": "umlauts", "model": "copy"}
    entries = spark.createDataFrame([(k, a, t) for k, (a, t) in enumerate(words.items())], "position int, abbreviation string, full_text string")
    table = txt.expansion_table(words)
    assert table["machine learning"] == "machine learning (study) (uses data (facts))"
    texts = [
        "MACHINE learning models, machine learning model.", "deep machine learning model data", "machine  learning", "learning machine\nlearning",
        "A-B C a-b-c a-b c", "äö Ü ÄÖ üx", "xmachine learning", "machine learning machine learning", "", None, "data " * 50,
    ]
    rows = [(k % 3 or None, t, "r", "f") for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "id long, t string, _row string, found string").repartition(2)
    got = dictionary.expand_with_table(df, "t", entries, **way)
    assert got.columns == df.columns
    wanted = sorted(str(longest_first(t, table)) if t is not None else "None" for t in texts)
    assert sorted(str(r["t"]) for r in got.collect()) == wanted
    native = df.withColumn("t", txt.expand_abbreviations(F.col("t"), words))
    assert sorted(str(r["t"]) for r in native.collect()) == wanted


def test_both_forms_of_following_chains_agree(spark):
    words = {f"w{k} x": f"w{k + 1} x and w{k + 2} x w{(k * 7) % 30}" for k in range(25)} | {f"w{k}": f"v w{k - 1} x" for k in range(30)}
    entries = spark.createDataFrame([(k, a, t) for k, (a, t) in enumerate(words.items())], "position int, abbreviation string, full_text string")
    few = dict(list(words.items())[18:36])
    some = spark.createDataFrame([(k, a, t) for k, (a, t) in enumerate(few.items())], "position int, abbreviation string, full_text string")
    got = {r["word"]: r["replacement"] for r in dictionary.replacement_table(some, block_bytes=300).collect()}
    assert got == txt.expansion_table(few)
    assert entries.count() == len(words)


def test_texts_are_not_shuffled_by_a_large_dictionary(spark):
    df = spark.range(100).selectExpr("CAST(id AS STRING) AS t")
    entries = spark.createDataFrame([(1, "1", "one"), (2, "2 3", "two")], "position int, abbreviation string, full_text string")
    plan = dictionary.expand_with_table(df, "t", entries, limit=1)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


@pytest.mark.parametrize("limit", [1, 1000])
def test_phrases_and_rows_without_a_unique_key(spark, limit):
    rows = [(None, "refused here"), (None, "fine"), (1, "fine too"), (1, "REFUSED")]
    df = spark.createDataFrame(rows, "id long, answer string")
    phrases = spark.createDataFrame([("refused",), ("other",)], "phrase string")
    assert sorted(r["answer"] for r in answer.reject_by_table(df, phrases, limit=limit).collect()) == ["fine", "fine too"]


def test_phrase_table_both_ways(spark):
    rows = [(1, "all fine"), (2, "I am SORRY, no"), (3, None), (4, ""), (5, "so"), (6, "not known here"), (7, "a知りません"), (8, "ends in sor")]
    df = spark.createDataFrame(rows, "id long, answer string")
    phrases = spark.createDataFrame([("sorry",), ("known",), ("知りません",), ("abcdefghijklmnop",), ("",), (None,)], "phrase string")
    small = answer.reject_by_table(df, phrases)
    large = answer.reject_by_table(df, phrases, limit=1, block_bytes=100)
    assert sorted(r["id"] for r in small.collect()) == [1, 4, 5, 8]
    assert sorted(r["id"] for r in large.collect()) == [1, 4, 5, 8]


def test_phrase_join_on_a_table(spark, folder):
    from lorespan.plans import queries

    said = queries._said(spark, folder).withColumn("turn_id", queries._turn_id())
    opening = F.lower(F.regexp_extract("text", r"^[^ \n]+ [^ \n]+", 0))
    phrases = spark.read.parquet(f"{folder}/benchmark.parquet").select(opening.alias("phrase"))
    joined = answer.reject_by_table(said, phrases, limit=1).select("turn_id").collect()
    literal = answer.reject_by_table(said, phrases).select("turn_id").collect()
    assert sorted(joined) == sorted(literal)


def test_texts_of_many_hits(spark, index, monkeypatch):
    """A filter that is too small for the ids lets more chunks through; the result is the same."""
    asked = questions(spark, ["cats", "tables", "streams"])
    few = sorted(map(tuple, retrieve.retrieve(asked, index, 2).collect()))
    monkeypatch.setattr(lookup, "FILTER_BITS", 64)
    assert sorted(map(tuple, retrieve.retrieve(asked, index, 2).collect())) == few
    assert len(few) == 6


def test_texts_are_read_once_however_many_blocks(spark):
    """Blocks of one pass: no text is written between them, and many passes give the same."""
    df = spark.range(100).selectExpr("CONCAT('w', id % 7, ' w', id % 11, ' end') AS t")
    words = {f"w{k} w{k + 1}": "two" for k in range(10)} | {f"w{k}": "one" for k in range(0, 10, 2)}
    entries = spark.createDataFrame([(k, a, t) for k, (a, t) in enumerate(words.items())], "position int, abbreviation string, full_text string")
    got = dictionary.expand_with_table(df, "t", entries, limit=1, block_bytes=100)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Range" in plan and "FileScan" not in plan
    wanted = sorted(longest_first(r["t"], txt.expansion_table(words)) for r in df.collect())
    assert sorted(r["t"] for r in got.collect()) == wanted


def test_many_passes_over_the_texts(spark, monkeypatch):
    monkeypatch.setattr(dictionary, "PASS_BYTES", 300)
    df = spark.range(60).selectExpr("CONCAT('w', id % 7, ' w', id % 11, ' end') AS t")
    words = {f"w{k} w{k + 1}": "two" for k in range(10)} | {f"w{k}": "one" for k in range(0, 10, 2)}
    entries = spark.createDataFrame([(k, a, t) for k, (a, t) in enumerate(words.items())], "position int, abbreviation string, full_text string")
    got = dictionary.expand_with_table(df, "t", entries, limit=1, block_bytes=100)
    assert sorted(r["t"] for r in got.collect()) == sorted(longest_first(r["t"], txt.expansion_table(words)) for r in df.collect())


def test_batches_are_cut_by_the_bytes_of_their_texts(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(dictionary, "TEXT_BYTES", 100)
    texts = ["x" * 30, None, "y" * 500, "", "z" * 60, "z" * 39, "z" * 2] * 3
    parts = list(dictionary._pieces(pa.RecordBatch.from_pydict({"t": texts}), "t"))
    assert [t for part in parts for t in part.column("t").to_pylist()] == texts
    assert all(part.num_rows == 1 or sum(len(t or "") for t in part.column("t").to_pylist()) <= 100 for part in parts)
    assert list(dictionary._pieces(pa.RecordBatch.from_pydict({"t": pa.array([], pa.string())}), "t")) == []


def test_alternatives_share_their_beginnings(spark):
    keys = [f"{a} {b}{tail}" for a in ("the", "then", "Ä-ö", "a+b") for b in ("end", "ends", "x.y") for tail in ("", " of", " of all")]
    table = {k.lower(): f"<{k}>" for k in keys} | {f"w{k}": f"<{k}>" for k in range(100)}
    pattern = txt.prefix_tree_pattern(k for k in table if " " in k)
    assert pattern.count("the") == 1 and pattern.count("all") == 12 < len(keys) / 2
    texts = ["The END of allx", "then ends of all the end OF", "ä-Ö X.Y of a+B end w7 W99 w100 the x.y, then", "the endsof", ""]
    df = spark.createDataFrame([(t,) for t in texts], "t string").repartition(2)
    got = df.select(txt.replace_entries(F.col("t"), table).alias("t"))
    assert sorted(r["t"] for r in got.collect()) == sorted(longest_first(t, table) for t in texts)
