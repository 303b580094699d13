"""Supervised fine-tuning data: pairs, prompts, tokens, split, collated batches."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lorespan import fixed_values as fixed
from lorespan.functions import text as txt
from lorespan.operators.lookup import hot_key_lookup
from lorespan.session import materialize

VOCABULARY = 50_000
END_ID = 0
_HISTOGRAM_DIGITS = 4
SLICE_ROWS = 1 << 20
#: Rows of a range of hashes that is numbered in one task, at most on average.
RANGE_ROWS = 1 << 20


def turn_pairs(conversations: DataFrame) -> DataFrame:
    """``example_id, conv_id, turn, instruction, response`` from ``conv_id, turn, role, text``.

    A user turn is paired with the assistant turn numbered one higher; ``turn_gaps`` finds conversations whose
    numbers have gaps, which would lose pairs. Pairing joins on (conversation,
    turn), which is unique, so a conversation of any length spreads over all partitions; a window
    over the conversation would not.
    """
    said = conversations.select("conv_id", "turn", "text")
    users = said.filter(conversations["role"] == "user").withColumnRenamed("text", "instruction")
    replies = said.filter(conversations["role"] == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("response")
    )
    return users.join(replies, ["conv_id", "turn"]).select(
        F.concat_ws("-", "conv_id", "turn").alias("example_id"), "conv_id", "turn", "instruction", "response"
    )


def turn_gaps(conversations: DataFrame) -> DataFrame:
    """``conv_id`` of conversations whose turns are not numbered one by one. Partial counts, nothing is sorted."""
    numbers = conversations.groupBy("conv_id").agg(F.min("turn").alias("a"), F.max("turn").alias("b"), F.count("*").alias("n"))
    return numbers.filter("b - a + 1 <> n").select("conv_id")


def with_contexts(pairs: DataFrame, conversations: DataFrame) -> DataFrame:
    """Add ``context``: the first system turn of the conversation, null where there is none."""
    contexts = (
        conversations.filter("role = 'system'").groupBy("conv_id").agg(F.min_by("text", "turn").alias("context"))
    )
    # Contexts are wide: only those of very long conversations are repeated.
    return hot_key_lookup(pairs, contexts, "conv_id", pairs.groupBy("conv_id").agg(F.count("*").alias("n")), ["turn"])


def training_texts(examples: DataFrame) -> DataFrame:
    """Add ``text``: the instruction prompt and the response in one string."""
    prompt = txt.instruction_prompt(F.col("instruction"), F.col("context"))
    return examples.withColumn("text", txt.training_text(prompt, F.col("response")))


def token_id(token: Column, vocabulary: int = VOCABULARY) -> Column:
    """Id of a token without a vocabulary file: first 32 bits of its md5, ids from 1; 0 ends a text."""
    digits = F.conv(F.substring(F.md5(token), 1, 8), 16, 10).cast("long")
    return (F.lit(1) + digits % F.lit(vocabulary - 1)).cast("int")


def tokenize(
    df: DataFrame,
    column: str = "text",
    max_tokens: int = fixed.TRAIN_MAX_TOKENS,
    mode: str = "ws",
    load_tokenizer: Callable[[], Callable[[list[str]], list[list[int]]]] | None = None,
) -> DataFrame:
    """Add ``input_ids`` cut to ``max_tokens`` and ``truncated``.

    ``load_tokenizer`` returns a function from texts to id lists, loaded once per task.
    """
    if load_tokenizer is None:
        all_tokens = txt.tokens(F.col(column), mode)
        cut = df.withColumn("_tokens", all_tokens).withColumn("truncated", F.size("_tokens") > max_tokens)
        return cut.withColumn(
            "input_ids", F.transform(F.slice(F.col("_tokens"), 1, max_tokens), lambda token: token_id(token))
        ).drop("_tokens")

    @F.pandas_udf("array<int>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokenizer = load_tokenizer()
        for texts in batches:
            yield pd.Series(list(tokenizer(texts.tolist())))

    cut = df.withColumn("_ids", encode(F.col(column))).withColumn("truncated", F.size("_ids") > max_tokens)
    return cut.withColumn("input_ids", F.slice("_ids", 1, max_tokens)).drop("_ids")


# -- exact split ----------------------------------------------------------------------------------


def exact_split(
    df: DataFrame, key: str, test: int | float = fixed.TRAIN_TEST_ROWS, seed: int = fixed.TRAIN_SEED
) -> DataFrame:
    """Add ``split``: the ``test`` rows with the smallest ``md5(seed:key)`` are test, the rest train.

    ``test`` is a number of rows, or a fraction below 1 that is rounded up. ``key`` must be unique.
    The size is exact and membership does not depend on partitioning. Keys and hashes are written once. The
    table is never sorted: a histogram over the first hash digits finds the slice of hashes the boundary lies in, and
    only that slice is ranked. The number of digits follows the row count, so that slice and histogram both stay
    below about ``SLICE_ROWS`` rows up to SLICE_ROWS squared rows.
    """
    order_key = F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))
    hashed = materialize(df.select(F.md5(order_key).alias("hash"), F.col(key).alias("key")), "keys")
    total = hashed.count()
    digits = _HISTOGRAM_DIGITS
    while total // 16**digits > SLICE_ROWS and digits < 8:
        digits += 1
    wanted = int(test) if test >= 1 or test == 0 else math.ceil(float(test) * total)
    if wanted >= total and (wanted or total):
        raise ValueError("the test split needs fewer rows than the table has")
    hashed = hashed.withColumn("digits", F.substring("hash", 1, digits))

    counts = hashed.groupBy("digits").agg(F.count("*").alias("n"))
    upto = F.sum("n").over(Window.orderBy("digits"))
    edge = counts.select("digits", "n", upto.alias("upto")).filter((F.col("upto") >= wanted) & (F.col("upto") - F.col("n") < wanted)).first()
    if edge is None:
        return df.withColumn("split", F.lit("train"))
    place = wanted - (edge["upto"] - edge["n"])
    last = hashed.filter(F.col("digits") == edge["digits"]).orderBy("hash", "key").limit(place).agg(F.max(F.struct("hash", "key")).alias("last")).first()["last"]
    inside = F.struct(F.md5(order_key).alias("hash"), F.col(key).alias("key")) <= F.struct(F.lit(last["hash"]), F.lit(last["key"]))
    return df.withColumn("split", F.when(inside, "test").otherwise("train"))


def complement(df: DataFrame, chosen: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose key was chosen, and all the others."""
    ids = chosen.select(key)
    return df.join(ids, key, "left_semi"), df.join(ids, key, "left_anti")


# -- collation ------------------------------------------------------------------------------------


def running_numbers(df: DataFrame, key: str, seed: int = fixed.TRAIN_SEED, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Add ``row_number``, from 1, over the whole table in the order of ``md5(seed:key)``; ``key`` must be unique.

    No task sees more than a range of hashes, about ``range_rows`` rows: ranges are the first hash digits, one
    aggregate counts their rows, the sums of the counts before each range are broadcast back (a row of two numbers for every
    ``range_rows`` / 16 rows at most), and a range is numbered by itself. ``df`` is read twice.
    """
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    total, digits = df.count(), 1
    while total // 16**digits > range_rows and digits < 8:
        digits += 1
    part = F.substring(order, 1, digits).alias("_range")
    counts = df.groupBy(part).agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("_range", F.coalesce(before, F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy("_order", key))
    placed = df.withColumn("_order", order).withColumn("_range", F.substring("_order", 1, digits)).withColumn("_inside", inside)
    numbered = placed.join(F.broadcast(starts), "_range").withColumn("row_number", F.col("_start") + F.col("_inside"))
    return numbered.drop("_range", "_order", "_inside", "_start")


def collate(
    df: DataFrame,
    key: str,
    batch_rows: int = 8,
    pad_id: int = END_ID,
    seed: int = fixed.TRAIN_SEED,
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """Pad ``input_ids`` to the longest of their batch and add ``batch``, ``attention_mask`` and ``labels``.

    Labels repeat the ids, with the ignored label wherever the pad id stands. Batches are runs of ``batch_rows`` rows of the
    whole table in the order of the hash of the unique key, numbered from 0; only the last one may be short. See
    ``running_numbers`` for how no task sees the whole table.
    """
    numbered = running_numbers(df, key, seed, range_rows)
    batched = numbered.withColumn("batch", F.floor((F.col("row_number") - 1) / batch_rows).cast("long")).drop("row_number")
    longest = F.max(F.size("input_ids")).over(Window.partitionBy("batch"))
    sized = batched.withColumn("_pad", longest - F.size("input_ids")).withColumn("_length", F.size("input_ids"))
    padded = sized.withColumn("input_ids", F.concat("input_ids", F.array_repeat(F.lit(pad_id), F.col("_pad"))))
    return padded.withColumn(
        "attention_mask", F.concat(F.array_repeat(F.lit(1), F.col("_length")), F.array_repeat(F.lit(0), F.col("_pad")))
    ).withColumn(
        "labels",
        F.transform("input_ids", lambda token: F.when(token == pad_id, fixed.IGNORED_LABEL).otherwise(token)),
    ).drop("_pad", "_length")


def marker_id(marker: str = fixed.END_OF_TEXT, vocabulary: DataFrame | None = None) -> Column:
    """Id of a marker token: a lookup in ``token, id``, or the reserved end id without a vocabulary."""
    if vocabulary is None:
        return F.lit(END_ID) if marker == fixed.END_OF_TEXT else token_id(F.lit(marker))
    return vocabulary.filter(F.col("token") == marker).agg(F.min("id").alias("id")).scalar()


def build_dataset(
    examples: DataFrame,
    path: str,
    test: int | float = fixed.TRAIN_TEST_ROWS,
    seed: int = fixed.TRAIN_SEED,
    load_tokenizer: Callable | None = None,
    conversations: DataFrame | None = None,
) -> DataFrame:
    """Write ``path/split=train|test`` once, for any number of trainers to read.

    ``conversations`` are those the examples were paired from: a gap between their turn numbers, which loses pairs, is an error.
    """
    if conversations is not None:
        gaps = [row["conv_id"] for row in turn_gaps(conversations).orderBy("conv_id").limit(5).collect()]
        if gaps:
            raise ValueError(f"turns are not numbered one by one in the conversations {gaps}")
    ready = tokenize(training_texts(exact_split(examples, "example_id", test, seed)), load_tokenizer=load_tokenizer)
    ready.write.mode("overwrite").partitionBy("split").parquet(path)
    return examples.sparkSession.read.parquet(path)
