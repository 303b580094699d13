"""Evaluation runs: per-row outputs under a run id, metrics per run, and comparisons of runs."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lorespan.functions import text as txt

#: Draws of the bootstrap, and the share of them outside of the interval.
DRAWS, OUTSIDE = 200, 0.05
MILLION = 1_000_000


def run_outputs(answers: DataFrame, run_id: str | Column) -> DataFrame:
    """``run_id, question_id, question, outputs`` from an answer table."""
    run = F.lit(run_id) if isinstance(run_id, str) else run_id
    return answers.select(
        run.alias("run_id"), "question_id", "question", F.struct("answer", "source", "output_metadata").alias("outputs")
    )


def append_results(outputs: DataFrame, path: str) -> None:
    outputs.write.mode("append").partitionBy("run_id").json(path)


def compare_runs(results: DataFrame) -> DataFrame:
    """Answers of all runs beside each other, sorted by question."""
    return results.select(
        "question", "run_id", "question_id", F.col("outputs.answer").alias("answer"), F.col("outputs.source").alias("source")
    ).sort("question", "question_id", "run_id")


def readability(answer: Column) -> Column:
    """Automated readability index; null for texts without a word."""
    n_words = F.size(F.regexp_extract_all(answer, F.lit(txt.WHITESPACE_TOKEN), F.lit(0)))
    n_chars = F.length(F.regexp_replace(answer, r"[^\p{L}\p{N}]", ""))
    n_sentences = F.greatest(F.size(F.regexp_extract_all(answer, F.lit(txt.SENTENCE), F.lit(0))), F.lit(1))
    return F.when(n_words > 0, 4.71 * F.try_divide(n_chars, n_words) + 0.5 * n_words / n_sentences - 21.43)


def summarize(results: DataFrame, target: str | None = None) -> DataFrame:
    """Metrics per run. Sums are kept per partition first, so one huge run is no hot group.

    Averages are taken over answered rows; ``exact_match`` needs a target column.
    """
    answer = F.col("outputs.answer")
    rows = results.withColumn("_n", F.size(txt.tokens(answer))).withColumn("_ari", readability(answer))
    metrics = [
        F.count("*").alias("n_questions"),
        F.count(answer).alias("n_answered"),
        F.round(F.count(answer) / F.count("*"), 6).alias("answered_rate"),
        F.round(F.avg(F.when(answer.isNotNull(), F.col("_n"))), 6).alias("mean_tokens"),
        F.round(F.avg("_ari"), 6).alias("mean_ari"),
    ]
    if target:
        same = F.coalesce((answer == F.col(target)).cast("int"), F.lit(0))
        metrics.append(F.round(F.sum(same) / F.count("*"), 6).alias("exact_match"))
    return rows.groupBy("run_id").agg(*metrics)


# -- comparison of runs ---------------------------------------------------------------------------


def numbered_words(words: Column) -> Column:
    """Words with the number of their occurrence, so that a set intersection of two lists is that of multisets.

    ``words`` must be a plain column of sorted words.
    """
    at = F.transform(words, lambda w, i: F.when((i == 0) | (F.get(words, i - 1) != w), i))
    starts = F.filter(at, lambda i: i.isNotNull())
    ends = F.concat(F.slice(starts, F.lit(2), F.greatest(F.size(starts), F.lit(1))), F.array(F.size(words)))
    runs = F.zip_with(starts, ends, lambda a, b: F.transform(F.sequence(a, b - 1), lambda j: F.concat_ws(" ", F.get(words, j), (j - a).cast("string"))))
    return F.when(F.size(words) > 0, F.flatten(runs)).otherwise(F.array().cast("array<string>"))


def with_scores(results: DataFrame, target: str) -> DataFrame:
    """Add ``answered``, ``exact`` and ``f1`` in millionths: whole numbers, so that sums don't depend on their order.

    ``f1`` is twice the shared words (as multisets, lower-cased) over the words of both. A missing answer scores 0 in
    all; rows without a target have null ``exact`` and ``f1``.
    """
    answer = F.col("outputs.answer")
    rows = results.withColumn("_said", F.array_sort(txt.words(F.coalesce(answer, F.lit(""))))).withColumn("_wanted", F.array_sort(txt.words(F.col(target))))
    shared = F.size(F.array_intersect(numbered_words(F.col("_said")), numbered_words(F.col("_wanted")))).cast("long")
    both = F.size("_said") + F.size("_wanted")
    f1 = F.when(both > 0, F.floor(2 * MILLION * shared / both)).otherwise(0)
    same = F.coalesce((answer == F.col(target)).cast("int"), F.lit(0)) * MILLION
    known = F.col(target).isNotNull()
    return (
        rows.withColumn("answered", (answer.isNotNull().cast("int") * MILLION).cast("long"))
        .withColumn("exact", F.when(known, same).cast("long"))
        .withColumn("f1", F.when(known, F.when(answer.isNull(), F.lit(0)).otherwise(f1)).cast("long"))
        .drop("_said", "_wanted")
    )


def poisson_steps() -> list[int]:
    """Thresholds of a 32-bit number u: the Poisson(1) weight of u is the number of thresholds it reaches."""
    steps, share, total = [], math.exp(-1), 0.0
    while len(steps) < 10:
        total += share
        steps.append(math.floor(total * 2**32))
        share /= len(steps)
    return steps


def draw_weight(question_id: Column, draw: Column) -> Column:
    """How often a question counts in a draw, from the md5 of both: the same for all runs, in any partitioning."""
    number = F.conv(F.substring(F.md5(F.concat_ws(":", question_id.cast("string"), draw.cast("string"))), 1, 8), 16, 10).cast("long")
    return sum(((number >= F.lit(step)).cast("long") for step in poisson_steps()), F.lit(0).cast("long"))


def compare(results: DataFrame, target: str, draws: int = DRAWS) -> DataFrame:
    """``run_a, run_b, metric, n_questions, difference, low, high`` of every pair of runs over the questions both have.

    ``difference`` is the mean of run_b less that of run_a; ``low`` and ``high`` hold all but ``OUTSIDE`` of a paired
    Poisson bootstrap: in a draw, a question counts as often as its weight, in both runs alike. All draws of all pairs
    and metrics are one aggregate, kept per partition first, so no pair of runs is a hot group. A question has one row a
    run. Results: ``run_id, question_id, outputs`` and the target column.
    """
    metrics = ["answered", "exact", "f1"]
    scored = with_scores(results, target).select("question_id", F.struct("run_id", *metrics).alias("run"))
    # One group is the runs of one question.
    runs = scored.groupBy("question_id").agg(F.array_sort(F.collect_list("run")).alias("runs"))
    pairs = runs.select("question_id", "runs", F.explode("runs").alias("a")).select("question_id", "a", F.explode("runs").alias("b")).where("a.run_id < b.run_id")
    gaps = pairs.select("question_id", F.col("a.run_id").alias("run_a"), F.col("b.run_id").alias("run_b"), *[(F.col(f"b.{m}") - F.col(f"a.{m}")).alias(m) for m in metrics])
    drawn = gaps.withColumn("draw", F.explode(F.sequence(F.lit(0), F.lit(draws))))
    # Draw 0 is the sample itself.
    weight = F.when(F.col("draw") == 0, F.lit(1).cast("long")).otherwise(draw_weight(F.col("question_id"), F.col("draw")))
    weighted = drawn.withColumn("w", weight).where("w > 0")
    sums = [F.sum(F.col("w") * F.col(m)).alias(m) for m in metrics] + [F.sum(F.when(F.col(m).isNotNull(), F.col("w"))).alias(f"{m}_w") for m in metrics]
    totals = weighted.groupBy("run_a", "run_b", "draw").agg(*sums)
    each = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("total"), F.col(f"{m}_w").alias("weight")) for m in metrics])).alias("m")
    means = totals.select("run_a", "run_b", "draw", each).select("run_a", "run_b", "draw", "m.metric", F.col("m.weight").alias("weight"), (F.col("m.total") / F.col("m.weight") / F.lit(float(MILLION))).alias("mean"))
    # One group is the draws of a pair and metric.
    drawn_means = F.array_sort(F.collect_list(F.when(F.col("draw") > 0, F.col("mean"))))
    grouped = means.where("weight > 0").groupBy("run_a", "run_b", "metric").agg(
        F.max(F.when(F.col("draw") == 0, F.col("weight"))).alias("n_questions"),
        F.max(F.when(F.col("draw") == 0, F.col("mean"))).alias("difference"),
        drawn_means.alias("means"),
    )
    side = F.floor(F.size("means") * F.lit(OUTSIDE / 2)).cast("int")
    return grouped.select(
        "run_a", "run_b", "metric", "n_questions",
        F.round("difference", 9).alias("difference"),
        F.round(F.get("means", side), 9).alias("low"),
        F.round(F.get("means", F.size("means") - 1 - side), 9).alias("high"),
    )
