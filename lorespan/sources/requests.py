"""Batch scoring requests and responses as JSON text tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lorespan.functions import payload


def parse_requests(requests: DataFrame, body: str = "body", key: str = "request_id") -> tuple[DataFrame, DataFrame]:
    """``request_id, pos, question_id, question`` of readable requests, and the unreadable ones.

    A readable request without questions has no row here; ``readable_requests`` lists it.
    """
    read = requests.withColumn("_questions", payload.questions_in(F.col(body)))
    bad = read.filter(F.col("_questions").isNull()).select(key, body, F.lit("unreadable request").alias("error"))
    good = read.select(key, F.posexplode_outer("_questions").alias("pos", "question")).filter("pos IS NOT NULL")
    return good.select(key, "pos", F.concat_ws("/", key, "pos").alias("question_id"), "question"), bad


def readable_requests(requests: DataFrame, body: str = "body", key: str = "request_id") -> DataFrame:
    """``request_id`` of every request that can be read, those that ask nothing included."""
    return requests.filter(payload.questions_in(F.col(body)).isNotNull()).select(key)


def format_responses(answers: DataFrame, key: str = "request_id", asked: DataFrame | None = None) -> DataFrame:
    """One response per request with its predictions in request order.

    A group is the answers to one request body, which was a single JSON value to begin with. With ``asked``, the ids
    of all readable requests, those without answers get an empty prediction list.
    """
    record = F.struct("answer", "source", "output_metadata")
    gathered = answers.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("pos", record.alias("record")))).alias("_all"))
    records = F.col("_all.record")
    if asked is not None:
        gathered = asked.select(key).distinct().join(gathered, key, "left")
        records = F.coalesce(records, F.array().cast(gathered.select(records).schema[0].dataType))
    return gathered.select(key, payload.response_body(records).alias("body"))


def first_predictions(responses: DataFrame, key: str = "request_id", body: str = "body") -> DataFrame:
    """What a chat client reads from a response: the first answer and its source."""
    return responses.withColumn("_first", payload.first_prediction(F.col(body))).select(
        key, F.col("_first.answer").alias("answer"), F.col("_first.source").alias("source")
    )


def route_status(scored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Responses with status 200, and the rest with an error text."""
    ok = F.coalesce(F.col("status") == 200, F.lit(False))
    status = F.coalesce(F.col("status").cast("string"), F.lit("None"))
    error = F.concat(F.lit("Request failed with status "), status, F.lit(", "), F.coalesce("body", F.lit("")))
    failed = scored.filter(~ok).withColumn("error", error)
    return scored.filter(ok), failed
