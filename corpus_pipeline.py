"""From raw documents to packed training sequences: filter, deduplicate, decontaminate, pack.

Every stage takes what the one before kept. Rows with a null doc_id are filtered by their texts and packed like others;
deduplication and decontamination, which name documents by their ids, let them stay.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lorespan.llm import decontaminate, jaccard_join, packing, quality, toxicity
from lorespan.llm.common import materialize, table


def clean_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity grammar scores one half or more go."""
    labels = table(spark, sf_dir, "labels").where(~toxicity.held_out())
    return toxicity.without_toxic(docs, toxicity.fit(docs, labels))


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifiers score below one half go."""
    labels = table(spark, sf_dir, "labels").where(~toxicity.held_out())
    return quality.without_bad(docs, quality.fit(docs, labels))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return jaccard_join.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    hit = found.where("contaminated").select("doc_id").distinct()
    return docs.join(hit, "doc_id", "left_anti").select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in bins of the training length."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", clean_language),
    ("quality_classifier", good_quality),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", decontaminated),
    ("best_fit_packing", packed),
]

#: The stages learn, search and pack, which SQL can't express; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, from the table ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
