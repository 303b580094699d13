"""The registered queries of the operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lorespan.llm import (
    bitsliced,
    decontaminate,
    html_crf,
    jaccard_join,
    licenses,
    packing,
    quality,
    sharding,
    token_store,
    topk,
    toxicity,
    warc,
    whitening,
)
from lorespan.llm.common import table


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, piece, bin_id, bin_offset, length, source`` of every piece of every document."""
    return packing.pack(table(spark, sf_dir, "documents"))


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, n_shingles, component_id, n_links`` of every document."""
    return jaccard_join.similar_components(table(spark, sf_dir, "documents"))


def op3_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of every record read back."""
    records = warc.round_trip(table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` of every document."""
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _with_fold(scores: DataFrame) -> DataFrame:
    predicted = (F.col("score") >= 0.5).cast("int")
    return scores.select("doc_id", toxicity.held_out().alias("held_out"), "score", predicted.alias("predicted"))


def op5_quality_co_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document; held-out rows are never learned from."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.fit(docs, labels.where(~toxicity.held_out()))
    return _with_fold(quality.score(docs, model))


def op6_toxicity_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document; held-out rows are never learned from."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.where(~toxicity.held_out()))
    return _with_fold(toxicity.score(docs, model))


def op7_permutation_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, slot, shard, n_bytes`` of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"))
    return sharding.place(docs, "doc_id", sharding.shard_names()).select("doc_id", "slot", "shard", "n_bytes")


def op8_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``query_id, rank, vec_id, score``: the 10 best vectors of every hundredth one."""
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where("vec_id % 100 = 0"))


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    return html_crf.extract(table(spark, sf_dir, "pages"))


def op10_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the token table read back."""
    return token_store.round_trip(table(spark, sf_dir, "documents"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` and more of every vector and component."""
    vectors = table(spark, sf_dir, "embeddings")
    return whitening.whiten(vectors, whitening.fit(vectors))


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score`` of every document."""
    return licenses.scan(table(spark, sf_dir, "documents"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``item_id, rank, doc_id, score``: the 20 best documents of every benchmark item."""
    return bitsliced.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}
