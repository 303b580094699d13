"""A chunk index that follows its documents without being rebuilt.

Layout below a folder, one generation a refresh:

* ``documents/generation=N``: ``doc_id, digest, gone`` of the documents that refresh N took up, or found gone;
* ``chunks/generation=N``: the chunks of those it took up.

A document's newest row says which of its chunks count. The rows of ``documents`` are written last, so a refresh that
breaks off counts for nothing and its number is used again. ``compact`` folds all generations into one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from lorespan import schemas
from lorespan.operators.lookup import possible_rows
from lorespan.session import materialize
from lorespan.sources.index_store import build_index

_DOCUMENTS = "doc_id long, digest string, gone boolean, generation int"
_CHUNKS = StructType([*schemas.CHUNK_INDEX.fields, StructField("generation", IntegerType())])


def _folders(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the generations below ``path`` that are written in full."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(place):
        return []
    names = [status.getPath() for status in files.listStatus(place)]
    done = [p.getName() for p in names if files.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    return sorted(int(name.split("=")[1]) for name in done if name.startswith("generation="))


def _read(spark: SparkSession, path: str, kind: str, schema, generations: list[int]) -> DataFrame:
    if not generations:
        return spark.createDataFrame([], schema)
    folders = [f"{path}/{kind}/generation={n}" for n in generations]
    return spark.read.option("basePath", f"{path}/{kind}").schema(schema).parquet(*folders)


def _documents(spark: SparkSession, path: str) -> DataFrame:
    """All rows of ``documents`` with ``newest``, the newest generation of the document."""
    rows = _read(spark, path, "documents", _DOCUMENTS, _folders(spark, f"{path}/documents"))
    newest = rows.groupBy("doc_id").agg(F.max("generation").alias("newest"))
    return rows.join(newest, "doc_id")


def digest(*columns: str):
    """A digest of the columns that tells nulls from empty texts."""
    return F.sha2(F.to_json(F.struct(*columns)), 256)


def refresh_index(sources: DataFrame, path: str, **build) -> int:
    """Bring the index at ``path`` up to ``sources`` (``doc_id, response, source``); returns the generation.

    Only documents whose text or source is new are chunked and embedded; those no longer there are marked. The stored
    digests and those of the sources meet in one join of narrow rows; sources are read where they are, and only
    the changed ones move on. ``doc_id`` has to be unique and not null. ``build`` goes to ``build_index`` and has to be the same
    every time.
    """
    spark = sources.sparkSession
    sources = sources.select("doc_id", "response", "source")
    generations = _folders(spark, f"{path}/documents")
    generation = (generations[-1] if generations else 0) + 1
    known = _documents(spark, path).where("generation = newest AND NOT gone").select("doc_id", F.col("digest").alias("known"))
    twice = F.raise_error(F.concat(F.lit("document id comes more than once or is null: "), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    now = sources.groupBy("doc_id").agg(F.count("*").alias("n"), F.max(digest("response", "source")).alias("digest"))
    now = now.select("doc_id", F.when((F.col("n") > 1) | F.col("doc_id").isNull(), twice.cast("string")).otherwise(F.col("digest")).alias("digest"))
    changes = materialize(
        now.join(known, "doc_id", "full").where("NOT digest <=> known").select("doc_id", "digest", F.col("digest").isNull().alias("gone")), "changes"
    )
    taken_up = changes.where("NOT gone").select("doc_id")
    changed = possible_rows(sources, "doc_id", taken_up).join(taken_up, "doc_id", "left_semi")
    build_index(changed, **build).write.mode("overwrite").parquet(f"{path}/chunks/generation={generation}")
    changes.write.mode("overwrite").parquet(f"{path}/documents/generation={generation}")
    return generation


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """The index as it is after the last refresh, in the columns of a saved index.

    Chunks are read in place; those of older states are taken out by an anti join with the outdated documents, which are few
    between compactions. What refreshes never touched is never shuffled where these fit a broadcast.
    """
    documents = _documents(spark, path)
    outdated = documents.where("generation < newest").select("doc_id", "generation")
    chunks = _read(spark, path, "chunks", _CHUNKS, _folders(spark, f"{path}/documents"))
    return chunks.join(outdated, ["doc_id", "generation"], "left_anti").select(*schemas.CHUNK_INDEX.fieldNames())


def compact(spark: SparkSession, path: str) -> int:
    """Fold all generations into a new one and delete them; returns its number. No reader may be at work meanwhile.

    Breaking off before the deletion harms nothing: the new generation outdates all others.
    """
    generations = _folders(spark, f"{path}/documents")
    if not generations:
        return 0
    generation = generations[-1] + 1
    read_index(spark, path).write.mode("overwrite").parquet(f"{path}/chunks/generation={generation}")
    live = _documents(spark, path).where("generation = newest AND NOT gone").select("doc_id", "digest", "gone")
    live.write.mode("overwrite").parquet(f"{path}/documents/generation={generation}")
    for old in generations:
        for kind in ("documents", "chunks"):
            place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{kind}/generation={old}")
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    return generation
