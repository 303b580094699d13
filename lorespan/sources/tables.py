"""Tables and files: scans, sinks, namespaces, listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def scan(spark: SparkSession, path: str, schema: StructType | None = None, file_format: str = "parquet") -> DataFrame:
    """A dataset on disk (``parquet``, ``json``, ``orc``, ``csv``). Give a schema to skip inference."""
    reader = spark.read.format(file_format)
    if schema is not None:
        reader = reader.schema(schema)
    if file_format == "csv":
        reader = reader.option("header", "true")
    return reader.load(path)


def test_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return scan(spark, f"{folder}/{name}.parquet")


def sources_from(documents: DataFrame) -> DataFrame:
    """The ``sources`` table from a document table: id, text as ``response``, ``source``."""
    return documents.selectExpr("doc_id", "text AS response", "source")


def use_namespace(spark: SparkSession, schema: str, catalog: str | None = None) -> str:
    """Create the schema if needed and make it current. A catalog has to be configured already."""
    if catalog:
        spark.catalog.setCurrentCatalog(catalog)
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{schema}`")
    spark.sql(f"USE `{schema}`")
    return f"{spark.catalog.currentCatalog()}.{schema}"


def save_table(df: DataFrame, name: str, partition_by: list[str] | None = None, path: str | None = None) -> None:
    """Replace a table, schema included: a managed one, or one whose files are at ``path``."""
    writer = df.write.mode("overwrite").format("parquet")
    if path:
        writer = writer.option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """``path, length, modificationTime`` of the files below a folder; their content is not read."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return listing.select("path", "length", "modificationTime")


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows"))


def longest(df: DataFrame, column: str, key: str, n: int = 1) -> DataFrame:
    """The ``n`` longest texts, ties by key: per-partition heaps, no sort of the table."""
    return (
        df.select(key, F.length(column).alias("n_chars"), column)
        .orderBy(F.desc("n_chars"), key)
        .limit(n)
    )


def preview(df: DataFrame, n: int = 20) -> DataFrame:
    return df.limit(n)
