"""Version log of saved indexes (or models): register, alias, resolve.

Both tables are append-only, so every version and every move of an alias stays on record.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lorespan import fixed_values as fixed
from lorespan import schemas


def latest(versions: DataFrame, name: str | None = None) -> DataFrame:
    """Highest version per name, compared as numbers. Partial maxima make a hot name harmless."""
    if name is not None:
        versions = versions.filter(F.col("name") == name)
    return versions.groupBy("name").agg(F.max("version").alias("version"), F.max_by("path", "version").alias("path"))


def resolve(versions: DataFrame, aliases: DataFrame, alias: str = fixed.PRODUCTION_ALIAS) -> DataFrame:
    """``name, alias, version, path`` that an alias points to now: its last assignment counts."""
    current = (
        aliases.filter(F.col("alias") == alias)
        .groupBy("name", "alias")
        .agg(F.max_by("version", "seq").alias("version"))
    )
    return current.join(versions, ["name", "version"]).select("name", "alias", "version", "path")


class VersionLog:
    """The two tables below one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _read(self, name: str, schema) -> DataFrame:
        empty = self.spark.createDataFrame([], schema)
        try:
            return self.spark.read.schema(schema).parquet(f"{self.folder}/{name}")
        except Exception as problem:
            if "PATH_NOT_FOUND" in str(problem):
                return empty
            raise

    def versions(self) -> DataFrame:
        return self._read("versions", schemas.INDEX_VERSIONS)

    def aliases(self) -> DataFrame:
        return self._read("aliases", schemas.INDEX_ALIASES)

    def register(self, name: str, path: str) -> int:
        highest = latest(self.versions(), name).select("version").first()
        version = (highest[0] if highest else 0) + 1
        row = self.spark.createDataFrame([(name, version, path)], schemas.INDEX_VERSIONS)
        row.write.mode("append").parquet(f"{self.folder}/versions")
        return version

    def set_alias(self, name: str, version: int, alias: str = fixed.PRODUCTION_ALIAS) -> None:
        if self.versions().filter((F.col("name") == name) & (F.col("version") == version)).isEmpty():
            raise ValueError(f"{name} has no version {version}")
        highest = self.aliases().filter(F.col("name") == name).agg(F.max("seq")).first()[0] or 0
        row = self.spark.createDataFrame([(name, alias, version, highest + 1)], schemas.INDEX_ALIASES)
        row.write.mode("append").parquet(f"{self.folder}/aliases")

    def path(self, uri: str) -> str:
        """Path behind ``name@alias``."""
        name, _, alias = uri.partition("@")
        found = resolve(self.versions(), self.aliases().filter(F.col("name") == name), alias).first()
        if found is None:
            raise ValueError(f"nothing is registered as {uri}")
        return found["path"]
