"""Session set-up, partition sizing and the shared scratch folder."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
ARROW_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
_LOCAL_ROOTS: dict[str, str] = {}
_SCOPES = threading.local()


def get_spark(app: str = "lorespan", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators rely on; ``conf`` overrides any of them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for written intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master may fall back to a
    temporary folder, because there the driver and the executors are one process.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="lorespan-")
    return _LOCAL_ROOTS[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    path = f"{_scratch_folder(spark)}/{label}-{uuid.uuid4().hex}"
    for paths in getattr(_SCOPES, "open", []):
        paths.append(path)
    return path


def _scratch_folder(spark: SparkSession) -> str:
    return f"{scratch_root(spark).rstrip('/')}/lorespan/{spark.sparkContext.applicationId}"


def _delete(spark: SparkSession, name: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this application wrote to the scratch folder. Call when no result is needed any more."""
    _delete(spark, _scratch_folder(spark))


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete at the end what the calling thread wrote to the scratch folder inside the block.

    For work that repeats without end, such as the micro-batches of a stream.
    """
    scopes = _SCOPES.__dict__.setdefault("open", [])
    paths: list[str] = []
    scopes.append(paths)
    try:
        yield
    finally:
        scopes.remove(paths)
        for path in paths:
            _delete(spark, path)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the scratch folder and read it back.

    Cuts the lineage like ``checkpoint()`` does and outlives lost executors, but stays columnar, so
    later steps still prune columns and push filters into the scan.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def arrow_batches(spark: SparkSession, size: int) -> Iterator[None]:
    """Inside the block, jobs send Python workers at most about ``size`` bytes in one Arrow batch.

    A batch is held by the JVM, whose buffers double as they grow, and by the worker, often beside the one before. Rows of long
    texts or lists make batches of the usual 10,000 rows tens of megabytes large. Jobs have to run inside the block.
    """
    before = spark.conf.get(ARROW_BATCH_BYTES)
    spark.conf.set(ARROW_BATCH_BYTES, str(size))
    try:
        yield
    finally:
        spark.conf.set(ARROW_BATCH_BYTES, before)


def slots(spark: SparkSession) -> int:
    return spark.sparkContext.defaultParallelism


def _moves_rows(node) -> bool:
    """Whether a plan has a step that other steps need a shuffle for, or a shuffle itself."""
    if any(word in node.nodeName() for word in ("Exchange", "Join", "Aggregate", "Window", "Sort", "Limit")):
        return True
    children = node.children()
    return any(_moves_rows(children.apply(k)) for k in range(children.size()))


def spread(scan: DataFrame, *key: str) -> DataFrame:
    """Give a file scan at least one partition per core.

    A table of a few megabytes reads as one or two partitions, which would leave all but one core
    idle during chunking and embedding. A scan that already has a partition per core (every large
    table) passes through untouched, so nothing big is ever shuffled here. So does a plan with a
    shuffle of its own. ``key`` must be unique.
    """
    if _moves_rows(scan._jdf.queryExecution().sparkPlan()):
        return scan
    wanted = slots(scan.sparkSession)
    if scan.rdd.getNumPartitions() >= wanted:
        return scan
    return scan.repartition(wanted, *key)
