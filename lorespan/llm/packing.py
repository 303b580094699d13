"""Best-fit packing of documents into sequences of fixed length, with conflicts.

Open bins are kept in order of what is left in them. A piece goes to the tightest bin that can take it:
the search starts at the smallest sufficient residual and goes on to the next larger one until a bin without a
conflict is found; else a new bin is opened. Each bin carries two bitmaps, of the sources and of the duplicate
clusters it holds: a source may be in a bin once, a cluster too.

Packing is local to groups of about ``GROUP_ROWS`` pieces, dealt by a hash of the document, so that groups
have about the same size and the same mix whatever source or cluster is hot. A group leaves at most a few bins
partly filled for want of further pieces.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lorespan.llm.common import materialize

CAPACITY = 2048
GROUP_ROWS = 2048


def best_fit(pieces: list[tuple[int, int, int]], capacity: int) -> list[tuple[int, int]]:
    """(bin, offset) of every piece (length, source bit, cluster bit), given in the order of placement.

    A source or cluster bit of -1 never conflicts. Of bins with equal residuals the one opened first is tried first.
    """
    residuals: list[tuple[int, int]] = []  # (what is left, bin), ascending
    sources: list[int] = []
    clusters: list[int] = []
    placed = []
    for length, source, cluster in pieces:
        source_bit = 1 << source if source >= 0 else 0
        cluster_bit = 1 << cluster if cluster >= 0 else 0
        at = bisect_left(residuals, (length, -1))
        while at < len(residuals):
            bin_ = residuals[at][1]
            if not sources[bin_] & source_bit and not clusters[bin_] & cluster_bit:
                break
            at += 1
        if at < len(residuals):
            left, bin_ = residuals.pop(at)
        else:
            left, bin_ = capacity, len(sources)
            sources.append(0)
            clusters.append(0)
        sources[bin_] |= source_bit
        clusters[bin_] |= cluster_bit
        placed.append((bin_, capacity - left))
        if left > length:
            insort(residuals, (left - length, bin_))
    return placed


def pack(docs: DataFrame, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS, cluster: str | None = None) -> DataFrame:
    """``doc_id, piece, bin_id, bin_offset, length, source`` of every piece of every row of ``docs``.

    ``docs``: ``doc_id, text, source`` and, if ``cluster`` names one, a column of duplicate clusters; without it
    texts that are equal after trimming and lower-casing are a cluster. Lengths are words (runs of
    non-space characters). A text longer than ``capacity`` is cut into full pieces and a rest; the full
    ones fill bins alone. Texts without words, and null texts, take no room: ``bin_id`` and ``bin_offset`` are null
    and ``length`` is 0. A null source or cluster never conflicts. Repeated rows are packed as rows of their
    own. Pieces are placed longest first, ties by doc_id and piece. An empty table gives an empty result.
    """
    words = F.regexp_count(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit(r"\S+")).cast("long")
    copies = F.xxhash64(F.lower(F.trim(F.col("text").cast("string")))) if cluster is None else F.xxhash64(F.col(cluster))
    unclustered = F.col("text" if cluster is None else cluster).isNull()
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.when(~unclustered, copies).alias("cluster"),
        words.alias("words"),
    )
    pieces = rows.withColumn("n", F.greatest(F.lit(1), F.ceil(F.col("words") / capacity))).select(
        "doc_id", "source", "cluster", F.posexplode(F.sequence(F.lit(1), F.col("n"))).alias("piece", "_k"), "words"
    )
    pieces = pieces.select(
        "doc_id", "piece", "source", "cluster",
        F.least(F.lit(capacity), F.col("words") - F.col("piece") * capacity).cast("long").alias("length"),
    )
    pieces = materialize(pieces, "pieces")
    part = pieces.where(F.col("length").between(1, capacity - 1))
    groups = max(1, -(-part.count() // group_rows))
    # The group goes by document and cluster alike, so copies and pieces of one text spread over all groups.
    part = part.withColumn("group", F.pmod(F.xxhash64("doc_id", "piece", "cluster"), F.lit(groups)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            group = batch.column("group").to_numpy()
            cuts = [0, *((group[1:] != group[:-1]).nonzero()[0] + 1).tolist(), len(group)]
            for a, b in zip(cuts[:-1], cuts[1:]):
                if held and a < b and held[-1].column("group")[0].as_py() != group[a]:
                    yield placed(held)
                    held = []
                if a < b:
                    held.append(batch.slice(a, b - a))
        if held:
            yield placed(held)

    def placed(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).combine_chunks()
        bits: tuple[dict, dict] = {}, {}

        def bit(k: int, value: object) -> int:
            return -1 if value is None else bits[k].setdefault(value, len(bits[k]))

        lengths, sources, clusters = (rows.column(c).to_pylist() for c in ("length", "source", "cluster"))
        spots = best_fit([(n, bit(0, s), bit(1, c)) for n, s, c in zip(lengths, sources, clusters)], capacity)
        group = rows.column("group")[0].as_py()
        return pa.RecordBatch.from_arrays(
            [
                *(rows.column(c).combine_chunks() for c in ("doc_id", "piece")),
                pa.array([group << 24 | b for b, _ in spots], pa.int64()),
                pa.array([o for _, o in spots], pa.int64()),
                *(rows.column(c).combine_chunks() for c in ("length", "source")),
            ],
            ["doc_id", "piece", "bin_id", "bin_offset", "length", "source"],
        )

    schema = "doc_id long, piece int, bin_id long, bin_offset long, length long, source string"
    dealt = part.repartition("group").sortWithinPartitions("group", F.desc("length"), "doc_id", "piece", "cluster", "source")
    shared = dealt.mapInArrow(run, schema)
    # Full pieces need no search: a bin each, numbered below zero.
    full = pieces.where(F.col("length") == capacity)
    alone = -F.monotonically_increasing_id() - 1  # over a written table, so a task that runs again numbers alike
    full = full.select("doc_id", "piece", alone.alias("bin_id"), F.lit(0).cast("long").alias("bin_offset"), "length", "source")
    nothing = F.lit(None).cast("long")
    empty = pieces.where("length <= 0").select(
        "doc_id", "piece", nothing.alias("bin_id"), nothing.alias("bin_offset"), F.lit(0).cast("long").alias("length"), "source"
    )
    return shared.unionByName(full).unionByName(empty)
