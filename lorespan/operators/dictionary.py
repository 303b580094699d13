"""Abbreviation tables: entries of one or more words, replaced in one pass over a text.

A text is cut into runs of word characters and runs of others. An entry is a sequence of such runs that begins and
ends with a word; a trie over runs finds the longest entry at every word, without regard to case, and of overlapping ones the
leftmost counts. Small dictionaries become an expression. Larger ones are sent to the tasks in blocks of
bounded size, dealt by the first word, so that all entries that can begin at a word are in one block. A pass over the texts seeks
as many blocks as are together of bounded size, in pieces of the texts of bounded size; texts stay where they are read and carry
what was found from pass to pass.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lorespan.functions import text as txt
from lorespan.operators.lookup import rows_if_small
from lorespan.session import materialize

#: Entries up to which a dictionary is an expression, and up to which its chains are followed by the driver.
LITERAL_ENTRIES, DRIVER_ENTRIES = 100, 10_000
BLOCK_BYTES = 32 << 20
#: Entries that one pass over the texts looks for, as plain rows, at least one block; and bytes of texts that are cut together.
PASS_BYTES, TEXT_BYTES = 32 << 20, 1 << 20

_FOUND = "array<struct<at:int,n:int,value:string>>"


def cleaned(dictionary: DataFrame) -> DataFrame:
    """``word, place, abbreviation, full_text`` from entries ``position, abbreviation, full_text``.

    Entries apply in the order of their positions, ties by abbreviation. Of entries that differ in case only the first
    counts. Entries with a null part are ignored; an entry that does not begin and end with a word is an error.
    """
    good = F.col("abbreviation").rlike(f"^(?:{txt.ENTRY})$")
    return (
        dictionary.select("position", "abbreviation", "full_text")
        .where("position IS NOT NULL AND abbreviation IS NOT NULL AND full_text IS NOT NULL")
        .withColumn("word", F.when(good, F.lower("abbreviation")).otherwise(F.raise_error("an abbreviation has to begin and end with a word")))
        .groupBy("word")
        .agg(F.min(F.struct("position", "abbreviation", "full_text")).alias("entry"))
        .select("word", F.struct("entry.position", "entry.abbreviation").alias("place"), "entry.abbreviation", "entry.full_text")
    )


def _passes(entries: DataFrame, size, block_bytes: int) -> list[DataFrame]:
    """Entries dealt to blocks by their first words, column ``block``, in passes of at most about ``PASS_BYTES``."""
    total = entries.agg(F.sum(size)).first()[0] or 0
    count = max(1, -(-total // block_bytes))
    passes = min(count, max(1, -(-total // max(block_bytes, PASS_BYTES))))
    first = F.regexp_extract("word", r"^[\p{L}\p{N}_]+", 0)
    dealt = entries.withColumn("block", F.pmod(F.xxhash64(first), F.lit(count)))
    return [dealt if passes == 1 else dealt.where(F.col("block") % passes == at) for at in range(passes)]


def _marked(df: DataFrame, column: str, entries: DataFrame, value: str, block_bytes: int, allowed: str | None = None, splice: bool = False) -> tuple[DataFrame, str]:
    """``df`` with a column of the entries found in ``column``: leftmost, longest, none overlapping; and its name.

    ``entries``: ``word`` and ``value``. ``allowed`` names a column of both that decides: only entries with a greater value
    than the row's count. With ``splice`` the last pass puts the values into the text and adds no column.

    Blocks of together ``PASS_BYTES`` are sought in one pass, so their number does not say how often texts are read
    and written.
    """
    mark = "found"
    while mark in df.columns:
        mark += "_"
    size = F.octet_length("word") + F.octet_length(F.col(value).cast("string")) + F.lit(100)
    passes = _passes(entries, size, block_bytes)
    marked = df if splice and len(passes) == 1 else df.withColumn(mark, F.array().cast(_FOUND))
    for at, part in enumerate(passes):
        rows = part.select("block", "word", F.col(value).alias("value"), (F.col(allowed) if allowed else F.lit(0)).alias("rank")).collect()
        blocks: dict[int, list] = {}
        for r in rows:
            blocks.setdefault(r["block"], []).append((r["word"], r["value"], r["rank"]))
        sent = df.sparkSession.sparkContext.broadcast(list(blocks.values()))
        last = at + 1 == len(passes)
        schema = df.schema if splice and last else marked.schema
        marked = marked.mapInArrow(_finder(sent, column, mark, allowed, last, splice and last), schema)
        if not last:
            marked = materialize(marked, "marked")
    return marked, mark


def _pieces(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """A batch cut where its texts pass ``TEXT_BYTES``, so that what a task holds does not follow the length of texts."""
    ends = pc.cumulative_sum(pc.fill_null(pc.binary_length(batch.column(column)).cast(pa.int64()), 0)).to_numpy()
    at = 0
    while at < batch.num_rows:
        end = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + TEXT_BYTES, side="right"))
        end = min(max(end, at + 1), batch.num_rows)
        yield batch.slice(at, end - at)
        at = end


def _finder(sent, column: str, mark: str, allowed: str | None, last: bool, splice: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tries = [txt.RunTrie((word, (value, rank)) for word, value, rank in block) for block in sent.value]
        owner = {head: at for at, trie in enumerate(tries) for head in trie.root}  # a first word is in one block
        for whole in batches:
            for batch in _pieces(whole, column):
                texts = [text or "" for text in batch.column(column).to_pylist()]
                ranks = batch.column(allowed).to_pylist() if allowed else None
                at = batch.schema.get_field_index(mark)
                found = [[(b["at"], b["n"], b["value"]) for b in before] for before in batch.column(mark).to_pylist()] if at >= 0 else [[] for _ in texts]
                runs = [txt.word_runs(text) for text in texts]
                lowered = [[run.lower() for run in cut] for cut in runs]
                for row, cut in enumerate(lowered):
                    places: dict[int, list[int]] = {}
                    for k, head in enumerate(cut):
                        block = owner.get(head)
                        if block is not None:
                            places.setdefault(block, []).append(k)
                    least = None if ranks is None else ranks[row]
                    counts = None if least is None else lambda v: v[1] > least  # noqa: B023
                    for block, own in places.items():
                        found[row] += [(k, n, v[0]) for k, n, v in tries[block].matches_in(cut, counts, own)]
                out = [txt.leftmost(sorted(f)) if last else sorted(f) for f in found]
                if splice:
                    new = [None if not f else txt.splice_runs(cut, f) for cut, f in zip(runs, out)]
                    kept = batch.column(column)
                    changed = pa.array([f is not None for f in new])
                    text = pc.if_else(changed, pa.array(new, kept.type), kept)
                    pairs = [(n, text if n == column else c) for n, c in zip(batch.schema.names, batch.columns) if n != mark]
                    yield pa.RecordBatch.from_arrays([c for _, c in pairs], [n for n, _ in pairs])
                else:
                    columns = list(batch.columns)
                    columns[at] = pa.array([[dict(zip(("at", "n", "value"), f)) for f in row] for row in out], batch.schema.field(at).type)
                    yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return run


def _spliced(column: str, mark: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, found = batch.column(column).to_pylist(), batch.column(mark).to_pylist()
            new = [t if not f else txt.splice(t, [(x["at"], x["n"], x["value"]) for x in f]) for t, f in zip(texts, found)]
            at = batch.schema.get_field_index(column)
            kept = [(n, c) for n, c in zip(batch.schema.names, batch.columns) if n != mark]
            columns = [pa.array(new, batch.schema.field(at).type) if n == column else c for n, c in kept]
            yield pa.RecordBatch.from_arrays(columns, [n for n, _ in kept])

    return run


def replaced_in_blocks(df: DataFrame, column: str, replacements: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Texts with their entries replaced by ``word, replacement``, read and changed in place; a task holds the tries of one pass."""
    return _marked(df, column, replacements, "replacement", block_bytes, splice=True)[0]


def replacement_table(dictionary: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``word, replacement`` from entries ``position, abbreviation, full_text``; all chains are followed by Spark.

    A replacement, ``abbreviation (full_text)``, can hold entries of later positions, which are replaced in turn. Every
    round settles the entries whose later entries are settled, so there are as many rounds as the longest chain has
    entries. For entries see ``cleaned``.
    """
    entries = materialize(cleaned(dictionary).withColumn("whole", F.concat("abbreviation", F.lit(" ("), "full_text", F.lit(")"))), "entries")
    # Places as one number a row, so that tasks can compare them: an entry's rank is the number of entries up to it.
    ranked = materialize(_ranked(entries), "entries")
    marked, mark = _marked(ranked, "whole", ranked, "word", block_bytes, "rank")
    marked = materialize(marked.withColumnRenamed(mark, "inside"), "entries")
    settled = materialize(marked.where(F.size("inside") == 0).select("word", F.col("whole").alias("replacement")), "replacements")
    left = marked.where(F.size("inside") > 0).select("word", "whole", "inside")
    while True:
        left = materialize(left.join(settled.select("word"), "word", "left_anti"), "entries")
        if left.isEmpty():
            return settled
        parts = left.select("word", F.explode("inside").alias("p")).select("word", "p.at", "p.n", F.col("p.value").alias("inner"))
        known = settled.select(F.col("word").alias("inner"), "replacement")
        # One group is one entry's text.
        ready = (
            parts.join(known, "inner", "left")
            .groupBy("word")
            .agg(F.array_sort(F.collect_list(F.struct("at", "n", F.col("replacement").alias("value")))).alias("found"), F.count("replacement").alias("m"))
            .where(F.col("m") == F.size("found"))
        )
        rows = left.select("word", F.col("whole").alias("replacement")).join(ready.drop("m"), "word")
        schema = StructType([StructField("word", StringType()), StructField("replacement", StringType())])
        new = materialize(rows.mapInArrow(_spliced("replacement", "found"), schema), "replacements")
        settled = settled.unionByName(new)


def _ranked(entries: DataFrame) -> DataFrame:
    """Add ``rank``, growing with ``place``: distinct places sorted by range partitions, numbered by partition and row."""
    places = entries.select("place").distinct().repartitionByRange("place").sortWithinPartitions("place")
    numbered = materialize(places.withColumn("rank", F.monotonically_increasing_id()), "places")
    return entries.join(numbered, "place")


def expand_with_table(
    df: DataFrame, column: str, dictionary: DataFrame, limit: int = LITERAL_ENTRIES, block_bytes: int = BLOCK_BYTES, driver_limit: int = DRIVER_ENTRIES
) -> DataFrame:
    """Expand abbreviations given as a table ``position, abbreviation, full_text``.

    Up to ``limit`` entries become an expression, more are sought in blocks. Chains of up to ``driver_limit`` entries
    are followed on the driver, of more by ``replacement_table``. All ways give the same texts. No column needs to be unique, and
    texts are not shuffled.
    """
    entries = materialize(cleaned(dictionary), "entries")
    rows = rows_if_small(entries, driver_limit)
    if rows is None:
        return replaced_in_blocks(df, column, replacement_table(entries.select("place.position", "abbreviation", "full_text"), block_bytes), block_bytes)
    ordered = sorted(rows, key=lambda r: (r["place"]["position"], r["place"]["abbreviation"]))
    table = txt.expansion_table({r["abbreviation"]: r["full_text"] for r in ordered})
    if len(table) <= limit:
        return df.withColumn(column, txt.replace_entries(F.col(column), table)) if table else df
    schema = "word string, replacement string"
    return replaced_in_blocks(df, column, df.sparkSession.createDataFrame(list(table.items()), schema), block_bytes)
