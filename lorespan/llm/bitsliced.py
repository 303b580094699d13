"""Ranked lexical search with bit-sliced Bloom signatures and exact scores.

A document's signature holds every term once for each of the counts 1, 2, 3, 4, 6, 8, 12, ... that it reaches in the
document. Documents of like size are stored in blocks, one bitmap of documents for each signature bit (a slice), so
the slices of a term, and-ed, are the documents that may hold it that often: never one too few. For a batch of queries:

1. One pass over the texts counts the documents of every query term; the index gives all other statistics.
2. Per block, the bitmaps of a level times the weights of the queries, summed up over the levels, bound the score of
   every document from above. The documents with the highest bounds are scored exactly, which gives every query a floor.
3. All documents whose bound reaches the floor of a query are scored exactly by their texts. The rest is provably not
   among the best.

Terms are 64-bit hashes of words. Sums of bounds are whole numbers and exact.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lorespan.llm.common import IdFilter, list_array, materialize
from lorespan.llm.decontaminate import members, texts_of
from lorespan.llm.shingles import mix

#: Counts that have an entry of their own in a signature; the last one stands for all higher counts.
LEVELS = (1, 2, 3, 4, 6, 8, 12, 16, 24, 32, 48, 64)
#: Slices of a term, and bits of a signature for every entry at least.
PROBES, BITS_PER_ENTRY = 5, 12
#: Documents and bytes of a block at most (a block of very long documents holds eight), and the fewest slices.
BLOCK_DOCUMENTS, BLOCK_BYTES, FEWEST_SLICES = 4096, 1 << 20, 64
#: Items and terms searched for in one pass, terms whose bitmaps are unpacked together.
ITEMS_AT_ONCE, TERMS_AT_ONCE, TERM_STEP = 256, 1 << 16, 512
#: Documents of the highest bounds that are scored for the floor of a query, for each one wanted.
FIRST = 3

_U = np.uint64
_INDEX = "slices int, documents int, terms long, doc_ids binary, lengths binary, bits binary"


def entries(terms: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The hashes a signature holds for distinct ``terms`` with their ``counts``."""
    return np.concatenate([_entry(terms[counts >= least], level) for level, least in enumerate(LEVELS)])


def _entry(terms: np.ndarray, level: int) -> np.ndarray:
    return mix(terms + _U(level * 0xD6E8FEB86659FD93 % 2**64))


def places(hashes: np.ndarray, slices: int) -> np.ndarray:
    """The slices of every hash, a row a probe; ``slices`` is a power of two."""
    step = (hashes >> _U(32)) | _U(1)
    return ((hashes + np.arange(PROBES, dtype=np.uint64)[:, None] * step) & _U(slices - 1)).astype(np.int64)


class _Block:
    """Signatures of documents with the same number of slices, as they come in."""

    def __init__(self, slices: int) -> None:
        self.slices = slices
        self.most = max(8, min(BLOCK_DOCUMENTS, BLOCK_BYTES * 8 // slices // 8 * 8))
        self.ids: list[int] = []
        self.lengths: list[int] = []
        self.bits = np.zeros((slices, self.most // 8), dtype=np.uint8)

    def add(self, doc_id: int, length: int, hashes: np.ndarray) -> bool:
        """Whether the block is full now."""
        row = len(self.ids)
        self.bits[places(hashes, self.slices).ravel(), row >> 3] |= np.uint8(1 << (row & 7))
        self.ids.append(doc_id)
        self.lengths.append(length)
        return len(self.ids) == self.most

    def batch(self) -> pa.RecordBatch:
        bits = np.ascontiguousarray(self.bits[:, : -(-len(self.ids) // 8)])
        columns = [
            pa.array([self.slices], pa.int32()),
            pa.array([len(self.ids)], pa.int32()),
            pa.array([sum(self.lengths)], pa.int64()),
            pa.array([np.array(self.ids, dtype="<i8").tobytes()], pa.binary()),
            pa.array([np.array(self.lengths, dtype="<i8").tobytes()], pa.binary()),
            pa.array([bits.tobytes()], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, [part.split()[0] for part in _INDEX.split(", ")])


def build_index(docs: DataFrame) -> DataFrame:
    """One row a block of signatures, of all rows of ``docs`` (``doc_id long, text``) that have a term.

    Documents with a null id are stored with the statistics only: they count, but can't be named, so their signatures
    are empty.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: dict[int, _Block] = {}
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for start, words, bounds in texts_of(batch.column("text")):
                for k in range(len(bounds) - 1):
                    own = words[bounds[k] : bounds[k + 1]]
                    if not len(own):
                        continue
                    doc_id = ids[start + k]
                    hashes = entries(*np.unique(own, return_counts=True)) if doc_id is not None else own[:0]
                    slices = max(FEWEST_SLICES, 1 << (BITS_PER_ENTRY * len(hashes) - 1).bit_length())
                    block = open_.get(slices) or open_.setdefault(slices, _Block(slices))
                    if block.add(-1 if doc_id is None else doc_id, len(own), hashes):
                        yield open_.pop(slices).batch()
        for block in open_.values():
            yield block.batch()

    return _narrow(docs).mapInArrow(run, _INDEX)


def _narrow(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


@dataclass
class Queries:
    """A batch of queries: sorted distinct term hashes with their weights, and the terms of every item."""

    items: list[int]
    terms: np.ndarray
    wanted: np.ndarray  # one row an item: indexes of its terms with repeats, filled up with len(terms)
    documents: int = 0
    total: int = 0
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    def damping(self, lengths: np.ndarray) -> np.ndarray:
        return 75 + (25 * lengths * self.documents) // max(self.total, 1)

    def matrix(self) -> np.ndarray:
        """Weights of the terms (columns) in the items (rows), repeats added up."""
        out = np.zeros((len(self.items), len(self.terms) + 1))
        for row, own in enumerate(self.wanted):
            np.add.at(out[row], own, 1.0)
        out = out[:, :-1] * self.weights
        return out.astype(np.float32) if out.sum(axis=1).max(initial=0) < 2**24 else out  # sums stay exact


def gains(counts: np.ndarray | int, damping: np.ndarray) -> np.ndarray:
    """What a term of weight 1 adds to the score of a document."""
    return (1_000_000_000 * counts) // (1000 * counts + 12 * damping)


def item_terms(items: DataFrame) -> DataFrame:
    """``item_id, terms array<long>`` of items with an id and a term; of a repeated id the largest text counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, words, bounds in texts_of(batch.column("text")):
                ids = batch.column("item_id").slice(start, len(bounds) - 1)
                yield pa.RecordBatch.from_arrays([ids, list_array(words.view(np.int64), np.diff(bounds), pa.int64())], ["item_id", "terms"])

    shape = [F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")]
    chosen = items.select(*shape).where("item_id IS NOT NULL").groupBy("item_id").agg(F.max("text").alias("text"))
    return chosen.mapInArrow(run, "item_id long, terms array<long>").where(F.size("terms") > 0)


def _batches(items: DataFrame) -> Iterator[Queries]:
    """Items in batches of bounded size, dealt by the hash of their ids."""
    held = materialize(item_terms(items), "items")
    count = held.agg(F.count("*").alias("n"), F.sum(F.size("terms")).alias("t")).first()
    parts = max(-(-count["n"] // ITEMS_AT_ONCE), -(-(count["t"] or 0) // TERMS_AT_ONCE))
    for part in range(parts):
        rows = held.where(F.pmod(F.xxhash64("item_id"), F.lit(parts)) == part).orderBy("item_id").collect()  # one batch
        if not rows:
            continue
        own = [np.array(r["terms"], dtype=np.int64).view(np.uint64) for r in rows]
        terms = np.unique(np.concatenate(own))
        wanted = np.full((len(rows), max(map(len, own))), len(terms))
        for k, t in enumerate(own):
            wanted[k, : len(t)] = np.searchsorted(terms, t)
        yield Queries([r["item_id"] for r in rows], terms, wanted)


def document_frequencies(docs: DataFrame, terms: np.ndarray) -> np.ndarray:
    """Documents that hold each of the sorted ``terms``: one pass, counted in the tasks first."""
    sent = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        df = np.zeros(len(known), np.int64)
        for batch in batches:
            for _, words, bounds in texts_of(batch.column("text")):
                at, term = members(known, words)
                owner = np.searchsorted(bounds, at, "right") - 1
                df += np.bincount(np.unique(owner * len(known) + term) % len(known), minlength=len(known))
        seen = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(df[seen])], ["at", "df"])

    found = _narrow(docs).select("text").mapInArrow(run, "at int, df long").groupBy("at").agg(F.sum("df").alias("df")).toArrow()
    out = np.zeros(len(terms), np.int64)
    out[found.column("at").to_numpy()] = found.column("df").to_numpy()  # a row a term of the batch
    return out


def upper_bounds(slices: np.ndarray, lengths: np.ndarray, queries: Queries, matrix: np.ndarray) -> np.ndarray:
    """Upper bounds of the scores of a block's documents (columns) for every item (rows).

    ``slices``: one row a slice, documents as bits. A document that a level's bitmaps show gains at most what the
    highest count of that level gives; each level adds what it gives beyond the level before.
    """
    damping = queries.damping(lengths)
    out = np.zeros((len(queries.items), len(lengths)))
    alive, below = np.arange(len(queries.terms)), None
    before = np.zeros(len(lengths), np.int64)
    for level in range(len(LEVELS)):
        at = places(_entry(queries.terms[alive], level), len(slices))
        found = slices[at[0]]
        for more in at[1:]:
            found &= slices[more]
        if below is not None:
            found &= below
        some = found.any(axis=1)
        alive, below = alive[some], found[some]
        if not len(alive):
            break
        last = level + 1 == len(LEVELS)
        gain = np.full(len(lengths), 1_000_000) if last else gains(LEVELS[level + 1] - 1, damping)
        sums = np.zeros(out.shape, dtype=matrix.dtype)
        for a in range(0, len(alive), TERM_STEP):
            shown = np.unpackbits(below[a : a + TERM_STEP], axis=1, count=len(lengths), bitorder="little")
            sums += matrix[:, alive[a : a + TERM_STEP]] @ shown.astype(matrix.dtype)
        out += sums * (gain - before).astype(np.float64)
        before = gain
    return out


def _block_bounds(batch: pa.RecordBatch, queries: Queries, matrix: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(doc_ids, upper bounds) of every block; documents without an id are bounded by 0."""
    for row in range(batch.num_rows):
        ids = np.frombuffer(batch.column("doc_ids")[row].as_buffer(), dtype="<i8")
        lengths = np.frombuffer(batch.column("lengths")[row].as_buffer(), dtype="<i8")
        slices = batch.column("slices")[row].as_py()
        bits = np.frombuffer(batch.column("bits")[row].as_buffer(), dtype=np.uint8).reshape(slices, -1)
        yield ids, upper_bounds(bits, lengths, queries, matrix)


class _Best:
    """The ``k`` best (score, smallest doc_id) of every item over the rows offered."""

    def __init__(self, k: int) -> None:
        self.k, self.parts, self.rows = k, [], 0

    def offer(self, item: np.ndarray, doc_id: np.ndarray, score: np.ndarray) -> None:
        self.parts.append((item, doc_id, score))
        self.rows += len(item)
        if self.rows > 1 << 20:
            self.parts = [self.settled()]
            self.rows = len(self.parts[0][0])

    def settled(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        item, doc_id, score = (np.concatenate(x) for x in zip(*self.parts))
        order = np.lexsort((doc_id, -score, item))
        item, doc_id, score = item[order], doc_id[order], score[order]
        first = np.flatnonzero(np.r_[True, item[1:] != item[:-1]]) if len(item) else np.zeros(0, np.int64)
        place = np.arange(len(item)) - np.repeat(first, np.diff(np.r_[first, len(item)]))
        return tuple(x[place < self.k] for x in (item, doc_id, score))

    def batch(self) -> pa.RecordBatch:
        item, doc_id, score = self.settled()
        return pa.RecordBatch.from_arrays([pa.array(item.astype(np.int64)), pa.array(doc_id), pa.array(score.astype(np.int64))], ["item", "doc_id", "score"])


def highest_bounds(index: DataFrame, sent, k: int) -> DataFrame:
    """``item, doc_id, score``: the ``k`` documents of the highest bounds of every item (``score`` is the bound)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = sent.value
        matrix, best = queries.matrix(), _Best(k)
        for batch in batches:
            for ids, bounds in _block_bounds(batch, queries, matrix):
                top = np.argpartition(-bounds, k, axis=1)[:, :k] if len(ids) > k else np.tile(np.arange(len(ids)), (len(bounds), 1))
                item = np.repeat(np.arange(len(bounds)), top.shape[1])
                value = np.take_along_axis(bounds, top, axis=1).ravel()
                fine = value > 0
                best.offer(item[fine], ids[top.ravel()][fine], value[fine])
        yield best.batch()

    found = index.mapInArrow(run, "item long, doc_id long, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), "doc_id")
    return found.withColumn("at", F.row_number().over(order)).where(F.col("at") <= k).drop("at")


def not_excluded(index: DataFrame, sent, floors: np.ndarray) -> DataFrame:
    """``doc_id, queries array<int>``: every document with the items whose floor its bound reaches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = sent.value
        matrix = queries.matrix()
        least = np.maximum(floors, 1)[:, None]
        for batch in batches:
            for ids, bounds in _block_bounds(batch, queries, matrix):
                row, item = np.nonzero((bounds >= least).T)
                if len(row):
                    counts = np.bincount(row, minlength=len(ids))
                    some = np.flatnonzero(counts)
                    lists = list_array(item.astype(np.int32), counts[some], pa.int32())
                    yield pa.RecordBatch.from_arrays([pa.array(ids[some]), lists], ["doc_id", "queries"])

    return index.mapInArrow(run, "doc_id long, queries array<int>")


def exact_scores(docs: DataFrame, candidates: DataFrame, sent, k: int) -> DataFrame:
    """``item, doc_id, score`` of the ``k`` best candidates of every item a task meets (``doc_id, queries``), scored exactly.

    Texts are read where they are; only counts of query terms in documents that are candidates move to the join.
    """
    candidates = candidates.groupBy("doc_id").agg(F.array_distinct(F.flatten(F.collect_list("queries"))).alias("queries"))
    wanted = IdFilter(candidates, "doc_id")
    test = wanted.tester()

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = sent.value.terms
        for batch in batches:
            batch = batch.filter(pa.array(test(batch.column("slot").to_numpy())))
            for start, words, bounds in texts_of(batch.column("text")):
                at, term = members(terms, words)
                owner = np.searchsorted(bounds, at, "right") - 1
                keys, counts = np.unique(owner * len(terms) + term, return_counts=True)
                sizes = np.bincount(keys // len(terms), minlength=len(bounds) - 1)
                columns = [
                    batch.column("doc_id").slice(start, len(bounds) - 1),
                    pa.array(np.diff(bounds)),
                    list_array((keys % len(terms)).astype(np.int32), sizes, pa.int32()),
                    list_array(counts.astype(np.int32), sizes, pa.int32()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "length", "terms", "counts"])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, best = sent.value, _Best(k)
        weights = np.append(queries.weights, 0)
        for batch in batches:
            ids, damping = batch.column("doc_id").to_numpy(), queries.damping(batch.column("length").to_numpy())
            lists = {c: (batch.column(c).offsets.to_numpy(), batch.column(c).values.to_numpy()) for c in ("terms", "counts", "queries")}
            own = {c: [v[a:b] for a, b in zip(o[:-1], o[1:])] for c, (o, v) in lists.items()}
            for row, (terms, counts, items) in enumerate(zip(own["terms"], own["counts"], own["queries"])):
                gain = np.zeros(len(weights), np.int64)
                gain[terms] = weights[terms] * gains(counts.astype(np.int64), damping[row])
                score = gain[queries.wanted[items]].sum(axis=1)
                fine = score > 0
                best.offer(items[fine], np.full(int(fine.sum()), ids[row]), score[fine])
        yield best.batch()

    texts = _narrow(docs).select("doc_id", wanted.slot(F.col("doc_id")).alias("slot"), "text").where("doc_id IS NOT NULL")
    found = texts.mapInArrow(counted, "doc_id long, length long, terms array<int>, counts array<int>").join(candidates, "doc_id")
    return found.mapInArrow(scored, "item long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = 20, index: DataFrame | None = None) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` documents of the highest scores above 0 of every item.

    ``docs``: ``doc_id long, text``; ``items``: ``item_id long, text``; other columns are ignored. Equal scores rank by
    ascending doc_id. Null and empty texts have no terms: as documents they don't count, as items they have no rows.
    Documents with a null id count in the statistics but are not ranked; rows that repeat a doc_id are documents of their own.
    Items with a null id are left out; of a repeated item_id the largest text counts. Empty tables give an empty result.
    ``index`` may be a stored result of ``build_index`` of the same documents.
    """
    spark = docs.sparkSession
    index = materialize(build_index(docs), "signatures") if index is None else index
    total = index.agg(F.sum("documents").alias("n"), F.sum("terms").alias("t")).first()
    result = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    if not total["n"]:
        return result
    for queries in _batches(items):
        result = result.unionByName(_searched(spark, docs, index, queries, total["n"], total["t"], k))
    return result


def _searched(spark: SparkSession, docs: DataFrame, index: DataFrame, queries: Queries, documents: int, total: int, k: int) -> DataFrame:
    queries.documents, queries.total = int(documents), int(total)
    df = document_frequencies(docs, queries.terms)
    queries.weights = np.array([math.floor(1000 * math.log((2 * queries.documents + 2) / (2 * int(n) + 1))) for n in df])
    sent = spark.sparkContext.broadcast(queries)
    first = highest_bounds(index, sent, FIRST * k).groupBy("doc_id").agg(F.collect_list(F.col("item").cast("int")).alias("queries"))
    order = Window.partitionBy("item").orderBy(F.desc("score"), "doc_id")
    ranked = exact_scores(docs, materialize(first, "first"), sent, k).withColumn("rank", F.row_number().over(order))
    floors = np.zeros(len(queries.items), np.int64)
    for row in ranked.where(F.col("rank") == k).collect():  # a row an item of the batch
        floors[row["item"]] = row["score"]
    left = materialize(not_excluded(index, sent, floors), "candidates")
    best = exact_scores(docs, left, sent, k).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    names = F.element_at(F.lit(queries.items), (F.col("item") + 1).cast("int"))
    return materialize(best.select(names.cast("long").alias("item_id"), "rank", "doc_id", "score"), "ranked")
