"""Exact Jaccard join of documents on word n-grams, as a blocked sparse matrix product.

Rows of the matrix are documents, columns are n-grams. For a similarity of at least t = 75/100, two
documents of sizes n and m overlap in at least ceil(t/(1+t) * (n+m)) n-grams, and the first
``n - ceil(t*n) + 1`` columns of a document in any fixed order hold a column of each partner. The
product runs over those columns only:

1. Texts with equal sets become one row (128-bit digest and size); copies are never compared.
2. Column lists of up to ``SHORT`` rows yield their pairs; counts are accumulated per pair and pairs
   below the bound of their sizes are dropped. Longer lists yield pairs with their first row only.
3. Surviving pairs are compared on whole sets. Links give components.
4. Long lists whose rows are not yet in one component are multiplied in blocks inside the tasks. Pairs of
   one component are skipped, and pairs whose parity bitmaps differ in more places than their sizes
   allow are dropped (each differing bit is an n-gram that only one of both has). What is left goes
   through step 3.
5. So far the links connect all that is linked, but a component can have more. The sets of one component are
   dealt to pairs of bounded blocks, whole sets are multiplied there, and links are counted per set.

So every link between different texts counts, a large group of copies costs one row, a group of near copies
is joined through its first members, and a passage that many documents share yields few pairs. The
column order puts n-grams found often in a bounded sample of the documents last; the order decides the
speed only, never the result. ``keep_one`` needs no counts and leaves step 5 out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lorespan.llm.common import IdFilter, discarded, list_array, materialize, signed
from lorespan.llm.components import connected_components
from lorespan.llm.shingles import mix, shingle_sets

#: Column lists up to this length yield all their pairs: at most SHORT / 2 a posting.
SHORT = 8
#: Documents whose n-grams are counted to find the order of the columns, and how often is often.
SAMPLE_DOCUMENTS, OFTEN = 4096, 4
#: Rows of a block of the product of a long list.
BLOCK_ROWS = 512
#: Sets and hashes of a block of a component whose links are counted, and columns multiplied at once.
COUNT_ROWS, COUNT_HASHES, COUNT_COLUMNS = 1024, 1 << 19, 4096

_SET = ["high", "low", "n_shingles"]
_SETS = "doc_id long, n_shingles long, high long, low long, parity binary"
_COLUMNS = "doc_id long, n_shingles long, high long, low long, columns array<long>"
_POSTS = "kind byte, col long, a long, b long, n_a int, n_b int, at_a int, at_b int"


def similar_components(docs: DataFrame, percent: int = 75, width: int = 5, sample: int = SAMPLE_DOCUMENTS) -> DataFrame:
    """``doc_id, n_shingles, component_id, n_links`` of every row of ``docs`` (``doc_id long, text``).

    Two documents link when 100 * intersection >= ``percent`` * union of their sets of ``width``-word
    shingles. ``component_id`` is the smallest doc_id reachable, ``n_links`` the number of all links of the
    document's set to other sets (0 for copies only).

    Null, empty and blank texts have an empty set, link with nothing and are their own component. Rows
    with a null doc_id keep a null component. Rows that repeat a doc_id are one node. Other columns are
    ignored. An empty table gives an empty result.
    """
    docs = _narrow(docs)
    sets, members = _grouped(docs, percent, width, sample)
    members = materialize(members, "members")
    known = members.join(_link_counts(docs, members, percent, width), _SET, "left").select(*_SET, "component_id", "n_links")
    return (
        sets.select("doc_id", *_SET)
        .join(known, _SET, "left")
        .select("doc_id", "n_shingles", _component(), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
    )


def keep_one(docs: DataFrame, percent: int = 75, width: int = 5) -> DataFrame:
    """One row of each group of near duplicates: that whose doc_id is the component's. All columns stay.

    Rows with a null doc_id stay; of rows that repeat the doc_id of the kept one, all stay.
    """
    sets, members = _grouped(_narrow(docs), percent, width, SAMPLE_DOCUMENTS)
    found = sets.select("doc_id", *_SET).join(members.drop("class_id"), _SET, "left").select("doc_id", _component())
    gone = found.where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def _narrow(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _component() -> Column:
    return F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id")


def _grouped(docs: DataFrame, percent: int, width: int, sample: int) -> tuple[DataFrame, DataFrame]:
    """The set of every document, and ``high, low, n_shingles, class_id, component_id`` of every different set."""
    sets = materialize(_sets(docs, width), "sets")
    classes = sets.where("doc_id IS NOT NULL AND n_shingles > 0").groupBy("high", "low", "n_shingles").agg(
        F.min("doc_id").alias("class_id")
    )
    classes = materialize(classes, "classes")
    components = connected_components(_links(docs, sets, classes, percent, width, _often(docs, width, sample)))
    members = classes.join(components.withColumnRenamed("node", "class_id"), "class_id", "left")
    return sets, members.select(*_SET, "class_id", F.coalesce("component", "class_id").alias("component_id"))


def _link_counts(docs: DataFrame, members: DataFrame, percent: int, width: int) -> DataFrame:
    """``high, low, n_shingles, n_links`` of the sets that have links: each meets all sets of its component.

    Sets that link are in one component and their size classes are equal or neighbours. A component's size class is
    cut into blocks of bounded rows and hashes, and a task compares two blocks; no pair becomes a row.
    """
    groups = members.groupBy("component_id").agg(F.count("*").alias("sets"), (F.min("class_id") != F.max("class_id")).alias("ids_differ"))
    placed = members.join(groups.where("sets > 1"), "component_id")
    two = (F.col("sets") == 2) & F.col("ids_differ")  # joined by their one link
    own = _size_class(percent)
    rows = placed.where(~two).withColumn("size_class", F.explode(F.array(own, own + 1))).withColumn("visits", F.col("size_class") > own)
    rows = materialize(rows.select(*_SET, "class_id", "component_id", "size_class", "visits"), "count_rows")
    cuts = (
        rows.groupBy("component_id", "size_class")
        .agg(F.count("*").alias("n"), F.sum("n_shingles").alias("hashes"), F.min("visits").alias("guests_only"))
        .where("n > 1 AND NOT guests_only")
        .select("component_id", "size_class", F.ceil(F.greatest(F.col("n") / COUNT_ROWS, F.col("hashes") / COUNT_HASHES)).alias("blocks"))
    )
    rows = rows.join(cuts, ["component_id", "size_class"]).withColumn("block", F.pmod(F.xxhash64("high", "low"), "blocks"))
    concerned = IdFilter(rows.select("class_id").distinct(), "class_id")
    test = concerned.tester()

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(test(batch.column("slot").to_numpy())))
            found = [s for _, s in shingle_sets(batch.column("text"), width)]
            if found:
                high, low = (signed(np.array(d, dtype=np.uint64)) for d in zip(*(_digests(s) if len(s) else (0, 0) for s in found)))
                sizes = [len(s) for s in found]
                values = list_array(signed(np.concatenate(found)), sizes, pa.int64())
                names = ["class_id", *_SET, "hashes"]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(high), pa.array(low), pa.array(sizes, pa.int64()), values], names)

    texts = docs.where("doc_id IS NOT NULL").select("doc_id", concerned.slot(F.col("doc_id")).alias("slot"), "text")
    whole = texts.mapInArrow(hashes, "class_id long, high long, low long, n_shingles long, hashes array<long>")
    cell = ["component_id", "size_class", "x", "y"]
    dealt = (
        rows.hint("merge").join(whole, ["class_id", *_SET])
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .select("component_id", "size_class", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), "block", "visits", *_SET, "hashes")
        .repartition(*cell)
        .sortWithinPartitions(*cell, "block", *_SET)
    )
    counted = dealt.mapInArrow(_count_cells(percent), "high long, low long, n_shingles long, n_links long")
    one = placed.where(two).select(*_SET, F.lit(1).cast("long").alias("n_links"))
    return counted.groupBy(*_SET).agg(F.sum("n_links").alias("n_links")).unionByName(one)


def _count_cells(percent: int):
    """From rows sorted by cell (two blocks of one size class of a component): links of each set in the cell."""
    keys, plain = ("component_id", "size_class", "x", "y"), ("block", "visits", "high", "low", "n_shingles")

    def count(rows: dict, x: int, y: int) -> pa.RecordBatch:
        n, values = rows["n_shingles"], rows["hashes"]
        # Rows of the documents that repeat both id and text.
        again = np.r_[False, (rows["high"][1:] == rows["high"][:-1]) & (rows["low"][1:] == rows["low"][:-1]) & (n[1:] == n[:-1])]
        row = np.repeat(np.arange(len(n)), n)
        _, col, times = np.unique(values, return_inverse=True, return_counts=True)
        shared = times > 1
        row, col = row[shared[col]], (np.cumsum(shared) - 1)[col[shared[col]]]
        order = np.argsort(col, kind="stable")
        row, col = row[order], col[order]
        left, right = (np.flatnonzero((rows["block"] == block) & ~again) for block in (x, y))
        common = np.zeros((len(left), len(right)))
        for start in range(0, int(shared.sum()), COUNT_COLUMNS):
            a, b = np.searchsorted(col, (start, start + COUNT_COLUMNS))
            matrix = np.zeros((len(n), int(col[b - 1]) - start + 1), np.float32)
            matrix[row[a:b], col[a:b] - start] = 1
            common += matrix[left] @ matrix[right].T
        linked = (common > 0) & (100 * common >= percent * (n[left][:, None] + n[right][None, :] - common))
        linked &= ~(rows["visits"][left][:, None] & rows["visits"][right][None, :])  # met in their own class
        if x == y:
            np.fill_diagonal(linked, False)
            which, links = left, linked.sum(axis=1)
        else:
            which, links = np.r_[left, right], np.r_[linked.sum(axis=1), linked.sum(axis=0)]
        which, links = which[links > 0], links[links > 0]
        return pa.RecordBatch.from_arrays([*(pa.array(rows[k][which]) for k in _SET), pa.array(links.astype(np.int64))], [*_SET, "n_links"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        key = None

        def done() -> pa.RecordBatch:
            return count({k: np.concatenate([h[k] for h in held]) for k in held[0]}, *key[2:])

        for batch in batches:
            if not batch.num_rows:
                continue
            now = {k: batch.column(k).to_numpy(zero_copy_only=False) for k in (*keys, *plain)}
            ends, values = batch.column("hashes").offsets.to_numpy(), batch.column("hashes").values.to_numpy()
            cuts = np.flatnonzero(np.any([now[k][1:] != now[k][:-1] for k in keys], axis=0)) + 1
            edges = [0, *cuts.tolist(), batch.num_rows]
            for a, b in zip(edges[:-1], edges[1:]):
                here = tuple(int(now[k][a]) for k in keys)
                if held and here != key:
                    yield done()
                    held = []
                key = here
                # Copies, so that a batch can be let go.
                held.append({k: now[k][a:b].copy() for k in plain} | {"hashes": values[ends[a] : ends[b]].copy()})
        if held:
            yield done()

    return run


def _size_class(percent: int) -> Column:
    """Sets that can link are of one size class or of neighbouring ones."""
    return F.floor(F.log(F.col("n_shingles").cast("double")) / math.log(100 / percent * 1.0000001)).cast("int")


def _prefix(n: int, percent: int) -> int:
    return n + (-percent * n // 100) + 1 if n else 0


def _often(docs: DataFrame, width: int, sample: int) -> np.ndarray:
    """Hashes found in at least OFTEN documents of a bounded sample (the smallest hashes of doc_id)."""
    if not sample:
        return np.zeros(0, np.uint64)
    chosen = docs.select("doc_id").where("doc_id IS NOT NULL").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [s for _, s in shingle_sets(batch.column("text"), width)]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(signed(np.concatenate(found)))], ["col"])

    texts = docs.join(F.broadcast(chosen), "doc_id", "left_semi").select("text")
    counts = texts.mapInArrow(run, "col long").groupBy("col").count().where(F.col("count") >= OFTEN)
    top = counts.orderBy(F.desc("count"), "col").limit(1 << 16)
    return np.sort(np.array([r[0] for r in top.collect()], dtype=np.int64).view(np.uint64))


def _digests(found: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set."""
    return int(np.sum(mix(found))), int(np.sum(mix(found ^ np.uint64(0x5851F42D4C957F2D))))


def _sets(docs: DataFrame, width: int) -> DataFrame:
    """Size, digest and parity bitmap of every document's set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, sizes, high, low, parity = [], [], [], [], []
            for row, found in shingle_sets(batch.column("text"), width):
                rows.append(row)
                sizes.append(len(found))
                for digest, value in zip((high, low), _digests(found) if len(found) else (0, 0)):
                    digest.append(value)
                parity.append(_parity(found))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(rows, pa.int32())),
                    pa.array(sizes, pa.int64()),
                    pa.array(signed(np.array(high, dtype=np.uint64))),
                    pa.array(signed(np.array(low, dtype=np.uint64))),
                    pa.array(parity, pa.binary()),
                ],
                ["doc_id", "n_shingles", "high", "low", "parity"],
            )

    return docs.mapInArrow(run, _SETS)


def _columns(docs: DataFrame, percent: int, width: int, often: np.ndarray) -> DataFrame:
    """The first columns of every document, those of ``often`` last. Made apart from ``_sets``: making them twice
    takes less than storing them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, sizes, high, low, columns = [], [], [], [], []
            for row, found in shingle_sets(batch.column("text"), width):
                n = len(found)
                if not n:
                    continue
                rows.append(row)
                sizes.append(n)
                for digest, value in zip((high, low), _digests(found)):
                    digest.append(value)
                if len(often):
                    place = np.minimum(np.searchsorted(often, found), len(often) - 1)
                    late = often[place] == found
                    found = np.concatenate([found[~late], found[late]])
                columns.append(found[: _prefix(n, percent)])
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(pa.array(rows, pa.int32())),
                        pa.array(sizes, pa.int64()),
                        pa.array(signed(np.array(high, dtype=np.uint64))),
                        pa.array(signed(np.array(low, dtype=np.uint64))),
                        list_array(signed(np.concatenate(columns)), [len(c) for c in columns], pa.int64()),
                    ],
                    ["doc_id", "n_shingles", "high", "low", "columns"],
                )

    return docs.where("doc_id IS NOT NULL").mapInArrow(run, _COLUMNS)


def _parity(found: np.ndarray) -> bytes:
    """One bit a bucket: whether an odd number of hashes fell into it. The number of buckets follows the size."""
    bits = 512
    while bits < len(found) and bits < 1 << 16:
        bits *= 2
    counts = np.bincount((found >> np.uint64(7)).astype(np.int64) & (bits - 1), minlength=bits)
    return np.packbits(counts & 1, bitorder="little").tobytes()


def _folded(parity: list[bytes], size: int) -> np.ndarray:
    """Parity bitmaps as rows of 64-bit words, all folded to ``size`` bytes."""
    rows = [np.bitwise_xor.reduce(np.frombuffer(p, np.uint64).reshape(-1, size // 8), axis=0) for p in parity]
    return np.stack(rows)


def _links(docs: DataFrame, sets: DataFrame, classes: DataFrame, percent: int, width: int, often: np.ndarray) -> DataFrame:
    """``a, b``: links between classes that connect all that is linked."""
    rows = (
        _columns(docs, percent, width, often)
        .groupBy("high", "low", "n_shingles")
        .agg(F.min(F.struct("doc_id", "columns")).alias("first"))
        .select(F.col("first.doc_id").alias("doc"), F.col("n_shingles").cast("int").alias("n"), F.col("first.columns").alias("columns"))
    )
    posts = rows.select("doc", "n", F.posexplode("columns").alias("at", "col"))
    lists = posts.repartition("col").sortWithinPartitions("col", "doc")
    posts = materialize(lists.mapInArrow(_short_lists(percent), _POSTS), "posts")
    pairs = _accumulated(posts.where("kind = 0"), percent)
    links = _verified(docs, pairs, percent, width)

    long_lists = posts.where("kind = 1").select("col", F.col("a").alias("doc"), F.col("n_a").alias("n"), F.col("at_a").alias("at"))
    if long_lists.isEmpty():
        return links
    components = connected_components(links)
    placed = long_lists.join(components.withColumnRenamed("node", "doc"), "doc", "left").withColumn(
        "component", F.coalesce("component", "doc")
    )
    placed = materialize(placed, "placed")
    open_lists = placed.groupBy("col").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select("col")
    parities = sets.join(classes.select(F.col("class_id").alias("doc_id")), "doc_id", "left_semi").select(
        F.col("doc_id").alias("doc"), F.col("n_shingles").cast("int").alias("n"), "parity"
    )
    step = F.floor(F.log(F.col("n").cast("double")) / math.log(100 / percent * 1.0000001)).cast("int")
    rows = (
        placed.join(open_lists, "col", "left_semi")
        .join(parities, ["doc", "n"])
        .withColumn("own", step)
        # A row meets its own size class and, as a visitor, the next larger one.
        .withColumn("size_class", F.explode(F.array("own", F.col("own") + 1)))
        .withColumn("visits", F.col("size_class") > F.col("own"))
    )
    dealt = rows.repartition("col", "size_class").sortWithinPartitions("col", "size_class", "visits", "component", "doc")
    more = dealt.select("col", "size_class", "visits", "component", "doc", "n", "at", "parity").mapInArrow(
        _long_lists(percent), "a long, b long"
    )
    more = _verified(docs, materialize(more.distinct(), "pairs"), percent, width)
    return materialize(links.unionByName(more), "links")


def _short_lists(percent: int):
    """From rows sorted by column: pairs of short lists, pairs with the first row of long lists, and long lists."""

    def pairs(run: dict[str, np.ndarray], first: np.ndarray, second: np.ndarray) -> list[np.ndarray]:
        n, m = run["n"][first].astype(np.int64), run["n"][second].astype(np.int64)
        i, j = run["at"][first], run["at"][second]
        enough = -(-percent * (n + m) // (100 + percent))
        fits = (np.minimum(n, m) * 100 >= percent * np.maximum(n, m)) & (np.minimum(n - i, m - j) >= enough)
        first, second = first[fits], second[fits]
        out = [run["col"][first], run["doc"][first], run["doc"][second], run["n"][first], run["n"][second], run["at"][first], run["at"][second]]
        swap = out[1] > out[2]
        for x, y in ((1, 2), (3, 4), (5, 6)):
            out[x], out[y] = np.where(swap, out[y], out[x]), np.where(swap, out[x], out[y])
        return [np.zeros(len(first), np.int8), *out]

    def work(run: dict[str, np.ndarray], carried: int) -> list[list[np.ndarray]]:
        """``carried``: rows of the first list that earlier calls have seen (only its first row is in ``run``)."""
        col = run["col"]
        starts = np.flatnonzero(np.r_[True, col[1:] != col[:-1]])
        lengths = np.diff(np.r_[starts, len(col)])
        out = []
        index = np.arange(len(col))
        start_of, length_of = np.repeat(starts, lengths), np.repeat(lengths, lengths)
        is_long = length_of > SHORT
        if carried:
            is_long |= start_of == 0
        for gap in range(1, SHORT):
            second = index[gap:][(start_of[gap:] == start_of[:-gap]) & ~is_long[gap:]]
            out.append(pairs(run, second - gap, second))
        members = index[is_long & (index != start_of)]
        out.append(pairs(run, start_of[members], members))
        rows = index[is_long]
        if carried:
            rows = rows[rows != 0]
        none = np.zeros(len(rows), np.int64)
        out.append([np.ones(len(rows), np.int8), col[rows], run["doc"][rows], none, run["n"][rows], none, run["at"][rows], none])
        return out

    def batch_of(parts: list[list[np.ndarray]]) -> pa.RecordBatch:
        kinds = (pa.int8(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32())
        names = ("kind", "col", "a", "b", "n_a", "n_b", "at_a", "at_b")
        columns = [np.concatenate([p[k] for p in parts]) for k in range(8)]
        return pa.RecordBatch.from_arrays([pa.array(c.astype(t.to_pandas_dtype()), t) for c, t in zip(columns, kinds)], list(names))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] | None = None
        carried = 0
        for batch in batches:
            now = {k: batch.column(k).to_numpy(zero_copy_only=False) for k in ("col", "doc", "n", "at")}
            if not len(now["col"]):
                continue
            if held is not None:
                now = {k: np.concatenate([held[k], now[k]]) for k in now}
            last = int(np.searchsorted(now["col"], now["col"][-1], "left"))
            open_rows = len(now["col"]) - last
            if open_rows > SHORT:
                # The last list is long already: its rows go out now, its first row stays to meet the rest.
                yield batch_of(work(now, carried))
                held, carried = {k: v[last : last + 1] for k, v in now.items()}, 1
            else:
                if last:
                    yield batch_of(work({k: v[:last] for k, v in now.items()}, carried))
                    carried = 0
                held = {k: v[last:] for k, v in now.items()}
        if held is not None and len(held["col"]) > carried:
            yield batch_of(work(held, carried))

    return run


def _accumulated(pairs: DataFrame, percent: int) -> DataFrame:
    """Counts per pair; pairs whose count and last common places rule out the bound of their sizes are dropped."""
    counted = pairs.groupBy("a", "b").agg(
        F.count("*").alias("c"), F.max("n_a").alias("n_a"), F.max("n_b").alias("n_b"), F.max("at_a").alias("at_a"), F.max("at_b").alias("at_b")
    )
    most = F.least(F.col("n_a") - 1 - F.col("at_a"), F.col("n_b") - 1 - F.col("at_b"))
    # Long lists give some of their pairs only, so the count misses what a pair shares there; see _verified for the rest.
    exact = counted.where((F.col("c") + most) * (100 + percent) >= percent * (F.col("n_a") + F.col("n_b")))
    return exact.select("a", "b")


def _long_lists(percent: int):
    """Blocks of the product of one (column, size class): pairs of different components that may still link."""

    def meet(x: dict, y: dict, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        size = min(min(map(len, x["parity"])), min(map(len, y["parity"])))
        p, q = _folded(x["parity"], size), _folded(y["parity"], size)
        n, m = x["n"][:, None].astype(np.int64), y["n"][None, :].astype(np.int64)
        fits = (np.minimum(n, m) * 100 >= percent * np.maximum(n, m)) & (x["component"][:, None] != y["component"][None, :])
        if same:
            fits &= np.tri(len(p), len(q), -1, dtype=bool)
        i, j = np.nonzero(fits)
        for s in range(0, len(i), 1 << 16):
            a, b = i[s : s + (1 << 16)], j[s : s + (1 << 16)]
            differ = np.bitwise_count(p[a] ^ q[b]).sum(axis=1, dtype=np.int64)
            total = x["n"][a].astype(np.int64) + y["n"][b]
            # overlap <= (n + m - differ) / 2
            good = (total - differ) * (100 + percent) >= 2 * percent * total
            left, right = x["doc"][a[good]], y["doc"][b[good]]
            yield np.minimum(left, right), np.maximum(left, right)

    def product(rows: dict) -> Iterator[pa.RecordBatch]:
        n = len(rows["doc"])
        guests = rows["visits"]
        cuts = [(s, min(s + BLOCK_ROWS, n)) for s in range(0, n, BLOCK_ROWS)]
        low = [rows["component"][a:b].min() for a, b in cuts]
        high = [rows["component"][a:b].max() for a, b in cuts]
        found = []
        for k, (a, b) in enumerate(cuts):
            x = {key: v[a:b] for key, v in rows.items()}
            for c, d in cuts[: k + 1]:
                if guests[a:b].all() and guests[c:d].all():
                    continue  # both are met in their own class
                if low[k] == high[k] == low[c // BLOCK_ROWS] == high[c // BLOCK_ROWS]:
                    continue
                found += meet(x, {key: v[c:d] for key, v in rows.items()}, a == c)
                if sum(len(f[0]) for f in found) > 1 << 16:
                    yield distinct(found)
                    found = []
        if found:
            yield distinct(found)

    def distinct(found: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        both = np.unique(np.stack([np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])], axis=1), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []

        def joined() -> dict:
            out = {k: np.concatenate([h[k] for h in held]) for k in held[0] if k != "parity"}
            return out | {"parity": [p for h in held for p in h["parity"]]}

        key = None
        for batch in batches:
            now = {k: batch.column(k).to_numpy(zero_copy_only=False) for k in ("col", "size_class", "visits", "component", "doc", "n")}
            now["parity"] = batch.column("parity").to_pylist()
            cuts = np.flatnonzero((now["col"][1:] != now["col"][:-1]) | (now["size_class"][1:] != now["size_class"][:-1])) + 1
            edges = [0, *cuts.tolist(), len(now["col"])]
            for a, b in zip(edges[:-1], edges[1:]):
                if a == b:
                    continue
                here = (now["col"][a], now["size_class"][a])
                if key is not None and here != key:
                    yield from product(joined())
                    held = []
                key = here
                held.append({k: v[a:b] for k, v in now.items()})
        if held:
            yield from product(joined())

    return run


def _verified(docs: DataFrame, pairs: DataFrame, percent: int, width: int) -> DataFrame:
    """The pairs whose whole sets are similar enough. Sets are made again for the documents concerned only."""
    pairs = materialize(pairs, "candidates")
    ids = pairs.select(F.explode(F.array("a", "b")).alias("doc")).distinct()
    concerned = IdFilter(ids, "doc")
    test = concerned.tester()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(test(batch.column("slot").to_numpy())))
            names, found = batch.column("doc"), [s for _, s in shingle_sets(batch.column("text"), width)]
            if found:
                values = list_array(signed(np.concatenate(found)), [len(s) for s in found], pa.int64())
                yield pa.RecordBatch.from_arrays([names, values], ["doc", "hashes"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            ends = {k: batch.column(k).offsets.to_numpy() for k in ("x", "y")}
            values = {k: batch.column(k).values.to_numpy() for k in ("x", "y")}
            for row in range(batch.num_rows):
                x, y = (values[k][ends[k][row] : ends[k][row + 1]] for k in ("x", "y"))
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= percent * (len(x) + len(y) - common) and common > 0)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    texts = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").alias("doc"), concerned.slot(F.col("doc_id")).alias("slot"), "text")
    with discarded(texts.mapInArrow(run, "doc long, hashes array<long>"), "hashes") as hashes:
        # Merge joins at every size: sides are split when a document has very many pairs.
        both = (
            pairs.hint("merge").join(hashes.select(F.col("doc").alias("b"), F.col("hashes").alias("y")), "b")
            .hint("merge").join(hashes.select(F.col("doc").alias("a"), F.col("hashes").alias("x")), "a")
            .select("a", "b", "x", "y")
        )
        return materialize(both.mapInArrow(compare, "a long, b long"), "links")
