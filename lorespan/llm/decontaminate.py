"""Benchmark decontamination with a positional inverted index of the training tokens.

The index holds postings (term, document, positions). A benchmark window is found by intersecting the
lists of its rarest terms after subtracting each term's offset in the window, so only documents that hold
those terms at the right distances are looked at again; there the whole window is compared.

Terms are 64-bit hashes of words. Statistics and postings cover all documents; the terms looked for are sent
to the tasks in blocks of at most ``TERM_BLOCK`` hashes (8 MB), one pass over the documents a block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lorespan.llm.common import IdFilter, list_array, materialize, signed
from lorespan.llm.shingles import blocks, hashes_and_bounds, string_parts, window_hashes

#: Consecutive item words that count as a leak; an item of fewer words is one window.
WINDOW = 10
#: Lists intersected for a window before the whole window is compared.
ANCHORS = 3
TERM_BLOCK = 1 << 20

#: Bytes that separate words: all of ASCII but digits and letters.
SEPARATORS = np.ones(256, dtype=bool)
SEPARATORS[128:] = False
for _low, _high in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B)):
    SEPARATORS[_low:_high] = False


def texts_of(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, word hashes, first word of each text and the end) of blocks of texts."""
    data, offsets = string_parts(column)
    for first, last in blocks(offsets):
        low, high = offsets[first], offsets[last]
        words, bounds = hashes_and_bounds(data[low:high], offsets[first : last + 1] - low, SEPARATORS)
        yield first, words, bounds


def item_windows(items: DataFrame, width: int = WINDOW) -> DataFrame:
    """``item_id, window, terms`` of benchmark items (``item_id, text``): one row a window and item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, windows, terms = [], [], []
            for first, words, bounds in texts_of(batch.column("text")):
                for k in range(len(bounds) - 1):
                    own = words[bounds[k] : bounds[k + 1]]
                    size = min(width, len(own))
                    for at, value in enumerate(window_hashes(own, size) if size else ()):
                        rows.append(first + k)
                        windows.append(value)
                        terms.append(own[at : at + size])
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("item_id").take(pa.array(rows)),
                        pa.array(signed(np.array(windows, dtype=np.uint64))),
                        list_array(signed(np.concatenate(terms)), [len(t) for t in terms], pa.int64()),
                    ],
                    ["item_id", "window", "terms"],
                )

    kind = items.schema["item_id"].dataType.simpleString()
    return items.select("item_id", F.col("text").cast("string").alias("text")).mapInArrow(
        run, f"item_id {kind}, window long, terms array<long>"
    )


def _blocks(terms: DataFrame) -> Iterator[np.ndarray]:
    """Sorted hashes of the column ``term`` in blocks of bounded size."""
    n = -(-terms.count() // TERM_BLOCK) or 1
    for k in range(n):
        part = terms.where(F.pmod("term", F.lit(n)) == k).toPandas()["term"].to_numpy(dtype=np.int64)
        yield np.sort(part.view(np.uint64))


def members(terms: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the words that are terms, and the index of the term at each."""
    if not len(terms) or not len(words):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    place = np.searchsorted(terms, words)
    place[place == len(terms)] = 0
    found = np.flatnonzero(terms[place] == words)
    return found, place[found]


def term_statistics(docs: DataFrame, terms: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(``doc_id, n_words`` of every document, ``term, df`` of the terms that occur) from passes over ``docs``."""
    spark = docs.sparkSession

    def passes(wanted: np.ndarray, first: bool):
        sent = spark.sparkContext.broadcast(wanted)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            terms_ = sent.value
            df = np.zeros(len(terms_), np.int64)
            for batch in batches:
                counts = np.zeros(batch.num_rows, np.int64)
                for start, words, bounds in texts_of(batch.column("text")):
                    counts[start : start + len(bounds) - 1] = np.diff(bounds)
                    at, term = members(terms_, words)
                    owner = np.searchsorted(bounds, at, "right") - 1
                    df += np.bincount(np.unique(owner * len(terms_) + term) % max(len(terms_), 1), minlength=len(terms_))[: len(terms_)]
                if first:
                    nothing = pa.nulls(batch.num_rows, pa.int64())
                    yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(counts), nothing, nothing], names)
            seen = np.flatnonzero(df)
            nothing = pa.nulls(len(seen), pa.int64())
            yield pa.RecordBatch.from_arrays([nothing, nothing, pa.array(signed(terms_[seen])), pa.array(df[seen])], names)

        return docs.mapInArrow(run, "doc_id long, n_words long, term long, df long")

    names = ["doc_id", "n_words", "term", "df"]
    tables = [materialize(passes(wanted, k == 0), "terms") for k, wanted in enumerate(_blocks(terms))]
    sizes = tables[0].where("n_words IS NOT NULL").select("doc_id", "n_words")
    counts = tables[0]
    for more in tables[1:]:
        counts = counts.unionByName(more)
    return sizes, counts.where("term IS NOT NULL").groupBy("term").agg(F.sum("df").alias("df"))


def positional_index(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """Postings ``term, doc_id, positions array<int>`` of the given terms (column ``term``) in all documents."""
    spark = docs.sparkSession

    def passes(wanted: np.ndarray):
        sent = spark.sparkContext.broadcast(wanted)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for start, words, bounds in texts_of(batch.column("text")):
                    at, term = members(sent.value, words)
                    if not len(at):
                        continue
                    owner = np.searchsorted(bounds, at, "right") - 1
                    order = np.lexsort((at, term, owner))
                    at, term, owner = at[order], term[order], owner[order]
                    lists = np.flatnonzero(np.r_[True, (term[1:] != term[:-1]) | (owner[1:] != owner[:-1])])
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(signed(sent.value[term[lists]])),
                            batch.column("doc_id").take(pa.array(owner[lists] + start)),
                            list_array((at - bounds[owner]).astype(np.int32), np.diff(np.r_[lists, len(at)]), pa.int32()),
                        ],
                        ["term", "doc_id", "positions"],
                    )

        return docs.mapInArrow(run, "term long, doc_id long, positions array<int>")

    parts = [materialize(passes(wanted), "postings") for wanted in _blocks(terms)]
    index = parts[0]
    for more in parts[1:]:
        index = index.unionByName(more)
    return index


def intersect(index: DataFrame, windows: DataFrame) -> DataFrame:
    """``window, width, doc_id, starts`` where every anchor of a window (``anchors array<struct<at,term>>``) is in place."""
    found = windows.select("window", "width", "anchors")
    for k in range(ANCHORS):
        one = F.col("anchors")[F.least(F.lit(k), F.size("anchors") - 1)]  # a window of few terms meets its last list again
        found = found.withColumn("term", one["term"]).withColumn("shift", one["at"])
        starts = F.filter(F.transform("positions", lambda p: p - F.col("shift")), lambda p: p >= 0)
        if k == 0:
            found = found.join(index, "term").withColumn("starts", starts)
        else:
            found = found.join(index, ["term", "doc_id"]).withColumn("starts", F.array_intersect("starts", starts))
        found = found.where(F.size("starts") > 0).drop("positions", "shift", "term")
    return found.select("window", "width", "doc_id", "starts")


def contamination(docs: DataFrame, items: DataFrame, width: int = WINDOW) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` of every row of ``docs``.

    ``docs``: ``doc_id long, text``; ``items``: ``item_id, text``. A window is ``width`` consecutive words of
    an item, or all words of a shorter one. A document word inside an occurrence of a window is hit.
    ``items_sha256`` is the digest of the ids of the items that occur, sorted as strings and comma-joined.

    Null texts have no words; items without words have no window; items with a null id can hit but are not
    listed. Rows that repeat a doc_id share their hits; rows with a null doc_id are counted but never hit. Other columns are ignored. An empty table of items
    leaves every document clean; an empty table of documents gives an empty result.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    listed = materialize(item_windows(items, width), "windows")
    windows = listed.groupBy("window").agg(F.min("terms").alias("terms")).withColumn("width", F.size("terms"))
    terms = windows.select(F.explode("terms").alias("term")).distinct()
    sizes, counts = term_statistics(docs, terms)
    places = windows.select("window", "width", F.posexplode("terms").alias("at", "term")).join(counts, "term")
    anchors = (
        places.groupBy("window", "width")
        .agg(F.array_sort(F.collect_list(F.struct("df", "at", "term"))).alias("all"))  # at most ``width`` entries
        .where(F.size("all") == F.col("width"))  # else a word of the window is in no document
        .select("window", "width", F.slice("all", 1, ANCHORS).alias("anchors"))
    )
    anchors = materialize(anchors, "anchors")
    index = positional_index(docs, anchors.select(F.explode("anchors.term").alias("term")).distinct())
    found = materialize(intersect(index, anchors), "candidates")
    hits = materialize(_compared(docs, found), "hits")
    matched = hits.select("doc_id", F.explode("windows").alias("window")).join(listed.select("window", "item_id"), "window")
    names = (
        matched.where("item_id IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("ids"))
    )
    hits = hits.groupBy("doc_id").agg(F.max("n_hit").alias("n_hit"))
    ids = F.coalesce("ids", F.array().cast("array<string>"))
    return (
        sizes.join(hits, "doc_id", "left")
        .join(names, "doc_id", "left")
        .select(
            "doc_id",
            "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.size(ids).cast("long").alias("n_items"),
            F.sha2(F.concat_ws(",", ids).cast("binary"), 256).alias("items_sha256"),
            (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
        )
    )


def _compared(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``doc_id, n_hit, windows``: candidates compared word by word, in the documents concerned only."""
    per_doc = found.groupBy("doc_id").agg(F.collect_list(F.struct("window", "width", "starts")).alias("found"))
    concerned = IdFilter(per_doc, "doc_id")
    test = concerned.tester()

    def narrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(test(batch.column("slot").to_numpy()))).select(["doc_id", "text"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hits, windows = [], [], []
            names, candidates = batch.column("doc_id").to_pylist(), batch.column("found")
            for start, words, bounds in texts_of(batch.column("text")):
                for k in range(len(bounds) - 1):
                    own = words[bounds[k] : bounds[k + 1]]
                    hashes: dict[int, np.ndarray] = {}
                    hit, seen = np.zeros(len(own) + 1, np.int64), set()
                    for one in candidates[start + k].as_py():
                        size = one["width"]
                        if size not in hashes:
                            hashes[size] = signed(window_hashes(own, size))
                        at = np.array(one["starts"], dtype=np.int64)
                        at = at[at < len(hashes[size])]
                        at = at[hashes[size][at] == one["window"]]
                        if len(at):
                            seen.add(one["window"])
                            np.add.at(hit, at, 1)
                            np.add.at(hit, at + size, -1)
                    if seen:
                        ids.append(names[start + k])
                        hits.append(int((np.cumsum(hit) > 0).sum()))
                        windows.append(sorted(seen))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(hits, pa.int64()), pa.array(windows, pa.list_(pa.int64()))], ["doc_id", "n_hit", "windows"]
            )

    texts = docs.select("doc_id", concerned.slot(F.col("doc_id")).alias("slot"), "text").mapInArrow(narrow, "doc_id long, text string")
    both = texts.join(per_doc, "doc_id").select("doc_id", "text", "found")
    return both.mapInArrow(run, "doc_id long, n_hit long, windows array<long>")


def proximity_matches(docs: DataFrame, phrases: DataFrame, slop: int = 3) -> DataFrame:
    """``phrase_id, doc_id, start`` where all words of a phrase lie within its length plus ``slop`` words, in order.

    ``phrases``: ``phrase_id, text``. Lists are intersected from a phrase's rarest terms on, with a span of ``slop`` instead of an
    offset; postings of its other terms are not read. Documents left over are looked at again with the whole phrase. Null
    and empty phrases match nothing, nor do documents with a null id. Rows that repeat a doc_id are matched one by one.
    """
    items = phrases.select(F.col("phrase_id").alias("item_id"), "text")
    listed = materialize(item_windows(items, 1 << 20), "phrases")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("doc_id IS NOT NULL")
    _, counts = term_statistics(docs, listed.select(F.explode("terms").alias("term")).distinct())
    places = listed.select("window", F.size("terms").alias("width"), F.posexplode("terms").alias("at", "term")).distinct().join(counts, "term")
    anchors = materialize(
        places.groupBy("window", "width")
        .agg(F.array_sort(F.collect_list(F.struct("df", "at", "term"))).alias("all"))  # as many entries as the phrase has words
        .where(F.size("all") == F.col("width"))
        .select("window", F.slice("all", 1, ANCHORS).alias("anchors")),
        "anchors",
    )
    index = positional_index(docs, anchors.select(F.explode("anchors.term").alias("term")).distinct())
    found = anchors
    for k in range(ANCHORS):
        one = F.col("anchors")[F.least(F.lit(k), F.size("anchors") - 1)]
        found = found.withColumn("term", one["term"]).withColumn("shift", one["at"])
        starts = F.transform("positions", lambda p: p - F.col("shift"))
        if k == 0:
            found = found.join(index, "term").withColumn("starts", starts)
        else:
            near = F.filter("starts", lambda s: F.exists("own", lambda t: F.abs(t - s) <= slop))
            found = found.join(index, ["term", "doc_id"]).withColumn("own", starts).withColumn("starts", near).drop("own")
        found = found.where(F.size("starts") > 0).drop("positions", "shift", "term")
    wanted = found.select("window", "doc_id").distinct().join(listed.select("window", "item_id", "terms"), "window")
    return _phrases_near(docs, materialize(wanted.select("doc_id", "item_id", "terms"), "near"), slop, phrases.schema["phrase_id"].dataType.simpleString())


def _phrases_near(docs: DataFrame, wanted: DataFrame, slop: int, kind: str) -> DataFrame:
    """Places of the phrases ``wanted`` (``doc_id, item_id, terms``) in the documents concerned."""
    concerned = IdFilter(wanted, "doc_id")
    test = concerned.tester()
    schema = f"phrase_id {kind}, doc_id long, start int"

    def narrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(test(batch.column("slot").to_numpy()))).select(["doc_id", "text"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, starts = [], []
            for start, words, bounds in texts_of(batch.column("text")):
                for k in range(len(bounds) - 1):
                    own = signed(words[bounds[k] : bounds[k + 1]])
                    terms = np.array(batch.column("terms")[start + k].as_py(), dtype=np.int64)
                    lists = [np.flatnonzero(own == term) for term in terms]
                    first = last = lists[0]
                    alive = np.ones(len(first), bool)
                    for more in lists[1:]:
                        place = np.searchsorted(more, last, "right")
                        alive &= place < len(more)
                        last = more[np.minimum(place, len(more) - 1)] if len(more) else last
                    good = alive & (last - first < len(lists) + slop)
                    rows += [start + k] * int(good.sum())
                    starts += first[good].tolist()
            where = pa.array(rows, pa.int32())
            columns = [batch.column("item_id").take(where), batch.column("doc_id").take(where), pa.array(starts, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, ["phrase_id", "doc_id", "start"])

    texts = docs.select("doc_id", concerned.slot(F.col("doc_id")).alias("slot"), "text").mapInArrow(narrow, "doc_id long, text string")
    return texts.join(wanted, "doc_id").select("doc_id", "item_id", "terms", "text").mapInArrow(run, schema)
