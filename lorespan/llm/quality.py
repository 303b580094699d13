"""Quality by co-training: a classifier of the text and one of its metadata teach each other.

The text view holds shares of character classes, word statistics and repetition, counted on the bytes of
whole texts; the metadata view holds language, source and stated length. Both start from the labelled rows. In
each round every classifier scores all unlabelled rows, and labels those it is surest of for the other one to learn from: a
share of them, by a threshold that a histogram over all rows gives. On labelled rows kept apart both views are calibrated, and a
small logistic model of both combines them.

Nothing but coefficients, thresholds and sums comes to the driver: features of every document are written once, slope
and curvature of both fits are summed up in the tasks, and which rows a view was taught, and as what, follows
from the classifiers and thresholds of the rounds before.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lorespan.llm.common import materialize
from lorespan.llm.models import decision, fit_logistic, newton_step, newton_sums, sigmoid, summed
from lorespan.llm.shingles import BLOCK_BYTES, blocks, string_parts, word_pieces

#: Labelled rows for calibration, at most: those with the smallest hashes of their ids among the rows kept apart.
CALIBRATION_ROWS = 20_000
#: Rounds, and the share of the unlabelled rows that a view hands over of each class in a round, if it is this sure.
ROUNDS, SHARE, SURE = 3, 0.02, 0.95
#: Weight of a row that the other view labelled, ridge penalty, and steps of a fit.
TAUGHT_WEIGHT, RIDGE, STEPS = 0.5, 2.0, 12
#: Log odds are counted in bins of this width, up to this size.
BIN, MOST_ODDS = 0.01, 40.0
SOURCE_BUCKETS = 64

_CLASSES = np.full(256, 7, dtype=np.uint8)  # other ASCII
_CLASSES[65:91], _CLASSES[97:123], _CLASSES[48:58], _CLASSES[128:] = 0, 1, 2, 3
_CLASSES[[32, 9, 13]], _CLASSES[10], _CLASSES[[44, 46]] = 4, 5, 6
for _k, _c in enumerate(b"!|*%$&#"):
    _CLASSES[_c] = 8 + _k
N_CLASSES = 15


def text_view(column: pa.Array) -> np.ndarray:
    """One row of features for every text; null and empty texts have zeros and a mark of their own."""
    data, offsets = string_parts(column)
    out = np.zeros((len(column), N_CLASSES * 2 + 7))
    for first, last in blocks(offsets):
        low, high = offsets[first], offsets[last]
        part, bounds = data[low:high], offsets[first : last + 1] - low
        hashes, total, single = [np.zeros(0, np.uint64)], np.zeros(len(bounds), np.int64), np.zeros(len(bounds), np.int64)
        edges = np.zeros(len(bounds), np.int64)
        for words, starts, ends in word_pieces(part, bounds):
            sizes = np.concatenate([[0], np.cumsum(ends - starts)])
            ones = np.concatenate([[0], np.cumsum(ends - starts == 1)])
            upto = np.searchsorted(starts, bounds, "left")
            hashes.append(words)
            edges, total, single = edges + upto, total + sizes[upto], single + ones[upto]
        words = hashes[1] if len(hashes) == 2 else np.concatenate(hashes)
        for k in range(last - first):
            a, b = bounds[k], bounds[k + 1]
            own = words[edges[k] : edges[k + 1]]
            row = out[first + k]
            if not len(own):
                row[-1] = 1.0
                continue
            n, m = b - a, len(own)
            counts = sum(np.bincount(_CLASSES[part[c : min(c + BLOCK_BYTES, b)]], minlength=N_CLASSES) for c in range(a, b, BLOCK_BYTES)) / n
            row[:N_CLASSES] = counts
            row[N_CLASSES : 2 * N_CLASSES] = np.log1p(100 * counts)
            distinct = len(np.unique(own)) / m
            repeated = float((own[1:] == own[:-1]).mean()) if m > 1 else 0.0
            mean, ones = (total[k + 1] - total[k]) / m, (single[k + 1] - single[k]) / m
            row[-7:-1] = (np.log1p(m), distinct, distinct * np.log1p(m), repeated, mean / 10, ones)
    return out


def metadata_view(langs: list, sources: list, sizes: list) -> np.ndarray:
    """Language and source in hashed buckets, and the stated length; nulls have buckets of their own."""
    from zlib import crc32

    out = np.zeros((len(langs), SOURCE_BUCKETS + 16 + 2))
    for k, (lang, source, size) in enumerate(zip(langs, sources, sizes)):
        out[k, crc32(str(source).encode()) % SOURCE_BUCKETS] = 1.0
        out[k, SOURCE_BUCKETS + crc32(str(lang).encode()) % 16] = 1.0
        out[k, -2] = np.log1p(max(size or 0, 0)) / 10
        out[k, -1] = float(size is None)
    return out


@dataclass
class Model:
    """Coefficients of the views, of their calibration (slope, intercept) and of the combination."""

    text: np.ndarray
    metadata: np.ndarray
    scale: tuple[np.ndarray, np.ndarray]
    text_cal: np.ndarray
    metadata_cal: np.ndarray
    both: np.ndarray

    def score(self, text: np.ndarray, metadata: np.ndarray) -> np.ndarray:
        a, b = self.calibrated(text, metadata)
        return sigmoid(decision(np.column_stack([a, b]), self.both))

    def calibrated(self, text: np.ndarray, metadata: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log odds of both views."""
        a = decision((text - self.scale[0]) / self.scale[1], self.text)
        return decision(a[:, None], self.text_cal), decision(decision(metadata, self.metadata)[:, None], self.metadata_cal)


VIEWS = ("text", "metadata")
OTHER = {"text": "metadata", "metadata": "text"}


@dataclass(frozen=True)
class Rule:
    """A classifier of one view that labels rows for the other: 0 up to ``low`` log odds, 1 from ``high`` on."""

    beta: np.ndarray
    low: float
    high: float

    def labels(self, x: np.ndarray) -> np.ndarray:
        odds = decision(x, self.beta)
        return np.where(odds >= self.high, 1.0, np.where(odds <= self.low, 0.0, np.nan))


def taught_labels(x: np.ndarray, rules: list[Rule]) -> np.ndarray:
    """What the rules of the rounds say of rows of the teaching view: the first that says anything counts, else NaN."""
    out = np.full(len(x), np.nan)
    for rule in rules:
        out = np.where(np.isnan(out), rule.labels(x), out)
    return out


def threshold(counts: np.ndarray, most: float) -> int:
    """The first bin from which on at most ``most`` rows are, the last bin with rows at least."""
    behind = np.cumsum(counts[::-1])[::-1]
    fine = np.flatnonzero(behind <= most)
    last = int(np.flatnonzero(counts)[-1]) if counts.any() else len(counts) - 1
    return min(int(fine[0]) if len(fine) else last, last)


def _bins(odds: np.ndarray) -> np.ndarray:
    return np.floor(np.clip(odds, 0, MOST_ODDS - BIN / 2) / BIN).astype(np.int64)


N_BINS = int(round(MOST_ODDS / BIN))


class CoTraining:
    """The rounds over a table of features. ``views(batch)`` gives a batch's label (NaN for none), mark of rows kept apart, and views."""

    def __init__(self, rows: DataFrame, views, widths: dict[str, int]) -> None:
        self.rows, self.views, self.widths = rows, views, widths

    def run(self) -> tuple[dict[str, np.ndarray], dict[str, list[Rule]]]:
        """(classifier of each view, rules by the view they teach)."""
        fitted = {v: np.zeros(self.widths[v] + 1) for v in VIEWS}
        rules: dict[str, list[Rule]] = {v: [] for v in VIEWS}
        for round_ in range(ROUNDS + 1):
            fitted = self.fit(fitted, rules)
            if round_ < ROUNDS:
                counts, free = self.histograms(fitted, rules)
                for view in VIEWS:  # what this view hands over teaches the other
                    low, high = (max(threshold(c, SHARE * free[view]) * BIN, np.log(SURE / (1 - SURE))) for c in counts[view])
                    rules[OTHER[view]].append(Rule(fitted[view], -low, high))
        return fitted, rules

    def fit(self, start: dict[str, np.ndarray], rules: dict[str, list[Rule]]) -> dict[str, np.ndarray]:
        """Both classifiers by Newton steps, in step; a step is one pass over all rows."""
        fitted = dict(start)
        sizes = {v: (d := self.widths[v] + 1) + d * d for v in VIEWS}
        views = self.views
        for _ in range(STEPS):
            now = dict(fitted)

            def sums(batch: pa.RecordBatch) -> np.ndarray:
                y, apart, x = views(batch)
                parts = []
                for view in VIEWS:
                    target = np.where(np.isnan(y), taught_labels(x[OTHER[view]], rules[view]), y)
                    used = ~apart & ~np.isnan(target)
                    weight = np.where(np.isnan(y[used]), TAUGHT_WEIGHT, 1.0)
                    parts.append(newton_sums(x[view][used], target[used], weight, now[view]))
                return np.concatenate(parts)

            both = summed(self.rows, sums, sum(sizes.values()))
            steps = {"text": newton_step(both[: sizes["text"]], now["text"], RIDGE), "metadata": newton_step(both[sizes["text"] :], now["metadata"], RIDGE)}
            fitted = {v: now[v] + steps[v] for v in VIEWS}
            if max(np.abs(s).max() for s in steps.values()) < 1e-6:
                break
        return fitted

    def histograms(self, fitted: dict[str, np.ndarray], rules: dict[str, list[Rule]]) -> tuple[dict, dict[str, float]]:
        """Of each view: counts of the log odds below and above 0 of the free rows, and their number.

        Free are unlabelled rows that the view has not handed over yet.
        """
        views = self.views

        def counts(batch: pa.RecordBatch) -> np.ndarray:
            y, apart, x = views(batch)
            out = []
            for view in VIEWS:
                free = np.isnan(y) & ~apart & np.isnan(taught_labels(x[view], rules[OTHER[view]]))
                odds = decision(x[view][free], fitted[view])
                out += [np.bincount(_bins(-odds[odds < 0]), minlength=N_BINS), np.bincount(_bins(odds[odds >= 0]), minlength=N_BINS)]
            return np.concatenate(out).astype(float)

        found = summed(self.rows, counts, 4 * N_BINS).reshape(2, 2, N_BINS)
        return {v: list(found[k]) for k, v in enumerate(VIEWS)}, {v: float(found[k].sum()) for k, v in enumerate(VIEWS)}


def calibrated_model(fitted: dict[str, np.ndarray], scale, text: np.ndarray, metadata: np.ndarray, y: np.ndarray) -> Model:
    """The model of both views, calibrated and combined on labelled rows kept apart (``text`` scaled already)."""
    raw = {v: decision(x, fitted[v])[:, None] for v, x in (("text", text), ("metadata", metadata))}
    cal = {v: fit_logistic(r, y, ridge=1.0) for v, r in raw.items()}
    both = fit_logistic(np.column_stack([decision(raw[v], cal[v]) for v in VIEWS]), y, ridge=1.0)
    return Model(fitted["text"], fitted["metadata"], scale, cal["text"], cal["metadata"], both)


_INPUTS = (("text", "string"), ("lang", "string"), ("source", "string"), ("n_chars", "long"))


def _inputs(docs: DataFrame) -> DataFrame:
    named = {c.lower() for c in docs.columns}
    columns = [(F.col(c) if c in named else F.lit(None)).cast(t).alias(c) for c, t in _INPUTS]
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), *columns)


def _views(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    nothing = [None] * batch.num_rows
    names = batch.schema.names
    metadata = (batch.column(c).to_pylist() if c in names else nothing for c in ("lang", "source", "n_chars"))
    return text_view(batch.column("text")), metadata_view(*metadata)


_FEATURES = "doc_id long, text array<float>, metadata array<float>"
TEXT_WIDTH, METADATA_WIDTH = N_CLASSES * 2 + 7, SOURCE_BUCKETS + 16 + 2


def features(docs: DataFrame) -> DataFrame:
    """``doc_id, text, metadata``: the features of every document, metadata as (place, place, value, value)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, metadata = _views(batch)
            places = np.column_stack([metadata[:, :SOURCE_BUCKETS].argmax(axis=1), metadata[:, SOURCE_BUCKETS:-2].argmax(axis=1), metadata[:, -2:]])
            lists = [pa.array(list(v.astype(np.float32)), pa.list_(pa.float32())) for v in (text, places)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *lists], ["doc_id", "text", "metadata"])

    return _inputs(docs).mapInArrow(run, _FEATURES)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), width).astype(float)


def _metadata_matrix(column: pa.Array) -> np.ndarray:
    places = _matrix(column, 4)
    out = np.zeros((len(places), METADATA_WIDTH))
    rows = np.arange(len(places))
    out[rows, places[:, 0].astype(int)] = 1.0
    out[rows, SOURCE_BUCKETS + places[:, 1].astype(int)] = 1.0
    out[:, -2:] = places[:, 2:]
    return out


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality") -> Model:
    """Learn from all labelled and all other documents (``labels``: ``doc_id``, ``label``).

    Labels with a null id or value are left out; of a repeated id the larger label counts. Documents with a null id are
    unlabelled ones. A fifth of the labelled rows, by their ids, is kept apart for calibration, of which at most
    ``CALIBRATION_ROWS`` are used. Without rows of both labels every document scores one half.
    """
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
        .where("doc_id IS NOT NULL AND y IN (0, 1)")
        .groupBy("doc_id").agg(F.max("y").alias("y"))
    )
    # Features are computed where texts are read; only they meet the labels.
    apart = F.col("y").isNotNull() & (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1)
    rows = materialize(features(docs).join(known, "doc_id", "left").withColumn("apart", apart), "features")
    seen = {(r["apart"], r["y"]) for r in rows.where("y IS NOT NULL").select("apart", "y").distinct().collect()}
    if len(seen) < 4:
        zero = np.zeros(2)
        return Model(np.zeros(TEXT_WIDTH + 1), np.zeros(METADATA_WIDTH + 1), (np.zeros(TEXT_WIDTH), np.ones(TEXT_WIDTH)), zero, zero, np.zeros(3))

    def moments(batch: pa.RecordBatch) -> np.ndarray:
        x = _matrix(batch.column("text"), TEXT_WIDTH)
        return np.concatenate([[len(x)], x.sum(axis=0), (x * x).sum(axis=0)])

    sums = summed(rows.select("text"), moments, 1 + 2 * TEXT_WIDTH)
    mean = sums[1 : 1 + TEXT_WIDTH] / sums[0]
    scale = (mean, np.sqrt(np.maximum(sums[1 + TEXT_WIDTH :] / sums[0] - mean**2, 0)) + 1e-6)

    def views(batch: pa.RecordBatch):
        y = batch.column("y").to_numpy(zero_copy_only=False).astype(float)
        kept = batch.column("apart").to_numpy(zero_copy_only=False).astype(bool)
        x = {"text": (_matrix(batch.column("text"), TEXT_WIDTH) - scale[0]) / scale[1], "metadata": _metadata_matrix(batch.column("metadata"))}
        return y, kept, x

    fitted, _ = CoTraining(rows.select("y", "apart", "text", "metadata"), views, {"text": TEXT_WIDTH, "metadata": METADATA_WIDTH}).run()
    chosen = rows.where("apart").orderBy(F.xxhash64("doc_id"), "doc_id").limit(CALIBRATION_ROWS).select("y", "apart", "text", "metadata").toArrow()
    y, _, x = views(chosen.combine_chunks().to_batches()[0])
    return calibrated_model(fitted, scale, x["text"], x["metadata"], y)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` (0 to 1, higher is better) of every row of ``docs`` (``doc_id, text``; ``lang, source, n_chars`` if there).

    Null, empty and blank texts are scored by their metadata and a mark for texts without words. Nulls in
    the metadata are values of their own. Repeated rows score alike; an empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.score(*_views(batch)))], ["doc_id", "score"])

    return _inputs(docs).mapInArrow(run, "doc_id long, score double")


def without_bad(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or more, in all their columns. Rows are decided where they are read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 1000):
                rows = batch.slice(a, 1000)
                yield rows.filter(pa.array(model.score(*_views(rows)) >= threshold))

    return docs.mapInArrow(run, docs.schema)
