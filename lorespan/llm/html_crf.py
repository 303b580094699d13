"""Main text of web pages by a linear-chain conditional random field over the leaf blocks of the page.

Every block is content or not. A block is described by the elements around it (tags, words of class, id and
role) and by its text; neighbouring labels depend on each other. The weights are trained on labelled pages by
maximum likelihood (forward-backward), a page is decoded by Viterbi.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lorespan.llm.dom import Block, leaf_blocks
from lorespan.llm.labelled_pages import labelled_pages

#: Labelled pages the field is trained on, and gradient steps.
TRAIN_PAGES, STEPS = 240, 150


def around(names: tuple[str, ...]) -> list[str]:
    """Features of the elements around a block."""
    known = {n for n in names if n not in ("html", "body", "b", "i", "em", "strong", "span", "u", "font")}
    return [f"in:{n}" for n in sorted(known)]


def of_text(block: Block) -> list[str]:
    """Features of a block's text and its own tag."""
    text = block.text
    n = len(text)
    out = [f"tag:{block.tag}", f"length:{min(max(n.bit_length(), 4), 10)}"]
    if block.link_chars * 2 > n:
        out.append("linked")
    if text[-1] in ".!?:;\"'”»…":
        out.append("sentence")
    if "©" in text or "·" in text or "|" in text:
        out.append("mark")
    if n < 400 and sum(w[:1].isupper() for w in text.split()) * 2 > text.count(" ") + 1:
        out.append("title")
    return out


@dataclass
class Field:
    """Weights: of features for content over other, of the first and last label, of label pairs."""

    weights: dict[str, float]
    ends: tuple[float, float]
    pairs: tuple[tuple[float, float], tuple[float, float]]

    def decode(self, blocks: list[Block], cache: dict[tuple[str, ...], float] | None = None) -> list[bool]:
        """The most likely labels; ties go to content."""
        cache = {} if cache is None else cache
        w = self.weights.get
        zero, one, back = 0.0, 0.0, []
        for k, block in enumerate(blocks):
            outer = cache.get(block.names)
            if outer is None:
                outer = sum(w(f, 0.0) for f in around(block.names))
                if len(cache) < 100_000:
                    cache[block.names] = outer
            emit = outer
            for f in of_text(block):
                emit += w(f, 0.0)
            if not k:
                zero, one = 0.0, emit + self.ends[0]
                continue
            (p00, p01), (p10, p11) = self.pairs
            from_zero = (zero + p00 > one + p10, zero + p01 > one + p11)
            back.append(from_zero)
            zero, one = max(zero + p00, one + p10), max(zero + p01, one + p11) + emit
        if not blocks:
            return []
        label = one + self.ends[1] >= zero
        labels = [label]
        for from_zero in reversed(back):
            label = not from_zero[int(label)]
            labels.append(label)
        return labels[::-1]


def train(pages: list[tuple[list[Block], list[bool]]], steps: int = STEPS, ridge: float = 0.05) -> Field:
    """Maximum likelihood with a ridge penalty, by Adam on all pages at once."""
    pages = [p for p in pages if p[0]]
    index: dict[str, int] = {}
    rows, columns, spots = [], [], {}
    longest = max(len(b) for b, _ in pages)
    gold = np.full((longest, len(pages)), -1)
    for p, (blocks, labels) in enumerate(pages):
        for t, (block, label) in enumerate(zip(blocks, labels)):
            gold[t, p] = int(label)
            for f in around(block.names) + of_text(block):
                rows.append(t * len(pages) + p)
                columns.append(index.setdefault(f, len(index)))
    rows, columns = np.array(rows), np.array(columns)
    n, size = len(index), longest * len(pages)
    inside = gold >= 0
    last = inside.sum(axis=0) - 1
    theta = np.zeros(n + 6)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    every = np.arange(len(pages))
    for step in range(1, steps + 1):
        emit = np.bincount(rows, weights=theta[columns], minlength=size).reshape(longest, len(pages))
        start, stop, pairs = theta[n], theta[n + 1], theta[n + 2 :].reshape(2, 2)
        score = np.zeros((longest, len(pages), 2))
        score[:, :, 1] = emit
        score[0, :, 1] += start
        score[last, every, 1] += stop
        forward, backward = np.zeros_like(score), np.zeros_like(score)
        forward[0] = score[0]
        for t in range(1, longest):
            into = forward[t - 1][:, :, None] + pairs
            forward[t] = np.where(inside[t][:, None], np.logaddexp(into[:, 0], into[:, 1]) + score[t], forward[t - 1])
        total = np.logaddexp(forward[-1][:, 0], forward[-1][:, 1])
        expected = np.zeros((2, 2))
        observed = np.zeros((2, 2))
        for t in range(longest - 2, -1, -1):
            ahead = pairs[None] + (score[t + 1] + backward[t + 1])[:, None, :]
            both = inside[t + 1][:, None]
            backward[t] = np.where(both, np.logaddexp(ahead[:, :, 0], ahead[:, :, 1]), 0.0)
            joint = np.exp(forward[t][:, :, None] + ahead - total[:, None, None])
            expected += joint[inside[t + 1]].sum(axis=0)
            for a in (0, 1):
                for b in (0, 1):
                    observed[a, b] += ((gold[t] == a) & (gold[t + 1] == b)).sum()
        p_one = np.where(inside, np.exp(forward[:, :, 1] + backward[:, :, 1] - total), 0.0)
        gap = np.where(inside, (gold == 1) - p_one, 0.0)
        slope = np.zeros_like(theta)
        slope[:n] = np.bincount(columns, weights=gap.reshape(-1)[rows], minlength=n)
        slope[n] = gap[0].sum()
        slope[n + 1] = gap[last, every].sum()
        slope[n + 2 :] = (observed - expected).reshape(-1)
        slope -= ridge * theta
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        theta += 0.15 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    (a, b), (c, d) = theta[n + 2 :].reshape(2, 2).tolist()
    return Field({f: float(theta[k]) for f, k in index.items()}, (float(theta[n]), float(theta[n + 1])), ((a, b), (c, d)))


def default_field(pages: int = TRAIN_PAGES) -> Field:
    """A field trained on the labelled pages of this package."""
    return train(list(labelled_pages(pages)))


def main_text(html: str | None, field: Field, cache: dict | None = None) -> str:
    """Content blocks of a page in page order, joined by two line ends; empty for null and for pages without any."""
    blocks = list(leaf_blocks(html or ""))
    return "\n\n".join(b.text for b, keep in zip(blocks, field.decode(blocks, cache)) if keep)


def extract(pages: DataFrame, field: Field | None = None) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row of ``pages`` (``page_id long, url, html``).

    Null and empty pages, and pages without content, have an empty text. Repeated rows give repeated results;
    other columns are ignored; an empty table gives an empty result.
    """
    field = field or default_field()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict = {}
        for batch in batches:
            for a in range(0, batch.num_rows, 200):
                rows = batch.slice(a, 200)
                texts = [main_text(html, field, cache) for html in rows.column("html").to_pylist()]
                sizes = pa.array([len(t) for t in texts], pa.int64())
                yield pa.RecordBatch.from_arrays([rows.column("page_id"), rows.column("url"), pa.array(texts, pa.string()), sizes], ["page_id", "url", "text", "n_chars"])

    columns = (("page_id", "long"), ("url", "string"), ("html", "string"))
    return pages.select(*(F.col(c).cast(t).alias(c) for c, t in columns)).mapInArrow(run, "page_id long, url string, text string, n_chars long")
