"""Token ids as Parquet list columns that can be read selectively.

Texts are dealt into ranges of doc_id and encoded in place; every range is sorted and written as one or more
files with columns ``doc_id, part, part_start, n_tokens, tokens``. Ids are dictionary-encoded (pages of a large
vocabulary fall back to delta encoding by the format's second version), row groups and pages have a given
size, and the page indexes that the writer adds let a reader fetch the pages of a few documents or the narrow
columns alone.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lorespan.llm.common import list_array
from lorespan.llm.shingles import blocks, byte_hashes, string_parts
from lorespan.session import arrow_batches, materialize, scratch_path

END_ID = 1
ROW_GROUP_BYTES, PAGE_BYTES, PAGE_ROWS = 32 << 20, 256 << 10, 2_000
#: Bytes of text in one range of documents, at most on average.
RANGE_BYTES = 64 << 20
#: Bytes of texts, or of tokens, that a task gets in one batch.
BATCH_BYTES = 4 << 20
#: Pieces, and words of other texts, whose ids a task remembers; pieces encoded in one call, and characters cut at a time.
REMEMBERED, WORDS_REMEMBERED, PIECES_AT_ONCE, CHARACTERS_AT_ONCE = 1 << 19, 1 << 16, 256, 1 << 20

_BLANK = re.compile(r"[ \t\n\r]+")
_BEYOND_LATIN = re.compile(r"[^\x00-\xff]")
#: Classes of the first 256 code points in lower case: white space, letters, digits, others.
_SPACE, _LETTER, _DIGIT, _OTHER = range(4)
_CLASS = np.full(256, _OTHER, dtype=np.uint8)
_CLASS[list(b" \t\n\x0b\f\r\x85\xa0")] = _SPACE
_CLASS[[*range(0x61, 0x7B), 0xAA, 0xB5, 0xBA, *range(0xDF, 0xF7), *range(0xF8, 0x100)]] = _LETTER
_CLASS[[*range(0x30, 0x3A), 0xB2, 0xB3, 0xB9, *range(0xBC, 0xBF)]] = _DIGIT
_FIRST_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)


def cut(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the tokenizer's pieces of lower-case text, one byte a character.

    Runs of letters, single digits, and runs of others; the endings 's 't 'm 'd 're 've 'll are pieces where the
    apostrophe begins a run.
    """
    kind = _CLASS[data]
    n = len(data)
    first = kind != _SPACE
    first[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
    marks = np.flatnonzero(first & (data == 0x27))
    padded = np.concatenate([data, np.zeros(2, np.uint8)])
    one, two = padded[marks + 1], padded[marks + 2]
    short = np.isin(one, np.frombuffer(b"stmd", np.uint8))
    long = (((one == ord("r")) | (one == ord("v"))) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
    for chosen, size in ((marks[short], 2), (marks[long & ~short], 3)):
        first[chosen + 1] = False
        rest = chosen + size
        rest = rest[rest < n]
        first[rest[kind[rest] == _LETTER]] = True
    last = kind != _SPACE
    last[:-1] &= first[1:] | (kind[1:] == _SPACE)
    return np.flatnonzero(first), np.flatnonzero(last) + 1


class Encoder:
    """Encodes texts with the tokenizers library, the ids of pieces remembered.

    This tokenizer encodes the pieces of a text one by one, so the ids of a text are those of its pieces in turn, and
    a piece that comes again need not be encoded again. Texts of the first 256 code points without marks of special tokens
    are cut as the tokenizer cuts them, many at a time in arrays: every different piece is looked up once a step by its
    hash, length and first bytes, and ids are gathered by offsets. All other texts are cut at white space only, which the
    tokenizer drops. Tests hold both against encoding the whole text. When the memory is full, the rarer half is forgotten.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[k for token, k in vocabulary.items() if token.endswith("</w>")]] = True
        self.remembered = remembered
        self.words: dict[str, np.ndarray] = {}
        # Pieces sorted by hash: length, first bytes, how often met, and where their ids are.
        self.hash = np.zeros(0, np.uint64)
        self.size, self.head, self.met = np.zeros(0, np.int32), np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.start, self.count = np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.ids = np.zeros(0, np.int32)

    def _one(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.int32)

    def _encoded(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each) of pieces that are one piece to the tokenizer, many in one call."""
        ids, counts = [], []
        for a in range(0, len(pieces), PIECES_AT_ONCE):
            part = pieces[a : a + PIECES_AT_ONCE]
            found = self._one(" ".join(part))
            ends = np.flatnonzero(self.ends[found]) + 1
            if len(ends) == len(part):
                ids.append(found)
                counts += np.diff(ends, prepend=0).tolist()
            else:
                single = [self._one(p) for p in part]
                ids += single
                counts += [len(x) for x in single]
        return np.concatenate(ids) if ids else np.zeros(0, np.int32), np.array(counts, dtype=np.int64)

    def _known(self, hashes: np.ndarray, sizes: np.ndarray, heads: np.ndarray, texts) -> np.ndarray:
        """Places of distinct pieces in the memory; those not there are encoded (``texts`` of places) and taken in."""
        place = np.searchsorted(self.hash, hashes)
        near = np.minimum(place, max(len(self.hash) - 1, 0))
        there = (self.hash[near] == hashes) & (self.size[near] == sizes) & (self.head[near] == heads) if len(self.hash) else np.zeros(len(hashes), bool)
        new = np.flatnonzero(~there)
        if not len(new):
            return near
        ids, counts = self._encoded(texts(new))
        self._forget(len(new))
        starts = len(self.ids) + np.cumsum(counts) - counts
        self.ids = np.concatenate([self.ids, ids])
        added = {"size": sizes[new], "head": heads[new], "met": 0, "start": starts, "count": counts, "hash": hashes[new]}
        # Both are sorted, so places are known; one column after the other, as copies of all at once would be much memory.
        at = np.searchsorted(self.hash, added["hash"], "right") + np.arange(len(new))
        before = np.ones(len(self.hash) + len(new), dtype=bool)
        before[at] = False
        for name, values in added.items():
            merged = np.empty(len(before), getattr(self, name).dtype)
            merged[before], merged[at] = getattr(self, name), values
            setattr(self, name, merged)
        return self._known(hashes, sizes, heads, texts)

    def _forget(self, coming: int) -> None:
        """Keep the half of the pieces met most often when the memory would overflow; ids are packed anew."""
        if len(self.hash) + coming <= max(self.remembered, 2 * coming):
            return
        kept = np.sort(np.argsort(-self.met, kind="stable")[: len(self.hash) // 2])
        self.ids = self._gathered(kept)
        for name in ("hash", "size", "head", "count"):
            setattr(self, name, getattr(self, name)[kept])
        self.met = self.met[kept] // 2
        self.start = np.cumsum(self.count) - self.count

    def _gathered(self, places: np.ndarray) -> np.ndarray:
        counts = self.count[places]
        before = np.cumsum(counts) - counts
        return self.ids[np.repeat(self.start[places] - before, counts) + np.arange(int(counts.sum()))]

    def _latin(self, text: str, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids up to every edge) of lower-case text of the first 256 code points."""
        data = np.frombuffer(text.encode("latin-1"), dtype=np.uint8)
        starts, ends = cut(data)
        if not len(starts):
            return np.zeros(0, np.int32), np.zeros(len(edges), np.int64)
        sizes = ends - starts
        hashes, heads = piece_hashes(data, starts, ends)
        distinct, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        same = (sizes[first][inverse] == sizes) & (heads[first][inverse] == heads)
        if not same.all():  # two pieces of one hash: one by one
            parts = [self._one(data[a:b].tobytes().decode("latin-1")) for a, b in zip(starts, ends)]
            counts = np.array([len(p) for p in parts])
            ids = np.concatenate(parts)
        else:
            place = self._known(distinct, sizes[first], heads[first], lambda new: [data[starts[k] : ends[k]].tobytes().decode("latin-1") for k in first[new]])
            self.met[place] += np.bincount(inverse, minlength=len(place))
            at = place[inverse]
            counts, ids = self.count[at], self._gathered(at)
        upto = np.concatenate([[0], np.cumsum(counts)])
        return ids, upto[np.searchsorted(starts, edges, "left")]

    def _long(self, text: str) -> np.ndarray:
        """Ids of one lower-case text of the first 256 code points, in parts cut at blanks."""
        parts, a = [], 0
        while a < len(text):
            b = min(a + CHARACTERS_AT_ONCE, len(text))
            if b < len(text):
                blank = max(text.rfind(" ", a, b), text.rfind("\n", a, b))
                b = blank if blank > a else min((x for x in (text.find(" ", b), text.find("\n", b)) if x >= 0), default=len(text))
            parts.append(self._latin(text[a:b], np.zeros(0, np.int64))[0])
            a = b
        return np.concatenate(parts) if parts else np.zeros(0, np.int32)

    def _other(self, text: str) -> np.ndarray:
        """Ids of any text, word by word."""
        words = _BLANK.split(text)
        if len(self.words) > min(self.remembered, WORDS_REMEMBERED):
            self.words.clear()
        for word in words:
            if word not in self.words:
                self.words[word] = self._one(word)
        return np.concatenate([self.words[w] for w in words])

    def ids_of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, each followed by the end id; number of ids of each, that one included)."""
        out: list[np.ndarray] = [np.zeros(0, np.int32)] * len(texts)
        group: list[int] = []
        lowered: dict[int, str] = {}
        held = 0

        def flush() -> None:
            nonlocal held
            whole = "\n".join(lowered[k] for k in group)
            edges = np.cumsum([0] + [len(lowered[k]) + 1 for k in group])
            ids, upto = self._latin(whole, edges)
            for k, a, b in zip(group, upto[:-1], upto[1:]):
                out[k] = ids[a:b]
            group.clear()
            lowered.clear()
            held = 0

        for k, text in enumerate(texts):
            if "<|" in text or _BEYOND_LATIN.search(text) is not None:
                out[k] = self._other(text)
            elif len(text) > CHARACTERS_AT_ONCE:
                out[k] = self._long(text.lower())
            else:
                group.append(k)
                lowered[k] = text.lower()
                held += len(text)
                if held > CHARACTERS_AT_ONCE:
                    flush()
        if group:
            flush()
        end = np.array([END_ID], dtype=np.int32)
        sizes = np.array([len(x) + 1 for x in out], dtype=np.int64)
        return np.concatenate([x for own in out for x in (own, end)]) if out else np.zeros(0, np.int32), sizes


def piece_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash, first eight bytes as a number) of every piece."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(data) + 1, dtype="<u8", buffer=padded, strides=(1,))
    heads = eight[starts] & _FIRST_BYTES[np.minimum(ends - starts, 8)]
    return byte_hashes(data, starts, ends), heads


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def write_tokens(docs: DataFrame, path: str, tokenizer: str | None = None, ranges: int | None = None) -> None:
    """Encode every whole text of ``docs`` (``doc_id long, text``) and write the token table to ``path``.

    Null texts count as empty: they hold the end id alone. Rows with a null doc_id come first; rows that repeat a
    doc_id are in the order of their texts' hashes. An empty table gives an empty token table. Other columns are ignored.
    """
    tokenizer = tokenizer or default_tokenizer()
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    if ranges is None:
        size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        ranges = max(1, -(-size // RANGE_BYTES), docs.sparkSession.sparkContext.defaultParallelism)
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    dealt = docs.repartitionByRange(ranges, *order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, part, start = Encoder(tokenizer), TaskContext.get().partitionId(), 0
        for batch in batches:
            for first, last in blocks(string_parts(batch.column("text"))[1], CHARACTERS_AT_ONCE):
                rows = batch.slice(first, last - first)
                ids, sizes = encoder.ids_of(rows.column("text").to_pylist())
                starts = start + np.cumsum(sizes) - sizes
                start += int(sizes.sum())
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("doc_id"),
                        pa.array(np.full(len(sizes), part, np.int32)),
                        pa.array(starts),
                        pa.array(sizes.astype(np.int32)),
                        list_array(ids, sizes, pa.int32()),
                    ],
                    ["doc_id", "part", "part_start", "n_tokens", "tokens"],
                )

    schema = "doc_id long, part int, part_start long, n_tokens int, tokens array<int>"
    writer = (
        dealt.mapInArrow(run, schema)
        .write.option("parquet.writer.version", "PARQUET_2_0")
        .option("parquet.enable.dictionary", "true")
        .option("parquet.block.size", str(ROW_GROUP_BYTES))
        .option("parquet.page.size", str(PAGE_BYTES))
        .option("parquet.page.row.count.limit", str(PAGE_ROWS))
        .option("compression", "zstd")
    )
    with arrow_batches(docs.sparkSession, BATCH_BYTES):
        writer.parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The token table with ``start``: ids of all documents before, in ascending doc_id order.

    Starts come from the narrow columns: one row a part is summed up, no token is read for it.
    """
    stored = spark.read.parquet(path)
    sizes = stored.groupBy("part").agg(F.sum("n_tokens").alias("size"))
    # One row of two numbers for every part, that is for every RANGE_BYTES of text: 16 bytes for 64 MB. So it is
    # broadcast, and no token is moved for it.
    before = F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    bases = sizes.select("part", F.coalesce(before, F.lit(0)).alias("base"))
    return stored.join(F.broadcast(bases), "part").select("doc_id", (F.col("base") + F.col("part_start")).alias("start"), "n_tokens", "tokens")


def read_documents(spark: SparkSession, path: str, first: int, last: int) -> DataFrame:
    """Tokens of the documents with ids from ``first`` to ``last``: the filter reaches row groups and pages."""
    return spark.read.parquet(path).where(F.col("doc_id").between(first, last)).select("doc_id", "tokens")


def digests(tokens: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of a token table as read back; the size is that of the list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("tokens")
            ends, values = lists.offsets.to_numpy(), lists.values.to_numpy().astype("<i4", copy=False)
            sums = [crc32(values[a:b]) for a, b in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("start"), pa.array(np.diff(ends).astype(np.int64)), pa.array(sums, pa.int64())],
                ["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    return tokens.select("doc_id", "start", "tokens").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Write the documents as a token table in the scratch folder and return ``digests`` of what is read back."""
    spark = docs.sparkSession
    path = scratch_path(spark, "tokens")
    write_tokens(docs, path, tokenizer)
    with arrow_batches(spark, BATCH_BYTES):
        return materialize(digests(read_tokens(spark, path)), "token-digests")
