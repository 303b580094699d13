"""Word shingles as 64-bit hashes, computed on the bytes of Arrow string columns.

Words are runs of bytes other than space and ``\\x09-\\x0D`` after lower-casing A-Z. A text's set holds
its distinct runs of ``width`` words; a text with fewer words has its whole sequence as the only
member; a text without words, or null, has the empty set.

Words are hashed eight bytes at a time, all words of a block at once, through a mixing that is not linear; words of
more than ``LONGEST`` bytes by BLAKE2. Two different shingles of a pair of documents share a hash with probability
n*m / 2**64. Texts above ``BLOCK_BYTES`` are cut at separators, so that work space does not grow with them.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
#: Bytes of a word up to which it is hashed with the others of its block.
LONGEST = 64
#: Shingles of a long text held before they are reduced to the different ones.
HELD = 1 << 21

_U = np.uint64
_STEP = _U(0x9E3779B97F4A7C15)
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers (a bijection)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def string_parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls become empty."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(offsets: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of whole texts of about ``limit`` bytes; a longer text is a block of its own."""
    first = 0
    while first < len(offsets) - 1:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), len(offsets) - 1)
        yield first, last
        first = last


def word_spans(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Byte starts and ends of the words of a block; words never cross texts."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = ~space[data]
    first = inside.copy()
    first[1:] &= space[data[:-1]]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    first[edges] = inside[edges]
    last = inside.copy()
    last[:-1] &= space[data[1:]]
    last[edges - 1] = inside[edges - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def _hashed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of every word, in lower case."""
    return byte_hashes(_LOWER[data], starts, ends)


def byte_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of every range of bytes: its length and its bytes, eight at a time."""
    size = ends - starts
    low = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    eight = np.ndarray(len(data) + 1, dtype="<u8", buffer=low, strides=(1,))  # the eight bytes from every byte on
    out = mix((eight[starts] & _FIRST[np.minimum(size, 8)]) + mix(size.astype(np.uint64) * _STEP))
    for at in range(8, LONGEST, 8):
        rows = np.flatnonzero((size > at) & (size <= LONGEST))
        if not len(rows):
            break
        chunk = eight[starts[rows] + at] & _FIRST[np.minimum(size[rows] - at, 8)]
        out[rows] = mix((out[rows] ^ chunk) * _STEP + _U(at))
    for row in np.flatnonzero(size > LONGEST).tolist():
        out[row] = int.from_bytes(blake2b(low[starts[row] : ends[row]], digest_size=8).digest(), "little")
    return out


def word_pieces(
    data: np.ndarray, offsets: np.ndarray, space: np.ndarray = _SPACE, limit: int = BLOCK_BYTES
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(hash, start, end) of every word of a block of texts, in pieces of about ``limit`` bytes cut at separators."""
    a = 0
    while a < len(data):
        b = min(a + limit, len(data))
        if b < len(data):
            cuts = np.flatnonzero(space[data[a:b]])
            while not len(cuts) and b < len(data):  # a word longer than the limit stays whole
                cuts = np.flatnonzero(space[data[b : b + limit]]) + (b - a)
                b = min(b + limit, len(data))
            b = a + int(cuts[-1]) + 1 if len(cuts) else len(data)
        edges = offsets[(offsets > a) & (offsets < b)] - a
        starts, ends = word_spans(data[a:b], edges, space)
        yield _hashed(data[a:b], starts, ends), starts + a, ends + a
        a = b


def word_hashes(
    data: np.ndarray, offsets: np.ndarray, space: np.ndarray = _SPACE
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash of every word, first word of every text and the end, starts, ends) of a block of texts."""
    parts = list(word_pieces(data, offsets, space))
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    hashes, starts, ends = parts[0] if len(parts) == 1 else (np.concatenate(x) for x in zip(*parts))
    return hashes, np.searchsorted(starts, offsets, "left"), starts, ends


def hashes_and_bounds(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, first word of every text and the end): eight bytes a word are all that is held."""
    hashes, bounds = [np.zeros(0, np.uint64)], np.zeros(len(offsets), np.int64)
    for found, starts, _ in word_pieces(data, offsets, space):
        hashes.append(found)
        bounds += np.searchsorted(starts, offsets, "left")
    return hashes[1] if len(hashes) == 2 else np.concatenate(hashes), bounds


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` words."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, dtype=np.uint64)
    for k in range(width):
        total = total * _U(0xD6E8FEB86659FD93) + words[k : k + n]
    return mix(total + _U(width))


def _long_set(data: np.ndarray, width: int) -> np.ndarray:
    """The set of one long text: pieces in turn, the last words of each carried over to the next."""
    kept, held, carried, n = [np.zeros(0, np.uint64)], 0, np.zeros(0, np.uint64), 0
    for words, _, _ in word_pieces(data, np.array([0, len(data)])):
        n += len(words)
        carried = np.concatenate([carried, words])
        kept.append(np.unique(window_hashes(carried, width)))
        held += len(kept[-1])
        carried = carried[-(width - 1) :] if width > 1 else carried[:0]
        if held > HELD:
            kept = [np.unique(np.concatenate(kept))]
            held = 0
    if 0 < n < width:
        return window_hashes(carried, n)
    return np.unique(np.concatenate(kept))


def shingle_sets(column: pa.Array, width: int = 5) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of every text of a string column."""
    data, offsets = string_parts(column)
    empty = np.zeros(0, np.uint64)
    for first, last in blocks(offsets):
        low, high = offsets[first], offsets[last]
        if high - low > BLOCK_BYTES:
            yield first, _long_set(data[low:high], width)
            continue
        words, bounds = hashes_and_bounds(data[low:high], offsets[first : last + 1] - low)
        windows = window_hashes(words, width)
        for row in range(first, last):
            a, b = bounds[row - first], bounds[row - first + 1]
            if b - a >= width:
                yield row, np.unique(windows[a : b - width + 1])
            elif b > a:
                yield row, window_hashes(words[a:b], int(b - a))
            else:
                yield row, empty
