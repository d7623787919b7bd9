"""Whole texts of Arrow batches as byte blocks, and hashes of their words and shingles.

Every function works on a block: the UTF-8 bytes of some texts, one after another, and the offsets at
which texts begin and end. Blocks keep numpy temporaries small whatever the size of a batch; a text is
never split over blocks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

BLOCK_BYTES = 1 << 20
BLOCK_ROWS = 1 << 14
# Words longer than this are hashed one by one; all others together, eight bytes a step.
LONG_WORD = 256

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_KEEP = np.array([0] + [(1 << (8 * n)) - 1 for n in range(1, 9)], dtype=np.uint64)
_MUL = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_S32 = np.uint64(32)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = x ^ (x >> _S32)
    x = x * _MIX
    x ^= x >> _S32
    x *= _MIX
    x ^= x >> _S32
    return x


def blocks(texts: pa.Array | pa.ChunkedArray, limit: int = BLOCK_BYTES, rows: int = BLOCK_ROWS) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of at most `rows` consecutive texts of about `limit` bytes; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if not len(texts):
        return
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        end = max(first + 1, int(np.searchsorted(at, at[first] + limit, side="right")) - 1)
        end = min(end, first + rows)
        yield first, end, raw[at[first] : at[end]], at[first : end + 1] - at[first]
        first = end


def words(data: np.ndarray, offsets: np.ndarray, between: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of every run of bytes that are not `between` words, by default ASCII white space, and for
    each text the number of the first word; the last entry is the number of words."""
    solid = ~between[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    before = np.empty(len(data), dtype=bool)
    before[:1] = False
    before[1:] = solid[:-1]
    after = np.empty(len(data), dtype=bool)
    after[-1:] = False
    after[:-1] = solid[1:]
    begin = np.flatnonzero(solid & (~before | edge[:-1]))
    end = np.flatnonzero(solid & (~after | edge[1:])) + 1
    return begin, end, np.searchsorted(begin, offsets)


def lowered(data: np.ndarray) -> np.ndarray:
    """A to Z as a to z; all other bytes as they are."""
    return _LOWER[data]


def word_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of every word."""
    size = end - begin
    out = mix64(size.astype(np.uint64) * _MUL + np.uint64(1))
    if not len(begin):
        return out
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    loads = np.ndarray((len(padded) - 7,), dtype="<u8", buffer=padded, strides=(1,))
    rest = np.flatnonzero(size <= LONG_WORD)
    step = 0
    while len(rest):
        piece = loads[begin[rest] + 8 * step] & _KEEP[np.minimum(size[rest] - 8 * step, 8)]
        out[rest] = mix64((out[rest] ^ piece) * _MUL)
        step += 1
        rest = rest[size[rest] > 8 * step]
    for i in np.flatnonzero(size > LONG_WORD):
        digest = hashlib.blake2b(data[begin[i] : end[i]].tobytes(), digest_size=8).digest()
        out[i] = np.frombuffer(digest, dtype="<u8")[0]
    return out


def shingle_hashes(hashes: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all runs of `size` words, and the first run of each text. A text with fewer words
    has one run, all its words; a text without words has none."""
    count = np.diff(first)
    runs = np.where(count >= size, count - size + 1, np.minimum(count, 1))
    at = np.concatenate([[0], np.cumsum(runs)])
    text = np.repeat(np.arange(len(count)), runs)
    begin = np.arange(at[-1]) - at[text] + first[text]
    stop = first[1:][text]
    out = np.full(at[-1], size, dtype=np.uint64)
    padded = np.concatenate([hashes, np.zeros(size, np.uint64)])
    for k in range(size):
        inside = begin + k < stop
        out = mix64(out * _MUL + np.where(inside, padded[begin + k], np.uint64(0)) + inside.astype(np.uint64))
    return out, at


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text, over lower-cased words."""
    data = lowered(data)
    begin, end, first = words(data, offsets)
    runs, at = shingle_hashes(word_hashes(data, begin, end), first, size)
    return [np.unique(runs[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Hand texts to Python workers in batches of `rows`, unless the session already asks for fewer. Spark's own number
    is meant for rows of a few numbers; of texts it makes batches of tens of megabytes, twice for every task."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name, "10000")) <= rows:
        spark.conf.set(name, str(rows))
