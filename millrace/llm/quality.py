"""Quality: nearest labelled neighbours in a latent semantic space vote.

A text is a vector of hashed terms: its byte triplets and how its words repeat. Term weights come from
document counts over all texts; the latent space is a truncated singular value decomposition of a bounded
sample of labelled texts. Every text is compared with every labelled vector, exactly and in blocks; its
NEIGHBOURS closest ones vote with their similarity.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm import textblocks as tb

TERMS = 4096
# Texts whose counts of all terms are in memory at once.
BLOCK_ROWS = 128
# Rows of labelled texts that are neighbours, in the order of a hash of their id.
SAMPLE_ROWS = 3000
DIMENSIONS = 64
NEIGHBOURS = 25
SHARPNESS = 8
_SHAPES = 64  # of the terms, those that count repeated words, marks and lengths
_MUL = np.uint32(0x9E3779B1)


def term_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Counts of the terms of each text of a block."""
    texts = len(offsets) - 1
    low = tb.lowered(data)
    text = np.repeat(np.arange(texts), np.diff(offsets))
    out = np.zeros(texts * TERMS, dtype=np.int64)
    if len(data) >= 3:
        number = (low[:-2].astype(np.uint32) << 16) | (low[1:-1].astype(np.uint32) << 8) | low[2:]
        term = ((number * _MUL) >> np.uint32(16)) % np.uint32(TERMS - _SHAPES) + np.uint32(_SHAPES)
        inside = text[:-2] == text[2:]
        out += np.bincount(text[:-2][inside] * TERMS + term[inside], minlength=len(out))
    # What a word is, and what it follows: its first byte's kind, its last one's, its length, a repetition.
    begin, end, first = tb.words(low, offsets)
    if len(begin):
        owner = np.searchsorted(offsets, begin, side="right") - 1
        kind = lambda b: np.where((b >= 97) & (b <= 122) | (b >= 128), 0, np.where((b >= 48) & (b <= 57), 1, 2))
        length = np.minimum(np.log2(end - begin + 0.5).astype(np.int64).clip(0), 3)
        shape = (kind(low[begin]) * 3 + kind(low[end - 1])) * 4 + length
        out += np.bincount(owner * TERMS + shape, minlength=len(out))
        hashes = tb.word_hashes(low, begin, end)
        again = np.flatnonzero((hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])) + 1
        out += np.bincount(owner[again] * TERMS + 40 + length[again], minlength=len(out))
    return out.reshape(texts, TERMS)


def document_counts(docs: DataFrame, text_col: str = "text") -> tuple[np.ndarray, int]:
    """In how many texts each term occurs, over all of them, and the number of texts. A task sends one sum
    per term, so what is gathered has a fixed size for each task; the driver gets one number per term."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, rows = np.zeros(TERMS, dtype=np.int64), 0
        for batch in batches:
            for first, end, data, offsets in tb.blocks(batch.column(0), 1 << 18, BLOCK_ROWS):
                seen += (term_counts(data, offsets) > 0).sum(axis=0)
                rows += end - first
        yield pa.RecordBatch.from_arrays(
            [pa.array([*np.flatnonzero(seen), -1], pa.int32()), pa.array([*seen[seen > 0], rows], pa.int64())], ["term", "df"])

    parts = docs.select(F.col(text_col).alias("text")).mapInArrow(run, "term int, df bigint")
    sums = parts.groupBy("term").agg(F.sum("df").alias("df")).collect()
    out, rows = np.zeros(TERMS), 0
    for row in sums:
        if row["term"] < 0:
            rows = row["df"]
        else:
            out[row["term"]] = row["df"]
    return out, rows


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, rows: int, id_col: str = "doc_id",
                    text_col: str = "text", teach: Column | None = None) -> list[tuple[str, int]]:
    """Texts and labels of at most `rows` labelled rows that may teach, in the order of a hash of their id.

    A null label or id is no label; an id with several labels counts with the highest, one with several texts
    with the greatest. Only chosen texts reach the driver.
    """
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("y"))
    may = F.coalesce(F.crc32(F.col("id").cast("string")) % 4 != 2, F.lit(False)) if teach is None else teach
    known = known.where(F.col("y").isNotNull() & may).groupBy("id").agg(F.max("y").alias("y"))
    ids = known.withColumn("h", F.xxhash64(F.col("id").cast("string"))).orderBy("h", "id").limit(rows)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(ids), "id")
    found = texts.groupBy("id", "h", "y").agg(F.max("text").alias("text")).collect()
    return [(r["text"] or "", int(r["y"])) for r in sorted(found, key=lambda r: (r["h"], r["id"]))]


def counts_of(texts: list[str]) -> np.ndarray:
    """Counts of the terms of each text, one row each; temporaries are those of a block."""
    out = np.empty((len(texts), TERMS), dtype=np.float32)
    for first, end, data, offsets in tb.blocks(pa.array(texts, pa.large_string()), 1 << 18, BLOCK_ROWS):
        out[first:end] = term_counts(data, offsets)
    return out


def _parts(counts: np.ndarray) -> Iterator[np.ndarray]:
    """The rows in blocks, at least one."""
    for first in range(0, max(len(counts), 1), BLOCK_ROWS):
        yield counts[first : first + BLOCK_ROWS]


class TermSpace:
    """Weighted terms, projected to the latent space."""

    def __init__(self, weights: np.ndarray, basis: np.ndarray):
        self.weights, self.basis = weights.astype(np.float32), basis.astype(np.float32)

    @classmethod
    def fit(cls, counts: np.ndarray, df: np.ndarray, rows: int, dimensions: int = DIMENSIONS) -> TermSpace:
        """Terms weigh by how few documents have them; the basis spans the strongest directions of the sample,
        by subspace iteration from a fixed start. Weighted rows are made a block at a time."""
        weights = np.log((rows + 1) / (df + 1)) + 0.1
        space = cls(weights, np.zeros((TERMS, 1)))
        basis = np.random.default_rng(5).standard_normal((TERMS, min(dimensions, TERMS)))
        for _ in range(6):
            turned = np.zeros_like(basis)
            for part in _parts(counts):
                x = space.weighted(part).astype(np.float64)
                turned += x.T @ (x @ basis)
            basis, _ = np.linalg.qr(turned)
        space.basis = basis.astype(np.float32)
        return space

    def weighted(self, counts: np.ndarray) -> np.ndarray:
        x = np.log1p(counts.astype(np.float32)) * self.weights
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)

    def vectors(self, counts: np.ndarray) -> np.ndarray:
        """Latent vectors of unit length; of texts without terms, zero."""
        z = np.concatenate([self.weighted(part) @ self.basis for part in _parts(counts)])
        return z / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-9)


class QualityModel:
    """The space, and the labelled vectors in it."""

    def __init__(self, space: TermSpace, vectors: np.ndarray, labels: np.ndarray, prior: float):
        self.space, self.vectors, self.labels, self.prior = space, vectors, labels, prior

    def vote(self, counts: np.ndarray) -> np.ndarray:
        if not len(self.labels):
            return np.full(len(counts), self.prior)
        cosine = self.space.vectors(counts) @ self.vectors.T
        k = min(NEIGHBOURS, cosine.shape[1])
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(cosine, near, axis=1), 0.0).astype(np.float64) ** SHARPNESS
        # One weak vote for the share of good labels settles texts that are like nothing.
        total = weight.sum(axis=1) + 1e-3
        return np.clip(((weight * self.labels[near]).sum(axis=1) + 1e-3 * self.prior) / total, 0.0, 1.0)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", rows: int = SAMPLE_ROWS) -> QualityModel:
    """The neighbours: at most `rows` labelled texts; term weights from all texts. Rows whose crc32 of the id
    has rest 2 by 4 never teach. Without labels every text scores one half."""
    df, total = document_counts(docs, text_col)
    sample = labelled_sample(docs, labels, label_col, rows, id_col, text_col)
    y = np.array([float(label > 0) for _, label in sample])
    if not sample:
        return QualityModel(TermSpace(np.ones(TERMS), np.zeros((TERMS, 1))), np.zeros((0, 1), np.float32), y, 0.5)
    counts = counts_of([t for t, _ in sample])
    space = TermSpace.fit(counts, df, total)
    return QualityModel(space, space.vectors(counts), y, float(y.mean()))


def score(df: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every row: the weighted share of good labels among its neighbours, from 0 to 1.

    Null and empty texts have no terms and score the share of good labels. Rows that repeat an id each give a
    row. Only the two named columns are read. The model has a fixed size and goes out as a broadcast variable.
    """
    docs = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in tb.blocks(batch.column(1), 1 << 19, BLOCK_ROWS):
                scores = shared.value.vote(term_counts(data, offsets))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, end - first), pa.array(scores)], ["id", "score"])

    scored = docs.mapInArrow(run, f"id {docs.schema['id'].dataType.simpleString()}, score double")
    return scored.withColumnRenamed("id", id_col)


