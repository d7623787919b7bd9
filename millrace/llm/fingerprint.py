"""Document fingerprints: quartile bucket digests of hashed byte triplets, and a bounded difference score.

Every run of three bytes of a text falls into one of BUCKETS buckets. The digest holds, for each bucket, the
quartile of its count among all buckets (two bits), after one byte for the length on a logarithmic scale.
Two digests differ by the steps between their quartiles, more for opposite ones, and by the steps between
their lengths. Texts that share much have close counts and so close digests; a digest has a fixed size.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import textblocks as tb

BUCKETS = 256
# Steps per doubling of the length, and the most that lengths may add to a difference.
LENGTH_STEPS, LENGTH_LIMIT = 4, 32
# Difference of quartiles 0, 1, 2 or 3 apart.
_STEP = np.array([0, 1, 2, 6])
# Digests of unrelated counts are about this far apart: the mean of _STEP over all pairs, for each bucket.
UNRELATED = BUCKETS * 15 / 8
# Texts whose counts are in memory at once.
BLOCK_ROWS = 1024
# Ranges of ids for each task, so that hashing ranges to tasks stays even.
RANGES_PER_TASK = 8

_SEED = np.random.default_rng(3).permutation(256).astype(np.uint8)


def _buckets(data: np.ndarray) -> np.ndarray:
    """Bucket of the triplet that begins at each byte."""
    one = _SEED[data]
    two = _SEED[one[:-1] ^ data[1:]]
    return _SEED[two[:-1] ^ data[2:]]


def digests(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row per text of a block: the length step, then the quartile of each bucket."""
    texts = len(offsets) - 1
    sizes = np.diff(offsets)
    out = np.zeros((texts, BUCKETS + 1), dtype=np.uint8)
    out[:, 0] = np.minimum(np.round(LENGTH_STEPS * np.log2(sizes + 1)), 255)
    if len(data) >= 3:
        bucket = _buckets(data).astype(np.int64)
        text = np.repeat(np.arange(texts), sizes)
        inside = text[:-2] == text[2:]
        counts = np.bincount(text[:-2][inside] * BUCKETS + bucket[inside], minlength=texts * BUCKETS).reshape(texts, BUCKETS)
        ordered = np.sort(counts, axis=1)
        for quarter in (1, 2, 3):
            out[:, 1:] += counts > ordered[:, quarter * BUCKETS // 4 - 1][:, None]
    return out


def as_text(digest: np.ndarray) -> list[str]:
    """Digests as hexadecimal text: length, then four buckets a byte."""
    quarters = digest[:, 1:].reshape(len(digest), -1, 4)
    packed = (quarters << np.array([6, 4, 2, 0], np.uint8)).sum(axis=2).astype(np.uint8)
    return [row.tobytes().hex() for row in np.hstack([digest[:, :1], packed])]


def likeness(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """1 for equal digests, 0 for digests as far apart as unrelated counts, or farther."""
    apart = _STEP[np.abs(one[:, 1:].astype(np.int16) - two[:, 1:])].sum(axis=1)
    apart = apart + np.minimum(np.abs(one[:, 0].astype(np.int16) - two[:, 0]), LENGTH_LIMIT)
    return np.maximum(0.0, 1.0 - apart / (UNRELATED + LENGTH_LIMIT))


def _digests_of(texts: list[str]) -> np.ndarray:
    rows = [digests(data, offsets) for *_, data, offsets in tb.blocks(pa.array(texts, pa.large_string()), rows=BLOCK_ROWS)]
    return np.concatenate(rows) if rows else np.zeros((0, BUCKETS + 1), np.uint8)


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint) of every row. Null counts as empty; equal texts have equal fingerprints; texts of
    fewer than three bytes have no triplets and differ by length alone. Rows that repeat an id each give a
    row. Only the two named columns are read."""
    docs = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in tb.blocks(batch.column(1), rows=BLOCK_ROWS):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, end - first), pa.array(as_text(digests(data, offsets)), pa.string())],
                    ["id", "fingerprint"])

    out = docs.mapInArrow(run, f"id {docs.schema['id'].dataType.simpleString()}, fingerprint string")
    return out.withColumnRenamed("id", id_col)


def with_next(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(range, id, text, copy) laid out so that in each task every row is followed by the row with the next
    id; rows with `copy` only serve as a next row.

    Ids are cut into ranges at approximate quantiles. A row shuffles once, to its range; the first row of
    each range also goes, as a copy, to the end of the range before it, and the first of all to the end of
    the last. So no task needs another's rows, and nothing but the ranges' first ids, as many as ranges,
    reaches the driver. Ids are numbers; null ids come last. Rows with equal ids are ordered by a hash of their text, and
    stay in one range.
    """
    spark = df.sparkSession
    docs = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    cuts = docs.agg(F.percentile_approx("id", [k / (tasks * RANGES_PER_TASK) for k in range(1, tasks * RANGES_PER_TASK)],
                                        100 * tasks * RANGES_PER_TASK)).first()[0]
    cuts = np.unique(np.array(cuts or [0]))

    @F.pandas_udf("int")
    def range_of(ids: pd.Series) -> pd.Series:
        place = np.searchsorted(cuts, ids.fillna(0).to_numpy(), side="right")
        return pd.Series(np.where(ids.isna(), len(cuts) + 1, place))

    keyed = docs.select(range_of("id").alias("range"), "id", F.xxhash64("text").alias("h"), "text")
    order = F.struct(F.col("id").isNull().alias("no_id"), "id", "h")
    firsts = keyed.groupBy("range").agg(F.min(order).alias("f")).select("range", "f.id", "f.h").orderBy("range").collect()
    if not firsts:
        return docs.select(F.lit(0).alias("range"), "id", "text", F.lit(False).alias("copy")).limit(0)
    before = [firsts[-1], *firsts[:-1]]
    table = [(r["range"], r["id"], r["h"], b["range"]) for r, b in zip(firsts, before, strict=True)]
    schema = f"at int, first_id {docs.schema['id'].dataType.simpleString()}, first_h bigint, also int"
    table = F.broadcast(spark.createDataFrame(table, schema))
    same = (F.col("range") == F.col("at")) & F.col("id").eqNullSafe(F.col("first_id")) & (F.col("h") == F.col("first_h"))
    own = F.struct(F.col("range"), F.lit(False).alias("copy"))
    also = F.struct(F.col("also").alias("range"), F.lit(True).alias("copy"))
    rows = keyed.join(table, same, "left").select("id", "h", "text", F.explode(
        F.when(F.col("also").isNull(), F.array(own)).otherwise(F.array(own, also))).alias("to"))
    rows = rows.select("to.range", "to.copy", F.col("id").isNull().alias("no_id"), "id", "h", "text")
    laid = rows.repartition(tasks, "range").sortWithinPartitions("range", "copy", "no_id", "id", "h")
    return laid.select("range", "id", "text", "copy")


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str], list[str]]]:
    """Ids, texts and next texts, some rows at a time, over the batches of one task."""
    ids, texts, after, size = [], [], [], 0
    last = None
    for batch in batches:
        for group, key, text, copy in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
            if last and last[0] == group:
                ids.append(last[1])
                texts.append(last[2])
                after.append(text)
                size += len(last[2]) + len(text)
            last = None if copy else (group, key, text)
            if size > tb.BLOCK_BYTES or len(ids) >= BLOCK_ROWS:
                yield ids, texts, after
                ids, texts, after, size = [], [], [], 0
    if ids:
        yield ids, texts, after


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    first = next(batches, None)
    if first is None:
        return
    id_type = first.schema.field(1).type
    for ids, texts, after in _pairs(itertools.chain([first], batches)):
        edited = [t[: len(t) - len(t) // 2] + n[: len(t) // 2] for t, n in zip(texts, after, strict=True)]
        own, other, following = _digests_of(texts), _digests_of(edited), _digests_of(after)
        yield pa.RecordBatch.from_arrays([
            pa.array(ids, id_type), pa.array([len(t) for t in texts], pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited]), pa.array(as_text(own)),
            pa.array(as_text(other)), pa.array(likeness(own, other)), pa.array(likeness(own, following))],
            ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])


def edited_likeness(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next.

    The edited text is the text with its last floor(n_chars / 2) code points replaced by as many of the first
    of the next row's text, in ascending order of id, or all it has; the last row is followed by the first.
    near_edited and near_next are the likeness of a text's fingerprint to the edited and to the next text's.
    Null counts as empty. A table of one row follows itself. Only the two named columns are read.
    """
    laid = with_next(df, id_col, text_col)
    out = laid.mapInArrow(
        _compare, f"id {laid.schema['id'].dataType.simpleString()}, n_chars bigint, edited_sha256 string, "
        "fingerprint string, edited_fingerprint string, near_edited double, near_next double")
    return out.withColumnRenamed("id", id_col)
