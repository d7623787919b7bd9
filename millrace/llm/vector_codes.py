"""Vector codes: vectors are cut into parts, and each part becomes the index of its nearest codebook entry.

Codebooks are integer means, refined for a fixed number of rounds over all vectors. The nearest entry is found
with LAESA pivots: the distances of every part to a few fixed pivots are computed once and stored. In each
round the entries' distances to the same pivots are new, and the largest difference of the two is a lower
bound of the distance between part and entry. Entries are tried in the order of that bound with exact integer
distances, and a part is done as soon as the bound exceeds the best distance found.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import lookup, settle

SCALE = 4096
PARTS, ENTRIES, ROUNDS = 8, 16, 6
PIVOTS = 4
# Integers beyond this are an error: sums of squared differences would no longer fit 64 bits.
LIMIT = 1 << 26
_ROWS = 8192


def integer_vector(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component; null for a null or empty vector and for one with a component that
    is null, not a number or infinite."""
    vector = vector.cast("array<double>")
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    scaled = F.transform(vector, lambda x: F.floor(x * scale))
    large = F.exists(vector, lambda x: F.abs(x * scale) >= float(LIMIT))
    whole = F.when(large, F.raise_error(F.lit(f"a component is not below {LIMIT // scale}")).cast("array<bigint>")).otherwise(scaled)
    return F.when((F.size(vector) > 0) & F.forall(vector, finite), whole)


def farthest_first(entries: np.ndarray, count: int) -> np.ndarray:
    """At most `count` of the entries, each the one farthest from those before it; none twice."""
    chosen = [0]
    gap = ((entries - entries[0]) ** 2).sum(axis=1)
    while len(chosen) < min(count, len(entries)) and gap.max() > 0:
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, ((entries - entries[chosen[-1]]) ** 2).sum(axis=1))
    return entries[chosen]


def pivot_distances(parts: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distance of every row to every pivot."""
    return np.sqrt(((parts[:, None, :] - pivots[None, :, :]) ** 2).sum(axis=2).astype(np.float64))


def nearest(parts: np.ndarray, to_pivots: np.ndarray, entries: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Index of the nearest entry of every part, the squared distance to it, and how many exact distances that took.

    Exact: an entry is left out only where its bound is above the best distance by more than the rounding of
    stored distances. Of equally near entries the lower index wins.
    """
    of_entries = pivot_distances(entries, pivots)
    bound = np.abs(to_pivots[:, None, :] - of_entries[None, :, :]).max(axis=2)
    # Stored as 32-bit floats: off by at most 6e-8 of themselves.
    slack = 1e-6 * (to_pivots.max(axis=1) + of_entries.max()) + 1e-6
    order = np.argsort(bound, axis=1, kind="stable")
    best = np.full(len(parts), np.iinfo(np.int64).max)
    which = np.full(len(parts), len(entries))
    live, evaluated = np.arange(len(parts)), 0
    for rank in range(len(entries)):
        entry = order[live, rank]
        open_ = bound[live, entry] <= np.sqrt(best[live].astype(np.float64)) + slack[live]
        live, entry = live[open_], entry[open_]
        if not len(live):
            break
        evaluated += len(live)
        distance = ((parts[live] - entries[entry]) ** 2).sum(axis=1)
        better = (distance < best[live]) | ((distance == best[live]) & (entry < which[live]))
        best[live[better]], which[live[better]] = distance[better], entry[better]
    return which, best, evaluated


def _matrix(column: pa.Array, dtype) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(dtype).reshape(len(column), -1)


def _assigned(batch: pa.RecordBatch, codebooks: np.ndarray, pivots: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, parts, entry and squared distance of every part) of slices of a batch with `ints` and `pivots`."""
    for first in range(0, batch.num_rows, _ROWS):
        rows = batch.slice(first, _ROWS)
        ints = _matrix(rows.column("ints"), np.int64)
        ints = ints.reshape(len(ints), len(codebooks), -1)
        stored = _matrix(rows.column("pivots"), np.float64)
        which = np.empty(ints.shape[:2], np.int64)
        error = np.empty(ints.shape[:2], np.int64)
        at = 0
        for part, entries in enumerate(codebooks):
            to_pivots = stored[:, at : at + len(pivots[part])]
            at += len(pivots[part])
            which[:, part], error[:, part], _ = nearest(ints[:, part], to_pivots, entries, pivots[part])
        yield first, ints, which, error


def _measured(vectors: DataFrame, pivots: list[np.ndarray]) -> DataFrame:
    """The vectors with the distances of their parts to the pivots, which no round changes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, _ROWS):
                rows = batch.slice(first, _ROWS)
                ints = _matrix(rows.column("ints"), np.int64)
                ints = ints.reshape(len(ints), len(pivots), -1)
                out = np.concatenate([pivot_distances(ints[:, k], p) for k, p in enumerate(pivots)], axis=1).astype(np.float32)
                ends = np.arange(len(out) + 1, dtype=np.int32) * out.shape[1]
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.ListArray.from_arrays(ends, out.ravel())], [*rows.schema.names, "pivots"])

    kind = vectors.schema.simpleString().removeprefix("struct<").removesuffix(">")
    return vectors.mapInArrow(run, f"{kind},pivots:array<float>")


def _sums(vectors: DataFrame, shared: Broadcast, pivots: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sum and number of the parts of every entry. A task gives one row for each entry; the driver gets as many."""
    parts, entries, width = shared.value.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts * entries, width), dtype=np.int64)
        count = np.zeros(parts * entries, dtype=np.int64)
        for batch in batches:
            for _, ints, which, _ in _assigned(batch, shared.value, pivots):
                cell = (which + np.arange(parts) * entries).ravel()
                flat = ints.reshape(-1, width)
                for k in range(width):  # whole numbers below 2^53, so the sums of doubles are exact
                    total[:, k] += np.bincount(cell, flat[:, k], minlength=len(count)).astype(np.int64)
                count += np.bincount(cell, minlength=len(count))
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array(count[used]), *(pa.array(total[used, k]) for k in range(width))],
            ["cell", "n", *(f"s{k}" for k in range(width))])

    columns = [f"s{k}" for k in range(width)]
    rows = vectors.mapInArrow(run, "cell int, n bigint, " + ", ".join(f"{c} bigint" for c in columns))
    rows = rows.groupBy("cell").agg(*(F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ["n", *columns])).collect()
    total, count = np.zeros((parts, entries, width), dtype=object), np.zeros((parts, entries), dtype=object)
    for row in rows:
        part, entry = divmod(row["cell"], entries)
        count[part, entry] = int(row["n"])
        total[part, entry] = [int(row[c]) for c in columns]
    return total, count


def _codebooks(vectors: DataFrame, first: np.ndarray, pivots: list[np.ndarray], rounds: int) -> np.ndarray:
    books = first
    for _ in range(rounds):
        shared = vectors.sparkSession.sparkContext.broadcast(books)
        total, count = _sums(vectors, shared, pivots)
        shared.destroy()
        books = books.copy()
        for part, entry in np.argwhere(count > 0):
            books[part, entry] = [s // count[part, entry] for s in total[part, entry]]
    return books


def codebooks_text(books: np.ndarray) -> str:
    """Components of all entries by part, entry and position."""
    return ",".join(str(int(x)) for x in books.ravel())


def compress(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """One row per kept vector: id, code, error, label_error, codebooks_sha256.

    Components become floor(scale * x). The codebook of a part position starts as that part of the first
    `entries` rows in the order of id, then vector, null ids last; with fewer rows it has fewer entries. Each round
    assigns every part of every vector to its nearest entry and replaces entries by the floor of the mean of
    their parts; an entry without parts stays. code has two hex digits a part, error is the squared distance
    over all parts, label_error its sum over rows of equal label, nulls together.

    Vectors that are null or empty or hold a null, NaN or infinite component are dropped. Rows that repeat an
    id each count and give a row; null ids stay null. A kept vector of another length than that of the
    first row, a length that is no multiple of `parts`, more than 256 entries, or a component of 16,384 and more is an error. An empty
    table gives an empty result. Only the three named columns are read. Codebooks and pivots go to the
    executors by broadcast; their size depends on the parameters and the vectors' length alone.
    """
    if entries > 256:
        raise ValueError("a code has two hex digits, so a codebook has at most 256 entries")
    kept = df.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), integer_vector(F.col(vector_col), scale).alias("ints"))
    kept = kept.where("ints IS NOT NULL").withColumn("ints", F.col("ints").cast("array<int>"))
    head = [r["ints"] for r in kept.orderBy(F.col("id").asc_nulls_last(), "ints").limit(entries).collect()]
    if not head:
        kind = f"id {kept.schema['id'].dataType.simpleString()}, code string, error bigint, label_error bigint, codebooks_sha256 string"
        return df.sparkSession.createDataFrame([], kind).withColumnRenamed("id", id_col)
    length = len(head[0])
    if length % parts:
        raise ValueError(f"vectors of length {length} have no {parts} equal parts")
    same = F.when(F.size("ints") == length, F.col("ints")).otherwise(
        F.raise_error(F.lit(f"a vector is not of length {length}")).cast("array<int>"))
    # Any other length among the first rows is found by the same test, before the codebook is made of them.
    kept = kept.withColumn("ints", same)
    first = np.array([v for v in head if len(v) == length], dtype=np.int64).reshape(-1, parts, length // parts).transpose(1, 0, 2)
    pivots = [farthest_first(book, PIVOTS) for book in first]
    vectors = settle(_measured(kept, pivots), "vectors")

    books = _codebooks(vectors, first, pivots, rounds)
    shared = df.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, _, which, error in _assigned(batch, shared.value, pivots):
                codes = [row.tobytes().hex() for row in which.astype(np.uint8)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(codes)), batch.column(1).slice(at, len(codes)), pa.array(codes),
                     pa.array(error.sum(axis=1))], ["id", "label", "code", "error"])

    kinds = [f"{c} {vectors.schema[c].dataType.simpleString()}" for c in ("id", "label")]
    coded = settle(vectors.mapInArrow(run, ", ".join([*kinds, "code string", "error bigint"])), "codes")
    coded = coded.withColumn("unlabelled", F.col("label").isNull()).withColumn("name", F.coalesce(F.col("label").cast("string"), F.lit("")))
    sums = coded.groupBy("unlabelled", "name").agg(F.sum("error").alias("label_error"))
    digest = hashlib.sha256(codebooks_text(books).encode()).hexdigest()
    return lookup(coded, sums, ["unlabelled", "name"]).select(
        F.col("id").alias(id_col), "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
