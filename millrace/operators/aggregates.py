"""Aggregates and the windows over them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def running_total(df: DataFrame, value: str, partition: list[str], order: list[str], name: str) -> DataFrame:
    """Running sum over rows that are already aggregated to one row per partition and order value."""
    w = Window.partitionBy(*partition).orderBy(*order)
    return df.withColumn(name, F.sum(value).over(w))


def share_of_total(df: DataFrame, value: str, name: str, digits: int = 2) -> DataFrame:
    """Percentage of the grand total. The total is a scalar subquery, so no row moves for it."""
    total = df.agg(F.sum(value).cast("double").alias("total")).scalar()
    return df.withColumn(name, F.round(F.col(value).cast("double") * 100.0 / total, digits))


def top_k(df: DataFrame, measure: str, k: int | None = None, ties: tuple[str, ...] = ()) -> DataFrame:
    """Rows by descending measure, then the given columns, then all others, so that many rows of one measure
    still spread over the tasks of the sort; with k, the first k of them."""
    rest = [c for c in df.columns if c != measure and c not in ties]
    ordered = df.orderBy(F.desc_nulls_last(measure), *[F.asc_nulls_last(t) for t in (*ties, *rest)])
    return ordered if k is None else ordered.limit(k)


def latest_of(values):
    """Largest text of an array; no element gives NULL."""
    return F.array_max(values)


def distinct_parts(df: DataFrame, value: str, by: list[str]) -> DataFrame:
    """Which whole numbers occur in each group, as one bitmap of 32,768 bits per group and range of numbers.

    Unlike counts of distinct values, bitmaps of different rows add up: keep them per day and combine days with
    `add_parts`. Building is partial before the shuffle, so a hot group sends one bitmap per task and range. NULL is
    no value."""
    known = df.where(F.col(value).isNotNull()).withColumn("bucket", F.bitmap_bucket_number(value))
    return known.groupBy(*by, "bucket").agg(F.bitmap_construct_agg(F.bitmap_bit_position(value)).alias("bitmap"))


def add_parts(parts: DataFrame, by: list[str]) -> DataFrame:
    """Bitmaps of fewer columns, or of several tables in one, united."""
    return parts.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def distinct_counts(parts: DataFrame, by: list[str], name: str) -> DataFrame:
    """Exact number of distinct values of each group, from bitmaps. Without groups there is one row."""
    counts = add_parts(parts, by).select(*by, F.bitmap_count("bitmap").alias("n"))
    total = F.coalesce(F.sum("n"), F.lit(0)).alias(name)
    return counts.groupBy(*by).agg(total) if by else counts.agg(total)
