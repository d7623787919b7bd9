"""Merges into a stored table that rewrite only the key ranges they touch."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import settle
from ..sinks.files import write_split
from .upsert import merge

PART = "key_range"


def key_range(key: str, width: int) -> Column:
    """Number of the range of `width` whole keys that a key is in; NULL keys have a range of their own."""
    return F.expr(f"`{key}` div {width}L")


def store(df: DataFrame, folder: str, key: str, width: int) -> None:
    """Parquet with a sub-folder for each range of a whole-number key."""
    write_split(df.withColumn(PART, key_range(key, width)), folder, [PART])


def read_stored(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """The stored rows with their range, by which a filter selects sub-folders."""
    return spark.read.schema(T.StructType([*schema.fields, T.StructField(PART, T.LongType())])).parquet(folder)


def merge_stored(spark: SparkSession, folder: str, schema: T.StructType, source: DataFrame, keys: list[str], width: int,
                 audit: str | None = None, at: datetime | None = None, latest_by: str | None = None,
                 keep: tuple[str, ...] = ()) -> list[int | None]:
    """`upsert.merge` of a source into a table made by `store`, in place; the ranges that were rewritten.

    The first key names the range, so rows that match are in the same one. Only ranges with source rows are read, merged and
    replaced; the files of all others stay as they are. The merged rows are settled before anything is replaced. Each
    range is replaced as a whole; a merge that is broken off between ranges is finished by repeating it with the
    same `at`. The driver gets one number for each range touched. A source without rows changes nothing.
    """
    source = settle(source, "source")
    ranges = [r[0] for r in source.select(key_range(keys[0], width)).distinct().collect()]
    if not ranges:
        return []
    known = [r for r in ranges if r is not None]
    touched = F.col(PART).isin(known)
    if len(known) < len(ranges):
        touched = touched | F.col(PART).isNull()
    target = read_stored(spark, folder, schema).filter(touched).drop(PART)
    merged = settle(merge(target, source, keys, audit, at, latest_by, keep).withColumn(PART, key_range(keys[0], width)), "merged")
    writer = merged.hint("rebalance", PART).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(PART).parquet(folder)
    return sorted(ranges, key=lambda r: (r is not None, r))
