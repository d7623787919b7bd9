"""File sinks. Writes that split by column use a rebalance hint, so a hot value becomes several files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.times import hour_parts

HOURLY = ["year", "month", "day", "hour"]
PARTITIONS = {"hourly": HOURLY, "daily": HOURLY[:3]}


def write_stage(df: DataFrame, folder: str) -> str:
    """Next stage of a batch. The folder read is never the folder written."""
    df.write.mode("overwrite").parquet(folder)
    return folder


def write_csv(df: DataFrame, folder: str, compression: str = "none", index: str | None = None,
              rows_per_file: int = 0) -> str:
    """CSV with a header; `index` names a leading row id (increasing, not dense). 0 rows sets no limit."""
    if index:
        df = df.select(F.monotonically_increasing_id().alias(index), "*")
    writer = df.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file)
    writer.option("header", True).option("compression", compression).csv(folder)
    return folder


def _format(writer, file_format: str, folder: str) -> str:
    if file_format == "csv":
        writer = writer.option("header", True)
    writer.format(file_format).save(folder)
    return folder


def write_split(df: DataFrame, folder: str, by: list[str], file_format: str = "parquet", mode: str = "overwrite") -> str:
    """One sub-folder per combination of the `by` values."""
    return _format(df.hint("rebalance", *by).write.mode(mode).partitionBy(*by), file_format, folder)


def time_partitions(df: DataFrame, at: Column, partition: str) -> DataFrame:
    if partition not in PARTITIONS:
        raise ValueError(f"partition must be one of {sorted(PARTITIONS)}, not {partition!r}")
    parts = hour_parts(at)
    return df.withColumns({name: parts[name] for name in PARTITIONS[partition]})


def write_by_time(df: DataFrame, folder: str, at: Column, partition: str, file_format: str = "json") -> str:
    """Documents below year/month/day, and hour when hourly."""
    return write_split(time_partitions(df, at, partition), folder, PARTITIONS[partition], file_format)
