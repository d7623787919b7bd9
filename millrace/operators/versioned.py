"""Rows with a history: each carries the commit that added it and the one that removed it.

A history is a DataFrame with the columns `added_in` and `removed_in` (null while the row is in force);
commits are a DataFrame with `snapshot_id`, `committed_at` and `operation`. Both come from where the caller
keeps them. The functions only filter; a range of commit numbers reaches a scan that is partitioned by them.
"""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.times import moment

ADDED, REMOVED = "added_in", "removed_in"


def rows_at_version(rows: DataFrame, version: int) -> DataFrame:
    """Rows in force after a commit, without the history columns."""
    removed = F.col(REMOVED).isNull() | (F.col(REMOVED) > version)
    return rows.filter((F.col(ADDED) <= version) & removed).drop(ADDED, REMOVED)


def current_rows(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col(REMOVED).isNull()).drop(ADDED, REMOVED)


def version_at(commits: DataFrame, at: datetime) -> int:
    """The last commit up to a moment; a time with an offset is converted to UTC first."""
    if at.tzinfo is not None:
        at = at.astimezone(UTC).replace(tzinfo=None)
    version = commits.filter(F.col("committed_at") <= moment(at)).agg(F.max("snapshot_id")).first()[0]
    if version is None:
        raise ValueError(f"no commit at {at}")
    return version


def rows_at_time(rows: DataFrame, commits: DataFrame, at: datetime) -> DataFrame:
    return rows_at_version(rows, version_at(commits, at))


def rows_per_commit(rows: DataFrame, commits: DataFrame) -> DataFrame:
    """Each commit with the number of rows it added."""
    added = rows.groupBy(F.col(ADDED).alias("snapshot_id")).agg(F.count("*").alias("added_rows"))
    return commits.join(added, "snapshot_id", "left").withColumn("added_rows", F.coalesce("added_rows", F.lit(0)))
