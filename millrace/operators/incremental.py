"""Incremental loads by high-water mark, and the run log that remembers the last good run."""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType, TimestampNTZType

from ..functions.times import moment
from .upsert import merge


def high_water_mark(target: DataFrame, column: str):
    """Largest value of the column in the target: one value, read by the driver; None when empty."""
    return target.agg(F.max(column).alias("mark")).first()["mark"]


def new_rows(source: DataFrame, target: DataFrame | None, column: str, late: str = "drop") -> DataFrame:
    """Source rows beyond the target's high-water mark.

    No target, or one without rows, means a full load. `late="drop"` keeps rows strictly after the
    mark; `late="include_ties"` also keeps rows equal to it. The mark enters the plan as a literal, so
    the filter reaches the scan.
    """
    if late not in ("drop", "include_ties"):
        raise ValueError(f"late must be 'drop' or 'include_ties', not {late!r}")
    mark = None if target is None else high_water_mark(target, column)
    if mark is None:
        return source
    # A zone-less time stays zone-less; as a plain literal it would pass through the session time zone.
    zoneless = isinstance(source.schema[column].dataType, TimestampNTZType)
    limit = moment(mark) if zoneless else F.lit(mark)
    return source.filter(F.col(column) > limit if late == "drop" else F.col(column) >= limit)


def load_increment(
    source: DataFrame, target: DataFrame | None, column: str, keys: list[str] | None = None, late: str = "drop",
) -> DataFrame:
    """Target after an incremental load: new rows appended or, when keys are given, merged."""
    fresh = new_rows(source, target, column, late)
    if target is None:
        return fresh
    return merge(target, fresh, keys) if keys else target.unionByName(fresh)


# Run states of the control table.
RUNNING, DONE = -1, 1


# The control table of package runs.
RUN_LOG = StructType([
    StructField("PKG_NAME", StringType()), StructField("STATUS", IntegerType()),
    StructField("START_DT", TimestampNTZType()), StructField("END_DT", TimestampNTZType()),
    StructField("LAST_RUN_DT", TimestampNTZType()),
])


def _for_package(log: DataFrame, package: str | None):
    return F.lit(True) if package is None else F.col("PKG_NAME") == package


def begin_run(log: DataFrame, at: datetime, package: str | None = None) -> DataFrame:
    """Mark a package (or all of them) as running since `at`."""
    mine = _for_package(log, package)
    return log.withColumns({
        "START_DT": F.when(mine, moment(at)).otherwise(F.col("START_DT")),
        "STATUS": F.when(mine, F.lit(RUNNING)).otherwise(F.col("STATUS")),
    })


def finish_run(log: DataFrame, at: datetime, package: str | None = None) -> DataFrame:
    """Mark unfinished runs as done; the start of the run becomes the last run date."""
    mine = _for_package(log, package) & (F.col("STATUS") != DONE)
    return log.withColumns({
        "STATUS": F.when(mine, F.lit(DONE)).otherwise(F.col("STATUS")),
        "LAST_RUN_DT": F.when(mine, F.col("START_DT")).otherwise(F.col("LAST_RUN_DT")),
        "END_DT": F.when(mine, moment(at)).otherwise(F.col("END_DT")),
    })


def last_run(log: DataFrame, package: str) -> DataFrame:
    return log.filter(F.col("PKG_NAME") == package).select("LAST_RUN_DT")


class RunLog:
    """The control table, kept as a folder to which each change of a package appends its row with the time of
    the change. The last row of a package counts, so a run that fails half-way keeps its last run date."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def current(self) -> DataFrame:
        kept = StructType([*RUN_LOG.fields, StructField("CHANGED_DT", TimestampNTZType())])
        try:
            rows = self.spark.read.schema(kept).parquet(self.folder)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], RUN_LOG)
        # A run that ends in the moment it began is done.
        last = F.max(F.struct("CHANGED_DT", "STATUS", F.struct(*RUN_LOG.names).alias("row")))["row"]
        return rows.groupBy("PKG_NAME").agg(last.alias("row")).select("row.*")

    def _append(self, rows: DataFrame, at: datetime) -> None:
        rows.withColumn("CHANGED_DT", moment(at)).coalesce(1).write.mode("append").parquet(self.folder)

    def add(self, packages: DataFrame, at: datetime) -> None:
        """Register packages: rows of the control table."""
        self._append(packages.select(*[F.col(f.name).cast(f.dataType) for f in RUN_LOG.fields]), at)

    def begin(self, package: str, at: datetime) -> None:
        self._append(begin_run(self.current(), at, package).filter(F.col("PKG_NAME") == package), at)

    def finish(self, package: str, at: datetime) -> None:
        self._append(finish_run(self.current(), at, package).filter(F.col("PKG_NAME") == package), at)

    def last_run(self, package: str) -> datetime | None:
        row = last_run(self.current(), package).first()
        return row and row["LAST_RUN_DT"]
