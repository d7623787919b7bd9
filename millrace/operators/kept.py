"""Counts that are kept and grow by what is new, so that a mart needs no second look at old rows."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .incremental import high_water_mark, new_rows

# Largest mark that a row of the stored counts covers.
UPTO = "counted_upto"


def _stored(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame | None:
    try:
        return spark.read.schema(schema).parquet(folder)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _summed(parts: DataFrame, by: list[str], name: str) -> DataFrame:
    return parts.groupBy(*by).agg(F.sum(name).alias(name))


def add_counts(rows: DataFrame, folder: str, by: list[str], mark: str, name: str) -> DataFrame:
    """Count the rows beyond the mark of the stored counts by group, store them beside those, and return all counts.

    The mark is the largest value of the `mark` column counted so far; it is kept with the counts, which alone are read for it, and
    reaches the scan of the rows as a literal. Rows are counted up to the largest mark seen at the start, so rows
    that arrive meanwhile wait for the next run. One write adds a run's counts, so a run that fails before it can be repeated.
    A row that comes later than others of its mark is not counted, nor is one without a mark. NULL is a group like any
    other. Nothing new stores nothing; no rows at all give no counts.
    """
    spark = rows.sparkSession
    schema = T.StructType([*rows.select(*by).schema.fields, T.StructField(name, T.LongType()),
                           T.StructField(UPTO, rows.schema[mark].dataType)])
    stored = _stored(spark, folder, schema)
    fresh = new_rows(rows, stored and stored.select(F.col(UPTO).alias(mark)), mark)
    upto = high_water_mark(fresh, mark)
    if upto is not None:
        upper = F.lit(upto).cast(schema[UPTO].dataType)
        counts = fresh.filter(F.col(mark) <= upper).groupBy(*by).agg(F.count("*").alias(name))
        counts.withColumn(UPTO, upper).write.mode("append").parquet(folder)
        stored = spark.read.schema(schema).parquet(folder)
    if stored is None:
        return spark.createDataFrame([], T.StructType(schema.fields[:-1]))
    return _summed(stored, by, name)


def compact_counts(spark: SparkSession, folder: str, to: str, by: list[str], name: str) -> None:
    """The counts of all runs as those of one, in a new folder; the old one stays for its readers."""
    parts = spark.read.parquet(folder)
    # Every group gets the mark of the last run, since its own may be older.
    last = parts.agg(F.max(UPTO).alias(UPTO)).scalar()
    _summed(parts, by, name).withColumn(UPTO, last).write.mode("errorifexists").parquet(to)
