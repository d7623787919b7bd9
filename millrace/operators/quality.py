"""Data checks. Each yields one row (check, failures); one table's column checks share one pass."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

NOT_NULL = "expect_column_values_to_not_be_null"


class CheckFailed(Exception):
    """Raised by a gate when a check has failing rows; `failures` has their number by check."""

    def __init__(self, failures: dict[str, int]):
        super().__init__(", ".join(f"{name}: {n}" for name, n in failures.items()))
        self.failures = failures


@dataclass(frozen=True)
class RowCheck:
    """A named test of single rows; `fails` gives the condition under which a row fails."""

    name: str
    fails: Callable[[], Column]


def not_null(column: str) -> RowCheck:
    return RowCheck(f"not_null_{column}", lambda: F.col(column).isNull())


def accepted_values(column: str, values: list) -> RowCheck:
    """NULL passes: only present values outside the list fail."""
    return RowCheck(f"accepted_values_{column}", lambda: F.col(column).isNotNull() & ~F.col(column).isin(values))


def row_checks(df: DataFrame, checks: list[RowCheck]) -> DataFrame:
    """Evaluate any number of row checks in a single aggregate."""
    counted = df.agg(*[F.count_if(c.fails()).alias(c.name) for c in checks])
    return counted.unpivot([], [c.name for c in checks], "check", "failures")


def observed(df: DataFrame, checks: list[RowCheck]) -> tuple[DataFrame, Observation]:
    """The same rows, whose first job also counts `rows` and what fails each check, so that no job of its own reads them.

    A shuffle behind it may repeat tasks and count their rows again; write the rows as they are to have exact
    numbers. A check without failures is never counted up."""
    seen = Observation()
    counts = [F.count(F.when(c.fails(), 1)).alias(c.name) for c in checks]
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *counts), seen


def unique(df: DataFrame, column: str) -> DataFrame:
    """Number of values that occur more than once; NULLs are ignored."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return counts.agg(
        F.lit(f"unique_{column}").alias("check"), F.count_if(F.col("n") > 1).alias("failures"))


def check_table(df: DataFrame, checks: list[RowCheck], unique_columns: tuple[str, ...] = ()) -> DataFrame:
    """All checks of one table: one aggregate, plus one grouping per unique column."""
    result = row_checks(df, checks) if checks else None
    for column in unique_columns:
        result = unique(df, column) if result is None else result.unionByName(unique(df, column))
    return result


def read_suite(spark: SparkSession, path: str) -> str:
    """Text of a suite file, from any file system Spark reads."""
    return spark.read.text(path, wholetext=True).first()["value"]


def load_suite(text: str) -> list[str]:
    """Columns a JSON expectation suite wants to be free of NULLs; other expectations are an error."""
    suite = json.loads(text)
    for item in suite["expectations"]:
        if item["expectation_type"] != NOT_NULL:
            raise ValueError(f"unknown expectation {item['expectation_type']}")
    return [item["kwargs"]["column"] for item in suite["expectations"]]


def run_suite(df: DataFrame, suite_text: str) -> DataFrame:
    """One row per expectation: element and unexpected counts, unexpected percent, success."""
    columns = load_suite(suite_text)
    counted = df.agg(
        F.count("*").alias("element_count"), *[F.count_if(F.col(c).isNull()).alias(f"_{c}") for c in columns])
    long = counted.unpivot(["element_count"], [f"_{c}" for c in columns], "_name", "unexpected_count")
    percent = F.when(F.col("element_count") > 0, F.col("unexpected_count") * F.lit(100.0) / F.col("element_count"))
    return long.select(
        F.lit(NOT_NULL).alias("expectation_type"),
        F.substr("_name", F.lit(2)).alias("column"),
        "element_count",
        "unexpected_count",
        F.round(F.coalesce(percent, F.lit(0.0)), 4).alias("unexpected_percent"),
        (F.col("unexpected_count") == 0).alias("success"),
    )


def gate(checks: DataFrame) -> DataFrame:
    """Raise when any check failed; the checks table has one row per check."""
    failed = checks.filter(F.col("failures") > 0).collect()
    if failed:
        raise CheckFailed({r["check"]: r["failures"] for r in failed})
    return checks
