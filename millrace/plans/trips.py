"""Trip files: fix types, normalise, drop incomplete rows, combine, load by name, sample."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import columns, files
from ..schemas import GREEN_NAMES, OTHER_NAMES, SAMPLE_ROWS


def normalise(df: DataFrame, colour: str) -> DataFrame:
    """Common column names; fee columns, and the trip type of green files, are dropped."""
    if colour == "green":
        df = columns.drop_if_present(columns.rename(df, GREEN_NAMES), "trip_type")
    else:
        df = columns.rename(df, OTHER_NAMES)
    return columns.drop_if_present(columns.lower_names(df), "fee")


def drop_columns(df: DataFrame, colour: str) -> DataFrame:
    return columns.drop_if_present(columns.drop_columns_with_nulls(df), "store_and_fwd_flag")


def drop_missing(df: DataFrame, colour: str) -> DataFrame:
    return columns.sort_columns(columns.drop_rows_with_nulls(df))


STEPS: dict[str, Callable[[DataFrame, str], DataFrame]] = {
    "fix_data_type": lambda df, colour: columns.cast_payment_type(df),
    "transform": normalise,
    "drop_missing": drop_missing,
    "drop_column": drop_columns,
}
DEFAULT_ORDER = ("fix_data_type", "transform", "drop_missing")


def apply_steps(df: DataFrame, colour: str, steps: tuple[str, ...] = DEFAULT_ORDER) -> DataFrame:
    for step in steps:
        if step not in STEPS:
            raise ValueError(f"unknown step {step!r}; known: {sorted(STEPS)}")
        df = STEPS[step](df, colour)
    return df


def combine(cleaned: dict[str, DataFrame]) -> DataFrame:
    """All colours by column name, labelled; a column one colour lacks is NULL."""
    result = None
    for colour, df in cleaned.items():
        df = df.withColumn("content", F.lit(colour))
        result = df if result is None else result.unionByName(df, allowMissingColumns=True)
    return result


def streaming_sample(df: DataFrame, key: list[str], n: int = SAMPLE_ROWS) -> DataFrame:
    """n rows of every file that has n complete rows, labelled by file name."""
    sampled = files.sample_per_file(columns.drop_rows_with_nulls(df), "file", n, key)
    return sampled.withColumn("content", files.content_label(F.col("file")))
