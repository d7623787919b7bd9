"""Column-level batch steps: rename, normalise, drop, reorder, cast, align."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.casts import whole_number_or_null


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Rename exact (case-sensitive) matches; names that are absent are ignored."""
    return df.toDF(*[names.get(c, c) for c in df.columns])


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def upper_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.upper().replace(" ", "_") for c in df.columns])


def drop_if_present(df: DataFrame, *names: str) -> DataFrame:
    return df.drop(*names)


def drop_rows_with_nulls(df: DataFrame) -> DataFrame:
    """Keep complete rows; NaN counts as missing."""
    return df.na.drop("any")


def _missing(field: T.StructField):
    c = F.col(f"`{field.name}`")
    return c.isNull() | F.isnan(c) if isinstance(field.dataType, (T.DoubleType, T.FloatType)) else c.isNull()


def drop_columns_with_nulls(df: DataFrame) -> DataFrame:
    """Drop every column that misses a value anywhere. One aggregate answers for all columns."""
    found = df.agg(*[F.bool_or(_missing(f)).alias(f.name) for f in df.schema.fields]).first()
    return df.drop(*[c for c in df.columns if found[c]])


def sort_columns(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in sorted(df.columns)])


def cast_payment_type(df: DataFrame) -> DataFrame:
    if "payment_type" not in df.columns:
        return df
    return df.withColumn("payment_type", whole_number_or_null("payment_type"))


def align_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of the schema, by name, cast to its types; a missing column is an error."""
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
