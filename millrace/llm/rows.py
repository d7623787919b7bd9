"""Decisions about rows, brought back to whole rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_key(id_col: str, text_col: str) -> Column:
    """What names a row, also where ids repeat or are null: its id and a digest of its text."""
    return F.concat_ws(":", F.col(id_col).cast("string"), F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256))


def only_rows(df: DataFrame, keys: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows of df whose key is among `row_key` of keys, each once, with the columns of df.

    The columns travel in one struct, so their names cannot clash with the key.
    """
    packed = df.select(row_key(id_col, text_col).alias("row_key"), F.struct(*df.columns).alias("row"))
    kept = packed.join(keys.select("row_key").distinct(), "row_key", "left_semi").dropDuplicates(["row_key"])
    return kept.select("row.*")
