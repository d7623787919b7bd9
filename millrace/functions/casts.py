"""Casts whose rounding and blank handling is spelled out rather than left to an engine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(_col(c), F.lit(""))


def to_double(c: Column | str) -> Column:
    return blank_to_null(c).cast("double")


def to_integer(c: Column | str) -> Column:
    """Straight string to integer: text such as '3.0' is an error, not 3."""
    return blank_to_null(c).cast("int")


def floor_to(c: Column | str, target: str) -> Column:
    return F.floor(to_double(c)).cast(target)


def round_to(c: Column | str, target: str) -> Column:
    """Halves go away from zero: 7.5 becomes 8, -7.5 becomes -8."""
    return F.round(to_double(c)).cast(target)


def whole_number_or_null(c: Column | str) -> Column:
    """Float to bigint; NULL, NaN and out-of-range values become NULL."""
    return _col(c).try_cast("bigint")


def decode_flag(c: Column | str) -> Column:
    """'t' is true, 'f' is false, everything else (also 'true') is NULL."""
    text = _col(c).cast("string")
    return F.when(text == "t", F.lit(True)).when(text == "f", F.lit(False))


def change_default(c: Column, data_type: str) -> Column:
    """Value used when comparing for change: NULL equals '' for text and dates, 0 otherwise."""
    if data_type.startswith(("string", "varchar", "char", "timestamp", "date")):
        return F.coalesce(c.cast("string"), F.lit(""))
    if data_type == "boolean":
        return F.coalesce(c.cast("int"), F.lit(0))
    return F.coalesce(c, F.lit(0).cast(data_type))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
