"""Epoch, date and time expressions on zone-less timestamps."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def moment(at: datetime | None) -> Column:
    """A clock value as a zone-less literal, so that one run stamps one value; None means now."""
    return F.localtimestamp() if at is None else F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")


def from_epoch(seconds: str) -> Column:
    """Epoch seconds column to a zone-less timestamp; no session time zone is involved."""
    return F.expr(f"timestampadd(SECOND, {seconds}, {_EPOCH})")


def to_epoch(ts: str) -> Column:
    """Whole seconds since the epoch of a zone-less timestamp column, rounded down."""
    at = F.col(ts).cast("timestamp_ntz")
    days = F.datediff(at.cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint")
    return days * 86400 + F.hour(at) * 3600 + F.minute(at) * 60 + F.second(at)


def date_text(ts: Column) -> Column:
    return ts.cast("date").cast("string")


def hour_text(ts: Column) -> Column:
    return _two_digits(F.hour(ts))


def shifted_text(iso: Column, hours: int = 7) -> Column:
    """ISO date-time text moved by whole hours and reformatted; blank or missing gives NULL."""
    moved = F.nullif(iso, F.lit("")).cast("timestamp_ntz") + F.make_dt_interval(hours=F.lit(hours))
    return F.date_format(moved, "yyyy-MM-dd HH:mm:ss")


def compact_date(d: Column) -> Column:
    return F.date_format(d, "yyyyMMdd")


def file_date(d: Column) -> Column:
    """Date as written in daily file names: year, then day, then month."""
    return F.date_format(d, "yyyyddMM")


def hour_parts(ts: Column) -> dict[str, Column]:
    """Zero-padded year, month, day and hour used as partition values."""
    return {
        "year": F.lpad(F.year(ts).cast("string"), 4, "0"),
        "month": _two_digits(F.month(ts)),
        "day": _two_digits(F.day(ts)),
        "hour": hour_text(ts),
    }


def _two_digits(part: Column) -> Column:
    return F.lpad(part.cast("string"), 2, "0")
