"""Cleaning of the three raw event feeds, whose numbers arrive as text with '' for missing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.casts import decode_flag, floor_to, round_to, to_double, to_integer

# Output columns of the cleaned feeds.
AUTH_COLUMNS = [
    "id", "ts", "sessionId", "level", "itemInSession", "city", "zip", "state", "userAgent", "lon", "lat",
    "userId", "lastName", "firstName", "gender", "registration", "success_boolean",
]
LISTEN_COLUMNS = [
    "id", "artist", "song", "duration", "ts", "sessionid", "auth", "level", "itemInSession", "city", "zip",
    "state", "country", "userAgent", "lon", "lat", "userId", "lastName", "firstName", "gender", "registration",
]
PAGE_VIEW_COLUMNS = [
    "id", "ts", "sessionId", "page", "auth", "level", "itemInSession", "city", "zip", "state", "userAgent",
    "lon", "lat", "userId", "lastName", "firstName", "gender", "registration", "artist", "song", "duration",
]


def _project(raw: DataFrame, columns: list[str], cleaned: dict[str, Column]) -> DataFrame:
    return raw.select(*[cleaned.get(c, F.col(c)).alias(c) for c in columns])


def clean_auth(raw: DataFrame) -> DataFrame:
    return _project(raw, AUTH_COLUMNS, {
        "id": F.col("ts").cast("string"),
        "sessionId": F.col("sessionId").cast("string"),
        "lon": to_double("lon"),
        "lat": to_double("lat"),
        "userId": floor_to("userId", "int"),
        "registration": floor_to("registration", "bigint"),
        "success_boolean": decode_flag("success"),
    })


def clean_listen(raw: DataFrame) -> DataFrame:
    return _project(raw, LISTEN_COLUMNS, {
        "id": F.col("_id").cast("string"),
        "duration": to_double("duration"),
        "itemInSession": to_integer("itemInSession"),
        "lon": to_double("lon"),
        "lat": to_double("lat"),
        "userId": round_to("userId", "int"),
        "registration": round_to("registration", "bigint"),
    })


def clean_page_view(raw: DataFrame) -> DataFrame:
    return _project(raw, PAGE_VIEW_COLUMNS, {
        "id": F.col("_id").cast("string"),
        "sessionId": F.col("sessionId").cast("string"),
        "itemInSession": round_to("itemInSession", "int"),
        "lon": to_double("lon"),
        "lat": to_double("lat"),
        "userId": round_to("userId", "int"),
        "registration": round_to("registration", "bigint"),
        "duration": to_double("duration"),
    })
