"""Readers of the given tables and the raw event feeds projected from `events`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.times import to_epoch


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# The feeds are plain projections of `events`: blanks, NULLs and halves are put in by expression, and no
# join is needed. The same expressions are valid for Spark and for the checking database.
_SHARED = {
    "sessionId": "CAST(event_id % 500 AS STRING)",
    "level": "CASE WHEN event_id % 3 = 0 THEN 'paid' ELSE 'free' END",
    "city": "'city_' || CAST(user_id % 7 AS STRING)",
    "zip": "CAST(10000 + user_id % 1000 AS STRING)",
    "state": "CASE WHEN event_id % 19 = 0 THEN NULL ELSE 'state_' || CAST(user_id % 25 AS STRING) END",
    "userAgent": "'agent/' || CAST(event_id % 4 AS STRING)",
    "lon": "CASE WHEN event_id % 29 = 0 THEN '' ELSE CAST(user_id % 180 AS STRING) || '.25' END",
    "lat": "CASE WHEN event_id % 29 = 0 THEN '' ELSE CAST(user_id % 90 AS STRING) || '.75' END",
    "userId": "CASE WHEN event_id % 17 = 0 THEN '' "
              "ELSE CAST(user_id AS STRING) || CASE WHEN event_id % 5 = 0 THEN '.5' ELSE '.0' END END",
    "lastName": "'last_' || CAST(user_id % 40 AS STRING)",
    "firstName": "'first_' || CAST(user_id % 60 AS STRING)",
    "gender": "CASE WHEN user_id % 2 = 0 THEN 'F' WHEN user_id % 7 = 0 THEN NULL ELSE 'M' END",
    "registration": "CASE WHEN event_id % 23 = 0 THEN '' ELSE CAST(1600000000 + user_id AS STRING) || '.0' END",
}
_PLAYED = {
    "artist": "'artist_' || CAST(user_id % 50 AS STRING)",
    "song": "CASE WHEN event_id % 37 = 0 THEN NULL ELSE 'song_' || CAST(event_id % 200 AS STRING) END",
    "duration": "CASE WHEN event_id % 11 = 0 THEN '' ELSE CAST(value AS STRING) END",
}
FEEDS = {
    "raw_listen": {
        "_id": "CAST(event_id AS STRING)", "ts": "epoch", "auth": "'Logged In'", **_SHARED, **_PLAYED,
        "itemInSession": "CASE WHEN event_id % 31 = 0 THEN '' ELSE CAST(event_id % 20 AS STRING) END",
        "country": "CASE WHEN event_id % 13 = 0 THEN NULL ELSE 'country_' || CAST(user_id % 5 AS STRING) END",
    },
    "raw_auth": {
        "ts": "epoch", **_SHARED, "itemInSession": "CAST(event_id % 20 AS INT)",
        "success": "CASE WHEN event_type = 'signup' THEN 't' WHEN event_id % 5 = 0 THEN NULL ELSE 'f' END",
    },
    "raw_page_view": {
        "_id": "CAST(event_id AS STRING)", "ts": "epoch", "auth": "'Logged Out'", **_SHARED, **_PLAYED,
        "page": "'page_' || CAST(event_id % 9 AS STRING)",
        "itemInSession": "CASE WHEN event_id % 31 = 0 THEN '' ELSE CAST(event_id % 20 AS STRING) || '.5' END",
    },
}
FEED_TYPES = {
    "raw_listen": ["view", "click"],
    "raw_auth": ["signup", "error"],
    "raw_page_view": ["purchase"],
}


def feed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    events = table(spark, sf_dir, "events").filter(F.col("event_type").isin(FEED_TYPES[name]))
    return events.withColumn("epoch", to_epoch("ts")).selectExpr(
        *[f"{text} AS {c}" for c, text in FEEDS[name].items()])


def feed_sql(*names: str) -> str:
    """WITH clause defining the named feeds for the checking SQL."""
    parts = []
    for name in names:
        columns = ", ".join(f"{text} AS {c}" for c, text in FEEDS[name].items())
        types = ", ".join(f"'{t}'" for t in FEED_TYPES[name])
        parts.append(
            f"{name} AS (SELECT {columns} FROM"
            f" (SELECT *, CAST(floor(epoch(ts)) AS BIGINT) AS epoch FROM events) WHERE event_type IN ({types}))")
    return "WITH " + ",\n".join(parts)
