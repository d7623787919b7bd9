"""Cleaned feeds and marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.times import date_text, from_epoch, hour_text
from ..operators.aggregates import distinct_counts, distinct_parts, top_k
from ..operators.cleaning import clean_auth, clean_listen, clean_page_view
from ..operators.kept import add_counts
from ..plans import marts
from ..session import new_folder, settle
from .tables import feed, feed_sql


def listen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_listen(feed(spark, sf_dir, "raw_listen"))


def auth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_auth(feed(spark, sf_dir, "raw_auth"))


def page_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_page_view(feed(spark, sf_dir, "raw_page_view"))


def _all(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return listen(spark, sf_dir), auth(spark, sf_dir), page_view(spark, sf_dir)


def _kept(rows: DataFrame, by: list[str]) -> tuple[DataFrame, DataFrame]:
    """Bitmaps of users per day and group: those stored for all days but the last, and those with the last day, of which
    alone events are read again."""
    rows = rows.withColumn("day", date_text(from_epoch("ts")))
    last = rows.agg(F.max("day")).first()[0]
    stored = settle(distinct_parts(rows.filter(F.col("day") < last), "userId", ["day", *by]), "bitmaps")
    return stored, stored.unionByName(distinct_parts(rows.filter(F.col("day") == last), "userId", ["day", *by]))


def unique_users_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listeners up to the day before the last, and with it, from bitmaps that are kept per day."""
    stored, parts = _kept(listen(spark, sf_dir), [])
    before = distinct_counts(stored, [], "users_before").scalar()
    return distinct_counts(parts, [], "total_unique_users").withColumn("users_before", before)


def user_levels_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users by gender and level, from bitmaps that are kept per day."""
    known = auth(spark, sf_dir).filter(F.col("gender").isNotNull() & F.col("level").isNotNull())
    return distinct_counts(_kept(known, ["gender", "level"])[1], ["gender", "level"], "user_count")


# 2024-01-15 00:00:00, up to which events are there at a first run.
_FIRST_RUN = 1705276800


def _counted_twice(rows: DataFrame, by: list[str], name: str) -> DataFrame:
    """Counts after a first run over the events up to then, and a second one that reads what came later."""
    folder = new_folder(rows.sparkSession, "counts")
    add_counts(rows.filter(F.col("ts") < _FIRST_RUN), folder, by, "ts", name)
    return add_counts(rows, folder, by, "ts", name)


def hourly_counts_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plays by hour, kept: the second run adds the new hours' counts to the stored ones."""
    rows = listen(spark, sf_dir).select("ts", (F.col("ts") - F.pmod("ts", F.lit(3600))).alias("hour"))
    at = from_epoch("hour")
    counts = _counted_twice(rows, ["hour"], "total_streams")
    return counts.select(date_text(at).alias("stream_date"), hour_text(at).alias("stream_hour"), "total_streams")


def song_counts_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plays by song, kept likewise; songs of both runs add up."""
    return _counted_twice(listen(spark, sf_dir), ["artist", "song"], "play_count")


QUERIES = {
    "hourly_counts_kept": hourly_counts_kept,
    "song_counts_kept": song_counts_kept,
    "unique_users_kept": unique_users_kept,
    "user_levels_kept": user_levels_kept,
    "src_listen_events": listen,
    "src_auth_events": auth,
    "src_page_view_events": page_view,
    "stg_streams_hourly": lambda s, d: marts.stg_streams_hourly(listen(s, d)),
    "stg_user_level_by_gender": lambda s, d: marts.stg_user_level_by_gender(auth(s, d)),
    "mart_hourly_stream_evolution":
        lambda s, d: marts.mart_hourly_stream_evolution(marts.stg_streams_hourly(listen(s, d))),
    "mart_top_songs_artists": lambda s, d: marts.mart_top_songs_artists(marts.stg_top_songs_artists(listen(s, d))),
    "top_k_songs":
        lambda s, d: top_k(marts.stg_top_songs_artists(listen(s, d)), "play_count", 100, ("song", "artist")),
    "mart_total_unique_users": lambda s, d: marts.mart_total_unique_users(marts.stg_unique_users(listen(s, d))),
    "mart_user_activity_per_country":
        lambda s, d: marts.mart_user_activity_per_country(marts.stg_user_activity_per_country(*_all(s, d))),
    "mart_user_activity_per_state":
        lambda s, d: marts.mart_user_activity_per_state(marts.stg_user_activity_per_location(*_all(s, d))),
    "mart_user_level_by_gender":
        lambda s, d: marts.mart_user_level_by_gender(marts.stg_user_level_by_gender(auth(s, d))),
}

_DOUBLE = "CAST(NULLIF({0}, '') AS DOUBLE) AS {0}"
_ROUND = "CAST(ROUND(CAST(NULLIF({0}, '') AS DOUBLE)) AS {1}) AS {0}"
_FLOOR = "CAST(FLOOR(CAST(NULLIF({0}, '') AS DOUBLE)) AS {1}) AS {0}"
_LON_LAT = f"{_DOUBLE.format('lon')}, {_DOUBLE.format('lat')}"
_HOURLY = """SELECT strftime(make_timestamp(ts * 1000000), '%Y-%m-%d') AS stream_date,
    strftime(make_timestamp(ts * 1000000), '%H') AS stream_hour, COUNT(*) AS total_streams
    FROM raw_listen GROUP BY 1, 2"""
_LEVELS = """SELECT gender, level, COUNT(DISTINCT CAST(FLOOR(CAST(NULLIF(userId, '') AS DOUBLE)) AS INTEGER)) AS user_count
    FROM raw_auth WHERE gender IS NOT NULL AND level IS NOT NULL GROUP BY gender, level"""
_SONGS = "SELECT artist, song, COUNT(*) AS play_count FROM raw_listen GROUP BY artist, song"
_ALL = feed_sql("raw_listen", "raw_auth", "raw_page_view")

_USER = "CAST(ROUND(CAST(NULLIF(userId, '') AS DOUBLE)) AS INTEGER)"

ORACLES = {
    "hourly_counts_kept": f"{feed_sql('raw_listen')} {_HOURLY}",
    "song_counts_kept": f"{feed_sql('raw_listen')} {_SONGS}",
    "unique_users_kept": f"""{feed_sql("raw_listen")}, days AS (
        SELECT {_USER} AS u, CAST(make_timestamp(ts * 1000000) AS DATE) AS day FROM raw_listen)
        SELECT COUNT(DISTINCT u) AS total_unique_users,
        COUNT(DISTINCT u) FILTER (day < (SELECT max(day) FROM days)) AS users_before FROM days""",
    "user_levels_kept": f"{feed_sql('raw_auth')} {_LEVELS}",
    "src_listen_events": f"""{feed_sql("raw_listen")}
        SELECT _id AS id, artist, song, {_DOUBLE.format("duration")}, ts, sessionId AS sessionid, auth, level,
        CAST(NULLIF(itemInSession, '') AS INTEGER) AS itemInSession, city, zip, state, country, userAgent, {_LON_LAT},
        {_ROUND.format("userId", "INTEGER")}, lastName, firstName, gender, {_ROUND.format("registration", "BIGINT")}
        FROM raw_listen""",
    "src_auth_events": f"""{feed_sql("raw_auth")}
        SELECT CAST(ts AS VARCHAR) AS id, ts, sessionId, level, itemInSession, city, zip, state, userAgent, {_LON_LAT},
        {_FLOOR.format("userId", "INTEGER")}, lastName, firstName, gender, {_FLOOR.format("registration", "BIGINT")},
        CASE WHEN success = 't' THEN true WHEN success = 'f' THEN false END AS success_boolean FROM raw_auth""",
    "src_page_view_events": f"""{feed_sql("raw_page_view")}
        SELECT _id AS id, ts, sessionId, page, auth, level, {_ROUND.format("itemInSession", "INTEGER")}, city, zip,
        state, userAgent, {_LON_LAT}, {_ROUND.format("userId", "INTEGER")}, lastName, firstName, gender,
        {_ROUND.format("registration", "BIGINT")}, artist, song, {_DOUBLE.format("duration")} FROM raw_page_view""",
    "stg_streams_hourly": f"{feed_sql('raw_listen')} {_HOURLY}",
    "stg_user_level_by_gender": f"{feed_sql('raw_auth')} {_LEVELS}",
    "mart_hourly_stream_evolution": f"""{feed_sql("raw_listen")}, hourly AS ({_HOURLY})
        SELECT *, CAST(SUM(total_streams) OVER (PARTITION BY stream_date ORDER BY stream_hour) AS BIGINT)
        AS cumulative_streams FROM hourly ORDER BY stream_date, stream_hour""",
    "mart_top_songs_artists": f"{feed_sql('raw_listen')} {_SONGS} ORDER BY play_count DESC",
    "top_k_songs": f"{feed_sql('raw_listen')} {_SONGS}"
                   " ORDER BY play_count DESC NULLS LAST, song ASC NULLS LAST, artist ASC NULLS LAST LIMIT 100",
    "mart_total_unique_users": f"""{feed_sql("raw_listen")}
        SELECT COUNT(DISTINCT CAST(ROUND(CAST(NULLIF(userId, '') AS DOUBLE)) AS INTEGER)) AS total_unique_users
        FROM raw_listen""",
    "mart_user_activity_per_country": f"""{_ALL}, activity AS (
        SELECT country FROM raw_listen WHERE country IS NOT NULL
        UNION ALL SELECT 'Unknown' FROM raw_auth UNION ALL SELECT 'Unknown' FROM raw_page_view)
        SELECT country, CAST(COUNT(*) AS BIGINT) AS total_activity FROM activity GROUP BY country ORDER BY 2 DESC""",
    "mart_user_activity_per_state": f"""{_ALL}, activity AS (SELECT state, city FROM raw_listen
        UNION ALL SELECT state, city FROM raw_auth UNION ALL SELECT state, city FROM raw_page_view)
        SELECT state, city, CAST(COUNT(*) AS BIGINT) AS total_activity FROM activity GROUP BY state, city
        ORDER BY state NULLS LAST, 3 DESC""",
    "mart_user_level_by_gender": f"""{feed_sql("raw_auth")}, levels AS ({_LEVELS})
        SELECT gender, level, CAST(user_count AS BIGINT) AS total_users,
        ROUND(CAST(user_count AS DOUBLE) * 100.0 / CAST((SELECT SUM(user_count) FROM levels) AS DOUBLE), 2)
        AS percentage_of_total_users FROM levels""",
}
