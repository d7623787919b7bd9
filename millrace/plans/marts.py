"""Stage views and marts over the cleaned feeds. Every model is DataFrame(s) in, DataFrame out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.times import date_text, from_epoch, hour_text
from ..operators.aggregates import running_total, share_of_total, top_k


def stg_streams_hourly(listen: DataFrame) -> DataFrame:
    """Counted by the start of the hour as a number; the texts are made from the few hours left."""
    hours = listen.groupBy((F.col("ts") - F.pmod("ts", F.lit(3600))).alias("hour")).agg(
        F.count("*").alias("total_streams"))
    at = from_epoch("hour")
    return hours.select(date_text(at).alias("stream_date"), hour_text(at).alias("stream_hour"), "total_streams")


def stg_top_songs_artists(listen: DataFrame) -> DataFrame:
    plays = listen.groupBy("artist", "song").agg(F.count("*").alias("play_count"))
    return top_k(plays, "play_count")


def stg_unique_users(listen: DataFrame) -> DataFrame:
    return listen.filter(F.col("userId").isNotNull()).agg(F.count_distinct("userId").alias("total_unique_users"))


def stg_user_activity_per_country(listen: DataFrame, auth: DataFrame, page_view: DataFrame) -> DataFrame:
    """Only listen events know a country; the other feeds count as 'Unknown'."""
    known = listen.filter(F.col("country").isNotNull()).select(
        "country", F.lit("listen_event").alias("event_type"), "ts", "userId")
    branches = [known] + [
        df.select(F.lit("Unknown").alias("country"), F.lit(tag).alias("event_type"), "ts", "userId")
        for df, tag in ((auth, "auth_event"), (page_view, "page_view_event"))
    ]
    return _union(branches).groupBy("country").agg(F.count("*").alias("activity_count"))


def stg_user_activity_per_location(listen: DataFrame, auth: DataFrame, page_view: DataFrame) -> DataFrame:
    tagged = ((auth, "auth_event"), (listen, "listen_event"), (page_view, "page_view_event"))
    branches = [df.select("city", "state", F.lit(tag).alias("event_type"), "ts", "userId") for df, tag in tagged]
    return _union(branches).groupBy("state", "city").agg(F.count("*").alias("activity_count"))


def stg_user_level_by_gender(auth: DataFrame) -> DataFrame:
    known = auth.filter(F.col("gender").isNotNull() & F.col("level").isNotNull())
    return known.groupBy("gender", "level").agg(F.count_distinct("userId").alias("user_count"))


def mart_hourly_stream_evolution(hourly: DataFrame) -> DataFrame:
    totals = running_total(hourly, "total_streams", ["stream_date"], ["stream_hour"], "cumulative_streams")
    return totals.orderBy("stream_date", "stream_hour")


def mart_top_songs_artists(songs: DataFrame) -> DataFrame:
    return songs.select("artist", "song", "play_count")


def mart_total_unique_users(users: DataFrame) -> DataFrame:
    return users.select("total_unique_users")


def mart_user_activity_per_country(activity: DataFrame) -> DataFrame:
    total = activity.groupBy("country").agg(F.sum("activity_count").alias("total_activity"))
    return total.orderBy(F.desc_nulls_last("total_activity"))


def mart_user_activity_per_state(activity: DataFrame) -> DataFrame:
    total = activity.groupBy("state", "city").agg(F.sum("activity_count").alias("total_activity"))
    return total.orderBy(F.asc_nulls_last("state"), F.desc_nulls_last("total_activity"))


def mart_user_level_by_gender(levels: DataFrame) -> DataFrame:
    total = levels.groupBy("gender", "level").agg(F.sum("user_count").alias("total_users"))
    return share_of_total(total, "total_users", "percentage_of_total_users")


def _union(branches: list[DataFrame]) -> DataFrame:
    first, *rest = branches
    for df in rest:
        first = first.unionByName(df)
    return first
