"""Streams over `events`, read by the file source until nothing is left."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.times import date_text, from_epoch, hour_text, to_epoch
from ..session import new_folder
from ..streaming import landing, records
from ..streaming.sources import MAX_AGE_SECONDS, read_arrivals

_EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
_RECORD = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("page", T.StringType()),
    T.StructField("at", T.TimestampNTZType()), T.StructField("item-list", T.StringType()),
])


# Files per micro-batch: bounds what one batch shuffles, however long the backlog.
_FILES = 1000
# Records per micro-batch of the bounded stream.
_BATCH_RECORDS = 2500
# Queries that work through the bounded batches side by side.
_LANES = 8


def _events(spark, sf_dir, files_per_batch: int | None = _FILES):
    return read_arrivals(spark, f"{sf_dir}/events*.parquet", _EVENTS, "parquet", files_per_batch)


def _messages(spark, sf_dir):
    """Topic records: signups arrive wrapped, errors have lost their id, the others are bare objects. A record
    arrives as many seconds after its event as its value says."""
    body = F.struct(
        F.when(F.col("event_type") != "error", F.col("event_id")).alias("id"), F.col("event_type").alias("page"),
        F.col("ts").alias("at"), F.col("props").alias("item-list"))
    wrapped = F.to_json(F.struct(F.lit("v1").alias("schema"), body.alias("payload")))
    value = F.when(F.col("event_type") == "signup", wrapped).otherwise(F.to_json(body))
    received = "timestampadd(SECOND, CAST(floor(value) AS INT), date_trunc('SECOND', ts))"
    return _events(spark, sf_dir).select(
        value.alias("value"), F.expr(received).cast("timestamp_ntz").alias("received"))


def _landed(spark, sf_dir):
    """Good records and dead letters below the hour of arrival: five o'clock on the day after they were received."""
    folder = new_folder(spark, "landing")
    decoded = records.decode(_messages(spark, sf_dir), _RECORD)
    record = F.col("record")
    result = records.outcome(record["id"], F.date_trunc("SECOND", record["at"]), F.col("received"), MAX_AGE_SECONDS)
    arrival = F.date_trunc("DAY", "received") + F.make_dt_interval(days=F.lit(1), hours=F.lit(5))
    query = landing.land_by_hour(
        decoded, f"{folder}/data", f"{folder}/state", arrival, result, files_per_hour=2)
    query.awaitTermination()
    return spark.read.parquet(f"{folder}/data")


def stream_landing(spark, sf_dir):
    good = _landed(spark, sf_dir).filter(F.col("result") == records.OK)
    return good.select(
        F.col("record.id").alias("id"), F.col("record.page").alias("page"),
        F.col("record")["item-list"].alias("items"), *[F.col(p).cast("int").alias(p) for p in landing.HOURLY])


def stream_dead_letter(spark, sf_dir):
    bad = _landed(spark, sf_dir).filter(F.col("result") != records.OK)
    return bad.groupBy("result", "record.page").agg(F.count("*").alias("records"))


def _scattered(spark, sf_dir, folder):
    """The events as files that are not in time order, one micro-batch each."""
    events = spark.read.schema(_EVENTS).parquet(f"{sf_dir}/events.parquet")
    events.repartition(8, F.pmod("event_id", F.lit(8))).write.parquet(f"{folder}/in")
    return read_arrivals(spark, f"{folder}/in", _EVENTS, "parquet", 1)


def stream_hourly(spark, sf_dir):
    """Hourly counts of plays; the last hours stay open until later events close them."""
    folder = new_folder(spark, "hourly")
    plays = _scattered(spark, sf_dir, folder).filter(F.col("event_type").isin("view", "click"))
    landing.write_batches(plays, f"{folder}/state", landing.hourly_partials("ts", f"{folder}/data")).awaitTermination()
    return landing.hourly_counts(spark, f"{folder}/data", time_type="timestamp_ntz").select(
        F.date_format("hour", "yyyy-MM-dd").alias("stream_date"), F.date_format("hour", "HH").alias("stream_hour"),
        "total_streams")


def stream_hourly_windows(spark, sf_dir):
    """Hourly counts kept as state: three deliveries, each in time order by itself. The last one comes when the first
    has closed all but its latest hours, so its rows of those hours are late and dropped."""
    folder = new_folder(spark, "windows")
    plays = spark.read.schema(_EVENTS).parquet(f"{sf_dir}/events.parquet").filter(F.col("event_type").isin("view", "click"))
    plays = plays.select("event_id", F.timestamp_seconds(to_epoch("ts")).alias("at"))
    query = None
    for k, part in enumerate(("event_id % 10 < 8", "event_id % 10 = 8", "event_id % 10 = 9")):
        plays.filter(part).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        query = landing.land_windows(landing.windowed_counts(
            read_arrivals(spark, f"{folder}/in", "event_id bigint, at timestamp", "parquet", 1), "at"), f"{folder}/data", f"{folder}/state")
        query.awaitTermination()
    hour = from_epoch("unix_timestamp(window_start)")
    found = spark.read.schema("window_start timestamp, total_streams bigint").parquet(f"{folder}/data")
    return found.select(date_text(hour).alias("stream_date"), hour_text(hour).alias("stream_hour"), "total_streams")


def stream_batch_failures(spark, sf_dir):
    """Four deliveries, a batch each; an error of an odd event is a bad record and fails its whole batch."""
    folder = new_folder(spark, "batches")
    events = spark.read.schema(_EVENTS).parquet(f"{sf_dir}/events.parquet").select("event_id", "event_type")
    for k in range(4):
        events.filter(F.col("event_id") % 4 == k).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    schema = "event_id bigint, event_type string"
    stream = read_arrivals(spark, f"{folder}/in", schema, "parquet", 1)
    bad = (F.col("event_type") == "error") & (F.col("event_id") % 2 == 1)
    write = landing.all_or_nothing(landing.to_folder(f"{folder}/out/result=ok"), landing.to_folder(f"{folder}/out/result=failed"), bad)
    landing.write_batches(stream, f"{folder}/state", write).awaitTermination()
    found = spark.read.schema(f"{schema}, result string, batch_id string").parquet(f"{folder}/out")
    return found.select("event_id", "result")


def stream_bounded_batches(spark, sf_dir):
    """Batches bounded by records: how many had more than the bound, and the records of all."""
    folder = new_folder(spark, "bounded")
    events = spark.read.schema(_EVENTS).parquet(f"{sf_dir}/events.parquet").select("event_id")
    landed = landing.land_bounded(events, f"{folder}/in", _BATCH_RECORDS, _LANES)
    write = landing.counted(landing.to_folder(f"{folder}/out"), f"{folder}/counts")
    landing.write_lanes(
        lambda lane: read_arrivals(spark, lane, "event_id bigint", "parquet", 1), landed, _LANES, f"{folder}/state", write)
    counts = landing.batch_counts(spark, f"{folder}/counts")
    return counts.agg(
        F.count_if(F.col("records") > _BATCH_RECORDS).alias("over_bound"), F.coalesce(F.sum("records"), F.lit(0)).alias("records"))


_TOPICS = {"auth": ["signup"], "listen": ["view", "click"], "page_view": ["purchase"]}


def stream_fanout(spark, sf_dir):
    """Three topics to a table and two document folders, the records of no topic to a folder of their own;
    read back together."""
    folder = new_folder(spark, "topics")
    topic = F.coalesce(*[F.when(F.col("event_type").isin(kinds), F.lit(t)) for t, kinds in _TOPICS.items()])
    sinks = {"auth": landing.to_folder(f"{folder}/auth"), "listen": landing.to_documents(f"{folder}/listen"),
             "page_view": landing.to_documents(f"{folder}/page_view")}
    stream = _events(spark, sf_dir).select("event_id", "user_id", "props", topic.alias("topic"))
    landing.fan_out(stream, "topic", sinks, landing.to_folder(f"{folder}/rest"), f"{folder}/state").awaitTermination()
    schema = "event_id bigint, user_id bigint, props string"
    found = spark.read.schema(schema).parquet(f"{folder}/auth").withColumn("topic", F.lit("auth"))
    found = found.unionByName(spark.read.schema(schema).parquet(f"{folder}/rest").withColumn("topic", F.lit(None).cast("string")))
    for name in ("listen", "page_view"):
        documents = spark.read.schema(schema).json(f"{folder}/{name}")
        found = found.unionByName(documents.withColumn("topic", F.lit(name)))
    return found.drop("batch_id")


def stream_forward(spark, sf_dir):
    """Rows forwarded as JSON keyed by id."""
    folder = new_folder(spark, "forward")
    rows = _events(spark, sf_dir).select(F.col("event_id").alias("id"), "event_type", "props")
    landing.write_batches(records.keyed(rows), f"{folder}/state", landing.to_folder(f"{folder}/data")).awaitTermination()
    sent = spark.read.schema("key string, value string").parquet(f"{folder}/data")
    return sent.select("key", *[F.get_json_object("value", f"$.{c}").alias(c) for c in ("id", "event_type", "props")])


def stream_batch_counts(spark, sf_dir):
    """Records of all batches, by their own counts, beside the rows written."""
    folder = new_folder(spark, "counts")
    stream = _scattered(spark, sf_dir, folder).select("event_id")
    write = landing.counted(landing.to_folder(f"{folder}/data"), f"{folder}/counts")
    landing.write_batches(stream, f"{folder}/state", write).awaitTermination()
    seen = landing.batch_counts(spark, f"{folder}/counts").agg(F.sum("records").alias("observed"))
    written = spark.read.schema("event_id bigint").parquet(f"{folder}/data").agg(F.count("*").alias("written"))
    return seen.select("observed", written.scalar().alias("written"))


QUERIES = {f.__name__: f for f in (
    stream_landing, stream_dead_letter, stream_hourly, stream_hourly_windows, stream_batch_failures, stream_bounded_batches,
    stream_fanout, stream_forward, stream_batch_counts)}

_ARRIVED = """WITH arrived AS (SELECT *, date_trunc('day', date_trunc('second', ts)
        + to_seconds(CAST(floor(value) AS BIGINT))) + INTERVAL 29 HOUR AS arrival,
    CASE WHEN event_type = 'error' THEN 'malformed' WHEN floor(value) > 60 THEN 'expired' ELSE 'ok' END AS result
    FROM events)"""

ORACLES = {
    "stream_landing": f"""{_ARRIVED} SELECT event_id AS id, event_type AS page, props AS items,
        CAST(year(arrival) AS INTEGER) AS year, CAST(month(arrival) AS INTEGER) AS month,
        CAST(day(arrival) AS INTEGER) AS day, CAST(hour(arrival) AS INTEGER) AS hour
        FROM arrived WHERE result = 'ok'""",
    "stream_dead_letter": f"""{_ARRIVED} SELECT result, event_type AS page, COUNT(*) AS records
        FROM arrived WHERE result <> 'ok' GROUP BY result, event_type""",
    "stream_hourly": """WITH plays AS (SELECT ts FROM events WHERE event_type IN ('view', 'click')),
        hours AS (SELECT date_trunc('hour', ts) AS hour, COUNT(*) AS total_streams FROM plays GROUP BY 1)
        SELECT strftime(hour, '%Y-%m-%d') AS stream_date, strftime(hour, '%H') AS stream_hour, total_streams
        FROM hours WHERE hour + INTERVAL 1 HOUR <= (SELECT max(ts) FROM plays) - INTERVAL 1 HOUR""",
    "stream_hourly_windows": """WITH plays AS (SELECT event_id, ts, date_trunc('hour', ts) AS hour FROM events WHERE event_type IN ('view', 'click')),
        closed AS (SELECT max(ts) FILTER (event_id % 10 < 8) - INTERVAL 1 HOUR AS first,
            max(ts) FILTER (event_id % 10 < 9) - INTERVAL 1 HOUR AS second, max(ts) - INTERVAL 1 HOUR AS last FROM plays)
        SELECT strftime(hour, '%Y-%m-%d') AS stream_date, strftime(hour, '%H') AS stream_hour, COUNT(*) AS total_streams
        FROM plays, closed WHERE hour + INTERVAL 1 HOUR <= last AND hour + INTERVAL 1 HOUR > CASE event_id % 10
            WHEN 8 THEN first WHEN 9 THEN second ELSE TIMESTAMP '1900-01-01' END GROUP BY hour""",
    "stream_batch_failures": """SELECT event_id, CASE WHEN bool_or(event_type = 'error' AND event_id % 2 = 1) OVER (PARTITION BY event_id % 4)
        THEN 'failed' ELSE 'ok' END AS result FROM events""",
    "stream_bounded_batches": "SELECT CAST(0 AS BIGINT) AS over_bound, COUNT(*) AS records FROM events",
    "stream_fanout": """SELECT event_id, user_id, props, CASE event_type WHEN 'signup' THEN 'auth'
        WHEN 'purchase' THEN 'page_view' WHEN 'view' THEN 'listen' WHEN 'click' THEN 'listen' END AS topic FROM events""",
    "stream_forward": """SELECT CAST(event_id AS VARCHAR) AS key, CAST(event_id AS VARCHAR) AS id, event_type, props
        FROM events""",
    "stream_batch_counts": "SELECT COUNT(*) AS observed, COUNT(*) AS written FROM events",
}
