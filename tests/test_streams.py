"""Streams over small landed files."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.streaming import landing, records, sources

AT = datetime(2024, 3, 5, 7, 0, 0)
SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])


def rows(df):
    return sorted([tuple(r) for r in df.collect()], key=repr)


def land(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(line) for line in lines))


def test_both_record_shapes(spark):
    values = ['{"id": 1, "name": "a"}', '{"schema": {}, "payload": {"id": 1, "name": "a"}}', "not json", None]
    got = records.decode(spark.createDataFrame([(v,) for v in values], "value string"), SCHEMA)
    assert [r.record and r.record.id for r in got.collect()] == [1, 1, None, None]


def test_age_limits(spark):
    ages = spark.createDataFrame([(1, AT, AT + timedelta(seconds=s)) for s in (59, 60, 61)] + [(None, AT, AT)],
                                 "id int, at timestamp_ntz, arrival timestamp_ntz")
    result = records.outcome(F.col("id"), F.col("at"), F.col("arrival"), sources.MAX_AGE_SECONDS)
    assert [r[0] for r in ages.select(result).collect()] == ["ok", "ok", "expired", "malformed"]


def test_landing(spark, tmp_path):
    land(tmp_path / "in", "a.json", [{"value": '{"id": 1}'}, {"value": '{"id": null}'}])
    land(tmp_path / "in", "skip.txt", [{"value": '{"id": 7}'}])

    def run():
        stream = sources.read_arrivals(spark, str(tmp_path / "in"), "value string", files_per_batch=1)
        decoded = records.decode(stream, SCHEMA)
        at = F.lit(AT.isoformat()).cast("timestamp_ntz")
        result = records.outcome(F.col("record.id"), at, at, 60)
        landing.land_by_hour(decoded, str(tmp_path / "out"), str(tmp_path / "state"), at, result).awaitTermination()
        return spark.read.parquet(str(tmp_path / "out")).select("result", "record.id")

    assert rows(run()) == [("malformed", None), ("ok", 1)]
    assert (tmp_path / "out" / "result=ok" / "year=2024" / "month=03" / "day=05" / "hour=07").is_dir()
    land(tmp_path / "in", "b.json", [{"value": '{"id": 2}'}])
    assert rows(run()) == [("malformed", None), ("ok", 1), ("ok", 2)]


def test_fan_out_and_counts(spark, tmp_path):
    for i in range(3):
        land(tmp_path / "in", f"{i}.json", [{"topic": t, "id": i} for t in ("auth", "listen", "other")])
    land(tmp_path / "in", "none.json", [{"topic": None, "id": 9}])
    stream = sources.read_arrivals(spark, str(tmp_path / "in"), "topic string, id bigint", files_per_batch=1)
    auth = landing.counted(landing.to_folder(str(tmp_path / "auth")), str(tmp_path / "counts"))
    routes = {"auth": auth, "listen": landing.to_documents(str(tmp_path / "listen"))}
    rest = landing.to_folder(str(tmp_path / "rest"))
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    landing.fan_out(stream, "topic", routes, rest, str(tmp_path / "state")).awaitTermination()
    spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert sorted(r.records for r in landing.batch_counts(spark, str(tmp_path / "counts")).collect()) == [0, 1, 1, 1]
    assert rows(spark.read.schema("id bigint").parquet(str(tmp_path / "auth")).select("id")) == [(0,), (1,), (2,)]
    assert rows(spark.read.schema("id bigint").json(str(tmp_path / "listen")).select("id")) == [(0,), (1,), (2,)]
    left = spark.read.schema("topic string, id bigint").parquet(str(tmp_path / "rest")).select("topic", "id")
    assert rows(left) == [("other", 0), ("other", 1), ("other", 2), (None, 9)]


def test_runs_do_not_replace_each_other(spark, tmp_path):
    land(tmp_path / "in", "a.json", [{"id": i} for i in range(5)])
    for run in ("one", "two"):
        stream = sources.read_arrivals(spark, str(tmp_path / "in"), "id bigint")
        landing.write_batches(stream, str(tmp_path / run), landing.to_folder(str(tmp_path / "out"))).awaitTermination()
    assert spark.read.schema("id bigint").parquet(str(tmp_path / "out")).count() == 10


def test_repeated_batch_replaces_itself(spark, tmp_path):
    write = landing.to_folder(str(tmp_path / "out"))
    write(spark.range(3), 0)
    write(spark.range(3), 0)
    write(spark.range(2), 1)
    assert spark.read.schema("id bigint").parquet(str(tmp_path / "out")).count() == 5


@pytest.mark.parametrize("files_per_batch", [1, None])
def test_hourly_counts_do_not_depend_on_batches(spark, tmp_path, files_per_batch):
    days = [20, 21, 1, 2]
    for i, day in enumerate(days):
        plays = [{"ts": datetime(2024, 3, day, 7) + timedelta(minutes=7 * k)} for k in range(30)]
        land(tmp_path / "in", f"{i}.json", [{"ts": p["ts"].isoformat()} for p in plays])
    stream = sources.read_arrivals(spark, str(tmp_path / "in"), "ts timestamp_ntz", files_per_batch=files_per_batch)
    write = landing.hourly_partials("ts", str(tmp_path / "out"))
    landing.write_batches(stream, str(tmp_path / "state"), write).awaitTermination()
    everything = landing.hourly_counts(spark, str(tmp_path / "out"), None, "timestamp_ntz")
    assert everything.agg(F.sum("total_streams")).first()[0] == 120 and everything.count() == 16
    closed = landing.hourly_counts(spark, str(tmp_path / "out"), time_type="timestamp_ntz")
    assert sorted(r.hour for r in closed.collect())[-1] == datetime(2024, 3, 21, 8) and closed.count() == 14


def test_keyed(spark):
    df = spark.createDataFrame([(1, "a")], "id int, name string")
    assert rows(records.keyed(df)) == [("1", '{"id":1,"name":"a"}')]


def test_topic_options():
    options = sources.topic_options("h:1", ["a", "b"], sources.BATCH_RECORDS)
    assert options == {"kafka.bootstrap.servers": "h:1", "subscribe": "a,b", "startingOffsets": "latest",
                       "maxOffsetsPerTrigger": "5"}


def test_limits_and_intervals_are_in_force(spark, tmp_path):
    for i in range(7):
        land(tmp_path / "in", f"{i}.json", [{"id": i}])
    stream = sources.read_arrivals(spark, str(tmp_path / "in"), "id bigint", files_per_batch=sources.BATCH_RECORDS)
    seen = []
    writer = stream.writeStream.foreachBatch(lambda df, _: seen.append(df.count())).option(
        "checkpointLocation", str(tmp_path / "state"))
    writer.trigger(availableNow=True).start().awaitTermination()
    assert sorted(seen) == [2, 5]
    query = stream.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "pull")).trigger(
        **sources.pull_trigger("pull")).start()
    try:
        assert query.isActive
    finally:
        query.stop()
    assert sources.pull_trigger("batch") == {"processingTime": "30 seconds"}
