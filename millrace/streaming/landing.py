"""Streaming sinks: landing by arrival hour with dead letters, tables, documents, topic fan-out."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ..functions.times import hour_parts
from ..sinks.files import HOURLY

RESULT = "result"


def trigger(writer: DataStreamWriter, every: str | None) -> DataStreamWriter:
    """Run at an interval, or once over everything available when none is given."""
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def land_by_hour(
    stream: DataFrame, folder: str, checkpoint: str, arrival: Column, result: Column,
    files_per_hour: int = 8, every: str | None = None,
) -> StreamingQuery:
    """Parquet below result/year/month/day/hour of arrival: good records and each kind of dead letter.

    One write serves both, each record goes to exactly one folder, and the file sink's own log makes a
    repeated batch harmless. Rows are spread by hour and row digest, so the files of a hot hour are
    written by up to `files_per_hour` tasks and other hours do not leave a file per task.
    """
    parts = hour_parts(arrival)
    by = [RESULT, *HOURLY]
    salt = F.pmod(F.xxhash64(*stream.columns), F.lit(files_per_hour))
    rows = stream.withColumns({RESULT: result, **{p: parts[p] for p in HOURLY}})
    rows = rows.withColumn("_salt", salt).repartition(*by, "_salt").drop("_salt")
    writer = rows.writeStream.format("parquet").partitionBy(*by).option("checkpointLocation", checkpoint)
    return trigger(writer.outputMode("append"), every).start(folder)


# Writes one batch under a label that names the run and the batch: a repeated batch has the same label, a
# batch of another run never has.
BatchWriter = Callable[[DataFrame, str], None]


def to_folder(folder: str, file_format: str = "parquet") -> BatchWriter:
    """Batch writer that may repeat a batch: each batch replaces its own sub-folder."""
    def write(batch: DataFrame, label: str) -> None:
        batch.write.mode("overwrite").format(file_format).save(f"{folder}/batch_id={label}")
    return write


def to_documents(folder: str) -> BatchWriter:
    """Whole rows as JSON documents."""
    return to_folder(folder, "json")


def to_jdbc(url: str, table: str, **options: str) -> BatchWriter:
    """Append to a relational table, which the first batch creates. Delivery is at least once."""
    def write(batch: DataFrame, label: str) -> None:
        batch.write.format("jdbc").options(url=url, dbtable=table, **options).mode("append").save()
    return write


def _run_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the query that owns a checkpoint, which restarts keep."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def write_batches(stream: DataFrame, checkpoint: str, write: BatchWriter, every: str | None = None) -> StreamingQuery:
    run: list[str] = []

    def labelled(batch: DataFrame, batch_id: int) -> None:
        run[:] = run or [_run_id(batch.sparkSession, checkpoint)]
        write(batch, f"{run[0]}-{batch_id}")

    writer = stream.writeStream.foreachBatch(labelled).option("checkpointLocation", checkpoint)
    return trigger(writer, every).start()


def fan_out(stream: DataFrame, topic: str, routes: dict[str, BatchWriter], rest: BatchWriter, checkpoint: str,
            every: str | None = None) -> StreamingQuery:
    """Each topic to its own sink, and records without a topic or of one that has no route, with their topic,
    to `rest`. A batch is kept while its topics are written, so it is read once."""
    def write(batch: DataFrame, label: str) -> None:
        batch.persist()
        try:
            for name, sink in routes.items():
                sink(batch.filter(F.col(topic) == name).drop(topic), label)
            rest(batch.filter(F.col(topic).isNull() | ~F.col(topic).isin(*routes)), label)
        finally:
            batch.unpersist()
    return write_batches(stream, checkpoint, write, every)


def all_or_nothing(write: BatchWriter, reject: BatchWriter, bad: Column) -> BatchWriter:
    """A batch with a bad record goes to `reject` as a whole, every other one to `write`.

    The decision depends on the batch's records alone, so a batch that is repeated goes the same way and replaces what an
    attempt before it left. The batch is kept while it is looked at and written, so it is read once; a null condition is not bad."""
    def decide(batch: DataFrame, label: str) -> None:
        batch.persist()
        try:
            sink = write if batch.filter(bad).isEmpty() else reject
            sink(batch, label)
        finally:
            batch.unpersist()
    return decide


LANE = "lane"


def land_bounded(df: DataFrame, folder: str, records: int, lanes: int = 0) -> str:
    """Records as files of at most `records` each, appended to a landing folder. A stream that admits one file a batch then
    never has more records in a batch than that, however they arrive.

    With lanes, every run of `records` rows goes to the next of so many sub-folders, whatever the rows hold, so that
    `write_lanes` can work through them side by side. A lane that got no rows is an empty folder."""
    if not lanes:
        df.write.mode("append").option("maxRecordsPerFile", records).parquet(folder)
        return folder
    place = F.monotonically_increasing_id() % F.lit(1 << 33)  # the row's place within its task
    lane = (F.spark_partition_id() + F.floor(place / records)) % lanes
    df.withColumn(LANE, lane).write.mode("append").option("maxRecordsPerFile", records).partitionBy(LANE).parquet(folder)
    for path in lane_folders(folder, lanes):
        _mkdirs(df.sparkSession, path)
    return folder


def lane_folders(folder: str, lanes: int) -> list[str]:
    return [f"{folder}/{LANE}={k}" for k in range(lanes)]


def write_lanes(read: Callable[[str], DataFrame], folder: str, lanes: int, checkpoint: str, write: BatchWriter) -> None:
    """Work through the lanes of a landing folder, each as a query with a checkpoint of its own, until nothing is left.

    Batches of one lane follow each other, those of different lanes run at the same time. A batch is as large as without lanes.
    When a lane fails, the others are stopped; all go on from their checkpoints the next time."""
    queries: list[StreamingQuery] = []
    try:
        for name, path in zip(lane_folders(checkpoint, lanes), lane_folders(folder, lanes), strict=True):
            queries.append(write_batches(read(path), name, write))
        for query in queries:
            query.awaitTermination()
    finally:
        for query in queries:
            query.stop()


def _path(spark: SparkSession, name: str):
    """A path and the file system it is on."""
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def _mkdirs(spark: SparkSession, folder: str) -> None:
    path, files = _path(spark, folder)
    files.mkdirs(path)


def counted(write: BatchWriter, folder: str) -> BatchWriter:
    """Also keep the number of records of each batch, as they pass, in a file of its own. The number is at hand when the batch
    is written, so the file takes no job; a repeated batch replaces it."""
    def write_and_count(batch: DataFrame, label: str) -> None:
        seen = Observation()
        write(batch.observe(seen, F.count("*").alias("records")), label)
        path, files = _path(batch.sparkSession, f"{folder}/{label}.json")
        out = files.create(path, True)
        try:
            out.writeBytes(json.dumps({"batch_id": str(label), "records": seen.get["records"]}) + "\n")
        finally:
            out.close()
    return write_and_count


def batch_counts(spark: SparkSession, folder: str) -> DataFrame:
    """(batch_id, records) of every batch that `counted` saw, whatever the query's progress remembers."""
    _mkdirs(spark, folder)  # there may have been no batch
    return spark.read.schema("batch_id string, records bigint").json(folder)


def hourly_partials(event_time: str, folder: str) -> BatchWriter:
    """Counts per hour of event time, each batch its own. They hold no state, so late events count too,
    however files are dealt to batches; `hourly_counts` adds the batches up."""
    def write(batch: DataFrame, label: str) -> None:
        per_hour = batch.filter(F.col(event_time).isNotNull()).groupBy(F.date_trunc("HOUR", event_time).alias("hour")).agg(
            F.count("*").alias("streams"), F.max(event_time).alias("latest"))
        to_folder(folder)(per_hour, label)
    return write


def hourly_counts(spark: SparkSession, folder: str, delay: str | None = "1 hour", time_type: str = "timestamp") -> DataFrame:
    """(hour, total_streams) over all batches written so far. With a delay, hours still open are left out:
    those that end within it of the latest event, or after it. Their counts stay and show up later."""
    parts = spark.read.schema(f"hour {time_type}, streams bigint, latest {time_type}").parquet(folder)
    totals = parts.groupBy("hour").agg(F.sum("streams").alias("total_streams"))
    if delay is None:
        return totals
    closed = parts.agg(F.max("latest").alias("latest")).select((F.col("latest") - F.expr(f"INTERVAL {delay}")).alias("t"))
    return totals.filter(F.col("hour") + F.expr("INTERVAL 1 HOUR") <= closed.scalar())


def windowed_counts(stream: DataFrame, event_time: str, width: str = "1 hour", delay: str = "1 hour") -> DataFrame:
    """(window_start, total_streams) per window of event time, kept in the state store until the watermark closes it.

    event_time is a timestamp. A window is emitted once, when the latest event seen is `delay` past its end; rows that come
    after that are dropped and counted by the query's progress. State holds the open windows only, whatever the
    length of the stream. Rows without an event time count nowhere.
    """
    counts = stream.withWatermark(event_time, delay).groupBy(F.window(event_time, width).alias("w")).agg(
        F.count("*").alias("total_streams"))
    return counts.select(F.col("w.start").alias("window_start"), "total_streams")


def land_windows(counts: DataFrame, folder: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Closed windows as Parquet, each written once: the file sink's log and the state of the checkpoint go together."""
    writer = counts.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append")
    return trigger(writer, every).start(folder)
