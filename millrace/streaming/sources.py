"""Streaming sources: topics, a shard stream, or landed files with the same record shape."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# Records per micro-batch, its longest wait, the pull interval, the greatest record age.
BATCH_RECORDS = 5
BATCH_WAIT = "30 seconds"
PULL_INTERVAL = "10 minutes"
MAX_AGE_SECONDS = 60


def batch_limits(format_name: str, records: int = BATCH_RECORDS) -> dict[str, str]:
    """Reader options that hold a micro-batch to so many records (topics) or files (landed files)."""
    names = {"kafka": "maxOffsetsPerTrigger"}
    return {names.get(format_name, "maxFilesPerTrigger"): str(records)}


def pull_trigger(mode: str) -> dict[str, str]:
    """Trigger arguments: `batch` starts a micro-batch at the longest wait, `pull` at the pull interval."""
    return {"processingTime": {"batch": BATCH_WAIT, "pull": PULL_INTERVAL}[mode]}


def topic_options(servers: str, topics: list[str], per_batch: int | None = None, start: str = "latest") -> dict[str, str]:
    options = {"kafka.bootstrap.servers": servers, "subscribe": ",".join(topics), "startingOffsets": start}
    if per_batch:
        options |= batch_limits("kafka", per_batch)
    return options


def read_topics(spark: SparkSession, servers: str, topics: list[str], per_batch: int | None = None,
                start: str = "latest") -> DataFrame:
    """Key, value and topic of every record; the connector package must be on the classpath."""
    records = spark.readStream.format("kafka").options(**topic_options(servers, topics, per_batch, start)).load()
    return records.selectExpr("CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value", "topic", "timestamp")


def read_shards(spark: SparkSession, connector: str, options: dict[str, str]) -> DataFrame:
    """A shard stream from its latest record, through a named connector."""
    return spark.readStream.format(connector).options(**{"startingPosition": "latest", **options}).load()


def read_arrivals(spark: SparkSession, path: str, schema: StructType | str, file_format: str = "json",
                  files_per_batch: int | None = None) -> DataFrame:
    """Files as they arrive below a path; only names with the format's extension count."""
    reader = spark.readStream.format(file_format).schema(schema).option("pathGlobFilter", f"*.{file_format}*")
    if files_per_batch:
        reader = reader.options(**batch_limits(file_format, files_per_batch))
    return reader.load(path)
