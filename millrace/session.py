"""Session settings, the shared scratch folder and size-checked broadcasts."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A side may be broadcast with at most this many rows and as many bytes, as Spark estimates them from the
# sizes of its files and the widths of its columns.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 * 1024 ** 2
SALTS = 64


def build_session(app: str = "millrace", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings every job relies on; `conf` keys use `__` for dots."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
        # Recording the Python call site of every column expression costs more than planning it.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    if not (master or "").startswith("local"):
        # Exchanges begin with many partitions; adaptive execution merges those that turn out small.
        builder = builder.config("spark.sql.adaptive.coalescePartitions.initialPartitionNum", "4096")
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def size_shuffles(spark: SparkSession, input_bytes: int, task_bytes: int = 256 * 1024 ** 2) -> int:
    """Plan shuffles for an input of that size: enough partitions for tasks of about `task_bytes`, which
    adaptive execution merges where less data arrives. Returns the number of partitions."""
    parts = max(spark.sparkContext.defaultParallelism, -(-input_bytes // task_bytes))
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    return parts


@functools.cache
def _local_folder() -> str:
    return "file://" + tempfile.mkdtemp(prefix="run-", dir="/tmp")


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: spark.checkpoint.dir, or a temporary one in local mode."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors")
    return _local_folder()


_named: list[str] = []


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder name under the shared folder; nothing is created yet."""
    folder = f"{shared_folder(spark)}/millrace-{label}-{uuid.uuid4().hex}"
    _named.append(folder)
    return folder


def release(spark: SparkSession) -> int:
    """Delete the scratch folders this process has named, once the results that read them are used up."""
    configuration, count = spark._jsc.hadoopConfiguration(), 0
    while _named:
        path = spark._jvm.org.apache.hadoop.fs.Path(_named.pop())
        count += path.getFileSystem(configuration).delete(path, True)
    return count


def settle(df: DataFrame, label: str = "settled") -> DataFrame:
    """Write once and read back: cuts lineage and survives the loss of executors."""
    folder = new_folder(df.sparkSession, label)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


_FIXED = ("tinyint", "smallint", "int", "bigint", "float", "double", "boolean", "date", "timestamp", "timestamp_ntz")


def narrow(df: DataFrame) -> bool:
    """Whether a result of at most BROADCAST_ROWS rows has no more than BROADCAST_BYTES, so that it may be
    broadcast. A plan whose files are too large settles it; texts and nested values are measured, since
    estimates know neither their lengths nor their compression."""
    if all(kind in _FIXED for _, kind in df.dtypes):
        return True
    estimate = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    if BROADCAST_BYTES < estimate < 1 << 60:
        return False
    return (df.select(F.sum(F.length(F.to_json(F.struct(*df.columns))))).first()[0] or 0) <= BROADCAST_BYTES


def lookup(facts: DataFrame, dim: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join facts to a dimension that is expected, but not known, to be small.

    The dimension is settled and counted first. Up to BROADCAST_ROWS and BROADCAST_BYTES it is broadcast,
    so facts do not move. Beyond that both sides shuffle on the key plus a salt, so that no single key of the
    facts fills one task.
    """
    dim = settle(dim, "lookup")
    if dim.count() <= BROADCAST_ROWS and narrow(dim):
        return facts.join(F.broadcast(dim), on, how)
    salted_dim = dim.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    row_hash = F.xxhash64(*[c for c in facts.columns if c not in on] or on)
    salted_facts = facts.withColumn("_salt", F.pmod(row_hash, F.lit(SALTS)).cast("int"))
    return salted_facts.join(salted_dim, [*on, "_salt"], how).drop("_salt")
