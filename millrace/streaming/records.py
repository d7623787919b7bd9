"""Stream records: decoding, keying, and the age rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

OK, MALFORMED, EXPIRED = "ok", "malformed", "expired"


def decode(df: DataFrame, schema: StructType, value: str = "value", wrapper: str = "payload") -> DataFrame:
    """Record struct `record` from JSON text that is either the bare object or wrapped by name.

    Both shapes are read in one parse: the wrapper is an extra field of the schema.
    """
    both = StructType([*schema.fields, StructField(wrapper, schema)])
    parsed = df.withColumn("_parsed", F.from_json(value, both))
    bare = F.struct(*[F.col("_parsed")[f.name].alias(f.name) for f in schema.fields])
    record = F.when(F.col("_parsed")[wrapper].isNotNull(), F.col("_parsed")[wrapper]).when(
        F.col("_parsed").isNotNull(), bare)
    return parsed.withColumn("record", record).drop("_parsed")


def keyed(df: DataFrame, key: str = "id") -> DataFrame:
    """Whole rows as JSON values keyed by one column, ready to forward."""
    return df.select(F.col(f"`{key}`").cast("string").alias("key"), F.to_json(F.struct("*")).alias("value"))


def outcome(key: Column, event_time: Column, arrival: Column, max_age_seconds: int) -> Column:
    """What becomes of a record: without a key it is malformed, older than the limit on arrival expired."""
    limit = event_time + F.make_dt_interval(secs=F.lit(max_age_seconds))
    return F.when(key.isNull() | event_time.isNull(), MALFORMED).when(arrival > limit, EXPIRED).otherwise(OK)
