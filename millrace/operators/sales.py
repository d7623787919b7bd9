"""Sales-side operators: calendar, product catalogue, amounts, daily reseller records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.times import file_date
from ..schemas import (
    CALENDAR_END, CALENDAR_START, CHANNEL_ROWS, CHANNELS, PRODUCT_FORMATS, PRODUCT_TEXTS, RESELLER_ROWS, RESELLERS,
)
from ..session import settle
from .sequence import sequence_within


def _fixed_rows(spark: SparkSession, rows: list[tuple], schema: StructType) -> DataFrame:
    """A small dimension as literals of the plan."""
    literals = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, schema.fields, strict=True)])
                for row in rows]
    return spark.range(1).select(F.inline(F.array(*literals)))


def channels(spark: SparkSession) -> DataFrame:
    return _fixed_rows(spark, CHANNEL_ROWS, CHANNELS)


def resellers(spark: SparkSession) -> DataFrame:
    return _fixed_rows(spark, RESELLER_ROWS, RESELLERS)


def calendar(spark: SparkSession, start: str = CALENDAR_START, end: str = CALENDAR_END) -> DataFrame:
    """One row per day, both ends included."""
    days = F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))
    return spark.range(1).select(F.explode(days).alias("day"))


def in_calendar(df: DataFrame, column: str, start: str = CALENDAR_START, end: str = CALENDAR_END) -> DataFrame:
    """Rows whose date is a calendar day. The days are contiguous, so a range test that reaches the scan
    says the same as a semi join with the calendar."""
    first, after = F.lit(start).cast("date"), F.date_add(F.lit(end).cast("date"), 1)
    return df.filter((F.col(column) >= first) & (F.col(column) < after))


def product_catalogue(
    cities: DataFrame, city: str, formats: list[str] = PRODUCT_FORMATS, texts: list[str] = PRODUCT_TEXTS,
) -> DataFrame:
    """Every format and text for every city, numbered from 1 in format, text, city order.

    The two fixed lists are exploded per city; the number follows from the three positions, so nothing
    is sorted but the cities.
    """
    distinct = settle(cities.select(F.col(city).alias("city")).distinct(), "cities")
    ranked = sequence_within(distinct, [], ["city"], "_city")
    n_cities = ranked.agg(F.count("*").alias("n")).scalar()
    every = ranked.select("city", "_city", F.posexplode(F.array(*map(F.lit, formats))).alias("_format", "format"))
    every = every.select("*", F.posexplode(F.array(*map(F.lit, texts))).alias("_text", "text"))
    number = (F.col("_format") * F.lit(len(texts)) + F.col("_text")) * n_cities + F.col("_city") + 1
    return every.select(number.alias("product_id"), F.concat_ws(" ", "format", "text", "city").alias("name"), "city")


def line_amount(price: Column, qty: Column) -> Column:
    """Exact amount of a line, in cents of a decimal."""
    return (price.cast("decimal(15,2)") * qty.cast("decimal(10,0)")).cast("decimal(19,2)")


def commission(sales_rows: DataFrame, amount: str, reseller: str, spark: SparkSession) -> DataFrame:
    """Reseller name and commission of each sale. The dimension is four fixed rows, so it is broadcast."""
    rates = F.broadcast(resellers(spark))
    joined = sales_rows.join(rates, F.col(reseller) == F.col("reseller_id"), "left")
    due = (F.col(amount).cast("decimal(19,2)") * F.col("commission_pct").cast("decimal(5,4)")).cast("decimal(19,4)")
    return joined.withColumn("commission", due).drop("reseller_id", "commission_pct")


def daily_file_name(day: Column, reseller: Column, extension: str) -> Column:
    """Name of a daily file: its date is written year, day, month."""
    return F.format_string(f"DailySales_%s_%s.{extension}", file_date(day), reseller.cast("string"))


def daily_file_parts(name: Column) -> Column:
    """struct(day, reseller) read back from a daily file name; any other name gives NULLs."""
    pattern = r"^(?:raw)?DailySales_(\d{8})_(\w+)\.\w+$"
    day = F.try_to_date(F.regexp_extract(name, pattern, 1), "yyyyddMM")
    return F.struct(day.alias("day"), F.nullif(F.regexp_extract(name, pattern, 2), F.lit("")).alias("reseller"))


def email(first: Column, last: Column) -> Column:
    return F.format_string("%s.%s@example.com", first, last)
