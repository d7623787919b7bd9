"""Trip-style file batches over `lineitem`: every row becomes a trip of one of two colours."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import columns, files
from ..plans import trips
from ..schemas import TRIP_WAREHOUSE
from ..session import new_folder
from ..sinks.files import write_by_time, write_split, write_stage
from ..sources.catalog import discover
from ..sources.files import read_declared, read_directory, read_merged, read_partitions, read_split, rows_per_file
from .tables import table

_COMMON = {
    "VendorID": "CAST(l_suppkey % 2 + 1 AS INT)",
    "passenger_count": "l_quantity",
    "trip_distance": "l_discount",
    "RatecodeID": "CAST(l_partkey % 6 AS DOUBLE)",
    "store_and_fwd_flag": "l_linestatus",
    "PULocationID": "CAST(l_partkey % 265 AS INT)",
    "DOLocationID": "CAST(l_suppkey % 265 AS INT)",
    "payment_type": "CASE WHEN l_quantity = 13 THEN CAST('NaN' AS DOUBLE) ELSE l_linenumber + 0.5 END",
    "fare_amount": "l_extendedprice",
    "extra": "l_tax",
    "mta_tax": "l_tax",
    "tip_amount": "l_discount",
    "tolls_amount": "l_tax",
    "improvement_surcharge": "l_discount",
    "total_amount": "l_extendedprice",
    "congestion_surcharge": "CASE WHEN l_quantity = 7 THEN NULL ELSE 2.5 END",
}
_COLOURS = {
    "yellow": {"tpep_pickup_datetime": "l_shipdate", "tpep_dropoff_datetime": "l_shipdate + INTERVAL 1 HOUR",
               "airport_fee": "CAST(l_linenumber AS DOUBLE)"},
    "green": {"lpep_pickup_datetime": "l_shipdate", "lpep_dropoff_datetime": "l_shipdate + INTERVAL 1 HOUR",
              "ehail_fee": "CAST(l_linenumber AS DOUBLE)", "trip_type": "l_linenumber"},
}
_COLOUR_OF = {"yellow": "l_linestatus = 'O'", "green": "l_linestatus <> 'O'"}


def _raw_trips(spark, sf_dir) -> str:
    """Land both colours, one dataset per colour and return flag, and return their folder."""
    folder = new_folder(spark, "trips")
    for colour, own in _COLOURS.items():
        lines = table(spark, sf_dir, "lineitem").filter(_COLOUR_OF[colour])
        lines = lines.withColumn("l_shipdate", F.col("l_shipdate").cast("timestamp_ntz"))
        raw = lines.select(
            *[F.expr(e).alias(c) for c, e in {**_COMMON, **own}.items()],
            F.concat(F.lit(f"{colour}_tripdata_"), "l_returnflag", F.lit(".parquet")).alias("file"))
        write_split(raw, folder, ["file"], mode="append")
    return folder


def _cleaned(spark, sf_dir):
    folder = _raw_trips(spark, sf_dir)
    return {c: trips.apply_steps(read_split(spark, folder, "file", c), c) for c in _COLOURS}


def trip_batch(spark, sf_dir):
    """Both colours cleaned, combined, written as one stage and aligned to the warehouse table by name."""
    stage = write_stage(trips.combine(_cleaned(spark, sf_dir)), new_folder(spark, "stage"))
    return columns.align_to(spark.read.parquet(stage), TRIP_WAREHOUSE)


def trip_rows_per_file(spark, sf_dir):
    return trips.combine(_cleaned(spark, sf_dir)).groupBy("content", "file").agg(F.count("*").alias("rows"))


def named_file_scan(spark, sf_dir):
    """Rows of the given files whose name starts with 'line', by file name."""
    return rows_per_file(read_directory(spark, sf_dir, "line"))


def schema_merge_scan(spark, sf_dir):
    """Two deliveries of which the second has a column more, found as one table."""
    folder = new_folder(spark, "merged")
    lines = table(spark, sf_dir, "lineitem")
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    lines.filter("l_linestatus = 'O'").select(*keys).write.parquet(f"{folder}/delivery=1")
    lines.filter("l_linestatus <> 'O'").select(*keys, "l_returnflag").write.parquet(f"{folder}/delivery=2")
    return read_merged(spark, folder).select(*keys, "l_returnflag", F.col("delivery").cast("int").alias("delivery"))


def partitioned_scan(spark, sf_dir):
    """Events landed four times a day; the partition filter selects folders before any file is opened."""
    events = table(spark, sf_dir, "events")
    folder = new_folder(spark, "hours")
    slot = F.date_trunc("DAY", "ts") + F.make_dt_interval(hours=(F.hour("ts") / 6).cast("int") * 6)
    write_by_time(events, folder, slot, "hourly", "parquet")
    schema = "event_id bigint, user_id bigint, event_type string, year string, month string, day string, hour string"
    return read_partitions(spark, folder, schema).filter((F.col("day") <= "20") & (F.col("hour") >= "06"))


def schema_discovered(spark, sf_dir):
    """Three deliveries whose types clash, found in two runs and registered as one table."""
    lines, folder = table(spark, sf_dir, "lineitem"), new_folder(spark, "discovered")
    name = "discovered_" + folder.rpartition("-")[2]
    keys = ["l_orderkey", "l_linenumber"]
    first = lines.filter("l_linenumber = 1").selectExpr(*keys, "CAST(l_quantity AS INT) AS l_quantity", "CAST(l_partkey AS INT) AS l_partkey", "l_shipdate")
    second = lines.filter("l_linenumber = 2").selectExpr(*keys, "CAST(l_quantity AS DOUBLE) AS L_Quantity", "CAST(l_partkey AS BIGINT) AS l_partkey", "l_tax")
    third = lines.filter("l_linenumber > 2").selectExpr(*keys, "CAST(l_quantity AS FLOAT) AS l_quantity", "'P-' || l_partkey AS l_partkey")
    for k, delivery in enumerate((first, second, third)):
        write_stage(delivery, f"{folder}/delivery={k}")
        if k:
            discover(spark, name, folder)
    return spark.table(name)


def declared_partitions(spark, sf_dir):
    """Two days and a half of hourly folders by computed paths; the range begins before the first hour that exists."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "ts")
    folder = new_folder(spark, "declared")
    write_by_time(events, folder, F.col("ts"), "hourly", "parquet")
    schema = "event_id bigint, event_type string, ts timestamp_ntz, year string, month string, day string, hour string"
    return read_declared(spark, folder, schema, datetime(2023, 12, 30, 21), datetime(2024, 1, 3, 14),
                         (datetime(2023, 1, 1), datetime(2025, 1, 1))).drop("ts")


_HOLES = """CASE WHEN l_quantity = 13 THEN NULL ELSE l_partkey END"""


def _with_holes(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").withColumn("l_shipdate", F.col("l_shipdate").cast("timestamp_ntz"))
    return lines.withColumns({
        "l_partkey": F.expr(_HOLES),
        "l_tax": F.expr("CASE WHEN l_linenumber = 3 THEN CAST('NaN' AS DOUBLE) ELSE l_tax END"),
    })


def drop_null_rows(spark, sf_dir):
    return columns.sort_columns(columns.drop_rows_with_nulls(_with_holes(spark, sf_dir)))


def drop_null_columns(spark, sf_dir):
    return columns.drop_columns_with_nulls(_with_holes(spark, sf_dir))


def normalize_columns(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    spaced = columns.rename(part, {"p_name": "Part name", "p_size": "p size", "P_BRAND": "never"})
    return columns.drop_if_present(columns.upper_names(spaced), "P_TYPE", "NOT_THERE")


def align_to_schema(spark, sf_dir):
    wanted = T.StructType([
        T.StructField("p_size", T.LongType()), T.StructField("p_partkey", T.StringType()),
        T.StructField("p_name", T.StringType())])
    return columns.align_to(columns.sort_columns(table(spark, sf_dir, "part")), wanted)


_SAMPLE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def _files(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    name = F.concat("l_returnflag", F.lit("_"), "l_linestatus", F.lit("_tripdata.parquet"))
    return lines.select(*_SAMPLE_KEY, "l_quantity", "l_extendedprice", name.alias("file"))


def size_guard(spark, sf_dir):
    return files.size_guard(_files(spark, sf_dir), "file", 10_000)


def sample_per_file(spark, sf_dir):
    return trips.streaming_sample(_files(spark, sf_dir), _SAMPLE_KEY)


QUERIES = {f.__name__: f for f in (
    trip_batch, trip_rows_per_file, named_file_scan, schema_merge_scan, schema_discovered, partitioned_scan, declared_partitions, drop_null_rows,
    drop_null_columns, normalize_columns, align_to_schema, size_guard, sample_per_file,
)}

_COMPLETE = "l_quantity <> 13 AND l_quantity <> 7"
_FILE = "l_returnflag || '_' || l_linestatus || '_tripdata.parquet' AS file"

ORACLES = {
    "trip_batch": f"""SELECT CAST(l_suppkey % 2 + 1 AS INTEGER) AS vendorid, l_shipdate AS pickup_datetime,
        l_shipdate + INTERVAL 1 HOUR AS dropoff_datetime, l_quantity AS passenger_count, l_discount AS trip_distance,
        CAST(l_partkey % 6 AS DOUBLE) AS ratecodeid, l_linestatus AS store_and_fwd_flag,
        CAST(l_partkey % 265 AS INTEGER) AS pulocationid, CAST(l_suppkey % 265 AS INTEGER) AS dolocationid,
        l_linenumber AS payment_type, l_extendedprice AS fare_amount, l_tax AS extra, l_tax AS mta_tax,
        l_discount AS tip_amount, l_tax AS tolls_amount, l_discount AS improvement_surcharge,
        l_extendedprice AS total_amount, CAST(2.5 AS DOUBLE) AS congestion_surcharge
        FROM lineitem WHERE {_COMPLETE}""",
    "trip_rows_per_file": f"""SELECT content, content || '_tripdata_' || l_returnflag || '.parquet' AS file,
        COUNT(*) AS rows FROM (SELECT *, CASE WHEN l_linestatus = 'O' THEN 'yellow' ELSE 'green' END AS content
        FROM lineitem WHERE {_COMPLETE}) GROUP BY content, l_returnflag""",
    "named_file_scan": """SELECT 'lineitem.parquet' AS file, COUNT(*) AS rows FROM lineitem""",
    "schema_merge_scan": """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
        CASE WHEN l_linestatus <> 'O' THEN l_returnflag END AS l_returnflag,
        CASE WHEN l_linestatus = 'O' THEN 1 ELSE 2 END AS delivery FROM lineitem""",
    "partitioned_scan": """SELECT event_id, user_id, event_type, strftime(ts, '%Y') AS year,
        strftime(ts, '%m') AS month, strftime(ts, '%d') AS day, lpad(CAST(hour(ts) // 6 * 6 AS VARCHAR), 2, '0') AS hour
        FROM events WHERE strftime(ts, '%d') <= '20' AND hour(ts) >= 6""",
    "schema_discovered": """SELECT l_orderkey, l_linenumber, CAST(l_quantity AS DOUBLE) AS l_quantity,
        CASE WHEN l_linenumber > 2 THEN 'P-' ELSE '' END || l_partkey AS l_partkey,
        CASE WHEN l_linenumber = 1 THEN l_shipdate END AS l_shipdate, CASE WHEN l_linenumber = 2 THEN l_tax END AS l_tax FROM lineitem""",
    "declared_partitions": """SELECT event_id, event_type, strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month,
        strftime(ts, '%d') AS day, strftime(ts, '%H') AS hour FROM events
        WHERE ts >= TIMESTAMP '2023-12-30 21:00:00' AND ts < TIMESTAMP '2024-01-03 14:00:00'""",
    "drop_null_rows": "SELECT * FROM lineitem WHERE l_quantity <> 13 AND l_linenumber <> 3",
    "drop_null_columns": "SELECT * EXCLUDE (l_partkey, l_tax) FROM lineitem",
    "normalize_columns": """SELECT p_partkey AS "P_PARTKEY", p_name AS "PART_NAME", p_brand AS "P_BRAND",
        p_size AS "P_SIZE", p_retailprice AS "P_RETAILPRICE" FROM part""",
    "align_to_schema": """SELECT CAST(p_size AS BIGINT) AS p_size, CAST(p_partkey AS VARCHAR) AS p_partkey, p_name
        FROM part""",
    "size_guard": f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, {_FILE}
        FROM lineitem WHERE (l_returnflag, l_linestatus) IN (SELECT (l_returnflag, l_linestatus) FROM lineitem
        GROUP BY l_returnflag, l_linestatus HAVING COUNT(*) >= 10000)""",
    "sample_per_file": f"""WITH files AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
            l_extendedprice, {_FILE}, l_returnflag AS content FROM lineitem),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY file ORDER BY md5(concat_ws('|', l_orderkey,
            l_linenumber, l_partkey, l_suppkey)), l_quantity, l_extendedprice) AS n,
            COUNT(*) OVER (PARTITION BY file) AS total FROM files)
        SELECT * EXCLUDE (n, total) FROM ranked WHERE n <= 10000 AND total >= 10000""",
}
