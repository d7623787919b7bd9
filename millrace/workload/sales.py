"""Sales side: catalogue, calendar, sequences, daily files, and file round trips."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.times import compact_date
from ..operators import sales
from ..operators.sequence import first_by_key, sequence_within
from ..schemas import PRODUCT_FORMATS, PRODUCT_TEXTS, RESELLER_CSV, RESELLER_JSON
from ..session import new_folder
from ..sinks import tables
from ..sinks.files import write_by_time, write_csv, write_split
from ..sources.catalog import empty_like, table_columns, table_exists
from ..sources.files import list_objects, read_csv, read_objects, read_payload
from .tables import table


def product_catalogue(spark, sf_dir):
    """Postcards of every format and text for every part name."""
    return sales.product_catalogue(table(spark, sf_dir, "part"), "p_name")


def calendar_split(spark, sf_dir):
    """Orders whose date is a day of the calendar."""
    kept = sales.in_calendar(table(spark, sf_dir, "orders"), "o_orderdate", "1996-01-01", "2000-12-31").withColumn(
        "file", sales.daily_file_name(F.col("o_orderdate"), F.col("o_custkey"), "csv"))
    found = sales.daily_file_parts(F.col("file"))
    return kept.select(
        "o_orderkey", compact_date(F.col("o_orderdate")).alias("day"), "file",
        found["day"].cast("string").alias("file_day"), found["reseller"].alias("file_reseller"))


def reseller_commission(spark, sf_dir):
    """Commission of every order, the reseller following from the first letter of its priority."""
    seller = (F.left("o_orderpriority", F.lit(1)).cast("int") + 1000).alias("seller")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", seller)
    due = sales.commission(orders, "o_totalprice", "seller", spark)
    return due.select("o_orderkey", "reseller_name", F.col("commission").cast("double").alias("commission"))


def calendar_days(spark, sf_dir):
    """Days of the calendar with their number of orders, days without orders included."""
    per_day = table(spark, sf_dir, "orders").groupBy(F.col("o_orderdate").cast("date").alias("day")).agg(
        F.count("*").alias("n"))
    days = sales.calendar(spark, "1996-01-01", "2000-12-31")
    return days.join(per_day, "day", "left").select(
        F.date_format("day", "yyyy-MM-dd").alias("day"), F.coalesce("n", F.lit(0)).alias("orders"))


def daily_sequence(spark, sf_dir):
    """Transaction ids per priority, counted from 0 through the days."""
    orders = table(spark, sf_dir, "orders").select("o_orderpriority", "o_orderdate", "o_orderkey")
    numbered = sequence_within(orders, ["o_orderpriority"], ["o_orderdate", "o_orderkey"], "transaction_id")
    return numbered.select("o_orderpriority", "o_orderkey", "transaction_id")


_CSV_SELLERS = ["view", "click", "purchase"]


def _sold(spark, sf_dir):
    """Events as reseller sales; the event type is the reseller."""
    return table(spark, sf_dir, "events").select(
        "event_id", F.col("event_type").alias("reseller"), F.date_format("ts", "yyyy-MM-dd").alias("day"),
        F.format_string("item %d", F.col("user_id")).alias("name"), (F.col("user_id") % 6 + 1).cast("int").alias("qty"),
        "value", F.format_string("F%d", F.col("user_id") % 9).alias("first"),
        F.format_string("L%d", F.col("user_id") % 8).alias("last"))


def daily_files(spark, sf_dir):
    """Sales written as one folder per day and reseller, CSV for some resellers and JSON with a nested
    customer for the others, then read back as one table."""
    sold = _sold(spark, sf_dir)
    folder = new_folder(spark, "daily")
    in_csv = F.col("reseller").isin(_CSV_SELLERS)
    parts = F.col("day").alias("file_day"), F.col("reseller").alias("file_reseller")
    as_csv = sold.filter(in_csv).select(
        F.col("event_id").alias("Transaction ID"), F.col("name").alias("Product name"),
        F.col("qty").alias("Quantity"), F.col("value").alias("Total amount"), F.lit("web").alias("Sales Channel"),
        F.col("first").alias("Customer First Name"), F.col("last").alias("Customer Last Name"),
        sales.email(F.col("first"), F.col("last")).alias("Customer Email"), F.lit("Rome").alias("Series City"),
        F.col("day").alias("Created Date"), F.col("reseller").alias("Reseller ID"), *parts)
    bare = F.replace("day", F.lit("-"), F.lit(""))
    as_json = sold.filter(~in_csv).select(
        bare.alias("date"), F.col("reseller").alias("reseller-id"), F.col("name").alias("productName"), "qty",
        F.col("value").alias("totalAmount"), F.lit("web").alias("salesChannel"),
        F.struct(F.col("first").alias("firstname"), F.col("last").alias("lastname"),
                 sales.email(F.col("first"), F.col("last")).alias("email")).alias("customer"),
        bare.alias("dateCreated"), F.lit("Rome").alias("seriesCity"), F.col("day").alias("Created Date"),
        F.col("event_id").alias("transactionId"), *parts)
    by = ["file_day", "file_reseller"]
    write_split(as_csv, f"{folder}/csv", by, "csv")
    write_split(as_json, f"{folder}/json", by, "json")
    split = [T.StructField(c, T.StringType()) for c in by]
    csv = read_csv(spark, f"{folder}/csv", T.StructType([*RESELLER_CSV.fields, *split]))
    json = read_payload(spark, f"{folder}/json", T.StructType([*RESELLER_JSON.fields, *split]))
    return csv.select(
        F.col("Transaction ID").alias("id"), F.col("file_reseller").alias("reseller"), F.col("file_day").alias("day"),
        F.col("Product name").alias("name"), F.col("Quantity").alias("qty"), F.col("Total amount").alias("amount"),
        F.col("Customer Email").alias("email"),
    ).unionByName(json.select(
        F.col("transactionId").alias("id"), F.col("file_reseller").alias("reseller"), F.col("file_day").alias("day"),
        F.col("productName").alias("name"), "qty", F.col("totalAmount").alias("amount"),
        F.col("customer.email").alias("email")))


def line_amount(spark, sf_dir):
    """Exact line amounts, as text with two decimals."""
    amount = sales.line_amount(F.col("l_extendedprice"), F.col("l_quantity"))
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", amount.cast("string").alias("amount"))


def csv_filter(spark, sf_dir):
    """Parts as compressed CSV, read back with inferred types and filtered."""
    folder = write_csv(table(spark, sf_dir, "part"), new_folder(spark, "csv"), "gzip")
    found = read_csv(spark, folder)
    return found.filter(F.col("p_size") > 10).withColumn("p_partkey", F.col("p_partkey").cast("bigint"))


def json_payload(spark, sf_dir):
    """Payloads that are arrays of objects, landed as text and read as a table."""
    events = table(spark, sf_dir, "events")
    objects = F.array(
        F.struct("event_id", F.lit("value").alias("name"), F.col("value").alias("amount")),
        F.struct("event_id", F.lit("k").alias("name"),
                 F.get_json_object("props", "$.k").cast("double").alias("amount")))
    folder = new_folder(spark, "payload")
    events.select(F.to_json(objects).alias("value")).write.text(folder)
    return read_payload(spark, folder, "event_id bigint, name string, amount double")


def time_partitioned_json(spark, sf_dir):
    """Events as documents below year/month/day folders, read back with their folder values."""
    folder = new_folder(spark, "documents")
    write_by_time(table(spark, sf_dir, "events").select("event_id", "props", "ts"), folder, F.col("ts"), "daily")
    schema = "event_id bigint, props string, year string, month string, day string"
    return read_payload(spark, folder, schema)


def object_listing(spark, sf_dir):
    """Events landed by type, then listed by extension: the folders found and whether their files hold bytes."""
    folder = write_split(table(spark, sf_dir, "events"), new_folder(spark, "listed"), ["event_type"])
    files = list_objects(spark, folder, "parquet")
    name = F.regexp_extract("path", "/(event_type=[^/]+)/[^/]+[.]parquet$", 1)
    return files.groupBy(name.alias("folder")).agg((F.min("length") > 0).alias("filled"))


def object_bytes(spark, sf_dir):
    """Suppliers as CSV objects of bounded size, read back as bytes; their rows counted by line ends."""
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    folder = write_csv(suppliers, new_folder(spark, "objects"), rows_per_file=100_000)
    text = F.col("content").cast("string")
    line_ends = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))
    return read_objects(spark, f"{folder}/*.csv").agg(F.sum(line_ends - 1).cast("bigint").alias("rows"))


def reject_split(spark, sf_dir):
    """Order text rows loaded into typed columns; rows that do not fit are counted by the column at fault."""
    orders = table(spark, sf_dir, "orders")
    raw = orders.select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.when(F.col("o_orderstatus") == "P", F.lit("pending")).otherwise(
            F.col("o_totalprice").cast("string")).alias("price"))
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("price", T.DoubleType())])
    tagged = tables.tag_rejects(raw, schema)
    fits = F.size("rejected_for") == 0
    return tagged.select(
        F.coalesce(F.col("row.id"), F.col("raw.id").try_cast("bigint")).alias("id"), F.col("row.price").alias("price"),
        F.when(~fits, F.array_join("rejected_for", ",")).alias("rejected_for"))


_CUSTOMER = T.StructType([
    T.StructField("customer_id", T.LongType()), T.StructField("name", T.StringType()),
    T.StructField("balance", T.DoubleType())])


def _customers(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))


def table_create_append(spark, sf_dir):
    """A table made from a declared schema, loaded by two appends, the second with its columns reordered."""
    folder = new_folder(spark, "table")
    name = "customer_" + folder[-12:]
    tables.create_if_missing(spark, name, _CUSTOMER, folder)
    assert table_exists(spark, name) and not tables.create_if_missing(spark, name, _CUSTOMER, folder)
    rows = _customers(spark, sf_dir)
    tables.append(rows.filter("balance < 5000"), name)
    tables.append(rows.filter("balance >= 5000").select("balance", "name", "customer_id"), name)
    return spark.table(name)


def truncate_load(spark, sf_dir):
    """A staging table emptied and loaded again: only the second load remains."""
    folder = new_folder(spark, "staging")
    name = "staging_" + folder[-12:]
    rows = _customers(spark, sf_dir)
    tables.create_if_missing(spark, name, empty_like(rows).schema, folder)
    tables.truncate_load(rows, name)
    tables.truncate_load(rows.withColumn("balance", F.col("balance") + 1), name)
    assert [c for c, _ in table_columns(spark, name)] == _CUSTOMER.names
    return spark.table(name)


def full_refresh(spark, sf_dir):
    """A typed table dropped and built again from the suppliers."""
    name = "supplier_" + new_folder(spark, "x")[-12:]
    schema = T.StructType([
        T.StructField("supplier_id", T.IntegerType()), T.StructField("name", T.StringType())])
    rows = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("supplier_id"), F.col("s_name").alias("name"))
    tables.full_refresh(rows, name, schema, new_folder(spark, "first"))
    return tables.full_refresh(rows.withColumn("name", F.upper("name")), name, schema, new_folder(spark, "second"))


def dedupe_first(spark, sf_dir):
    """First order of every customer by date, then number."""
    return first_by_key(
        table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate"),
        ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey", "o_totalprice")


QUERIES = {f.__name__: f for f in (
    product_catalogue, calendar_split, reseller_commission, calendar_days, daily_sequence, daily_files, line_amount, csv_filter,
    json_payload, time_partitioned_json, object_listing, object_bytes, reject_split, table_create_append,
    truncate_load, full_refresh, dedupe_first,
)}


def _list(values):
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


ORACLES = {
    "object_listing": "SELECT DISTINCT 'event_type=' || event_type AS folder, true AS filled FROM events",
    "product_catalogue": f"""WITH f AS (SELECT unnest({_list(PRODUCT_FORMATS)}) AS format,
            unnest(range({len(PRODUCT_FORMATS)})) AS fi),
        t AS (SELECT unnest({_list(PRODUCT_TEXTS)}) AS text, unnest(range({len(PRODUCT_TEXTS)})) AS ti),
        c AS (SELECT p_name AS city, row_number() OVER (ORDER BY p_name) AS ci FROM (SELECT DISTINCT p_name FROM part))
        SELECT row_number() OVER (ORDER BY fi, ti, ci) AS product_id, format || ' ' || text || ' ' || city AS name, city
        FROM f, t, c""",
    "calendar_split": """SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS day,
        'DailySales_' || strftime(o_orderdate, '%Y%d%m') || '_' || o_custkey || '.csv' AS file,
        strftime(o_orderdate, '%Y-%m-%d') AS file_day, CAST(o_custkey AS VARCHAR) AS file_reseller FROM orders
        WHERE o_orderdate >= DATE '1996-01-01' AND o_orderdate < DATE '2001-01-01'""",
    "reseller_commission": """WITH r AS (SELECT * FROM (VALUES (1001, 'Imaginary Street Press Company', 0.15),
            (1002, 'European Example Press Corporation', 0.17), (1003, 'Scandinavian Legendary Printing Company', 0.14),
            (1004, 'Mediterranean Postcard Press Association', 0.16)) AS v(id, name, pct))
        SELECT o_orderkey, name AS reseller_name, CAST(CAST(CAST(o_totalprice AS DECIMAL(19,2))
        * CAST(pct AS DECIMAL(5,4)) AS DECIMAL(19,4)) AS DOUBLE) AS commission
        FROM orders LEFT JOIN r ON CAST(left(o_orderpriority, 1) AS INTEGER) + 1000 = id""",
    "calendar_days": """SELECT strftime(d.day, '%Y-%m-%d') AS day, COUNT(o_orderkey) AS orders FROM
        (SELECT unnest(generate_series(TIMESTAMP '1996-01-01', TIMESTAMP '2000-12-31', INTERVAL 1 DAY)) AS day) d
        LEFT JOIN orders ON CAST(o_orderdate AS DATE) = CAST(d.day AS DATE) GROUP BY d.day""",
    "daily_sequence": """SELECT o_orderpriority, o_orderkey, row_number() OVER
        (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey) - 1 AS transaction_id FROM orders""",
    "daily_files": """SELECT event_id AS id, event_type AS reseller, strftime(ts, '%Y-%m-%d') AS day,
        'item ' || user_id AS name, CAST(user_id % 6 + 1 AS INTEGER) AS qty, value AS amount,
        'F' || (user_id % 9) || '.L' || (user_id % 8) || '@example.com' AS email FROM events""",
    "line_amount": """SELECT l_orderkey, l_linenumber, l_partkey, CAST(CAST(CAST(l_extendedprice AS DECIMAL(15,2))
        * CAST(l_quantity AS DECIMAL(10,0)) AS DECIMAL(19,2)) AS VARCHAR) AS amount FROM lineitem""",
    "csv_filter": "SELECT * FROM part WHERE p_size > 10",
    "json_payload": """SELECT event_id, 'value' AS name, value AS amount FROM events UNION ALL
        SELECT event_id, 'k', CAST(json_extract_string(props, '$.k') AS DOUBLE) FROM events""",
    "time_partitioned_json": """SELECT event_id, props, strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month,
        strftime(ts, '%d') AS day FROM events""",
    "object_bytes": "SELECT COUNT(*) AS rows FROM supplier",
    "reject_split": """SELECT o_orderkey AS id, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS price,
        CASE WHEN o_orderstatus = 'P' THEN 'price' END AS rejected_for FROM orders""",
    "table_create_append": "SELECT c_custkey AS customer_id, c_name AS name, c_acctbal AS balance FROM customer",
    "truncate_load": "SELECT c_custkey AS customer_id, c_name AS name, c_acctbal + 1 AS balance FROM customer",
    "full_refresh": "SELECT CAST(s_suppkey AS INTEGER) AS supplier_id, upper(s_name) AS name FROM supplier",
    "dedupe_first": """SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER
        (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS n FROM orders) WHERE n = 1""",
}
