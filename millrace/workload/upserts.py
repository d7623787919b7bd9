"""Incremental loads, change detection, merges and data checks over whole tables."""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.times import moment
from ..operators import incremental, quality, stored, upsert
from ..session import new_folder, settle
from ..sinks.tables import publish
from .tables import table

AT = datetime(2024, 5, 1, 12, 0, 0)
EARLIER = datetime(2020, 1, 1)
# Keys of a range of the stored orders.
_RANGE = 5000
AT_SQL = "TIMESTAMP '2024-05-01 12:00:00'"
EARLIER_SQL = "TIMESTAMP '2020-01-01 00:00:00'"

# Orders up to the cut-off are already in the target; every order arrives in the staging table, finished
# ones with a new price and a missing priority where it was not specified.
CUT = "TIMESTAMP_NTZ'2000-01-01 00:00:00'"
_STAGED_PRICE = "CASE WHEN o_orderstatus = 'F' THEN o_totalprice + 1 ELSE o_totalprice END"
_STAGED_PRIORITY = "CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN {0} ELSE o_orderpriority END"


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp_ntz"))


def _target(spark, sf_dir, stamps: tuple[str, ...] = ()):
    """Orders before the cut-off; a missing priority reads ''."""
    old = _orders(spark, sf_dir).filter(F.col("o_orderdate") < F.expr(CUT))
    old = old.withColumn("o_orderpriority", F.expr(_STAGED_PRIORITY.format("''")))
    for name in stamps:
        old = old.withColumn(name, moment(EARLIER))
    return old


def _staging(spark, sf_dir):
    """All orders; a missing priority is NULL, which is no change against ''."""
    return _orders(spark, sf_dir).withColumns({
        "o_totalprice": F.expr(_STAGED_PRICE),
        "o_orderpriority": F.expr(_STAGED_PRIORITY.format("CAST(NULL AS STRING)")),
    })


def incremental_new_rows(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    loaded = events.filter(F.col("ts") < F.expr("TIMESTAMP_NTZ'2024-01-15 00:00:00'"))
    return incremental.new_rows(events, loaded, "ts")


def incremental_include_ties(spark, sf_dir):
    orders = _orders(spark, sf_dir)
    return incremental.new_rows(orders, _target(spark, sf_dir), "o_orderdate", late="include_ties")


def incremental_append(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    loaded = events.filter(F.col("ts") < F.expr("TIMESTAMP_NTZ'2024-01-15 00:00:00'"))
    return incremental.load_increment(events, loaded, "ts")


def incremental_merge(spark, sf_dir):
    return incremental.load_increment(
        _staging(spark, sf_dir), _target(spark, sf_dir), "o_orderdate", ["o_orderkey"], late="include_ties")


def upsert_changes(spark, sf_dir):
    return upsert.detect_changes(_staging(spark, sf_dir), _target(spark, sf_dir), "o_orderkey", ("o_custkey",))


def upsert_applied(spark, sf_dir):
    staging = _staging(spark, sf_dir).withColumn("o_custkey", F.col("o_custkey") + 1)
    return upsert.upsert(_target(spark, sf_dir), staging, "o_orderkey", ignore=("o_custkey",))


def merge_audited(spark, sf_dir):
    target = _target(spark, sf_dir, ("created_at", "updated_at"))
    return upsert.merge(target, _staging(spark, sf_dir), ["o_orderkey", "o_custkey"], "created_updated", AT)


def merge_last_updated(spark, sf_dir):
    target = _target(spark, sf_dir, ("LAST_UPDATED_DT",))
    return upsert.merge(target, _staging(spark, sf_dir), ["o_orderkey"], "last_updated", AT)


def merge_plain(spark, sf_dir):
    return upsert.merge(_target(spark, sf_dir), _staging(spark, sf_dir), ["o_orderkey"])


def merge_latest(spark, sf_dir):
    """One row per customer: the latest order wins, and customers already known are updated. Some customers'
    orders have no date, and orders of one month tie; then the largest order number wins."""
    stamp = F.when(F.col("o_custkey") % 7 != 0, F.date_trunc("MONTH", "o_orderdate").cast("timestamp_ntz"))
    orders = _orders(spark, sf_dir).select("o_custkey", stamp.alias("stamp"), "o_orderkey", "o_totalprice")
    known = table(spark, sf_dir, "customer").filter("c_acctbal < 5000").select(
        F.col("c_custkey").alias("o_custkey"), F.lit(None).cast("bigint").alias("o_orderkey"),
        F.col("c_acctbal").alias("o_totalprice"))
    return upsert.merge(known, orders, ["o_custkey"], latest_by="stamp")


def merge_committed(spark, sf_dir):
    """A merge into a stored table: the result goes to a folder of its own, the old one stays for its readers."""
    folder = new_folder(spark, "orders")
    _target(spark, sf_dir, ("LAST_UPDATED_DT",)).write.parquet(f"{folder}/1")
    kept = spark.read.parquet(f"{folder}/1")
    upsert.merge(kept, _staging(spark, sf_dir), ["o_orderkey"], "last_updated", AT).write.parquet(f"{folder}/2")
    return spark.read.schema(kept.schema).parquet(f"{folder}/2")


def merge_stored_ranges(spark, sf_dir):
    """A merge in place: orders of every third range of keys arrive, and only these ranges are written again."""
    folder, width = new_folder(spark, "ranges"), _RANGE
    target = _target(spark, sf_dir, ("LAST_UPDATED_DT",))
    stored.store(target, folder, "o_orderkey", width)
    arrived = _staging(spark, sf_dir).filter(f"o_orderkey div {width} % 3 = 0")
    stored.merge_stored(spark, folder, target.schema, arrived, ["o_orderkey"], width, "last_updated", AT)
    return stored.read_stored(spark, folder, target.schema).drop(stored.PART)


def insert_if_absent(spark, sf_dir):
    target = _target(spark, sf_dir, ("created_at", "updated_at"))
    return upsert.insert_if_absent(target, _staging(spark, sf_dir), ["o_orderkey"], at=AT)


def apply_flagged(spark, sf_dir):
    target = _target(spark, sf_dir)
    changes = settle(upsert.detect_changes(_staging(spark, sf_dir), target, "o_orderkey"), "changes")
    return upsert.apply_flagged(target, changes, ["o_orderkey"])


def _control(spark, sf_dir):
    """One control row per customer with orders; the last run is the customer's latest order."""
    return _orders(spark, sf_dir).groupBy(F.col("o_custkey").cast("string").alias("PKG_NAME")).agg(
        F.lit(1).alias("STATUS"),
        F.min("o_orderdate").alias("START_DT"),
        F.max("o_orderdate").alias("END_DT"),
        F.max("o_orderdate").alias("LAST_RUN_DT"))


def tracking_cycle(spark, sf_dir):
    """All packages start and finish; one of them starts a second run."""
    started = incremental.begin_run(_control(spark, sf_dir), AT)
    finished = incremental.finish_run(started, datetime(2024, 5, 1, 13, 0, 0))
    return incremental.begin_run(finished, datetime(2024, 5, 2), package="10")


def dq_not_null(spark, sf_dir):
    return quality.row_checks(table(spark, sf_dir, "events"), [quality.not_null("ts"), quality.not_null("user_id")])


def dq_unique(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return quality.check_table(events, [], ("event_id", "user_id"))


def dq_accepted_values(spark, sf_dir):
    return quality.row_checks(_staging(spark, sf_dir), [
        quality.accepted_values("o_orderstatus", ["F", "O"]),
        quality.accepted_values("o_orderpriority", ["1-URGENT", "2-HIGH"]),
    ])


def published_after_checks(spark, sf_dir):
    """A load that passes its checks is published; one with missing priorities is refused, and readers keep the first."""
    checks = [quality.not_null("o_orderkey"), quality.not_null("o_orderpriority")]
    folder = new_folder(spark, "published")
    name = folder.rsplit("/", 1)[1].replace("-", "_")
    publish(_target(spark, sf_dir), name, f"{folder}/1", checks)
    refused = 0
    try:
        publish(_staging(spark, sf_dir), name, f"{folder}/2", checks)
    except quality.CheckFailed as failed:
        refused = failed.failures["not_null_o_orderpriority"]
    return spark.table(name).withColumn("refused", F.lit(refused).cast("bigint"))


SUITE = json.dumps({
    "expectation_suite_name": "orders_suite",
    "expectations": [
        {"expectation_type": quality.NOT_NULL, "kwargs": {"column": c}} for c in ("o_orderkey", "o_orderpriority")
    ],
})


def dq_suite(spark, sf_dir):
    return quality.run_suite(_staging(spark, sf_dir), SUITE)


QUERIES = {f.__name__: f for f in (
    incremental_new_rows, incremental_include_ties, incremental_append, incremental_merge, upsert_changes,
    upsert_applied, merge_audited, merge_last_updated, merge_plain, merge_latest, merge_committed, merge_stored_ranges, insert_if_absent, apply_flagged,
    tracking_cycle, dq_not_null, dq_unique, dq_accepted_values, dq_suite,
    published_after_checks,
)}

_CUT_SQL = "TIMESTAMP '2000-01-01 00:00:00'"
_SIDES = f"""WITH target AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
    {_STAGED_PRIORITY.format("''")} AS o_orderpriority FROM orders WHERE o_orderdate < {_CUT_SQL}),
    staging AS (SELECT o_orderkey, o_custkey, o_orderstatus, {_STAGED_PRICE} AS o_totalprice, o_orderdate,
    {_STAGED_PRIORITY.format("NULL")} AS o_orderpriority FROM orders)"""
_CHANGED = """(COALESCE(s.o_orderstatus, '') <> COALESCE(t.o_orderstatus, '')
    OR COALESCE(s.o_totalprice, 0) <> COALESCE(t.o_totalprice, 0)
    OR COALESCE(CAST(s.o_orderdate AS VARCHAR), '') <> COALESCE(CAST(t.o_orderdate AS VARCHAR), '')
    OR COALESCE(s.o_orderpriority, '') <> COALESCE(t.o_orderpriority, ''))"""
_LEFT = "FROM staging s LEFT JOIN target t ON s.o_orderkey = t.o_orderkey"

ORACLES = {
    "incremental_new_rows": """SELECT * FROM events WHERE ts >
        (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '2024-01-15 00:00:00')""",
    "incremental_include_ties": f"""SELECT * FROM orders WHERE o_orderdate >=
        (SELECT max(o_orderdate) FROM orders WHERE o_orderdate < {_CUT_SQL})""",
    "incremental_append": """WITH loaded AS (SELECT * FROM events WHERE ts < TIMESTAMP '2024-01-15 00:00:00')
        SELECT * FROM loaded UNION ALL SELECT * FROM events WHERE ts > (SELECT max(ts) FROM loaded)""",
    "incremental_merge": f"""{_SIDES}, fresh AS (SELECT * FROM staging WHERE o_orderdate >=
            (SELECT max(o_orderdate) FROM target))
        SELECT * FROM fresh UNION ALL
        SELECT * FROM target WHERE o_orderkey NOT IN (SELECT o_orderkey FROM fresh)""",
    "upsert_changes": f"""{_SIDES} SELECT s.*, CASE WHEN t.o_orderkey IS NULL THEN 'I' ELSE 'U' END AS "RECORD_STATUS"
        {_LEFT} WHERE t.o_orderkey IS NULL OR {_CHANGED}""",
    "upsert_applied": f"""{_SIDES}
        SELECT s.o_orderkey, COALESCE(t.o_custkey, s.o_custkey + 1) AS o_custkey, s.o_orderstatus, s.o_totalprice,
        s.o_orderdate, CASE WHEN t.o_orderkey IS NULL OR {_CHANGED} THEN s.o_orderpriority ELSE t.o_orderpriority
        END AS o_orderpriority {_LEFT}""",
    "merge_audited": f"""{_SIDES} SELECT s.*, CASE WHEN t.o_orderkey IS NULL THEN {AT_SQL} ELSE {EARLIER_SQL} END
        AS created_at, {AT_SQL} AS updated_at {_LEFT}""",
    "merge_last_updated": f"""{_SIDES} SELECT s.*, {AT_SQL} AS "LAST_UPDATED_DT" FROM staging s""",
    "merge_plain": f"{_SIDES} SELECT * FROM staging",
    "merge_committed": f"""{_SIDES} SELECT s.*, {AT_SQL} AS "LAST_UPDATED_DT" FROM staging s""",
    "merge_stored_ranges": f"""{_SIDES} SELECT s.*, {AT_SQL} AS "LAST_UPDATED_DT" FROM staging s WHERE o_orderkey // {_RANGE} % 3 = 0
        UNION ALL SELECT t.*, {EARLIER_SQL} FROM target t WHERE o_orderkey // {_RANGE} % 3 <> 0""",
    "merge_latest": """WITH latest AS (SELECT o_custkey, o_orderkey, o_totalprice, row_number() OVER
            (PARTITION BY o_custkey ORDER BY CASE WHEN o_custkey % 7 <> 0 THEN date_trunc('month', o_orderdate) END
            DESC NULLS LAST, o_orderkey DESC) AS n FROM orders)
        SELECT o_custkey, o_orderkey, o_totalprice FROM latest WHERE n = 1 UNION ALL
        SELECT c_custkey, NULL, c_acctbal FROM customer WHERE c_acctbal < 5000
        AND c_custkey NOT IN (SELECT o_custkey FROM orders)""",
    "insert_if_absent": f"""{_SIDES}
        SELECT *, {EARLIER_SQL} AS created_at, {EARLIER_SQL} AS updated_at FROM target UNION ALL
        SELECT s.*, {AT_SQL}, {AT_SQL} {_LEFT} WHERE t.o_orderkey IS NULL""",
    "apply_flagged": f"""{_SIDES}
        SELECT s.o_orderkey, s.o_custkey, s.o_orderstatus, s.o_totalprice, s.o_orderdate,
        CASE WHEN t.o_orderkey IS NULL OR {_CHANGED} OR s.o_custkey <> t.o_custkey THEN s.o_orderpriority
        ELSE t.o_orderpriority END AS o_orderpriority {_LEFT}""",
    "tracking_cycle": f"""SELECT CAST(o_custkey AS VARCHAR) AS "PKG_NAME",
        CASE WHEN o_custkey = 10 THEN -1 ELSE 1 END AS "STATUS",
        CASE WHEN o_custkey = 10 THEN TIMESTAMP '2024-05-02 00:00:00' ELSE {AT_SQL} END AS "START_DT",
        TIMESTAMP '2024-05-01 13:00:00' AS "END_DT", {AT_SQL} AS "LAST_RUN_DT" FROM orders GROUP BY o_custkey""",
    "dq_not_null": """SELECT 'not_null_ts' AS "check", COUNT(*) FILTER (ts IS NULL) AS failures FROM events
        UNION ALL SELECT 'not_null_user_id', COUNT(*) FILTER (user_id IS NULL) FROM events""",
    "dq_unique": """SELECT 'unique_event_id' AS "check", COUNT(*) AS failures FROM
            (SELECT event_id FROM events GROUP BY event_id HAVING COUNT(*) > 1) UNION ALL
        SELECT 'unique_user_id', COUNT(*) FROM (SELECT user_id FROM events GROUP BY user_id HAVING COUNT(*) > 1)""",
    "dq_accepted_values": f"""{_SIDES}
        SELECT 'accepted_values_o_orderstatus' AS "check",
        COUNT(*) FILTER (o_orderstatus NOT IN ('F', 'O')) AS failures FROM staging UNION ALL
        SELECT 'accepted_values_o_orderpriority',
        COUNT(*) FILTER (o_orderpriority NOT IN ('1-URGENT', '2-HIGH')) FROM staging""",
    "published_after_checks": f"""{_SIDES} SELECT t.*,
        (SELECT COUNT(*) FROM staging WHERE o_orderpriority IS NULL) AS refused FROM target t""",
    "dq_suite": f"""{_SIDES}, counted AS (
        SELECT 'o_orderkey' AS "column", COUNT(*) AS n, COUNT(*) FILTER (o_orderkey IS NULL) AS bad FROM staging
        UNION ALL SELECT 'o_orderpriority', COUNT(*), COUNT(*) FILTER (o_orderpriority IS NULL) FROM staging)
        SELECT '{quality.NOT_NULL}' AS expectation_type, "column", n AS element_count, bad AS unexpected_count,
        ROUND(CAST(bad AS DOUBLE) * 100.0 / n, 4) AS unexpected_percent, bad = 0 AS success FROM counted""",
}
