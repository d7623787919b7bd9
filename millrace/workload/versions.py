"""Histories over `customer`, and the model registry over the event feeds."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from ..functions.times import moment
from ..operators import versioned
from ..plans.models import check_models, run_models
from ..session import new_folder
from ..sources.catalog import Sources
from .tables import feed, feed_sql, table

_DAYS = [datetime(2024, 10, day) for day in range(1, 7)]


def _commits(spark):
    """Two appends and a replacement; commits 2 and 4 only added and renamed a column."""
    kinds = {1: "append", 3: "append", 5: "overwrite"}
    rows = [F.struct(F.lit(k).cast("bigint").alias("snapshot_id"), moment(_DAYS[k]).alias("committed_at"),
                     F.lit(kind).alias("operation")) for k, kind in kinds.items()]
    return spark.range(1, numPartitions=1).select(F.inline(F.array(*rows)))


def _history(spark, sf_dir):
    """Customers as they were added by each commit, with all columns that ever were."""
    rows = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"),
        F.col("c_mktsegment").alias("segment"))
    early = rows.filter("balance < 3000").withColumn("segment", F.lit(None).cast("string"))

    def added(df, first, last):
        return df.withColumns({versioned.ADDED: F.lit(first), versioned.REMOVED: F.lit(last).cast("int")})
    first = added(early, 1, 5).unionByName(added(rows.filter("balance >= 3000"), 3, 5))
    return first.unionByName(added(rows.withColumn("name", F.upper("name")), 5, None))


def vt_current(spark, sf_dir):
    return versioned.current_rows(_history(spark, sf_dir)).withColumnRenamed("segment", "market")


def vt_as_of_version(spark, sf_dir):
    return versioned.rows_at_version(_history(spark, sf_dir), 1).drop("segment")


def vt_renamed(spark, sf_dir):
    return versioned.rows_at_version(_history(spark, sf_dir), 4).withColumnRenamed("segment", "market")


def vt_as_of_time(spark, sf_dir):
    """A time seven hours east of UTC, just after the second append."""
    at = (_DAYS[3] + timedelta(hours=7, minutes=1)).replace(tzinfo=timezone(timedelta(hours=7)))
    return versioned.rows_at_time(_history(spark, sf_dir), _commits(spark), at)


def vt_snapshots(spark, sf_dir):
    return versioned.rows_per_commit(_history(spark, sf_dir), _commits(spark))


_RAW = {"listen_events": "raw_listen", "auth_events": "raw_auth", "page_view_events": "raw_page_view"}
_CUT = 1705276800  # 2024-01-15 00:00:00


def _sources(sf_dir, before: int | None = None) -> Sources:
    sources = Sources()
    for name, raw in _RAW.items():
        def read(spark, raw=raw):
            df = feed(spark, sf_dir, raw)
            return df if before is None else df.filter(F.col("ts") < before)
        sources.add(name, read)
    return sources


def model_run_checks(spark, sf_dir):
    """The whole registry built, then its data checks."""
    return check_models(run_models(spark, _sources(sf_dir), new_folder(spark, "models")))


def model_second_run(spark, sf_dir):
    """A mart after two runs, the second of which loads only what came after the first."""
    folder, only = new_folder(spark, "models"), {"mart_user_level_by_gender"}
    run_models(spark, _sources(sf_dir, _CUT), folder, only=only)
    return run_models(spark, _sources(sf_dir), folder, only=only)["mart_user_level_by_gender"]


def federated_query(spark, sf_dir):
    """SQL over two named sources registered as views."""
    sources = _sources(sf_dir)
    sources.add("users", lambda s: table(s, sf_dir, "customer").select("c_custkey", "c_mktsegment"))
    sources.register_views(spark)
    return spark.sql("""
        SELECT u.c_mktsegment AS segment, SUM(l.n) AS plays
        FROM (SELECT CAST(CAST(NULLIF(userId, '') AS DOUBLE) AS BIGINT) AS user, COUNT(*) AS n
              FROM listen_events GROUP BY 1) l
        JOIN users u ON u.c_custkey = l.user GROUP BY u.c_mktsegment""")


QUERIES = {f.__name__: f for f in (
    vt_current, vt_as_of_version, vt_renamed, vt_as_of_time, vt_snapshots, model_run_checks, model_second_run,
    federated_query,
)}

_BASE = "c_custkey AS customer_id, c_name AS name, c_acctbal AS balance"
_LATER = f"SELECT {_BASE}, CASE WHEN c_acctbal >= 3000 THEN c_mktsegment END AS {{}} FROM customer"
_USER = "CAST(FLOOR(CAST(NULLIF(userId, '') AS DOUBLE)) AS INTEGER)"

ORACLES = {
    "vt_current": """SELECT c_custkey AS customer_id, upper(c_name) AS name, c_acctbal AS balance,
        c_mktsegment AS market FROM customer""",
    "vt_as_of_version": f"SELECT {_BASE} FROM customer WHERE c_acctbal < 3000",
    "vt_renamed": _LATER.format("market"),
    "vt_as_of_time": _LATER.format("segment"),
    "vt_snapshots": """SELECT * FROM (
        SELECT CAST(1 AS BIGINT) AS snapshot_id, TIMESTAMP '2024-10-02' AS committed_at, 'append' AS operation,
            (SELECT COUNT(*) FROM customer WHERE c_acctbal < 3000) AS added_rows UNION ALL
        SELECT 3, TIMESTAMP '2024-10-04', 'append', (SELECT COUNT(*) FROM customer WHERE c_acctbal >= 3000) UNION ALL
        SELECT 5, TIMESTAMP '2024-10-06', 'overwrite', (SELECT COUNT(*) FROM customer))""",
    "model_run_checks": f"""{feed_sql("raw_auth")}
        SELECT 'not_null_ts' AS "check", COUNT(*) FILTER (ts IS NULL) AS failures FROM raw_auth UNION ALL
        SELECT 'not_null_sessionId', COUNT(*) FILTER (sessionId IS NULL) FROM raw_auth UNION ALL
        SELECT 'not_null_itemInSession', COUNT(*) FILTER (itemInSession IS NULL) FROM raw_auth UNION ALL
        SELECT 'accepted_values_level', COUNT(*) FILTER (level NOT IN ('free', 'paid')) FROM raw_auth UNION ALL
        SELECT 'accepted_values_gender', COUNT(*) FILTER (gender NOT IN ('F', 'M')) FROM raw_auth UNION ALL
        SELECT 'accepted_values_success_boolean', COUNT(*) FILTER (success NOT IN ('t', 'f')) FROM raw_auth UNION ALL
        SELECT 'unique_sessionId', COUNT(*) FROM (SELECT sessionId FROM raw_auth WHERE sessionId IS NOT NULL
            GROUP BY sessionId HAVING COUNT(*) > 1) UNION ALL
        SELECT 'unique_userId', COUNT(*) FROM (SELECT {_USER} AS u FROM raw_auth WHERE {_USER} IS NOT NULL
            GROUP BY 1 HAVING COUNT(*) > 1)""",
    "model_second_run": f"""{feed_sql("raw_auth")},
        loaded AS (SELECT * FROM raw_auth WHERE ts < {_CUT} OR ts > (SELECT max(ts) FROM raw_auth WHERE ts < {_CUT})),
        levels AS (SELECT gender, level, COUNT(DISTINCT {_USER}) AS n FROM loaded
            WHERE gender IS NOT NULL AND level IS NOT NULL GROUP BY gender, level)
        SELECT gender, level, CAST(n AS BIGINT) AS total_users, ROUND(CAST(n AS DOUBLE) * 100.0
        / CAST((SELECT SUM(n) FROM levels) AS DOUBLE), 2) AS percentage_of_total_users FROM levels""",
    "federated_query": f"""{feed_sql("raw_listen")}, l AS (SELECT CAST(TRUNC(CAST(NULLIF(userId, '') AS DOUBLE)) AS BIGINT)
            AS u, COUNT(*) AS n FROM raw_listen GROUP BY 1)
        SELECT c_mktsegment AS segment, CAST(SUM(n) AS BIGINT) AS plays FROM l JOIN customer ON c_custkey = u GROUP BY c_mktsegment""",
}
