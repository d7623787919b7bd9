"""Column steps, quality checks, sinks, sources, versioned tables and the model registry."""

import json
from collections import Counter
from datetime import datetime, timedelta, timezone

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import session
from millrace.operators import aggregates, columns, quality, versioned
from millrace.operators import files as file_operators
from millrace.plans import marts, models, trips
from millrace.sinks import files as file_sinks
from millrace.sinks import tables
from millrace.sources import catalog, files, jdbc


def rows(df):
    return sorted([tuple(r) for r in df.collect()], key=repr)


# --- columns and trips ------------------------------------------------------------------------------

def test_column_steps(spark):
    df = spark.createDataFrame([(1, None, 2.0), (2, "x", float("nan"))], "b int, `A b` string, c double")
    assert columns.upper_names(df).columns == ["B", "A_B", "C"]
    assert columns.rename(df, {"B": "no", "b": "z"}).columns == ["z", "A b", "c"]
    assert columns.sort_columns(df).columns == ["A b", "b", "c"]
    assert columns.drop_columns_with_nulls(df).columns == ["b"]
    assert columns.drop_rows_with_nulls(df).count() == 0
    assert columns.drop_if_present(df, "c", "none").columns == ["b", "A b"]
    assert columns.cast_payment_type(df) is df
    with pytest.raises(ValueError, match="missing"):
        columns.align_to(df, T.StructType([T.StructField("d", T.IntegerType())]))


def test_trip_names_by_colour(spark):
    green = spark.createDataFrame([(1, 2, 3, 4.0)], "lpep_pickup_datetime int, trip_type int, ehail_fee int, Airport_fee double")
    assert trips.normalise(green, "green").columns == ["pickup_datetime", "airport_fee"]
    yellow = spark.createDataFrame([(1, 2, 3)], "tpep_pickup_datetime int, trip_type int, airport_fee int")
    assert trips.normalise(yellow, "yellow").columns == ["pickup_datetime", "trip_type"]
    with pytest.raises(ValueError, match="unknown step"):
        trips.apply_steps(green, "green", ("polish",))
    flagged = spark.createDataFrame([("N", 1, None)], "store_and_fwd_flag string, a int, b int")
    assert trips.apply_steps(flagged, "yellow", ("drop_column",)).columns == ["a"]


def test_shares_and_running_totals(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "g string, n bigint")
    assert rows(aggregates.share_of_total(df, "n", "p")) == [("a", 1, 33.33), ("b", 2, 66.67)]
    hours = spark.createDataFrame([("d", "01", 5), ("d", "00", 2), ("e", "00", 1)], "day string, hour string, n bigint")
    total = aggregates.running_total(hours, "n", ["day"], ["hour"], "t")
    assert rows(total.select("day", "hour", "t")) == [("d", "00", 2), ("d", "01", 7), ("e", "00", 1)]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(counts=st.lists(st.integers(1, 1000), min_size=1, max_size=12))
def test_shares_add_up_and_totals_end_at_the_sum(spark, counts):
    df = spark.createDataFrame([("d", f"{i:02d}", n) for i, n in enumerate(counts)], "day string, hour string, n bigint")
    shares = [r.p for r in aggregates.share_of_total(df, "n", "p").collect()]
    assert abs(sum(shares) - 100) <= 0.005 * len(counts) + 1e-9
    total = aggregates.running_total(df, "n", ["day"], ["hour"], "t")
    assert total.agg(F.max_by("t", "hour")).first()[0] == sum(counts)


def test_unique_users_of_nothing(spark):
    assert rows(marts.stg_unique_users(spark.createDataFrame([], "userId int"))) == [(0,)]


# --- checks -----------------------------------------------------------------------------------------

def test_checks_ignore_nulls(spark):
    df = spark.createDataFrame([(1, "M"), (1, None), (None, "X"), (None, "F")], "k int, g string")
    found = quality.check_table(df, [quality.not_null("k"), quality.accepted_values("g", ["M", "F"])], ("k",))
    assert rows(found) == [("accepted_values_g", 1), ("not_null_k", 2), ("unique_k", 1)]
    with pytest.raises(quality.CheckFailed, match="not_null_k: 2"):
        quality.gate(found)
    assert quality.gate(quality.row_checks(df, [quality.accepted_values("g", ["M", "F", "X"])])).count() == 1


def test_suite(spark, tmp_path):
    suite = json.dumps({"expectations": [{"expectation_type": quality.NOT_NULL, "kwargs": {"column": "vendorid"}}]})
    df = spark.createDataFrame([(1,), (None,), (2,), (3,)], "vendorid int")
    assert rows(quality.run_suite(df, suite)) == [(quality.NOT_NULL, "vendorid", 4, 1, 25.0, False)]
    assert rows(quality.run_suite(df.limit(0), suite)) == [(quality.NOT_NULL, "vendorid", 0, 0, 0.0, True)]
    (tmp_path / "suite.json").write_text(suite)
    assert quality.read_suite(spark, str(tmp_path / "suite.json")) == suite
    with pytest.raises(ValueError, match="unknown expectation"):
        quality.run_suite(df, suite.replace("not_be_null", "be_null"))


# --- sinks and sources ------------------------------------------------------------------------------

def test_ddl():
    schema = T.StructType([
        T.StructField("a", T.LongType()), T.StructField("b", T.FloatType()), T.StructField("c", T.BooleanType()),
        T.StructField("d", T.TimestampType()), T.StructField("e", T.DateType())])
    assert tables.create_statement("DW", "t", schema, warehouse=True) == (
        'CREATE TABLE "DW"."T" ("A" INTEGER, "B" DOUBLE, "C" TINYINT, "D" TIMESTAMP, "E" VARCHAR(255))')
    exact = T.StructType([*schema.fields, T.StructField("f", T.DecimalType(20, 4)), T.StructField("g", T.StringType())])
    assert tables.create_statement("DW", "t", exact) == (
        'CREATE TABLE "DW"."T" ("A" BIGINT, "B" REAL, "C" BOOLEAN, "D" TIMESTAMP, "E" DATE, "F" DECIMAL(20,4), "G" TEXT)')


def test_created_column_types():
    schema = T.StructType([T.StructField("a b", T.LongType()), T.StructField("c", T.StringType())])
    assert tables.created_types(schema, warehouse=True) == {"createTableColumnTypes": "`a b` INTEGER, `c` VARCHAR(255)"}
    assert tables.created_types(schema) == {}


def test_sample_keeps_values_and_orders_only_the_last_range(spark):
    rows_in = [(k, -0.0 if k % 2 else 0.0, "f") for k in range(500)] + [(7, -0.0, "f")] * 300 + [(1, 1.0, "g")]
    df = spark.createDataFrame(rows_in, "k int, v double, file string")
    got = [(r.k, str(r.v)) for r in file_operators.sample_per_file(df, "file", 400, ["k"]).collect()]
    import hashlib
    order = sorted(((hashlib.md5(str(k).encode()).hexdigest(), k, str(v)) for k, v, f in rows_in if f == "f"))
    assert sorted(got) == sorted((k, v) for _, k, v in order[:400])


def test_refresh_keeps_the_table_when_the_write_fails(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.IntegerType())])
    name = "refreshed_" + tmp_path.name.replace("-", "_")
    tables.full_refresh(spark.range(3), name, schema, str(tmp_path / "one"))
    bad = spark.range(3).selectExpr("IF(id = 2, raise_error('broken'), id) AS id")
    with pytest.raises(Exception, match="broken"):
        tables.full_refresh(bad, name, schema, str(tmp_path / "two"))
    assert spark.table(name).count() == 3
    assert tables.full_refresh(spark.range(5), name, schema, str(tmp_path / "three")).count() == 5
    spark.sql(f"DROP TABLE {name}")


def test_equal_measures_spread_over_tasks(spark):
    plays = spark.range(20_000, numPartitions=4).selectExpr("id AS song", "1 AS n")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = aggregates.top_k(plays, "n").rdd.glom().map(len).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert max(sizes) < 10_000 and sum(sizes) == 20_000


def test_jdbc_options():
    assert jdbc.query_options("u", "select 1") == {"url": "u", "query": "select 1"}
    assert jdbc.split_options("u", "t", "id", 0, 10, 4)["numPartitions"] == "4"
    with pytest.raises(ValueError):
        jdbc.split_options("u", "t", "id", 5, 5, 4)


class Recorder:
    """Stands in for a DataFrame writer and remembers what was asked of it."""

    def __init__(self):
        self.seen = {}

    def repartition(self, n):
        self.seen["parts"] = n
        return self

    write = property(lambda self: self)

    def format(self, name):
        self.seen["format"] = name
        return self

    def options(self, **options):
        self.seen.update(options)
        return self

    def mode(self, mode):
        self.seen["mode"] = mode
        return self

    def save(self):
        self.seen["saved"] = True


def test_jdbc_writes():
    append, truncate = Recorder(), Recorder()
    tables.append_jdbc(append, "u", "t")
    tables.truncate_jdbc(truncate, "u", "t")
    assert append.seen == {"parts": 6, "format": "jdbc", "url": "u", "dbtable": "t", "batchsize": "1000",
                           "mode": "append", "saved": True}
    assert truncate.seen["mode"] == "overwrite" and truncate.seen["truncate"] == "true"


def test_rejects(spark):
    raw = spark.createDataFrame([("1", "2.5"), ("x", "1"), ("2", None), ("y", "z")], "id string, n string")
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("n", T.DoubleType())])
    good, bad = tables.split_rejects(raw, schema)
    assert rows(good) == [(1, 2.5), (2, None)]
    assert rows(bad) == [("x", "1", ["id"]), ("y", "z", ["id", "n"])]


@pytest.mark.parametrize("partition, parts", [
    ("hourly", ["2024", "03", "05", "07"]), ("daily", ["2024", "03", "05"])])
def test_time_partitions(spark, tmp_path, partition, parts):
    df = spark.createDataFrame([(1, datetime(2024, 3, 5, 7))], "id int, at timestamp_ntz")
    folder = file_sinks.write_by_time(df, str(tmp_path / partition), F.col("at"), partition)
    names = [f"{n}={v}" for n, v in zip(["year", "month", "day", "hour"], parts)]
    assert list((tmp_path / partition).joinpath(*names).glob("*.json")) and folder
    with pytest.raises(ValueError):
        file_sinks.time_partitions(df, F.col("at"), "weekly")


def test_csv_forms(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "n int, s string")
    file_sinks.write_csv(df, str(tmp_path / "gz"), "gzip")
    assert list((tmp_path / "gz").glob("*.csv.gz"))
    file_sinks.write_csv(df, str(tmp_path / "plain"), index="row")
    back = files.read_csv(spark, str(tmp_path / "plain"))
    assert back.columns == ["row", "n", "s"] and rows(back.select("n", "s")) == [(1, "a"), (2, "b")]


def test_directory_scans(spark, tmp_path):
    import pandas as pd
    for name, n in (("yellow_tripdata_2021-01", 2), ("yellow_tripdata_2021-02", 3), ("green_tripdata_2021-01", 4)):
        pd.DataFrame({"v": range(n)}).to_parquet(tmp_path / f"{name}.parquet")
    (tmp_path / "notes.txt").write_text("x")
    every = files.read_directory(spark, str(tmp_path))
    assert rows(files.rows_per_file(every)) == [
        ("green_tripdata_2021-01.parquet", 4), ("yellow_tripdata_2021-01.parquet", 2), ("yellow_tripdata_2021-02.parquet", 3)]
    assert files.read_directory(spark, str(tmp_path), "yellow").count() == 5
    listed = files.list_objects(spark, str(tmp_path), "txt").collect()
    assert [r.length for r in listed] == [1] and files.list_objects(spark, str(tmp_path)).count() == 4
    assert bytes(files.read_objects(spark, str(tmp_path / "notes.txt")).first().content) == b"x"


def test_dataset_folders_count_as_files(spark, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "lines.parquet"))
    assert rows(files.rows_per_file(files.read_directory(spark, str(tmp_path), "lines"))) == [("lines.parquet", 5)]


def test_payload_and_elements(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"id": 1},\n {"id": 2}]')
    assert rows(files.read_payload(spark, str(tmp_path / "a.json"), "id int", whole_file=True)) == [(1,), (2,)]
    (tmp_path / "a.xml").write_text("<L><G><I><D>1</D></I></G><I><D>2</D></I></L>")
    schema = T.StructType([T.StructField("D", T.StringType())])
    assert rows(files.read_elements(spark, str(tmp_path / "a.xml"), "I", schema)) == [("1",), ("2",)]


def test_large_element_files_are_cut(spark, tmp_path, monkeypatch):
    schema = T.StructType([
        T.StructField("D", T.StringType()), T.StructField("_a", T.StringType()), T.StructField("V", T.ArrayType(T.StringType()))])
    body = "".join(f'<I a="x{i}">\n <D> \u00fc {i} &amp; &lt;I&gt; </D><V>{i}</V><V/></I>\n' for i in range(200))
    body += "<IX><D>other</D></IX><G><I><D>deep</D></I></G>"
    cases = {  # whether a file can be cut
        f"<L>{body}</L>": True,
        f'<?xml version="1.0" encoding="UTF-8"?>\n<L xmlns:x="u" x:b="c">{body}</L>\n': True,
        f'<L>{body}<I a="q>r"><D> t x:y="z" /> </D></I></L>': True,
        f"<L>{body}<!-- <I><D>hidden</D></I> --></L>": False,
        f"<L>{body}<I><D><![CDATA[</I>]]></D></I></L>": False,
        f"<L>{body}<I><D>out</D><I><D>in</D></I></I></L>": False,
        f'<L>{body}<I/><I a="q>"/></L>': False,
        f"<L>{body}<I><D>blank</D></I ></L>": False,
        f'<L xmlns:p="u">{body}<p:I><D>z</D></p:I></L>': False,
        f'<L xmlns:p="u">{body}<I a="q>r" p:k="1"><D>z</D></I></L>': False,
        f'<L xmlns:p="u">{body}<I><D p:k="1">z</D></I></L>': False,
        f"<L>{body}<I><D>open": False,
        "<L>" + "<D>none</D>" * 500 + "</L>": False,
    }
    for name, value in (("spark.sql.files.maxPartitionBytes", "2000b"), ("spark.sql.files.openCostInBytes", "1b")):
        spark.conf.set(name, value)
    try:
        for k, (text, plain) in enumerate(cases.items()):
            folder = tmp_path / f"{k} %20"
            folder.mkdir()
            (folder / "large.xml").write_text(text)
            (folder / "small.xml").write_text("<L><I><D>small</D></I></L>")
            whole = files.read_elements(spark, str(folder), "I", schema)
            cut = files.read_elements(spark, str(folder), "I", schema, whole_bytes=1000)
            assert Counter(map(repr, cut.collect())) == Counter(map(repr, whole.collect())), text[-80:]
            assert cut.schema == whole.schema
            assert (len(files._plain(files._pieces(spark, [str(folder / "large.xml")], "I"), "I")) == 1) == plain, text[-80:]
            assert (cut.select(F.spark_partition_id()).distinct().count() > 5) == plain
        (tmp_path / "0 %20" / "more[1].xml").write_text(next(iter(cases)))  # a name that reads as a pattern
        assert files.read_elements(spark, str(tmp_path / "0 %20"), "I", schema, whole_bytes=1000).count() == 403
        (tmp_path / "0 %20" / "more[1].xml").unlink()
        monkeypatch.setattr(files, "_PIECE_BYTES", 40)  # texts longer than a piece are never lost
        assert files.read_elements(spark, str(tmp_path / "0 %20"), "I", schema, whole_bytes=1000).count() == 202
    finally:
        for name in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
            spark.conf.unset(name)


def test_sources(spark):
    named = catalog.Sources().add("a", lambda s: s.range(3))
    assert named.read(spark, "a").count() == 3 and named.register_views(spark) == ["a"]
    assert spark.sql("select count(*) from a").first()[0] == 3
    with pytest.raises(KeyError):
        named.read(spark, "b")
    with pytest.raises(ValueError):
        named.add("a", lambda s: s.range(1))
    assert catalog.empty_like(spark.range(3)).schema == spark.range(3).schema
    assert not catalog.table_exists(spark, "no_such_table")


class Cluster:
    """Stands in for a session on a cluster."""

    def __init__(self, folder):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = type("Context", (), {"master": "yarn"})


def test_shared_folder():
    assert session.shared_folder(Cluster("hdfs://shared/x/")) == "hdfs://shared/x"
    assert session.new_folder(Cluster("hdfs://shared/x"), "a").startswith("hdfs://shared/x/millrace-a-")
    session._named.pop()
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(Cluster(None))


def test_shuffles_follow_the_input(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert session.size_shuffles(spark, 10) == spark.sparkContext.defaultParallelism
        assert session.size_shuffles(spark, 100 * 1024 ** 4) == 409_600
        assert spark.conf.get("spark.sql.shuffle.partitions") == "409600"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


# --- versions ---------------------------------------------------------------------------------------

def test_versions(spark):
    days = [datetime(2024, 10, d) for d in range(1, 8)]
    history = spark.createDataFrame(
        [(1, "Alice", 1, None), (2, "Bob", 1, 3), (3, "Charlie", 3, 6), (3, "Carl", 6, None)],
        "id bigint, name string, added_in int, removed_in int")
    commits = spark.createDataFrame([(k, days[k], "append") for k in (1, 3, 6)],
                                    "snapshot_id bigint, committed_at timestamp_ntz, operation string")
    assert rows(versioned.current_rows(history)) == [(1, "Alice"), (3, "Carl")]
    assert rows(versioned.rows_at_version(history, 2)) == [(1, "Alice"), (2, "Bob")]
    assert rows(versioned.rows_at_version(history, 3)) == [(1, "Alice"), (3, "Charlie")]
    assert rows(versioned.rows_at_version(history, 0)) == []
    assert [tuple(r)[::3] for r in versioned.rows_per_commit(history, commits).orderBy("snapshot_id").collect()] == [
        (1, 2), (3, 1), (6, 1)]
    east = timezone(timedelta(hours=7))
    assert versioned.rows_at_time(history, commits, datetime(2024, 10, 2, 7, 0, tzinfo=east)).count() == 2
    with pytest.raises(ValueError):
        versioned.rows_at_time(history, commits, datetime(2024, 10, 2, 6, 59, tzinfo=east))


# --- models -----------------------------------------------------------------------------------------

def test_registry(spark, tmp_path):
    raw = spark.createDataFrame([(i, i % 3) for i in range(10)], "ts bigint, k bigint")
    seen = {"upto": 5}
    sources = catalog.Sources().add("raw", lambda s: raw.filter(F.col("ts") < seen["upto"]))
    registry = {m.name: m for m in [
        models.Model("total", ("view",), lambda df: df.agg(F.sum("n").alias("n"))),
        models.Model("view", ("kept",), lambda df: df.groupBy("k").agg(F.count("*").alias("n")), "view"),
        models.Model("kept", ("raw",), lambda df: df, "incremental", checks=(quality.not_null("ts"),), unique=("k",)),
        models.Model("latest", ("raw",), lambda df: df.groupBy("k").agg(F.max("ts").alias("ts")), "incremental",
                     merge_on=("k",)),
    ]}
    first = models.run_models(spark, sources, str(tmp_path / "m"), registry)
    assert rows(first["total"]) == [(5,)] and spark.table("view").count() == 3
    seen["upto"] = 10
    second = models.run_models(spark, sources, str(tmp_path / "m"), registry)
    assert rows(second["total"]) == [(10,)]
    assert rows(second["latest"].select("k", "ts")) == [(0, 9), (1, 7), (2, 8)]
    assert rows(models.check_models(second, registry)) == [("not_null_ts", 0), ("unique_k", 3)]
    with pytest.raises(quality.CheckFailed):
        models.check_models(second, registry, fail_on_error=True)
    only = models.run_models(spark, sources, str(tmp_path / "o"), registry, only={"total"})
    assert "latest" not in only
    with pytest.raises(ValueError):
        models.Model("x", (), lambda: None, "cube")
