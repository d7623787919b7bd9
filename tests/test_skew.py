"""Operators that number, sample and look up, against brute force when one group or copy dominates."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace import session
from millrace.operators import files, sales
from millrace.operators.sequence import first_by_key, sequence_within
from millrace.workload import documents


@pytest.fixture(scope="module")
def skewed():
    """A third of the rows are in one group, and a third are copies of one row."""
    rnd = random.Random(3)
    rows = [("hot", rnd.randrange(50), rnd.randrange(1000)) for _ in range(400)]
    rows += [("copy", 7, 7)] * 400
    rows += [(f"g{rnd.randrange(20)}", rnd.randrange(50), rnd.randrange(1000)) for _ in range(400)] + [(None, 1, 1)] * 5
    rnd.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "g string, day int, k int").repartition(5)


@pytest.mark.parametrize("limit", [500_000, 0])
def test_sequence(spark, skewed, monkeypatch, limit):
    monkeypatch.setattr("millrace.operators.sequence.BROADCAST_ROWS", limit)
    got = sequence_within(frame(spark, skewed), ["g"], ["day", "k"], "n").collect()
    expected = Counter()
    for g in {r[0] for r in skewed}:
        for n, row in enumerate(sorted(r[1:] for r in skewed if r[0] == g)):
            expected[(g, *row, n)] += 1
    assert Counter(tuple(r) for r in got) == expected


def test_sequence_without_groups(spark):
    got = sequence_within(spark.range(1000).select((999 - F.col("id")).alias("v")), [], ["v"], "n", start=1)
    assert got.filter("n <> v + 1").count() == 0 and got.count() == 1000


def test_sample_is_exact_and_whole(spark, skewed):
    df = frame(spark, skewed)
    got = [tuple(r) for r in files.sample_per_file(df, "g", 100, ["g", "day", "k"]).collect()]
    counts, have = Counter(r[0] for r in got), Counter(skewed)
    sizes = Counter(r[0] for r in skewed)
    assert counts == {g: 100 for g, n in sizes.items() if n >= 100 and g is not None}
    assert all(have[r] >= n for r, n in Counter(got).items())
    again = [tuple(r) for r in files.sample_per_file(df.repartition(2), "g", 100, ["g", "day", "k"]).collect()]
    assert Counter(again) == Counter(got)


def test_sample_guard(spark):
    df = spark.range(19_999).select(
        F.when(F.col("id") < 9_999, "small").otherwise("large").alias("file"), F.col("id").alias("k"))
    sample = files.sample_per_file(df, "file", 10_000, ["k"])
    assert [tuple(r) for r in sample.groupBy("file").count().collect()] == [("large", 10_000)]
    assert files.size_guard(df, "file", 10_000).count() == 10_000


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_lookup_both_ways(spark, skewed, monkeypatch, how):
    df = frame(spark, skewed)
    dim = spark.createDataFrame([("hot", 1), ("g1", 2), ("none", 3)], "g string, tag int")
    broadcast = session.lookup(df, dim, ["g"], how).collect()
    monkeypatch.setattr(session, "BROADCAST_ROWS", 0)
    salted = session.lookup(df, dim, ["g"], how).collect()
    assert Counter(broadcast) == Counter(salted) and broadcast


def test_first_by_key(spark, skewed):
    got = first_by_key(frame(spark, skewed).filter("g is not null"), ["g"], ["day", "k"]).collect()
    assert {r.g: (r.day, r.k) for r in got} == {
        g: min(r[1:] for r in skewed if r[0] == g) for g in {r[0] for r in skewed} - {None}}


def test_catalogue(spark):
    cities = spark.createDataFrame([("Roma",), ("Berlin",), ("Roma",)], "c string")
    got = sales.product_catalogue(cities, "c", ["4x6", "5x7"], ["Hi", "Bye"]).orderBy("product_id").collect()
    assert [r.name for r in got] == [f"{f} {t} {c}" for f in ("4x6", "5x7") for t in ("Hi", "Bye") for c in ("Berlin", "Roma")]
    assert [r.product_id for r in got] == list(range(1, 9))


def test_calendar(spark):
    assert sales.calendar(spark).count() == 731
    days = spark.createDataFrame([("2018-12-31",), ("2019-01-01",), ("2020-12-31",), ("2021-01-01",)], "d string")
    days = days.select(F.col("d").cast("timestamp_ntz").alias("d"))
    semi = days.join(sales.calendar(spark), F.col("d").cast("date") == F.col("day"), "left_semi")
    assert sorted(sales.in_calendar(days, "d").collect()) == sorted(semi.collect()) and semi.count() == 2


def test_daily_file_names(spark):
    names = spark.createDataFrame([("rawDailySales_20203101_1001.json",), ("other.csv",)], "n string")
    got = names.select(sales.daily_file_parts(F.col("n")).alias("p")).collect()
    assert str(got[0].p.day) == "2020-01-31" and got[0].p.reseller == "1001"
    assert got[1].p.day is None and got[1].p.reseller is None


def test_fixed_dimensions(spark):
    assert sales.channels(spark).count() == 3
    assert [str(r.commission_pct) for r in sales.resellers(spark).orderBy("reseller_id").collect()] == [
        "0.1500", "0.1700", "0.1400", "0.1600"]


def test_release_deletes_only_named_folders(spark, tmp_path):
    kept = session.settle(spark.range(3), "kept")
    assert kept.count() == 3 and session.release(spark) >= 1
    assert session.release(spark) == 0 and tmp_path.exists()


@pytest.mark.parametrize("name", ["sanctions_individuals", "sanctions_entities", "sanctions_union"])
def test_large_lists_are_read_in_splits(spark, tmp_path, monkeypatch, name):
    """A task of the XML source reads no more than a file of the size up to which files are read whole."""
    import check

    spark.range(400).select(
        F.col("id").alias("c_custkey"), F.format_string("Customer#%09d", "id").alias("c_name"), (F.col("id") % 25).alias("c_nationkey"),
        F.lit("A & <B>").alias("c_mktsegment")).write.parquet(f"{tmp_path}/customer.parquet")
    spark.range(300).select(
        F.col("id").alias("s_suppkey"), F.format_string("Supplier#%09d", "id").alias("s_name"), (F.col("id") % 25).alias("s_nationkey")
        ).write.parquet(f"{tmp_path}/supplier.parquet")
    con = check.duckdb.connect()
    for table in ("customer", "supplier"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet/*.parquet'")
    monkeypatch.setattr("millrace.sources.files.WHOLE_BYTES", 1000)
    scans = []
    read_elements = documents.read_elements
    monkeypatch.setattr(documents, "read_elements", lambda *a: scans.append(read_elements(*a)) or scans[-1])
    for key, value in (("spark.sql.files.maxPartitionBytes", "8000b"), ("spark.sql.files.openCostInBytes", "1b")):
        spark.conf.set(key, value)
    try:
        verdict, detail, _ = check.compare(spark, con, name, str(tmp_path), documents.QUERIES[name](spark, str(tmp_path)))
        assert verdict == "ok", detail
        assert all("FileScan text" in df._jdf.queryExecution().executedPlan().toString() for df in scans)
        assert all(df.select(F.spark_partition_id()).distinct().count() > 10 for df in scans)
    finally:
        for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
            spark.conf.unset(key)
