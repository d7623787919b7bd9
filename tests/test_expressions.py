"""Casts, times and texts on the rows where engines differ."""

from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Row
from pyspark.sql import functions as F

from millrace.functions import casts, texts, times


def column(spark, values, kind, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


def test_floor_and_round(spark):
    values = ["", "7.0", "7.5", "-7.5", None]
    assert column(spark, values, "string", casts.floor_to("c", "int")) == [None, 7, 7, -8, None]
    assert column(spark, values, "string", casts.round_to("c", "int")) == [None, 7, 8, -8, None]


def test_straight_integer(spark):
    assert column(spark, ["3", ""], "string", casts.to_integer("c")) == [3, None]
    with pytest.raises(PySparkException):
        column(spark, ["3.0"], "string", casts.to_integer("c"))


def test_flag(spark):
    assert column(spark, ["t", "f", "true", None], "string", casts.decode_flag("c")) == [True, False, None, None]
    assert column(spark, [True, False], "boolean", casts.decode_flag("c")) == [None, None]


def test_whole_number(spark):
    values = [2.9, float("nan"), None, 1e300]
    assert column(spark, values, "double", casts.whole_number_or_null("c")) == [2, None, None, None]


def test_epoch_round_trip(spark):
    values = [0, 1704067207, -1]
    df = spark.createDataFrame([(v,) for v in values], "c bigint").withColumn("t", times.from_epoch("c"))
    assert [r.back for r in df.select(times.to_epoch("t").alias("back")).collect()] == values
    assert df.first().t == datetime(1970, 1, 1)


def test_shifted_text(spark):
    values = ["2024-01-31T20:30:00", "", None]
    assert column(spark, values, "string", times.shifted_text(F.col("c"))) == ["2024-02-01 03:30:00", None, None]


def test_dates(spark):
    values = [datetime(2020, 1, 31)]
    assert column(spark, values, "timestamp_ntz", times.compact_date(F.col("c"))) == ["20200131"]
    assert column(spark, values, "timestamp_ntz", times.file_date(F.col("c"))) == ["20203101"]


def test_title_case(spark):
    values = ["moskva (moscow)", "o'neil 4TH street", "", None]
    assert column(spark, values, "string", texts.title_case(F.col("c"))) == [
        "Moskva (Moscow)", "O'Neil 4Th Street", "", None]


def test_coordinates(spark):
    values = ["https://m/?ll=10.5,-3.2&z=1", "https://m/?z=1", None]
    assert column(spark, values, "string", texts.marker_coordinates(F.col("c"))) == [
        Row(lat=10.5, long=-3.2), Row(lat=None, long=None), Row(lat=None, long=None)]
    assert column(spark, ["x=1=2.5,3", "nothing"], "string", texts.trailing_coordinates(F.col("c"), "=")) == [
        Row(lat=2.5, long=3.0), Row(lat=None, long=None)]


def test_address(spark):
    values = ["1 Street\nWard 2\nHanoi\nphone", "one line"]
    assert column(spark, values, "string", texts.address_block(F.col("c"))) == [
        Row(province="Hanoi", address="1 Street, Ward 2, Hanoi"), Row(province=None, address="")]


def test_links(spark):
    assert column(spark, ["a/b/c/", "a"], "string", texts.path_segment(F.col("c"), 2)) == ["c", None]
    assert column(spark, ["s3://bucket//key/x.csv", "s3://b/k"], "string", texts.bucket_and_key(F.col("c"))) == [
        Row(bucket="bucket", key="key/x.csv"), Row(bucket="b", key="k")]
    assert column(spark, ["Data Engineer II"], "string", texts.slug(F.col("c"))) == ["data-engineer-ii"]
    assert column(spark, ["12 stores of 40", "none"], "string", texts.first_integer(F.col("c"))) == [12, None]


@pytest.mark.parametrize("length, expected", [(100, "  "), (101, " ")])
def test_collapse_only_when_long(spark, length, expected):
    text = "x" * (length - 3) + "  y"
    assert column(spark, [text], "string", texts.collapse_long(F.col("c"), 100)) == ["x" * (length - 3) + expected + "y"]


def test_joins_of_values(spark):
    values = [["a", "b"], [], None]
    assert column(spark, values, "array<string>", texts.join_values(F.col("c"))) == ["a; b", "", ""]
    assert column(spark, [["a", None, "", "b"]], "array<string>", texts.join_present(F.col("c"), ", ")) == ["a, b"]
