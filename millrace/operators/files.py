"""Operators that treat a column as the file a row came from: size guard and exact sample."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import lookup

# Hex digits of the row digest that name a digest range: 16 ** 3 ranges per file, and as many again within
# the range in which the sample ends.
_DIGITS = (3, 6)


def content_label(name):
    """Text of a file name before its first underscore."""
    return F.substring_index(name, "_", 1)


def size_guard(df: DataFrame, file: str, min_rows: int) -> DataFrame:
    """Rows of the files that hold at least `min_rows` rows."""
    large = df.groupBy(file).agg(F.count("*").alias("_n")).filter(F.col("_n") >= min_rows).select(file)
    return lookup(df, large, [file], "left_semi")


def _edges(coded: DataFrame, file: str, digits: int, n, least: int = 0) -> DataFrame:
    """(file, _edge, _need) of each file with at least `least` rows: the digest range in which its n-th row
    falls, and how many rows are still needed there."""
    counts = coded.groupBy(file, F.left("_code", F.lit(digits)).alias("_range")).agg(
        F.count("*").alias("_n"), F.max(n).alias("_want"))
    per_file = Window.partitionBy(file)
    counts = counts.withColumns({
        "_before": F.sum("_n").over(per_file.orderBy("_range")) - F.col("_n"),
        "_total": F.sum("_n").over(per_file),
    })
    inside = counts.filter((F.col("_total") >= least) & (F.col("_before") < F.col("_want")))
    return inside.groupBy(file).agg(F.max("_range").alias("_edge"),
                                    F.max(F.struct("_range", (F.col("_want") - F.col("_before")).alias("k")))["k"].alias("_need"))


def sample_per_file(df: DataFrame, file: str, n: int, key: list[str], min_rows: int | None = None) -> DataFrame:
    """Exactly n rows of every file with at least `min_rows` (default n) rows, chosen by digest order.

    The order is md5 of the key columns, then the whole row, so the sample is repeatable, and rows are given
    back exactly as they are. Counts per file and digest range find the range in which the n-th row falls,
    and then the range within it: all rows before it are taken as they are, and only rows of that last range,
    one in 16 ** 6 of a file, are put in order. Copies of a row there count as one row with a multiplicity, so
    neither a huge file nor a huge group of copies fills one task.
    """
    columns = df.columns
    coded = df.withColumn("_code", F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in key])))
    coarse, fine = _DIGITS
    first = lookup(coded, _edges(coded, file, coarse, F.lit(n), n if min_rows is None else min_rows), [file])
    taken = first.filter(F.left("_code", F.lit(coarse)) < F.col("_edge")).select(*columns)
    last = first.filter(F.left("_code", F.lit(coarse)) == F.col("_edge")).select(*columns, "_code", "_need")
    last = lookup(last.withColumnRenamed("_need", "_want"), _edges(last, file, fine, F.col("_need")), [file])
    taken = taken.unionAll(last.filter(F.left("_code", F.lit(fine)) < F.col("_edge")).select(*columns))
    rest = last.filter(F.left("_code", F.lit(fine)) == F.col("_edge"))
    # Rows are alike when their text is, which tells -0.0 from 0.0.
    rest = rest.groupBy(file, "_code", "_need", F.to_json(F.struct(*columns)).alias("_text")).agg(
        F.any_value(F.struct(*columns)).alias("_row"), F.count("*").alias("_copies"))
    running = Window.partitionBy(file).orderBy("_code", *[F.col("_row")[c] for c in columns], "_text").rowsBetween(
        Window.unboundedPreceding, 0)
    rest = rest.withColumn("_prior", F.sum("_copies").over(running) - F.col("_copies"))
    take = F.least(F.col("_copies"), F.col("_need") - F.col("_prior"))
    rest = rest.filter(F.col("_prior") < F.col("_need")).withColumn(
        "_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), take))).select("_row.*")
    return taken.unionAll(rest.select(*columns))
