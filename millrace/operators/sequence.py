"""Row numbers and first rows per group, without one task per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import BROADCAST_ROWS, settle

_SEED = 20240501


def sequence_within(df: DataFrame, group: list[str], order: list[str], name: str, start: int = 0) -> DataFrame:
    """Number the rows of each group by `order`, beginning at `start`.

    Rows are range-partitioned on group, order and a random tie-breaker, so a group of any size, or a
    value shared by any number of rows, spreads over tasks. The ranges are written once, with each row's
    position; a row's number is its position moved by the count of earlier runs of its group, a run being
    the stretch of a group within one range.

    The tie-breaker follows the order in which rows are read, so the input must be a scan with row-wise
    steps only; settle anything that was shuffled first.
    """
    spread = [*group, *order, "_tie"]
    ranged = df.withColumn("_tie", F.rand(_SEED)).repartitionByRange(*spread).sortWithinPartitions(*spread)
    # The id is the partition number in the upper bits and the row position in the lower 33 bits.
    stored = settle(ranged.withColumn("_pos", F.monotonically_increasing_id()).drop("_tie"), "sequence")
    stored = stored.withColumn("_part", F.shiftright("_pos", 33))
    runs = stored.groupBy(*group, "_part").agg(F.min("_pos").alias("_first"), F.count("*").alias("_n"))
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")
    runs = settle(runs.select(*group, "_part", shift.alias("_shift")), "runs")
    small = runs.count() <= BROADCAST_ROWS
    side = runs.select(F.col("_part").alias("_p"), "_shift", *[F.col(g).alias(f"_g_{g}") for g in group])
    on = F.col("_part") == F.col("_p")
    for g in group:
        on = on & F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    joined = stored.join(F.broadcast(side) if small else side, on)
    return joined.select(*df.columns, (F.col("_pos") + F.col("_shift") + start).alias(name))


def first_by_key(df: DataFrame, key: list[str], arrival: list[str | Column]) -> DataFrame:
    """The first row of every key in arrival order.

    Spark limits each map task to one row per key before the shuffle, so a hot key stays small.
    """
    w = Window.partitionBy(*key).orderBy(*arrival)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")
