"""Connected components of a link table, by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import settle


# Rows for each task and file of the tables between rounds, so that a small graph is not spread thin.
ROWS_PER_TASK = 250_000


def _compact(df: DataFrame, rows: int) -> DataFrame:
    """A result of at most that many rows in as few tasks as they need."""
    return df.coalesce(rows // ROWS_PER_TASK + 1)


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node that has a link; nodes share a label when links connect them.

    links: columns `a` and `b`. Each round maps a node to the neighbour, or itself, with the least hash
    under the round's own seed, and keeps the links between different images. A node and its image are
    linked, so a round never joins what is apart, and random order shrinks any shape of graph, a chain
    too, by a constant factor. Only minima are aggregated, so a node with many links is no heavy group;
    joins on such nodes are plain equality joins, which adaptive execution may split. Null ends and links
    of a node with itself are ignored. No links: no rows.
    """
    edges = settle(_compact(links.select("a", "b").where("a <> b").distinct(), links.count()), "links")
    maps, size = [], edges.count()
    while size:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        order = lambda c: F.struct(F.xxhash64(F.lit(len(maps)), c), c.alias("v"))  # noqa: E731, B023
        step = both.groupBy(F.col("a").alias("node")).agg(F.min(order(F.col("b"))).alias("m"))
        step = step.select("node", F.least("m", order(F.col("node")))["v"].alias("image"))
        maps.append(step := settle(_compact(step, 2 * size), "images"))
        one = step.select(F.col("node").alias("a"), F.col("image").alias("x"))
        two = step.select(F.col("node").alias("b"), F.col("image").alias("y"))
        moved = edges.join(one, "a").join(two, "b").where("x <> y")
        moved = moved.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        edges = settle(_compact(moved, size), "links")
        size = edges.count()
    if not maps:
        return links.select(F.col("a").alias("node"), F.col("a").alias("label")).limit(0)
    labels = maps[0].withColumnRenamed("image", "label")
    for step in maps[1:]:
        step = step.select(F.col("node").alias("label"), "image")
        labels = labels.join(step, "label", "left").select("node", F.coalesce("image", "label").alias("label"))
    return settle(_compact(labels, maps[0].count()), "labels")
