"""Relational sources. The driver jar and the database are the caller's."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def query_options(url: str, query: str) -> dict[str, str]:
    return {"url": url, "query": query}


def split_options(url: str, table: str, column: str, lower: int, upper: int, parts: int) -> dict[str, str]:
    """A table read in `parts` ranges of a numeric or date column."""
    if parts < 1 or lower >= upper:
        raise ValueError("a split read needs at least one part and lower < upper")
    return {
        "url": url, "dbtable": table, "partitionColumn": column, "lowerBound": str(lower), "upperBound": str(upper),
        "numPartitions": str(parts),
    }


def read_query(spark: SparkSession, url: str, query: str, **options: str) -> DataFrame:
    """Result of a query that the database evaluates; one connection."""
    return spark.read.format("jdbc").options(**query_options(url, query), **options).load()


def read_table(spark: SparkSession, url: str, table: str, column: str, lower: int, upper: int, parts: int,
               **options: str) -> DataFrame:
    """A whole table over several connections; rows outside the bounds fall into the outer parts."""
    chosen = split_options(url, table, column, lower, upper, parts)
    return spark.read.format("jdbc").options(**chosen, **options).load()
