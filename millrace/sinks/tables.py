"""Table sinks: typed creation, parallel append, truncate and load, full refresh, checked publication, reject capture."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import quality

# Bulk load width and batch size.
LOAD_PARTS = 6
BATCH_ROWS = 1000


# The types of the warehouse's own table creation, by class of Spark types; all others are
# VARCHAR(255). They are narrower than the data may be, so they are used on request only.
WAREHOUSE_TYPES = {
    "INTEGER": (T.IntegralType,), "DOUBLE": (T.FloatType, T.DoubleType), "TINYINT": (T.BooleanType,),
    "TIMESTAMP": (T.TimestampType, T.TimestampNTZType),
}
# Names of exact types where the catalog's name is no SQL of other databases.
_EXACT = {"tinyint": "SMALLINT", "int": "INTEGER", "string": "TEXT", "timestamp_ntz": "TIMESTAMP", "double": "DOUBLE PRECISION",
          "float": "REAL"}


def column_type(data_type: T.DataType, warehouse: bool = False) -> str:
    """Type of a column that holds every value, or the warehouse's own narrower one."""
    if warehouse:
        return next((name for name, kinds in WAREHOUSE_TYPES.items() if isinstance(data_type, kinds)), "VARCHAR(255)")
    name = data_type.simpleString()
    return _EXACT.get(name, name.upper())


def create_statement(schema_name: str, table: str, schema: T.StructType, warehouse: bool = False) -> str:
    """CREATE TABLE text for a DataFrame schema, with upper-cased names."""
    columns = ", ".join(f'"{f.name.upper()}" {column_type(f.dataType, warehouse)}' for f in schema.fields)
    return f'CREATE TABLE "{schema_name}"."{table.upper()}" ({columns})'


def created_types(schema: T.StructType, warehouse: bool = False) -> dict[str, str]:
    """Writer option for the columns of a table made by the JDBC sink. Without the warehouse's own types
    there is nothing to say: the sink's dialect has a type for every value."""
    if not warehouse:
        return {}
    return {"createTableColumnTypes": ", ".join(f"`{f.name}` {column_type(f.dataType, True)}" for f in schema.fields)}


def create_if_missing(spark: SparkSession, table: str, schema: T.StructType, folder: str) -> bool:
    """External Parquet table with the declared schema; True when it had to be created."""
    if spark.catalog.tableExists(table):
        return False
    spark.createDataFrame([], schema).write.mode("ignore").parquet(folder)
    spark.catalog.createTable(table, path=folder, source="parquet", schema=schema)
    return True


def append(df: DataFrame, table: str) -> None:
    """Append by name to a catalog table."""
    names = [f.name for f in df.sparkSession.table(table).schema.fields]
    df.select(*names).write.mode("append").insertInto(table)


def append_jdbc(df: DataFrame, url: str, table: str, parts: int = LOAD_PARTS, batch: int = BATCH_ROWS,
                **options: str) -> None:
    """Append over `parts` connections in batches; a failed part fails the job, and no row is lost unseen."""
    df.repartition(parts).write.format("jdbc").options(url=url, dbtable=table, batchsize=str(batch), **options).mode(
        "append").save()


def truncate_jdbc(df: DataFrame, url: str, table: str, parts: int = LOAD_PARTS, batch: int = BATCH_ROWS,
                  **options: str) -> None:
    """Empty the table, keeping its definition, and load it. An empty DataFrame only truncates."""
    df.repartition(parts).write.format("jdbc").options(
        url=url, dbtable=table, batchsize=str(batch), truncate="true", **options).mode("overwrite").save()


def truncate_load(df: DataFrame, table: str) -> None:
    """Replace the rows of a catalog table and keep its definition."""
    names = [f.name for f in df.sparkSession.table(table).schema.fields]
    df.select(*names).write.insertInto(table, overwrite=True)


def full_refresh(df: DataFrame, table: str, schema: T.StructType, folder: str) -> DataFrame:
    """Write the rows with declared types to a new folder, then let the table stand for it. Until the rows are
    complete the old table stays as it is."""
    spark = df.sparkSession
    typed = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    typed.write.mode("errorifexists").parquet(folder)
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.catalog.createTable(table, path=folder, source="parquet", schema=schema)
    return spark.table(table)


def publish(df: DataFrame, table: str, folder: str, checks: list[quality.RowCheck]) -> int:
    """Write rows to a new folder and let the table stand for it if no check fails; the number of rows.

    The write itself counts the failures, so nothing is read twice. When a check fails, `CheckFailed` names it, the written
    rows stay in their folder to be looked at, and the table stays as it was, or absent. Readers see the old rows or
    the new ones: the table is an external one whose location changes in one step. A table of other columns or types is
    an error before anything is written. No rows are published as an empty table.
    """
    spark = df.sparkSession
    exists = spark.catalog.tableExists(table)
    if exists and spark.table(table).dtypes != df.dtypes:
        raise ValueError(f"{table} has columns {spark.table(table).dtypes}, not {df.dtypes}")
    rows, seen = quality.observed(df, checks)
    rows.write.mode("errorifexists").parquet(folder)
    counts = seen.get
    failures = {c.name: counts[c.name] for c in checks if counts.get(c.name, 0)}
    if failures:
        raise quality.CheckFailed(failures)
    if exists:
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
        spark.catalog.refreshTable(table)
    else:
        spark.catalog.createTable(table, path=folder, source="parquet", schema=df.schema)
    return counts.get("rows", 0)


def tag_rejects(df: DataFrame, schema: T.StructType) -> DataFrame:
    """(row, raw, rejected_for) of every raw row, in one pass: the typed row, the raw one, and the columns
    whose present value cannot be cast to its type; a row fits when there are none."""
    casts = [(f.name, F.col(f.name).try_cast(f.dataType)) for f in schema.fields]
    faults = F.array_compact(F.array(*[F.when(F.col(n).isNotNull() & cast.isNull(), F.lit(n)) for n, cast in casts]))
    return df.select(F.struct(*[cast.alias(n) for n, cast in casts]).alias("row"), F.struct(*df.columns).alias("raw"),
                     faults.alias("rejected_for"))


def split_rejects(df: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Rows that fit the typed schema, and the raw rows that do not with the columns at fault. Each reads the
    input; `tag_rejects` serves both from one pass."""
    tagged = tag_rejects(df, schema)
    fits = F.size("rejected_for") == 0
    return tagged.filter(fits).select("row.*"), tagged.filter(~fits).select("raw.*", "rejected_for")
