"""Named sources, catalog look-ups and empty clones."""

from __future__ import annotations

import json
import os
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .files import list_objects


@dataclass
class Sources:
    """Named readers of tables that may live in different systems, usable together in one query."""

    readers: dict[str, Callable[[SparkSession], DataFrame]] = field(default_factory=dict)

    def add(self, name: str, reader: Callable[[SparkSession], DataFrame]) -> Sources:
        if name in self.readers:
            raise ValueError(f"source {name} is already registered")
        self.readers[name] = reader
        return self

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        if name not in self.readers:
            raise KeyError(f"unknown source {name}; known: {sorted(self.readers)}")
        return self.readers[name](spark)

    def register_views(self, spark: SparkSession) -> list[str]:
        """Make every source a temporary view, for use from SQL."""
        for name in self.readers:
            self.read(spark, name).createOrReplaceTempView(name)
        return sorted(self.readers)


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def table_columns(spark: SparkSession, name: str) -> list[tuple[str, str]]:
    """Column names and types in table order."""
    return spark.table(name).dtypes


_WIDER = {"byte": 0, "short": 1, "integer": 2, "long": 3, "double": 5}


def widest(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type that holds the values of both: whole numbers widen, whole and broken numbers meet in double, a
    date and a timestamp in the timestamp, and everything else that differs in text. A column of nulls has no say."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    names = sorted(("double" if t.typeName() == "float" else t.typeName() for t in (a, b)), key=lambda n: _WIDER.get(n, 9))
    if all(n in _WIDER for n in names):
        return {"byte": T.ByteType, "short": T.ShortType, "integer": T.IntegerType, "long": T.LongType, "double": T.DoubleType}[names[1]]()
    stamp = next((t for t in (a, b) if isinstance(t, (T.TimestampType, T.TimestampNTZType))), None)
    if stamp and any(isinstance(t, T.DateType) for t in (a, b)):
        return stamp
    return T.StringType()


_SEEN, _SEEN_SIZE = "millrace.seen", 3000


def _seen(spark: SparkSession, name: str) -> dict[str, list]:
    """Files a discovered table knows: size, time and schema by path. Properties are kept short for metastores."""
    if not spark.catalog.tableExists(name):
        return {}
    parts = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect() if r["key"].startswith(_SEEN)}
    text = "".join(parts[f"{_SEEN}.{k}"] for k in range(len(parts)))
    return json.loads(text) if text else {}


def discover(spark: SparkSession, name: str, folder: str) -> list[str]:
    """Register the Parquet files below a folder as one table, and return the paths whose schemas had to be read.

    Deliveries may differ in columns and types: a column has the `widest` of its types, and is NULL for files without
    it. Names are matched without case, as the catalog does, and keep their first spelling. The table is a view with
    one scan for each distinct schema, so nothing is copied, and a scan casts only the columns that are wider elsewhere.
    What was found is kept in the view's properties: a later call reads the footers of new and changed files only, and
    files that are gone leave the table. A folder without files is an error.
    """
    listed = {r["path"]: [r["length"], str(r["modificationTime"])] for r in list_objects(spark, folder, "parquet").collect()}
    if not listed:
        raise ValueError(f"no Parquet files below {folder}")
    odd = [p for p in listed if set(p) & set("{}[]*?,\\`'")]
    if odd:
        raise ValueError(f"paths with marks that patterns use: {odd[:3]}")
    known, fresh, seen = _seen(spark, name), [], {}
    for path in sorted(listed, key=lambda p: (listed[p][1], p)):
        if known.get(path, [])[:2] == listed[path]:
            seen[path] = known[path]
        else:
            fresh.append(path)
            seen[path] = [*listed[path], spark.read.parquet(path).schema.json()]
    columns: dict[str, tuple[str, T.DataType]] = {}
    scans: dict[str, list[str]] = {}
    for path, (_, _, schema) in seen.items():
        scans.setdefault(schema, []).append(path)
    fields = {schema: {f.name.lower(): f for f in T.StructType.fromJson(json.loads(schema))} for schema in scans}
    for found in fields.values():
        for key, f in found.items():
            spelling, kind = columns.get(key, (f.name, f.dataType))
            columns[key] = (spelling, widest(kind, f.dataType))
    selects = []
    for schema, paths in scans.items():
        root = os.path.commonpath(paths) if len(paths) > 1 else ""
        at = f"{root}/{{{','.join(p[len(root) + 1:] for p in paths)}}}" if root else paths[0]
        own = [f"CAST({'`' + fields[schema][key].name + '`' if key in fields[schema] else 'NULL'} AS {kind.simpleString()}) AS `{spelling}`"
               for key, (spelling, kind) in columns.items()]
        selects.append(f"SELECT {', '.join(own)} FROM parquet.`{at}`")
    text = json.dumps(seen).replace("\\", "\\\\").replace("'", "\\'")
    # Cut between escapes: a cut behind a backslash would part it from its mark.
    pieces, first = [], 0
    while first < len(text):
        end = min(first + _SEEN_SIZE, len(text))
        while end < len(text) and text[end - 1] == "\\":
            end += 1
        pieces.append(text[first:end])
        first = end
    kept = ", ".join(f"'{_SEEN}.{k}' = '{piece}'" for k, piece in enumerate(pieces))
    spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ({kept}) AS {' UNION ALL '.join(selects)}")
    return fresh


def empty_like(df: DataFrame) -> DataFrame:
    """No rows, same schema."""
    return df.sparkSession.createDataFrame([], df.schema)
