"""Change detection and merges of a keyed change set into a target.

Shared rules: keys compare with plain `=`, so a row with a NULL key never matches and is always
inserted; a key that occurs twice in the change set is an error unless the caller says which row wins.

The work is split so that no key fills a task. Target rows are the left side of a left join: a change set
of few counted rows is broadcast to them, and beyond that Spark may split a hot target key. Rows with NULL
keys take no part in any join.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.casts import change_default
from ..functions.times import moment
from ..session import BROADCAST_ROWS, narrow, settle

FLAG = "RECORD_STATUS"
# Audit columns per style: set on insert, and set on update.
AUDIT_STYLES = {
    "created_updated": (["created_at", "updated_at"], ["updated_at"]),
    "last_updated": (["LAST_UPDATED_DT"], ["LAST_UPDATED_DT"]),
    None: ([], []),
}


def _keys_present(keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def _sortable(df: DataFrame, column: str) -> Column:
    """The column, or its text where its type has no order."""
    kind = df.schema[column].dataType.simpleString()
    return F.to_json(F.struct(column)) if "map<" in kind or "variant" in kind else F.col(column)


class RepeatedKey(ValueError):
    """A change set has more than one row for a key."""


@dataclass(frozen=True)
class ChangeSet:
    """Rows with complete keys, one per key, and how many there are."""

    rows: DataFrame
    size: int

    def fits(self, df: DataFrame) -> bool:
        """Whether `df`, made of these rows, may be broadcast: by their counted number and its bytes."""
        return self.size <= BROADCAST_ROWS and narrow(df)

    def beside_target(self, df: DataFrame) -> DataFrame:
        """`df` as a join side: broadcast if it fits, sorted and merged otherwise."""
        return F.broadcast(df) if self.fits(df) else df.hint("merge")


def one_row_per_key(source: DataFrame, keys: list[str], latest_by: str | None = None) -> ChangeSet:
    """The change set with one row per key.

    The key columns alone are read and counted at once. A repeated key raises, unless `latest_by` is given:
    then the row with the largest value wins, and copies of a key collapse before the shuffle.
    """
    complete = source.filter(_keys_present(keys))
    per_key = complete.groupBy(*keys).agg(F.count("*").alias("_n"))
    found = per_key.agg(
        F.count("*").alias("keys"), F.max("_n").alias("most"), F.max_by(F.struct(*keys), "_n").alias("key")).first()
    if latest_by:
        # A NULL order is the least, and of equal ones the greatest row wins, so no key is left without a row.
        order = F.struct(F.col(latest_by).isNotNull(), F.col(latest_by), *[_sortable(source, c) for c in source.columns])
        whole = F.max_by(F.struct(*source.columns), order).alias("_row")
        latest = complete.groupBy(*keys).agg(whole)
        rows = latest.select(*keys, *[F.col("_row")[c].alias(c) for c in source.columns if c not in keys])
        return ChangeSet(rows, found["keys"])
    if found["keys"] and found["most"] > 1:
        raise RepeatedKey(f"more than one source row for key {found['key'].asDict()}")
    return ChangeSet(complete, found["keys"])


def detect_changes(staging: DataFrame, target: DataFrame, key: str, ignore: tuple[str, ...] = ()) -> DataFrame:
    """Staging rows that are new ('I') or differ from the target ('U'); unchanged rows are left out.

    NULL counts as '' in text, date and time columns and as 0 in the others. The key, LAST_UPDATED_DT
    and ignored columns are not compared. The target has one row per key; the staging table need not.
    """
    types = dict(target.dtypes)
    compared = [c for c in target.columns if c != key and c != "LAST_UPDATED_DT" and c not in ignore]
    old = target.select(F.col(key).alias("_key"), *[F.col(c).alias(f"_old_{c}") for c in compared])
    known = staging.filter(F.col(key).isNotNull())
    wanted = known.select(F.col(key).alias("_key")).distinct()
    if wanted.count() <= BROADCAST_ROWS and narrow(wanted):
        # Few keys: the target is reduced to them where it lies, and only those rows move.
        old = old.join(F.broadcast(wanted), "_key", "left_semi")
    joined = known.join(old, known[key] == F.col("_key"), "left")
    differs = reduce(
        lambda a, b: a | b,
        [change_default(F.col(c), types[c]) != change_default(F.col(f"_old_{c}"), types[c]) for c in compared],
        F.lit(False),
    )
    flag = F.when(F.col("_key").isNull(), "I").when(differs, "U")
    changed = joined.withColumn(FLAG, flag).filter(F.col(FLAG).isNotNull()).select(*staging.columns, FLAG)
    return changed.unionByName(staging.filter(F.col(key).isNull()).withColumn(FLAG, F.lit("I")))


def _update(target: DataFrame, changes: ChangeSet, keys: list[str], stamps: dict[str, Column],
            keep: tuple[str, ...] = ()) -> DataFrame:
    """Target rows with the values of their matching source row, if any."""
    source = changes.rows
    taken = [c for c in source.columns if c not in keys and c not in keep and c in target.columns]
    side = source.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[F.col(c).alias(f"_new_{c}") for c in taken])
    on = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_k_{k}") for k in keys])
    matched = F.col(f"_k_{keys[0]}").isNotNull()
    side = changes.beside_target(side)
    joined = target.filter(_keys_present(keys)).join(side, on, "left")
    types = dict(target.dtypes)
    columns = []
    for c in target.columns:
        if c in stamps:
            columns.append(F.when(matched, stamps[c].cast(types[c])).otherwise(F.col(c)).alias(c))
        elif c in taken:
            columns.append(F.when(matched, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c))
        else:
            columns.append(F.col(c))
    return joined.select(*columns).unionByName(target.filter(~_keys_present(keys)))


def _absent(changes: ChangeSet, target: DataFrame, keys: list[str]) -> DataFrame:
    """Source rows whose key the target lacks.

    A small source is broadcast: the target is reduced to the keys they share without being shuffled, and
    the few left decide. Beyond that, target keys collapse before the shuffle, so a hot one stays small.
    """
    source = changes.rows
    if changes.fits(source.select(*keys)):
        shared = target.select(*keys).join(F.broadcast(source.select(*keys)), keys, "left_semi").distinct()
        return source.join(F.broadcast(shared), keys, "left_anti")
    return source.join(target.select(*keys).distinct().hint("merge"), keys, "left_anti")


def _insertable(rows: DataFrame, target: DataFrame, stamps: dict[str, Column]) -> DataFrame:
    """Insert columns in target order; a target column the source lacks becomes NULL."""
    return rows.select(*[
        stamps[f.name].cast(f.dataType).alias(f.name) if f.name in stamps
        else F.col(f.name).cast(f.dataType).alias(f.name) if f.name in rows.columns
        else F.lit(None).cast(f.dataType).alias(f.name)
        for f in target.schema.fields
    ])


def merge(target: DataFrame, source: DataFrame, keys: list[str], audit: str | None = None,
          at: datetime | None = None, latest_by: str | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Target after update-or-insert of the source on its keys.

    `audit` names the stamped columns: "created_updated" sets both on insert and updated_at on update,
    "last_updated" sets LAST_UPDATED_DT on both, None stamps nothing. `keep` columns are not updated.
    """
    on_insert, on_update = AUDIT_STYLES[audit]
    clock = moment(at)
    unique = one_row_per_key(source, keys, latest_by)
    updated = _update(target, unique, keys, {c: clock for c in on_update}, keep)
    fresh = _absent(unique, target, keys).unionByName(source.filter(~_keys_present(keys)))
    return updated.unionByName(_insertable(fresh, target, {c: clock for c in on_insert}))


def insert_if_absent(target: DataFrame, source: DataFrame, keys: list[str], audit: str | None = "created_updated",
                     at: datetime | None = None, latest_by: str | None = None) -> DataFrame:
    """Target plus the source rows whose key it lacks; matched rows stay as they are."""
    stamps = {c: moment(at) for c in AUDIT_STYLES[audit][0]}
    unique = one_row_per_key(source, keys, latest_by)
    fresh = _absent(unique, target, keys).unionByName(source.filter(~_keys_present(keys)))
    return target.unionByName(_insertable(fresh, target, stamps))


def apply_flagged(target: DataFrame, changes: DataFrame, keys: list[str], keep: tuple[str, ...] = ()) -> DataFrame:
    """Apply a flagged change set: 'U' rows update, 'I' rows are inserted, the flag is dropped."""
    unknown = ~F.coalesce(F.col(FLAG).isin("I", "U"), F.lit(False)) | ((F.col(FLAG) == "U") & ~_keys_present(keys))
    if not changes.filter(unknown).isEmpty():
        raise ValueError(f"{FLAG} must be 'I' or 'U', and a 'U' row must have its keys")
    updates = one_row_per_key(changes.filter(F.col(FLAG) == "U").drop(FLAG), keys)
    inserts = changes.filter(F.col(FLAG) == "I").drop(FLAG)
    return _update(target, updates, keys, {}, keep).unionByName(_insertable(inserts, target, {}))


def upsert(target: DataFrame, staging: DataFrame, key: str, at: datetime | None = None,
           ignore: tuple[str, ...] = ()) -> DataFrame:
    """Detect changes against the target and apply them; ignored columns keep their target value.

    The change set is written once: applying it reads it several times, and its real size then decides
    whether the target has to be shuffled.
    """
    changes = settle(detect_changes(staging, target, key, ignore), "changes")
    if at is not None and "LAST_UPDATED_DT" in target.columns:
        changes = changes.withColumn("LAST_UPDATED_DT", moment(at))
    return apply_flagged(target, changes, [key], ignore)
