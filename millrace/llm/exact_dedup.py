"""Exact duplicates: groups by a 128-bit content hash, checked byte by byte."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.rows import only_rows, row_key
from millrace.session import settle

# Hashes of repeated texts are broadcast to the second scan up to this number (16 bytes each); beyond it
# that scan takes all rows.
BROADCAST_HASHES = 2_000_000


def stripped(text: Column) -> Column:
    """The text without ASCII white space."""
    return F.translate(text, " \t\n\x0b\f\r", "")


def exact_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     digest: Callable[[Column], Column] = F.md5, keyed: bool = False) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256; and its row_key if `keyed`.

    Texts are equal when they are the same bytes after white space is deleted; null counts as empty, and
    empty texts are equal to each other. Of equal texts the one with the most code points stays, then the
    least id; a null id comes after all others. Rows that repeat an id are rows of their own and share one
    decision: all copies of the row that stays are marked as kept.

    Rows are grouped by the hash alone, in two counters per group and task. Groups of several rows are
    grouped again by the hash and the text, which compares their bytes; a hash that turns out to stand for
    more than one text is decided by text. Copies collapse in each task before the shuffle, so a group may
    hold any share of the rows. Only the two named columns are read. An empty table gives an empty result.
    """
    key = row_key(id_col, text_col) if keyed else F.lit(None).cast("string")
    docs = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), key.alias("key"))
    docs = docs.select("id", "key", F.length("text").alias("n"), stripped(F.col("text")).alias("body"))
    hashed = docs.withColumn("h", F.unhex(digest(F.col("body"))))
    rows = settle(hashed.select("id", "key", "n", "h", F.unhex(F.sha2("body", 256)).alias("sha")), "hashes")

    # The text with the most code points, then the least id; null ids last.
    order = F.struct((-F.col("n")).alias("n"), F.col("id").isNull().alias("no_id"), F.col("id").alias("id"))
    stays = [F.min(order).alias("first"), F.count("*").alias("group_size")]
    groups = settle(rows.groupBy("h").agg(*stays), "groups")
    repeated = groups.where("group_size > 1").select("h")
    several = hashed.select("id", "n", "h", "body")
    if repeated.count() <= BROADCAST_HASHES:
        several = several.join(F.broadcast(repeated), "h", "left_semi")
    by_text = several.groupBy("h", "body").agg(*stays)
    clashing = settle(by_text.groupBy("h").agg(F.count("*").alias("texts")).where("texts > 1").select("h"), "clashing")

    plain = rows.join(groups, "h")
    if not clashing.isEmpty():
        plain = rows.join(groups.join(clashing, "h", "left_anti"), "h")
        apart = hashed.join(clashing, "h", "left_semi")
        decided = apart.groupBy("h", "body").agg(*stays)
        apart = apart.withColumn("sha", F.unhex(F.sha2("body", 256))).join(decided, ["h", "body"])
        columns = ["id", "key", "n", "sha", "first", "group_size"]
        plain = plain.select(columns).unionAll(apart.select(columns))
    kept = F.col("id").eqNullSafe(F.col("first.id")) & (F.col("n") == -F.col("first.n"))
    return plain.select(F.col("id").alias(id_col), F.col("first.id").alias("keep_id"), "group_size", kept.alias("kept"),
                        F.lower(F.hex("sha")).alias("text_sha256"), *([F.col("key").alias("row_key")] if keyed else []))


def without_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that `exact_duplicates` keeps, with all their columns; a row that is there twice stays once."""
    kept = exact_duplicates(df, id_col, text_col, keyed=True).where("kept")
    return only_rows(df, kept.select("row_key"), id_col, text_col)
