"""Chat logs: snapshots that a longer conversation continues are dropped, the rest is rendered."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.session import settle

# Turn numbers per chunk: no task sorts or renders more of one conversation at a time.
CHUNK = 256
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def _content(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.col("role").isNull(), "role", F.col("text").isNull(), "text")


def _turns(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    df = df.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"))
    return df.withColumn("chunk", F.floor(F.col("turn") / CHUNK)).withColumn("c1", _content(1)).withColumn("c2", _content(2))


def _same(a: DataFrame, b: DataFrame, *columns: str) -> Column:
    on = F.lit(True)
    for c in columns:
        on = on & a[c].eqNullSafe(b[c])
    return on


def prefix_hashes(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                  text: str = "text") -> DataFrame:
    """(conv, pos, p1, p2): for every turn its place in its conversation, from 1, and the 128-bit hash of
    all turns up to it.

    A turn's hash covers its place, role and text; a prefix hash is the exclusive or of them. That operation
    is associative, so a conversation is cut into chunks of turn numbers: places and hashes run within a
    chunk, and one row per chunk carries them on.
    """
    rows = _turns(df, conv, turn, role, text).select("conv", "chunk", "turn", "role", "c1", "c2").distinct()
    rows = settle(rows, "turns")
    in_chunk = W.partitionBy("conv", "chunk").orderBy("turn", "role", "c1", "c2")
    before = W.partitionBy("conv").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    so_far = in_chunk.rowsBetween(W.unboundedPreceding, W.currentRow)

    sizes = rows.groupBy("conv", "chunk").agg(F.count("*").alias("size"))
    sizes = sizes.select("conv", "chunk", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))
    placed = rows.withColumn("rank", F.row_number().over(in_chunk))
    placed = placed.join(sizes, _same(placed, sizes, "conv", "chunk")).select(
        placed["conv"], placed["chunk"], "turn", "role", "c1", "c2", (F.col("offset") + F.col("rank")).alias("pos"))
    placed = placed.withColumn("e1", F.xxhash64("pos", "c1")).withColumn("e2", F.xxhash64("pos", "c2", F.lit(7)))
    parts = placed.groupBy("conv", "chunk").agg(F.bit_xor("e1").alias("s1"), F.bit_xor("e2").alias("s2"))
    carried = parts.select("conv", "chunk", *(
        F.coalesce(F.bit_xor(f"s{k}").over(before), F.lit(0)).alias(f"o{k}") for k in (1, 2)))
    running = placed.select("conv", "chunk", "pos", *(F.bit_xor(f"e{k}").over(so_far).alias(f"r{k}") for k in (1, 2)))
    return running.join(carried, _same(running, carried, "conv", "chunk")).select(
        running["conv"], "pos", *(F.col(f"r{k}").bitwiseXOR(F.col(f"o{k}")).alias(f"p{k}") for k in (1, 2)))


def maximal_conversations(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                          text: str = "text") -> DataFrame:
    """(conv, turns, copies) of the conversations that no other one continues.

    A conversation is its turns in order of turn, then role, then content, null before all else. It is dropped if another has the
    same turns and more; of equal ones the least id stays, and copies counts them. A turn row that is there
    twice counts once. Rows without a conversation id are one conversation, turns without a number come
    first, and null texts or roles are equal only to null. An empty table gives an empty result.
    """
    hashes = settle(prefix_hashes(df, conv, turn, role, text), "prefixes")
    whole = hashes.groupBy("conv").agg(F.max(F.struct("pos", "p1", "p2")).alias("w")).select("conv", "w.*")
    distinct = whole.groupBy("pos", "p1", "p2").agg(F.min("conv").alias("conv"), F.count("*").alias("copies"))
    last = whole.select(F.col("conv").alias("c"), F.col("pos").alias("last"))
    inner = hashes.join(last, F.col("conv").eqNullSafe(F.col("c"))).where("pos < last").select("pos", "p1", "p2").distinct()
    return distinct.join(inner, ["pos", "p1", "p2"], "left_anti").select("conv", F.col("pos").alias("turns"), "copies")


def rendered(turns: Column) -> Column:
    """The turns of a sorted array as one text. A marker inside a text is split by a space, so that it
    cannot open or close a turn; a null role reads as user, a null text as empty."""
    def one(t):
        plain = F.replace(F.coalesce(t["text"], F.lit("")), F.lit("<|"), F.lit("< |"))
        return F.concat(F.lit(OPEN), F.coalesce(t["role"], F.lit("user")), F.lit("\n"), plain, F.lit(CLOSE + "\n"))
    return F.array_join(F.transform(turns, one), "")


def format_chats(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                 text: str = "text") -> DataFrame:
    """The maximal conversations as text: conv id, part, n_turns, copies, text.

    A conversation has one row per chunk of turn numbers, numbered from 0 by `part`; its text is the parts
    in order. All but very long conversations have one part. Only the named columns are read.
    """
    kept = settle(maximal_conversations(df, conv, turn, role, text), "maximal")
    kept = kept.select(F.col("conv").alias("kept_conv"), "copies")
    rows = _turns(df, conv, turn, role, text)
    rows = rows.join(kept, F.col("conv").eqNullSafe(F.col("kept_conv")))
    # Equal rows collapse before texts are collected.
    rows = rows.groupBy("conv", "chunk", "copies", "turn", "role", "c1", "c2").agg(F.first("text").alias("text"))
    parts = rows.groupBy("conv", "chunk", "copies").agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "c1", "c2", "text"))).alias("t"))
    parts = parts.select("conv", "chunk", "copies", F.size("t").cast("bigint").alias("n_turns"), rendered(F.col("t")).alias("out"))
    number = F.row_number().over(W.partitionBy("conv").orderBy("chunk")).cast("bigint") - 1
    return parts.withColumn("part", number).select(F.col("conv").alias(conv), "part", "n_turns", "copies", F.col("out").alias("text"))
