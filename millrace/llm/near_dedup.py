"""MinHash near-duplicates: circulant signatures, bands, exact check on full sets, components."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm import textblocks as tb
from millrace.llm.components import components
from millrace.llm.rows import only_rows, row_key
from millrace.session import narrow, settle

BANDS, ROWS = 32, 4
# Members of a bucket, still in different components, up to which all its pairs are candidates. Beyond it
# candidates come from an exact prefix filter.
CROWD = 8
# Standard deviations by which the share of equal signature bytes may fall short before a pair is ruled out.
SLACK = 6.0
PARITY_BITS = 1024
# 64-bit numbers that all parities are folded into, to go along with members.
FOLDS = 4
# Ids are broadcast to a scan up to this number; beyond it the scan is shuffled.
BROADCAST_IDS = 1_000_000

_C1, _C2 = np.uint32(0x85EBCA6B), np.uint32(0xC2B2AE35)


def _permuted(x: np.ndarray) -> np.ndarray:
    """A permutation of the 32-bit numbers: the finaliser of a public hash."""
    x = x ^ (x >> np.uint32(16))
    x *= _C1
    x ^= x >> np.uint32(13)
    x *= _C2
    x ^= x >> np.uint32(16)
    return x


def signatures(sets: list[np.ndarray], size: int) -> np.ndarray:
    """Circulant MinHash of non-empty sets of 64-bit hashes, one row of `size` numbers each.

    A first permutation (on the circle of 32-bit numbers) breaks up structure; coordinate k is the least
    value of a second permutation after shifting the circle by k. The two serve all coordinates.
    """
    out = np.empty((len(sets), size), dtype=np.uint32)
    first = 0
    while first < len(sets):  # short blocks stay in cache
        end, total = first, 0
        while end < len(sets) and (end == first or total + len(sets[end]) <= 32768):
            total += len(sets[end])
            end += 1
        flat = np.concatenate(sets[first:end])
        at = np.concatenate([[0], np.cumsum([len(s) for s in sets[first : end - 1]])]).astype(np.int64)
        start = _permuted((flat >> np.uint64(32)).astype(np.uint32) ^ np.uint32(0x5BD1E995))
        for k in range(size):
            out[first:end, k] = np.minimum.reduceat(_permuted(start + np.uint32(k)), at)
        first = end
    return out


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """64-bit key of each band; keys of different bands differ also for equal values."""
    keys = np.empty((len(signature), bands), dtype=np.uint64)
    for band in range(bands):
        key = np.full(len(signature), band + 1, dtype=np.uint64)
        for row in range(rows):
            key = tb.mix64(key * np.uint64(0x9E3779B97F4A7C15) + signature[:, band * rows + row])
        keys[:, band] = key
    return keys.view(np.int64)


def _parities(members: np.ndarray) -> bytes:
    """For each of PARITY_BITS classes of members, whether their number is odd. Sets that differ in d members
    differ in d of these bits at most."""
    counts = np.bincount((members >> np.uint64(20)).astype(np.int64) % PARITY_BITS, minlength=PARITY_BITS)
    return np.packbits((counts & 1).astype(np.uint8)).tobytes()


def _folded(parities: bytes) -> np.ndarray:
    """Parities of fewer, larger classes: those of the classes that make up one, added up."""
    return np.bitwise_xor.reduce(np.frombuffer(parities, dtype=np.int64).reshape(-1, FOLDS), axis=0)


def _digest(sets: list[np.ndarray]) -> list[bytes | None]:
    return [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]


def _describe(batches: Iterator[pa.RecordBatch], shingle: int, bands: int, rows: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, end, data, offsets in tb.blocks(batch.column(1)):
            sets = tb.shingle_sets(data, offsets, shingle)
            full = [s for s in sets if len(s)]
            signature = signatures(full, bands * rows)
            keys = band_keys(signature, bands, rows)
            parities = [_parities(s) for s in full]
            sketches = iter([row.tobytes() + p for row, p in zip(signature.astype(np.uint8), parities, strict=True)])
            folds = np.array([_folded(p) for p in parities], dtype=np.int64).ravel()
            ends = np.cumsum([0, *(bands if len(s) else 0 for s in sets)])
            fold_ends = np.cumsum([0, *(FOLDS if len(s) else 0 for s in sets)])
            yield pa.RecordBatch.from_arrays([
                batch.column(0).slice(first, end - first), batch.column(2).slice(first, end - first),
                pa.array(_digest(sets), pa.binary()), pa.array([len(s) for s in sets], pa.int64()),
                pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(keys.ravel(), pa.int64())),
                pa.array([next(sketches) if len(s) else None for s in sets], pa.binary()),
                pa.ListArray.from_arrays(pa.array(fold_ends, pa.int32()), pa.array(folds))],
                ["id", "row_key", "node", "n", "bands", "sketch", "folds"])


def _named(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, end, data, offsets in tb.blocks(batch.column(0)):
            yield pa.RecordBatch.from_arrays([
                pa.array(_digest(tb.shingle_sets(data, offsets, shingle)), pa.binary()),
                batch.column(0).slice(first, end - first)], ["node", "text"])


def _linked(batches: Iterator[pa.RecordBatch], shingle: int, percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        left = [s for *_, data, offsets in tb.blocks(batch.column(2)) for s in tb.shingle_sets(data, offsets, shingle)]
        right = (s for *_, data, offsets in tb.blocks(batch.column(3)) for s in tb.shingle_sets(data, offsets, shingle))
        good = []
        for one, two in zip(left, right, strict=True):
            both = len(np.intersect1d(one, two, assume_unique=True))
            good.append(both > 0 and 100 * both >= percent * (len(one) + len(two) - both))
        yield pa.RecordBatch.from_arrays(batch.columns[:2], ["a", "b"]).filter(pa.array(good, pa.bool_()))


def _tokens(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, end, data, offsets in tb.blocks(batch.column(1), 1 << 18):
            sets = tb.shingle_sets(data, offsets, shingle)
            at = np.repeat(np.arange(first, end), [len(s) for s in sets])
            flat = np.concatenate(sets).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), pa.array(flat)], ["node", "token"])


def _plausible(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        one, two = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for k in (2, 3))
        p, size = percent / 100, one.shape[1] - PARITY_BITS // 8
        good = (one[:, :size] == two[:, :size]).mean(axis=1) >= p - SLACK * np.sqrt(p * (1 - p) / size)
        both = batch.column(4).to_numpy() + batch.column(5).to_numpy()
        apart = np.bitwise_count(one[:, size:] ^ two[:, size:]).sum(axis=1, dtype=np.int64)
        good &= (both - apart) // 2 * (100 + percent) >= both * percent
        yield pa.RecordBatch.from_arrays(batch.columns[:2], ["a", "b"]).filter(pa.array(good, pa.bool_()))


def _ruled_in(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs that neither their parities nor their signatures rule out, so that texts of others need not move.

    Parities bound the difference of two sets exactly. Signatures of a linked pair fall SLACK standard
    deviations short with a probability near 1e-9.
    """
    one = nodes.select(F.col("node").alias("a"), F.col("sketch").alias("sketch_a"), F.col("n").alias("n_a"))
    two = nodes.select(F.col("node").alias("b"), F.col("sketch").alias("sketch_b"), F.col("n").alias("n_b"))
    both = pairs.select("a", "b").join(one, "a").join(two, "b").select("a", "b", "sketch_a", "sketch_b", "n_a", "n_b")
    return both.mapInArrow(lambda it: _plausible(it, percent), "a binary, b binary")


def _texts_of(wanted: DataFrame, docs: DataFrame, nodes: DataFrame, shingle: int) -> DataFrame:
    """(node, text): one text of each wanted node. Its row is found by the node's least id and named by its
    set again, since ids may repeat."""
    wanted = settle(nodes.select("node", "least_id").join(wanted, "node", "left_semi"), "wanted")
    ids = wanted.select(F.col("least_id").alias("wanted_id")).distinct()
    if wanted.count() <= BROADCAST_IDS and narrow(ids):
        ids = F.broadcast(ids)
    texts = docs.join(ids, docs["id"].eqNullSafe(ids["wanted_id"]), "left_semi").select("text")
    texts = texts.mapInArrow(lambda it: _named(it, shingle), "node binary, text string").where("node IS NOT NULL")
    return texts.dropDuplicates(["node"])


def _verified(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Those pairs of nodes whose full sets are similar enough, settled. Texts and not sets are shuffled,
    because texts compress."""
    pairs = settle(_ruled_in(pairs, nodes, percent), "pairs")
    wanted = pairs.select(F.col("a").alias("node")).unionAll(pairs.select(F.col("b").alias("node"))).distinct()
    texts = _texts_of(wanted, docs, nodes, shingle)
    one = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    two = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(one, "a").join(two, "b").select("a", "b", "text_a", "text_b")
    return settle(both.mapInArrow(lambda it: _linked(it, shingle, percent), "a binary, b binary"), "links")


def _close(percent: int):
    """Sizes that leave the similarity possible."""
    return F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent


def _with_labels(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    one = labels.select(F.col("node").alias("a"), F.col("label").alias("label_a"))
    two = labels.select(F.col("node").alias("b"), F.col("label").alias("label_b"))
    return pairs.join(one, "a", "left").join(two, "b", "left").where(
        F.coalesce("label_a", "a") != F.coalesce("label_b", "b"))


def _crossing(members: DataFrame) -> DataFrame:
    """Buckets whose members are in more than one component: key and number of members."""
    counts = members.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("m"))
    return counts.where("lo <> hi").select("key", "m")


def _pairs_across(members: DataFrame, percent: int) -> DataFrame:
    """Pairs of nodes that share a key, are in different components and can be similar enough.

    members: key, node, label, n, folds and `left`, the most members that two sets can share if this key is the
    first they share. Nodes alike in label, n and left are paired as one group first, then expanded, so the
    members of one large component never meet each other. A pair goes on only if its folded parities, which bound the
    difference of the two sets from below, leave the similarity possible.
    """
    alike = ["key", "label", "n", "left"]
    groups = members.groupBy(*alike).agg(F.count("*").alias("size"))
    one = groups.select("key", *(F.col(c).alias(f"{c}_a") for c in alike[1:]))
    two = groups.select("key", *(F.col(c).alias(f"{c}_b") for c in alike[1:]))
    enough = F.least("left_a", "left_b") * (100 + percent) >= (F.col("n_a") + F.col("n_b")) * percent
    meet = one.join(two, "key").where((F.col("label_a") < F.col("label_b")) & enough)
    one = members.select("key", *(F.col(c).alias(f"{c}_a") for c in alike[1:]), F.col("node").alias("x"), F.col("folds").alias("folds_x"))
    two = members.select("key", *(F.col(c).alias(f"{c}_b") for c in alike[1:]), F.col("node").alias("y"), F.col("folds").alias("folds_y"))
    found = meet.join(one, ["key", "label_a", "n_a", "left_a"]).join(two, ["key", "label_b", "n_b", "left_b"])
    apart = sum(F.bit_count(F.col("folds_x")[k].bitwiseXOR(F.col("folds_y")[k])) for k in range(FOLDS))
    both = F.col("n_a") + F.col("n_b")
    found = found.where(F.floor((both - apart) / 2) * (100 + percent) >= both * percent)
    return found.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))


def _prefix_pairs(members: DataFrame, docs: DataFrame, nodes: DataFrame, shingle: int, percent: int) -> DataFrame:
    """All pairs of the members, in different components, that can be similar enough.

    Exact: if sets of sizes n and m are that similar, they share one of the n - ceil(p n) + 1 first members
    of one and of the m - ceil(p m) + 1 first members of the other in any fixed order; and where they share
    their first one, no more than what is left from there on can be shared. Rare members come first here, so
    that what sets a text apart fills its prefix.
    """
    members = members.select("node", "n", "label", "folds").distinct()
    texts = _texts_of(members.select("node"), docs, nodes, shingle)
    tokens = settle(texts.mapInArrow(lambda it: _tokens(it, shingle), "node binary, token bigint"), "tokens")
    counts = tokens.groupBy("token").agg(F.count("*").alias("df"))
    placed = tokens.join(counts, "token").withColumn(
        "place", F.row_number().over(Window.partitionBy("node").orderBy("df", "token"))).join(members, "node")
    prefix = F.floor(F.col("n") - F.ceil(F.col("n") * percent / 100.0 - 1e-9) + 1)
    heads = placed.where((F.col("place") <= prefix) & (F.col("df") > 1))
    heads = heads.select(F.col("token").alias("key"), "node", "n", "label", "folds", (F.col("n") - F.col("place") + 1).alias("left"))
    return _pairs_across(settle(heads, "heads"), percent)


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5,
                    percent: int = 80, bands: int = BANDS, rows: int = ROWS, row_key: Column | None = None) -> DataFrame:
    """One row per input row: id, n_shingles, component_id, kept; and row_key, a text, where that is given.

    Words are runs without ASCII white space, A to Z lower-cased; a text's set holds its distinct runs of
    `shingle` words, a shorter text's only run is all of it. Texts are linked when 100 * intersection >=
    percent * union. component_id is the least id that links reach; kept marks rows that carry it.

    Equal sets are one node from the start, so copies are never paired. Nodes that share one band of their
    signature share a bucket. Pairs are compared in full sets in three rounds, each of which leaves out
    pairs that links already connect: every node with the bucket centre it shares most buckets with, every
    node with all centres of its buckets, then all members of a bucket that are still in different
    components. In that last round pairs in crowded buckets come from an exact prefix filter on the full sets.
    A pair at the threshold misses all 32 bands of 4 with a probability below 1e-7 at 80 percent, and fails
    the comparison of signatures before texts move with one near 1e-9; nothing else can lose a link. Set
    members are 64-bit hashes of word runs.

    Null, empty and blank texts have no shingles, are linked with nothing and are kept under their own id.
    Rows that repeat an id or a text each give a row; a null id never is a component's id unless all its
    ids are null. Only the two named columns are read. An empty table gives an empty result.
    """
    key = F.lit(None).cast("string") if row_key is None else row_key
    keyed = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), key.alias("row_key"))
    docs = keyed.select("id", "text")
    id_type = docs.schema["id"].dataType.simpleString()
    prepared = settle(keyed.mapInArrow(
        lambda it: _describe(it, shingle, bands, rows),
        f"id {id_type}, row_key string, node binary, n bigint, bands array<bigint>, sketch binary, folds array<bigint>"), "signatures")
    nodes = prepared.where("node IS NOT NULL").groupBy("node").agg(
        F.min("id").alias("least_id"), F.count("*").alias("copies"), F.min("n").alias("n"), F.min("bands").alias("bands"),
        F.min("sketch").alias("sketch"), F.min("folds").alias("folds"))
    nodes = settle(nodes, "nodes")
    spread = nodes.select("node", "n", F.explode("bands").alias("key"))
    # Each bucket has a centre of its own, so that a node in 32 buckets meets many others.
    order = F.struct(F.xxhash64("key", "node").alias("h"), "node", "n")
    buckets = spread.groupBy("key").agg(F.min(order).alias("c"), F.count("*").alias("m")).where("m > 1")
    members = settle(spread.join(buckets.select("key", "c"), "key").select(
        "key", "node", "n", F.col("c.node").alias("center"), F.col("c.n").alias("n_center")), "members")

    star = members.where("node <> center").select(
        F.col("center").alias("a"), F.col("node").alias("b"), F.col("n_center").alias("n_a"), F.col("n").alias("n_b"))
    star = settle(star.where(_close(percent)).groupBy("a", "b").agg(F.count("*").alias("shared")), "stars")
    best = star.groupBy("b").agg(F.max(F.struct("shared", "a"))["a"].alias("a")).select("a", "b")
    best = settle(best, "best")
    links = _verified(best, docs, nodes, shingle, percent)
    labels = components(links)

    more = _with_labels(star.select("a", "b").join(best, ["a", "b"], "left_anti"), labels).select("a", "b")
    links = links.unionAll(_verified(more, docs, nodes, shingle, percent))
    labels = components(links)

    rest = members.select("key", "node", "n", "center").join(labels, "node", "left").select(
        "key", "node", "n", "center", F.coalesce("label", "node").alias("label"))
    rest = rest.join(_crossing(rest), "key").where("node <> center")
    crossing = _crossing(rest).withColumnRenamed("m", "others")
    rest = rest.drop("m").join(crossing, "key").join(nodes.select("node", "folds"), "node")
    rest = settle(rest, "unsettled")
    small = rest.where(F.col("others") <= CROWD).select("key", "node", "n", "label", "folds", F.col("n").alias("left"))
    crowded = rest.where(F.col("others") > CROWD).select("key", "node", "n", "label", "folds")
    pairs = _pairs_across(small, percent)
    if not crowded.isEmpty():
        pairs = pairs.unionAll(_prefix_pairs(crowded, docs, nodes, shingle, percent))
    pairs = pairs.distinct().join(star.select("a", "b"), ["a", "b"], "left_anti")
    pairs = settle(pairs, "across")
    if not pairs.isEmpty():
        links = links.unionAll(_verified(pairs, docs, nodes, shingle, percent))
        labels = components(links)

    owned = nodes.where("copies > 1").select("node").unionAll(labels.select("node")).distinct()
    owned = nodes.select("node", "least_id").join(owned, "node").join(labels, "node", "left").select(
        "node", "least_id", F.coalesce("label", "node").alias("label"))
    ids = owned.groupBy("label").agg(F.min("least_id").alias("component_id"))
    owned = owned.join(ids, "label").select("node", "component_id")
    out = prepared.select("id", "row_key", "node", F.col("n").alias("n_shingles")).join(owned, "node", "left")
    # A row of an owned node takes its component; any other row is its own.
    out = out.withColumn("component_id", F.coalesce("component_id", "id"))
    return out.select(F.col("id").alias(id_col), "n_shingles", "component_id",
                      F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
                      *(["row_key"] if row_key is not None else []))


def without_near_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows that `near_duplicates` keeps, with all their columns; a row that is there twice stays once."""
    kept = near_duplicates(df, id_col, text_col, row_key=row_key(id_col, text_col), **options).where("kept")
    return only_rows(df, kept.select("row_key"), id_col, text_col)
