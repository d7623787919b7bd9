"""Benchmark decontamination with a positional inverted index of the training texts.

The index is cut into segments of whole documents. A segment holds, for every term of its documents, the sorted
list of the word positions at which the term stands; it is one row of a stored table, so an index is built in
parallel without a shuffle and read as often as wanted. Benchmark windows go to the segments, and each segment
answers for its own documents: it takes the list of the window's rarest term, moves it by the term's place
in the window to get the places where the window could begin, and intersects these with the moved lists of the
next rarer terms until none is left or all have been seen. The same intersection with a tolerance gives
proximity matches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import textblocks as tb
from millrace.session import settle

WINDOW = 10
# Places that a word of a proximity match may stand from its own.
SLOP = 1
# (window, item) pairs that are searched for in one pass over the index.
QUERY_ROWS = 100_000
SEGMENT_BYTES = 1 << 20
# Places looked at in one step; a single list may be longer.
_STEP = 1 << 19

# Words are runs of a to z, 0 to 9 and everything outside ASCII.
_BETWEEN = np.ones(256, dtype=bool)
_BETWEEN[48:58] = _BETWEEN[97:123] = _BETWEEN[128:] = False

_SEGMENT = "segment bigint, ids array<{id}>, first binary, terms binary, starts binary, positions binary"


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of a block, and the first word of each text; the last entry is the number of words."""
    data = tb.lowered(data)
    begin, end, first = tb.words(data, offsets, _BETWEEN)
    return tb.word_hashes(data, begin, end), first


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """The index as a stored table, one row per segment: its documents' ids, the number of the first word of each,
    all its terms (64-bit hashes, ascending), where each term's list begins, and the lists.

    A segment has about `segment_bytes` of text, more if a document has more. Null and empty texts are
    documents without words. Ids may repeat and be null: a document is known by its place in its segment.
    """
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment = TaskContext.get().partitionId() << 32
        for batch in batches:
            for begin, end, data, offsets in tb.blocks(batch.column(1), segment_bytes):
                words, first = _words(data, offsets)
                positions = np.argsort(words, kind="stable").astype(np.int32)
                sorted_words = words[positions]
                starts = np.flatnonzero(np.concatenate([[True], sorted_words[1:] != sorted_words[:-1]])) if len(words) else np.zeros(0, int)
                blobs = (first.astype(np.int64), sorted_words[starts], np.append(starts, len(words)).astype(np.int32), positions)
                ids = batch.column(0).slice(begin, end - begin)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([segment]), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                     *(pa.array([x.tobytes()], pa.binary()) for x in blobs)],
                    ["segment", "ids", "first", "terms", "starts", "positions"])
                segment += 1

    return settle(texts.mapInArrow(run, _SEGMENT.format(id=texts.schema["id"].dataType.simpleString())), "index")


def windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text", size: int = WINDOW) -> DataFrame:
    """Distinct (item, window): the item's id as text, and the hashes of `size` consecutive words of it. An item
    of fewer words, but not none, has one window."""
    texts = items.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, _, data, offsets in tb.blocks(batch.column(1)):
                words, first = _words(data, offsets)
                for k, (a, b) in enumerate(zip(first[:-1], first[1:], strict=True)):
                    found = list(dict.fromkeys(words[i : min(i + size, b)].tobytes() for i in range(a, max(b - size, a) + 1) if b > a))
                    item = pa.repeat(pa.scalar(batch.column(0)[begin + k].as_py(), pa.string()), len(found))
                    yield pa.RecordBatch.from_arrays([item, pa.array(found, pa.binary())], ["item", "window"])

    return settle(texts.mapInArrow(run, "item string, window binary").distinct(), "windows")


class Queries:
    """Distinct windows as numbers of terms, padded with -1, and the items of each."""

    def __init__(self, rows: list[tuple[str | None, bytes]], size: int):
        self.items = sorted({item for item, _ in rows if item is not None}, key=lambda x: x.encode())
        number = {item: k for k, item in enumerate(self.items)}
        blobs = sorted({window for _, window in rows})
        place = {window: k for k, window in enumerate(blobs)}
        self.length = np.array([len(b) // 8 for b in blobs], dtype=np.int64)
        flat = np.frombuffer(b"".join(blobs), dtype=np.uint64)
        self.terms, which = np.unique(flat, return_inverse=True)
        self.places = np.full((len(blobs), size), -1, dtype=np.int64)
        self.places[np.arange(size) < self.length[:, None]] = which
        pairs = np.array(sorted((place[w], number[i]) for i, w in rows if i is not None), dtype=np.int64).reshape(-1, 2)
        self.item = pairs[:, 1]
        self.item_at = np.searchsorted(pairs[:, 0], np.arange(len(blobs) + 1))


class Segment:
    """The lists of one segment for the terms that are asked for."""

    def __init__(self, row: dict, queries: Queries):
        self.first = np.frombuffer(row["first"], dtype=np.int64)
        terms = np.frombuffer(row["terms"], dtype=np.uint64)
        starts = np.frombuffer(row["starts"], dtype=np.int32).astype(np.int64)
        self.positions = np.frombuffer(row["positions"], dtype=np.int32)
        at = np.searchsorted(terms, queries.terms)
        known = at < len(terms)
        known[known] = terms[at[known]] == queries.terms[known]
        self.start = np.where(known, starts[np.where(known, at, 0)], 0)
        self.count = np.where(known, np.diff(starts)[np.where(known, at, 0)] if len(terms) else 0, 0)
        # All lists in one: the number of the term, then the position.
        self.postings = (np.repeat(np.arange(len(at)), self.count) << 32) | self.positions[_runs(self.start, self.count)]

    def matches(self, queries: Queries, slop: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(document, window, place of the window's first word) of all matches, a bounded number at a time: every
        word of the window stands in the document, at most `slop` places from its own."""
        counts = np.where(queries.places >= 0, self.count[queries.places], np.iinfo(np.int64).max)
        able = np.flatnonzero((counts > 0).all(axis=1))
        order = np.argsort(counts[able], axis=1, kind="stable")
        rarest = counts[able, order[:, 0]] * (2 * slop + 1)
        step = np.cumsum(rarest) // _STEP
        for group in np.split(np.arange(len(able)), np.flatnonzero(np.diff(step)) + 1) if len(able) else []:
            yield self._intersect(queries, able[group], order[group], slop)

    def _intersect(self, queries: Queries, window: np.ndarray, order: np.ndarray, slop: int):
        anchor = queries.places[window, order[:, 0]]
        row = np.repeat(np.arange(len(window)), self.count[anchor])
        place = self.positions[_runs(self.start[anchor], self.count[anchor])].astype(np.int64)
        doc = np.searchsorted(self.first, place, side="right") - 1
        begin = place - order[row, 0]
        if slop:
            moves = np.arange(-slop, slop + 1)
            row, doc = np.repeat(row, len(moves)), np.repeat(doc, len(moves))
            begin = (begin[:, None] + moves).ravel()
        for rank in range(order.shape[1]):
            offset = order[row, rank]
            term = queries.places[window[row], offset]
            low = np.maximum(begin + offset - slop, self.first[doc])
            high = np.minimum(begin + offset + slop, self.first[doc + 1] - 1)
            at = np.searchsorted(self.postings, (term << 32) | np.maximum(low, 0))
            there = (at < len(self.postings)) & (low <= high)
            there[there] = self.postings[at[there]] <= ((term << 32) | high)[there]
            keep = there | (term < 0)
            row, doc, begin = row[keep], doc[keep], begin[keep]
        return doc, window[row], begin


def _runs(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Indices of all elements of runs, one run after another."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - counts), counts)


def _items(queries: Queries, doc: np.ndarray, window: np.ndarray, docs: int) -> pa.Array:
    """Ids of the items of the windows found in each document, each once, ascending."""
    pairs = np.unique(doc * len(queries.places) + window)
    doc, window = np.divmod(pairs, len(queries.places))
    counts = queries.item_at[window + 1] - queries.item_at[window]
    pairs = np.unique(np.repeat(doc, counts) * max(len(queries.items), 1) + queries.item[_runs(queries.item_at[window], counts)])
    doc, item = np.divmod(pairs, max(len(queries.items), 1))
    ends = np.searchsorted(doc, np.arange(docs + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(ends, pa.array(queries.items, pa.string()).take(pa.array(item)))


def _found(segment: Segment, queries: Queries, slop: int) -> tuple[np.ndarray, np.ndarray, pa.Array, pa.Array]:
    """Document, begin and end of every stretch of hit words, and the items of exact and of proximity matches."""
    docs, words = len(segment.first) - 1, int(segment.first[-1])
    change = np.zeros(words + 1, dtype=np.int64)
    exact = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for doc, window, begin in segment.matches(queries, 0):
        np.add.at(change, begin, 1)
        np.add.at(change, begin + queries.length[window], -1)
        exact.append((doc, window))
    near = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for doc, window, _ in segment.matches(queries, slop) if slop else ():
        near.append((doc, window))
    hit = np.concatenate([[0], (np.cumsum(change[:-1]) > 0).astype(np.int8), [0]])
    # Stretches that touch at the end of a document are two.
    inner = segment.first[1:-1]
    inner = inner[(inner > 0) & (inner < words)]
    inner = np.unique(inner[(hit[inner] & hit[inner + 1]).astype(bool)])
    begin = np.union1d(np.flatnonzero(np.diff(hit) == 1), inner)
    end = np.union1d(np.flatnonzero(np.diff(hit) == -1), inner)
    lists = [_items(queries, *(np.concatenate(x) for x in zip(*m, strict=True)), docs) for m in (exact, near)]
    return begin, end, *lists


def _search(index: DataFrame, queries: Broadcast, slop: int) -> DataFrame:
    id_type = index.schema["ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k].as_py() for c in ("segment", "first", "terms", "starts", "positions")}
                segment = Segment(row, queries.value)
                begin, end, items, near = _found(segment, queries.value, slop)
                docs, first = len(segment.first) - 1, segment.first
                doc = np.searchsorted(first, begin, side="right") - 1
                spans = pa.StructArray.from_arrays([pa.array(begin - first[doc]), pa.array(end - first[doc])], ["begin", "end"])
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(pa.scalar(row["segment"], pa.int64()), docs), pa.array(np.arange(docs)), batch.column("ids")[k].values,
                     pa.array(np.diff(first)), pa.ListArray.from_arrays(np.searchsorted(doc, np.arange(docs + 1)).astype(np.int32), spans),
                     items, near], ["segment", "place", "id", "n_words", "spans", "items", "near_items"])

    return index.mapInArrow(run, f"segment bigint, place bigint, id {id_type}, n_words bigint, "
                            "spans array<struct<begin:bigint,end:bigint>>, items array<string>, near_items array<string>")


# The stretches of a document as one set: sorted, then each counts from where the one before it ended.
_COVERED = """aggregate(array_sort(spans), named_struct('n', 0L, 'to', 0L), (s, x) -> named_struct(
  'n', s.n + greatest(x.end - greatest(x.begin, s.to), 0L), 'to', greatest(s.to, x.end)), s -> s.n)"""


def search(index: DataFrame, wanted: DataFrame, slop: int = SLOP, query_rows: int = QUERY_ROWS, size: int = WINDOW) -> DataFrame:
    """One row per document of the index: segment, place (its number there), id, n_words, spans (begin and end of the
    stretches of words that lie in matches), items (of exact matches) and near_items (of proximity matches, which
    include the exact ones), both as sorted texts.

    wanted: a stored table of `windows`. It is searched for in blocks of about `query_rows` rows, each of which is
    collected and broadcast; every block reads the whole index once. With one block nothing is shuffled.
    """
    spark = index.sparkSession
    blocks = max(-(-wanted.count() // query_rows), 1)
    block = F.pmod(F.xxhash64("item", "window"), F.lit(blocks))
    found = []
    for k in range(blocks):
        rows = [(r["item"], bytes(r["window"])) for r in wanted.where(block == k).collect()]
        part = _search(index, spark.sparkContext.broadcast(Queries(rows, size)), slop)
        found.append(part if blocks == 1 else settle(part.where("size(spans) + size(near_items) > 0") if k else part, "found"))
    out = found[0]
    for part in found[1:]:
        out = out.unionAll(part)
    if blocks == 1:
        return out
    # A document is in no more rows than there are blocks.
    merged = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c)
    return out.groupBy("segment", "place").agg(
        F.first("id").alias("id"), F.first("n_words").alias("n_words"), merged("spans"), merged("items"), merged("near_items"))


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", size: int = WINDOW, slop: int = SLOP, query_rows: int = QUERY_ROWS) -> DataFrame:
    """One row per document: id, n_words, n_hit, n_items, items_sha256, contaminated, n_near_items.

    Words are runs of letters a to z, digits and characters outside ASCII, A to Z lower-cased. A window is
    `size` consecutive words of an item, or all words of a shorter item. n_hit counts the document's words inside any
    occurrence of a window, n_items the items with an occurring window, items_sha256 is the hash of their ids as
    sorted texts with commas between; n_near_items counts the items with a window whose words all stand in the
    document at most `slop` places from their own. Words are compared by 64-bit hashes.

    Null, empty and wordless texts have no words and no hits; a wordless item has no window. Windows of an item whose
    id is null hit words, but count as no item; items that share an id are one item. Rows that repeat an id each
    give a row. Without items nothing is hit; without documents the result is empty. Only the named columns are read.
    """
    index = build_index(docs, id_col, text_col)
    found = search(index, windows(items, item_col, item_text_col, size), slop, query_rows, size)
    n_hit = F.expr(_COVERED)
    return found.select(
        F.col("id").alias(id_col), "n_words", n_hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
        F.size("near_items").cast("bigint").alias("n_near_items"))
