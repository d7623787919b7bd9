"""SentencePiece encoding and decoding: the best segmentation under a piece vocabulary, by streaming Viterbi.

The best segmentation is the one with the highest sum of piece scores; of equal ones, the one whose pieces
begin earlier wins at each boundary. Text is read as UTF-8 with one space put before it. Characters that no
path covers become byte pieces, so decoding gives every text back exactly.

Viterbi runs over a stream: `StreamCoder` keeps only the scores of the last positions, as many as the
longest piece has bytes, and the back-pointers since the last boundary that all surviving paths share; at
such a boundary ids are committed and forgotten. Many boundaries are known beforehand: where two neighbouring
bytes occur side by side in no piece, every path has a boundary. `encode_block` cuts texts there, computes
each distinct stretch of a block once, all stretches in step, and leaves stretches longer than LANE bytes to
the stream coder.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import textblocks as tb

LANE = 96
UNKNOWN_PENALTY = 10.0
# Of a position that no path reaches or needs.
_NEVER = -(1 << 62)


class Vocabulary:
    """Pieces with ids and scores: `texts` of normal pieces as bytes with plain spaces, `byte_ids` of the
    256 byte pieces, ids that decode to nothing in `silent`. Plain data, small, and safe to broadcast, with the
    tables that are made of it once."""

    def __init__(self, texts: dict[bytes, tuple[int, float]], byte_ids: list[int], silent: set[int], size: int):
        self.texts, self.byte_ids, self.silent, self.size = texts, byte_ids, silent, size
        self._tables = None

    @classmethod
    def load(cls, model_file: str) -> Vocabulary:
        """Read the pieces of a model file. Its own segmentation is not used."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        texts, byte_ids, silent = {}, [-1] * 256, set()
        for number in range(model.vocab_size()):
            piece = model.id_to_piece(number)
            if model.is_byte(number):
                byte_ids[int(piece[3:5], 16)] = number
            elif model.is_control(number) or model.is_unused(number) or model.is_unknown(number):
                silent.add(number)
            else:
                texts[piece.replace("▁", " ").encode()] = (number, model.get_score(number))
        if min(byte_ids) < 0:
            raise ValueError("the model has no byte pieces, so not every text could be encoded")
        return cls(texts, byte_ids, silent, model.vocab_size())

    @property
    def tables(self) -> _Tables:
        if self._tables is None:
            self._tables = _Tables(self)
        return self._tables


class _Tables:
    """A trie over the bytes of all pieces, and what decoding needs, as arrays. Nodes without children share the
    first row of `step`, so a node costs 512 bytes only if something follows it."""

    def __init__(self, vocabulary: Vocabulary):
        texts = list(vocabulary.texts)
        self.longest = max(map(len, texts), default=1)
        flat = np.zeros((len(texts), self.longest), dtype=np.uint8)
        size = np.array([len(t) for t in texts], dtype=np.int64)
        flat[np.arange(self.longest) < size[:, None]] = np.frombuffer(b"".join(texts), dtype=np.uint8)
        # Level by level: the node of a piece's next byte is one for each node before it and byte.
        node, edges, nodes = np.zeros(len(texts), dtype=np.int64), [], 1
        for level in range(self.longest):
            on = size > level
            keys, which = np.unique(node[on] * 256 + flat[on, level], return_inverse=True)
            edges.append((keys // 256, keys % 256, nodes + np.arange(len(keys))))
            node[on] = nodes + which
            nodes += len(keys)
        parent, byte, child = (np.concatenate(x) for x in zip(*edges, strict=True))
        inner = np.unique(parent)
        self.row = np.zeros(nodes, dtype=np.int32)
        self.row[inner] = 1 + np.arange(len(inner))
        self.step = np.zeros((len(inner) + 1, 256), dtype=np.uint16 if nodes < 1 << 16 else np.int32)
        self.step[self.row[parent], byte] = child
        self.number = np.full(nodes, -1, dtype=np.int32)
        self.score = np.zeros(nodes)
        self.number[node] = [piece for piece, _ in vocabulary.texts.values()]
        self.score[node] = [value for _, value in vocabulary.texts.values()]
        self.pairs = np.zeros((256, 256), dtype=bool)
        for k in range(self.longest - 1):
            on = size > k + 1
            self.pairs[flat[on, k], flat[on, k + 1]] = True
        self.unknown = min((v for _, v in vocabulary.texts.values()), default=0.0) - UNKNOWN_PENALTY
        self.byte_ids = np.array(vocabulary.byte_ids, dtype=np.int32)
        spoken = [b""] * vocabulary.size
        for text, (piece, _) in vocabulary.texts.items():
            spoken[piece] = text
        for k, piece in enumerate(vocabulary.byte_ids):
            spoken[piece] = bytes([k])
        self.spoken = np.frombuffer(b"".join(spoken), dtype=np.uint8)
        self.spoken_at = np.concatenate([[0], np.cumsum([len(s) for s in spoken])])
        self._edges: dict[int, int] | None = None

    def edges(self) -> dict[int, int]:
        """The trie as one mapping of node * 256 + byte, for single steps; made when first asked for."""
        if self._edges is not None:
            return self._edges
        row, byte = np.nonzero(self.step)
        node = np.zeros(len(self.step), dtype=np.int64)
        node[self.row] = np.arange(len(self.row))
        keep = row > 0
        self._edges = dict(zip((node[row[keep]] * 256 + byte[keep]).tolist(), self.step[row[keep], byte[keep]].tolist(), strict=True))
        return self._edges


class StreamCoder:
    """Viterbi over a stream of bytes. `feed` takes bytes and returns the ids committed so far, `finish` the
    rest. Bytes must add up to whole characters.

    Scores and bytes are kept for a window of the longest piece. Back-pointers form a tree whose root is the last
    boundary committed. A position counts the pointers to it; one that the window has passed and that none points to
    is let go, and so are those before it that nothing else needs. Where the root has one successor left, all surviving
    paths go through that, and its ids are committed. Every position is added and let go once, so the time is
    proportional to the stream. What is kept is the window and the surviving paths: where paths never meet, as in
    a long run of one letter, a start and a piece for each of their positions.
    """

    def __init__(self, vocabulary: Vocabulary, edges: dict[int, int] | None = None):
        t = vocabulary.tables
        self.longest, self.unknown, self.byte_ids = max(t.longest, 4), t.unknown, t.byte_ids
        self.edges = t.edges() if edges is None else edges
        self.number, self.score = t.number, t.score
        self.bytes, self.at = bytearray(), 0  # bytes from position `at` on; the next position to try pieces at
        self.best: dict[int, float] = {0: 0.0}  # scores of the positions reached, from `at` on
        self.root = self.origin = 0
        # By position from origin: start of the last piece; its id, or the bytes of a bare character below zero; how many
        # pointers come here; the exclusive or of the positions they come from.
        self.start, self.piece, self.refs, self.heirs = array("q", [0]), array("q", [0]), array("h", [0]), array("q", [0])

    def feed(self, data: bytes) -> list[int]:
        self.bytes += data
        return self._advance(self.at + len(self.bytes) - self.longest)

    def finish(self) -> list[int]:
        """The ids that were left; the best path is the one to the end."""
        end = self.at + len(self.bytes)
        out = self._advance(end - 1)
        path = []
        while end > self.root:
            path.append(self.piece[end - self.origin])
            end = self.start[end - self.origin]
        for piece in reversed(path):
            out += self._ids(piece)
        return out

    def _ids(self, piece: int) -> list[int]:
        if piece >= 0:
            return [piece]
        width, char = divmod(-piece, 1 << 32)
        return [int(self.byte_ids[b]) for b in char.to_bytes(width, "big")]

    def _advance(self, last: int) -> list[int]:
        """Try pieces at all positions up to `last`."""
        out, first = [], self.at
        while self.at <= last:
            score = self.best.pop(self.at, None)
            if score is not None:
                if self.at > self.root:  # no better path to here will come: it counts for where it comes from
                    place = self.start[self.at - self.origin] - self.origin
                    self.refs[place] += 1
                    self.heirs[place] ^= self.at
                self._try_pieces(score, self.at - first)
            passed = self.at - self.longest
            if passed > self.root:
                self._let_go(passed, passed)
            while self.root <= passed and self.refs[self.root - self.origin] == 1:
                self.root = self.heirs[self.root - self.origin]
                out += self._ids(self.piece[self.root - self.origin])
            self.at += 1
        del self.bytes[: self.at - first]
        done = self.root - self.origin
        if done > 4096 and 2 * done > len(self.start):
            for kept in (self.start, self.piece, self.refs, self.heirs):
                del kept[:done]
            self.origin = self.root
        return out

    def _let_go(self, position: int, oldest: int) -> None:
        """A position without pointers to it, and those before it that only led here."""
        while self.root < position <= oldest:
            place = position - self.origin
            if self.refs[place] or self.piece[place] == _NEVER:
                return
            before = self.start[place]
            self.piece[place] = _NEVER
            self.refs[before - self.origin] -= 1
            self.heirs[before - self.origin] ^= position
            position = before

    def _reach(self, position: int, score: float, piece: int) -> None:
        place = position - self.origin
        while len(self.start) <= place:
            for kept, value in ((self.start, 0), (self.piece, _NEVER), (self.refs, 0), (self.heirs, 0)):
                kept.append(value)
        known = self.best.get(position)
        if known is None or score > known:
            self.best[position], self.start[place], self.piece[place] = score, self.at, piece

    def _try_pieces(self, score: float, offset: int) -> None:
        data, node, end = self.bytes, 0, offset
        if offset >= len(data):
            return
        first = data[offset]
        size = 1 if first < 0xC0 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
        covered = False
        while end < len(data) and (node := self.edges.get(node * 256 + data[end], 0)):
            end += 1
            number = int(self.number[node])
            if number >= 0:
                covered |= end - offset == size
                self._reach(self.at + end - offset, score + float(self.score[node]), number)
        if not covered:
            char = int.from_bytes(data[offset : offset + size], "big")
            self._reach(self.at + size, score + self.unknown, -((size << 32) + char))


def stream_ids(vocabulary: Vocabulary, data: bytes, chunk: int = 4096, edges: dict[int, int] | None = None) -> list[int]:
    """Ids of one stretch of bytes, a chunk at a time."""
    coder, out = StreamCoder(vocabulary, edges), []
    for at in range(0, len(data), chunk):
        out += coder.feed(data[at : at + chunk])
    return out + coder.finish()


def _ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Indices of all elements of runs, one run after another."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - counts), counts)


def _spaced(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The block with one space before every text that is not empty."""
    sizes = np.diff(offsets)
    begin = offsets[:-1] + np.cumsum(sizes > 0) - (sizes > 0)
    out = np.full(len(data) + int((sizes > 0).sum()), 32, dtype=np.uint8)
    out[_ragged(begin + 1, sizes)] = data
    return out, np.concatenate([begin, [len(out)]])


def _lanes(vocabulary: Vocabulary, data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of many stretches, Viterbi in step over all of them; and the number of ids of each."""
    t = vocabulary.tables
    flat = data[_ragged(begin, size)]
    first = np.cumsum(size) - size  # of each stretch in flat; its boundaries start at first + its number
    lane = np.repeat(np.arange(len(size)), size)
    place = np.arange(len(flat)) - first[lane]
    rest = size[lane] - place
    starts = np.flatnonzero((flat & 0xC0) != 0x80)
    lead = flat[starts]
    width = np.where(lead < 0xC0, 1, np.where(lead < 0xE0, 2, np.where(lead < 0xF0, 3, 4)))

    # All pieces at all positions, by length: a walk of the trie from every character.
    arcs = []
    node, live, covered = np.zeros(len(starts), np.int32), np.arange(len(starts)), np.zeros(len(starts), bool)
    for length in range(1, t.longest + 1):
        at = starts[live]
        inside = rest[at] >= length
        live, node, at = live[inside], node[inside], at[inside]
        node = t.step[t.row[node], flat[at + length - 1]].astype(np.int32)
        on = node > 0
        live, node, at = live[on], node[on], at[on]
        if not len(live):
            break
        ends = t.number[node] >= 0
        arcs.append((at[ends], np.full(int(ends.sum()), length), t.score[node[ends]], t.number[node[ends]]))
        covered[live[ends]] |= width[live[ends]] == length
    bare = starts[~covered]
    arcs.append((bare, width[~covered], np.full(len(bare), t.unknown), np.full(len(bare), -1, np.int32)))
    at, length, score, number = (np.concatenate(x) for x in zip(*arcs, strict=True))

    # By the place of their end, longer pieces first; each group has at most one arc for each stretch.
    end = place[at] + length
    order = np.argsort((end * (t.longest + 4) + t.longest + 3 - length).astype(np.int32), kind="stable")
    at, length, score, number, end = at[order], length[order], score[order], number[order], end[order]
    edges = np.flatnonzero(np.diff(end, prepend=-1) | np.diff(length, prepend=-1))
    source, target = at + lane[at], at + lane[at] + length
    best = np.full(len(flat) + len(size), -np.inf)
    best[first + np.arange(len(size))] = 0.0
    back = np.full(len(best), -1, dtype=np.int64)
    for a, b in zip(edges, [*edges[1:], len(at)], strict=True):
        value = best[source[a:b]] + score[a:b]
        better = np.flatnonzero(value > best[target[a:b]])
        best[target[a:b][better]] = value[better]
        back[target[a:b][better]] = a + better

    # Back from the ends, all stretches in step; a bare character gives an id for each of its bytes.
    origin = first + np.arange(len(size))
    here, steps = origin + size, []
    open_ = np.arange(len(size))
    while len(open_):
        arc = back[here[open_]]
        steps.append((open_, arc))
        here[open_] = source[arc]
        open_ = open_[here[open_] > origin[open_]]
    lanes, arc = (np.concatenate(x) for x in zip(*reversed(steps), strict=True))
    order = np.argsort(lanes, kind="stable")
    lanes, arc = lanes[order], arc[order]
    plain = number[arc] >= 0
    counts = np.where(plain, 1, length[arc])
    ids = np.repeat(number[arc], counts)
    loose = np.repeat(~plain, counts)
    if loose.any():
        ids[loose] = t.byte_ids[flat[_ragged(at[arc[~plain]], length[arc[~plain]])]]
    return ids, np.bincount(lanes, weights=counts, minlength=len(size)).astype(np.int64)


def encode_block(vocabulary: Vocabulary, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the texts of a block, and where each text's ids begin; the last entry is their number."""
    data, offsets = _spaced(data, offsets)
    if not len(data):
        return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
    cut = np.ones(len(data), dtype=bool)
    cut[1:] = ~vocabulary.tables.pairs[data[:-1], data[1:]] & ((data[1:] & 0xC0) != 0x80)
    cut[offsets[:-1][np.diff(offsets) > 0]] = True
    begin = np.flatnonzero(cut)
    end = np.append(begin[1:], len(data))
    # Equal stretches once: found by a hash, confirmed by another one.
    hashes, check = tb.word_hashes(data, begin, end), tb.word_hashes(data[::-1], len(data) - end, len(data) - begin)
    _, chosen, which = np.unique(hashes, return_index=True, return_inverse=True)
    if not np.array_equal(check[chosen][which], check):
        chosen = which = np.arange(len(begin))
    begin, size = begin[chosen], (end - begin)[chosen]
    short = np.flatnonzero(size <= LANE)
    ids, counts = np.zeros(0, np.int32), np.zeros(len(chosen), np.int64)
    if len(short):
        ids, counts[short] = _lanes(vocabulary, data, begin[short], size[short])
    starts = np.zeros(len(chosen), np.int64)
    starts[short] = np.cumsum(counts[short]) - counts[short]
    long, used = np.flatnonzero(size > LANE), len(ids)
    edges = vocabulary.tables.edges() if len(long) else {}
    parts = [ids]
    for k in long:
        parts.append(np.array(stream_ids(vocabulary, data[begin[k] : begin[k] + size[k]].tobytes(), edges=edges), np.int32))
        starts[k], counts[k] = used, len(parts[-1])
        used += len(parts[-1])
    ids = np.concatenate(parts)
    totals = np.concatenate([[0], np.cumsum(counts[which])])
    return ids[_ragged(starts[which], counts[which])], totals[np.searchsorted(np.flatnonzero(cut), offsets)]


def decode_block(vocabulary: Vocabulary, ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the texts of ids, and where each begins. Ids that are no piece decode to nothing."""
    t = vocabulary.tables
    known = (ids >= 0) & (ids < vocabulary.size)
    ids = np.where(known, ids, 0)
    sizes = np.where(known, np.diff(t.spoken_at)[ids], 0)
    data = t.spoken[_ragged(t.spoken_at[ids], sizes)]
    offsets = np.concatenate([[0], np.cumsum(sizes)])[at]
    # The space that encoding puts first goes again.
    lead = (np.diff(offsets) > 0)
    lead[lead] = data[offsets[:-1][lead]] == 32
    keep = np.ones(len(data), dtype=bool)
    keep[offsets[:-1][lead]] = False
    return data[keep], offsets - np.concatenate([[0], np.cumsum(lead)])


def _encode(batches: Iterator[pa.RecordBatch], shared: Broadcast, check: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, end, data, offsets in tb.blocks(batch.column(1)):
            ids, at = encode_block(shared.value, data, offsets)
            columns = [batch.column(0).slice(first, end - first), pa.array(np.diff(at), pa.int64()),
                       pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids, pa.int32()))]
            if check:
                back, where = decode_block(shared.value, ids, at)
                columns.append(pa.array([hashlib.sha256(back[a:b]).hexdigest() for a, b in zip(where[:-1], where[1:], strict=True)]))
            yield pa.RecordBatch.from_arrays(columns, ["id", "n_ids", "ids", "decoded_sha256"][: len(columns)])


def _shared(df: DataFrame, vocabulary: Vocabulary) -> Broadcast:
    """The vocabulary with its tables, made here once and by no executor."""
    _ = vocabulary.tables
    return df.sparkSession.sparkContext.broadcast(vocabulary)


def encode(df: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text",
           check: bool = False) -> DataFrame:
    """One row per input row: id, n_ids, ids; with `check` also decoded_sha256, the hash of what the ids
    decode to.

    Null and empty texts have no ids. A text may be of any length and need not hold a space. Rows that repeat
    an id each give a row. Only the two named columns are read. The vocabulary goes to the executors as a
    broadcast variable; its size does not depend on the data.
    """
    docs = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    shared = _shared(df, vocabulary)
    schema = f"id {docs.schema['id'].dataType.simpleString()}, n_ids bigint, ids array<int>"
    out = docs.mapInArrow(lambda it: _encode(it, shared, check), schema + (", decoded_sha256 string" if check else ""))
    return out.withColumnRenamed("id", id_col)


def _decode(batches: Iterator[pa.RecordBatch], shared: Broadcast) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first in range(0, batch.num_rows, 256):
            part = batch.slice(first, 256)
            lists = part.column(1)
            at = np.concatenate([[0], np.cumsum([len(x) if x.is_valid else 0 for x in lists])])
            flat = lists.drop_null().flatten().fill_null(-1).to_numpy(zero_copy_only=False)
            data, offsets = decode_block(shared.value, flat, at)
            texts = [data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], ["id", "text"])


def decode(df: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, text) of every row. Null lists and null or unknown ids give nothing; bytes that are no valid text
    give replacement characters. A space at the beginning is the one that encoding added, and goes."""
    rows = df.select(F.col(id_col).alias("id"), F.col(ids_col).cast("array<int>").alias("ids"))
    shared = _shared(df, vocabulary)
    out = rows.mapInArrow(lambda it: _decode(it, shared), f"id {rows.schema['id'].dataType.simpleString()}, text string")
    return out.withColumnRenamed("id", id_col)
