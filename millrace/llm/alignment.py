"""Cross-tokenizer alignment: byte-level tokens (A) against pieces (B) of the same texts.

Texts are encoded as a whole by both tokenizers, and kept only if the bytes of both sides' tokens are those of the
text. A place where both sides end a token and both go on with a token marked by a space is an anchor; anchors cut a text into
windows of token ids. The same windows come again and again, so the alignment of a window (its groups, written as
text) is worked out once and remembered under the ids of both sides.

Tokenizers never join what stands before a single space with what follows it, so a text's ids are those of its
stretches from space to space, and ids of short stretches are remembered too.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import textblocks as tb
from millrace.session import new_folder, settle

# What a worker remembers: stretches of up to so many bytes, windows of up to so many ids, so many of each.
SHORT, FEW, REMEMBERED = 48, 24, 300_000
# Short stretches that are encoded as one text.
_JOINED = 2048
# Id pairs whose counts are broadcast at once.
PAIR_ROWS = 4_000_000
# Different pairs that a task gathers before it hands on their counts.
_GATHERED = 1 << 21


def byte_level_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level entry stands for: printable characters of Latin-1 for
    themselves, the others in order from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


# Fixed value: how the byte-level tokenizer splits texts before it joins pairs.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def ids_are_ranks(byte_level: str) -> bool:
    """Whether joining the neighbours that make the entry with the lowest id gives the same ids as the file's merges.

    It does if merges are listed in the order of the ids they make, and every entry, taken alone, is joined to
    itself. For then, whenever two tokens stand side by side whose bytes are an entry, they have come about
    inside these bytes alone, as they do in the entry, so they are the pair that its merge names.
    """
    from tokenizers import Tokenizer

    tokenizer, model = Tokenizer.from_str(byte_level), json.loads(byte_level)["model"]
    if json.loads(byte_level)["pre_tokenizer"] != {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}:
        return False
    vocabulary = model["vocab"]
    special = {t["content"] for t in json.loads(byte_level)["added_tokens"]}
    made = [vocabulary["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    return made == sorted(made) and all(
        [t.id for t in tokenizer.model.tokenize(entry)] == [number] for entry, number in vocabulary.items() if entry not in special)


class Tokenizers:
    """Both tokenizers from their files' bytes, made when first used; safe to broadcast. If `ranks`, side A's ids serve
    as ranks for a faster encoder of ASCII stretches, with the same result."""

    def __init__(self, byte_level: str, pieces: bytes):
        self.byte_level, self.pieces, self._made = byte_level, pieces, None
        self.ranks = ids_are_ranks(byte_level)

    @classmethod
    def load(cls, byte_level_file: str, piece_file: str) -> Tokenizers:
        with open(byte_level_file, encoding="utf-8") as one, open(piece_file, "rb") as two:
            return cls(one.read(), two.read())

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_made": None}

    @property
    def made(self) -> _Made:
        if self._made is None:
            self._made = _Made(self)
        return self._made


class _Stretches:
    """Ids of both sides of the stretches seen so far. Full, it starts anew."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.number: dict[bytes, int] = {}
        self.sides = [_Lists(), _Lists()]

    def add(self, keys: list[bytes], sides: list[tuple[np.ndarray, np.ndarray]]) -> None:
        self.number.update(zip(keys, range(len(self.number), len(self.number) + len(keys)), strict=True))
        for lists, (flat, sizes) in zip(self.sides, sides, strict=True):
            lists.extend(flat, sizes)


class _Lists:
    """Lists of ids, one after another, that more are added to."""

    def __init__(self):
        self.flat, self.used = np.zeros(1 << 12, np.int32), 0
        self.size, self.rows = np.zeros(1 << 12, np.int64), 0
        self.at = np.zeros(1 << 12, np.int64)

    def extend(self, flat: np.ndarray, sizes: np.ndarray) -> None:
        while self.used + len(flat) > len(self.flat):
            self.flat = np.resize(self.flat, 2 * len(self.flat))
        while self.rows + len(sizes) > len(self.size):
            self.size, self.at = np.resize(self.size, 2 * len(self.size)), np.resize(self.at, 2 * len(self.at))
        self.flat[self.used : self.used + len(flat)] = flat
        rows = slice(self.rows, self.rows + len(sizes))
        self.size[rows], self.at[rows] = sizes, self.used + np.cumsum(sizes) - sizes
        self.used, self.rows = self.used + len(flat), rows.stop


class _Made:
    def __init__(self, files: Tokenizers):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(files.byte_level)
        # Strings of special tokens inside texts are plain text.
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=files.pieces)
        byte_of = byte_level_alphabet()
        vocabulary = json.loads(files.byte_level)["model"]["vocab"]
        spoken_a = [b""] * (max([*vocabulary.values(), self.a.get_vocab_size() - 1]) + 1)
        for entry, number in vocabulary.items():
            spoken_a[number] = bytes(byte_of[c] for c in entry if c in byte_of)
        spoken_b = []
        for number in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(number)
            plain = piece.replace("▁", " ").encode()
            spoken_b.append(bytes([int(piece[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", piece) else plain)
        self.spoken = [_Spoken(spoken_a), _Spoken(spoken_b)]
        self.digits = _Spoken([b"%d," % k for k in range(max(len(spoken_a), len(spoken_b)))])
        self.fast = None
        if files.ranks:
            import tiktoken

            special = {t["content"] for t in json.loads(files.byte_level)["added_tokens"]}
            ranks = {spoken_a[number]: number for entry, number in vocabulary.items() if entry not in special}
            self.fast = tiktoken.Encoding("side A", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        self.stretches = _Stretches()
        # The groups of a window as text and their number, by the ids of both sides.
        self.windows: dict[bytes, tuple[bytes, int]] = {}

    def encode(self, side: int, text: str) -> np.ndarray:
        """Ids of a text that begins with a space, which side B puts there itself."""
        if side == 1:
            ids = self.b.encode(text[1:])
        elif self.fast and text.isascii():
            ids = self.fast.encode_ordinary(text)
        else:
            ids = self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids
        return np.array(ids, dtype=np.int32)

    def encode_each(self, side: int, stretches: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many stretches and their numbers."""
        found = [self.encode(side, s.decode()) for s in stretches]
        return np.concatenate([*found, np.zeros(0, np.int32)]), np.array([len(x) for x in found], dtype=np.int64)

    def encode_joined(self, side: int, stretches: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many stretches that may stand next to each other in a text, and their numbers: they are encoded as
        texts of many, and the ids dealt out by their bytes."""
        flat, sizes = [], []
        for first in range(0, len(stretches), _JOINED):
            part = stretches[first : first + _JOINED]
            ids = self.encode(side, b"".join(part).decode())
            tops = np.cumsum(self.spoken[side].size[ids])
            want = np.cumsum([len(s) for s in part])
            at = np.minimum(np.searchsorted(tops, want), len(tops) - 1)
            if np.array_equal(tops[at], want) and tops[-1] == want[-1]:
                flat.append(ids)
                sizes.append(np.diff(at + 1, prepend=0))
            else:  # a side that does not give bytes back
                ids, own = self.encode_each(side, part)
                flat.append(ids)
                sizes.append(own)
        return np.concatenate([*flat, np.zeros(0, np.int32)]), np.concatenate([*sizes, np.zeros(0, np.int64)])


class _Spoken:
    """The bytes of every id of a side."""

    def __init__(self, texts: list[bytes]):
        self.size = np.array([len(t) for t in texts], dtype=np.int64)
        self.at = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(texts), dtype=np.uint8)
        self.spaced = np.array([t.startswith(b" ") for t in texts])

    def bytes_of(self, ids: np.ndarray) -> np.ndarray:
        return self.data[_runs(self.at[ids], self.size[ids])]


def _runs(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Indices of all elements of runs, one run after another."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - counts), counts)


def _spaced(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The block with one space before every text that is not empty."""
    sizes = np.diff(offsets)
    begin = offsets[:-1] + np.cumsum(sizes > 0) - (sizes > 0)
    out = np.full(len(data) + int((sizes > 0).sum()), 32, dtype=np.uint8)
    out[_runs(begin + 1, sizes)] = data
    return out, np.concatenate([begin, [len(out)]])


def encode_block(made: _Made, data: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For both sides the ids of the texts of a block, each text with its space, and where each text's begin."""
    # A single space between two printable ASCII characters begins a stretch.
    solid = (data > 32) & (data < 127)
    cut = np.zeros(len(data), dtype=bool)
    cut[1:-1] = (data[1:-1] == 32) & solid[:-2] & solid[2:]
    cut[offsets[:-1][np.diff(offsets) > 0]] = True
    begin = np.flatnonzero(cut)
    end = np.append(begin[1:], len(data))
    # Equal stretches once: found by a hash, confirmed by another one.
    hashes, check = tb.word_hashes(data, begin, end), tb.word_hashes(data[::-1], len(data) - end, len(data) - begin)
    _, chosen, which = np.unique(hashes, return_index=True, return_inverse=True)
    if not np.array_equal(check[chosen][which], check):
        chosen = which = np.arange(len(begin))
    raw = data.tobytes()
    keys = [raw[a:b] for a, b in zip(begin[chosen].tolist(), end[chosen].tolist(), strict=True)]
    of_text = np.searchsorted(begin, offsets)
    table = made.stretches
    if len(table.number) + len(keys) > REMEMBERED:
        table.clear()
    new = [key for key in keys if len(key) <= SHORT and key not in table.number]
    inner = lambda s: len(s) > 1 and 32 < s[1] < 127 and 32 < s[-1] < 127
    for ascii_ in (True, False):
        part = [s for s in new if inner(s) and s.isascii() == ascii_]
        table.add(part, [made.encode_joined(side, part) for side in (0, 1)])
    part = [s for s in new if not inner(s)]
    table.add(part, [made.encode_each(side, part) for side in (0, 1)])
    long = [k for k, key in enumerate(keys) if len(key) > SHORT]
    number = np.array([table.number.get(key, 0) for key in keys], dtype=np.int64)
    out = []
    for side, lists in enumerate(table.sides):
        once = [made.encode(side, keys[k].decode()) for k in long]
        flat = np.concatenate([lists.flat[: lists.used], *once])
        starts, counts = lists.at[number], lists.size[number]
        sizes = np.array([len(x) for x in once], dtype=np.int64)
        starts[long], counts[long] = lists.used + np.cumsum(sizes) - sizes, sizes
        ids = flat[_runs(starts[which], counts[which])]
        out.append((ids, np.concatenate([[0], np.cumsum(counts[which])])[of_text]))
    return out


def verified(made: _Made, data: np.ndarray, offsets: np.ndarray, sides: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Which texts both sides give back byte for byte."""
    good = np.diff(offsets) > 0
    for spoken, (ids, at) in zip(made.spoken, sides, strict=True):
        size = np.concatenate([[0], np.cumsum(spoken.size[ids])])[at]
        whole = np.diff(size) == np.diff(offsets)
        if np.array_equal(size, offsets):
            wrong = np.flatnonzero(spoken.bytes_of(ids) != data)
            whole[np.searchsorted(offsets, wrong, side="right") - 1] = False
        else:
            for k in np.flatnonzero(good & whole):
                whole[k] = np.array_equal(spoken.bytes_of(ids[at[k] : at[k + 1]]), data[offsets[k] : offsets[k + 1]])
        good &= whole
    return good


def group_texts(made: _Made, sides: list[np.ndarray], at: list[np.ndarray]) -> tuple[list[bytes], np.ndarray]:
    """The groups of windows as text, `a1,a2|b1;a3|b2,b3`, and their numbers. sides: ids of both sides, window after window;
    at: where each window begins in them. Both sides of a window have the same bytes.

    A group ends where a token of each side ends. Its tokens of side A come first, so the place of a token in the
    text is its own number plus the tokens of the other side before it.
    """
    tops = [np.cumsum(spoken.size[ids]) for spoken, ids in zip(made.spoken, sides, strict=True)]
    mark = np.zeros(int(tops[0][-1]) + 1, dtype=np.uint8)
    for top in tops:
        mark[top] += 1
    # Groups end before each place; their tokens up to there.
    group = np.cumsum(mark == 2)
    last = [mark[top] == 2 for top in tops]
    group = [group[top] - end for top, end in zip(tops, last, strict=True)]
    upto = [np.flatnonzero(end) + 1 for end in last]
    place = [np.arange(len(sides[0])) + np.concatenate([[0], upto[1]])[group[0]], np.arange(len(sides[1])) + upto[0][group[1]]]
    ids = np.empty(len(sides[0]) + len(sides[1]), dtype=np.int64)
    after = np.empty(len(ids), dtype=np.uint8)
    for k, sign in enumerate(b"|;"):
        ids[place[k]] = sides[k]
        after[place[k]] = np.where(last[k], sign, ord(","))
    ends = np.cumsum(made.digits.size[ids])
    data = made.digits.bytes_of(ids)
    data[ends - 1] = after
    raw, ends = data.tobytes(), np.concatenate([[0], ends])[at[0] + at[1]].tolist()
    numbers = np.diff(np.concatenate([[0], np.cumsum(last[0])])[at[0]])
    return [raw[x : y - 1] for x, y in zip(ends[:-1], ends[1:], strict=True)], numbers


def _windows(made: _Made, sides: list[tuple[np.ndarray, np.ndarray]]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For both sides the first id of every window, and the first window of every text. All texts are verified, so
    both sides have the same bytes; windows begin at texts and at anchors."""
    ends, begins = [], []
    for spoken, (ids, _) in zip(made.spoken, sides, strict=True):
        end = np.cumsum(spoken.size[ids])
        ends.append(end)
        begins.append(end - spoken.size[ids])
    mark = np.zeros(int(ends[0][-1]), dtype=np.uint8)
    for b, spoken, (ids, _) in zip(begins, made.spoken, sides, strict=True):
        mark[b[spoken.spaced[ids]]] += 1
    texts = begins[0][sides[0][1][:-1]]
    mark[texts] = 2
    anchors = np.flatnonzero(mark == 2)
    return [np.append(np.searchsorted(b, anchors), len(b)) for b in begins], np.append(np.searchsorted(anchors, texts), len(anchors))


def _window_numbers(sides: list[tuple[np.ndarray, np.ndarray]], at: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """One window of each kind, and the kind of every window: equal ids on both sides."""
    hashes = np.zeros(len(at[0]) - 1, dtype=np.uint64)
    for side, ((ids, _), a) in enumerate(zip(sides, at, strict=True)):
        place = np.arange(len(ids)) - np.repeat(a[:-1], np.diff(a))
        own = tb.mix64((ids.astype(np.uint64) << np.uint64(32)) + (place.astype(np.uint64) << np.uint64(1)) + np.uint64(side))
        hashes += tb.mix64(np.add.reduceat(own, a[:-1]) + np.uint64(side))
    _, chosen, which = np.unique(hashes, return_index=True, return_inverse=True)
    for (ids, _), a in zip(sides, at, strict=True):
        size = np.diff(a)
        same = np.array_equal(size[chosen][which], size) and np.array_equal(ids[_runs(a[:-1][chosen][which], size)], ids)
        if not same:
            return np.arange(len(hashes)), np.arange(len(hashes))
    return chosen, which


def align_block(made: _Made, sides: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Numbers of groups and links of every verified text, and the hash of its groups.

    Two neighbouring ends of tokens, of whatever side, have one token of each side between them, so a group of
    m and n tokens has m + n - 1 links.
    """
    at, first = _windows(made, sides)
    chosen, which = _window_numbers(sides, at)
    if len(made.windows) > REMEMBERED:
        made.windows.clear()
    # The key of a window: its ids of side A, a mark that is no id, its ids of side B.
    starts, counts = [side[:-1][chosen] for side in at], [np.diff(side)[chosen] for side in at]
    flat = [ids[_runs(s, c)] for (ids, _), s, c in zip(sides, starts, counts, strict=True)]
    total = counts[0] + counts[1] + 1
    ends = np.cumsum(total)
    keys = np.full(int(ends[-1]), -1, dtype=np.int32)
    keys[_runs(ends - total, counts[0])] = flat[0]
    keys[_runs(ends - counts[1], counts[1])] = flat[1]
    raw, cuts = keys.tobytes(), [0, *(4 * ends).tolist()]
    keys = [raw[x:y] for x, y in zip(cuts[:-1], cuts[1:], strict=True)]
    found = [made.windows.get(key) for key in keys]
    new = np.array([k for k, f in enumerate(found) if f is None], dtype=np.int64)
    if len(new):
        own = [ids[_runs(s[new], c[new])] for (ids, _), s, c in zip(sides, starts, counts, strict=True)]
        texts, numbers = group_texts(made, own, [np.concatenate([[0], np.cumsum(c[new])]) for c in counts])
        for k, text, number, few in zip(new.tolist(), texts, numbers.tolist(), (total[new] <= FEW).tolist(), strict=True):
            found[k] = (text, number)
            if few:
                made.windows[keys[k]] = (text, number)
    texts = np.empty(len(found), dtype=object)
    texts[:] = [f[0] for f in found]
    texts = texts[which]
    groups = np.diff(np.concatenate([[0], np.cumsum(np.array([f[1] for f in found], dtype=np.int64)[which])])[first])
    hashes = [hashlib.sha256(b";".join(texts[a:b].tolist())).hexdigest() for a, b in zip(first[:-1], first[1:], strict=True)]
    return groups, np.diff(sides[0][1]) + np.diff(sides[1][1]) - groups, hashes


def _take(side: tuple[np.ndarray, np.ndarray], texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of some texts of a side."""
    ids, at = side
    counts = np.diff(at)[texts]
    return ids[_runs(at[:-1][texts], counts)], np.concatenate([[0], np.cumsum(counts)])


def _spread(values: np.ndarray, texts: np.ndarray, rows: int) -> np.ndarray:
    out = np.zeros(rows, dtype=np.int64)
    out[texts] = values
    return out


def _aligned(batches: Iterator[pa.RecordBatch], shared: Broadcast) -> Iterator[pa.RecordBatch]:
    made = shared.value.made
    for batch in batches:
        for begin, end, data, offsets in tb.blocks(batch.column(1)):
            rows = end - begin
            data, offsets = _spaced(data, offsets)
            sides, texts = [(np.zeros(0, np.int32), np.zeros(rows + 1, np.int64))] * 2, np.zeros(0, np.int64)
            if len(data):
                both = encode_block(made, data, offsets)
                texts = np.flatnonzero(verified(made, data, offsets, both))
                sides = [_take(side, texts) for side in both]
            groups, links, hashes = align_block(made, sides) if len(texts) else ([], [], [])
            digests = [""] * rows
            for k, digest in zip(texts, hashes, strict=True):
                digests[k] = digest
            columns, counts = [], []
            for ids, at in sides:
                counts.append(_spread(np.diff(at), texts, rows) if len(texts) else np.zeros(rows, np.int64))
                ends = np.concatenate([[0], np.cumsum(counts[-1])]) * 2
                columns.append(pa.Array.from_buffers(pa.large_binary(), rows, [
                    None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(ids, dtype="<u2"))]).cast(pa.binary()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(begin, rows), *columns, *map(pa.array, counts), pa.array(_spread(groups, texts, rows)),
                 pa.array(_spread(links, texts, rows)), pa.array(digests)],
                ["id", "a", "b", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"])


def _links(spoken: list[_Spoken], a: pa.Array, b: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, number of rows, text, pair) of the links of some rows at a time; a pair is A's id times the number of B's
    ids plus B's id. Ends of both sides, taken together, bound the links."""
    sizes = np.array([len(x.as_buffer()) for x in a]) if len(a) else np.zeros(0, int)
    first = 0
    while first < len(sizes):
        end = first + max(int(np.searchsorted(np.cumsum(sizes[first:]), tb.BLOCK_BYTES, side="right")), 1)
        parts = [[np.frombuffer(x.as_buffer(), dtype="<u2") for x in column[first:end]] for column in (a, b)]
        ids = [np.concatenate(p).astype(np.int64) for p in parts]
        tops = [np.cumsum(side.size[i]) for side, i in zip(spoken, ids, strict=True)]
        mark = np.zeros(int(tops[0][-1]) + 1 if len(tops[0]) else 1, dtype=np.uint8)
        mark[tops[0]] = 1
        mark[tops[1]] += 2
        mark = mark[mark > 0]
        i, j = (np.cumsum(m) - m for m in ((mark & 1).astype(np.int64), (mark >> 1).astype(np.int64)))
        owner = np.repeat(np.arange(end - first), [len(p) for p in parts[0]])
        yield first, end - first, owner[i], ids[0][i] * len(spoken[1].size) + ids[1][j]
        first = end


def pair_counts(aligned: DataFrame, shared: Broadcast) -> DataFrame:
    """(pair, docs): in how many texts each id pair is linked. Tasks send one row per pair and at most
    as many rows as their links; they hold a bounded number of pairs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spoken = shared.value.made.spoken
        codes = len(spoken[0].size) * len(spoken[1].size)
        pairs, docs = np.zeros(0, np.int64), np.zeros(0, np.int64)
        fresh, waiting = [], 0
        for batch in batches:
            for _, _, text, pair in _links(spoken, batch.column(0), batch.column(1)):
                fresh.append(pd.unique(text * codes + pair) % codes)
                waiting += len(fresh[-1])
                if waiting > _GATHERED:
                    pairs, docs = _added(pairs, docs, fresh)
                    fresh, waiting = [], 0
                    if len(pairs) > _GATHERED:
                        yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(docs)], ["pair", "docs"])
                        pairs, docs = pairs[:0], docs[:0]
        pairs, docs = _added(pairs, docs, fresh)
        yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(docs)], ["pair", "docs"])

    parts = aligned.select("a", "b").mapInArrow(run, "pair bigint, docs bigint")
    return parts.groupBy("pair").agg(F.sum("docs").alias("docs"))


def _added(pairs: np.ndarray, docs: np.ndarray, fresh: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    new = np.concatenate([*fresh, np.zeros(0, np.int64)])
    out, which = np.unique(np.concatenate([pairs, new]), return_inverse=True)
    return out, np.bincount(which, weights=np.concatenate([docs, np.ones(len(new), np.int64)]), minlength=len(out)).astype(np.int64)


def _scored(aligned: DataFrame, shared: Broadcast, known: Broadcast) -> DataFrame:
    """The rows with n_best and count_sum raised by the links whose pairs are known."""
    kind = aligned.schema.simpleString().removeprefix("struct<").removesuffix(">")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spoken, (pairs, docs, best) = shared.value.made.spoken, known.value
        for batch in batches:
            more = np.zeros((2, batch.num_rows), dtype=np.int64)
            for first, rows, text, pair in _links(spoken, batch.column("a"), batch.column("b")):
                which, kinds = pd.factorize(pair)
                at = np.minimum(np.searchsorted(pairs, kinds), max(len(pairs) - 1, 0))
                there = pairs[at] == kinds if len(pairs) else np.zeros(len(kinds), bool)
                count = np.where(there, docs[at], 0) if len(pairs) else np.zeros(len(kinds), np.int64)
                top = there & best[at] if len(pairs) else there
                # Doubles add up whole numbers exactly below 2^53.
                more[0, first : first + rows] = np.bincount(text, weights=top[which], minlength=rows)
                more[1, first : first + rows] = np.bincount(text, weights=count[which], minlength=rows)
            columns = dict(zip(batch.schema.names, batch.columns, strict=True))
            for name, values in zip(("n_best", "count_sum"), more, strict=True):
                columns[name] = pa.array(columns[name].to_numpy() + values)
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return aligned.mapInArrow(run, kind)


def align_tokens(df: DataFrame, tokenizers: Tokenizers, id_col: str = "doc_id", text_col: str = "text",
                 pair_rows: int = PAIR_ROWS) -> DataFrame:
    """One row per text: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, and the ids of both sides, `a` and `b`,
    as 16-bit numbers in binary.

    Side A encodes a space and the text, side B the text, to which it adds the space itself. Places where both
    end a token cut them into groups; tokens of the two sides whose bytes overlap are linked. An id pair's count is the
    number of texts in which it is linked, over the whole table; count_sum adds it up over a text's links, n_best counts the
    links whose count is the highest of their A id's pairs, ties included. groups_sha256 is the hash of the groups'
    ids, `a1,a2|b1;a3|b2,b3`.

    Null and empty texts, and texts that either side does not give back byte for byte, have no tokens: zeros and an
    empty hash. Rows that repeat an id each give a row and each count as a text. An empty table gives an empty
    result. Only the two named columns are read. Pair counts are broadcast `pair_rows` at a time; with more pairs than that
    every block of them is one more pass over the stored ids.
    """
    spark = df.sparkSession
    docs = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    shared = spark.sparkContext.broadcast(tokenizers)
    if max(len(s.size) for s in tokenizers.made.spoken) > 1 << 16:
        raise ValueError("ids are stored in 16 bits")
    b_ids = len(tokenizers.made.spoken[1].size)
    kind = f"id {docs.schema['id'].dataType.simpleString()}, a binary, b binary, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string"
    folder = new_folder(spark, "aligned")
    docs.mapInArrow(lambda it: _aligned(it, shared), kind).write.option("compression", "zstd").parquet(folder)
    aligned = spark.read.schema(kind).parquet(folder)

    pairs = settle(pair_counts(aligned, shared), "pairs").withColumn("a", F.expr(f"pair div {b_ids}"))
    blocks = max(-(-pairs.count() // pair_rows), 1)
    out = aligned.withColumn("n_best", F.lit(0).cast("bigint")).withColumn("count_sum", F.lit(0).cast("bigint"))
    for k in range(blocks):
        # All pairs of an A id are in one block.
        rows = pairs.where(F.pmod(F.xxhash64("a"), F.lit(blocks)) == k).select("pair", "docs").toArrow()
        pair, count = (c.to_numpy() for c in rows.columns)
        order = np.argsort(pair)
        pair, count = pair[order], count[order]
        best = np.zeros(len(pair), dtype=bool)
        if len(pair):
            firsts = np.flatnonzero(np.diff(pair // b_ids, prepend=-1))
            best = count == np.repeat(np.maximum.reduceat(count, firsts), np.diff(np.append(firsts, len(pair))))
        out = _scored(out, shared, spark.sparkContext.broadcast((pair, count, best)))
        if k + 1 < blocks:
            out = settle(out, "scored")
    return out.select(F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "a", "b")
