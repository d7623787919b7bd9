"""Piece encoding against a plain dynamic programme, and exact round trips."""

import os
import random
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.llm import pieces
from millrace.llm import textblocks as tb
from millrace.llm.queries import piece_model

TEXTS = ["", " ", "hello world", "  two  spaces ", "tab\tline\nend", "日本語 😀 ▁ é", "abab" * 900, "no" + "x" * 300 + " end",
         "The quick brown fox jumps over the lazy dog.", "a▁b ▁", "ﬁ ½ \x00 \x7f", "ñandú àéîõü " * 30]


def small_vocabulary():
    """Pieces whose best path cannot be found greedily, with crossing pieces and ties."""
    normal = [" ", "a", "b", "c", "ab", "bc", "abc", "ca", "caab", " a", "aa", "aaa", "é", "éa"]
    scores = [-3.0, -2.0, -2.5, -2.0, -2.2, -2.1, -4.6, -3.9, -3.0, -1.9, -4.0, -5.5, -2.0, -2.5]
    texts = {p.encode(): (k + 257, s) for k, (p, s) in enumerate(zip(normal, scores, strict=True))}
    return pieces.Vocabulary(texts, list(range(1, 257)), {0}, 257 + len(normal))


def brute(vocabulary, text):
    """Best path over characters; of equal scores the piece that begins earlier."""
    if not text:
        return []
    text = " " + text
    unknown = min(s for _, s in vocabulary.texts.values()) - pieces.UNKNOWN_PENALTY
    best, back = [0.0] + [-1e300] * len(text), [None] * (len(text) + 1)
    for end in range(1, len(text) + 1):
        for start in range(max(0, end - 20), end):
            found = vocabulary.texts.get(text[start:end].encode())
            if found is None and end - start == 1:
                found = (None, unknown)
            if found and best[start] + found[1] > best[end]:
                best[end], back[end] = best[start] + found[1], (start, found[0])
    out, at = [], len(text)
    while at:
        start, number = back[at]
        out += [number] if number is not None else [vocabulary.byte_ids[b] for b in reversed(text[start:at].encode())]
        at = start
    return out[::-1]


def encoded(vocabulary, texts):
    out = []
    for first, end, data, offsets in tb.blocks(pa.array(texts)):
        ids, at = pieces.encode_block(vocabulary, data, offsets)
        out += [ids[at[k] : at[k + 1]].tolist() for k in range(end - first)]
    return out


def test_small_vocabulary_against_brute_force():
    vocabulary = small_vocabulary()
    rng = random.Random(1)
    texts = ["", *("".join(rng.choice("aabbc é▁z") for _ in range(rng.randrange(1, 200))) for _ in range(120))]
    want = [brute(vocabulary, t) for t in texts]
    assert encoded(vocabulary, texts) == want
    for text, ids in zip(texts, want, strict=True):
        data = (" " + text).encode() if text else b""
        assert pieces.stream_ids(vocabulary, data, 7) == ids


def test_stream_window_stays_bounded():
    vocabulary = small_vocabulary()
    coder = pieces.StreamCoder(vocabulary)
    for _ in range(4000):
        coder.feed(b"caabcaab")
        assert len(coder.bytes) <= 8 + coder.longest and len(coder.best) <= coder.longest + 1
        assert coder.at - coder.root <= 8 + 6 * coder.longest and len(coder.start) <= 2 * 4096 + 64


@pytest.fixture(scope="module")
def vocabulary():
    if not os.path.exists(piece_model()):
        pytest.skip("no piece model")
    return pieces.Vocabulary.load(piece_model())


def test_long_runs_take_time_in_proportion(vocabulary):
    seconds, t = [], vocabulary.tables
    for n in (100_000, 400_000):
        started = time.process_time()
        ids = pieces.stream_ids(vocabulary, b" " + b"a" * n)
        seconds.append(time.process_time() - started)
        assert b"".join(t.spoken[t.spoken_at[i] : t.spoken_at[i + 1]].tobytes() for i in ids) == b" " + b"a" * n
    assert seconds[1] < 8 * seconds[0]


def test_streams_equal_brute_force(vocabulary):
    rng = random.Random(5)
    for letters in ("a", "ab", "xyz", "aeiou", "tionsére日"):
        for _ in range(6):
            text = "".join(rng.choice(letters) for _ in range(rng.randrange(1, 700)))
            assert pieces.stream_ids(vocabulary, (" " + text).encode(), rng.choice([1 << 12, 64])) == brute(vocabulary, text)


def test_public_vocabulary(vocabulary):
    short = [t[:200] for t in TEXTS]
    assert encoded(vocabulary, short) == [brute(vocabulary, t) for t in short]
    for first, end, data, offsets in tb.blocks(pa.array(TEXTS)):
        ids, at = pieces.encode_block(vocabulary, data, offsets)
        back, where = pieces.decode_block(vocabulary, ids, at)
        assert [back[where[k] : where[k + 1]].tobytes().decode() for k in range(end - first)] == TEXTS[first:end]


def test_lanes_without_shared_hashes(vocabulary, monkeypatch):
    want = encoded(vocabulary, TEXTS)
    monkeypatch.setattr(tb, "word_hashes", lambda d, b, e: (e - b).astype(np.uint64) % np.uint64(2) + (d[b] % 2))
    assert encoded(vocabulary, TEXTS) == want


def test_frames(docs, odd_rows, vocabulary):
    df = docs(odd_rows)
    ids = pieces.encode(df, vocabulary, check=True)
    texts = df.select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("decoded_sha256"))
    assert sorted(map(repr, ids.select("doc_id", "decoded_sha256").collect())) == sorted(map(repr, texts.collect()))
    back = pieces.decode(ids, vocabulary)
    assert sorted(map(repr, back.collect())) == sorted(repr(r) for r in df.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).collect())
    odd = pieces.decode(df.sparkSession.createDataFrame([(1, None), (2, [None, -5, 99_999_999, 0, 1]), (3, [])], "doc_id long, ids array<int>"), vocabulary)
    assert {r["text"] for r in odd.collect()} == {""}
    assert pieces.encode(docs([]), vocabulary).count() == 0
