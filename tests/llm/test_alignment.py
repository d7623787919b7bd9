"""Alignments of two tokenizers against the plain definition: whole texts, every pair of overlapping tokens."""

import hashlib
from collections import defaultdict

import numpy as np
import pytest

from millrace.llm import alignment, queries

ODD = ["<|endoftext|> hi", "a ▁ b", "  two  spaces ", " x y　z  \n\n q", "don't I'll 123 4567 x²", None, "", " ", "日本語 テキスト 😀",
       "a\x00b c", "x" * 3000, "tab\tx y\r\n z", "ﬁ ligature Å é", " lead", "trail ", "<s> </s> <unk> <0x41>", "a b a b a b",
       "é combining", "​zero ﻿width", "a  b   c", "new\n line", "one", "ÀÉ à é", "�"]


@pytest.fixture(scope="module")
def tokenizers():
    return alignment.Tokenizers.load(queries.token_model(), queries.piece_model())


def brute(made, rows):
    text_of = [[s.data[a : a + n].tobytes() for a, n in zip(s.at, s.size, strict=True)] for s in made.spoken]
    out, links_of, docs_of = {}, {}, defaultdict(set)
    for key, text in rows:
        a = made.a.encode(" " + text, add_special_tokens=False).ids if text else []
        b = made.b.encode(text) if text else []
        whole = (" " + text).encode() if text else b""
        if any(b"".join(t[i] for i in ids) != whole for t, ids in zip(text_of, (a, b), strict=True)):
            a, b = [], []
        spans = []
        for t, ids in zip(text_of, (a, b), strict=True):
            ends = np.cumsum([len(t[i]) for i in ids]).tolist()
            spans.append(list(zip([0, *ends[:-1]], ends, strict=True)) if ids else [])
        links = [(a[i], b[j]) for i, x in enumerate(spans[0]) for j, y in enumerate(spans[1]) if x[0] < y[1] and y[0] < x[1]] if len(a) < 700 else None
        if links is None:
            links, j = [], 0
            for i, x in enumerate(spans[0]):
                while spans[1][j][1] <= x[0]:
                    j += 1
                k = j
                while k < len(b) and spans[1][k][0] < x[1]:
                    links.append((a[i], b[k]))
                    k += 1
        shared = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        groups, low = [], 0
        for high in shared:
            groups.append("|".join(",".join(str(i) for i, s in zip(ids, span, strict=True) if low < s[1] <= high)
                                   for ids, span in zip((a, b), spans, strict=True)) if len(a) < 700 else "")
            low = high
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""
        out[key] = [len(a), len(b), len(shared), len(links)]
        links_of[key] = (links, digest if len(a) < 700 else None)
        for link in set(links):
            docs_of[link].add(key)
    best = defaultdict(int)
    for (i, _), docs in docs_of.items():
        best[i] = max(best[i], len(docs))
    return {k: (*out[k], sum(len(docs_of[x]) == best[x[0]] for x in links), sum(len(docs_of[x]) for x in links), digest)
            for k, (links, digest) in links_of.items()}


@pytest.mark.parametrize("pair_rows", [alignment.PAIR_ROWS, 900])
def test_equals_the_definition(spark, sf_dir, tokenizers, pair_rows):
    given = spark.read.parquet(f"{sf_dir}/documents.parquet").where("length(text) < 4000").limit(150).collect()
    rows = list(enumerate([r["text"] for r in given] + ODD))
    df = spark.createDataFrame([(k, t, b"a", 1.5) for k, t in rows], "doc_id long, text string, a binary, n_best double").repartition(4)
    want = brute(tokenizers.made, rows)
    got = alignment.align_tokens(df, tokenizers, pair_rows=pair_rows).collect()
    assert len(got) == len(rows)
    for r in got:
        expected = want[r["doc_id"]]
        assert tuple(r)[1:7] == expected[:6], rows[r["doc_id"]]
        assert expected[6] is None or r["groups_sha256"] == expected[6], rows[r["doc_id"]]


def test_ids_of_stretches_are_ids_of_texts(spark, sf_dir, tokenizers):
    made = tokenizers.made
    texts = [r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").limit(300).collect()] + [t or "" for t in ODD]
    data = "".join(texts).encode()
    offsets = np.cumsum([0, *(len(t.encode()) for t in texts)])
    sides = alignment.encode_block(made, *alignment._spaced(np.frombuffer(data, np.uint8), offsets))
    for side, (ids, at) in enumerate(sides):
        for k, text in enumerate(texts):
            want = (made.a.encode(" " + text, add_special_tokens=False).ids, made.b.encode(text))[side] if text else []
            assert ids[at[k] : at[k + 1]].tolist() == want


def test_group_texts(tokenizers):
    made = tokenizers.made
    texts = [" naïve", " co-operation", " 日本", " x"]
    a = [made.a.encode(t, add_special_tokens=False).ids for t in texts]
    b = [made.b.encode(t[1:]) for t in texts]
    at = [np.cumsum([0, *map(len, side)]) for side in (a, b)]
    found, numbers = alignment.group_texts(made, [np.concatenate(side) for side in (a, b)], at)
    for i, j, text, number in zip(a, b, found, numbers, strict=True):
        groups = [[[int(k) for k in side.split(",")] for side in g.split("|")] for g in text.decode().split(";")]
        assert len(groups) == number and sum((g[0] for g in groups), []) == i and sum((g[1] for g in groups), []) == j
        for g in groups:
            assert made.spoken[0].bytes_of(np.array(g[0])).tobytes() == made.spoken[1].bytes_of(np.array(g[1])).tobytes()


def test_remembering_less_changes_nothing(spark, sf_dir, tokenizers, monkeypatch):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60)
    texts = [r["text"] or "" for r in df.collect()]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    block = alignment._spaced(data, np.cumsum([0, *(len(t.encode()) for t in texts)]))
    fresh = lambda: alignment.Tokenizers(tokenizers.byte_level, tokenizers.pieces).made
    whole = alignment.align_block(fresh(), alignment.encode_block(tokenizers.made, *block))
    for name in ("REMEMBERED", "SHORT", "FEW"):
        monkeypatch.setattr(alignment, name, 3)
    made = fresh()
    for _ in range(2):
        again = alignment.align_block(made, alignment.encode_block(made, *block))
        assert all(np.array_equal(a, b) for a, b in zip(whole, again, strict=True))


def test_repeats_and_empty_table(spark, tokenizers):
    rows = [(1, "the same text"), (1, "the same text"), (None, "the same text"), (2, "another")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = alignment.align_tokens(df, tokenizers).collect()
    same = [r for r in got if r["doc_id"] != 2]
    assert len(same) == 3 and len({tuple(r)[1:] for r in same}) == 1
    assert same[0]["count_sum"] == 3 * same[0]["n_links"] and same[0]["n_best"] == same[0]["n_links"]
    assert alignment.align_tokens(df.limit(0), tokenizers).count() == 0


def test_ids_serve_as_ranks_only_where_they_may(tokenizers):
    assert tokenizers.ranks
    import json

    file = json.loads(tokenizers.byte_level)
    file["model"]["merges"].reverse()
    assert not alignment.ids_are_ranks(json.dumps(file))
