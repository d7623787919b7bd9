"""The positional index against a search of every window in every text."""

import hashlib
import random
import re

import pytest

from millrace.llm import decontaminate as dc


def words(text):
    return re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, size=10):
    out = []
    for key, text in docs:
        own, hit, found = words(text), set(), set()
        for item, passage in items:
            w = words(passage)
            n = min(len(w), size)
            for i in range(len(w) - n + 1 if n else 0):
                for k in range(len(own) - n + 1):
                    if own[k : k + n] == w[i : i + n]:
                        hit |= set(range(k, k + n))
                        found |= {str(item)} if item is not None else set()
        out.append((key, len(own), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


@pytest.fixture
def tables(spark):
    rng = random.Random(4)
    vocabulary = ["the"] * 6 + ["of"] * 3 + ["Straße", "日本", "x1", "a", "b", "c", "d", "e"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    passage = text(14)
    items = [(1, passage), (2, text(30)), (3, "the the"), (3, "x1, x1!"), (10, passage), (None, "c d e d c"), (5, ""), (6, None), (7, "—.,")]
    docs = [(k, text(rng.randint(0, 60))) for k in range(40)]
    docs += [(100 + k, f"{text(4)} {passage.upper()} {text(3)}") for k in range(20)]
    docs += [(1, None), (2, ""), (2, "  ."), (None, passage), (8, " ".join([passage] * 300)), (9, passage.replace(" ", "\n--"))]
    docs += [(300, "c D e. d c c d e d c"), (300, "c D e. d c c d e d c")]
    return (spark.createDataFrame([(k, t, "s", 1, [2]) for k, t in docs], "doc_id long, text string, item string, place int, spans array<int>"),
            spark.createDataFrame([(k, t, "w") for k, t in items], "item_id long, text string, window string"), docs, items)


@pytest.mark.parametrize("query_rows", [100_000, 7])
def test_equals_search_of_all_windows(tables, query_rows):
    docs, items, rows, passages = tables
    got = dc.contamination(docs.repartition(3), items, query_rows=query_rows)
    assert sorted((tuple(r)[:6] for r in got.collect()), key=repr) == brute(rows, passages)
    assert got.where("n_near_items < n_items - 1").count() == 0


def test_empty_tables(tables):
    docs, items, rows, _ = tables
    assert dc.contamination(docs.limit(0), items).count() == 0
    got = dc.contamination(docs, items.limit(0))
    assert got.count() == len(rows) and got.where("contaminated OR n_items > 0").count() == 0


def test_texts_without_words_only(spark):
    docs = spark.createDataFrame([(1, ""), (2, None), (3, "..")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert [tuple(r)[1:4] for r in dc.contamination(docs, items).collect()] == [(0, 0, 0)] * 3


def test_phrases_do_not_cross_documents(spark):
    docs = spark.createDataFrame([(1, "one two"), (2, "three four")], "doc_id long, text string").coalesce(1)
    items = spark.createDataFrame([(1, "two three"), (2, "one two"), (3, "three four")], "item_id long, text string")
    got = sorted(tuple(r) for r in dc.search(dc.build_index(docs), dc.windows(items)).select("id", "n_words", "items", "near_items").collect())
    assert got == [(1, 2, ["2"], ["2"]), (2, 2, ["3"], ["3"])]


def test_proximity(spark):
    item = "alpha beta gamma delta epsilon"
    texts = ["alpha beta gamma delta epsilon", "alpha beta so gamma delta epsilon", "beta alpha gamma epsilon delta",
             "alpha beta gamma delta", "alpha beta so it is gamma delta epsilon", "epsilon delta gamma beta alpha"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").coalesce(1)
    items = spark.createDataFrame([("i", item)], "item_id string, text string")
    index, wanted = dc.build_index(docs), dc.windows(items)
    near = lambda slop: {r["id"] for r in dc.search(index, wanted, slop).collect() if r["near_items"]}
    assert {r["id"] for r in dc.search(index, wanted, 0).collect() if r["items"]} == {0}
    assert near(1) == {0, 1, 2}
    assert near(2) == {0, 1, 2, 4}
