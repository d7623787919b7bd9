"""Toxicity, quality, mixing and fingerprints: held-out accuracy, targets met, brute force."""

import hashlib
import itertools
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from millrace.llm import fingerprint, mixing, quality, toxicity
from millrace.llm import textblocks as tb

INSULTS = ["idiot", "moron", "worthless"]
PLAIN = [a + b for a in ("ran", "tol", "mir", "sen", "dor", "lup") for b in ("ta", "ne", "lis", "or", "ake", "un")]


def prose(rng, words=60):
    return " ".join(rng.choice(PLAIN) for _ in range(words)).capitalize() + "."


def labelled(seed=0, n=400):
    """Prose with insults, and prose that repeats itself."""
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        words = prose(rng, rng.randrange(20, 90)).split()
        toxic, good = int(rng.random() < 0.3), int(rng.random() < 0.7)
        if toxic:
            words.insert(rng.randrange(len(words)), rng.choice(INSULTS))
        if not good:
            words = [w for w in words for _ in range(4)]
        rows.append((k, " ".join(words), good, toxic))
    return rows


@pytest.fixture(scope="module")
def tables(spark):
    rows = labelled()
    docs = spark.createDataFrame([(k, t, "x", 1) for k, t, _, _ in rows], "doc_id long, text string, id string, y int")
    labels = spark.createDataFrame([(k, q, x, 9) for k, _, q, x in rows] + [(None, 1, 1, 9), (0, None, None, 9), (10**6, 1, 1, 9)],
                                   "doc_id long, quality int, toxic int, id int")
    return docs, labels, {k: (q, x) for k, _, q, x in rows}


def held_out(k):
    return zlib.crc32(str(k).encode()) % 4 == 2


ODD = [(None, None), (1, ""), (1, ""), (2, " \n"), (3, "0123 !!"), (4, "w" * 50_000), (5, "日本語")]


def odd(spark):
    return spark.createDataFrame([(k, t, 0.1, "c") for k, t in ODD], "doc_id long, text string, score double, id string")


def test_toxicity(spark, tables):
    docs, labels, truth = tables
    model = toxicity.fit(docs, labels)
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    wrong = [k for k, s in scores.items() if held_out(k) and (s >= 0.3) != bool(truth[k][1])]
    assert sum(map(held_out, scores)) > 60 and len(wrong) <= 3
    marked = toxicity.score(odd(spark), model).collect()
    assert len(marked) == len(ODD) and all(0 <= r["score"] < 0.3 for r in marked)
    left = toxicity.without_toxic(docs, model, 0.5)
    assert left.columns == docs.columns and left.count() == sum(s < 0.5 for s in scores.values())
    assert toxicity.score(docs.limit(0), model).count() == 0


def test_insults_with_gaps_and_insertions(tables):
    docs, labels, _ = tables
    model = toxicity.fit(docs, labels)
    say = lambda t: model.probability(toxicity.worst_windows(*toxicity.encoded(
        np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())])), model.table)[0])[0]
    clean = say("Ranta tolne mirlis senor.")
    assert say("Ranta idiot mirlis.") > 0.9 and clean < 0.1
    for text in ("Ranta idxiot mirlis.", "Ranta worth-less mirlis.", "Ranta wortthless mirlis."):
        assert say(text) > 3 * clean


@pytest.mark.parametrize("shape", [" ".join, "--".join, ".".join, " - ".join, "\u200b".join, "\u00b7".join, lambda w: w.upper()])
def test_insults_that_are_set_apart_pass_the_threshold(tables, shape):
    docs, labels, _ = tables
    model = toxicity.fit(docs, labels)
    texts = [f"Ranta tolne {shape(w)} mirlis." for w in INSULTS] + ["Ranta tolne mirlis.", "Ranta a b c mirlis."]
    scores = np.concatenate([s for _, s in toxicity.score_batches([pa.RecordBatch.from_arrays([pa.array(texts)], ["t"])], model, 0)])
    assert (scores[:3] >= 0.3).all() and (scores[3:] < 0.3).all()


def test_a_text_is_scored_without_its_neighbours(tables):
    docs, labels, _ = tables
    model = toxicity.fit(docs, labels)
    texts = ["Ranta tolne.", "idiot", "", "idiot idiot", "senor", None, "moron"]
    def scores(part):
        batch = pa.RecordBatch.from_arrays([pa.array(part, pa.string())], ["t"])
        return np.concatenate([s for _, s in toxicity.score_batches([batch], model, 0)])
    together = scores(texts)
    assert np.allclose(together, [scores([t])[0] for t in texts], atol=1e-6)
    assert ((together >= 0.3) == [False, True, False, True, False, False, True]).all()


def test_kernel_equals_its_definition():
    def weights(codes, starts):
        found = {}
        for at in itertools.combinations(range(len(codes)), toxicity.ORDER):
            if at[0] < starts and at[-1] - at[0] < toxicity.SPAN and all(codes[k] for k in at):
                key = tuple(codes[k] for k in at)
                found[key] = found.get(key, 0) + toxicity.DECAY ** (at[-1] - at[0] + 1 - toxicity.ORDER)
        return found

    words = ["idiot", "ranta", "fat "]
    marks = toxicity._Landmarks(words)
    data = np.frombuffer("the fat idxi-ot, r a n t a".encode(), np.uint8)
    codes, _ = toxicity.encoded(data, np.array([0, len(data)]))
    rows = np.array([codes[k : k + toxicity._WIDTH] for k in range(0, 12, 3)])
    got = marks.kernel(rows)
    for k, word in enumerate(words):
        own = weights(toxicity.word_codes(word).tolist(), 99)
        norm = sum(v * v for v in own.values()) ** 0.5
        for row, value in zip(rows.tolist(), got[:, k], strict=True):
            other = weights(row, toxicity.WINDOW)
            assert value == pytest.approx(sum(v * other.get(n, 0) for n, v in own.items()) / norm, abs=1e-4)


def test_letters_that_are_set_apart_are_joined():
    def read(*texts):
        data = [t.encode() for t in texts]
        codes, begin = toxicity.encoded(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)]))
        ends = [*begin[1:], len(codes)]
        return ["".join("." if c == 0 else "_" if c == 27 else chr(96 + c) for c in codes[a:b]).rstrip(".")
                for a, b in zip(begin, ends, strict=True)]

    assert read("a b", "", "c d", "x") == ["_ab", "_", "_cd", "_x"]
    assert read("Is it i - d,i o t?! yes") == ["_is_it_idiot_yes"]
    assert read("  J. R. R. Tol ", "no") == ["_jrr_tol_", "_no"]
    assert read("é") == read("É") != read("д") == read("Д")


def test_table_of_the_machine_equals_the_kernel_sum():
    marks = toxicity._Landmarks(["idiot", "ranta", "moronic"])
    beta = np.array([0.7, -0.4, 0.2])
    data = np.frombuffer("you idxiot of ranta".encode(), np.uint8)
    codes, begin = toxicity.encoded(data, np.array([0, len(data)]))
    worst, window = toxicity.worst_windows(codes, begin, marks.fold(beta))
    rows = np.array([codes[k : k + toxicity._WIDTH] for k in range(len(window))])
    assert np.allclose(marks.kernel(rows) @ beta, window, atol=1e-4) and worst[0] == window.max()


def test_nothing_to_learn_from(spark, tables):
    docs, labels, _ = tables
    none = labels.limit(0)
    assert {round(r["score"], 6) for r in quality.score(docs, quality.fit(docs, none)).collect()} == {0.5}
    assert all(0 <= r["score"] <= 1 for r in toxicity.score(docs, toxicity.fit(docs, none)).collect())
    assert mixing.fit_domains(docs, none.selectExpr("doc_id", "quality AS domain"), 2).bias.tolist() == [0, 0]


def test_quality(spark, tables):
    docs, labels, truth = tables
    model = quality.fit(docs, labels)
    scores = {r["doc_id"]: r["score"] for r in quality.score(docs, model).collect()}
    wrong = [k for k, s in scores.items() if held_out(k) and (s >= 0.7) != bool(truth[k][0])]
    assert len(wrong) <= 5
    assert len(quality.score(odd(spark), model).collect()) == len(ODD)


def test_votes_are_exact(tables):
    docs, labels, _ = tables
    model = quality.fit(docs, labels)
    texts = [t for _, t, _, _ in labelled(5, 20)]
    counts = np.concatenate([quality.term_counts(d, o) for *_, d, o in tb.blocks(pa.array(texts))])
    cosine = model.space.vectors(counts) @ model.vectors.T
    for row, vote in zip(cosine, model.vote(counts), strict=True):
        near = np.argsort(-row)[: quality.NEIGHBOURS]
        weight = np.maximum(row[near], 0).astype(float) ** quality.SHARPNESS
        assert vote == pytest.approx((weight @ model.labels[near] + 1e-3 * model.prior) / (weight.sum() + 1e-3), abs=1e-6)


def test_document_counts_cover_all_texts(spark, tables):
    docs, _, _ = tables
    df, rows = quality.document_counts(docs)
    texts = pa.array([r["text"] for r in docs.collect()])
    counts = np.concatenate([quality.term_counts(d, o) for *_, d, o in tb.blocks(texts)])
    assert rows == len(texts) and (df == (counts > 0).sum(axis=0)).all()


def test_rates_meet_targets(spark, tables):
    docs, labels, _ = tables
    model = mixing.fit_domains(docs, labels.selectExpr("doc_id", "CAST(quality > 0 AS INT) AS domain"), 2)
    rates = mixing.mixing_rates(docs, model, [0.2, 0.8]).collect()
    tokens, rate = np.array([r["tokens"] for r in rates]), np.array([r["rate"] for r in rates])
    p = np.array([r["p"] for r in rates])
    assert (rate >= 0).all() and np.allclose(p.sum(axis=1), 1)
    assert np.allclose((tokens * rate) @ p / tokens.sum(), [0.2, 0.8], atol=1e-4)
    lifted = mixing.lifted(docs, model, [0.2, 0.8])
    assert lifted.columns == docs.columns and lifted.select("doc_id").distinct().count() == docs.count()
    assert lifted.count() > docs.count() and sorted(lifted.collect()) == sorted(lifted.collect())
    assert mixing.mixing_rates(docs.limit(0), model, [0.2, 0.8]).count() == 0
    assert mixing.mixing_rates(odd(spark), model, [0.2, 0.8]).count() == len(ODD)


def overlapping(spark, n=600):
    """Three domains that most rows belong to in part."""
    rng = np.random.default_rng(4)
    p = rng.dirichlet([0.6, 2.5, 0.5], n)
    return spark.createDataFrame([(k, int(t), x.tolist()) for k, (t, x) in enumerate(zip(rng.integers(5, 200, n), p, strict=True))],
                                 "id long, tokens long, p array<double>")


@pytest.mark.parametrize("least", [0.0, 0.5])
def test_targets_of_overlapping_domains_are_met(spark, least):
    rows = overlapping(spark)
    share = np.array([0.05, 0.9, 0.05])
    total = rows.agg({"tokens": "sum"}).first()[0] * (1 if least == 0 else 2)
    pushes = mixing.fit_rates(rows, share * total, least)
    got = rows.select("tokens", "p", mixing._rate(rows["p"], pushes, least).alias("rate")).collect()
    tokens, p, rate = (np.array([r[c] for r in got]) for c in ("tokens", "p", "rate"))
    assert rate.min() >= least and np.allclose((tokens * rate) @ p / total, share, atol=1e-6)


def test_a_fit_that_is_cut_short_is_an_error(spark):
    with pytest.raises(RuntimeError, match="not converged"):
        mixing.fit_rates(overlapping(spark), np.array([1000.0, 30000.0, 1000.0]), steps=3)


def test_a_lifted_table_has_the_ratio_of_the_weights(spark, tables):
    docs, labels, _ = tables
    model = mixing.fit_domains(docs, labels.selectExpr("doc_id", "CAST(quality > 0 AS INT) AS domain"), 2)
    rows = mixing.memberships(docs, model)
    for weights in ([0.3, 0.7], [0.8, 0.2]):
        share = np.array(weights)
        off = rows.selectExpr("tokens", f"array(p[0] - {share[0]}D, p[1] - {share[1]}D) AS p")
        push, = mixing.fit_rates(off, np.zeros(2), 1.0, per=share * 1000)
        got = rows.select("tokens", "p", mixing._rate(rows["p"], [push - share @ push], 1.0).alias("rate")).collect()
        tokens, p, rate = (np.array([r[c] for r in got]) for c in ("tokens", "p", "rate"))
        have = (tokens * rate) @ p
        assert rate.min() == 1 and np.allclose(have / have.sum(), share, atol=1e-5)
        copies = {r["doc_id"]: r["count"] for r in mixing.lifted(docs, model, weights).groupBy("doc_id").count().collect()}
        marked = rows.collect()
        made = sum(copies[r["id"]] * r["tokens"] * np.array(r["p"]) for r in marked)
        assert np.allclose(made / made.sum(), share, atol=0.03)


def test_unreachable_targets_are_reported(spark, tables):
    docs, _, _ = tables
    rows = docs.limit(50).selectExpr("doc_id AS id", "CAST(10 AS BIGINT) AS tokens", "array(0.5D, 0.5D) AS p")
    with pytest.warns(UserWarning, match="no rates reach"):
        mixing.fit_rates(rows, np.array([0.0, 1000.0]))


def test_unreachable_targets_give_the_least_miss(spark, tables):
    docs, _, _ = tables
    rows = docs.limit(50).selectExpr("doc_id AS id", "CAST(10 AS BIGINT) AS tokens", "array(0.5D, 0.5D) AS p")
    pushes = mixing.fit_rates(rows, np.array([0.0, 1000.0]))
    rate = rows.select(mixing._rate(rows["p"], pushes, 0.0)).distinct().collect()
    assert len(rate) == 1 and rate[0][0] == pytest.approx(2.0, abs=1e-3)


def brute_digest(text):
    data = text.encode()
    counts = [0] * fingerprint.BUCKETS
    seed = fingerprint._SEED
    for a, b, c in zip(data, data[1:], data[2:], strict=False):
        counts[seed[seed[seed[a] ^ b] ^ c]] += 1
    ordered = sorted(counts)
    cuts = [ordered[q * fingerprint.BUCKETS // 4 - 1] for q in (1, 2, 3)]
    return [min(round(fingerprint.LENGTH_STEPS * np.log2(len(data) + 1)), 255)] + [sum(c > x for x in cuts) for c in counts]


def test_fingerprints(spark):
    rng = random.Random(3)
    texts = ["", "a", "ab", "abc", "日本", *(prose(rng, 40) for _ in range(40)), "same text", "same text"]
    rows = [(10 * k + 3, t) for k, t in enumerate(texts)] + [(None, "no id")]
    df = spark.createDataFrame([(k, t, "x", True) for k, t in rows], "doc_id long, text string, range string, copy boolean").repartition(5)
    got = {r["doc_id"]: r for r in fingerprint.edited_likeness(df).collect()}
    assert len(got) == len(rows)
    digest = lambda t: np.array([brute_digest(t)], dtype=np.uint8)
    for (key, text), (_, after) in zip(rows, rows[1:] + rows[:1], strict=True):
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        row = got[key]
        assert row["n_chars"] == len(text) and row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert row["fingerprint"] == fingerprint.as_text(digest(text))[0]
        assert row["edited_fingerprint"] == fingerprint.as_text(digest(edited))[0]
        assert row["near_edited"] == pytest.approx(fingerprint.likeness(digest(text), digest(edited))[0])
        assert row["near_next"] == pytest.approx(fingerprint.likeness(digest(text), digest(after))[0])
    same = {r["fingerprint"] for r in fingerprint.fingerprints(df.where("text = 'same text'")).collect()}
    assert len(same) == 1 and fingerprint.likeness(digest("same text"), digest("same text"))[0] == 1.0


def test_fingerprints_of_odd_tables(spark):
    assert fingerprint.edited_likeness(odd(spark).limit(0)).count() == 0
    assert fingerprint.edited_likeness(odd(spark)).count() == len(ODD)
    one = fingerprint.edited_likeness(odd(spark).where("doc_id = 5")).first()
    assert one["edited_sha256"] == hashlib.sha256("日本日".encode()).hexdigest() and one["near_next"] == 1.0
