"""Exact and near duplicates against brute force."""

import hashlib
import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from millrace.llm import near_dedup
from millrace.llm.components import components
from millrace.llm.exact_dedup import exact_duplicates, without_copies
from millrace.llm.near_dedup import near_duplicates, without_near_copies
from tests_llm_helpers import rows_of

SPACE = re.compile(r"[\x20\x09-\x0D]")


def brute_exact(rows):
    groups = {}
    for k, t in rows:
        groups.setdefault(SPACE.sub("", t or ""), []).append((-len(t or ""), k is None, k or 0, k))
    out = []
    for k, t in rows:
        body = SPACE.sub("", t or "")
        first = min(groups[body])
        out.append((k, first[3], len(groups[body]), k == first[3] and -len(t or "") == first[0],
                    hashlib.sha256(body.encode()).hexdigest()))
    return sorted(out, key=repr)


def shingles(text, size):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", lower) if w]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def brute_near(rows, size, percent):
    sets = [shingles(t, size) for _, t in rows]
    own = list(range(len(rows)))
    for i, j in itertools.combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= percent * len(sets[i] | sets[j]) and own[i] != own[j]:
            own = [own[i] if o == own[j] else o for o in own]
    out = []
    for i, (k, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if own[j] == own[i] and rows[j][0] is not None]
        least = min(ids) if ids else None
        out.append((k, len(sets[i]), least, k == least))
    return sorted(out, key=repr)


def edited(rng, words, share):
    return [rng.choice(["red", "blue", "green", "grey"]) + str(rng.randrange(999)) if rng.random() < share else w for w in words]


def near_rows(seed=1, families=6, members=12):
    rng = random.Random(seed)
    rows = []
    for _ in range(families):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.randrange(20, 200))]
        rows += [" ".join(edited(rng, base, rng.choice([0, 0.01, 0.02, 0.04, 0.1]))) for _ in range(members)]
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_exact(docs, odd_rows):
    got = exact_duplicates(docs(odd_rows))
    assert rows_of(got, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == brute_exact(odd_rows)


def test_exact_survives_hash_collisions(docs, odd_rows):
    got = exact_duplicates(docs(odd_rows), digest=lambda c: F.lpad(F.hex(F.length(c) % 3), 32, "0"))
    assert rows_of(got, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == brute_exact(odd_rows)


def test_exact_stage_keeps_whole_rows_once(docs, odd_rows):
    df = docs(odd_rows)
    got = without_copies(df)
    assert got.columns == df.columns
    assert got.count() == len({SPACE.sub("", t or "") for _, t in odd_rows})
    assert without_copies(got).count() == got.count()


@pytest.mark.parametrize(("size", "percent"), [(3, 85), (5, 80)])
def test_near(docs, odd_rows, size, percent):
    rows = near_rows() + [(1000 + k if k is not None else None, t) for k, t in odd_rows]
    got = near_duplicates(docs(rows), shingle=size, percent=percent)
    assert rows_of(got, "doc_id", "n_shingles", "component_id", "kept") == brute_near(rows, size, percent)


def test_near_with_crowded_buckets(docs, monkeypatch):
    """Many versions of one text, most of them too far apart: the last round has to find every link."""
    rng = random.Random(4)
    base = [f"w{rng.randrange(400)}" for _ in range(120)]
    rows = list(enumerate(" ".join(edited(rng, base, rng.choice([0.01, 0.03, 0.06]))) for _ in range(150)))
    monkeypatch.setattr(near_dedup, "CROWD", 4)
    got = near_duplicates(docs(rows), shingle=3, percent=85)
    assert rows_of(got, "doc_id", "n_shingles", "component_id", "kept") == brute_near(rows, 3, 85)


def test_near_stage(docs, odd_rows):
    df = docs(near_rows() + [(1000, None), (1001, "")])
    got = without_near_copies(df)
    want = near_duplicates(df).where("kept").select("doc_id")
    assert got.columns == df.columns and sorted(got.select("doc_id").collect()) == sorted(want.collect())


def test_empty(docs):
    assert exact_duplicates(docs([])).count() == near_duplicates(docs([])).count() == without_copies(docs([])).count() == 0


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(0, i) for i in range(1, 50)] + [(7, 7)]
    got = components(spark.createDataFrame(links, "a long, b long"))
    labels = {}
    for row in got.collect():
        labels.setdefault(row["label"], set()).add(row["node"])
    assert sorted(map(sorted, labels.values())) == [list(range(50)), list(range(100, 161))]
