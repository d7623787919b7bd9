"""Vector codes against an exhaustive search, and their edge cases."""

import hashlib

import numpy as np
import pytest

from millrace.llm import vector_codes as vc

KIND = "vec_id long, embedding array<float>, label int, ints string, pivots int"


def brute(rows, parts=8, entries=16, rounds=6):
    ints = np.array([[int(np.floor(float(np.float32(x)) * 4096)) for x in r[1]] for r in rows]).reshape(len(rows), parts, -1)
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0, ints[k].ravel().tolist()))[:entries]
    books = ints[order].transpose(1, 0, 2).copy()
    search = lambda: ((ints[:, :, None, :] - books[None]) ** 2).sum(axis=3)
    for _ in range(rounds):
        which = search().argmin(axis=2)
        for part, entry in np.ndindex(books.shape[:2]):
            own = ints[which[:, part] == entry, part]
            if len(own):
                books[part, entry] = [int(c) // len(own) for c in own.sum(axis=0)]
    distance = search()
    codes = ["".join(f"{c:02x}" for c in row) for row in distance.argmin(axis=2)]
    error = distance.min(axis=2).sum(axis=1).tolist()
    sums = {}
    for r, e in zip(rows, error, strict=True):
        sums[r[2]] = sums.get(r[2], 0) + e
    digest = hashlib.sha256(",".join(map(str, books.ravel())).encode()).hexdigest()
    return sorted(((r[0], c, e, sums[r[2]], digest) for r, c, e in zip(rows, codes, error, strict=True)), key=repr)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("seed", range(2))
def test_equals_exhaustive_search(spark, seed):
    rng = np.random.default_rng(seed)
    # Coarse values give ties and equal parts; a third of the rows is one vector.
    vectors = np.round(rng.standard_normal((240, 16)) * 2) / 2
    vectors[80:160] = vectors[0]
    rows = [(int(k), [float(x) for x in v], int(k) % 3 or None) for k, v in enumerate(vectors)]
    rows += [rows[5], (5, rows[9][1], 1), (None, rows[7][1], None), (None, rows[8][1], 2)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], KIND).repartition(5)
    assert found(vc.compress(df)) == brute(rows)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    good = [(4, [1.0, -1.0] * 8, 1), (2, [0.5] * 16, None)]
    bad = [(1, None, 1), (0, [], 1), (3, [nan] + [0.0] * 15, 1), (5, [inf] + [0.0] * 15, 1), (6, [None] + [0.0] * 15, 2)]
    df = spark.createDataFrame([(*r, "x", 1) for r in good + bad], KIND)
    assert found(vc.compress(df)) == brute(good)
    assert vc.compress(df.limit(0)).count() == 0
    assert vc.compress(df.where("vec_id IN (0, 1, 3)")).columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]


@pytest.mark.parametrize("vector", [[0.0] * 15, [0.0] * 24, [1e6] + [0.0] * 15])
def test_vectors_that_cannot_be_cut_are_an_error(spark, vector):
    df = spark.createDataFrame([(1, [0.0] * 16, 1, "x", 1), (2, vector, 1, "x", 1)], KIND)
    with pytest.raises(Exception, match="component|length"):
        vc.compress(df).collect()


def test_pivots_bound_and_prune():
    rng = np.random.default_rng(3)
    centres = rng.integers(-4000, 4000, (16, 8))
    parts = centres[rng.integers(0, 16, 2000)] + rng.integers(-200, 200, (2000, 8))
    pivots = vc.farthest_first(centres, 4)
    stored = vc.pivot_distances(parts, pivots).astype(np.float32).astype(np.float64)
    which, distance, evaluated = vc.nearest(parts, stored, centres, pivots)
    every = ((parts[:, None] - centres[None]) ** 2).sum(axis=2)
    assert np.array_equal(which, every.argmin(axis=1)) and np.array_equal(distance, every.min(axis=1))
    assert evaluated < 0.25 * every.size
