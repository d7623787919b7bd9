"""Mixing to target weights with soft membership: domain posteriors, then nonnegative rates by least squares.

A classifier learnt from a labelled table says to which degree a document belongs to each domain. Every
document gets a rate, how often it is to appear, such that the expected tokens of each domain meet their
targets. Of all rates that do, those with the least squared distance from one, weighted by tokens, are
taken, under a least rate. They are one plus the product of a document's posteriors with one number per
domain, cut at the least rate, so equal documents keep equal rates. Newton steps find these numbers; a
step needs a few sums over all documents and nothing else.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import quality
from millrace.llm import textblocks as tb
from millrace.session import settle

# Rows of labelled texts the classifier learns from, in the order of a hash of their id.
SAMPLE_ROWS = 3000
# Scans after which a fit that has not converged is an error; a usual one takes about ten.
STEPS = 200
# Largest miss of a target, as a share of it.
TOLERANCE = 1e-6
# Pull of a Newton step to where it begins, as a share of the Gram matrix.
_PULL = 1e-6


class DomainModel:
    """Softmax over latent vectors."""

    def __init__(self, space: quality.TermSpace, weights: np.ndarray, bias: np.ndarray):
        self.space, self.weights, self.bias = space, weights, bias

    def posteriors(self, counts: np.ndarray) -> np.ndarray:
        z = self.space.vectors(counts) @ self.weights + self.bias
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


def _softmax_fit(x: np.ndarray, y: np.ndarray, domains: int, pull: float = 1e-3) -> tuple[np.ndarray, np.ndarray]:
    """Multinomial logistic regression by accelerated gradient steps, lightly pulled to zero."""
    x1 = np.hstack([x.astype(np.float64), np.ones((len(x), 1))])
    want = np.eye(domains)[y]
    w = ahead = np.zeros((x1.shape[1], domains))
    step = 1.0 / (0.5 * np.linalg.norm(x1, 2) ** 2 / len(x) + pull)
    for k in range(600):
        z = x1 @ ahead
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        new = ahead - step * (x1.T @ (p - want) / len(x) + pull * ahead)
        ahead, w = new + (k / (k + 3)) * (new - w), new
    return w[:-1], w[-1]


def fit_domains(docs: DataFrame, labels: DataFrame, domains: int, label_col: str = "domain", id_col: str = "doc_id",
                text_col: str = "text", rows: int = SAMPLE_ROWS) -> DomainModel:
    """Learn domains 0 to domains - 1 from at most `rows` labelled texts; term weights come from all texts.
    Without labels all domains are alike for every text."""
    df, total = quality.document_counts(docs, text_col)
    sample = quality.labelled_sample(docs, labels, label_col, rows, id_col, text_col, teach=F.lit(True))
    if not sample:
        return DomainModel(quality.TermSpace(np.ones(quality.TERMS), np.zeros((quality.TERMS, 1))),
                           np.zeros((1, domains)), np.zeros(domains))
    counts = quality.counts_of([t for t, _ in sample])
    space = quality.TermSpace.fit(counts, df, total)
    return DomainModel(space, *_softmax_fit(space.vectors(counts), np.array([y for _, y in sample]), domains))


def _described(model: DomainModel, texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, tokens, posteriors) of blocks of texts; tokens are words."""
    for first, end, data, offsets in tb.blocks(texts, 1 << 19, quality.BLOCK_ROWS):
        tokens = np.diff(tb.words(data, offsets)[2])
        yield first, end, tokens, model.posteriors(quality.term_counts(data, offsets))


def memberships(df: DataFrame, model: DomainModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, tokens, p) of every row: words of the text, and its posterior for each domain. Null counts as
    empty; an empty text has no tokens and the posteriors of a text like nothing."""
    docs = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, tokens, p in _described(shared.value, batch.column(1)):
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, p.size + 1, p.shape[1]), pa.int32()), pa.array(p.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, end - first), pa.array(tokens, pa.int64()), lists], ["id", "tokens", "p"])

    return docs.mapInArrow(run, f"id {docs.schema['id'].dataType.simpleString()}, tokens bigint, p array<double>")


def _dot(p, push: np.ndarray):
    return sum((p[i] * F.lit(x) for i, x in enumerate(push.tolist())), F.lit(0.0))


def _rate(p, pushes: list[np.ndarray], least: float):
    """The rate after the pushes, as an expression: each lowers or lifts a row along its posteriors.

    Rates are computed from the few numbers of each push again and are never stored, so a lost task only
    repeats arithmetic."""
    rate = F.lit(max(1.0, least))
    for push in pushes:
        rate = F.greatest(F.lit(least), rate - _dot(p, push))
    return rate


def fit_rates(rows: DataFrame, targets: np.ndarray, least: float = 0.0, steps: int = STEPS,
              per: np.ndarray | None = None) -> list[np.ndarray]:
    """The push that takes rows (tokens, p) to target tokens of each domain; none where one is met already.

    It goes on until all targets are met to TOLERANCE of `per`, by default of themselves. Targets that no
    rates reach are met as closely as least squares allow, each miss relative to its domain, and a warning
    names the misses. A fit that is neither after `steps` scans is an error.

    Rates that meet the targets closest to one minimise a convex function of the push, whose gradient is
    the miss and whose second derivative is the Gram matrix of the rows above the least rate.
    """
    k, start = len(targets), max(1.0, least)
    bound = TOLERANCE * np.maximum(targets if per is None else per, 1.0)

    def sums(frame: DataFrame, columns: list) -> np.ndarray:
        return np.array([v or 0.0 for v in frame.agg(*(c.alias(f"c{n}") for n, c in enumerate(columns))).first()])

    tokens, p, z = F.col("tokens"), F.col("p"), F.col("z")
    pairs = [(i, j) for i in range(k) for j in range(i, k)]

    def square(flat: np.ndarray) -> np.ndarray:
        out = np.zeros((k, k))
        for (i, j), v in zip(pairs, flat, strict=True):
            out[i, j] = out[j, i] = v
        return out

    def at(u: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """The convex function, the miss of each domain and the Gram matrix of the rows above the least rate."""
        raised = rows.select("tokens", "p", (F.lit(start) - _dot(p, -root * u)).alias("z"))
        above = z >= least
        found = sums(raised, [
            F.sum(tokens * F.when(above, z * z / 2).otherwise(least * (z - least / 2))),
            *(F.sum(tokens * F.greatest(F.lit(least), z) * p[i]) for i in range(k)),
            *(F.sum(F.when(above, tokens * p[i] * p[j]).otherwise(0.0)) for i, j in pairs)])
        return found[0] - float(targets @ (root * u)), found[1 : k + 1] - targets, square(found[k + 1 :])

    def settled(u: np.ndarray, miss: np.ndarray) -> bool:
        """Whether no change of rates above the least one lowers the squared misses any more."""
        raised = rows.select("tokens", "p", (F.lit(start) - _dot(p, -root * u)).alias("z"))
        slope = _dot(p, root * root * miss)
        free, full = sums(raised, [F.sum(F.when((z > least) | (slope < 0), tokens * slope * slope).otherwise(0.0)),
                                   F.sum(tokens * _dot(F.transform(p, F.abs), np.abs(root * root * miss)) ** 2)])
        return free <= 1e-8 * full

    gram = square(sums(rows, [F.sum(tokens * p[i] * p[j]) for i, j in pairs]))
    root = np.sqrt(np.where(np.diag(gram) > 0, 1.0 / np.maximum(np.diag(gram), 1e-300), 0.0))
    u = np.zeros(k)
    value, miss, active = at(u)
    scans = 2
    while not np.all(np.abs(miss) <= bound):
        if scans >= steps:
            raise RuntimeError(f"rates have not converged after {scans} scans; targets {targets}, misses {miss}")
        step = -np.linalg.solve(root[:, None] * active * root + _PULL * np.eye(k), root * miss)
        slope, size = float(step @ (root * miss)), 1.0
        new = at(u + step)
        scans += 1
        while new[0] > value + 1e-4 * size * slope + 1e-12 * abs(value) and scans < steps:
            size /= 2
            new = at(u + size * step)
            scans += 1
        before = np.linalg.norm(root * miss)
        u = u + size * step
        value, miss, active = new
        if np.linalg.norm(root * miss) > 0.9 * before and not np.all(np.abs(miss) <= bound):
            scans += 1
            if settled(u, miss):
                warnings.warn(f"no rates reach the targets {targets.tolist()}; left over: {miss.tolist()}", stacklevel=2)
                break
    return [-root * u] if u.any() else []


def mixing_rates(df: DataFrame, model: DomainModel, weights: list[float], id_col: str = "doc_id",
                 text_col: str = "text", least: float = 0.0) -> DataFrame:
    """(id, tokens, p, rate) of every row. Targets are the weights' shares of all tokens. Rows that repeat an
    id each give a row; an empty table gives none."""
    rows = settle(memberships(df, model, id_col, text_col), "memberships")
    total = rows.agg(F.sum("tokens")).first()[0] or 0
    targets = np.array(weights, dtype=float) / sum(weights) * total
    pushes = fit_rates(rows, targets, least)
    return rows.withColumn("rate", _rate(F.col("p"), pushes, least)).withColumnRenamed("id", id_col)


def lifted(df: DataFrame, model: DomainModel, weights: list[float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of df, each at least once and as often as its rate says, with all their columns.

    No document is lost: the least rate is one. The rates are those closest to one that give the domains the
    ratio of the weights; the sum of tokens is free, as lifting a text of one domain lifts its share of all
    others. A rate between two numbers is settled by a hash of the text, so a repeated task repeats its choice.
    """
    rows = settle(memberships(df, model, id_col, text_col), "memberships")
    share = np.array(weights, dtype=float) / sum(weights)
    # The ratio is met where posteriors less the shares add up to nothing.
    off = rows.select("tokens", F.array(*(F.col("p")[i] - x for i, x in enumerate(share.tolist()))).alias("p"))
    total = rows.agg(F.sum("tokens")).first()[0] or 0
    # Posteriors add up to one, so a push along the differences is one along the posteriors.
    pushes = [push - share @ push for push in fit_rates(off, np.zeros(len(share)), 1.0, per=share * total)]
    shared = df.sparkSession.sparkContext.broadcast(model)
    at = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in tb.blocks(batch.column(at), 1 << 19, quality.BLOCK_ROWS):
                p = shared.value.posteriors(quality.term_counts(data, offsets))
                rate = np.ones(len(p))
                for push in pushes:
                    rate = np.maximum(1.0, rate - p @ push)
                draw = tb.word_hashes(data, offsets[:-1], offsets[1:]) / 2.0 ** 64
                copies = np.floor(rate + draw).astype(np.int64)
                yield batch.slice(first, end - first).take(pa.array(np.repeat(np.arange(end - first), copies)))

    return df.mapInArrow(run, df.schema)
