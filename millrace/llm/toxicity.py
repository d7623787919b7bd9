"""Toxicity: a support vector machine on a gap-weighted subsequence string kernel with Nyström landmarks.

The kernel of two strings sums, over all subsequences of ORDER letters, the product of their weights in
both; an occurrence may span SPAN characters and weighs DECAY per skipped one. A skipped run of spaces or marks
between two lone letters weighs one, so `i-d-i-o-t` and `i  d  i  o  t` are `idiot` in full; `idxiot` shares part of it, and with
a letter put between all of its own little is left. Landmarks are words and beginnings of words of labelled rows. A Nyström map
with landmarks z makes the kernel machine f(x) = sum of beta_z k(z, x) + b, and as k is a dot product of
subsequence weights, all landmarks fold into one table of weights per subsequence. Scoring a text then is
one pass over its characters, whatever the number of landmarks.

A text's sentences are read in windows of WINDOW characters. A sentence is as toxic as its worst window,
a text as its worst sentence.
"""

from __future__ import annotations

import itertools
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm import textblocks as tb

ORDER, SPAN, DECAY, WINDOW = 4, 8, 0.7, 12
# Bounds of the labelled sample: rows of each label, in the order of a hash of their id.
SAMPLE_ROWS = 3000
LANDMARKS = 320
ROUNDS = 4
_CODES = 32  # 0 is no character, 1 to 26 are letters, 27 is a boundary, 28 to 31 are other letters
_BOUNDARY = 27
_WIDTH = WINDOW + SPAN - 1

# Code of each byte of UTF-8. Lead bytes of longer characters are left out; of the byte after them the last five bits
# count, which are the same for both cases of accented Latin, Greek and Cyrillic letters.
_CODE = np.full(256, _BOUNDARY, dtype=np.int32)
_CODE[97:123] = _CODE[65:91] = np.arange(1, 27)
_CODE[128:192] = np.array([*range(1, 27), 28, 29, 30, 31, 28, 29])[np.arange(64) % 32]
_CODE[192:] = -1
# Offsets of the characters of an occurrence from its first one.
SHAPES = [(0, *rest) for rest in itertools.combinations(range(1, SPAN), ORDER - 1)]


def _letters(data: np.ndarray) -> np.ndarray:
    """Code of each byte; punctuation and spaces outside ASCII are boundaries too."""
    codes = _CODE[data]
    sign = np.flatnonzero(data[:-1] == 0xC2)
    codes[sign + 1] = _BOUNDARY
    sign = np.flatnonzero((data[:-2] >= 0xE2) & (data[:-2] <= 0xE3) & (data[1:-1] == 0x80))
    codes[sign + 1] = codes[sign + 2] = _BOUNDARY
    return codes


def encoded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the texts of a block, and where each begins. A text is preceded by a boundary and followed
    by empty characters that keep its windows to itself. Boundaries in a row are one. One between two lone letters
    is left out, so letters that are set apart are next to each other."""
    codes = _letters(data)
    kept = codes >= 0
    texts = np.arange(len(offsets) - 1)
    before = np.concatenate([[0], np.cumsum(kept)])[offsets]
    begin = before[:-1] + texts
    line = np.full(before[-1] + len(texts), _BOUNDARY, dtype=np.int32)
    line[np.arange(before[-1]) + np.repeat(texts, np.diff(before)) + 1] = codes[kept]
    first = np.zeros(len(line), dtype=bool)
    first[begin] = True
    stay = np.ones(len(line), dtype=bool)
    stay[1:] = first[1:] | (line[1:] != _BOUNDARY) | (line[:-1] != _BOUNDARY)
    line, first = line[stay], first[stay]
    space = np.concatenate([[True, True], line == _BOUNDARY, [True, True]])
    stay = first | ~(space[2:-2] & ~space[1:-3] & space[:-4] & ~space[3:-1] & space[4:])
    line, first = line[stay], first[stay]
    begin = np.flatnonzero(first)
    gap = _WIDTH + 1
    out = np.zeros(len(line) + len(texts) * gap, dtype=np.int32)
    out[np.arange(len(line)) + (np.cumsum(first) - 1) * gap] = line
    return out, begin + texts * gap


def word_codes(word: str) -> np.ndarray:
    """Codes of a word with the boundary before it."""
    data = np.frombuffer(word.encode(), np.uint8)
    return encoded(data, np.array([0, len(data)]))[0]


def features(codes: np.ndarray, size: int) -> Iterator[tuple[np.ndarray, float]]:
    """For each shape, the numbers of the subsequences that begin at the first `size` places of the last
    axis, and their weight. Numbers that hold an empty character count for nothing."""
    pairs = {k: codes[..., : codes.shape[-1] - k] * _CODES + codes[..., k:] for k in range(1, SPAN)}
    for _, b, c, d in SHAPES:
        yield pairs[b][..., :size] * (_CODES * _CODES) + pairs[d - c][..., c : c + size], DECAY ** (d + 1 - ORDER)


def masked(table: np.ndarray) -> np.ndarray:
    """The table with zero for every number that contains an empty character."""
    grid = table.reshape((_CODES,) * ORDER + table.shape[1:])
    for axis in range(ORDER):
        np.moveaxis(grid, axis, 0)[0] = 0
    return table


def worst_windows(codes: np.ndarray, begin: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The highest window sum of each text, and the sums of all windows."""
    size = len(codes) - SPAN + 1
    weight = np.zeros(size, dtype=np.float32)
    for feature, decay in features(codes, size):
        weight += table[feature] * np.float32(decay)
    sums = np.cumsum(np.concatenate([[0.0], weight.astype(np.float64)]))
    window = sums[WINDOW:] - sums[:-WINDOW]
    # Windows of empty characters only, but for those that reach into the next text.
    window[(begin[1:, None] - np.arange(1, WINDOW)).ravel()] = 0
    return np.maximum.reduceat(window, begin), window


class ToxicityModel:
    """Weights of subsequences, and the line that turns the worst window into a probability."""

    def __init__(self, table: np.ndarray, slope: float, offset: float):
        self.table, self.slope, self.offset = table, slope, offset

    def probability(self, worst: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * worst + self.offset, -30, 30)))


class _Landmarks:
    """Strings whose kernel with a window is taken, as one sparse matrix of subsequence weights."""

    def __init__(self, words: list[str]):
        weights: list[dict[int, float]] = []
        zero = masked(np.ones(_CODES ** ORDER, dtype=np.float32))
        for word in words:
            codes, own = word_codes(word), {}
            for feature, decay in features(codes, len(codes) - SPAN + 1):
                for number in feature[zero[feature] > 0].tolist():
                    own[number] = own.get(number, 0.0) + decay
            weights.append(own)
        self.numbers = np.array(sorted({n for own in weights for n in own}))
        self.column = np.full(_CODES ** ORDER, len(self.numbers), dtype=np.int32)
        self.column[self.numbers] = np.arange(len(self.numbers))
        matrix = np.zeros((len(self.numbers) + 1, len(words)), dtype=np.float32)
        for k, own in enumerate(weights):
            matrix[self.column[list(own)], k] = list(own.values())
        norms = np.sqrt((matrix ** 2).sum(axis=0))
        self.matrix = matrix / np.where(norms > 0, norms, 1)

    def kernel(self, windows: np.ndarray) -> np.ndarray:
        """Kernel of every window (a row of codes) with every landmark."""
        return np.concatenate([*self.kernel_blocks(windows)])

    def kernel_blocks(self, windows: np.ndarray) -> Iterator[np.ndarray]:
        """The same in blocks of rows."""
        for first in range(0, len(windows), 256):
            part = windows[first : first + 256]
            counts = np.zeros((len(part), len(self.numbers) + 1), dtype=np.float32)
            rows = np.repeat(np.arange(len(part)), WINDOW)
            for feature, decay in features(part, WINDOW):
                np.add.at(counts, (rows, self.column[feature].ravel()), np.float32(decay))
            counts[:, -1] = 0
            yield counts @ self.matrix

    def fold(self, beta: np.ndarray) -> np.ndarray:
        """The weighted sum of all landmarks as one table over subsequences."""
        table = np.zeros(_CODES ** ORDER, dtype=np.float32)
        table[self.numbers] = (self.matrix @ beta.astype(np.float32))[:-1]
        return masked(table)


def _svm(z: np.ndarray, y: np.ndarray, cost: float = 10.0) -> tuple[np.ndarray, float]:
    """Linear support vector machine with squared hinge loss, classes balanced, by Newton steps whose sums run over
    blocks of rows. The last column of z is one."""
    share = cost * len(y) * np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1))
    keep = np.full(z.shape[1], 1.0)
    keep[-1] = 1e-6
    w = np.zeros(z.shape[1])
    for _ in range(30):
        inside = np.flatnonzero(y * (z @ w) < 1)
        curve, pull = np.diag(keep), np.zeros(z.shape[1])
        for first in range(0, len(inside), 1024):
            at = inside[first : first + 1024]
            zi = z[at] * share[at, None]
            curve += zi.T @ z[at]
            pull += zi.T @ y[at]
        new = np.linalg.solve(curve, pull)
        if np.allclose(new, w, atol=1e-6):
            break
        w = new
    return w[:-1], float(w[-1])


def _platt(worst: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a weighted logistic fit to softened labels, by Newton steps that never go uphill."""
    center, scale = float(np.mean(worst)), float(np.std(worst)) or 1.0
    z = np.column_stack([(worst - center) / scale, np.ones(len(worst))])
    y = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))

    def loss(w: np.ndarray) -> float:
        return float(weight @ (np.logaddexp(0, z @ w) - y * (z @ w)) + 5e-4 * w @ w)

    w = np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -500, 500)))
        gradient = z.T @ (weight * (p - y)) + 1e-3 * w
        step = np.linalg.solve((z * (weight * p * (1 - p))[:, None]).T @ z + 1e-3 * np.eye(2), gradient)
        size = 1.0
        while size > 1e-6 and loss(w - size * step) > loss(w):
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return float(w[0] / scale), float(w[1] - w[0] * center / scale)


def train(texts: list[str], toxic: np.ndarray, share: float) -> ToxicityModel:
    """Fit on whole labelled texts; `share` is the share of toxic rows among all labelled ones.

    Only some sentences of a toxic text are toxic, so the machine and the choice of each text's worst window
    are fitted in turn. Landmarks are the words whose document frequency differs most between the labels,
    and as many common words of clean texts.
    """
    texts = [t or "" for t in texts]
    toxic = np.asarray(toxic).astype(bool)
    if toxic.all() or not toxic.any():
        prior = min(max(share, 1e-3), 1 - 1e-3)
        return ToxicityModel(np.zeros(_CODES ** ORDER, np.float32), 0.0, float(np.log(prior / (1 - prior))))
    landmarks, lift = _choose_landmarks(texts, toxic)
    if not landmarks:
        return ToxicityModel(np.zeros(_CODES ** ORDER, np.float32), 0.0, float(np.log(share / (1 - share))))
    marks = _Landmarks(landmarks)
    values, vectors = np.linalg.eigh((marks.matrix.T @ marks.matrix).astype(np.float64))
    good = values > 1e-4
    half = (vectors[:, good] / np.sqrt(values[good])) @ vectors[:, good].T

    # Codes are kept as bytes and widened a block at a time.
    blocks = [(codes.astype(np.uint8), begin) for codes, begin in (
        encoded(data, offsets) for *_, data, offsets in tb.blocks(pa.array(texts, pa.large_string()), 1 << 18))]
    table = marks.fold(lift)
    clean: dict[bytes, None] = {}
    for _ in range(ROUNDS):
        bad = []
        for window, label in zip((w for b in blocks for w in _worst_codes(*b, table)), toxic, strict=True):
            # A toxic text counts by its worst window; a clean one by all that were its worst so far.
            if label:
                bad.append(window)
            else:
                clean[window.tobytes()] = None
        good_ones = np.frombuffer(b"".join(clean), np.int32).reshape(-1, _WIDTH)
        windows = np.concatenate([np.array(bad), good_ones])
        mapped, first = np.ones((len(windows), half.shape[1] + 1)), 0
        for part in marks.kernel_blocks(windows):
            mapped[first : first + len(part), :-1] = part @ half
            first += len(part)
        weights, _ = _svm(mapped, np.repeat([1.0, -1.0], [len(bad), len(good_ones)]))
        table = marks.fold(half @ weights)
    worst = np.concatenate([worst_windows(codes.astype(np.int32), begin, table)[0] for codes, begin in blocks])
    weight = np.where(toxic, share / toxic.mean(), (1 - share) / (1 - toxic.mean()))
    return ToxicityModel(table, *_platt(worst, toxic.astype(float), weight))


def _choose_landmarks(texts: list[str], toxic: np.ndarray) -> tuple[list[str], np.ndarray]:
    """Words and beginnings of words whose document frequency is highest for toxic texts, by its z-score,
    then common words of clean texts; and a first weight of each."""
    counts = [Counter(), Counter()]
    for text, label in zip(texts, toxic, strict=True):
        found = set(re.findall(r"[^\W\d_]{%d,}" % (ORDER - 1), text.lower()))
        # Words of three letters need the boundary after them to tell them from beginnings.
        counts[int(label)].update({w[:n] if len(w) >= ORDER else w + " " for w in found for n in (5, 6, 7, 8, 12)})
    n = [max(int((~toxic).sum()), 1), max(int(toxic.sum()), 1)]
    score = {}
    for word, c in counts[1].items():
        p = (c + counts[0][word]) / (n[0] + n[1])
        if c >= 3 and p < 1:
            score[word] = (c / n[1] - counts[0][word] / n[0]) / np.sqrt(p * (1 - p) * (1 / n[0] + 1 / n[1]))
    bad = [w for w in sorted(score, key=lambda w: (-score[w], w)) if score[w] > 3][: LANDMARKS * 2 // 3]
    common = [w for w, _ in sorted(counts[0].items(), key=lambda p: (-p[1], p[0]))[:LANDMARKS]]
    chosen = list(dict.fromkeys([*bad, *common]))[:LANDMARKS]
    return chosen, np.array([max(score.get(w, 0.0), 0.0) if w in bad else 0.0 for w in chosen])


def _worst_codes(codes: np.ndarray, begin: np.ndarray, table: np.ndarray) -> Iterator[np.ndarray]:
    """The worst window of each text, as codes."""
    codes = codes.astype(np.int32)
    worst, window = worst_windows(codes, begin, table)
    for a, b in zip(begin, [*begin[1:], len(window)], strict=True):
        at = a + int(np.argmax(window[a:b]))
        yield codes[at : at + _WIDTH]


def _in_training(id_col: Column) -> Column:
    """Whether a row may teach: the rest of crc32 of its id, as text, by four is not two."""
    return F.coalesce(F.crc32(id_col.cast("string")) % 4 != 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", rows: int = SAMPLE_ROWS) -> ToxicityModel:
    """Train on at most `rows` labelled texts of each label, chosen by a hash of the id.

    Rows whose crc32 of the id has rest 2 by 4 never teach. A null label or id is no label; an id that is
    there several times with several labels counts with the highest. Only chosen texts reach the driver.
    """
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("y"))
    known = known.where(F.col("y").isNotNull() & _in_training(F.col("id"))).groupBy("id").agg(F.max("y").alias("y"))
    share = known.agg(F.avg((F.col("y") > 0).cast("double"))).first()[0] or 0.0
    hashed = known.withColumn("h", F.xxhash64(F.col("id").cast("string")))
    chosen = [hashed.where((F.col("y") > 0) == F.lit(toxic)).orderBy("h", "id").limit(rows) for toxic in (True, False)]
    ids = F.broadcast(chosen[0].unionAll(chosen[1]).select("id", "y"))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(ids, "id")
    texts = texts.groupBy("id", "y").agg(F.max("text").alias("text")).select("id", "y", "text")
    sample = texts.toPandas().sort_values("id")
    return train(sample["text"].tolist(), sample["y"].to_numpy() > 0, share)


def score_batches(batches: Iterator[pa.RecordBatch], model: ToxicityModel, text_at: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        scores = [model.probability(worst_windows(*encoded(data, offsets), model.table)[0])
                  for *_, data, offsets in tb.blocks(batch.column(text_at), 1 << 18)]
        yield batch, np.concatenate(scores) if scores else np.zeros(0)


def score(df: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every row: the probability that a text is toxic, from 0 to 1.

    Null and empty texts, and texts without letters, have the score of an empty window. Rows that repeat an
    id each give a row. Only the two named columns are read. The model, a table of four megabytes whatever
    the size of the data, goes to the executors as a broadcast variable.
    """
    docs = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, scores in score_batches(batches, shared.value, 1):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["id", "score"])

    scored = docs.mapInArrow(run, f"id {docs.schema['id'].dataType.simpleString()}, score double")
    return scored.withColumnRenamed("id", id_col)


def without_toxic(df: DataFrame, model: ToxicityModel, threshold: float, text_col: str = "text") -> DataFrame:
    """The rows whose text scores below the threshold, with all their columns."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    at = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, scores in score_batches(batches, shared.value, at):
            yield batch.filter(pa.array(scores < threshold, pa.bool_()))

    return df.mapInArrow(run, df.schema)
