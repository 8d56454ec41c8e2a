"""Quality rules: base counts with fixed limits, then a calibrated logistic regression over hashed word and character
n-grams against a fixed threshold.

The regression learns from a bounded sample of labelled rows (SAMPLE, a parameter); two thirds of it fit the weights and
one third the calibration (Platt's sigmoid), after which the score is a probability of label 1. Scoring is one pass over
all whole texts in Arrow batches; the model that tasks carry is BUCKETS weights, whatever the size of the tables.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.features import Sparse, char_buckets, counted, labelled, sample, word_buckets
from broadsheet.llm.words import WordHashes, slices

BUCKETS = 1 << 17  # half for words, half for characters
SAMPLE = 4_000
THRESHOLD = 0.5  # of the calibrated probability of label 1
MIN_WORDS = 50
MAX_REPEATED = 50  # per cent of the words
_SYMBOLS = re.compile(r"[#*$%&|<>]")


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of a whole text; zeros for a null one."""
    if not text:
        return 0, 0, 0, 0, 0
    raw = text.encode()
    tokens = raw.split()
    chars = len(b"".join(tokens).decode())
    lines = [line for line in raw.split(b"\n") if line and not line.isspace()]
    windows = list(zip(tokens, tokens[1:], tokens[2:]))
    seen = Counter(windows)
    repeated = 0
    if len(seen) < len(windows):
        upto = 0  # words before it are counted
        for k, window in enumerate(windows):
            if seen[window] > 1:
                repeated += k + 3 - max(k, upto)
                upto = k + 3
    return len(tokens), chars, len(_SYMBOLS.findall(text)), len(lines) - len(set(lines)), repeated


def features(text: str, known: WordHashes) -> Sparse:
    raw = text.encode()
    half = BUCKETS // 2
    return counted(np.concatenate([word_buckets(known, raw.split(), half, (1, 2)), char_buckets(raw, half) + np.uint64(half)]))


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    slope: float  # of the calibration
    shift: float

    def probability(self, made: Sparse) -> float:
        index, value = made
        z = self.bias
        if len(index):
            v = np.log1p(value)
            z += float(self.weights[index] @ v) / float(np.sqrt(v @ v))
        return float(1 / (1 + np.exp(-np.clip(self.slope * z + self.shift, -30, 30))))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(labels: np.ndarray, rows: list[Sparse], rounds: int = 150, decay: float = 1e-4) -> Model:
    """Logistic regression by accelerated gradient steps on unit vectors of log counts, both labels weighing the same, and
    a sigmoid fitted on every third row. With one label only, or none, the model answers that label's share."""
    if len(set(labels.tolist())) < 2:
        share = (labels.sum() + 1) / (len(labels) + 1) if len(labels) else 0.5
        odds = float(np.log(max(share, 1e-3) / max(1 - share, 1e-3)))
        return Model(np.zeros(BUCKETS, np.float32), 0.0, 0.0, odds)
    held = np.arange(len(labels)) % 3 == 2
    if len(set(labels[held].tolist())) < 2 or len(set(labels[~held].tolist())) < 2:
        held[:] = False
    use = np.flatnonzero(~held)
    lengths = np.array([len(rows[k][0]) for k in use])
    index = np.concatenate([rows[k][0] for k in use])
    value = np.concatenate([(v := np.log1p(rows[k][1])) / np.sqrt(max(v @ v, 1e-9)) for k in use]).astype(np.float32)
    edges = np.concatenate(([0], np.cumsum(lengths)))
    y = labels[use]
    balance = np.where(y == 1, 0.5 / y.sum(), 0.5 / (1 - y).sum()).astype(np.float32)

    def scores(w: np.ndarray, b: float) -> np.ndarray:
        total = np.concatenate(([0.0], np.cumsum(w[index] * value, dtype=np.float64)))
        return total[edges[1:]] - total[edges[:-1]] + b

    w = ahead = np.zeros(BUCKETS, np.float32)
    b = b_ahead = 0.0
    for t in range(rounds):  # steps of 4: the loss's curvature is at most a quarter of a unit vector's square
        error = balance * (_sigmoid(scores(ahead, b_ahead)) - y)
        slope = np.bincount(index, np.repeat(error, lengths) * value, BUCKETS).astype(np.float32) + decay * ahead
        w_new, b_new = ahead - 3 * slope, b_ahead - 3 * float(error.sum())
        pace = t / (t + 3)
        ahead, b_ahead = w_new + pace * (w_new - w), b_new + pace * (b_new - b)
        w, b = w_new, b_new
    model = Model(w, b, 1.0, 0.0)
    check = np.flatnonzero(held) if held.any() else use
    z = np.array([b + (float(w[i] @ (v := np.log1p(c))) / float(np.sqrt(v @ v)) if len(i) else 0.0) for i, c in (rows[k] for k in check)])
    model.slope, model.shift = _platt(z, labels[check])
    return model


def _platt(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Newton's method for the sigmoid of slope * z + shift, with smoothed targets."""
    ones, zeros = y.sum(), len(y) - y.sum()
    target = np.where(y == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = _sigmoid(a * z + b)
        g = np.array([((p - target) * z).sum() + 1e-3 * (a - 1), (p - target).sum()])
        r = p * (1 - p)
        h = np.array([[(r * z * z).sum() + 1e-3, (r * z).sum()], [(r * z).sum(), r.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        a, b = a - float(np.clip(step[0], -2, 2)), b - float(np.clip(step[1], -2, 2))
    return max(a, 0.0), b


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE) -> Model:
    """Learn `labels.quality` from at most `rows` labelled documents (see `features.labelled`)."""
    known = WordHashes()
    return fit(*sample(docs, labelled(labels, "quality", rows), lambda text: features(text, known)))


def judge(docs: DataFrame, model: Model, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text",
          keep: tuple[str, ...] = ()) -> DataFrame:
    """One row for each document: id, the base counts, base_failed, quality (the model's probability) and kept, and the
    columns named in `keep`.

    Null and empty texts have zero counts and fail the base rules; null and repeated ids keep their rows.
    """
    fields = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "quality", "kept"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for part in slices(batches):
            texts = part.column(part.num_columns - 1).to_pylist()
            counts = np.array([base_counts(t) for t in texts], np.int64).reshape(-1, 5)
            failed = (counts[:, 0] < MIN_WORDS) | (100 * counts[:, 4] > MAX_REPEATED * counts[:, 0])
            quality = np.array([model.probability(features(t or "", known)) for t in texts])
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:-1], *(pa.array(counts[:, k]) for k in range(5)), pa.array(failed), pa.array(quality),
                 pa.array(~failed & (quality >= threshold))], [*part.schema.names[:-1], *fields])

    given = docs.select(F.col(id_col), *keep, F.col(text_col).alias("_text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in given.schema.fields[:-1])
    return given.mapInArrow(run, kinds + ", n_words long, word_chars long, n_symbols long, n_dup_lines long, "
                            "n_repeat_words long, base_failed boolean, quality double, kept boolean")


def kept(docs: DataFrame, model: Model, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The documents that `judge` keeps, with all their columns, where they are read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for part in slices(batches):
            stay = []
            for text in part.column(text_col).to_pylist():
                n, _, _, _, repeated = base_counts(text)
                stay.append(n >= MIN_WORDS and 100 * repeated <= MAX_REPEATED * n and model.probability(features(text, known)) >= threshold)
            yield part.filter(pa.array(stay, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
