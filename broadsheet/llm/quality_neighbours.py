"""Quality by nearest labelled neighbours in a latent-semantic space.

A bounded sample of labelled rows (SAMPLE, a parameter) gives hashed term weights, their singular vectors, and the labelled
points. Every document of the table is then projected, its cosines with all labelled points are computed exactly in blocks,
and the NEAREST most similar ones vote, each weighing its similarity. What tasks carry is bounded by the sample, not by the
tables: BUCKETS x RANK and SAMPLE x RANK numbers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.features import Sparse, char_buckets, counted, labelled, remainder, sample, word_buckets
from broadsheet.llm.words import WordHashes, mixed, slices

BUCKETS = 8_192  # a quarter for words, the rest for runs of bytes
SAMPLE = 3_000
RANK = 64
NEAREST = 25
THRESHOLD = 0.3


LAGS, LEVELS, WEIGHT = 16, (0.1, 0.2, 0.4), 50


def repetition(h: np.ndarray) -> np.ndarray:
    """Terms that say at which distances many words return: one for each distance and share reached, WEIGHT times."""
    marks = [lag * len(LEVELS) + k for lag in range(1, LAGS + 1) if len(h) > lag
             for k, level in enumerate(LEVELS) if (h[lag:] == h[:-lag]).mean() >= level]
    return mixed(np.repeat(np.array(marks, np.uint64), WEIGHT))


def features(text: str, known: WordHashes) -> Sparse:
    """Words, runs of three bytes, and repetition."""
    raw, words = text.encode(), BUCKETS // 4
    tokens = raw.split()
    return counted(np.concatenate([word_buckets(known, tokens, words), repetition(known.of(tokens)) % np.uint64(words),
                                   char_buckets(raw, BUCKETS - words) + np.uint64(words)]))


@dataclass
class Space:
    scale: np.ndarray  # weight of each bucket
    axes: np.ndarray  # BUCKETS x RANK
    points: np.ndarray  # labelled points, of length 1
    labels: np.ndarray
    prior: float

    def place(self, rows: list[Sparse]) -> np.ndarray:
        """Unit vectors in the space; zero for a text without features."""
        return unit(weighted(rows, self.scale) @ self.axes)

    def votes(self, rows: list[Sparse]) -> np.ndarray:
        """Share of label 1 among the nearest labelled points, by similarity; the prior where nothing is similar."""
        if not len(self.points):
            return np.full(len(rows), self.prior)
        cosine = self.place(rows) @ self.points.T
        n = min(NEAREST, cosine.shape[1])
        near = np.argpartition(-cosine, n - 1, axis=1)[:, :n]
        weight = np.maximum(np.take_along_axis(cosine, near, 1), 0).astype(np.float64) ** 4
        total = weight.sum(axis=1)
        share = (weight * self.labels[near]).sum(axis=1) / np.where(total > 0, total, 1)
        return np.where(total > 0, np.clip(share, 0, 1), self.prior)


def unit(m: np.ndarray) -> np.ndarray:
    size = np.sqrt((m * m).sum(axis=1, keepdims=True))
    return m / np.where(size > 1e-12, size, 1)


def weighted(rows: list[Sparse], scale: np.ndarray) -> np.ndarray:
    out = np.zeros((len(rows), BUCKETS), np.float32)
    for k, (index, counts) in enumerate(rows):
        out[k, index] = np.log1p(counts) * scale[index]
    return unit(out)


def fit(labels: np.ndarray, rows: list[Sparse]) -> Space:
    """Inverse document frequencies, singular vectors by subspace iteration, and the labelled points."""
    prior = float(labels.mean()) if len(labels) else 0.5
    seen = np.bincount(np.concatenate([i for i, _ in rows]), minlength=BUCKETS) if rows else np.zeros(BUCKETS)
    scale = np.log((1 + len(rows)) / (1 + seen)).astype(np.float32) + np.float32(0.05)
    m = weighted(rows, scale)
    rank = min(RANK, len(rows), BUCKETS)
    if not rank:
        return Space(scale, np.zeros((BUCKETS, 1), np.float32), np.zeros((0, 1), np.float32), labels, prior)
    axes = np.random.default_rng(0).standard_normal((BUCKETS, min(BUCKETS, rank + 8))).astype(np.float32)
    for _ in range(4):
        axes, _ = np.linalg.qr(m.T @ (m @ axes))
    _, _, turn = np.linalg.svd(m @ axes, full_matrices=False)
    axes = np.ascontiguousarray((axes @ turn.T)[:, :rank])
    return Space(scale, axes, unit(m @ axes), labels, prior)


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE) -> Space:
    """Learn `labels.quality` from at most `rows` documents whose crc32(id as text) mod 5 is not 0."""
    known = WordHashes()
    chosen = labelled(labels, "quality", rows, remainder() != 0)
    return fit(*sample(docs, chosen, lambda text: features(text, known)))


def classify(docs: DataFrame, space: Space, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, score, predicted) of every document; only the text is an input of the score. Null and empty texts
    take the labelled share of label 1; null ids are not held out; repeated rows stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for part in slices(batches):
            score = space.votes([features(t or "", known) for t in part.column(2).to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(score), pa.array((score >= threshold).astype(np.int32))],
                ["id", "held_out", "score", "predicted"])

    held = F.coalesce(remainder(id_col) == 0, F.lit(False))
    return (docs.select(F.col(id_col).cast("long").alias("id"), held.alias("held_out"), F.col(text_col).alias("text"))
            .mapInArrow(run, "id long, held_out boolean, score double, predicted int").withColumnRenamed("id", id_col))
