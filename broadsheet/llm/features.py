"""Hashed text features and the bounded sample of labelled rows that both quality models are fitted on."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.words import WordHashes, mixed, run_hashes, slices

Sparse = tuple[np.ndarray, np.ndarray]  # buckets that occur (ascending), and how often


def counted(buckets: np.ndarray) -> Sparse:
    index, counts = np.unique(buckets, return_counts=True)
    return index.astype(np.int32), counts.astype(np.float32)


def word_buckets(known: WordHashes, tokens: list[bytes], size: int, runs: tuple[int, ...] = (1,)) -> np.ndarray:
    """Buckets 0 .. size - 1 of the words and of runs of words."""
    h = known.of(tokens)
    parts = [run_hashes(h, n) if n > 1 else mixed(h) for n in runs if len(h) >= n]
    return np.concatenate(parts) % np.uint64(size) if parts else np.zeros(0, np.uint64)


def char_buckets(text: bytes, size: int, runs: tuple[int, ...] = (3,)) -> np.ndarray:
    """Buckets 0 .. size - 1 of the runs of bytes."""
    b = np.frombuffer(text, np.uint8).astype(np.uint64)
    parts = []
    for n in runs:
        if len(b) >= n:
            h = np.full(len(b) - n + 1, n, np.uint64)
            for k in range(n):
                h = h * np.uint64(257) + b[k:len(b) - n + 1 + k]
            parts.append(mixed(h) % np.uint64(size))
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def remainder(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5


def labelled(labels: DataFrame, label: str, rows: int, keep: Column | None = None) -> DataFrame:
    """(id, label) of at most `rows` labelled documents, the same in every run: those with the least hash of their id.
    Ids and labels that are null or labels other than 0 and 1 are left out; an id with several labels takes the highest."""
    known = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
    if keep is not None:
        known = known.filter(keep)
    return (known.groupBy(F.col("doc_id").alias("id")).agg(F.max(label).cast("int").alias("label"))
            .orderBy(F.xxhash64("id", F.lit(9)), "id").limit(rows))


def sample(docs: DataFrame, chosen: DataFrame, features: Callable[[str], Sparse]) -> tuple[np.ndarray, list[Sparse]]:
    """Labels and features of the chosen documents, on the driver; their number is bounded by `labelled`. One text stands
    for an id that occurs more than once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            made = [features(t or "") for t in part.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array([i.tobytes() for i, _ in made], pa.binary()),
                 pa.array([v.tobytes() for _, v in made], pa.binary())], ["id", "label", "buckets", "counts"])

    made = (docs.select(F.col("doc_id").alias("id"), "text").join(F.broadcast(chosen), "id").select("id", "label", "text")
            .mapInArrow(run, "id long, label int, buckets binary, counts binary"))
    rows = made.groupBy("id").agg(F.min(F.struct("buckets", "counts", "label")).alias("r")).select("id", "r.*").collect()
    first = sorted(rows, key=lambda r: r.id)
    return (np.array([r.label for r in first], np.float32),
            [(np.frombuffer(r.buckets, np.int32), np.frombuffer(r.counts, np.float32)) for r in first])
