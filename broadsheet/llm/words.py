"""Words, shingles and Arrow slices shared by the text operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

SEED = 42  # of every XXH64 here; the same as Spark's own xxhash64
SLICE = 256  # documents held as Python objects at a time


def words(text: str | None) -> list[bytes]:
    """Words `[^\\x20\\x09-\\x0D]+` with A-Z lower-cased; none for a null text."""
    return text.encode().lower().split() if text else []


def shingles(tokens: list[bytes], n: int) -> list[bytes]:
    """Runs of n words, repeats included; a shorter text gives its whole sequence, an empty one nothing."""
    if not tokens:
        return []
    joined = b" ".join(tokens)
    if len(tokens) <= n:
        return [joined]
    ends = np.cumsum([len(t) + 1 for t in tokens])
    starts = np.concatenate(([0], ends[:-1]))[: len(tokens) - n + 1].tolist()
    return [joined[a:b] for a, b in zip(starts, (ends[n - 1:] - 1).tolist())]


def hashes(items: list[bytes]) -> np.ndarray:
    h = xxhash.xxh64_intdigest
    return np.fromiter((h(x, SEED) for x in items), np.uint64, len(items))


class WordHashes(dict):
    """XXH64 of words, remembered; forgets all when it has grown large, so memory stays bounded."""

    LIMIT = 400_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word, SEED)
        return value

    def of(self, tokens: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, tokens), np.uint64, len(tokens))


def mixed(h: np.ndarray) -> np.ndarray:
    """A finaliser over uint64, so that combined hashes spread over all bits."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def run_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """One hash for each run of n consecutive word hashes; the whole sequence where it is shorter."""
    if len(h) == 0:
        return h
    n = min(n, len(h))
    out = np.zeros(len(h) - n + 1, np.uint64)
    for k in range(n):
        out = mixed(out * np.uint64(31) + h[k:len(h) - n + 1 + k])
    return out


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE) -> Iterator[pa.RecordBatch]:
    """Small pieces of each batch, so that only few documents are Python objects at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def free_names(docs: DataFrame, *names: str) -> list[str]:
    """Names for working columns that the table does not have, whatever their case."""
    held, mark = {c.lower() for c in docs.columns}, "_"
    while any((mark + name).lower() in held for name in names):
        mark += "_"
    return [mark + name for name in names]
