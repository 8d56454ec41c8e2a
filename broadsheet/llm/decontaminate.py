"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks, exact similarity.

For every benchmark item, windows of as many words as the item has slide over each whole document. A window of which too
few shingles occur in an item cannot reach the similarity with it; those shingles are counted for all windows at once, from
the places where a shingle of the item occurs, and this drops no hit. Every other window gets a fingerprint, whose counts of
ones roll over the document: what enters is added, what leaves is subtracted. Two fingerprints that differ in at most
`radius` bits differ in at most radius // BLOCKS bits of some byte; tables of the near values of the items' bytes so find all
pairs within the radius. These are verified by their exact weighted similarity: the shingles' counts, sum of the lesser by
sum of the greater. A window alike in 0.8 differs in about 10 bits with a deviation of 3, far from the radius.

Documents are judged where they are read, without a shuffle. The items are carried in blocks of at most ITEM_WORDS words,
each a pass over the documents, so what a task holds does not grow with the benchmark.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.words import SEED, WordHashes, run_hashes, slices, words

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 23
BLOCKS = 8
WINDOWS = 4_096  # places of a document whose fingerprints are made at a time
ITEM_WORDS = 4_000_000
_EDGES = b".,;:!?\"'()[]{}"


class BareHashes(WordHashes):
    """Hashes of words without the punctuation at their ends; 0 for a word that has nothing else."""

    def __missing__(self, word: bytes) -> int:
        bare = word.strip(_EDGES)
        if bare == word:
            return super().__missing__(word)
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = self[bare] if bare else 0
        return value


def bits(shingles: np.ndarray) -> np.ndarray:
    return np.unpackbits(np.ascontiguousarray(shingles).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def folded(counts: np.ndarray, n: int) -> np.ndarray:
    """Fingerprints from the numbers of ones of each bit among n shingles."""
    return np.packbits(2 * counts > n, axis=1, bitorder="little").view(np.uint64).ravel()


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    x, y = Counter(a.tolist()), Counter(b.tolist())
    both = sum((x & y).values())
    return both / (len(a) + len(b) - both) if len(a) + len(b) else 0.0


class Sized:
    """Items of one number of words, with the items that hold each shingle, and the tables of their fingerprints' bytes."""

    def __init__(self, n_words: int, items: list[tuple[int, np.ndarray]], radius: int):
        self.n_words, self.items, self.radius = n_words, items, radius
        distinct = [np.unique(s) for _, s in items]
        held, by = np.concatenate(distinct), np.repeat(np.arange(len(items)), [len(s) for s in distinct])
        order = np.argsort(held, kind="stable")
        self.holders = by[order]
        self.shingles, first = np.unique(held[order], return_index=True)
        self.edges = np.append(first, len(held))

    @cached_property
    def prints(self) -> np.ndarray:
        return np.array([folded(bits(s).sum(axis=0, dtype=np.int64)[None, :], len(s))[0] for _, s in self.items], np.uint64)

    @cached_property
    def tables(self) -> np.ndarray:
        near = np.bitwise_count(np.arange(256, dtype=np.uint8)[:, None] ^ np.arange(256, dtype=np.uint8)[None, :]) <= self.radius // BLOCKS
        return near[:, self.prints.view(np.uint8).reshape(-1, 8)].transpose(2, 0, 1)  # byte's place, its value, item

    def sharing(self, s: np.ndarray, places: np.ndarray, n: int, need: int) -> Iterator[tuple[int, np.ndarray]]:
        """(item, starts) of all windows of n of the shingles `s` with at least `need` that occur in the item; shingles that
        occur in any item lie at `places`."""
        at = np.minimum(np.searchsorted(self.shingles, s[places]), len(self.shingles) - 1)
        own = self.shingles[at] == s[places]
        at, places = at[own], places[own]
        counts = self.edges[at + 1] - self.edges[at]
        ends = np.cumsum(counts)
        item = self.holders[np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts) + np.repeat(self.edges[at], counts)]
        order = np.argsort(item, kind="stable")
        item, where = item[order], np.repeat(places, counts)[order]
        edges = np.flatnonzero(np.concatenate(([True], item[1:] != item[:-1], [True]))) if len(item) else np.zeros(0, np.int64)
        for a, b in zip(edges[:-1], edges[1:]):
            if b - a >= need:
                seen = where[a:b]
                low = max(0, int(seen[0]) - n + 1)
                starts = np.arange(low, min(len(s) - n, int(seen[-1])) + 1)
                inside = np.searchsorted(seen, starts + n) - np.searchsorted(seen, starts)
                yield int(item[a]), starts[inside >= need]

    def windows(self, s: np.ndarray, starts: np.ndarray, n: int) -> Iterator[tuple[int, int]]:
        """(start, item) of all windows of n of the shingles `s`, among the ascending `starts`, whose fingerprint lies within
        the radius of the item's."""
        edges = [0, *(np.flatnonzero(np.diff(starts // WINDOWS)) + 1).tolist(), len(starts)]
        for a, b in zip(edges[:-1], edges[1:]):
            part, first = starts[a:b], int(starts[a])
            ones = np.zeros((int(part[-1]) + n - first + 1, 64), np.int32)
            np.cumsum(bits(s[first:int(part[-1]) + n]), axis=0, dtype=np.int32, out=ones[1:])
            prints = folded(ones[part - first + n] - ones[part - first], n)
            yield from ((int(part[window]), item) for window, item in self.candidates(prints))

    def candidates(self, prints: np.ndarray) -> Iterator[tuple[int, int]]:
        """(window, item) of all fingerprints within the radius."""
        for at in range(0, len(prints), 512):
            part = prints[at:at + 512]
            found = np.zeros((len(part), len(self.items)), bool)
            for place, values in enumerate(part.view(np.uint8).reshape(-1, 8).T):
                found |= self.tables[place][values]
            window, item = np.nonzero(found)
            close = np.bitwise_count(part[window] ^ self.prints[item]) <= self.radius
            yield from zip((window[close] + at).tolist(), item[close].tolist())


class Index:
    def __init__(self, items: list[tuple[int, str | None]], shingle: int = SHINGLE, least: float = SIMILARITY, radius: int = RADIUS):
        self.shingle, self.least = shingle, least
        known, by_size = BareHashes(), {}
        for item, text in items:
            h = known.of(words(text))
            h = h[h != 0]
            if len(h):
                by_size.setdefault(len(h), []).append((item, run_hashes(h, shingle)))
        self.sizes = [Sized(n, rows, radius) for n, rows in sorted(by_size.items())]
        every = [s for size in self.sizes for _, s in size.items]
        self.shingles = np.unique(np.concatenate(every)) if every else np.zeros(0, np.uint64)
        short = [n for n in by_size if n < shingle]  # their shingle is the whole item, of fewer words
        self.short = sorted(short)

    def _known(self, s: np.ndarray) -> np.ndarray:
        if not len(self.shingles) or not len(s):
            return np.zeros(len(s), bool)
        at = np.minimum(np.searchsorted(self.shingles, s), len(self.shingles) - 1)
        return self.shingles[at] == s

    def hits(self, text: str | None, known: BareHashes) -> list[tuple[int, float, int, int]]:
        """(item, similarity, first word, word after the last) of the best window of each item that a document holds."""
        h = known.of(words(text))
        place = np.flatnonzero(h != 0)
        h = h[place]
        if not len(h):
            return []
        best: dict[int, tuple[float, int, int]] = {}
        by_run: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for size in self.sizes:
            run = min(self.shingle, size.n_words, len(h))
            if run not in by_run:
                s = run_hashes(h, run)
                by_run[run] = s, np.concatenate(([0], np.cumsum(self._known(s))))
            s, seen = by_run[run]
            if not seen[-1]:
                continue
            n_item = len(size.items[0][1])
            n = min(size.n_words - run + 1, len(s))  # shingles of a window; a shorter document is one window
            # shared / (n + n_item - shared) >= least
            need = math.ceil(self.least * (n + n_item) / (1 + self.least) - 1e-9)
            if (seen[n:] - seen[:-n]).max() < need:
                continue
            possible = [starts for _, starts in size.sharing(s, np.flatnonzero(np.diff(seen)), n, need) if len(starts)]
            if not possible:
                continue
            for a, which in size.windows(s, np.unique(np.concatenate(possible)), n):
                item, shingles = size.items[which]
                alike = similarity(s[a:a + n], shingles)
                if alike >= self.least and alike > best.get(item, (0,))[0]:
                    best[item] = alike, int(place[a]), int(place[a + n + run - 2]) + 1
        return [(item, *found) for item, found in sorted(best.items())]


def item_blocks(benchmark: DataFrame, most: int = ITEM_WORDS) -> Iterator[list[tuple[int, str | None]]]:
    """The benchmark's items (id, text) in blocks of about `most` words at most. Rows without an id are left out."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").filter("item_id is not null and text is not null").distinct()
    total = items.agg(F.sum(F.size(F.split("text", r"\s+")))).first()[0] or 0
    blocks = max(1, -(-total // most))
    for block in range(blocks):
        rows = items.filter(F.pmod(F.xxhash64("item_id", F.lit(SEED)), F.lit(blocks)) == block).collect()
        yield sorted((r.item_id, r.text) for r in rows)


def hits(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """(id, item_id, similarity, start_word, end_word): the best window of every benchmark item in every document that holds
    it with at least the similarity. Words are `[^\\x20\\x09-\\x0D]+`; A-Z and punctuation at their ends are not compared.

    Null and wordless texts and items hit nothing. Documents of a null or repeated id are judged by row; of items with one
    id the best counts.
    """

    def one(index: Index) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = BareHashes()
            for part in slices(batches):
                rows = [(d, *hit) for d, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist()) for hit in index.hits(t, known)]
                if rows:
                    kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64())
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                                     ["id", "item_id", "similarity", "start_word", "end_word"])

        return given.mapInArrow(run, "id long, item_id long, similarity double, start_word long, end_word long")

    given = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    found = None
    for items in item_blocks(benchmark):
        part = one(Index(items, **settings))
        found = part if found is None else found.unionByName(part)
    return found.withColumnRenamed("id", id_col)


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **settings) -> DataFrame:
    """The documents that hold no benchmark item, with all their columns."""

    def one(index: Index):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = BareHashes()
            for part in slices(batches):
                yield part.filter(pa.array([not index.hits(t, known) for t in part.column(text_col).to_pylist()], pa.bool_()))

        return run

    schema = docs.schema
    for items in item_blocks(benchmark):
        docs = docs.mapInArrow(one(Index(items, **settings)), schema)
    return docs
