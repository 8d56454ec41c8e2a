"""Grouping of spelling variants: words that differ by one inserted, deleted or replaced code point, led to the frequent form.

Words are cut into pieces. One edit damages one piece, so two near words agree in everything around some piece of the shorter
one: each word is sent to the keys of its text around each of its pieces, once as the shorter word and once as the longer one
of a pair. Words of one key meet as padded code-point matrices, compared block against block: the common prefix is the
first difference from the left, the common suffix that from the right, and two words are near exactly if prefix and suffix
together reach the longer length minus one. A pair that meets under several keys counts at the first piece that allows it.

Keys hold few words, since a piece is about three letters long; those with more than a tile are dealt into tiles, and every pair of
tiles meets in a task of its own. A tile is bounded in bytes. Tasks return sums by word, never pairs.

Words are Latin letters (one byte each in Latin-1). Documents are counted inside tasks before anything is shuffled.

Defined cases: a null or empty text has no words; a null id reads as one space in the digest that plants errors; repeated rows
count again; very long texts are read in windows and very long words compared whole; an empty table gives no words. Other
columns of the input are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.words import slices
from broadsheet.session import broadcast_if_small, stored

LETTERS = re.compile("[A-Za-zÀ-ÿ]+")
SHORTEST = 7  # code points of a word
LEAST = 2  # occurrences of a word
PLANTED = 31
RATIO = 10  # how much more frequent a form is
PIECE, MOST_PIECES = 3, 16
TILE, TILE_BYTES = 1024, 1 << 20
BLOCK_BYTES = 1 << 22
HELD = 200_000  # distinct words a task holds before it hands them on
WINDOW = 1 << 20
HOPS = 5  # doublings of the way to the root: a form is RATIO times as frequent, so 63 bits hold 19 steps


def planted(doc_id: int | None, run: str) -> str:
    """The run, without one code point where PLANTED divides crc32 of `doc_id:run`."""
    h = zlib.crc32(f"{' ' if doc_id is None else doc_id}:{run}".encode())
    if h % PLANTED:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def lowered(text: str) -> str:
    """A-Z lower-cased, nothing else."""
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def runs(text: str) -> Counter:
    """Maximal runs of letters and how often each occurs; long texts window by window, cut where no run is."""
    if len(text) <= WINDOW:
        return Counter(LETTERS.findall(lowered(text)))
    out: Counter = Counter()
    for found in LETTERS.finditer(lowered(text)):
        out[found.group()] += 1
    return out


def counted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", errors: bool = False) -> DataFrame:
    """(word, n) of all words of at least SHORTEST code points that occur LEAST times or more; `errors` plants misspellings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def batch() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])
            held.clear()
            return made

        for part in slices(batches):
            for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                for word, n in runs(text or "").items():
                    if len(word) >= SHORTEST:
                        if errors:
                            word = planted(doc_id, word)
                            if len(word) < SHORTEST:
                                continue
                        held[word] += n
            if len(held) >= HELD:
                yield batch()
        yield batch()

    parts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST)


# Keys

def pieces(length: int) -> int:
    """Number of pieces of the shorter word of a pair."""
    return min(max(length // PIECE, 3), MOST_PIECES)


def bounds(length: int, piece: int) -> tuple[int, int]:
    count = pieces(length)
    return length * piece // count, length * (piece + 1) // count


def keyed(words: DataFrame) -> DataFrame:
    """(key, length, piece, word, n): a word under the text around each piece, with the shorter word's length and the piece."""

    def keys(shorter: Column) -> Column:
        count = F.least(F.greatest(F.floor(shorter / PIECE), F.lit(3)), F.lit(MOST_PIECES)).cast("int")

        def key(piece: Column) -> Column:
            start, end = F.floor(shorter * piece / count).cast("int"), F.floor(shorter * (piece + 1) / count).cast("int")
            left = F.substr("word", F.lit(1), start)
            right = F.substr("word", F.col("size") - shorter + end + 1, shorter - end)
            return F.struct(F.xxhash64(shorter, piece, left, right).alias("key"), shorter.alias("length"), piece.alias("piece"))

        return F.transform(F.sequence(F.lit(0), count - 1), key)

    sized = words.withColumn("size", F.length("word"))
    return (sized.select("word", "n", F.explode(F.concat(keys(F.col("size")), keys(F.col("size") - 1))).alias("k"))
            .select("k.*", "word", "n"))


def dealt(words: DataFrame) -> DataFrame:
    """Every word under each of its keys, with the tiles in which it meets others: (length, key, piece, low, high, tile, word,
    n). Words of `low` meet those of `high`; where both are one tile, all words meet. Only the keys of more than one tile are
    looked up, so the words are shuffled once, to where they meet."""
    group = ["key", "length", "piece"]
    keys = keyed(words)
    tile = F.greatest(F.least(F.lit(TILE), F.floor(F.lit(TILE_BYTES) / (F.col("length") + 1))), F.lit(1))
    hot = (keys.groupBy(*group).agg(F.count(F.lit(1)).alias("held")).filter(F.col("held") > tile)
           .select(*group, F.ceil(F.col("held") / tile).cast("int").alias("tiles")))
    met = keys.join(broadcast_if_small(stored(hot, "spelling-hot")), group, "left").withColumn("tiles", F.coalesce("tiles", F.lit(1)))
    met = met.withColumn("tile", F.pmod(F.xxhash64("word", F.lit(3)), F.col("tiles")).cast("int"))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    return met.select("length", "key", "piece", F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high"), "tile", "word", "n")


# Blocks of words

class Block:
    """Consecutive words of one shorter length, as code-point matrices padded on the right and on the left."""

    def __init__(self, words: list[str], length: int):
        self.length, self.words = length, words
        self.sizes = np.fromiter(map(len, words), np.int64, len(words))
        width = length + 2  # one column of zeros at least, in which equal rows end
        self.left = np.zeros((len(words), width), np.uint8)
        raw = np.frombuffer("".join(words).encode("latin-1"), np.uint8)
        row = np.repeat(np.arange(len(words)), self.sizes)
        column = np.arange(len(raw)) - np.repeat(np.cumsum(self.sizes) - self.sizes, self.sizes)
        self.left[row, column] = raw
        self.right = np.zeros_like(self.left)
        self.right[row, self.sizes[row] - 1 - column] = raw

    def common(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lengths of the common prefixes and suffixes of the words i and j."""
        least = np.minimum(self.sizes[i], self.sizes[j])
        out = []
        for side in (self.left, self.right):
            differs = side[i] != side[j]
            differs[:, -1] = True
            out.append(np.minimum(differs.argmax(1), least))
        return out[0], out[1]


def near(block: Block, i: np.ndarray, j: np.ndarray, piece: np.ndarray) -> np.ndarray:
    """Places of the pairs that are near and meet here under the first piece that allows it."""
    prefix, suffix = block.common(i, j)
    longer = np.maximum(block.sizes[i], block.sizes[j])
    shorter = np.minimum(block.sizes[i], block.sizes[j])
    ok = np.flatnonzero((shorter == block.length) & (prefix + suffix >= longer - 1))
    prefix, suffix = prefix[ok], suffix[ok]
    first = np.full(len(ok), -1)
    for k in reversed(range(pieces(block.length))):
        start, end = bounds(block.length, k)
        first[(prefix >= start) & (suffix >= block.length - end)] = k
    return ok[first == piece[ok]]


class Found:
    """Sums by word: near words, and the most frequent one of them (ties: the least)."""

    def __init__(self):
        self.held: dict[str, tuple[int, int, str]] = {}

    def add(self, words: list[str], n: list[int], i: np.ndarray, j: np.ndarray) -> None:
        for a, b in zip(np.concatenate([i, j]).tolist(), np.concatenate([j, i]).tolist()):
            count, most, best = self.held.get(words[a], (0, 0, ""))
            if n[b] > most or (n[b] == most and words[b] < best):
                most, best = n[b], words[b]
            self.held[words[a]] = count + 1, most, best

    def batch(self) -> pa.RecordBatch:
        rows = [(w, c, m, b) for w, (c, m, b) in self.held.items()]
        self.held = {}
        columns = list(zip(*rows)) or [(), (), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.string()))],
                                          ["word", "n_near", "most", "best"])


def compared(found: Found, words: list[str], n: list[int], length: int, group: np.ndarray, tile: np.ndarray, cross: np.ndarray, piece: np.ndarray) -> None:
    """All pairs within the groups of consecutive words, each row against those below it, in blocks of bounded bytes."""
    block = Block(words, length)
    _, starts, sizes = np.unique(group, return_index=True, return_counts=True)
    at = np.arange(len(words))
    below = (np.repeat(starts + sizes, sizes) - at - 1) if len(words) else at  # rows of the group that follow
    most = max(BLOCK_BYTES // (length + 2), 1)
    total = np.cumsum(below)
    done = 0
    while done < len(words):
        base = total[done - 1] if done else 0
        end = max(int(np.searchsorted(total, base + most, "right")), done + 1)
        rows = np.repeat(at[done:end], below[done:end])
        first = np.cumsum(below[done:end]) - below[done:end]
        others = rows + 1 + np.arange(len(rows)) - np.repeat(first, below[done:end])
        meet = ~cross[rows] | (tile[rows] != tile[others])
        rows, others = rows[meet], others[meet]
        if len(rows):
            ok = near(block, rows, others, piece[rows])
            found.add(words, n, rows[ok], others[ok])
        done = end


def neighbours(words: DataFrame) -> DataFrame:
    """(word, n_near, best, most) of the words that have a near word; `best` is the most frequent one, ties the least, and
    `most` its occurrences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Found()
        held: list[pa.RecordBatch] = []

        def judge(rows: pa.Table) -> None:
            length = rows.column("length")[0].as_py()
            columns = {c: rows.column(c).to_numpy() for c in ("key", "piece", "low", "high", "tile")}
            change = np.zeros(rows.num_rows, bool)
            for c in ("key", "piece", "low", "high"):
                change[1:] |= columns[c][1:] != columns[c][:-1]
            compared(found, rows.column("word").to_pylist(), rows.column("n").to_pylist(), length, np.cumsum(change),
                     columns["tile"], columns["low"] != columns["high"], columns["piece"])

        # groups are kept whole: a part is judged up to its last change of group, the rest waits for the next part
        for part in slices(batches, 16_384):
            table = pa.Table.from_batches([*held, part] if held else [part])
            ids = np.zeros(table.num_rows, np.int64)
            lengths = table.column("length").to_numpy()
            for c in ("length", "key", "piece", "low", "high"):
                values = table.column(c).to_numpy()
                ids[1:] |= values[1:] != values[:-1]
            starts = np.flatnonzero(ids)
            done = int(starts[-1]) if len(starts) else 0
            cuts = [0, *(k for k in np.flatnonzero(lengths[1:done] != lengths[:max(done - 1, 0)]) + 1), done] if done else []
            for a, b in zip(cuts, cuts[1:]):
                rows = max(BLOCK_BYTES // (int(lengths[a]) + 2), 1)  # blocks of bounded bytes, cut between groups
                while a < b:
                    stops = starts[(starts > a) & (starts <= min(a + rows, b))]
                    more = starts[(starts > a) & (starts <= b)]
                    stop = int(stops[-1]) if len(stops) else int(more[0]) if len(more) else b
                    judge(table.slice(a, stop - a))
                    a = stop
            rest = table.slice(done)
            held = rest.combine_chunks().to_batches()
            if len(found.held) >= HELD:
                yield found.batch()
        if held:
            judge(pa.Table.from_batches(held))
        yield found.batch()

    group = ("length", "key", "piece", "low", "high")
    met = dealt(words).repartition("key", "low", "high").sortWithinPartitions(*group)
    parts = met.select(*group, "tile", "word", "n").mapInArrow(run, "word string, n_near long, most long, best string")
    best = F.min(F.struct((-F.col("most")).alias("less"), F.col("best").alias("best")))
    return (parts.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b"))
            .select("word", "n_near", F.col("b.best").alias("best"), (-F.col("b.less")).alias("most")))


def variants(words: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of (word, n): the form is its most frequent near word, if that is
    RATIO times as frequent; the root is where forms lead."""
    words = stored(words, "spelling-words")
    found = neighbours(words)
    leads = F.col("most") >= RATIO * F.col("n")
    formed = stored(words.join(found, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(leads, F.col("best")).alias("form"),
        F.when(leads, F.col("most")).alias("form_n")), "spelling-forms")
    ways = formed.filter("form is not null").select("word", F.col("form").alias("root"), F.lit(True).alias("goes_on"))
    for _ in range(HOPS):  # every way is doubled, until none goes on
        further = ways.select(F.col("word").alias("root"), F.col("root").alias("next"))
        ways = ways.select("word", "root").join(further, "root", "left")
        ways = stored(ways.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("goes_on")), "spelling-ways")
        if ways.filter("goes_on").isEmpty():
            break
    ways = ways.drop("goes_on")
    return (formed.join(ways, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
