"""Language identification with hyperdimensional profiles.

Every letter owns a random vector of DIM signs, the same in every run. The vector of an n-gram binds those of its letters:
each is rotated by its distance from the gram's end and all are multiplied, so the order of the letters counts. A text bundles
(adds) the vectors of all its grams. A language's prototype is the bundle of all its training texts, of which the part that
all prototypes share (their mean direction) is taken out, from prototypes and texts alike. A text belongs to the language
whose prototype has the greatest cosine with it.

Letters are lower-cased; a run of anything else counts as one blank, and a text begins and ends with one. Learning reads all
training texts whole: tasks bundle by language, and Spark adds the bundles up by (language, component), so the driver only
receives one vector a language. Texts are never shuffled.

Defined cases: a null text, or one without a letter, is `und` with score 0 and teaches nothing; a null language teaches
nothing; a null id is not held out and does not teach; equal cosines take the least language; without any training text all
are `und`; repeated rows stay. Other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.words import slices

DIM = 1024
GRAM = 3
SEED = 42
UNKNOWN = "und"
MAX_LANGUAGES = 4096  # what is broadcast: a vector a language, 16 MB at most
WINDOW = 1 << 20  # code points read at once
BLOCK = 64  # texts bundled at once
CACHE = 16_384  # vectors of grams held at once
BLANK = np.uint64(0x20)
WIDTH = np.uint64(21)  # bits of a code point


@cache
def _letters() -> np.ndarray:
    """Whether a code point is a letter."""
    return np.frombuffer(bytes(chr(k).isalpha() for k in range(0x110000)), np.bool_)


def _codes(text: str) -> np.ndarray:
    """Lower-cased letters as code points, everything else as a blank."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(_letters()[codes], codes, np.uint32(BLANK)).astype(np.uint64)


def grams(text: str | None, size: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """The distinct grams of a whole text (code points packed into 64 bits) and how often each occurs; none without a letter."""
    keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    tail = np.array([BLANK], np.uint64)
    text = text or ""
    lettered = False
    for at in range(0, len(text) + 1, WINDOW):
        last = at + WINDOW > len(text)
        codes = np.concatenate([tail, _codes(text[at:at + WINDOW]), np.full(int(last), BLANK, np.uint64)])
        lettered = lettered or bool((codes != BLANK).any())
        codes = codes[np.concatenate([[True], (codes[1:] != BLANK) | (codes[:-1] != BLANK)])]  # one blank for a run
        if len(codes) >= size:
            packed = codes[:len(codes) - size + 1]
            for k in range(1, size):
                packed = (packed << WIDTH) | codes[k:len(codes) - size + 1 + k]
            new, n = np.unique(packed, return_counts=True)
            keys, counts = (new, n) if not len(keys) else added((keys, counts), (new, n))
        tail = codes[-(size - 1):]
    return (keys, counts) if lettered else (np.zeros(0, np.uint64), np.zeros(0, np.int64))


def added(*parts: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Counts of several texts as those of one."""
    keys, place = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(place, np.concatenate([n for _, n in parts]), len(keys)).astype(np.int64)


class GramVectors:
    """Vectors of grams, made when first asked for; forgets all of them when CACHE are held."""

    def __init__(self, dim: int = DIM, size: int = GRAM):
        self.dim, self.size = dim, size
        self.letters: dict[int, np.ndarray] = {}
        self.rows: dict[int, int] = {}
        self.matrix = np.zeros((256, dim), np.int8)

    def letter(self, code: int) -> np.ndarray:
        if code not in self.letters:
            if len(self.letters) >= CACHE:
                self.letters.clear()
            self.letters[code] = np.random.default_rng([SEED, code]).integers(0, 2, self.dim, np.int8) * np.int8(2) - np.int8(1)
        return self.letters[code]

    def bound(self, key: int) -> np.ndarray:
        vector = np.ones(self.dim, np.int8)
        for k in range(self.size):  # the last letter is not rotated
            vector = vector * np.roll(self.letter(key >> int(WIDTH) * k & (1 << int(WIDTH)) - 1), k)
        return vector

    def of(self, keys: np.ndarray) -> np.ndarray:
        """One row for each of at most CACHE keys."""
        if len(self.rows) + len(keys) > CACHE:
            self.rows = {}
        places = np.empty(len(keys), np.int64)
        for k, key in enumerate(keys.tolist()):
            row = self.rows.get(key)
            if row is None:
                row = self.rows[key] = len(self.rows)
                if row >= len(self.matrix):
                    self.matrix = np.concatenate([self.matrix, np.zeros_like(self.matrix)])
                self.matrix[row] = self.bound(key)
            places[k] = row
        return self.matrix[places]

    def bundles(self, texts: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """The bundle of each text, all counts against the vectors of their common grams, block by block; sums are of whole
        numbers and exact."""
        out = np.zeros((len(texts), self.dim))
        kind = np.float32 if all(n.sum() < 1 << 24 for _, n in texts) else np.float64
        keys = np.unique(np.concatenate([k for k, _ in texts])) if texts else np.zeros(0, np.uint64)
        for at in range(0, len(keys), CACHE // 4):
            some = keys[at:at + CACHE // 4]
            counts = np.zeros((len(texts), len(some)), kind)
            for row, (own, n) in enumerate(texts):
                a, b = np.searchsorted(own, [some[0], some[-1] + np.uint64(1)])
                counts[row, np.searchsorted(some, own[a:b])] = n[a:b]
            out += counts @ self.of(some).astype(kind)
        return out


def unit(vectors: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(vectors, axis=-1, keepdims=True)
    return vectors / np.where(length > 0, length, 1)


@dataclass
class Profiles:
    """Languages in ascending order, the unit prototypes, and the unit direction they share (zeros for one language)."""

    languages: list[str]
    prototypes: np.ndarray
    shared: np.ndarray

    @classmethod
    def of(cls, languages: list[str], bundles: np.ndarray) -> Profiles:
        units = unit(bundles)
        shared = unit(units.sum(0)) if len(languages) > 1 else np.zeros(units.shape[-1])
        return cls(languages, cls._apart(units, shared), shared)

    @staticmethod
    def _apart(units: np.ndarray, shared: np.ndarray) -> np.ndarray:
        return unit(units - np.outer(units @ shared, shared))

    def cosines(self, bundles: np.ndarray) -> np.ndarray:
        return self._apart(unit(bundles), self.shared) @ self.prototypes.T


def remainder(id_col: str) -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", dim: int = DIM, size: int = GRAM) -> Profiles:
    """Prototypes of the languages of all documents whose crc32(id as text) mod 5 is not 0. More than MAX_LANGUAGES
    languages are an error, for then the prototypes are no small table any more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, held = GramVectors(dim, size), {}

        def bundled() -> Iterator[pa.RecordBatch]:
            for lang, counts in sorted(held.items()):
                yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([np.rint(vectors.bundles([counts])[0]).astype(np.int64)], pa.list_(pa.int64()))],
                                                 ["lang", "bundle"])
            held.clear()

        for part in slices(batches):
            new: dict[str, list] = {}
            for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                found = grams(text, size)
                if len(found[0]):
                    new.setdefault(lang, [held[lang]] if lang in held else []).append(found)
            held.update((lang, added(*found)) for lang, found in new.items())
            if sum(len(k) for k, _ in held.values()) > 1 << 20:
                yield from bundled()
        yield from bundled()

    known = docs.filter((remainder(id_col) != 0) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    parts = known.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")).mapInArrow(run, "lang string, bundle array<bigint>")
    sums = parts.select("lang", F.posexplode("bundle").alias("at", "value")).groupBy("lang", "at").agg(F.sum("value").alias("value"))
    rows = (sums.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("at", "value"))).alias("bundle"))
            .select("lang", "bundle.value").limit(MAX_LANGUAGES + 1).collect())
    if len(rows) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    rows.sort(key=lambda r: r.lang.encode())
    return Profiles.of([r.lang for r in rows], np.array([r.value for r in rows], np.float64).reshape(len(rows), dim))


def predict(docs: DataFrame, profiles: Profiles, id_col: str = "doc_id", text_col: str = "text", size: int = GRAM) -> DataFrame:
    """(id, held_out, lang_pred, score) of every document; only the text is an input. `score` is the cosine with the
    language's prototype, 0 where it is negative."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(profiles)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        vectors = GramVectors(known.prototypes.shape[-1], size)
        for part in slices(batches, BLOCK):
            found = [grams(t, size) for t in part.column(2).to_pylist()]
            names, scores = [UNKNOWN] * len(found), np.zeros(len(found))
            lettered = [k for k, (keys, _) in enumerate(found) if len(keys)]
            if lettered and known.languages:
                cosines = known.cosines(vectors.bundles([found[k] for k in lettered]))
                best = cosines.argmax(1)
                scores[lettered] = np.clip(cosines[np.arange(len(best)), best], 0, 1)
                for k, b in zip(lettered, best.tolist()):
                    names[k] = known.languages[b]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(names, pa.string()), pa.array(scores)],
                                             ["id", "held_out", "lang_pred", "score"])

    held = F.coalesce(remainder(id_col) == 0, F.lit(False))
    return (docs.select(F.col(id_col).cast("long").alias("id"), held.alias("held_out"), F.col(text_col).alias("text"))
            .mapInArrow(run, "id long, held_out boolean, lang_pred string, score double").withColumnRenamed("id", id_col))
