"""Substring deduplication by content-defined chunks.

A gear hash rolls over the words of a document: each step shifts the hash left and adds the word's random number, so it
depends on the last few words only. A chunk ends where the hash is least among SPAN neighbouring words. Boundaries so
depend on the words around them and not on their place: after an insertion the chunks are the same again, and two texts
that share a passage share all chunks inside it. The first boundary that lies in a passage for sure is at most GEAR_WORDS +
SPAN - 2 words behind its beginning, the last at most SPAN words before its end, so any passage of MIN_WORDS words or more
shares a run of chunks of at least MIN_WORDS - 2 * (SPAN - 1) - GEAR_WORDS words; runs of that length are reported.

A chunk is known by its digest. The digests' first holders are found by a sum that is pre-aggregated before the shuffle;
chunks then meet their digest's first holder in an equi join whose hot digests adaptive execution splits. Texts are never
shuffled, and a document's chunks are only put together again for chunks that repeat.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from broadsheet.llm.words import SEED, WordHashes, mixed, slices, words
from broadsheet.session import stored

GEAR_WORDS = 4  # words that a hash depends on
SPAN = 12  # words within which a boundary lies
MIN_WORDS = 50  # passages that are surely found


def gear(h: np.ndarray) -> np.ndarray:
    """The rolling hash after each word: h = (h << 1) + word, cut to the last GEAR_WORDS words."""
    out = h.copy()
    for k in range(1, GEAR_WORDS):
        out[k:] += h[:-k] << np.uint64(k)
    return mixed(out)


def boundaries(h: np.ndarray, span: int = SPAN) -> np.ndarray:
    """Places of the words that begin a chunk, the first word included: those whose rolling hash is the least of some
    window of `span` words (the last of equals). The first words, whose hash is not yet full, begin none."""
    n = len(h)
    if n <= GEAR_WORDS:
        return np.zeros(min(n, 1), np.int64)
    rolled = gear(h)[GEAR_WORDS - 1:]
    # the place in the low bits makes the least unique; later places win among equal hashes
    keyed = (rolled & ~np.uint64((1 << 24) - 1)) | (np.uint64((1 << 24) - 1) - (np.arange(len(rolled), dtype=np.uint64) & np.uint64((1 << 24) - 1)))
    least, reach = keyed, 1
    while reach < span and len(least) > 1:
        step = min(reach, span - reach, len(least) - 1)
        least = np.minimum(least[:-step], least[step:])
        reach += step
    # a window's least is found again by its key
    cuts = np.flatnonzero(np.isin(keyed, np.unique(least))) + GEAR_WORDS - 1
    return np.unique(np.concatenate(([0], cuts)))


def chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, start, n_words, digest) of every chunk of every whole text; none for a null or wordless one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        digest = xxhash.xxh3_64_intdigest
        for part in slices(batches):
            ids, starts, sizes, digests = [], [], [], []
            for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                tokens = words(text)
                if not tokens or doc is None:
                    continue
                edges = [*boundaries(known.of(tokens)).tolist(), len(tokens)]
                ids += [doc] * (len(edges) - 1)
                starts += edges[:-1]
                sizes += [b - a for a, b in zip(edges, edges[1:])]
                digests += [digest(b" ".join(tokens[a:b]), SEED) for a, b in zip(edges, edges[1:])]
            if ids:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(starts, pa.int32()), pa.array(sizes, pa.int32()),
                     pa.array(np.array(digests, np.uint64).view(np.int64))], ["id", "start", "n_words", "digest"])

    return (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
            .mapInArrow(run, "id long, start int, n_words int, digest long"))


def repeated_passages(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each passage of a document that another document with a smaller id holds as well: the id, start_word and
    end_word (the word after the last; words are `[^\\x20\\x09-\\x0D]+`, A-Z in lower case), n_words, and first_docs, the
    first holders of its chunks.

    Every passage that two documents share in at least `min_words` words is found; what is reported has at least
    `min_words` - 2 * (SPAN - 1) - GEAR_WORDS words. Documents of one id count as one document; rows without an id and null, empty or
    wordless texts have no passages.
    """
    pieces = chunks(docs, id_col, text_col)
    holders = pieces.groupBy("digest").agg(F.min("id").alias("first_doc"), F.max("id").alias("last_doc"))
    # written, so that the join below shuffles both sides for itself and hot digests can be split
    shared = stored(holders.filter("first_doc < last_doc").select("digest", "first_doc"), "shared-digests")
    copies = pieces.join(shared, "digest").filter("id > first_doc").select("id", "start", "n_words", "first_doc").distinct()
    order = Window.partitionBy("id").orderBy("start")
    ahead = F.lag(F.col("start") + F.col("n_words")).over(order)
    runs = copies.withColumn("new", (ahead.isNull() | (ahead != F.col("start"))).cast("int")).withColumn("run", F.sum("new").over(order))
    passages = runs.groupBy("id", "run").agg(F.min("start").cast("long").alias("start_word"), F.sum("n_words").alias("n_words"),
                                             F.sort_array(F.collect_set("first_doc")).alias("first_docs"))
    return (passages.filter(F.col("n_words") >= max(1, min_words - 2 * (SPAN - 1) - GEAR_WORDS))
            .select(F.col("id").alias(id_col), "start_word", (F.col("start_word") + F.col("n_words")).alias("end_word"), "n_words", "first_docs"))
