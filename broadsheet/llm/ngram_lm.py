"""Language-model scoring with a weighted backoff automaton.

States are the last word (and the start of a text, and the root without a history). From state h an arc for every word w
that followed h in training goes to state w with weight log10((1 - a) p(w) + a c(h, w) / c(h)); for any other word the
failure arc of h leads to the root with weight log10(1 - a), and the root's arc for w weighs log10 p(w), where
p(w) = (c(w) + 0.5) / (N + 0.5 (V + 1)). The shares a depend on how often h was seen (CLASSES), and are those under which
the training texts are likeliest when each counts without itself (leaving one out). A text is one left-to-right walk that
carries the state and adds up the weights.

The automaton is as large as the corpus, so it is never in one place. Texts are walked in blocks of documents, and every
block receives the arcs that its own texts can take, no others: a block sends the distinct keys of its words and word
pairs with their training counts, packed and cut into shards by key; a shard adds up the counts of a key over all blocks
and answers each block in the order of its keys. Keys are hashes, so shards are even whatever words are common, and a
common pair is one entry a block. Blocks are read from the files once more for the walk.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.features import remainder
from broadsheet.llm.words import WordHashes, mixed, slices, words
from broadsheet.session import stored

BLOCK_ROWS = 2_048
PENDING = 3_000_000  # keys gathered before a block's keys are sent, also in parts
SHARES = (0.0, 0.01, 0.03, 0.08, 0.15, 0.3, 0.5, 0.7, 0.9)
CLASSES = 4  # of a state's count: below 16, 256, 4096, and above
START, STOP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03)
_ONE = np.uint64(1)


# --- keys -----------------------------------------------------------------------------------------------------------

def word_keys(h: np.ndarray) -> np.ndarray:
    return mixed(h + np.uint64(0x5851F42D4C957F2D)) | _ONE


def state_and_pair_keys(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the states before each token, and of the pairs (state's word, token)."""
    before = np.concatenate(([START], h[:-1]))
    states = word_keys(before)
    states[0] &= ~_ONE  # the start is a state but no token
    return states, mixed(mixed(before) * np.uint64(31) + h) & ~_ONE


def tokens_of(text: str | None, known: WordHashes) -> np.ndarray:
    return np.append(known.of(words(text)), STOP)


def pack_keys(keys: np.ndarray, base: int) -> bytes:
    """Ascending keys at or above base as steps of six bytes, or of eight where a step is larger."""
    steps = np.diff(keys, prepend=np.uint64(base))
    wide = bool(len(steps) and steps.max() >= np.uint64(1) << np.uint64(48))
    raw = steps.astype("<u8").view(np.uint8).reshape(-1, 8)
    return bytes([wide]) + (raw if wide else raw[:, :6]).tobytes()


def unpack_keys(packed: bytes, base: int) -> np.ndarray:
    size = 8 if packed[0] else 6
    raw = np.frombuffer(packed, np.uint8, offset=1).reshape(-1, size)
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, :size] = raw
    return np.cumsum(wide.view("<u8").ravel(), dtype=np.uint64) + np.uint64(base)


def pack_counts(counts: np.ndarray) -> bytes:
    """Counts as one byte each, large ones behind them."""
    small = np.minimum(counts, 255).astype(np.uint8)
    return small.tobytes() + counts[small == 255].astype("<u8").tobytes()


def unpack_counts(packed: bytes, n: int) -> np.ndarray:
    counts = np.frombuffer(packed, np.uint8, n).astype(np.int64)
    large = counts == 255
    counts[large] = np.frombuffer(packed, "<u8", offset=n).astype(np.int64)
    return counts


# --- blocks and shards ----------------------------------------------------------------------------------------------

def _sent_keys(shards: int):
    shift = np.uint64(64 - (shards.bit_length() - 1)) if shards > 1 else None

    def send(block: int, keys: list[np.ndarray], weights: list[np.ndarray]) -> pa.RecordBatch:
        every, place = np.unique(np.concatenate(keys), return_inverse=True)
        counts = np.bincount(place, np.concatenate(weights), len(every)).astype(np.int64)
        shard = (every >> shift).astype(np.int64) if shift is not None else np.zeros(len(every), np.int64)
        edges = np.concatenate((np.flatnonzero(np.diff(shard, prepend=-1)), [len(every)]))
        rows = [(int(shard[a]), block, pack_keys(every[a:b], int(shard[a]) << int(shift) if shift is not None else 0), pack_counts(counts[a:b]))
                for a, b in zip(edges[:-1], edges[1:])]
        kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["shard", "block", "keys", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, block, keys, weights, pending = WordHashes(), None, [], [], 0
        for part in slices(batches):
            for mine, held, text in zip(*(c.to_pylist() for c in part.columns)):
                if keys and (mine != block or pending > PENDING):
                    yield send(block, keys, weights)
                    keys, weights, pending = [], [], 0
                block = mine
                h = tokens_of(text, known)
                states, pairs = state_and_pair_keys(h)
                keys += [word_keys(h), states[:1], pairs]
                weights.append(np.full(2 * len(h) + 1, not held, np.float64))
                pending += 2 * len(h) + 1
        if keys:
            yield send(block, keys, weights)

    return run


def _answered(shards: int):
    width = 64 - (shards.bit_length() - 1)

    def run(group: pa.Table) -> pa.Table:
        shard = group["shard"][0].as_py()
        base = shard << width if shards > 1 else 0
        parts: dict[int, list[np.ndarray]] = {}
        keys, counts = [], []
        for block, packed, n in zip(*(group[c].to_pylist() for c in ("block", "keys", "counts"))):
            keys.append(unpack_keys(packed, base))
            counts.append(unpack_counts(n, len(keys[-1])))
            parts.setdefault(block, []).append(keys[-1])
        every, place = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(place, np.concatenate(counts), len(every)).astype(np.int64)
        tokens = total[(every & _ONE == 1) & (total > 0)]
        rows = []
        for block, mine in parts.items():
            wanted = mine[0] if len(mine) == 1 else np.unique(np.concatenate(mine))
            rows.append((block, shard, len(wanted), pack_counts(total[np.searchsorted(every, wanted)]), 0, 0))
        rows[0] = (*rows[0][:4], len(tokens), int(tokens.sum()))
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.int64())
        return pa.table([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["block", "shard", "n", "totals", "vocabulary", "tokens"])

    return run


# --- the walk -------------------------------------------------------------------------------------------------------

def _logs(words: np.ndarray, pairs: np.ndarray, states: np.ndarray, n: int, v: int, doc: np.ndarray, docs: int) -> np.ndarray:
    """Sums of the tokens' log10 weights by document, class of the state and share: docs x (CLASSES * SHARES)."""
    root = (words + 0.5) / (n + 0.5 * (v + 1))
    seen = np.where(states > 0, pairs / np.maximum(states, 1), root)  # a state never seen has the root's arcs
    kind = np.minimum(np.log2(np.maximum(states, 1)) // 4, CLASSES - 1).astype(np.int64)
    cell = doc * CLASSES + kind
    sums = [np.bincount(cell, np.log10((1 - a) * root + a * seen), docs * CLASSES) for a in SHARES]
    return np.stack(sums, axis=1).reshape(docs, -1)


def _walked(n: int, v: int, id_col: str):
    def run(key, texts: pa.Table, answers: pa.Table) -> pa.Table:
        known = WordHashes()
        rows = texts.num_rows
        tokens = [tokens_of(t, known) for t in texts["text"].to_pylist()]
        doc = np.repeat(np.arange(rows), [len(t) for t in tokens])
        both = [state_and_pair_keys(t) for t in tokens]
        word = word_keys(np.concatenate(tokens))
        state, pair = (np.concatenate([b[k] for b in both]) for k in (0, 1))
        del tokens, both
        every, place = np.unique(np.concatenate([word, state, pair]), return_inverse=True)
        order = np.argsort(answers["shard"].to_numpy())
        sizes, packed = answers["n"].to_pylist(), answers["totals"].to_pylist()
        total = np.concatenate([unpack_counts(packed[k], sizes[k]) for k in order])
        if len(total) != len(every):
            raise ValueError("the block's texts have changed between the passes")
        words, states, pairs = total[place].reshape(3, -1)
        held = texts["held_out"].to_numpy()
        root = np.log10((words + 0.5) / (n + 0.5 * (v + 1)))
        logs = _logs(words, pairs, states, n, v, doc, rows)
        own = ~held[doc]  # training tokens, each counted without itself
        left_out = _logs(words[own] - 1, pairs[own] - 1, states[own] - 1, n - 1, v, doc[own], rows).sum(axis=0)
        return pa.table({
            "id": pa.chunked_array([texts["id"], pa.nulls(1, pa.int64())]), "summary": pa.array([False] * rows + [True]),
            "held_out": pa.array([*held.tolist(), None], pa.bool_()),
            "n_tokens": pa.array([*np.bincount(doc, minlength=rows).tolist(), None], pa.int64()),
            "n_known": pa.array([*np.bincount(doc, words > 0, rows).astype(np.int64).tolist(), None], pa.int64()),
            "base_score": pa.array([*np.bincount(doc, root, rows).tolist(), None], pa.float64()),
            "logs": pa.array([*logs, left_out], pa.list_(pa.float64()))})

    return run


def score(docs: DataFrame, block: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document: id, held_out, n_tokens, n_known, train_tokens, base_score and score.

    Documents whose crc32(id as text) mod 5 is 1 are held out; all others, those without an id included, are learnt from.
    `block` names the block of a row, a whole number; it has to be the same whenever the row is read, and rows of one block
    should lie together. Null texts are empty, so each text has its end as a token at least; repeated rows count and stay.
    With no training text at all every score is that of unknown tokens.
    """
    given = docs.select(block.cast("long").alias("block"), F.col(id_col).cast("long").alias("id"),
                        F.coalesce(remainder(id_col) == 1, F.lit(False)).alias("held_out"), F.col(text_col).alias("text"))
    shards = 1 << max(4, (given.count() // BLOCK_ROWS).bit_length())
    sent = given.select("block", "held_out", "text").mapInArrow(_sent_keys(shards), "shard int, block long, keys binary, counts binary")
    answers = stored(sent.groupBy("shard").applyInArrow(_answered(shards), "block long, shard int, n long, totals binary, vocabulary long, tokens long"),
                     "arc-counts")
    v, n = (x or 0 for x in answers.agg(F.sum("vocabulary"), F.sum("tokens")).first())
    walked = stored(given.groupBy("block").cogroup(answers.select("block", "shard", "n", "totals").groupBy("block")).applyInArrow(
        _walked(n, v, id_col), "id long, summary boolean, held_out boolean, n_tokens long, n_known long, base_score double, logs array<double>"),
        "walked")
    sums = dict(walked.filter("summary").select(F.posexplode("logs")).groupBy("pos").agg(F.sum("col")).collect())
    chosen = [max(range(len(SHARES)), key=lambda g: (sums.get(c * len(SHARES) + g, 0.0), -g)) for c in range(CLASSES)]
    total = sum((F.element_at("logs", c * len(SHARES) + g + 1) for c, g in enumerate(chosen)), F.lit(0.0))
    return (walked.filter("not summary")
            .select(F.col("id").alias(id_col), "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score",
                    total.alias("score")))


def score_files(docs: DataFrame, **columns) -> DataFrame:
    """`score` for a table read from files: blocks are runs of BLOCK_ROWS rows of one file."""
    place = F.concat(F.col("_metadata.file_path"), F.lit("#"), F.floor(F.col("_metadata.row_index") / BLOCK_ROWS).cast("string"))
    return score(docs, F.xxhash64(place), **columns)
