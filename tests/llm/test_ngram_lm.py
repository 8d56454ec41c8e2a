"""The language model against a plain one that holds all counts in dictionaries."""

import math
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from broadsheet.llm import ngram_lm as lm
from tests.llm.edges import documents as edge_documents


def plain(docs):
    """{(id, text): (held_out, n_tokens, n_known, base, score)} and the training tokens, by the definitions."""
    toks = [(d, t, (t or "").encode().lower().split() + [None]) for d, t in docs]
    held = [d is not None and zlib.crc32(str(d).encode()) % 5 == 1 for d, _, _ in toks]
    words, pairs, starts = Counter(), Counter(), 0
    for (_, _, ws), h in zip(toks, held):
        if not h:
            words.update(ws)
            starts += 1
            pairs.update(zip(["start", *ws], ws))
    n, v = sum(words.values()), len(words)
    state = lambda w: starts if w == "start" else words[w]

    def logs(ws, less):
        out = np.zeros((lm.CLASSES, len(lm.SHARES)))
        for before, w in zip(["start", *ws], ws):
            root = (words[w] - less + 0.5) / (n - less + 0.5 * (v + 1))
            seen = state(before) - less
            kind = min(int(math.log2(max(seen, 1)) // 4), lm.CLASSES - 1)
            ml = (pairs[before, w] - less) / seen if seen > 0 else root
            out[kind] += [math.log10((1 - a) * root + a * ml) for a in lm.SHARES]
        return out

    left_out = sum((logs(ws, 1) for (_, _, ws), h in zip(toks, held) if not h), np.zeros((lm.CLASSES, len(lm.SHARES))))
    best = left_out.argmax(axis=1)
    result = {}
    for (d, t, ws), h in zip(toks, held):
        base = sum(math.log10((words[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws)
        result[d, t] = (h, len(ws), sum(words[w] > 0 for w in ws), base, logs(ws, 0)[range(lm.CLASSES), best].sum())
    return result, n


def compare(df, docs):
    want, n = plain(docs)
    rows = df.collect()
    assert len(rows) == len(docs)
    by_id = {}
    for (d, _), x in want.items():
        by_id.setdefault(d, []).append(x)
    for r in rows:
        assert r.train_tokens == n
        assert any((r.held_out, r.n_tokens, r.n_known) == x[:3] and abs(r.base_score - x[3]) < 1e-6 * abs(x[3]) and abs(r.score - x[4]) < 1e-6 * abs(x[4])
                   for x in by_id[r.doc_id])


def test_whole_table(spark, documents):
    docs = [(r.doc_id, r.text) for r in documents.collect()]
    compare(lm.score_files(documents), docs)
    compare(lm.score(documents, F.col("doc_id") % 5), docs)


def test_edges(spark):
    docs = edge_documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    compare(lm.score(docs, F.pmod(F.xxhash64("text"), F.lit(3))), rows)
    assert lm.score(docs.filter("false"), F.lit(0)).count() == 0


def test_nothing_to_learn_from(spark):
    held = next(k for k in range(100) if zlib.crc32(str(k).encode()) % 5 == 1)
    r = lm.score(spark.createDataFrame([(held, "a b")], "doc_id long, text string"), F.lit(0)).collect()[0]
    assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score) == (3, 0, 0, 0.0)


def test_arcs_of_a_state_add_up_to_one(spark, documents):
    """Over all words and the unknown one the automaton's weights are probabilities."""
    rows = [(r.doc_id, r.text) for r in documents.limit(30).collect()]
    words, pairs = Counter(), Counter()
    for _, t in rows:
        ws = (t or "").encode().lower().split() + [None]
        words.update(ws)
        pairs.update(zip(ws, ws[1:]))
    n, v, state = sum(words.values()), len(words), words.most_common(1)[0][0]
    for share in lm.SHARES:
        total = (1 - share) * 0.5 / (n + 0.5 * (v + 1))
        total += sum((1 - share) * (c + 0.5) / (n + 0.5 * (v + 1)) + share * pairs[state, w] / words[state] for w, c in words.items())
        assert abs(total - 1) < 1e-9


def test_packed_keys_and_counts():
    rng = np.random.default_rng(8)
    for n in (0, 1, 5, 10_000):
        keys = np.unique(rng.integers(0, 2**64 - 1, n, dtype=np.uint64))
        assert (lm.unpack_keys(lm.pack_keys(keys, 0), 0) == keys).all()
        counts = rng.integers(0, 600, n)
        assert (lm.unpack_counts(lm.pack_counts(counts), n) == counts).all()
