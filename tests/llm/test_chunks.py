"""Repeated passages: found after insertions, silent on clean texts."""

import numpy as np

from broadsheet.llm import chunks as ch
from tests.llm.edges import documents, order


def test_every_shared_passage_is_found_and_clean_texts_are_left_alone(spark):
    rng = np.random.default_rng(5)
    word = lambda n: [f"t{x}" for x in rng.integers(0, 10**9, n)]
    passages = [word(int(rng.integers(51, 130))) for _ in range(30)]
    docs, holders = [], {}
    for k in range(150):
        body = word(int(rng.integers(0, 200)))
        if k % 2:
            p = int(rng.integers(0, 30))
            at = int(rng.integers(0, len(body) + 1))
            body[at:at] = passages[p]
            holders.setdefault(p, []).append((k, at, at + len(passages[p])))
        docs.append((k, " ".join(body)))
    got = {}
    for r in ch.repeated_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect():
        got.setdefault(r.doc_id, []).append(r)
    later = {k: (a, b, [w[0] for w in where]) for where in holders.values() for k, a, b in where[1:]}
    assert got.keys() == later.keys()
    for k, rows in got.items():
        a, b, who = later[k]
        assert len(rows) == 1 and a <= rows[0].start_word and rows[0].end_word <= b
        assert rows[0].first_docs[0] == who[0] and set(rows[0].first_docs) <= set(who)
        assert rows[0].n_words >= b - a - 2 * ch.SPAN


def test_boundaries_depend_on_the_neighbourhood_only():
    rng = np.random.default_rng(6)
    h = rng.integers(0, 2**63, 2000, dtype=np.uint64)
    cuts = ch.boundaries(h)
    assert np.diff(cuts).max() <= ch.SPAN + ch.GEAR_WORDS
    moved = ch.boundaries(np.concatenate([h[:500], rng.integers(0, 2**63, 37, dtype=np.uint64), h[500:]]))
    same = set(cuts.tolist()) & set(range(540, 2001))
    assert {c + 37 for c in same} == {c for c in moved.tolist() if c >= 577}
    plain = {0}
    rolled = ch.gear(h)[ch.GEAR_WORDS - 1:]
    keyed = [(int(v) >> 24, -k) for k, v in enumerate(rolled)]
    for a in range(len(keyed) - ch.SPAN + 1):
        plain.add(min(range(a, a + ch.SPAN), key=lambda k: keyed[k]) + ch.GEAR_WORDS - 1)
    assert set(cuts.tolist()) == plain


def test_edges(spark):
    got = ch.repeated_passages(documents(spark)).collect()
    assert {r.doc_id for r in got} == {11, 12} and all(1 in r.first_docs for r in got if r.doc_id == 11)
    assert ch.repeated_passages(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    docs = documents(spark)
    assert order(ch.repeated_passages(docs).collect()) == order(ch.repeated_passages(docs.repartition(5)).collect())


def test_passages_of_exactly_fifty_words_are_found(spark):
    rng = np.random.default_rng(8)
    word = lambda n: [f"t{x}" for x in rng.integers(0, 10**9, n)]
    docs = []
    for k in range(1000):
        passage = word(50 + k % 2)
        docs += [(2 * k + d, " ".join(word(30) + passage + word(30))) for d in (0, 1)]
    rows = ch.repeated_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sorted(r.doc_id for r in rows) == list(range(1, 2000, 2)) and min(r.n_words for r in rows) < 26
