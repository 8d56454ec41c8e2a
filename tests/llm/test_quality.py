"""Quality rules and the neighbours' vote: counts against a plain version, held-out accuracy, edges."""

import re
from collections import Counter

import numpy as np
import pytest

from broadsheet.llm import features as ft
from broadsheet.llm import quality_neighbours as qn
from broadsheet.llm import quality_rules as qr
from tests.llm.edges import documents as edge_documents

MIDDLE = "/root/testdata/sf0.01"


def plain_counts(text):
    tokens = re.findall("[^\x20\x09-\x0d]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    windows = Counter(tuple(tokens[k:k + 3]) for k in range(len(tokens) - 2))
    marked = {j for k in range(len(tokens) - 2) if windows[tuple(tokens[k:k + 3])] > 1 for j in range(k, k + 3)}
    return (len(tokens), sum(map(len, tokens)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(marked))


@pytest.fixture(scope="module")
def middle(spark):
    return spark.read.parquet(f"{MIDDLE}/documents.parquet"), spark.read.parquet(f"{MIDDLE}/labels.parquet")


def test_counts_and_verdicts(spark, middle):
    docs, labels = middle
    model = qr.train(docs, labels)
    rows = qr.judge(docs, model, keep=("text",)).collect()
    assert len(rows) == docs.count()
    for r in rows:
        n, chars, symbols, dup, repeated = plain_counts(r.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, dup, repeated)
        assert r.base_failed == (n < 50 or 100 * repeated > 50 * n) and 0 <= r.quality <= 1
        assert r.kept == (not r.base_failed and r.quality >= qr.THRESHOLD)
    assert {r.doc_id for r in qr.kept(docs, model).collect()} == {r.doc_id for r in rows if r.kept}


def test_regression_on_labels_it_has_not_seen(spark, middle):
    docs, labels = middle
    model = qr.train(docs, labels.filter("doc_id % 3 <> 0"))
    rows = qr.judge(docs, model).join(labels.selectExpr("doc_id", "quality AS label").filter("doc_id % 3 = 0 AND label IS NOT NULL"), "doc_id").collect()
    good, bad = [r for r in rows if r.label == 1], [r for r in rows if r.label == 0]
    assert np.mean([r.quality >= 0.5 for r in good]) > 0.95 and np.mean([r.quality < 0.5 for r in bad]) > 0.6


def test_neighbours_on_held_out_labels(spark, middle):
    docs, labels = middle
    got = qn.classify(docs, qn.train(docs, labels))
    assert got.columns == ["doc_id", "held_out", "score", "predicted"] and got.count() == docs.count()
    rows = got.join(labels, "doc_id").filter("held_out AND quality IS NOT NULL").collect()
    assert np.mean([r.predicted == r.quality for r in rows]) > np.mean([r.quality for r in rows]) + 0.05
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)


def test_votes_are_exact():
    rng = np.random.default_rng(9)
    space = qn.Space(np.ones(qn.BUCKETS, np.float32), rng.standard_normal((qn.BUCKETS, 16)).astype(np.float32),
                     qn.unit(rng.standard_normal((200, 16)).astype(np.float32)), rng.integers(0, 2, 200).astype(np.float32), 0.5)
    rows = [ft.counted(rng.integers(0, qn.BUCKETS, 40).astype(np.uint64)) for _ in range(20)] + [ft.counted(np.zeros(0, np.uint64))]
    got = space.votes(rows)
    for row, score in zip(rows[:-1], got):
        v = np.zeros(qn.BUCKETS)
        v[row[0]] = np.log1p(row[1])
        p = v @ space.axes
        sims = space.points @ (p / np.linalg.norm(p))
        near = np.argsort(-sims)[:qn.NEAREST]
        w = np.maximum(sims[near], 0) ** 4
        assert abs(score - (w * space.labels[near]).sum() / w.sum()) < 1e-3
    assert got[-1] == 0.5


def test_edges(spark):
    docs = edge_documents(spark)
    none = spark.createDataFrame([], "doc_id long, quality int")
    odd = spark.createDataFrame([(5, 1), (5, 0), (2, 0), (None, 1), (11, None), (12, 7), (77, 1)], "doc_id long, quality int")
    for labels in (none, odd, odd.filter("quality = 1")):
        assert qr.judge(docs, qr.train(docs, labels)).count() == docs.count()
        rows = qn.classify(docs, qn.train(docs, labels)).collect()
        assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
        assert {r.held_out for r in rows if r.doc_id is None} == {False}
    empty = docs.filter("false")
    assert qr.judge(empty, qr.train(empty, odd)).count() == 0 and qn.classify(empty, qn.train(empty, odd)).count() == 0
    assert qr.kept(docs, qr.train(docs, odd)).columns == docs.columns
    assert {(r.n_words, r.base_failed, r.kept) for r in qr.judge(docs, qr.train(docs, odd)).collect() if r.doc_id in (7, 8, 9)} == {(0, True, False)}
    picked = ft.labelled(odd, "quality", 10).collect()
    assert {(r.id, r.label) for r in picked} == {(5, 1), (2, 0), (77, 1)}
