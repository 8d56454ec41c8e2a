"""The mix: targets against plain resharing, draws against a plain prefix sum, edges."""

import hashlib
import math

import pytest

from broadsheet.llm import mixing as mx
from tests.llm.edges import documents as edge_documents
from tests.llm.edges import order


def plain_targets(sizes, ratio=(3, 1, 2), share=1.5, most=2.0):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: ratio[k % len(ratio)] for k, s in enumerate(names)}
    full, left = {}, share * sum(sizes.values())
    while True:
        open_ = [s for s in names if s not in full]
        total = sum(weight[s] for s in open_)
        target = {s: left * weight[s] / total for s in open_}
        over = [s for s in open_ if target[s] > most * sizes[s]]
        if not over:
            return full | target
        for s in over:
            full[s] = most * sizes[s]
            left -= full[s]
        if len(full) == len(names):
            return full


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 10, "c": 5, None: 50}, {"a": 1, "é": 1000, "z": 1}, {"x": 0, "y": 0}, {"q": 7},
                                   {f"s{k}": (k * 37) % 91 for k in range(25)}])
def test_targets(spark, sizes):
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mx.targets(frame).collect()}
    want = plain_targets(sizes)
    assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 for s in want)


def test_draws_follow_the_keys(spark, documents):
    weights = documents.selectExpr("doc_id", "1.0 + doc_id % 3 AS weight")
    rows = mx.drawn(documents, weights).collect()
    by_source = {}
    for r in rows:
        by_source.setdefault(r.source, []).append(r)
    for group in by_source.values():
        size, target = group[0].source_size, group[0].target
        assert size == sum(r["size"] for r in group)
        epochs, seen = int(target // size), 0
        key = {r.doc_id: -math.log((int(hashlib.md5(str(r.doc_id).encode()).hexdigest()[:13], 16) + 1) / 16**13) / (1 + r.doc_id % 3) for r in group}
        for r in sorted(group, key=lambda r: key[r.doc_id]):
            extra = r["size"] > 0 and seen + r["size"] / 2 < target - epochs * size
            assert r.taken == (epochs + extra) * r["size"] and r.taken <= 2 * r["size"]
            seen += r["size"]
        assert abs(sum(r.taken for r in group) - target) <= max(r["size"] for r in group) / 2
    assert order(rows) == order(mx.drawn(documents.repartition(7), weights).collect())


def test_mixed_rows_are_the_drawn_ones(spark, documents):
    want = {r.doc_id: r.copies for r in mx.drawn(documents).collect() if r.copies}
    mixed = mx.mix(documents)
    assert mixed.columns == documents.columns
    assert {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()} == want


def test_edges(spark):
    docs = edge_documents(spark)
    rows = mx.drawn(docs).collect()
    assert len(rows) == docs.count() and all(r.taken == r.copies * r["size"] <= 2 * r["size"] for r in rows)
    assert {r["size"] for r in rows if r.doc_id in (7, 8, 9)} == {0}
    assert mx.mix(docs).columns == docs.columns
    empty = spark.createDataFrame([], docs.schema)
    assert mx.drawn(empty).count() == 0 and mx.mix(empty).count() == 0
    blank = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert [(r.target, r.taken) for r in mx.drawn(blank).collect()] == [(0.0, 0), (0.0, 0)]
