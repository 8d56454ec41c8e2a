"""Groups of near copies against brute force over all pairs."""

from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from broadsheet.llm import near_copies as nc
from tests.llm.edges import documents as edge_documents


def plain_groups(docs):
    """A place for each document, the same within a group: equal words, or 5-word shingles alike in 0.8 or more."""
    tokens = [(d, (t or "").encode().lower().split()) for d, t in docs]
    sets = [{tuple(ws[k:k + 5]) for k in range(max(1, len(ws) - 4))} if ws else set() for _, ws in tokens]
    parent = list(range(len(docs)))

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a, b in combinations(range(len(docs)), 2):
        same = tokens[a][1] == tokens[b][1]
        if same or len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
            parent[find(a)] = find(b)
    return [find(k) for k in range(len(docs))]


def grouped(labels):
    out = {}
    for k, label in enumerate(labels):
        out.setdefault(label, set()).add(k)
    return sorted(map(sorted, out.values()))


def copies(seed=11, bases=6, each=25):
    rng = np.random.default_rng(seed)
    word = lambda: f"w{rng.integers(0, 10**6)}"
    docs = []
    for _ in range(bases):
        base = [word() for _ in range(int(rng.integers(60, 200)))]
        for _ in range(each):
            text = list(base)
            for at in rng.integers(0, len(text), int(rng.integers(0, 5))):
                text[at] = word()
            docs.append((len(docs), " ".join(text)))
    return docs


@pytest.mark.parametrize("nearest, piece", [(1, 1024), (2, 16)])
def test_large_groups_equal_brute_force(spark, nearest, piece):
    docs = copies()
    got = {r.id: r.comp for r in nc.groups(spark.createDataFrame(docs, "doc_id long, text string"), nearest=nearest, piece=piece).collect()}
    assert grouped([got[k] for k, _ in docs]) == grouped(plain_groups(docs))


def test_whole_table_keeps_one_of_each(spark, documents):
    docs = [(r.doc_id, r.text) for r in documents.collect()]
    want = {min(docs[k][0] for k in g) for g in grouped(plain_groups(docs))}
    kept = nc.one_of_each(documents)
    assert kept.columns == documents.columns and sorted(r.doc_id for r in kept.collect()) == sorted(want) and len(want) < len(docs)


def test_edges(spark):
    docs = edge_documents(spark)
    rows = nc.one_of_each(docs).select("doc_id", "text").collect()
    # copies: the texts of 3 and 5, of 7, 8 and 9, of the two rows 4, and of 1, the rows 12 and one row without an id
    assert sorted(((r.doc_id is None, r.doc_id) for r in rows), key=repr) == sorted(
        [(False, k) for k in (3, 7, 4, 6, 2, 1, 11, -3, 10**15)] + [(True, None)], key=repr)
    assert len([r for r in rows if r.doc_id is None]) == 1 and nc.one_of_each(docs).columns == docs.columns
    assert nc.one_of_each(docs.filter("false")).count() == 0
    assert nc.one_of_each(docs.withColumn("text", F.lit(None).cast("string"))).count() == 1
