"""SimHash groups against brute force, and the edge cases of the docstrings."""

from collections import Counter
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from broadsheet.llm import simhash as sh
from broadsheet.llm.components import components


def plain_fingerprint(text, n):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    tokens = [w for w in __import__("re").split("[\x20\x09-\x0d]+", lowered) if w]
    grams = [" ".join(tokens[k:k + n]) for k in range(max(1, len(tokens) - n + 1))] if tokens else []
    counts = Counter(b for g in grams for b in range(64) if xxhash.xxh64_intdigest(g.encode(), 42) >> b & 1)
    return sum(1 << b for b, c in counts.items() if 2 * c > len(grams))


def plain_groups(rows, radius):
    parent = list(range(len(rows)))

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a, b in combinations(range(len(rows)), 2):
        if (rows[a][1] ^ rows[b][1]).bit_count() <= radius:
            parent[find(a)] = find(b)
    least = {}
    for k, (key, _) in enumerate(rows):
        if key is not None:
            least[find(k)] = min(least.get(find(k), key), key)
    return [(key, f"{fp:016x}", least.get(find(k))) for k, (key, fp) in enumerate(rows)]


def order(rows):
    return sorted(rows, key=repr)


def test_whole_table_equals_brute_force(documents):
    rows = [(r.doc_id, plain_fingerprint(r.text, 3)) for r in documents.collect()]
    got = [tuple(r) for r in sh.near_duplicates(documents).collect()]
    assert order(got) == order(plain_groups(rows, 3)) and any(r[0] != r[2] for r in got)


EDGES = [(5, "One two three four five"), (3, "one two THREE four five"), (9, ""), (8, None), (7, " \t\n\x0b"), (None, "one two three four five"),
         (None, "quite alone here"), (4, "x"), (4, "x"), (6, "É é"), (2, "word " * 30_000), (1, "a b")]


def test_nulls_ties_and_long_texts(spark):
    docs = spark.createDataFrame(EDGES, "doc_id long, text string").withColumn("fp", F.lit("clash")).withColumn("key", F.lit(1))
    want = plain_groups([(k, plain_fingerprint(t, 3)) for k, t in EDGES], 3)
    assert order(tuple(r) for r in sh.near_duplicates(docs).collect()) == order(want)


def test_empty_table(spark):
    df = sh.near_duplicates(spark.createDataFrame([], "doc_id long, text string"))
    assert df.columns == ["doc_id", "fingerprint", "component_id"] and df.count() == 0


@pytest.mark.parametrize("radius, piece", [(3, 8), (7, 1024)])
def test_large_shards_are_dealt_and_lose_no_link(spark, radius, piece):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 12, dtype=np.uint64)
    values = {int(b) for b in base}
    for b in base:
        for _ in range(25):
            v = int(b)
            for bit in rng.integers(0, 64, rng.integers(1, radius + 4)):
                v ^= 1 << int(bit)
            values.add(v)
    values = sorted(values)
    signed = [int(np.uint64(v).astype(np.int64)) for v in values]
    found = components(sh.links(spark.createDataFrame([(v,) for v in signed], "fp long"), radius, piece))
    root = {r.node: r.root for r in found.collect()}
    got = {}
    for v in signed:
        got.setdefault(root.get(v, v), set()).add(v)
    want = {}
    for k, _, least in plain_groups([(k, v) for k, v in enumerate(values)], radius):
        want.setdefault(least, set()).add(signed[k])
    assert order(map(sorted, got.values())) == order(map(sorted, want.values()))


def test_tree_search_is_exact():
    rng = np.random.default_rng(2)
    values = np.unique(rng.integers(0, 2**12, 300, dtype=np.uint64))
    probes = rng.integers(0, 2**12, 200, dtype=np.uint64)
    got = {(v, int(p)) for v, near, _ in sh.bk_search(values, sh.bk_tree(values), probes, 3) for p in near}
    assert got == {(i, j) for i in range(len(values)) for j in range(len(probes)) if np.bitwise_count(values[i] ^ probes[j]) <= 3}


def test_components_of_chains_and_stars(spark):
    chain = [(k, k + 1) for k in range(40)] + [(100, 200 + k) for k in range(50)] + [(7, 7), (None, 3), (300, 299)]
    got = {r.node: r.root for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    want = {k: 0 for k in range(1, 41)} | {200 + k: 100 for k in range(50)} | {300: 299}
    assert got == want
