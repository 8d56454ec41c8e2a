"""Spelling variants against plain edits, blocks against plain distances, and rows that need care."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from broadsheet.llm import registered
from broadsheet.llm import spelling as sp

from tests.llm import edges


def plain_words(rows):
    n = Counter()
    for doc_id, text in rows:
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", lower):
            h = zlib.crc32(f"{' ' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            if len(run) >= 7:
                n[run] += 1
    return {w: k for w, k in n.items() if k >= 2}


def plain_variants(words):
    near = {w: set() for w in words}
    masks = {}
    for w in words:
        for k in range(len(w)):
            less = w[:k] + w[k + 1:]
            masks.setdefault((w[:k], w[k + 1:]), []).append(w)
            if less in words:
                near[w].add(less)
                near[less].add(w)
    for group in masks.values():
        for w in group:
            near[w].update(v for v in group if v != w)
    form = {}
    for w in words:
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 10 * words[w] else None
    out = {}
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None)
    return out


def result(df):
    rows = df.select("word", "form", "root", "n", "n_near", "form_n").collect()
    out = {r.word: tuple(r) for r in rows}
    assert len(out) == len(rows)
    return out


def test_whole_table_equals_plain_edits(spark, small, documents):
    words = plain_words([tuple(r) for r in documents.select("doc_id", "text").collect()])
    assert len(words) > 500
    assert result(registered.QUERIES["op13_spelling_variants"](spark, small)) == plain_variants(words)


def made_words(seed, count, letters, most):
    rng = random.Random(seed)
    words = {}
    while len(words) < count:
        w = "".join(rng.choice(letters) for _ in range(rng.randint(1, most)))
        words[w] = rng.choice([2, 3, 25, 300, 4000])
    return words


@pytest.mark.parametrize("tile, block, letters, most", [(1024, 1 << 22, "ab", 11), (4, 1 << 22, "ab", 9), (3, 64, "abé", 7), (1024, 200, "aß", 24)])
def test_words_close_together_in_any_tiling(spark, monkeypatch, tile, block, letters, most):
    monkeypatch.setattr(sp, "TILE", tile)
    monkeypatch.setattr(sp, "BLOCK_BYTES", block)
    words = made_words(tile, 350, letters, most)
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    assert result(sp.variants(frame)) == plain_variants(words)


def test_chains_lead_to_the_last_form(spark):
    words = {"a" * k: 10 ** (18 - k) for k in range(1, 18)}
    got = result(sp.variants(spark.createDataFrame(list(words.items()), "word string, n long")))
    assert got == plain_variants(words)
    assert {r[2] for r in got.values()} == {"a"}


def test_blocks_of_very_long_words(spark):
    long = "lorem" * 40_000
    words = {long: 50, long + "x": 5, "y" + long: 3, long[:99_999] + "Z" + long[100_000:]: 2, long[::-1]: 7}
    got = result(sp.variants(spark.createDataFrame(list(words.items()), "word string, n long")))
    assert {w: (r[1], r[4]) for w, r in got.items()} == {
        long: (None, 3), long + "x": (long, 1), "y" + long: (long, 1), long[:99_999] + "Z" + long[100_000:]: (long, 1), long[::-1]: (None, 0)}


def test_prefix_and_suffix_of_pairs():
    words = ["aabaa", "aabaaa", "abaaa", "aabba", "bbbbb"]
    block = sp.Block(words, 5)
    i, j = np.array([0, 0, 0, 0]), np.array([1, 2, 3, 4])
    prefix, suffix = block.common(i, j)
    assert prefix.tolist() == [5, 1, 3, 0] and suffix.tolist() == [2, 2, 1, 0]


def test_rows_that_need_care(spark):
    docs = edges.documents(spark)
    want = plain_variants(plain_words(edges.ROWS))
    assert result(sp.variants(sp.counted(docs, errors=True))) == want
    assert sp.variants(sp.counted(docs.filter("false"), errors=True)).count() == 0
    assert {"wizards", "quietly"} <= set(want)


def test_windows_of_long_texts(monkeypatch):
    text = "Überall GROSSE wörterbücher × und÷so weiter " * 30
    whole = sp.runs(text)
    monkeypatch.setattr(sp, "WINDOW", 10)
    assert sp.runs(text) == whole == Counter(re.findall("[A-Za-zÀ-ÿ]+", sp.lowered(text)))
