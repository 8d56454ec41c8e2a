"""Language profiles against a plain model, held-out languages, and rows that need care."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from broadsheet.llm import languages as la
from broadsheet.llm import registered

from tests.llm import edges


def plain_grams(text):
    spaced = " " + re.sub(" +", " ", "".join(c if c.isalpha() else " " for c in (text or "").lower())) + " "
    spaced = re.sub(" +", " ", spaced)
    return Counter(spaced[k:k + 3] for k in range(len(spaced) - 2)) if spaced.strip() else Counter()


def plain_bundle(counts, vectors):
    total = np.zeros(vectors.dim)
    for gram, n in counts.items():
        a, b, c = (vectors.letter(ord(x)).astype(float) for x in gram)
        total += n * np.roll(a, 2) * np.roll(b, 1) * c
    return total


def plain_direction(bundle, shared):
    v = bundle / np.linalg.norm(bundle)
    v = v - (v @ shared) * shared
    return v / np.linalg.norm(v)


def unpacked(found):
    return {"".join(chr(int(k) >> s & 0x1FFFFF) for s in (42, 21, 0)): int(n) for k, n in zip(*found)}


@pytest.mark.parametrize("window", [1 << 20, 1, 7])
def test_grams_equal_plain_ones(monkeypatch, window):
    monkeypatch.setattr(la, "WINDOW", window)
    for text in [None, "", " \n1", "a", "Ab  c!déf  ", "x" * 50, "12ab34", "The cat, the CAT; 漢字 the", "\U0001d518 z"]:
        assert unpacked(la.grams(text)) == plain_grams(text), text


def test_whole_table_equals_a_plain_model(spark, small, documents):
    rows = documents.select("doc_id", "text", "lang").collect()
    vectors = la.GramVectors()
    bundles, held = {}, {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in rows}
    own = {r.doc_id: plain_bundle(plain_grams(r.text), vectors) for r in rows}
    for r in rows:
        if r.lang is not None and not held[r.doc_id]:
            bundles[r.lang] = bundles.get(r.lang, 0) + own[r.doc_id]
    names = sorted(bundles)
    units = [bundles[n] / np.linalg.norm(bundles[n]) for n in names]
    shared = sum(units) / np.linalg.norm(sum(units))
    prototypes = np.array([plain_direction(bundles[n], shared) for n in names])
    got = {r.doc_id: r for r in registered.QUERIES["op12_language_id"](spark, small).collect()}
    assert len(got) == len(rows)
    for r in rows:
        found = got[r.doc_id]
        assert found.held_out == held[r.doc_id]
        if own[r.doc_id].any():
            cosines = prototypes @ plain_direction(own[r.doc_id], shared)
            assert found.lang_pred == names[int(cosines.argmax())]
            assert found.score == pytest.approx(max(cosines.max(), 0), abs=1e-6)
        else:
            assert (found.lang_pred, found.score) == ("und", 0.0)


def test_held_out_languages(spark):
    folder = "/root/testdata/sf0.01"
    got = registered.QUERIES["op12_language_id"](spark, folder).filter("held_out")
    rows = got.join(registered.table(spark, folder, "documents").select("doc_id", "lang"), "doc_id").filter("lang is not null").collect()
    assert len(rows) > 150
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.97


def test_rows_that_need_care(spark):
    docs = edges.documents(spark)
    profiles = la.train(docs)
    assert profiles.languages == ["en"]
    got = la.predict(docs, profiles).collect()
    assert sorted(repr(r.doc_id) for r in got) == sorted(repr(i) for i, _ in edges.ROWS)
    texts = {}
    for i, text in edges.ROWS:
        texts.setdefault(i, []).append(text)
    for r in got:
        lettered = any(c.isalpha() for t in texts[r.doc_id] for c in t or "")
        assert r.lang_pred == ("en" if lettered else "und") and 0 <= r.score <= 1
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)


def test_nothing_learned_and_empty_table(spark):
    docs = edges.documents(spark)
    nothing = la.train(docs.withColumn("lang", F.lit(None).cast("string")))
    assert nothing.languages == []
    assert {(r.lang_pred, r.score) for r in la.predict(docs, nothing).collect()} == {("und", 0.0)}
    assert la.predict(docs.filter("false"), la.train(docs)).count() == 0


def test_more_grams_than_the_cache_holds(monkeypatch):
    rng = np.random.default_rng(5)
    texts = ["".join(map(chr, rng.integers(0x4E00, 0x4F00, 400))) for _ in range(3)]
    whole = la.GramVectors(64).bundles([la.grams(t) for t in texts])
    monkeypatch.setattr(la, "CACHE", 512)
    assert (la.GramVectors(64).bundles([la.grams(t) for t in texts]) == whole).all()
    vectors = la.GramVectors(64)
    assert (whole == [plain_bundle(plain_grams(t), vectors) for t in texts]).all()
