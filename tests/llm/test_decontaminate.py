"""Benchmark windows against brute force over whole texts."""

from collections import Counter

import numpy as np

from broadsheet.llm import decontaminate as de
from tests.llm.edges import SENTENCE, documents


def tokens(text):
    out = []
    for k, w in enumerate((text or "").encode().lower().split()):
        bare = w.strip(b".,;:!?\"'()[]{}")
        if bare:
            out.append((k, bare))
    return out


def grams(words, n):
    n = min(n, len(words))
    return Counter(tuple(words[k:k + n]) for k in range(len(words) - n + 1)) if words else Counter()


def plain_hits(docs, items):
    """Best similarity by (document, item), windows of the item's number of words."""
    best = {}
    for doc, text in docs:
        words = [w for _, w in tokens(text)]
        for item, passage in items:
            want = [w for _, w in tokens(passage)]
            if not want or not words:
                continue
            run = min(5, len(want), len(words))
            target = grams(want, 5)
            for a in range(max(1, len(words) - len(want) + 1)):
                got = grams(words[a:a + len(want)], run)
                both, either = sum((got & target).values()), sum((got | target).values())
                if both / either >= 0.8:
                    best[doc, item] = max(best.get((doc, item), 0), both / either)
    return best


def test_small_tables_equal_brute_force(spark, small):
    docs, bench = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "benchmark"))
    want = plain_hits([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in bench.collect()])
    got = {(r.doc_id, r.item_id): r.similarity for r in de.hits(docs, bench).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)


def test_planted_passages_are_found_with_their_place(spark):
    rng = np.random.default_rng(3)
    vocabulary = np.array([f"w{k}" for k in range(4000)])
    items = [(k, " ".join(rng.choice(vocabulary, int(rng.integers(12, 60))))) for k in range(40)]
    docs, want = [], {}
    for k in range(120):
        body = list(rng.choice(vocabulary, 300))
        if k % 3 == 0:
            passage = items[k % 40][1].split()
            if k % 2 and len(passage) > 45:
                passage[20] = "changed"
            at = int(rng.integers(0, 250))
            body[at:at] = [w.upper() + "." if n % 7 == 0 else w for n, w in enumerate(passage)]
            want[k, k % 40] = at
        docs.append((k, " ".join(body)))
    bench = spark.createDataFrame(items, "item_id long, text string")
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    rows = de.hits(frame, bench).collect()
    expected = plain_hits(docs, items)
    assert {(r.doc_id, r.item_id) for r in rows} == expected.keys()
    assert all(r.start_word == want[r.doc_id, r.item_id] for r in rows if r.similarity == 1.0)
    clean = {r.doc_id for r in de.clean(frame, bench).collect()}
    assert clean == {k for k, _ in docs} - {k for k, _ in expected}


def test_tables_find_every_fingerprint_within_the_radius():
    rng = np.random.default_rng(4)
    sized = de.Sized(9, [(k, rng.integers(0, 2**63, 5, dtype=np.uint64)) for k in range(50)], 15)
    probes = sized.prints[rng.integers(0, 50, 400)]
    for k in range(len(probes)):
        for bit in rng.integers(0, 64, int(rng.integers(0, 30))):
            probes[k] ^= np.uint64(1) << np.uint64(bit)
    want = {(i, j) for i in range(400) for j in range(50) if np.bitwise_count(probes[i] ^ sized.prints[j]) <= 15}
    assert set(sized.candidates(probes)) == want and want


def test_edges(spark):
    items = [(1, SENTENCE), (2, ""), (3, None), (None, SENTENCE), (4, "one two three"), (5, "..."), (1, "minus three")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = documents(spark)
    got = sorted({(r.doc_id, r.item_id) for r in de.hits(docs, bench).collect()}, key=repr)
    assert got == sorted([(None, 1), (1, 1), (11, 1), (12, 1), (-3, 1), (5, 4), (3, 4)], key=repr)
    left = de.clean(docs, bench)
    assert left.columns == docs.columns and left.count() == docs.count() - 8
    empty = spark.createDataFrame([], docs.schema)
    assert de.hits(empty, bench).count() == 0 and de.clean(empty, bench).count() == 0
    none = spark.createDataFrame([], "item_id long, text string")
    assert de.hits(docs, none).count() == 0 and de.clean(docs, none).count() == docs.count()


def test_windows_just_over_the_similarity_are_all_found():
    rng = np.random.default_rng(7)
    word = lambda n: [f"w{x}" for x in rng.integers(0, 10**6, n)]
    items = [(k, " ".join(word(int(rng.integers(40, 90))))) for k in range(30)]
    index, known, docs = de.Index(items), de.BareHashes(), []
    for k in range(1500):
        passage = items[k % 30][1].split()
        cut = len(passage) // 10  # words replaced at one end leave about 0.80 to 0.85
        cut -= k % 3 == 0
        passage = word(cut) + passage[cut:] if k % 2 else passage[:-cut] + word(cut)
        docs.append((k, " ".join(word(20) + passage + word(20))))
    got = {(k, item): alike for k, text in docs for item, alike, _, _ in index.hits(text, known)}
    want = {}
    for k, text in docs:  # the window that lies where the passage was put
        passage = grams(items[k % 30][1].split(), 5)
        window = grams(text.split()[20:-20], 5)
        alike = sum((window & passage).values()) / sum((window | passage).values())
        if alike >= 0.8:
            want[k, k % 30] = alike
    assert all(got.get(k, 0) >= v - 1e-12 for k, v in want.items()) and sum(v <= 0.85 for v in want.values()) > 300
    few = docs[:40]
    want = plain_hits(few, items[:10])
    assert {k: v for k, v in got.items() if k[0] < 40 and k[1] < 10} == want


def test_recall_of_the_fingerprints_by_similarity_and_length():
    rng = np.random.default_rng(9)
    word = lambda n: [f"w{x}" for x in rng.integers(0, 10**6, n)]
    for low, high in ((13, 20), (20, 40), (40, 90), (90, 400)):
        items = [(k, " ".join(word(int(rng.integers(low, high))))) for k in range(20)]
        index, known, found, held = de.Index(items), de.BareHashes(), Counter(), Counter()
        for k in range(600):
            whole = items[k % 20][1].split()
            passage = list(whole)
            for at in rng.integers(0, len(whole), 1 + int(rng.integers(0, 1 + len(whole) // 45))):
                at = int(at) if k % 2 else 0 if at % 2 else len(whole) - 1  # anywhere, or at an end
                passage[at:at + 1] = word(1 + k % 2 * int(rng.integers(0, 2)))
            if k % 4 == 0:
                cut = len(whole) // int(rng.integers(10, 14))
                passage = word(cut) + whole[cut:]
            want, got = grams(whole, 5), grams(passage[:len(whole)], 5)
            alike = sum((got & want).values()) / sum((got | want).values())
            if 0.8 <= alike:
                band = "0.80-0.85" if alike < 0.85 else "0.85-0.90" if alike < 0.9 else "0.90-1.00"
                held[band] += 1
                text = " ".join(word(30) + passage + word(30))
                found[band] += any(i == k % 20 and v >= alike - 1e-12 for i, v, _, _ in index.hits(text, known))
        assert sum(held.values()) > 50
        for band, n in held.items():
            print(f"items of {low} to {high - 1} words, alike {band}: {found[band]} of {n}")
            assert found[band] >= 0.99 * n
