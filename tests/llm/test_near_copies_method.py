"""The SimHash step of the near copies, and the bound that keeps the texts of unlike large sets at home."""

import numpy as np

from broadsheet.llm import near_copies as nc
from broadsheet.llm import simhash
from tests.llm.test_near_copies import copies, grouped
from tests.llm.test_near_copies_whole import alike_groups


def test_pairs_of_near_fingerprints_are_sought_and_those_beyond_the_radius_are_not_lost(spark, monkeypatch):
    docs = copies(seed=5, bases=4, each=12)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    asked, links = [], simhash.links
    monkeypatch.setattr(simhash, "links", lambda prints, radius, piece: asked.append((prints.count(), radius)) or links(prints, radius, piece))
    got = {r.id: r.comp for r in nc.groups(frame, radius=3).collect()}
    assert grouped([got[k] for k, _ in docs]) == grouped(alike_groups(docs)[0])
    assert len(asked) == 1 and asked[0][0] > 4 and asked[0][1] == 3


def test_bins_never_exceed_the_difference_and_tell_unlike_large_sets_apart():
    rng = np.random.default_rng(8)
    some = lambda n: np.unique(rng.integers(0, 1 << 64, n, np.uint64))
    for n, m in ((2_000, 1_900), (2_400, 2_900), (20_000, 20_000), (17_000, 16_300), (200_000, 180_000)):
        a, b = some(n), some(m)
        allowed = (len(a) + len(b)) * (0.2 / 1.8)
        assert allowed < nc._apart(nc._bins(a), nc._bins(b)) <= len(a) + len(b)
        for share in (0.02, 0.1, 0.2):
            near = np.unique(np.concatenate([a[int(share * n):], some(int(share * n / 3) + 1)]))
            differ = len(np.setxor1d(a, near))
            assert nc._apart(nc._bins(a), nc._bins(near)) <= differ
    assert nc._bins(some(1_000)) is None
    same = np.full(70_000, 16, np.uint64) + np.arange(70_000, dtype=np.uint64) * np.uint64(8_192)  # one bin, beyond 255
    assert nc._apart(nc._bins(same), nc._bins(same[:60_000])) <= 10_000


def test_large_texts_that_share_a_passage_are_not_verified_and_near_copies_are(spark, monkeypatch):
    rng = np.random.default_rng(9)
    words = lambda n: [f"w{x}" for x in rng.integers(0, 10**6, n)]
    passage, texts = words(300), []
    for _ in range(6):
        texts.append(words(2_600) + passage)
    texts += [texts[0][:-320] + words(300), texts[1] + words(500), texts[2][:-700]]  # copies of 0.80, of 0.85, and one unlike
    docs = [(k, " ".join(t)) for k, t in enumerate(texts)]
    group, pairs = alike_groups(docs)
    assert len(pairs) == 2
    met, bounded = spark.sparkContext.accumulator(0), nc._bounded

    def counted(least):
        run = bounded(least)

        def again(batches):
            for part in run(batches):
                met.add(sum(part.column("possible").to_pylist()))
                yield part
        return again

    monkeypatch.setattr(nc, "_bounded", counted)
    got = {r.id: r.comp for r in nc.groups(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert grouped([got[k] for k, _ in docs]) == grouped(group)
    assert met.value <= 4  # of 21 pairs or more that share a first shingle
