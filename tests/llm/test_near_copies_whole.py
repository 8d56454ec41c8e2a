"""Groups of near copies against brute force that tests nothing but the similarity of whole texts."""

from itertools import combinations

import numpy as np

from broadsheet.llm import near_copies as nc
from tests.llm.test_near_copies import copies, grouped


def alike_groups(docs):
    """Groups of pairs alike in 0.8 or more on whole texts, and the similarity of each pair."""
    tokens = [(t or "").encode().lower().split() for _, t in docs]
    sets = [{tuple(ws[k:k + 5]) for k in range(max(1, len(ws) - 4))} if ws else set() for ws in tokens]
    group, pairs = list(range(len(docs))), {}
    for a, b in combinations(range(len(docs)), 2):
        both = len(sets[a] & sets[b])
        either = len(sets[a]) + len(sets[b]) - both
        if tokens[a] == tokens[b] or either and 10 * both >= 8 * either:
            pairs[a, b] = both / either if either else 1.0
            group = [group[a] if g == group[b] else g for g in group]
    return group, pairs


def test_copies_with_appended_blocks_and_short_texts_are_all_grouped(spark):
    rng = np.random.default_rng(12)
    words = lambda n: [f"w{x}" for x in rng.integers(0, 10**6, n)]
    texts = []
    for size in (6, 9, 12, 30, 100, 400) * 20:
        base = words(size)
        added = (size - 4) // 4
        texts += [base, base + words(added), base[:-1] if size < 12 else words(added) + base]
    docs = [(k, " ".join(t)) for k, t in enumerate(texts)]
    group, pairs = alike_groups(docs)
    assert sum(s <= 0.81 for s in pairs.values()) > 100
    for settings in ({}, {"nearest": 1, "piece": 2}):
        got = {r.id: r.comp for r in nc.groups(spark.createDataFrame(docs, "doc_id long, text string"), **settings).collect()}
        assert grouped([got[k] for k, _ in docs]) == grouped(group)


def test_large_groups_equal_brute_force_without_radius(spark):
    docs = copies()
    got = {r.id: r.comp for r in nc.groups(spark.createDataFrame(docs, "doc_id long, text string"), nearest=1, piece=16).collect()}
    assert grouped([got[k] for k, _ in docs]) == grouped(alike_groups(docs)[0])
