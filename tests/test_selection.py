"""Picking against a plain one-by-one selector, layers, and shortlists that had to be cut."""

import datetime as dt
import random
from collections import Counter

import pytest

from broadsheet import fixed_values as fv
from broadsheet.operators import selection as se

NOW = dt.datetime(2026, 9, 20)
DAY = NOW.date()
SCHEMA = ("feed_id int, report_date date, id string, source string, category string, source_tier int, published_at timestamp, "
          "fingerprint string, url_key string, title_key string, versions array<string>, importance int, score double, level int")
TWIN = ", layer string, key_cn string, versions_cn array<string>, key_en string, versions_en array<string>"


def row(n, level=1, importance=70, category="science", source=None, tier=1, title=None, hours=1, feed=0, fp=None, url=None, score=None):
    title = title if title is not None else chr(0x4E00 + n * 7) * 8
    points = {1: 100, 2: 85, 3: 65}[tier]
    score = score if score is not None else 0.6 * importance + 0.2 * points + 10 + (10 if category in ("ai", "robotics") else 0)
    return (feed, DAY, f"{n:04d}", source or f"s{n}", category, tier, NOW - dt.timedelta(hours=hours), fp or f"f{n}", url or f"u{n}", title, [],
            importance, float(score), level)


def picks(df):
    rows = sorted(df.filter("state = 'picked'").collect(), key=lambda r: (r.feed_id, r.pick))
    return {feed: [r.id for r in rows if r.feed_id == feed] for feed in {r.feed_id for r in rows}}


def plain(rows, rules=fv.RULES):
    """One candidate at a time: take the best, judge it, repeat."""
    cols = [c.split()[0] for c in SCHEMA.split(", ")]
    pool = [dict(zip(cols, r)) for r in rows]
    majors = sum(r["importance"] >= 85 and r["level"] <= 2 for r in pool)
    cap = rules["maximum"] if majors >= 10 else rules["target"]
    by_source, by_category = max(1, int(cap * 0.25)), max(1, int(cap * 0.65))
    chosen, waiting = [], []

    def same(a, b):
        return (a["fingerprint"] == b["fingerprint"] or a["url_key"] == b["url_key"] or a["title_key"] == b["title_key"])

    for level in (1, 2, 3, 4):
        left = [r for r in pool if r["level"] == level]
        while left and len(chosen) < cap:
            s, c = Counter(r["source"] for r in chosen), Counter(r["category"] for r in chosen)
            few = sum(r["category"] not in ("ai", "robotics") for r in chosen) < 2

            def over(r):
                return (r["source_tier"] > 1 and s[r["source"]] >= 2, s[r["source"]] >= by_source, c[r["category"]] >= by_category)

            def rank(r):
                major = r["importance"] >= 85
                a, b, d = over(r)
                extra = (20 if few and r["category"] not in ("ai", "robotics") else 0) - (0 if major else 25 * d + 25 * a + 30 * b)
                return major, r["importance"] // 10, r["score"] + extra, r["published_at"], r["id"]

            best = max(left, key=rank)
            left.remove(best)
            if any(same(best, x) for x in chosen):
                continue
            if best["importance"] < 85 and any(over(best)):
                waiting.append(best)
                continue
            chosen.append(best)
        if len(chosen) >= rules["target"]:
            break
    for r in sorted(waiting, key=lambda r: r["score"], reverse=True):
        if len(chosen) >= min(cap, rules["minimum"]):
            break
        if not any(same(r, x) for x in chosen):
            chosen.append(r)
    return [r["id"] for r in chosen]


def random_pool(seed, n):
    rng = random.Random(seed)
    return [row(i, level=rng.choice([1, 1, 2, 3, 4]), importance=rng.choice([60, 62, 75, 75, 80, 88, 93]),
                category=rng.choice(["ai", "ai", "ai", "science", "chips"]), source=f"s{rng.randrange(6)}", tier=rng.choice([1, 2, 3]),
                title=chr(0x4E00 + rng.randrange(n // 2) * 7) * 8, hours=rng.randrange(1, 20), fp=f"f{rng.randrange(n)}", url=f"u{rng.randrange(n)}")
            for i in range(n)]


@pytest.mark.parametrize("seed,n", [(1, 12), (2, 40), (3, 90), (4, 150)])
def test_equals_plain_selector(spark, seed, n):
    rows = random_pool(seed, n)
    got = picks(se.select_edition(spark.createDataFrame(rows, SCHEMA)))
    assert got.get(0, []) == plain(rows)


def test_cut_shortlists_change_nothing(spark):
    """One class holds hundreds of copies of what is already picked; the shortlist is far smaller."""
    rng = random.Random(9)
    copies = [row(1000 + i, importance=78, source="hot", title="同" * 8, hours=rng.randrange(1, 20)) for i in range(160)]
    copies += [row(2000 + i, importance=77, source="hot", title="异" * 8, hours=rng.randrange(1, 20)) for i in range(160)]
    rest = [row(i, importance=65, source=f"s{i % 3}", tier=2, category="ai", hours=i + 1) for i in range(12)]
    behind = [row(3000 + i, importance=70, source="hot", hours=5 + i) for i in range(3)]
    rows = copies + rest + behind
    got = picks(se.select_edition(spark.createDataFrame(rows, SCHEMA), keep=20))
    assert got[0] == plain(rows)


def test_repartitioning_changes_nothing(spark):
    rows = random_pool(7, 60)
    df = spark.createDataFrame(rows, SCHEMA)
    assert picks(se.select_edition(df.repartition(1))) == picks(se.select_edition(df.repartition(7)))


def test_target_and_major_day(spark):
    cats = ["ai", "science", "chips", "space"]
    normal = [row(i, category=cats[i % 4]) for i in range(24)]
    major = [row(i, category=cats[i % 4], importance=95, feed=1) for i in range(24)]
    got = picks(se.select_edition(spark.createDataFrame(normal + major, SCHEMA)))
    assert (len(got[0]), len(got[1])) == (14, 18)


def test_major_other_topic_beats_average_favourite(spark):
    rows = [row(1, category="ai", importance=65), row(2, category="science", importance=95)]
    assert picks(se.select_edition(spark.createDataFrame(rows, SCHEMA), limit=1))[0] == ["0002"]


def layered(spark, today, catch_up=0, deep=0, evergreen=0, change=None):
    rows, n = [], 0
    cats = ("ai", "chips", "science", "software", "space")
    for layer, count, level, hours, score in (("today", today, 1, 1, 75), ("catch_up", catch_up, 3, 48, 90), ("deep_read", deep, 4, 120, 92),
                                              ("evergreen", evergreen, 4, 1000, 99)):
        for _ in range(count):
            base = row(n, level=level, importance=score, category=cats[n % 5], hours=hours)
            rows.append([*base, layer, base[9], [], base[9], []])
            n += 1
    if change:
        change(rows)
    out = se.select_layered(spark.createDataFrame([tuple(r) for r in rows], SCHEMA + TWIN))
    return [r.layer for r in sorted(out.filter("state = 'picked'").collect(), key=lambda r: r.pick)], out


@pytest.mark.parametrize("pool,want", [
    ((14, 0, 0, 100), ["today"] * 14), ((12, 0, 0, 8), ["today"] * 12), ((10, 6), ["today"] * 10),
    ((8, 2, 3, 5), ["today"] * 8 + ["catch_up"] * 2 + ["deep_read"] * 3 + ["evergreen"]),
    ((8, 6, 4, 4), ["today"] * 8 + ["catch_up"] * 6), ((8, 2, 4, 4), ["today"] * 8 + ["catch_up"] * 2 + ["deep_read"] * 4),
    ((8, 3), ["today"] * 8 + ["catch_up"] * 3), ((0, 2, 1, 1), ["catch_up"] * 2 + ["deep_read", "evergreen"])])
def test_layers(spark, pool, want):
    assert layered(spark, *pool)[0] == want


def test_older_twin_never_replaces_today(spark):
    def same_headline(rows):
        rows[1][9] = rows[0][9]

    def same_translation(rows):
        rows[1][15] = rows[1][17] = rows[0][15]

    for change in (same_headline, same_translation):
        assert layered(spark, 1, evergreen=1, change=change)[0] == ["today"]


def test_reasons_cover_every_row(spark):
    _, out = layered(spark, 8, 2, 3, 5)
    assert out.count() == 18 and out.filter("state = 'dropped' and reason is null").count() == 0
