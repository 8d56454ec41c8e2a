"""Every row of a pool gets the decision that a run over the whole pool, one candidate at a time, would give it."""

import random
from difflib import SequenceMatcher

import pytest

from broadsheet import fixed_values as fv
from broadsheet.operators import selection as se

from tests.test_selection import SCHEMA, TWIN, row

NAMES = [c.split()[0] for c in (SCHEMA + TWIN).split(", ")]


def alike(a, b, key="title_key", versions="versions"):
    if a[versions] and b[versions] and a[versions] != b[versions]:
        return False
    return SequenceMatcher(None, a[key], b[key]).ratio() >= 0.78


def doubled(r, kept, prefix="duplicate"):
    tests = (("fingerprint", lambda o: o["fingerprint"] == r["fingerprint"]), ("url", lambda o: o["url_key"] == r["url_key"]), ("event", lambda o: alike(r, o)))
    for name, test in tests:
        for o in kept:
            if test(o):
                return f"{prefix}_{name}", o["id"]
    return None


def one_run(pool, limit, out, rules=fv.RULES):
    """Chosen rows in order; decisions on the others go to `out`."""
    cap = min(limit, rules["maximum"] if sum(r["importance"] >= 85 and r["level"] <= 2 for r in pool) >= 10 else rules["target"])
    most_source, most_category = max(1, int(cap * 0.25)), max(1, int(cap * 0.65))
    chosen, waiting, levels = [], [], set()
    for level in (1, 2, 3, 4):
        left = [r for r in pool if r["level"] == level]
        while left and len(chosen) < cap:
            def limits(r):
                s = sum(c["source"] == r["source"] for c in chosen)
                return (r["source_tier"] > 1 and s >= 2, s >= most_source, sum(c["category"] == r["category"] for c in chosen) >= most_category)

            def rank(r):
                few = sum(c["category"] not in ("ai", "robotics") for c in chosen) < 2
                media, source, category = limits(r)
                minus = 0 if r["importance"] >= 85 else 25 * media + 30 * source + 25 * category
                return (r["importance"] >= 85, r["importance"] // 10, r["score"] + (20 if few and r["category"] not in ("ai", "robotics") else 0) - minus,
                        r["published_at"], r["id"])

            best = max(left, key=rank)
            left.remove(best)
            found = doubled(best, chosen)
            if found:
                out[best["id"]] = found
            elif best["importance"] < 85 and any(limits(best)):
                out[best["id"]] = ("diversity_deferred_not_used", None)
                waiting.append(best)
            else:
                chosen.append(best)
        levels.add(level)
        if len(chosen) >= rules["target"]:
            break
    for r in sorted(waiting, key=lambda r: -r["score"]):
        if len(chosen) >= min(cap, rules["minimum"]):
            break
        found = doubled(r, chosen)
        if found:
            out[r["id"]] = (found[0], None)
        else:
            chosen.append(r)
    for r in pool:
        if r not in chosen:
            out.setdefault(r["id"], ("selection_capacity" if r["level"] in levels else "target_met_before_level", None))
        else:
            out.pop(r["id"], None)
    return chosen


def one_edition(pool, limit=None):
    out = {}
    chosen = one_run(pool, limit or fv.RULES["maximum"], out)
    return {r["id"]: (out.get(r["id"], (None, None)), chosen.index(r) + 1 if r in chosen else None) for r in pool}


def in_layers(pool, limit=None, rules=fv.RULES):
    target = min(rules["target"], limit or rules["maximum"])
    final, out, locked = [], {}, 0

    def twin(r, kept):
        return any(alike(r, o, "key_cn", "versions_cn") and alike(r, o, "key_en", "versions_en") for o in kept)

    for layer in ("today", "catch_up", "deep_read", "evergreen"):
        members = [r for r in pool if r["layer"] == layer]
        if layer != "today" and (locked >= rules["minimum"] or len(final) >= target):
            why = "normal_today_edition_no_supplement" if locked >= rules["minimum"] else "no_remaining_slots"
            out.update({r["id"]: (why, None) for r in members})
            continue
        rest = []
        for r in members:
            found = ("duplicate_with_locked_selection", None) if twin(r, final) else doubled(r, final, "historical")
            if found:
                out[r["id"]] = found
            else:
                rest.append(r)
        kept = []
        for r in one_run(rest, target - len(final), out):
            if twin(r, kept):
                out[r["id"]] = ("duplicate_bilingual_event", None)
            else:
                kept.append(r)
        final += kept
        locked += len(kept) if layer == "today" else 0
    out.update({r["id"]: ("outside_eligible_supply_layers", None) for r in pool if r["layer"] is None})
    return {r["id"]: (out.get(r["id"], (None, None)), final.index(r) + 1 if r in final else None) for r in pool}


def made(seed, n, feed=0, spread=0.5, layers=False):
    """Candidates with close headlines, shared sources, tied scores and copies; `spread` is how many of them are distinct."""
    rng = random.Random(seed)
    heads = ["".join(chr(0x4E00 + rng.randrange(4000)) for _ in range(8)) for _ in range(max(2, int(n * spread)))]
    rows = []
    for i in range(n):
        head = rng.choice(heads)
        if rng.random() < 0.3:
            head = head[:rng.randrange(9)] + "x" + head[rng.randrange(9):]
        versions = rng.choice([[], [], ["1.0"], ["2.0"]])
        r = list(row(i, level=rng.choice([1, 1, 2, 3, 4]), importance=rng.choice([60, 62, 62, 75, 80, 88]), feed=feed,
                     category=rng.choice(["ai", "ai", "ai", "science"]), source=f"s{rng.randrange(max(2, int(5 * spread) + 1))}", tier=rng.choice([1, 2, 3]),
                     title=head, hours=rng.randrange(1, 8), fp=f"f{rng.randrange(n)}", url=f"u{rng.randrange(n)}"))
        r[10] = versions
        if layers:
            r[13] = rng.choice([1, 2]) if (layer := rng.choice(["today", "catch_up", "deep_read", "evergreen", None])) == "today" else 3 if layer == "catch_up" else 4
            other = rng.choice(heads) if rng.random() < 0.4 else head
            r += [layer, heads[0], [], heads[0], []] if rng.random() < 0.15 else [layer, head, versions, other, []]
        rows.append(tuple(r))
    return rows


def check(rows, out, expected):
    got = {}
    for r in out.collect():
        assert (r.feed_id, r.id) not in got
        got[r.feed_id, r.id] = ((r.reason, r.duplicate_of), r.pick)
        assert r.state == ("picked" if r.pick else "dropped")
    want = {}
    for feed in {r[0] for r in rows}:
        pool = [dict(zip(NAMES, r)) for r in rows if r[0] == feed]
        want |= {(feed, k): v for k, v in expected(pool).items()}
    assert got == want
    return {reason for (reason, _), _ in want.values()}


FEEDS = [(1, 25, 0.5), (2, 60, 0.3), (3, 120, 0.2), (4, 150, 0.9), (5, 9, 1.0), (6, 200, 0.1), (7, 90, 0.05)]


@pytest.mark.parametrize("keep", [19, 64, 10_000])
def test_every_row_of_an_edition(spark, keep):
    rows = [r for seed, n, spread in FEEDS for r in made(seed, n, seed, spread)]
    seen = check(rows, se.select_edition(spark.createDataFrame(rows, SCHEMA), keep=keep), one_edition)
    assert {"selection_capacity", "target_met_before_level", "diversity_deferred_not_used", "duplicate_event", "duplicate_url", "duplicate_fingerprint"} <= seen


@pytest.mark.parametrize("limit", [3, 12])
def test_every_row_under_a_limit(spark, limit):
    rows = [r for seed, n, spread in FEEDS[:4] for r in made(seed + 20, n, seed, spread)]
    check(rows, se.select_edition(spark.createDataFrame(rows, SCHEMA), limit=limit), lambda pool: one_edition(pool, limit))


def test_more_rows_of_a_class_than_the_shortlist_holds(spark):
    rows = [row(i, importance=78, source=f"hot{i % 2}", category="ai", hours=1 + i % 5, title=chr(0x4E00 + i) * 8, level=1 + i % 2) for i in range(400)]
    rows += [row(1000 + i, importance=66, tier=2, source="cold", category="ai", title=chr(0x6000 + i % 3) * 8) for i in range(90)]
    seen = check(rows, se.select_edition(spark.createDataFrame(rows, SCHEMA), keep=19), one_edition)
    assert "diversity_deferred_not_used" in seen


@pytest.mark.parametrize("keep", [19, 10_000])
def test_every_row_in_layers(spark, keep):
    rows = [r for seed, n, spread in [(1, 20, 0.9), (2, 60, 0.3), (3, 120, 0.2), (4, 300, 0.5), (5, 40, 0.1), (6, 12, 0.3)] for r in made(seed, n, seed, spread, layers=True)]
    seen = check(rows, se.select_layered(spark.createDataFrame(rows, SCHEMA + TWIN), keep=keep), in_layers)
    assert {"outside_eligible_supply_layers", "normal_today_edition_no_supplement", "duplicate_bilingual_event", "duplicate_with_locked_selection"} <= seen


def test_layer_metadata_of_picked_rows(spark):
    rows = made(5, 40, 0, 0.1, layers=True)
    out = se.layer_metadata(se.select_layered(spark.createDataFrame(rows, SCHEMA + TWIN))).collect()
    places = {"today": 0, "catch_up": 1, "deep_read": 2, "evergreen": 3}
    for r in out:
        if r.state == "dropped":
            assert r.is_today is None and r.remaining_slots_before is None
        else:
            assert (r.is_today, r.locked_today, r.selected_as_fallback) == (r.layer == "today", r.layer == "today", r.layer != "today")
            assert (r.fallback_priority, r.remaining_slots_before) == (places[r.layer], 14 - r.pick + 1)


def test_empty_pool(spark):
    assert se.select_edition(spark.createDataFrame([], SCHEMA)).count() == 0


def test_whole_table(spark, data):
    """The registered query against the plain run over its whole pool."""
    from broadsheet.plans import selection_queries as sq

    pool = sq.pool(spark, data, events=True).filter("gate is null").collect()
    got = {(r.feed_id, r.report_date, r.id): ((r.reason, r.duplicate_of), r.pick) for r in sq.select_edition(spark, data).collect()}
    want = {}
    for edition in {(r.feed_id, r.report_date) for r in pool}:
        rows = [r.asDict() for r in pool if (r.feed_id, r.report_date) == edition]
        want |= {(edition[0], str(edition[1]), k): v for k, v in one_edition(rows).items()}
    assert len(want) == len(pool) and got == want


def test_diagnostics_of_greedy_editions(spark):
    rows = [r for seed, n, spread in FEEDS for r in made(seed, n, seed, spread)]
    pool = spark.createDataFrame([(*r, r[2].endswith("3"), "news") for r in rows], SCHEMA + ", deep boolean, channel string")
    out = {r.feed_id: r for r in se.edition_diagnostics(pool, se.select_edition(pool)).filter("dimension = 'edition'").collect()}
    for feed, n, _ in FEEDS:
        members = [dict(zip(NAMES, r)) for r in rows if r[0] == feed]
        decided = {}
        chosen = one_run(members, fv.RULES["maximum"], decided)
        majors = sum(r["importance"] >= 85 and r["level"] <= 2 for r in members)
        cap = 18 if majors >= 10 else 14
        most = max(1, int(cap * 0.25))
        counts = [sum(c["source"] == s for c in chosen) for s in {c["source"] for c in chosen}]
        filled = {r.id for r in se.select_edition(pool.filter(f"feed_id = {feed}")).filter("filled").collect()} if feed == 7 else None
        got = out[feed]
        assert (got.eligible, got.selected, got.sources, got.source_limit) == (n, len(chosen), len(counts), most)
        assert got.shortfall == max(10 - len(chosen), 0) and got.deep_read_candidates == sum(r["id"].endswith("3") for r in members)
        assert got.diversity_exception >= any(k > most for k in counts)
        assert filled is None or got.diversity_exception == (any(k > most for k in counts) or bool(filled))
