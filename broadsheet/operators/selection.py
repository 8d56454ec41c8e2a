"""Edition selection: windows, candidate pools, greedy picks under diversity rules, layers, replay.

Everything up to the picks is joins and aggregates over all feeds and editions. Picking is
sequential inside one edition, so it runs as a grouped map over a bounded shortlist per edition:
the best rows of every class whose members the rules cannot tell apart. An edition that ran out of
a cut class hands back the picks it is sure of; their duplicates then leave the pool and the
edition is run again, so the result equals a run over the whole pool.
"""

from __future__ import annotations

import datetime as dt
from collections import Counter
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet import fixed_values as fv
from broadsheet.functions import rules as ru
from broadsheet.functions import text as tx
from broadsheet.functions import urls
from broadsheet.operators import linkage as lk
from broadsheet.operators import reasons
from broadsheet.operators.admission import first_reason
from broadsheet.operators.dedup import first_per_key
from broadsheet.session import broadcast_if_small, delete_folder, stored

EDITION = ["feed_id", "report_date"]
SHORTLIST = 64
DAYS_AT_ONCE = 31  # editions of a feed that a replay picks in one task


def window_join(articles: DataFrame, editions: DataFrame, hours: int = fv.WINDOW_HOURS) -> DataFrame:
    """Articles inside each edition's window: an equi-join on (feed, day) with an exact residual."""
    low = F.col("now_ts") - F.expr(f"INTERVAL {hours} HOURS")
    high = F.col("now_ts") + F.expr(f"INTERVAL {fv.FUTURE_MINUTES} MINUTES")
    days = editions.select("feed_id", "report_date", "now_ts",
                           F.explode(F.sequence(F.to_date(low), F.to_date(high))).alias("published_date"))
    joined = articles.join(broadcast_if_small(days), ["feed_id", "published_date"])
    return joined.filter(ru.in_window(F.col("published_at"), F.col("now_ts"), hours))


def history_extend(past: DataFrame, attempted: DataFrame) -> DataFrame:
    """Attempted articles count as history for the next pass."""
    cols = ["doc_id", "original_url", "title", "fingerprint"]
    return past.select(*cols, F.lit("published").alias("kind")).unionByName(
        attempted.select(*cols, F.lit("attempted").alias("kind")))


def candidate_features(articles: DataFrame, deep_terms: str = fv.DEEP_TITLE, impact_terms: str = fv.IMPACT_TITLE,
                       extra: tuple[str, ...] = ()) -> DataFrame:
    """The narrow row selection works on; long texts stay behind. `extra` columns are kept as they are."""
    title, body = F.col("title"), F.col("clean_text")
    return articles.select(
        *extra,
        "feed_id", "id", "doc_id", "source", "category", "channel", "source_tier", "source_role", "verification_status",
        "published_at", "published_date", "fingerprint", urls.normalized_url(F.col("original_url")).alias("url_key"),
        *lk.event_key(title), ru.deep_read(title, body, F.col("source_tier"), deep_terms).alias("deep"),
        ru.editorial_candidate(title).alias("editorial"), F.col("importance").alias("enriched"),
        ru.importance(F.col("importance"), title, impact_terms).alias("importance"),
        F.col("importance").isNotNull().alias("cached"))


def keyed_history(history: DataFrame) -> DataFrame:
    """The published rows as keys: feed, report date, fingerprint, URL key, headline key and versions."""
    cols = ["feed_id", "report_date", "fingerprint", "url_key", "title_key", "versions"]
    if "url_key" in history.columns:
        return history.select(*cols)
    return history.select("feed_id", "report_date", "fingerprint", urls.normalized_url(F.col("original_url")).alias("url_key"),
                          *lk.event_key(F.col("title")))


def first_published(past: DataFrame, key: list[str], name: str) -> DataFrame:
    """First report date per published key: one row per key, whatever the history's length."""
    return past.groupBy("feed_id", *key).agg(F.min("report_date").alias(name))


def comparable(features: DataFrame) -> DataFrame:
    """Rows that the event gate may have to judge: those that another gate drops in every edition are never compared."""
    return features.filter(F.col("editorial") & (F.col("source_tier") <= 3) & (F.col("source_role") != "discovery")
                           & (F.col("verification_status") == "source_verified"))


def candidate_pool(features: DataFrame, editions: DataFrame, history: DataFrame, events: bool = True,
                   layers: DataFrame | None = None, pairs: DataFrame | None = None) -> DataFrame:
    """Every article in every edition's window with its level, score and the first gate it fails.

    `gate` is NULL for pool members. With `layers` (id, supply_layer), reserve articles keep
    level 4 beyond the window. `pairs` are event pairs found before, of all headlines the history can hold.
    """
    past = keyed_history(history)
    if events and pairs is None:  # the pairs read both tables once more, and their texts are cleaned and hashed only once
        features, past = stored(features, "features"), stored(past, "history")
    known = features.join(first_published(past, ["fingerprint"], "print_since"), ["feed_id", "fingerprint"], "left")
    known = known.join(first_published(past, ["url_key"], "url_since"), ["feed_id", "url_key"], "left")
    if events:
        if pairs is None:
            pairs = lk.event_pairs(comparable(features), past, ["feed_id"])
        first = first_published(past, ["title_key", "versions"], "since").withColumnsRenamed(
            {"title_key": "kept_key", "versions": "kept_versions"})
        since = pairs.join(first, ["feed_id", "kept_key", "kept_versions"]).groupBy(
            "feed_id", F.col("new_key").alias("title_key"), F.col("new_versions").alias("versions")).agg(F.min("since").alias("event_since"))
        known = known.join(since, ["feed_id", "title_key", "versions"], "left")
    else:
        known = known.withColumn("event_since", F.lit(None).cast("date"))
    rows = window_join(known, editions)
    level = ru.supply_level(F.col("published_at"), F.col("source_tier"), F.col("deep"), F.col("now_ts"))
    if layers is not None:
        rows = rows.join(layers.select("id", "supply_layer"), "id", "left")
        level = F.when(F.col("supply_layer").isin("deep_read", "evergreen"), 4).otherwise(level)
    rows = rows.withColumn("level", level)
    hours = ru.age_hours(F.col("published_at"), F.col("now_ts"))

    def before(name: str) -> Column:
        return F.coalesce(F.col(name) <= F.col("report_date"), F.lit(False))

    gate = first_reason(
        (~F.col("editorial"), "editorial_exclusion"),
        (F.col("level").isNull(), "older_than_72h_not_deep_read"),
        (F.col("source_tier") > 3, "tier_above_3"),
        (F.col("source_role") == "discovery", "discovery_not_factual_source"),
        (F.col("verification_status") != "source_verified", "source_not_verified"),
        (before("print_since"), "historical_fingerprint"), (before("url_since"), "historical_url"),
        (before("event_since"), "historical_event"),
        (F.col("cached") & (F.col("importance") < 60), "enriched_importance_below_60"))
    gate = F.when(gate == "older_than_72h_not_deep_read", first_reason(
        (hours < -1 / 6, "future_publication_time"), (hours > 168, "outside_7_day_window"),
        (F.lit(True), "older_than_72h_not_deep_read"))).otherwise(gate)
    score = ru.rank_score(F.col("importance"), F.col("source_tier"), F.col("category"))
    return rows.select(*EDITION, "now_ts", *[c for c in features.columns if c not in EDITION], "level",
                       score.alias("score"), gate.alias("gate"))


# --- picking ------------------------------------------------------------------------
# Rows of one class are told apart by nothing but score, time and id; rows of one group also by source.
GROUP = ["layer", "level", "importance_class", "major", "category", "source_tier"]
CLASS = [*GROUP, "source"]
PICK_SCHEMA = "feed_id int, report_date date, id string, n int, phase string, epoch int, pick int, state string"


def same_event(a, b) -> bool:
    """Row-level twin of the event join, for the few rows already picked."""
    if a.versions and b.versions and a.versions != b.versions:
        return False
    return lk.close_ratio(SequenceMatcher(None), a.title_key, b.title_key) >= fv.SAME_EVENT_RATIO


def duplicate_reason(row, kept) -> tuple[str, str] | None:
    for name, same in (("duplicate_fingerprint", lambda o: o.fingerprint == row.fingerprint),
                       ("duplicate_url", lambda o: o.url_key == row.url_key),
                       ("duplicate_event", lambda o: same_event(row, o))):
        for other in kept:
            if same(other):
                return name, other.id
    return None


class Limits:
    """The numeric limits of one picking round."""

    def __init__(self, cap: int, rules: dict):
        self.cap = cap
        self.category = max(1, int(cap * rules["category_share"]))
        self.source = max(1, int(cap * rules["source_share"]))
        self.media = rules["media_limit"]
        self.fill_to = min(cap, rules["minimum"])


class Cut(Exception):
    """A cut class or group was used up before the edition was decided."""


class Stock:
    """Rows left per class and per group, and which of them the shortlist cut short."""

    def __init__(self, rows: list, cut: set):
        self.cut = cut
        self.left = Counter(key for r in rows for key in (r.cls, r.grp))

    def use(self, row) -> None:
        self.left[row.cls] -= 1
        self.left[row.grp] -= 1

    def close(self, key) -> None:
        """What the shortlist left out of `key` would be blocked like the row just seen."""
        self.left[key] = float("inf")

    def short(self, row) -> bool:
        return any(not self.left[key] and key in self.cut for key in (row.cls, row.grp))


class Round:
    """Greedy picks over one shortlist; `cut` names its incomplete classes and groups."""

    def __init__(self, rows: list, limits: Limits, rules: dict, cut: set, duplicate=duplicate_reason):
        self.rows, self.limits, self.rules, self.cut, self.duplicate = rows, limits, rules, cut, duplicate
        self.picks: list = []
        self.epochs: dict[str, int] = {}  # picks made when a row was deferred
        self.deferred: list = []
        self.filled: set[str] = set()
        self.sources: Counter = Counter()
        self.categories: Counter = Counter()

    def blocked(self, row) -> bool:
        """A limit keeps this (non-major) row back. Counts only grow, so it stays blocked."""
        return not row.major and (
            (row.source_tier > 1 and self.sources[row.source] >= self.limits.media)
            or self.sources[row.source] >= self.limits.source
            or self.categories[row.category] >= self.limits.category)

    def key(self, row, exploring: bool) -> tuple:
        bonus = 20 if exploring and row.category not in self.rules["personal_categories"] else 0
        if not row.major:
            bonus -= 25 * (self.categories[row.category] >= self.limits.category)
            bonus -= 25 * (row.source_tier > 1 and self.sources[row.source] >= self.limits.media)
            bonus -= 30 * (self.sources[row.source] >= self.limits.source)
        return row.major, row.importance_class, row.score + bonus, row.published_at, row.id

    def take(self, row) -> None:
        self.picks.append(row)
        self.sources[row.source] += 1
        self.categories[row.category] += 1

    def run_level(self, level: int) -> None:
        waiting = [r for r in self.rows if r.level == level]
        stock = Stock(waiting, self.cut)
        while waiting and len(self.picks) < self.limits.cap:
            outside = sum(r.category not in self.rules["personal_categories"] for r in self.picks)
            exploring = outside < self.rules["explore_minimum"]
            # Passing over a row changes no count, so one order serves until the next pick.
            waiting.sort(key=lambda r: self.key(r, exploring), reverse=True)
            picked = None
            for place, row in enumerate(waiting):
                found = self.duplicate(row, self.picks)
                stock.use(row)
                if found:
                    pass
                elif self.blocked(row):
                    self.deferred.append(row)
                    self.epochs[row.id] = len(self.picks)
                    stock.close(row.cls)
                    if self.categories[row.category] >= self.limits.category:
                        stock.close(row.grp)
                else:
                    picked = place
                    self.take(row)
                if stock.short(row) and len(self.picks) < self.limits.cap:
                    raise Cut
                if picked is not None:
                    break
            waiting = waiting[picked + 1:] if picked is not None else []

    def fill(self) -> None:
        """Blocked rows return, best score first, only while the minimum is missed."""
        stock = Stock(self.deferred, self.cut)
        for row in sorted(self.deferred, key=lambda r: r.score, reverse=True):
            if len(self.picks) >= self.limits.fill_to:
                break
            stock.use(row)
            if not self.duplicate(row, self.picks):
                self.take(row)
                self.filled.add(row.id)
            if stock.short(row) and len(self.picks) < self.limits.fill_to:
                raise Cut

    def run(self) -> None:
        for level in (1, 2, 3, 4):
            self.run_level(level)
            if len(self.picks) >= self.rules["target"]:
                break
        self.fill()

    def chosen(self) -> list[tuple]:
        """(row, phase, epoch) in order."""
        return [(r, "fill", self.epochs[r.id]) if r.id in self.filled else (r, "main", None) for r in self.picks]


def shortlist(pool: DataFrame, keep: int) -> DataFrame:
    """The rows of each edition a picker can need, whatever the number of rows and sources.

    The best `keep` rows of each class, of those the best of each group (enough for every blocked
    source to fill a class), with the true sizes and the whole edition's number of majors.
    """
    sizes = pool.groupBy(*EDITION, *CLASS).agg(F.count("*").alias("class_size"))
    groups = sizes.groupBy(*EDITION, *GROUP).agg(F.sum(F.least("class_size", F.lit(keep))).alias("group_size"))
    order = [F.desc("score"), F.desc("published_at"), F.desc("id")]
    best = first_per_key(pool, [*EDITION, *CLASS], order, keep)
    best = first_per_key(best, [*EDITION, *GROUP], order, group_keep(keep))
    return best.join(sizes, [*EDITION, *CLASS]).join(groups, [*EDITION, *GROUP])


def group_keep(keep: int) -> int:
    return (fv.RULES["maximum"] + 2) * keep


def _rows(pdf: pd.DataFrame, keep: int) -> tuple[list, set]:
    pdf = pdf.sort_values(["score", "published_at", "id"], ascending=False, kind="stable")
    pdf = pdf.assign(cls=list(pdf[CLASS].itertuples(index=False, name=None)), grp=list(pdf[GROUP].itertuples(index=False, name=None)))
    if "versions" in pdf:
        pdf = pdf.assign(versions=pdf["versions"].map(tuple))
    if "versions_cn" in pdf:
        pdf = pdf.assign(versions_cn=pdf["versions_cn"].map(tuple), versions_en=pdf["versions_en"].map(tuple))
    rows = list(pdf.itertuples(index=False, name="Row"))
    # A class missing rows only because its group was cut is the group's business: they rank behind all the group holds.
    held = Counter(r.cls for r in rows)
    cut = {r.cls for r in rows if r.class_size > keep and held[r.cls] == keep}
    return rows, cut | {r.grp for r in rows if r.group_size > group_keep(keep)}


def _result(pdf: pd.DataFrame, chosen: list, twins: set, complete: bool) -> pd.DataFrame:
    """The chosen rows in order; those in `twins` take no place."""
    feed, day = pdf["feed_id"].iloc[0], pdf["report_date"].iloc[0]
    data, place = [], 0
    for n, (r, phase, epoch) in enumerate(chosen):
        place += r.id not in twins
        data.append((feed, day, r.id, n, phase, epoch, None if r.id in twins else place, "chosen" if complete else "sure"))
    if not complete:
        data.append((feed, day, None, None, None, None, None, "cut"))
    out = pd.DataFrame(data, columns=[part.split()[0] for part in PICK_SCHEMA.split(", ")])
    return out.astype({"n": "Int32", "epoch": "Int32", "pick": "Int32"})


def _greedy(rules: dict, limit: int | None, keep: int):
    def pick(pdf: pd.DataFrame) -> pd.DataFrame:
        rows, cut = _rows(pdf, keep)
        ceiling = limit or rules["maximum"]
        cap = min(ceiling, rules["maximum"] if int(pdf["majors"].iloc[0]) >= 10 else rules["target"])
        run = Round(rows, Limits(cap, rules), rules, cut)
        try:
            run.run()
        except Cut:
            return _result(pdf, run.chosen(), set(), complete=False)
        return _result(pdf, run.chosen(), set(), complete=True)

    return pick


def _bilingual_twin(row, kept: list) -> bool:
    def close(key: str, versions: str, other) -> bool:
        va, vb = getattr(row, versions), getattr(other, versions)
        if va and vb and va != vb:
            return False
        return lk.close_ratio(SequenceMatcher(None), getattr(row, key), getattr(other, key)) >= fv.SAME_EVENT_RATIO

    return any(close("key_cn", "versions_cn", o) and close("key_en", "versions_en", o) for o in kept)


def _layered(rules: dict, limit: int | None, keep: int):
    target = min(rules["target"], limit or rules["maximum"])

    def pick(pdf: pd.DataFrame) -> pd.DataFrame:
        rows, cut = _rows(pdf, keep)
        final: list = []
        chosen: list = []
        twins: set = set()
        locked = 0
        for layer in fv.SUPPLY_LAYERS:
            members = [r for r in rows if r.layer == layer]
            room = target - len(final)
            if layer != "today" and (locked >= rules["minimum"] or room <= 0):
                continue
            open_rows = []
            dropped: Counter = Counter()
            for row in members:
                # Earlier layers are references: never competitors, always a reason to drop.
                if _bilingual_twin(row, final) or duplicate_reason(row, final):
                    dropped.update((row.cls, row.grp))
                else:
                    open_rows.append(row)
            held = Counter(key for r in members for key in (r.cls, r.grp))
            if any(key in cut and dropped[key] == held[key] for key in held):
                return _result(pdf, [c for c in chosen if c[0].id not in twins], set(), complete=False)
            run = Round(open_rows, Limits(room, rules), rules, cut)
            try:
                run.run()
            except Cut:
                return _result(pdf, [c for c in chosen if c[0].id not in twins] + run.chosen(), set(), complete=False)
            kept, left = _accept(run.picks)
            chosen += run.chosen()
            twins |= {r.id for r in left}
            final += kept
            locked += len(kept) if layer == "today" else 0
        return _result(pdf, chosen, twins, complete=True)

    return pick


def _accept(picks: list) -> tuple[list, list]:
    kept: list = []
    twins: list = []
    for row in picks:
        (twins if _bilingual_twin(row, kept) else kept).append(row)
    return kept, twins


def _without_known_duplicates(pool: DataFrame, sure: DataFrame) -> DataFrame:
    """Drop rows a sure pick rules out: at most an edition's size of comparisons per row.

    A pick rules out duplicates in its own and later layers, and bilingual twins in later layers.
    """
    keys = ["fingerprint", "url_key", "title_key", "versions"]
    twins = [c for c in ("key_cn", "versions_cn", "key_en", "versions_en") if c in pool.columns]
    rank = F.array_position(F.array(*[F.lit(n) for n in ("single", *fv.SUPPLY_LAYERS)]), F.col("layer"))
    narrow = pool.select(*EDITION, "id", *keys, *twins, rank.alias("layer_rank"))
    marks = sure.join(narrow, [*EDITION, "id"]).select(*EDITION, *[
        F.col(c).alias(f"_{c}") for c in ("id", *keys, *twins, "layer_rank")])
    near = narrow.join(marks, EDITION).filter(
        (F.col("id") != F.col("_id")) & (F.col("layer_rank") >= F.col("_layer_rank")))
    exact = (F.col("fingerprint") == F.col("_fingerprint")) | (F.col("url_key") == F.col("_url_key"))

    def alike(key: str, versions: str) -> Column:
        """Ratio test behind the cheap version and length bounds (a skipped pair compares as unequal)."""
        length = F.length(key) + F.length(f"_{key}")
        open_ = ~lk.versions_conflict(F.col(versions), F.col(f"_{versions}")) & (
            F.least(F.length(key), F.length(f"_{key}")) >= length * F.lit(lk.RATIO / 2) - F.lit(1e-9))
        return lk.headline_ratio(F.when(open_, F.col(f"{key}")).otherwise(""),
                                 F.when(open_, F.col(f"_{key}")).otherwise("-"))

    tests = {"_event": alike("title_key", "versions")}
    if twins:
        tests |= {"_cn": alike("key_cn", "versions_cn"), "_en": alike("key_en", "versions_en")}
    doubles = near.withColumns(tests)
    out = exact | (F.col("_event") >= lk.RATIO)
    if twins:
        out = out | ((F.col("layer_rank") > F.col("_layer_rank")) & (F.col("_cn") >= lk.RATIO) & (F.col("_en") >= lk.RATIO))
    return pool.join(doubles.filter(out).select(*EDITION, "id").distinct(), [*EDITION, "id"], "left_anti")


def _picks(pool: DataFrame, picker, keep: int) -> tuple[DataFrame, DataFrame]:
    """The whole pool, and the chosen rows of all editions; editions stopped by a cut class run again on a thinner pool. `pool`
    is read more than once, so it comes as a written table."""
    if keep <= fv.RULES["maximum"]:
        raise ValueError("the shortlist must hold more rows per class than an edition has places")
    pool = pool.withColumn("major", F.col("importance") >= fv.RULES["major_score"]).withColumn(
        "importance_class", F.floor(F.col("importance") / 10).cast("int"))
    # Counted once: rows that leave the pool between rounds still make the day a major one.
    majors = stored(pool.groupBy(*EDITION).agg(F.count_if(F.col("major") & (F.col("level") <= 2)).alias("majors")), "majors")
    pool = whole = pool.join(broadcast_if_small(majors), EDITION)
    done: DataFrame | None = None
    while True:
        result = stored(shortlist(pool, keep).groupBy(*EDITION).applyInPandas(picker, PICK_SCHEMA), "picks")
        open_editions = result.filter("state = 'cut'").select(*EDITION)
        finished = result.join(open_editions, EDITION, "left_anti")
        done = finished if done is None else done.unionByName(finished)
        if open_editions.isEmpty():
            return whole, done
        pool = pool.join(open_editions, EDITION, "left_semi")
        pool = stored(_without_known_duplicates(pool, result.filter("state = 'sure'").select(*EDITION, "id")), "pool")


def _pick_editions(pool: DataFrame, picker, keep: int, rules: dict, limit: int | None, layered: bool) -> DataFrame:
    """The picks of all editions, then the decision on every row of the whole pool."""
    return reasons.decided(*_picks(pool, picker, keep), rules, limit, layered)


def select_edition(pool: DataFrame, rules: dict = fv.RULES, limit: int | None = None, keep: int = SHORTLIST) -> DataFrame:
    """The decision on every row of `pool` (rows without a gate): its place in the edition, or why it has none."""
    pool = stored(pool.withColumn("layer", F.lit("single")), "pool")
    return _pick_editions(pool, _greedy(rules, limit, keep), keep, rules, limit, layered=False)


def supply_layer(published_at: Column, tier: Column, deep: Column, now: Column, reserve: dict[str, Column]) -> Column:
    """today / catch_up / deep_read / evergreen; a reserve row must be eligible, cached and validated."""
    level = ru.supply_level(published_at, tier, deep, now)
    days = ru.age_days(published_at, now)
    status, layer = reserve["reserve_status"], reserve["supply_layer"]
    usable = (status == "eligible") & F.coalesce(reserve["cache_available"], F.lit(False)) & (
        reserve["validation_status"] == "passed")
    aged = (((layer == "catch_up") & (days > 1) & (days <= 3)) | ((layer == "deep_read") & (days > 3) & (days <= 30))
            | ((layer == "evergreen") & (days > 3) & (days <= 365)))
    return (F.when(level.isin(1, 2), "today")
            .when(status.isNotNull(), F.when(F.coalesce(usable & aged, F.lit(False)), layer))
            .when(level == 3, "catch_up").when(level == 4, "deep_read"))


def select_layered(pool: DataFrame, rules: dict = fv.RULES, limit: int | None = None, keep: int = SHORTLIST) -> DataFrame:
    """Layer by layer: today is locked, older layers only fill up to the target and only if today is short. The decision on
    every row, those outside all layers included.

    `pool` also holds `layer`, and per language `key_cn`, `versions_cn`, `key_en`, `versions_en`.
    """
    pool = stored(pool, "pool")  # rows inside and outside the layers are taken from one table
    placed = pool.filter(F.col("layer").isNotNull())
    out = _pick_editions(placed, _layered(rules, limit, keep), keep, rules, limit, layered=True)
    outside = pool.filter(F.col("layer").isNull()).select(
        *EDITION, "id", "layer", F.col("level").cast("int").alias("level"), "score", F.col("importance").cast("int").alias("importance"),
        F.lit(None).cast("int").alias("pick"), F.lit("dropped").alias("state"), F.lit("outside_eligible_supply_layers").alias("reason"),
        F.lit(None).cast("string").alias("duplicate_of"), F.lit(False).alias("filled"))
    return out.unionByName(outside)


def layer_metadata(decisions: DataFrame, rules: dict = fv.RULES, limit: int | None = None) -> DataFrame:
    """What the layers mean for a picked row; null for the others."""
    picked, today = F.col("state") == "picked", F.col("layer") == "today"
    target = min(rules["target"], limit or rules["maximum"])
    priority = F.array_position(F.array(*[F.lit(n) for n in fv.SUPPLY_LAYERS]), F.col("layer")).cast("int") - 1
    return decisions.select("*", *[F.when(picked, c).alias(n) for n, c in (
        ("is_today", today), ("locked_today", today), ("selected_as_fallback", ~today), ("fallback_priority", priority),
        ("deep_read", F.col("layer") == "deep_read"), ("remaining_slots_before", F.lit(target) - F.col("pick") + 1))])


def event_dedup_first(items: DataFrame, keys: list[str]) -> DataFrame:
    """First of each bilingual event, by layer and then importance; editions are small by rule (at most 18)."""

    def first(pdf: pd.DataFrame) -> pd.DataFrame:
        rank = {name: n for n, name in enumerate(fv.SUPPLY_LAYERS)}
        order = pdf.assign(_l=pdf["supply_layer"].map(lambda s: rank.get(s, 0))).sort_values(
            ["_l", "importance", "pick"], ascending=[True, False, True], kind="stable")
        order = order.assign(versions_cn=order["versions_cn"].map(tuple), versions_en=order["versions_en"].map(tuple))
        kept, _ = _accept(list(order.itertuples(index=True, name="Row")))
        return pdf.loc[[r.Index for r in kept]]

    return items.groupBy(*keys).applyInPandas(first, items.schema)


def selection_metadata(picked: DataFrame, personal=fv.RULES["personal_categories"]) -> DataFrame:
    """Section, content type and channel of the picked rows."""
    deep, major = F.col("deep"), F.col("importance") >= fv.RULES["major_score"]
    section = (F.when(deep, "deep_read").when(major, "major_tech").when(F.col("category").isin(*personal), "for_you")
               .otherwise("explore"))
    return picked.select("*", section.alias("section"), F.when(deep, "deep_read").otherwise("news").alias("content_type"),
                         (F.col("level") == 3).alias("catch_up"),
                         F.when(deep, "deep_read").otherwise(F.col("channel")).alias("shown_channel"),
                         F.round("score", 2).alias("ranking_score"))


def edition_profile(picked: DataFrame, keys: list[str], minimum: int = fv.RULES["minimum"]) -> DataFrame:
    """Sizes and spreads per edition."""
    personal = F.col("category").isin(*fv.RULES["personal_categories"])
    return picked.groupBy(*keys).agg(
        F.count("*").alias("selected"), F.countDistinct("source").alias("sources"),
        F.countDistinct("category").alias("categories"), F.count_if(~personal).alias("explore_count"),
        F.greatest(F.lit(minimum) - F.count("*"), F.lit(0)).alias("shortfall"))


def profile_counts(picked: DataFrame, keys: list[str], dimensions=("category", "channel", "source")) -> DataFrame:
    """Counts per value of each dimension, all dimensions from one pass."""
    pairs = F.explode(F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).alias("value")) for d in dimensions]))
    return picked.select(*keys, pairs.alias("p")).groupBy(*keys, "p.dimension", "p.value").agg(F.count("*").alias("n"))


def edition_diagnostics(pool: DataFrame, decisions: DataFrame, rules: dict = fv.RULES, limit: int | None = None) -> DataFrame:
    """One row per edition and value of a dimension, from one pass of grouping sets over the pool and its decisions: (feed_id,
    report_date, dimension, value, eligible, selected), dimension `edition` with the edition's own figures besides.

    `eligible` counts pool members and `selected` picks. For the edition: deep_read_candidates (pool), shortfall, explore_count,
    sources, source_limit (of a source's picks) and diversity_exception: a source has more picks, or deferred rows filled the
    edition up.
    """
    picked = F.col("state") == "picked"
    major = F.col("importance") >= rules["major_score"]
    rows = pool.join(decisions.select(*EDITION, "id", "state", "filled"), [*EDITION, "id"]).select(
        *EDITION, F.col("level").cast("string").alias("level"), "category", F.when(F.col("deep"), "deep_read").otherwise(F.col("channel")).alias("channel"), "source",
        "deep", "filled", picked.alias("picked"), major.alias("major"), (F.col("level") <= 2).alias("recent"))
    dimensions = ["level", "category", "channel", "source"]
    sets = [[F.col(c) for c in (*EDITION, d)] for d in dimensions] + [[F.col(c) for c in EDITION]]
    figures = [F.count(F.lit(1)).alias("eligible"), F.count_if("picked").alias("selected"), F.count_if("filled").alias("filled"), F.count_if("deep").alias("deep_read_candidates"),
               F.count_if(F.col("picked") & ~F.col("category").isin(*rules["personal_categories"])).alias("explore_count"),
               F.count_if(F.col("major") & F.col("recent")).alias("majors")]
    # The id of a set has a bit for each column that it leaves out.
    grouped = rows.groupingSets(sets, *EDITION, *dimensions).agg(F.grouping_id().alias("set"), *figures)
    name = F.when(F.col("set") == 15, "edition")
    value = F.lit(None).cast("string")
    for n, d in enumerate(dimensions):
        mine = F.col("set") == 15 - (8 >> n)
        name, value = name.when(mine, d), F.when(mine, F.col(d)).otherwise(value)
    counts = stored(grouped.select(*EDITION, name.alias("dimension"), value.alias("value"), *[c for c in grouped.columns if c not in (*EDITION, *dimensions, "set")]), "diagnostics")
    whole = counts.filter("dimension = 'edition'")
    places = F.least(F.when(F.col("majors") >= 10, rules["maximum"]).otherwise(rules["target"]), F.lit(limit or rules["maximum"]))
    most = F.greatest(F.lit(1), F.floor(places * F.lit(float(rules["source_share"]))).cast("int"))
    bounds = whole.select(*EDITION, most.alias("source_limit"))
    spread_ = counts.filter((F.col("dimension") == "source") & (F.col("selected") > 0)).join(bounds, EDITION).groupBy(*EDITION).agg(
        F.count("*").alias("sources"), F.max(F.col("selected") > F.col("source_limit")).alias("diversity_exception"))
    edition = whole.join(bounds, EDITION).join(spread_, EDITION, "left").select(
        *EDITION, "dimension", "value", "eligible", "selected", "deep_read_candidates", "explore_count",
        F.greatest(F.lit(rules["minimum"]) - F.col("selected"), F.lit(0)).alias("shortfall"), F.coalesce("sources", F.lit(0)).alias("sources"),
        "source_limit", (F.coalesce("diversity_exception", F.lit(False)) | (F.col("filled") > 0)).alias("diversity_exception"))
    return edition.unionByName(counts.filter("dimension <> 'edition'").select(*EDITION, "dimension", "value", "eligible", "selected"), allowMissingColumns=True)


def _in_a_row(rules: dict, keep: int, order: list):
    """Picks the editions of one feed in the order of their days, each without what the picks before it rule out, up to the first
    for which the shortlists are too short."""

    def pick(pdf: pd.DataFrame, near: pd.DataFrame) -> pd.DataFrame:
        events = "head" in pdf
        alike: dict = {}  # headlines that name a kept headline's event
        for new, kept in zip(near["new_head"], near["kept_head"]):
            alike.setdefault(kept, {kept}).add(new)

        def duplicate(row, kept) -> bool:
            return any(o.fingerprint == row.fingerprint or o.url_key == row.url_key or row.head == o.head or row.head in alike.get(o.head, ())
                       for o in kept)

        days, out, published = dict(list(pdf.groupby("report_date"))), [], []
        for n, day in enumerate(day for day in order if day in days):
            past = [r for r in published if r.report_date <= day]
            prints, links = {r.fingerprint for r in past} - {None}, {r.url_key for r in past} - {None}
            heads = set().union(*({r.head} | alike.get(r.head, set()) for r in past)) if events else set()
            rows, cut = _rows(days[day], keep)
            open_ = [r for r in rows if not (r.fingerprint in prints or r.url_key in links or events and r.head in heads)]
            recent = [sum(r.major and r.level <= 2 for r in some) for some in (rows, open_)]
            most = rows[0].majors - (recent[0] - recent[1])  # what the shortlist left out may be ruled out too
            held, left = (Counter(key for r in some for key in (r.cls, r.grp)) for some in (rows, open_))
            run, complete = Round(open_, Limits(min(rules["maximum"], rules["maximum"] if most >= 10 else rules["target"]), rules), rules, cut,
                                  duplicate if events else duplicate_reason), False
            if not any(key in cut and not left[key] for key in held) and (n == 0 or most < 10 or recent[1] >= 10):
                try:
                    run.run()
                    complete = True
                except Cut:
                    pass
            out.append(_result(days[day], run.chosen(), set(), complete))
            if not complete:
                break
            published += run.picks
        return pd.concat(out) if out else _result(pdf, [], set(), True)

    return pick


def _without_published(pool: DataFrame, picked: DataFrame, pairs: DataFrame | None) -> DataFrame:
    """Drops what picks of the same day or before rule out; `picked` holds their keys."""
    def older(known: DataFrame, key: str) -> DataFrame:
        return pool.join(known, ["feed_id", key], "left").filter(F.coalesce(F.col("since") > F.col("report_date"), F.lit(True))).drop("since")

    for key in ("fingerprint", "url_key"):
        pool = older(first_published(picked, [key], "since"), key)
    if pairs is None:
        return pool
    first = first_published(picked, ["head"], "since").withColumnRenamed("head", "kept_head")
    return older(pairs.join(first, ["feed_id", "kept_head"]).groupBy("feed_id", F.col("new_head").alias("head")).agg(F.min("since").alias("since")), "head")


def _pick_in_a_row(pool: DataFrame, pairs: DataFrame | None, order: list, rules: dict, keep: int) -> DataFrame:
    """The chosen rows of all editions of `pool`, whose days follow each other in `order`: each day's picks are history for the
    next. A feed whose shortlists ran short goes on from that day, after the duplicates of all picks so far left its pool.
    `pairs` are event pairs by digests of the headlines (feed_id, new_head, kept_head)."""
    if keep <= fv.RULES["maximum"]:
        raise ValueError("the shortlist must hold more rows per class than an edition has places")
    order = [dt.date.fromisoformat(str(day)[:10]) for day in order]
    place = F.array_position(F.array(*[F.lit(day).cast("date") for day in order]), F.col("report_date"))
    keys = ["head"] if pairs is not None else ["title_key", "versions"]
    done, sure = None, None
    while True:
        # Duplicates of an edition's own picks leave its pool between rounds, and still make its day a major one.
        majors = pool.groupBy(*EDITION).agg(F.count_if(F.col("major") & (F.col("level") <= 2)).alias("majors"))
        rows = pool if sure is None else _without_known_duplicates(pool, sure)
        rows = rows.join(broadcast_if_small(stored(majors, "majors")), EDITION).select(
            *EDITION, "id", *CLASS, "score", "published_at", "fingerprint", "url_key", *keys, "majors")
        rows = stored(shortlist(rows, keep), "shortlist")
        if pairs is None:
            near = rows.limit(0).select("feed_id", F.lit("").alias("new_head"), F.lit("").alias("kept_head"))
        else:
            heads = rows.select("feed_id", "head").distinct()
            near = pairs.filter("new_head <> kept_head")
            for side in ("new_head", "kept_head"):
                near = near.join(heads.withColumnRenamed("head", side), ["feed_id", side], "left_semi")
        picks = rows.groupBy("feed_id").cogroup(near.groupBy("feed_id")).applyInPandas(_in_a_row(rules, keep, order), PICK_SCHEMA)
        result = stored(picks, "picks")
        chosen = result.filter("state = 'chosen'")
        done = chosen if done is None else done.unionByName(chosen)
        cut = result.filter("state = 'cut'").select("feed_id", place.alias("from"))
        if cut.isEmpty():
            return done
        sure = result.filter("state = 'sure'").select(*EDITION, "id")
        published = chosen.select(*EDITION, "id").join(pool.select(*EDITION, "id", "fingerprint", "url_key", *keys), [*EDITION, "id"])
        pool = pool.join(cut, "feed_id").filter(place >= F.col("from")).drop("from")
        pool = stored(_without_published(pool, published, pairs), "pool")


def replay_editions(features: DataFrame, history: DataFrame, dates: list, folder: str, rules: dict = fv.RULES, events: bool = True,
                    keep: int = SHORTLIST) -> DataFrame:
    """Day after day, each day's picks become history for the next; every step covers all feeds. Returns feed_id, report_date,
    id and pick of all days.

    The picks are a table under `folder`, one partition a day, written once. Up to `DAYS_AT_ONCE` days have one pool, from which
    each feed's editions are picked in a row; then they are written. A day that was written is not run again, so a replay that was
    broken off goes on where it stopped. Event pairs among all headlines that can become history are found once, before the first
    day, and each day only looks up which of them are published by then.
    """
    spark = features.sparkSession
    cols = ["feed_id", "report_date", "fingerprint", "url_key", "title_key", "versions"]
    before = stored(keyed_history(history).select(*cols), "history")
    keys = features.select("feed_id", "id", "fingerprint", "url_key", "title_key", "versions")
    feeds = stored(features.select("feed_id").distinct(), "feeds")
    days_path = f"{folder.rstrip('/')}/days"
    schema = "feed_id int, id string, pick int, day date"

    def head(key: str, versions: str) -> Column:
        return F.md5(F.concat_ws("\n", F.col(key), F.col(versions)))

    def read(days: list) -> DataFrame:  # only the folders of days that count are listed
        return spark.read.schema(schema).option("basePath", days_path).parquet(*[f"{days_path}/day={d}" for d in days])

    pairs = by_head = None
    done: list = []

    def run(days: list) -> None:
        nonlocal pairs, by_head
        if events and pairs is None:
            # Only what passes every gate can be picked and become history.
            can_be_picked = comparable(features).filter(~(F.col("cached") & (F.coalesce("importance", F.lit(0)) < 60)))
            heads = can_be_picked.select("feed_id", "title_key", "versions").unionByName(before.select("feed_id", "title_key", "versions"))
            pairs = stored(lk.event_pairs(comparable(features), heads, ["feed_id"]), "pairs")
            by_head = pairs.select("feed_id", head("new_key", "new_versions").alias("new_head"), head("kept_key", "kept_versions").alias("kept_head"))
        past = before
        if done:
            past = past.unionByName(read(done).join(keys, ["feed_id", "id"]).withColumnRenamed("day", "report_date").select(*cols))
        open_days = F.explode(F.array(*[F.lit(day).cast("date") for day in days])).alias("report_date")
        editions = feeds.select("feed_id", open_days).withColumn("now_ts", F.col("report_date").cast("timestamp"))
        # Nothing published outside the days' windows reaches their pools, so it is left out before the joins.
        near = features.filter(F.col("published_date").between(
            F.date_sub(F.lit(min(days)).cast("date"), -(-fv.WINDOW_HOURS // 24) + 1), F.date_add(F.lit(max(days)).cast("date"), 1)))
        pool = candidate_pool(near, editions, past, events=events, pairs=pairs).filter("gate is null").withColumns({
            "layer": F.lit("single"), "major": F.col("importance") >= fv.RULES["major_score"],
            "importance_class": F.floor(F.col("importance") / 10).cast("int"), "head": head("title_key", "versions")})
        pool = stored(pool.select(*EDITION, "id", *CLASS, "score", "published_at", "fingerprint", "url_key", "title_key", "versions", "head"), "pool")
        picked = _pick_in_a_row(pool, by_head, days, rules, keep).filter("pick is not null")
        for day in days:  # what a broken-off replay left of them
            delete_folder(spark, f"{days_path}/day={day}")
        picked.select("feed_id", "id", "pick", F.col("report_date").alias("day")).repartition("day").write.mode("append").partitionBy("day").parquet(days_path)
        for day in days:
            _mark(spark, f"{days_path}/day={day}/_SUCCESS")
        done.extend(days)

    waiting: list = []
    for day in dates:
        written = day in waiting or _exists(spark, f"{days_path}/day={day}/_SUCCESS")
        if waiting and (written or len(waiting) == DAYS_AT_ONCE):
            run(waiting)
            waiting = []
        if written:
            done.append(day)
        else:
            waiting.append(day)
    if waiting:
        run(waiting)
    if not done:
        return spark.createDataFrame([], "feed_id int, report_date date, id string, pick int")
    return read(done).select("feed_id", F.col("day").alias("report_date"), "id", "pick")


def _mark(spark, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True).close()


def _exists(spark, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)
