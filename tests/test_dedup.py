"""Admission by two keys at once, and picks that a cut shortlist must not change."""

import datetime as dt
import random

from pyspark.sql import functions as F

from broadsheet.operators import dedup as dd
from broadsheet.operators import selection as se
from tests.test_selection import SCHEMA, picks, row

NOW = dt.datetime(2026, 9, 20)


def one_by_one(rows):
    urls, prints, out = set(), set(), []
    for seq, url, key, when in sorted(rows, key=lambda r: (-r[3].timestamp(), r[0])):
        if url not in urls and key not in prints:
            urls.add(url)
            prints.add(key)
            out.append(seq)
    return sorted(out)


def test_rows_are_admitted_one_by_one(spark):
    for seed in range(4):
        rng = random.Random(seed)
        rows = [(n, f"u{rng.randint(0, 25)}", f"f{rng.randint(0, 25)}", NOW - dt.timedelta(hours=rng.randint(0, 9))) for n in range(80)]
        batch = spark.createDataFrame(rows, "seq long, original_url string, fingerprint string, published_at timestamp")
        assert sorted(r.seq for r in dd.new_articles(batch, batch.limit(0)).collect()) == one_by_one(rows)


def test_same_url_twice_in_one_batch_is_appended_once(spark):
    batch = spark.createDataFrame([(1, "u", "a", NOW), (2, "u", "b", NOW)], "seq long, original_url string, fingerprint string, published_at timestamp")
    assert [r.seq for r in dd.new_articles(batch, batch.limit(0)).collect()] == [1]


def test_majors_are_counted_on_the_whole_pool(spark):
    rows = [row(n, importance=90, fp="copied", title="same headline") for n in range(40)] + [row(100 + n, importance=70, category=("science", "ai", "chips", "software")[n % 4]) for n in range(50)]
    pool = spark.createDataFrame(rows, SCHEMA)
    want = picks(se.select_edition(pool, keep=64))
    assert len(want[0]) == 18 and picks(se.select_edition(pool, keep=19)) == want


NULLS = "seq long, original_url string, fingerprint string, published_at timestamp, published_date date"


def test_nulls_are_no_keys(spark):
    rows = [(1, None, "a", NOW), (2, None, "a", NOW), (3, None, None, NOW), (4, "u", None, NOW), (5, "u", None, None), (6, None, None, None), (7, "u", "b", NOW)]
    batch = spark.createDataFrame([(*r, NOW.date()) for r in rows], NULLS)
    assert sorted(r.seq for r in dd.new_articles(batch, batch.limit(0)).collect()) == [1, 3, 4, 6]
    assert sorted(r.seq for r in dd.new_articles(batch, batch.filter("seq = 7")).collect()) == [1, 3, 6]


def test_long_chains_and_many_collisions(spark, monkeypatch):
    chain = [(n, f"u{(n + 1) // 2}", f"f{n // 2}", NOW - dt.timedelta(minutes=n)) for n in range(300)]
    rng = random.Random(11)
    dense = [(1000 + n, f"v{rng.randint(0, 9)}", f"g{rng.randint(0, 9)}", NOW - dt.timedelta(hours=rng.randint(0, 3))) for n in range(200)]
    batch = spark.createDataFrame(chain + dense, "seq long, original_url string, fingerprint string, published_at timestamp")
    assert sorted(r.seq for r in dd.first_of_both(batch).collect()) == one_by_one(chain + dense)
    monkeypatch.setattr(dd, "LAST_ROWS", 290)  # further rounds before the rest is small
    assert sorted(r.seq for r in dd.first_of_both(batch).collect()) == one_by_one(chain + dense)


def test_appends_through_the_key_index(spark):
    from broadsheet.session import new_folder
    from broadsheet.sources import keys, tables

    rng = random.Random(5)
    path = new_folder(spark, "table")
    rows = [(n, rng.choice([None, f"u{rng.randint(0, 60)}"]), rng.choice([None, f"f{rng.randint(0, 60)}"]), NOW - dt.timedelta(hours=n), NOW.date()) for n in range(120)]
    tables.write_articles(spark.createDataFrame(rows[:20], NULLS), path)
    held = [r[0] for r in rows[:20]]
    urls, prints = {r[1] for r in rows[:20]} - {None}, {r[2] for r in rows[:20]} - {None}
    for at in (20, 50, 80):
        tables.append_articles(spark.createDataFrame(rows[at:at + 40], NULLS), path)
        for r in rows[at:at + 40]:  # newest first is their order
            if r[1] not in urls and r[2] not in prints:
                held.append(r[0])
                urls |= {r[1]} - {None}
                prints |= {r[2]} - {None}
        assert sorted(r.seq for r in spark.read.parquet(path).collect()) == sorted(held)
        assert keys.unknown(spark.createDataFrame([(999, next(iter(urls)), "new", NOW, NOW.date())], NULLS), path).count() == 0
    before = {(r.kind, bytes(r.digest)) for r in keys.read_keys(spark, path, list(range(keys.BUCKETS))).collect()}
    assert len(before) == len(urls) + len(prints)
    merged = spark.read.parquet(keys.compact_keys(spark, path))
    assert {(r.kind, bytes(r.digest)) for r in merged.collect()} == before and merged.filter("part <> 0").isEmpty()


def test_only_touched_buckets_are_read(spark):
    from broadsheet.session import new_folder
    from broadsheet.sources import keys

    path = new_folder(spark, "table")
    keys.write_keys(spark.createDataFrame([(n, f"u{n}", f"f{n}", NOW, NOW.date()) for n in range(400)], NULLS), path, 1)
    one = keys.digests(spark.createDataFrame([(1, "u5", None, NOW, NOW.date())], NULLS)).first().bucket
    read = keys.read_keys(spark, path, [one]).select(F.input_file_name().alias("f")).distinct().collect()
    assert {r.f.split("bucket=")[1].split("/")[0] for r in read} == {str(one)}
