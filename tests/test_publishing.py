"""Edition documents, legacy pairs, digests and review evidence."""

import hashlib
import json

from pyspark.sql import functions as F

from broadsheet.operators import publishing as pb
from broadsheet.operators import reserve as rs
from broadsheet.operators.ledger import flatten_usage

ITEM = "struct<title_original:string,title_cn:string,title_en:string,what_happened_en:string,what_happened:string,why_it_matters_en:string,why_it_matters:string>"
PAIR = ("e", "中", "we", "wz", "me", "mz")


def test_pairs_apply_only_to_complete_editions(spark):
    items = [("o1", "old", None, None, None, None, None), ("o2", "old", None, None, None, None, None)]
    editions = spark.createDataFrame([("d1", items), ("d2", items)], f"report_date string, items array<{ITEM}>")
    pairs = spark.createDataFrame([("d1", 0, *PAIR), ("d1", 1, *PAIR), ("d2", 0, *PAIR), ("d2", 2, *PAIR)],
                                  "report_date string, pos int, " + ", ".join(f"{c} string" for c in pb.PAIR_FIELDS))
    rows = pb.merge_pairs_by_id(editions, pairs, ["report_date"]).collect()
    assert [r.report_date for r in rows] == ["d1"] and rows[0].schema_version == 3
    assert [(i.title_original, i.title_cn, i.why_it_matters) for i in rows[0]["items"]] == [("o1", "中", "mz"), ("o2", "中", "mz")]


def test_digest_is_the_sorted_compact_json(spark):
    df = spark.createDataFrame([("2026-09-14", 1, [(2, "标题", None)])], "report_date string, article_count int, items array<struct<z:int,a:string,b:string>>")
    got = df.select(pb.edition_digest(df, ["report_date", "article_count", "items"]).alias("d")).first()["d"]
    text = json.dumps({"report_date": "2026-09-14", "article_count": 1, "items": [{"z": 2, "a": "标题", "b": None}]}, ensure_ascii=False, sort_keys=True, separators=(",", ":"))
    assert got == hashlib.sha256(text.encode()).hexdigest()[:32]


def test_index_replaces_the_same_date(spark):
    old = spark.createDataFrame([("d1", 1), ("d2", 1)], "report_date string, article_count int")
    new = spark.createDataFrame([("d2", 9), ("d3", 9)], "report_date string, article_count int")
    assert [tuple(r) for r in pb.edition_index(old, new, ["report_date"]).collect()] == [("d3", 9), ("d2", 9), ("d1", 1)]


def test_rewriting_a_date_leaves_the_others(spark, tmp_path):
    def edition(day, title):
        return spark.createDataFrame([(1, [(title,)], day)], "feed_id int, items array<struct<title:string>>, report_date string").withColumn(
            "report_date", F.col("report_date").cast("date"))

    path = str(tmp_path / "editions")
    for day, title in (("2026-01-01", "a"), ("2026-01-02", "b"), ("2026-01-02", "c"), ("2026-01-05", "late")):
        pb.write_editions(edition(day, title), path)
    past = pb.read_history(spark, path, edition("2026-01-01", "x").schema, F.lit("2026-01-03").cast("date"))
    assert sorted(r.title for r in past.collect()) == ["a", "c"]


def test_review_evidence_wins(spark):
    df = spark.createDataFrame([("a", '{"policy_checked_at":"2026","current_applicability_verified":true}', "old"), ("b", None, "old")],
                               "article_id string, review_evidence_json string, policy_checked_at string")
    got = {r.article_id: (r.policy_checked_at, r.current_applicability_verified) for r in rs.merge_evidence(df).collect()}
    assert got == {"a": ("2026", True), "b": ("old", None)}


def test_usage_keeps_the_raw_object(spark):
    raw = '{"prompt_tokens":3,"total_tokens":5,"completion_tokens_details":{"reasoning_tokens":1},"vendor":{"x":1}}'
    row = flatten_usage(spark.createDataFrame([(raw,)], "raw_usage_json string")).first()
    assert (row.input_tokens, row.output_tokens, row.total_tokens, row.reasoning_tokens, row.raw_usage_json) == (3, None, 5, 1, raw)
