"""Evidence and short-lived topics are sought only in texts that hold a part of them, and none is lost by that."""

import random
import time

from pyspark.sql import functions as F

from broadsheet import fixed_values as fv
from broadsheet.functions import rules as ru

WORDS = ["Works by", "Underlying Mechanism", "principles of", "Principle of", "PRİNCIPLE OF", "工作原理", "作用机制", "推导过程", "methodology", "implementation detailſ",
         "step by step", "STEP-BY-STEP", "ſtep\nby step", "工程实践", "实现步骤", "具体方法", "```", " def run(", "function go(", "Pip ınstall", "代码示例", "comparative analysis",
         "Experimental Results", "SYSTEMATIC REVIEW", "实验结果", "系统综述", "对比分析", "step 1", "Step\t2", "ſtep 3", "步骤一", "步骤 二", "step", "flash sale", "FLAſH sale", "discount",
         "Promotion", "stocK price", "shares rose", "Shares fell", "shares", "outage", "security incident", "launch event", "product launch", "announce new", "announces the new",
         "发布会", "促销", "股价", "临时故障", "安全事件", "限时", "抽奖", "plain", "words", "İ"]


def evidence_as_it_was(text):
    found = [F.struct(F.lit(kind).alias("key"), F.regexp_extract(text, f"(?iu)({pattern})", 0).alias("value")) for kind, pattern in fv.DEEP_EVIDENCE]
    steps = F.array_sort(F.array_distinct(F.regexp_extract_all(text, F.lit("(?iu)" + fv.NUMBERED_STEP), 1)))
    numbered = F.struct(F.lit("procedural_steps").alias("key"), F.when(F.size(steps) >= 2, F.array_join(steps, ",")).otherwise("").alias("value"))
    kinds = F.map_filter(F.map_from_entries(F.array(*found, numbered)), lambda _, v: v != "")
    return F.when(F.size(kinds) >= 2, F.to_json(kinds)).otherwise("{}")


def test_same_evidence_and_topics_as_by_patterns_alone(spark):
    dice = random.Random(11)
    rows = spark.createDataFrame([(" ".join(dice.choice(WORDS) for _ in range(dice.randint(1, 5))) + " . " * 600,) for _ in range(4000)], "t string")
    t = F.col("t")
    out = rows.select(F.to_json(ru.deep_evidence(t, F.lit(1))).alias("now"), evidence_as_it_was(t).alias("old"),
                      ru.short_lived(t).alias("short"), t.rlike(f"(?iu)({fv.SHORT_LIVED})").alias("short_old"))
    got = out.selectExpr("count_if(now <> old) AS apart", "count_if(old <> '{}') AS held", "count_if(short <> short_old) AS short_apart",
                         "count_if(short_old) AS short_held").first()
    assert got.apart == 0 and got.short_apart == 0
    assert 500 < got.held < 3500 and 500 < got.short_held < 3900


def test_long_texts_without_a_part_are_passed_over(spark):
    """Twice as fast as by the patterns alone or more; less is asked for, as times vary."""
    body = F.concat(F.repeat(F.lit("a plain sentence about something else entirely, said at length. "), 280), F.col("id").cast("string"))
    rows = spark.range(2500).select(body.alias("t")).cache()
    rows.count()

    def seconds(*columns):
        best = []
        for _ in range(3):
            started = time.perf_counter()
            rows.select(*columns).write.format("noop").mode("overwrite").save()
            best.append(time.perf_counter() - started)
        return min(best)

    t = F.col("t")
    now = seconds(ru.deep_evidence(t, F.lit(1)), ru.short_lived(t))
    assert now < seconds(evidence_as_it_was(t), t.rlike(f"(?iu)({fv.SHORT_LIVED})")) * 0.8
    rows.unpersist()
