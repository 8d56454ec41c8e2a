"""The beginning of a clean text, without cleaning all of it."""

import random

from pyspark.sql import functions as F

from broadsheet.functions import text as tx


def texts():
    rng = random.Random(6)
    words = ["the", "tion", "über", "a&amp;b", "芯片", "x" * 30, "&lt;p&gt;", "end."]
    out = [None, "", " ", "a" * 2249, "a" * 2250, "a" * 2251, "a" * 5000, "b " * 1125, "b " * 3000, "　".join(["w"] * 4000), "& " * 2000]
    for n in range(60):
        some = [rng.choice(words) + str(rng.randint(0, 400)) for _ in range(rng.randint(1, 1200))]
        if n % 3 == 0:
            some = some[:18] * rng.randint(1, 30) + some
        out.append("".join(w + rng.choice((" ", "  ", "\n", "\t  ")) for w in some))
    return out


def test_head_equals_the_head_of_the_clean_text(spark):
    frame = spark.createDataFrame([(t,) for t in texts()], "t string")
    for size in (10, 1500):
        rows = frame.select("t", tx.clean_head(F.col("t"), size).alias("got"), F.substring(tx.clean_text(F.col("t")), 1, size).alias("want")).collect()
        assert [r.got for r in rows] == [r.want for r in rows]


def test_fingerprint_takes_the_beginning_first(spark):
    frame = spark.createDataFrame([("t",)], "t string")
    plan = frame.select(tx.fingerprint(F.col("t"), F.col("t")))._jdf.queryExecution().analyzed().toString()
    assert ", 1, 2250)" in plan
