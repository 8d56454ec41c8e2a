"""Guards that spare searches may lose no occurrence, and names are sought in a few texts at a time."""

import random

import pyarrow as pa
from pyspark.sql import functions as F

from broadsheet.functions import facts as fc

PARTS = ["1,000", "12", "3.5", "2024-05-06", "2024年5月6日", "5月6日和7日", "2024年 5 月", "12:30", "v1.2.3", "%", "percent", "mİllion", "ſeven", "ſteps",
         "two", "loops", "3rd", "21 ſt", "June", "June 5", "maY 5 and 7", "Jun. 5-7, 2024", "ſept 2024", "dec", "２０２４", "不支持", "可以使用", "两圈", "Ｋ", "K",
         "not supported", "will release", "ſhips", "\n", " ", " ", "-", "x", "word", "plain text"]
NOTATIONS = {**{f"number {k}": n for k, n in fc.NUMBER.items()}, "ordinal": fc.ORDINAL, "counted": fc.COUNTED, "scaled": fc.SCALED, "counted zh": fc.COUNTED_ZH,
             "clock": fc.CLOCK, "version": fc.VERSION, **{f"date {k}": n for k, n in enumerate(fc.DATES)},
             **{f"available {k}": n for k, n in fc.AVAILABLE.items()}}


def _texts(spark):
    dice = random.Random(7)
    rows = ["".join(dice.choice(PARTS) + dice.choice(["", " ", " "]) for _ in range(dice.randint(0, 9))) for _ in range(1500)]
    return spark.createDataFrame([(t,) for t in [*rows, "no such thing in here", None]], "t string").repartition(4)


def test_what_a_notation_needs_and_begins_with_loses_nothing(spark):
    rows = _texts(spark)
    for name, n in NOTATIONS.items():
        flags, rest = n.pattern.split(")", 1)
        assert n.needs.startswith(flags + ")")
        plain = F.regexp_extract_all("t", F.lit(flags + ")" + rest.removeprefix(n.first)), F.lit(0))
        counts = rows.agg(F.count_if(~n.pieces(F.col("t")).eqNullSafe(plain)).alias("apart"), F.count_if(F.size(plain) > 0).alias("held")).first()
        assert counts.apart == 0 and counts.held > 0, name


def test_names_are_found_in_texts_beyond_the_first_few():
    n = 2 * fc.AT_ONCE + 5
    texts = pa.array([None if k % 7 == 0 else f"about name{k}, and ÉTÉ{k}" for k in range(n)])
    names = pa.array([None if k % 11 == 0 else [f"Name{k}", f"été{k}", f"name{k + 1}"] for k in range(n)])
    assert fc._named.func(texts, names).to_pylist() == [
        [] if k % 7 == 0 or k % 11 == 0 else [f"Name{k}", f"été{k}"] for k in range(n)]
