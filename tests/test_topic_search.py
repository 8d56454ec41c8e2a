"""Terms are tried only where their letters stand, and none is lost by that."""

import random

from pyspark.sql import functions as F

from broadsheet import fixed_values as fv
from broadsheet.functions import rules as ru
from broadsheet.functions import text as tx


def test_stems_are_only_tried_where_their_letters_stand(spark):
    dice = random.Random(8)
    stems = fv.TOPIC_STEMS + "|" + fv.WIDE_TOPIC_STEMS
    words = [*[s.rstrip("?") for s in stems.split("|")], "ſociety", "SKİLL", "ſKıll", "plain", "en", "er", "科", "x"]
    rows = spark.createDataFrame([(dice.choice(words)[:dice.randint(1, 12)] + dice.choice(words)[dice.randint(0, 3):],) for _ in range(3000)], "t string")
    assert tx.begun(stems)
    apart = ru.on_topic(F.col("t"), "nosuchword", stems) != F.col("t").rlike(f"(?iu)({stems})")
    counts = rows.agg(F.count_if(apart).alias("apart"), F.count_if(ru.on_topic(F.col("t"), "nosuchword", stems)).alias("held")).first()
    assert counts.apart == 0 and 0 < counts.held < 3000
    assert tx.begun("a?b|cd") == "" and tx.begun("(ab)|cd") == ""


def test_words_between_borders_are_found_as_before(spark):
    dice = random.Random(9)
    parts = [*fv.TOPIC_WORDS.split("|"), "AI", "aİ", "ſpace", "the", "_", "9", " ", "\n", "é", "科", "\U0001d400", "-", ". "]
    rows = spark.createDataFrame([("".join(dice.choice(parts) for _ in range(dice.randint(1, 4))),) for _ in range(4000)], "t string")
    for words in (fv.TOPIC_WORDS, "the|and|est"):
        before, now = tx.matches(F.col("t"), tx.bounded(words)), tx.matches(F.col("t"), tx.some_word(words))
        counts = rows.agg(F.count_if(before != now).alias("apart"), F.count_if(now).alias("held")).first()
        assert counts.apart == 0 and 0 < counts.held < 4000
