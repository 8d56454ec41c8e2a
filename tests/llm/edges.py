"""Rows that every operator has to stand: nulls, empty and long texts, ties, repeated rows, clashing column names."""

SENTENCE = "the quick brown fox jumps over the lazy dog while seven wizards quietly mix a jar of blue ink before dawn "
ROWS = [
    (5, "One two three four five"), (3, "one two THREE four five"), (9, ""), (8, None), (7, " \t\n\x0b"), (None, SENTENCE * 3),
    (None, "quite alone here"), (4, "x"), (4, "x"), (6, "É é <|endoftext|> 漢字 \u0085 tail"), (2, "word " * 30_000), (1, SENTENCE * 3),
    (11, "intro words first\n" + SENTENCE * 3 + "\nand an end"), (12, SENTENCE * 4), (12, SENTENCE * 4), (-3, "minus three"), (10**15, "far away"),
]
SCHEMA = "doc_id long, text string"
CLASHES = ("id", "fp", "key", "size", "tie", "bin", "seen", "block", "node", "comp", "digest", "start", "n_words", "shard", "host", "line", "source_size",
           "_id", "_key", "_node", "_rows", "_tie", "_copies", "_copy")


def documents(spark, rows=ROWS):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, SCHEMA)
    sources = F.when(F.col("doc_id").isNull(), None).otherwise(F.concat(F.lit("s"), (F.pmod("doc_id", F.lit(3))).cast("string")))
    df = df.withColumns({"lang": F.lit("en"), "source": sources, "n_chars": F.length("text").cast("long")})
    return df.withColumns({c: F.lit("clash") for c in CLASHES})


def order(rows):
    return sorted((tuple(r) for r in rows), key=repr)
