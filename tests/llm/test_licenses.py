"""Canonical licence texts."""

from pyspark.sql import functions as F

from broadsheet.llm import licenses as li
from tests.llm.edges import documents as edge_documents
from tests.llm.edges import order

MIT = next(t for n, t in li.KNOWN if n == "MIT" and t.startswith("Permission"))


def test_equivalent_texts_have_one_digest(spark):
    texts = [(1, MIT), (2, "Copyright (c) 2020 Somebody\n\n" + MIT.upper()), (3, MIT.replace("sublicense", "sublicence").replace(",", " ,").replace("\n", "\n\n  ")),
             (4, "© Somebody. All rights reserved.\n" + MIT + "\n"), (5, MIT + " and more"), (6, "text\nReleased under the MIT licence\ntext"),
             (7, MIT.replace("COPYRIGHT HOLDERS", "copyright holders"))]
    got = {r.doc_id: (r.license, r.whole, r.first_line) for r in li.scan(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert got == {k: ("MIT", True, 0) for k in (1, 2, 3, 4, 7)} | {6: ("MIT", False, 2)}


def test_a_given_list_and_edges(spark):
    docs = edge_documents(spark)
    known = [("tale", "ONE two: three four five"), ("tale-2", "one two three four five!"), ("void", " -- ")]
    got = li.scan(docs, known).collect()
    assert order(got) == order([(5, "tale", True, 0), (3, "tale", True, 0)])
    assert li.scan(docs).count() == 0 and li.scan(docs.filter("false")).count() == 0
    assert spark.range(1).select(li.canonical(F.lit(None).cast("string"))).first()[0] is None


def test_every_spelling_both_ways(spark):
    pairs = [*li.SPELLINGS, *((f"{a} {b}", one) for a, b, one in li.PAIRS), *((f"{a}-{b}", one) for a, b, one in li.PAIRS)]
    rows = [(k, f"10 {a} {a}, {a}.", f"10 {b.upper()} {b}; {b}") for k, (a, b) in enumerate(pairs)]
    frame = spark.createDataFrame(rows, "k int, a string, b string")
    for r in frame.select("k", li.canonical(F.col("a")).alias("a"), li.canonical(F.col("b")).alias("b")).collect():
        assert r.a == r.b and "  " not in r.a, pairs[r.k]
    for a, b in pairs:
        found = li.scan(spark.createDataFrame([(1, f"{a} is meant"), (2, f"{b} is meant")], "doc_id long, text string"), [("x", f"{b} is meant")])
        assert found.count() == 2, (a, b)
        break


def test_other_scripts_are_text(spark):
    docs = spark.createDataFrame([(1, "не Released under the MIT License. 漢字"), (2, "Released under the MIT License."), (3, "é Released under the MIT License")], "doc_id long, text string")
    assert [(r.doc_id, r.whole) for r in li.scan(docs).collect()] == [(2, True)]


def test_licences_below_and_between_other_text(spark):
    isc = next(t for n, t in li.KNOWN if n == "ISC")
    words = MIT.split(" ")
    wrapped = "\n".join(" ".join(words[k:k + 9]) for k in range(0, len(words), 9))
    texts = [(1, "An introduction.\n\n" + isc + "\n\nAn end"), (2, "Top\nCopyright (c) 2001 X\n\n" + MIT.replace("\n", "\n\n") + "\nmore"),
             (3, "Intro\n\n" + wrapped + "\n\nEnd"), (4, "Intro\n" + isc.split("\n")[0]), (5, None), (6, "")]
    got = {r.doc_id: (r.license, r.whole, r.first_line) for r in li.scan(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert got == {1: ("ISC", False, 3), 2: ("MIT", False, 4), 3: ("MIT", False, 3)}


def test_known_texts_as_a_table(spark):
    known = spark.createDataFrame([(f"l{k}", f"notice {k} holds") for k in range(50)] + [("none", None), ("empty", "--")], "license string, text string")
    docs = spark.createDataFrame([(1, "x\nNotice 7: holds!"), (2, "notice 70 holds")], "doc_id long, text string")
    assert [(r.doc_id, r.license) for r in li.scan(docs, known).collect()] == [(1, "l7")]
    assert li.scan(docs, known.filter("false")).count() == 0
