"""Facts in text and bilingual validation over the cached renderings."""

from __future__ import annotations

from pyspark.sql import functions as F

from broadsheet import fixed_values as fv
from broadsheet.functions import facts as fc
from broadsheet.operators import validation as va
from broadsheet.plans import views as v
from broadsheet.plans.catalog import query
from broadsheet.session import stored


def _documents(spark, sf):
    from broadsheet.session import spread

    return spread(v.table(spark, sf, "documents"))


def _joined(kind, language="en"):
    def run(spark, sf):
        return _documents(spark, sf).select("doc_id", F.array_join(fc.fact_set(kind, F.col("text"), language), ",").alias(kind))

    return run


query("time_set", r"""
SELECT doc_id, array_to_string(list_sort(list_distinct(list_transform(regexp_extract_all(regexp_replace(' ' || text || ' ', '(\d)(\D)', '\1\2\2', 'g'),
 '(^|\D)((?:[01]?\d|2[0-3]):[0-5]\d)(\D|$)', 2), lambda t: t))), ',') AS times FROM documents""")(_joined("times"))
# Every border is doubled, so that two neighbouring terms do not share one.
query("availability_set", r"""
SELECT doc_id, array_to_string(list_sort(list_distinct(list_transform(regexp_extract_all(' ' || regexp_replace(lower(text), '([^\p{L}\p{N}_])', '\1\1', 'g') || ' ',
 '[^\p{L}\p{N}_](does  not  support|not  supported|unavailable|available|supports?|released|release|ships?|will  release|planned)[^\p{L}\p{N}_]', 1),
 lambda t: CASE WHEN t IN ('does  not  support', 'not  supported', 'unavailable') THEN 'unsupported' WHEN t IN ('will  release', 'planned') THEN 'planned'
  WHEN t IN ('release', 'released', 'ship', 'ships') THEN 'released' ELSE 'supported' END))), ',') AS availability FROM documents""")(_joined("availability"))
for _kind, _name in (("numbers", "number_set"), ("dates", "date_set"), ("versions", "version_literals")):
    query(_name)(_joined(_kind))
query("number_set_zh")(_joined("numbers", "zh"))
query("availability_set_zh")(_joined("availability", "zh"))


def _facts(doc, text, headline):
    """Facts drawn from an article: its first long words as names of several types, and its headline's first two words, which
    some articles call the other way round in the second rendering."""
    words = F.slice(F.array_distinct(F.regexp_extract_all(text, F.lit(r"\p{L}{8,}"), F.lit(0))), 1, 4)
    types = F.array(*[F.lit(t) for t in ("product", "Company", "person", "technology")])
    heads = F.slice(F.regexp_extract_all(headline, F.lit(r"[\p{L}\p{N}]+"), F.lit(0)), 1, 2)

    def fact(name, kind, value, english, chinese):
        return F.struct(name.alias("id"), kind.alias("type"), value.alias("value"), F.array(F.lit("title")).alias("rendered_in"),
                        english.alias("english_forms"), chinese.alias("chinese_forms"))

    named = F.transform(words, lambda w, i: fact(F.concat(F.lit("w"), i), F.get(types, i), w, F.array(w), F.array(F.upper(w), F.concat(F.lit("《"), w, F.lit("》")))))
    there, back = F.array_join(heads, " "), F.array_join(F.reverse(heads), ", ")
    phrase = fact(F.lit("h"), F.lit("institution"), there, F.array(there), F.array(F.when(doc % 5 == 0, back).otherwise(there)))
    return F.concat(named, F.when(F.size(heads) == 2, F.array(phrase)).otherwise(F.slice(F.array(phrase), 1, 0)))


def rendered(spark, sf):
    """Cached renderings of the labelled articles with a shared fact schema: the halves of the whole text are the English
    fields, and the Chinese ones repeat them, unless a turn of a conversation takes the place of one."""
    doc = F.col("doc_id")
    turns = v.table(spark, sf, "conversations").select((F.col("conv_id") * 8 + F.col("turn")).alias("doc_id"), F.col("text").alias("said"))
    turns = turns.groupBy("doc_id").agg(F.min("said").alias("said"))  # turns beyond the eighth share a number
    enr = v.enrichments(spark, sf).join(turns, "doc_id", "left")

    def other(field, rest):
        return F.when(F.col("said").isNotNull() & (doc % 8 == rest), F.col("said")).otherwise(F.col(field))

    lists = [F.array().cast("array<string>").alias(n) for n in fv.SCHEMA_LISTS]
    facts = _facts(doc, F.col("what_happened_en"), F.col("title_en"))
    schema = F.struct(F.col("article_id"), F.when(doc % 31 == 0, "other").otherwise(F.col("category")).alias("category"),
                      F.when(doc % 37 != 0, facts).alias("core_facts"), *lists, F.lit("").alias("scope"))
    rows = enr.select(
        "doc_id", "article_id", "task", "model", "generated_at", "title_original", "source", "published_at", "original_url", "category", "importance_score",
        "title_en", other("title_cn", 1).alias("title_cn"), "what_happened_en", other("what_happened", 3).alias("what_happened"),
        "why_it_matters_en", other("why_it_matters", 5).alias("why_it_matters"),
        F.to_json(schema).alias("fact_schema_json"), (doc % 3 == 0).alias("repaired"))
    return stored(rows, "rendered")  # as a collector would keep them; every check reads them several times


@query("enrichment_check")
def enrichment_check(spark, sf):
    return va.enrichment_check(rendered(spark, sf)).select("doc_id", "status", "reject_stage", "reject_reason")


@query("validation_summary")
def validation_summary(spark, sf):
    checked = va.enrichment_check(rendered(spark, sf))
    return va.validation_summary(checked, ["category"])


@query("repair_candidates")
def repair_candidates(spark, sf):
    checked = va.enrichment_check(rendered(spark, sf))
    out = va.repair_candidates(checked.withColumn("article_id", F.col("doc_id")))
    return out.select(F.col("article_id").alias("doc_id"), "failed_field", F.array_join("allowed_fields", ",").alias("allowed_fields"))


@query("parse_fact_schema", v.sql(v.V_BASE, v.V_ENRICHMENTS, select=r"""
, w AS (SELECT doc_id, length(list_distinct(regexp_extract_all(what_happened_en, '\p{L}{8,}'))) AS words,
    length(regexp_extract_all(title_en, '[\p{L}\p{N}]+')) AS heads FROM v_enrichments)
SELECT doc_id, CASE WHEN doc_id % 37 = 0 OR (words = 0 AND heads < 2) THEN 'core_facts_empty' WHEN doc_id % 31 = 0 THEN 'category_mismatch' END AS schema_issue FROM w"""))
def parse_fact_schema(spark, sf):
    return va.parse_fact_schema(rendered(spark, sf), "fact_schema_json", "article_id", "category").select("doc_id", "schema_issue")


@query("cache_validity")
def cache_validity(spark, sf):
    art = v.articles(spark, sf).select("id", "original_url", "published_at", "source", F.col("title").alias("original_title"))
    return va.cache_validity(art, rendered(spark, sf)).select("id", "cache_reason")


@query("literal_check")
def literal_check(spark, sf):
    return va.literal_check(rendered(spark, sf)).select("doc_id", "literal_issue")


@query("entity_mentions")
def entity_mentions(spark, sf):
    """The facts of each article that either rendering of its fields names, and the first disagreement."""
    facts = F.from_json("fact_schema_json", va.SCHEMA)["core_facts"]
    rows = va.bilingual_fact_check(rendered(spark, sf).withColumn("core_facts", facts))
    texts = {f"in_{c}": (c, language) for c, language in (("title_en", "en"), ("title_cn", "zh"), ("what_happened_en", "en"), ("what_happened", "zh"))}
    rows = fc.with_mentions(rows, "core_facts", texts)
    return rows.select("doc_id", *[F.array_join(c, ",").alias(c) for c in texts], F.col("issue.stage").alias("stage"), F.col("issue.reason").alias("reason"))


def _payloads(spark, sf):
    """Answers of ten items each, derived from the documents; some drop or double an item."""
    doc = F.col("doc_id")
    rows = v.table(spark, sf, "documents").select(doc, F.floor(doc / 10).alias("batch"))
    answered = rows.filter((doc % 70 != 3)).select("batch", F.when(doc % 90 == 5, doc - 1).otherwise(doc).alias("doc_id"))
    items = answered.groupBy("batch").agg(F.sort_array(F.collect_list(F.struct(F.col("doc_id").cast("string").alias("id")))).alias("items"))
    body = F.concat(F.lit("```json\n"), F.to_json(F.struct("items")), F.lit("\n```"))
    return items.select("batch", body.alias("content")), rows.select("batch", doc.cast("string").alias("id"))


@query("payload_violations", """
SELECT doc_id // 10 AS batch, CASE WHEN count(*) FILTER (doc_id % 90 = 5) > 0 THEN 'duplicate_item_id' ELSE 'ids_do_not_match' END AS rule
FROM documents GROUP BY 1 HAVING count(*) FILTER (doc_id % 90 = 5 OR doc_id % 70 = 3) > 0""")
def payload_violations(spark, sf):
    payloads, candidates = _payloads(spark, sf)
    return va.payload_violations(payloads, candidates, "batch", "content")


@query("apply_field_repair", v.sql(v.V_BASE, v.V_ENRICHMENTS, select="SELECT doc_id, doc_id % 2 = 0 AS repair_accepted, CASE WHEN doc_id % 2 = 0 THEN 'fixed' ELSE source END AS title_cn FROM v_enrichments"))
def apply_field_repair(spark, sf):
    doc = F.col("doc_id")
    rows = v.enrichments(spark, sf).select(
        "doc_id", F.create_map(F.lit("title_cn"), F.col("source"), F.lit("title_en"), F.col("category")).alias("fields"),
        F.create_map(F.when(doc % 2 == 0, "title_cn").otherwise("title_en"), F.lit(" fixed ")).alias("repairs"), F.array(F.lit("title_cn")).alias("allowed"))
    return va.apply_field_repair(rows, "fields", "repairs", "allowed").select("doc_id", "repair_accepted", F.col("fields")["title_cn"].alias("title_cn"))
