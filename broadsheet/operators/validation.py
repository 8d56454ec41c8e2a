"""Model payloads, shared fact schemas and bilingual checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from broadsheet import fixed_values as fv
from broadsheet.functions import facts as fc
from broadsheet.functions import rules as ru
from broadsheet.operators.admission import first_reason
from broadsheet.operators.dedup import cache_reason

TEXT_FIELDS = ("title_en", "title_cn", "what_happened_en", "what_happened", "why_it_matters_en", "why_it_matters")
SCHEMA = T.StructType([
    T.StructField("article_id", T.StringType()), T.StructField("category", T.StringType()), T.StructField("core_facts", fc.FACTS),
    *[T.StructField(n, T.ArrayType(T.StringType())) for n in fv.SCHEMA_LISTS], T.StructField("scope", T.StringType())])


def _filled(text: Column) -> Column:
    return F.coalesce(text.rlike(r"(?U)\S"), F.lit(False))


def _strings(values: Column) -> Column:
    return F.forall(values, _filled)


def parse_fact_schema(df: DataFrame, json: str, article_id: str, category: str | None = None) -> DataFrame:
    """Add `fact_schema` (NULL when invalid) and `schema_issue` (the first broken rule)."""
    parsed = F.from_json(F.col(json), SCHEMA)
    df = df.withColumn("_s", parsed)
    facts = F.col("_s.core_facts")
    ids = F.transform(facts, lambda f: f["id"])

    def sound(fact: Column) -> Column:
        return _filled(fact["id"]) & _filled(fact["type"]) & _filled(fact["value"]) & F.coalesce(F.size(fact["rendered_in"]) > 0, F.lit(False))

    def rendered(fact: Column) -> Column:
        return F.forall(fact["rendered_in"], lambda name: F.coalesce(name.isin(*fv.FIELD_NAMES), F.lit(False)))

    def forms(fact: Column) -> Column:
        return F.coalesce(_strings(fact["english_forms"]) & _strings(fact["chinese_forms"]), F.lit(False))

    lists = [F.coalesce(_strings(F.col(f"_s.{n}")), F.get_json_object(json, f"$.{n}").isNull()) for n in fv.SCHEMA_LISTS]
    lists_ok = lists[0]
    for test in lists[1:]:
        lists_ok = lists_ok & test
    raw_facts = F.get_json_object(json, "$.core_facts")
    tests = [
        (~F.coalesce(F.trim(F.col(json)).startswith("{"), F.lit(False)) | F.col("_s").isNull(), "no_object"),
        (~F.coalesce(F.col("_s.article_id") == F.col(article_id), F.lit(False)), "article_id"),
        (~_filled(F.col("_s.category")), "category"),
        (raw_facts.isNull() | facts.isNull() | (F.size(facts) == 0), "core_facts_empty"),
        (~F.forall(facts, sound) | (F.size(F.array_distinct(ids)) < F.size(ids)), "core_fact"),
        (~F.forall(facts, rendered), "rendered_in"), (~F.forall(facts, forms), "forms"), (~lists_ok, "string_list"),
    ]
    if category:
        tests.append((F.col("_s.category") != F.col(category), "category_mismatch"))
    df = df.withColumn("schema_issue", first_reason(*tests))
    return df.withColumn("fact_schema", F.when(F.col("schema_issue").isNull(), F.col("_s"))).drop("_s")


def model_items(payloads: DataFrame, batch: str, content: str) -> DataFrame:
    """Items of every response, a surrounding code fence removed: batch, id, item (JSON text)."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(content), r"^```[^\n]*\n", ""), r"```\s*$", "")
    rows = F.from_json(F.get_json_object(bare, "$.items"), "array<string>")
    return payloads.select(batch, F.explode_outer(rows).alias("item")).withColumn("id", F.get_json_object("item", "$.id"))


def payload_violations(payloads: DataFrame, candidates: DataFrame, batch: str, content: str) -> DataFrame:
    """Batches whose answer is not exactly one item per candidate."""
    items = model_items(payloads, batch, content).filter("item is not null")
    got = items.groupBy(batch, "id").agg(F.count("*").alias("_n"))
    want = candidates.select(batch, "id").distinct().withColumn("_want", F.lit(1))
    both = want.join(got, [batch, "id"], "full").groupBy(batch).agg(
        F.count_if(F.col("id").isNull()).alias("no_id"), F.count_if(F.col("_n") > 1).alias("double"),
        F.count_if(F.col("_n").isNull()).alias("missing"), F.count_if(F.col("_want").isNull()).alias("foreign"))
    rule = first_reason(
        (F.col("no_id") > 0, "item_without_id"), (F.col("double") > 0, "duplicate_item_id"),
        ((F.col("missing") > 0) | (F.col("foreign") > 0), "ids_do_not_match"))
    return both.select(batch, rule.alias("rule")).filter("rule is not null")


def apply_field_repair(items: DataFrame, fields: str, repairs: str, allowed: str) -> DataFrame:
    """Repaired fields (a map column) where every key is allowed and filled; else the item is rejected."""
    keys = F.map_keys(repairs)
    ok = (F.size(keys) > 0) & (F.size(F.array_except(keys, allowed)) == 0) & F.forall(F.map_values(repairs), _filled)
    kept = F.map_filter(fields, lambda k, _: ~F.array_contains(F.map_keys(repairs), k))
    return items.withColumn("repair_accepted", F.coalesce(ok, F.lit(False))).withColumn(
        fields, F.when(F.col("repair_accepted"), F.map_concat(kept, F.transform_values(repairs, lambda _, v: F.trim(v)))).otherwise(F.col(fields)))


def bilingual_fact_check(rows: DataFrame) -> DataFrame:
    """Add `issue`: the first disagreement between the English and Chinese fields (NULL = none).

    Rows hold the six text fields and `core_facts`. A missing text counts as empty.
    """
    pairs = {f: (f"{f}_en", "title_cn" if f == "title" else f) for f in fv.FIELD_NAMES}
    out = rows.withColumn("_facts", fc.hard_facts(F.col("core_facts"))).withColumn("_names", fc.names_of(F.col("_facts")))
    # Each text is searched once for all names of its batch.
    out = out.withColumns({f"_in_{c}": fc.named(F.coalesce(c, F.lit("")), F.col("_names")) for pair in pairs.values() for c in pair})
    texts = {f: [F.coalesce(c, F.lit("")) for c in pair] for f, pair in pairs.items()}
    out = out.withColumns({f"_{f}": fc.field_issue(*texts[f], F.col("_facts"), *[F.col(f"_in_{c}") for c in pairs[f]]) for f in pairs})

    def first(field: str) -> Column:
        found = F.col(f"_{field}")
        repair = F.when(found["stage"] == "hard_facts", fv.REPAIR_FIELDS[field]["zh"])
        reason = F.concat(F.lit(f"{field}: "), found["reason"])
        return F.when(found.isNotNull(), F.struct(found["stage"].alias("stage"), F.lit(field).alias("field"), reason.alias("reason"),
                                                  repair.alias("repair_field")))

    out = out.withColumn("issue", F.coalesce(*[first(f) for f in fv.FIELD_NAMES]).cast(fc.ISSUE))
    return out.drop("_facts", "_names", *[f"_{f}" for f in pairs], *[f"_in_{c}" for pair in pairs.values() for c in pair])


def literal_check(rows: DataFrame) -> DataFrame:
    """Add `literal_issue`: first field whose numbers, versions or dates differ."""
    issues = [F.concat(F.lit(f"{f}: "), fc.literal_issue(F.col(f"{f}_en"), F.col("title_cn" if f == "title" else f))) for f in fv.FIELD_NAMES]
    return rows.withColumn("literal_issue", F.coalesce(*issues))


def field_issue(item_columns=TEXT_FIELDS) -> Column:
    """Native part of the enrichment check: category, score, filled fields, blocked terms."""
    shown = F.concat_ws("\n", *item_columns, "category")
    return first_reason(
        (~_filled(F.col("category")), "category_empty"), (~F.col("category").isin(*fv.CATEGORIES), "category_invalid"),
        (~F.coalesce(F.col("importance_score").between(0, 100), F.lit(False)), "importance_score"),
        *[(~_filled(F.col(name)), f"{name}_empty") for name in item_columns],
        (ru.blocked_terms(shown), "blocked_content"))


def enrichment_check(rows: DataFrame, schema_json: str = "fact_schema_json", article_id: str = "article_id") -> DataFrame:
    """Status and first reason per item: fields, then the fact schema, then the bilingual facts."""
    out = parse_fact_schema(rows, schema_json, article_id, category="category").withColumn("_field", field_issue())
    sound = F.col("_field").isNull() & F.col("schema_issue").isNull()
    # Only sound rows travel to the bilingual check.
    checked = bilingual_fact_check(out.filter(sound).withColumn("core_facts", F.col("fact_schema.core_facts"))).drop("core_facts")
    rest = out.filter(~sound).withColumn("issue", F.lit(None).cast(fc.ISSUE))
    every = checked.unionByName(rest)
    stage = F.when(F.col("_field").isNotNull() & (F.col("_field") != "blocked_content"), "validation").when(
        F.col("schema_issue").isNotNull(), "schema").when(F.col("_field").isNotNull(), "validation").otherwise(F.col("issue.stage"))
    reason = F.when(stage == "schema", F.concat(F.lit("fact_schema: "), F.col("schema_issue"))).otherwise(F.coalesce("_field", "issue.reason"))
    return every.withColumn("reject_stage", stage).withColumn("reject_reason", reason).withColumn(
        "status", F.when(F.col("reject_stage").isNull(), "accepted").otherwise("rejected")).drop("_field")


def cache_validity(articles: DataFrame, enrichments: DataFrame) -> DataFrame:
    """Cached renderings with `cache_reason`: metadata first, then the full enrichment check."""
    pair = articles.alias("a").join(enrichments.alias("e"), F.col("a.id") == F.col("e.article_id"), "left").select(
        F.col("a.id").alias("id"), "e.*", cache_reason().alias("_meta"))
    open_ = enrichment_check(pair.filter("_meta is null"))
    verdict = F.when(F.col("status") == "rejected", "cache_validation_failed")
    fine = open_.select("id", verdict.alias("cache_reason"))
    return fine.unionByName(pair.filter("_meta is not null").select("id", F.col("_meta").alias("cache_reason")))


def validation_summary(checked: DataFrame, keys: list[str]) -> DataFrame:
    stage = F.col("reject_stage")
    return checked.groupBy(*keys).agg(
        F.count_if(F.col("status") == "accepted").alias("accepted"), F.count_if(stage == "hard_facts").alias("hard_fact_rejected"),
        F.count_if(stage == "semantic").alias("semantic_rejected"), F.count_if(F.col("repaired")).alias("repaired"))


def repair_candidates(checked: DataFrame) -> DataFrame:
    """Items one field repair may save, with the only field it may change."""
    return checked.filter(F.col("issue.repair_field").isNotNull()).select(
        "article_id", F.col("issue.field").alias("failed_field"), F.array("issue.repair_field").alias("allowed_fields"),
        F.col("issue.reason").alias("validation_reason"))
