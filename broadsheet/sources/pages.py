"""Captured article pages to clean articles."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet import fixed_values as fv
from broadsheet.functions import rules as ru
from broadsheet.functions import text as tx
from broadsheet.sources import markup

SELECTOR = re.compile(fv.SELECTOR, re.I)


def _selects(selector: str):
    """The test that a selector (tag, .class, #id, tag.class or tag#id) makes of an opening event."""
    parts = SELECTOR.fullmatch(selector)
    if not selector or parts is None:
        raise ValueError(f"unsupported selector: {selector!r}")
    tag, value = (parts["tag"] or "").lower(), parts["value"]
    named = {"#": lambda a: a.get("id") == value, ".": lambda a: value in (a.get("class") or "").split(), None: lambda a: True}[parts["kind"]]
    return lambda e: tag in ("", e.tag) and named(e.attributes)


def _visible(batches):
    for pdf in batches:
        rows = []
        for page, include, exclude in zip(pdf["html"], pdf["include"], pdf["exclude"]):
            left_out = [_selects(s) for s in (exclude if exclude is not None else [])]
            text, heading, found = markup.visible(
                markup.events(page), _selects(include) if include else None,
                lambda e: e.tag in fv.DROPPED_TAGS or any(test(e) for test in left_out), frozenset(fv.VOID_TAGS))
            rows.append((" ".join(text), " ".join(heading), None if found else "include_selector_did_not_match"))
        walked = pd.DataFrame(rows, columns=["joined_text", "heading", "error"], index=pdf.index)
        yield pd.concat([pdf[["key", "og", "fallback", "date_text"]], walked], axis=1)


def _meta(html: str, name: str):
    """Content of a meta tag, with its attributes in either order."""
    found = [F.nullif(F.trim(F.regexp_extract(html, p.format(name=name), 1)), F.lit("")) for p in (fv.META_FORWARD, fv.META_BACKWARD)]
    return F.coalesce(*found)


def extract_articles(pages: DataFrame, key: str, fallback_title: str | None = None) -> DataFrame:
    """key, title, raw_text, clean_text, published_at, error per page.

    `pages` holds `html` and optionally `include` and `exclude` selectors. Only the text walk is
    Python; title and date come from patterns, cleaning is native.
    """
    include = F.col("include") if "include" in pages.columns else F.lit(None).cast("string")
    exclude = F.col("exclude") if "exclude" in pages.columns else F.lit(None).cast("array<string>")
    kind = pages.schema[key].dataType.simpleString()
    fallback = F.col(fallback_title) if fallback_title else F.lit("")
    time_tag = F.nullif(F.regexp_extract("html", fv.TIME_TAG, 1), F.lit(""))
    date_text = F.coalesce(*[_meta("html", n) for n in fv.DATE_METAS], time_tag)
    heads = pages.select(F.col(key).alias("key"), "html", include.alias("include"), exclude.alias("exclude"), _meta("html", "og:title").alias("og"),
                         fallback.alias("fallback"), date_text.alias("date_text"))
    walked = heads.mapInPandas(
        _visible, f"key {kind}, og string, fallback string, date_text string, joined_text string, heading string, error string")
    title = tx.clean_text(F.coalesce("og", F.nullif(F.col("heading"), F.lit("")), "fallback"), fv.TITLE_LIMIT)
    out = walked.withColumn("raw_text", tx.clean_text(F.col("joined_text"), fv.RAW_LIMIT, fence=True))
    return out.select(F.col("key").alias(key), title.alias("title"), "raw_text", tx.clean_text(F.col("raw_text")).alias("clean_text"),
                      ru.parse_published(F.col("date_text")).alias("published_at"), "error")
