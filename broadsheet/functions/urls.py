"""URL parts by portable patterns: no parser, no UDF, same reading in every engine."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from broadsheet import fixed_values as fv

AUTHORITY = r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)"
PATH = r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)"


def scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.\-]*):", 1))


def host(url: Column) -> Column:
    """Lower-case host, or the empty string."""
    authority = F.regexp_replace(F.regexp_extract(url, AUTHORITY, 1), "^.*@", "")
    return F.lower(F.regexp_extract(authority, "^([^:]*)", 1))


def has_userinfo(url: Column) -> Column:
    return F.regexp_extract(F.regexp_extract(url, AUTHORITY, 1), "^(.*)@", 1).rlike("[^:]")


def path(url: Column) -> Column:
    return F.regexp_extract(url, PATH, 1)


def host_in(host_name: Column, hosts) -> Column:
    """Equal to, or a sub-domain of, one of `hosts` (a sequence, or an array column)."""
    if isinstance(hosts, Column):
        return F.exists(hosts, lambda h: (host_name == F.lower(h)) | host_name.endswith(F.concat(F.lit("."), F.lower(h))))
    tests = [(host_name == h) | host_name.endswith("." + h) for h in hosts]
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def blocked_host(host_name: Column) -> Column:
    return host_in(F.trim(host_name, F.lit(".")), fv.BLOCKED_HOSTS)


def safe_url(url: Column, hosts=None) -> Column:
    name = host(url)
    ok = (scheme(url) == "https") & (name != "") & ~has_userinfo(url) & ~blocked_host(name)
    return ok if hosts is None else ok & host_in(name, hosts)


def normalized_url(url: Column) -> Column:
    return F.rtrim(F.substring_index(url, "#", 1), F.lit("/"))


def favorite_key(url: Column) -> Column:
    """Bookmark key: the URL without its fragment (a trailing slash is kept)."""
    return F.sha2(F.substring_index(url, "#", 1), 256)


def is_index_path(url: Column) -> Column:
    return F.lower(F.rtrim(path(url), F.lit("/"))).isin(*fv.INDEX_PATHS)


@F.pandas_udf(T.StringType())
def _join_url(base: pd.Series, href: pd.Series) -> pd.Series:
    import posixpath
    from urllib.parse import urljoin, urlsplit

    def resolve(root: str, link: str) -> str | None:
        try:
            parts = urlsplit(urljoin(root, link))
            clean = posixpath.normpath(parts.path)
            if parts.path.endswith("/"):
                clean = clean.rstrip("/") + "/"
            return parts._replace(path=clean).geturl()
        except ValueError:
            return None

    return pd.Series([resolve(b, h) for b, h in zip(base, href)], index=base.index, dtype=object)


# Kept out of expression rewriting: its result feeds lambdas, which may not hold a Python call.
join_url = _join_url.asNondeterministic()


def prefer_https(url: Column, hosts) -> Column:
    """Upgrade plain http links that stay on the source's own hosts."""
    upgrade = (scheme(url) == "http") & host_in(host(url), hosts)
    return F.when(upgrade, F.regexp_replace(url, "(?i)^http:", "https:")).otherwise(url)


def normalize_index_url(df, base: str, href: str, hosts, name: str = "url"):
    """Resolve a link against its index page, tidy the path, prefer https."""
    return df.withColumn("_joined", join_url(base, href)).withColumn(name, prefer_https(F.col("_joined"), hosts)).drop("_joined")
