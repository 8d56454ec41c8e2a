"""Payload parsers and the registry on small captured bodies."""

import json

from broadsheet.sources import feeds, pages, registry

SOURCES = "source_id string, url string, allow_hosts array<string>, article_path_pattern string"
CAPTURES = "source_id string, url string, body string"


def sources(spark, url="https://example.com/feed", hosts=("example.com",), pattern=None):
    return spark.createDataFrame([("s", url, list(hosts), pattern)], SOURCES)


def captures(spark, *bodies):
    return spark.createDataFrame([("s", f"https://example.com/{n}", b) for n, b in enumerate(bodies)], CAPTURES)


def test_rss_cap_and_reasons(spark):
    body = "<rss><channel>" + "".join(f"<item><title>Quantum {i}</title><link>https://example.com/{i}</link></item>" for i in range(101))
    body += "<item><title>Missing URL</title></item><item><title>Bad</title><link>http://example.com/x</link></item></channel></rss>"
    rows = feeds.feed_items(captures(spark, body), sources(spark)).collect()
    by = {}
    for r in rows:
        by[r.reason] = by.get(r.reason, 0) + 1
    assert by == {"parsed_feed_item": 100, "feed_cap_100": 1, "missing_url": 1, "invalid_or_disallowed_url": 1}
    assert [r.idx for r in rows if r.reason == "feed_cap_100"] == [100]


def test_atom_and_broken_feed(spark):
    atom = ('<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>A model</title><link rel="self" href="https://example.com/self"/>'
            '<link href="https://example.com/a"/><updated>2026-09-14T00:00:00Z</updated></entry></feed>')
    rows = {r.url_of_index: r for r in feeds.feed_items(captures(spark, atom, "<rss><"), sources(spark)).collect()}
    assert (rows["https://example.com/0"].url, str(rows["https://example.com/0"].published_at)) == ("https://example.com/a", "2026-09-14 00:00:00")
    assert rows["https://example.com/1"].reason == "parse_failure"


def test_json_index(spark):
    items = [{"TITLE": "New AI policy", "URL": "https://example.com/1", "DOCRELPUBTIME": "2026-09-14"}, {"title": "Weather", "url": "https://example.com/2"},
             "text", {"title": "AI", "url": "https://elsewhere.org/"}]
    items += [{"title": "AI model", "url": "https://example.com/n"}] * 98
    for body in (json.dumps(items), json.dumps({"items": items})):
        rows = sorted(feeds.json_index_items(captures(spark, body), sources(spark)).collect(), key=lambda r: r.idx)
        assert [r.reason for r in rows[:4]] == ["parsed_json_item", "radar_terms_absent", "malformed_article", "invalid_or_disallowed_url"]
        assert [r.reason for r in rows[100:]] == ["index_cap_100"] * 2


def test_board(spark):
    good = json.dumps({"success": True, "data": {"cards": [{"content": [{"word": "新能源汽车芯片产业发展报告", "rawUrl": "https://example.com/a"}, 3, {"word": "短", "url": "https://example.com/b"}]}]}})
    bodies = [good, "[]", "{}", '{"success":false,"data":{"cards":[]}}', '{"success":true,"data":{"cards":[]}}', '{"success":true,"data":{"cards":[{}]}}']
    caps = captures(spark, *bodies)
    assert sorted(r.url[-1] for r in feeds.board_violations(caps).collect()) == ["1", "2", "3", "5"]
    rows = sorted(feeds.board_items(caps, sources(spark)).collect(), key=lambda r: r.idx)
    assert [(r.status, r.reason) for r in rows] == [("kept", "parsed_index_link"), ("dropped", "malformed_article"), ("dropped", "title_shorter_than_12")]


def test_html_index(spark):
    body = ('<a href="https://chat.example.com/">Example Chat AI model</a><a href="/en/news/x-flash/">News September 10, 2026 Introducing an AI model</a>'
            '<a href="/en/news/./x-flash/">Again: introducing an AI model</a><a href="/en/news/">All the AI research news</a><a href="/en/news/y">short</a>')
    src = sources(spark, "https://www.example.com/en/news/", ("www.example.com",), r"^/en/news/[^/]+/?$")
    rows = sorted(feeds.index_links(captures(spark, body), src).collect(), key=lambda r: r.idx)
    assert [r.reason for r in rows] == ["invalid_or_disallowed_url", "parsed_index_link", "duplicate_index_url", "article_path_pattern_mismatch", "title_shorter_than_12"]
    assert rows[1].url == "https://www.example.com/en/news/x-flash/" and str(rows[1].published_at)[:10] == "2026-09-10"


def test_extraction(spark):
    html = ('<html><head><meta property="og:title" content="The title"><meta content="2026-09-14T01:00:00Z" name="date"></head><body><nav>menu</nav>'
            '<div class="main x"><h1>Heading</h1><p>Body <br>text</p><span class="ad">buy</span><script>x()</script></div><p>outside</p></body></html>')
    df = spark.createDataFrame([("1", html, "div.main", [".ad"]), ("2", html, "#none", None), ("3", "<h1>Only</h1><p>t</p>", None, None)],
                               "k string, html string, include string, exclude array<string>")
    got = {r.k: r for r in pages.extract_articles(df, "k").collect()}
    assert (got["1"].title, got["1"].clean_text, str(got["1"].published_at), got["1"].error) == ("The title", "Heading Body text", "2026-09-14 01:00:00", None)
    assert got["2"].error == "include_selector_did_not_match"
    assert (got["3"].title, got["3"].clean_text, got["3"].published_at) == ("Only", "Only t", None)


GOOD = {"id": "one", "name": "One", "source_type": "official_blog", "adapter": "rss", "url": "https://example.com/feed", "allow_hosts": ["example.com"], "priority": 1,
        "region": "EU", "category": ["ai"], "tier": 1, "language": "en", "fetch_method": "rss", "health_status": "active"}


def broken(spark, tmp_path, *changes):
    path = tmp_path / "sources.json"
    path.write_text(json.dumps([{**GOOD, **c} for c in changes]))
    return sorted((r.id, r.rule) for r in registry.registry_violations(registry.read_sources(spark, str(path))).collect())


def test_registry(spark, tmp_path):
    assert broken(spark, tmp_path, {}) == []
    changes = [{"id": "b1", "adapter": "ftp", "fetch_method": "ftp"}, {"id": "b2", "url": "https://github.com/x", "allow_hosts": ["github.com"]}, {"id": "b3", "priority": True},
               {"id": "b4", "request_attempts": 0}, {"id": "b5", "request_timeout_seconds": 100}, {"id": "b6", "proxy_mode": "invalid"}, {"id": "b7", "extra": 1},
               {"id": "b8", "source_role": "discovery"}, {"id": "b9", "category": ["cooking"]}, {"id": "same"}, {"id": "same"}]
    assert broken(spark, tmp_path, *changes) == sorted([
        ("b1", "adapter_supported"), ("b2", "blocked_host"), ("b3", "priority_range"), ("b4", "request_attempts"), ("b5", "request_timeout_seconds"),
        ("b6", "network_route"), ("b7", "unknown_fields"), ("b8", "discovery_tier"), ("b9", "category"), ("same", "id_unique")])
    typed = registry.typed_sources(registry.read_sources(spark, str(tmp_path / "sources.json"))).first()
    assert (typed.source_role, typed.channels) == ("primary", ["technology"])
