"""The automaton against translated regular expressions, and url parts."""

import random
import re

from broadsheet.llm import url_rules as ur


def plain(glob):
    out, k = "", 0
    while k < len(glob):
        if glob.startswith("**", k):
            out, k = out + "(?:.|\n)*", k + 2
        elif glob[k] == "*":
            out, k = out + "[^/]*", k + 1
        elif glob[k] == "?":
            out, k = out + "[^/]", k + 1
        else:
            k += glob[k] == "\\"
            out, k = out + re.escape(glob[k]), k + 1
    return re.compile(out)


def test_all_globs_at_once_equal_regular_expressions():
    rng = random.Random(7)
    some = lambda letters, n: "".join(rng.choice(letters) for _ in range(rng.randint(0, n)))
    for _ in range(25):
        rules = [ur.Rule(str(k), some("ab/.*?**", 9), "block", rng.randint(0, 5)) for k in range(rng.randint(1, 60))]
        machine = ur.Automaton(rules)
        urls = [some("ab/.", 14) for _ in range(300)] + ["", "a" * 3000]
        for url, place in zip(urls, machine.best(urls).tolist()):
            want = max((r for r in rules if plain(r.glob).fullmatch(url)), key=lambda r: r.rank, default=None)
            assert (machine.rules[place].rank if place >= 0 else None) == (want.rank if want else None), url


def test_rules_over_hosts_and_paths(spark):
    rules = [ur.host_rule("org", "/", "allow"), ur.host_rule("example.org", "/es/", "block"), ur.host_rule("a*b.org", "/", "block"),
             ur.glob_rule("**.spam.**", "block")]
    cases = [("http://example.org/es/1", "example.org", "/es/1", "example.org/es/", "block"), ("x://WWW.Example.ORG/es", "www.example.org", "/es", "org/", "allow"),
             ("http://notorg/x.org/", "notorg", "/x.org/", None, "allow"), ("http://a.org", "a.org", "", None, "allow"),
             ("http://a.org?q=/", "a.org", "", None, "allow"), ("no scheme.org/", "", "", None, "allow"), (None, "", "", None, "allow"),
             ("a://b://c/d#e", "b:", "//c/d", None, "allow"), ("http://x.spam.net/", "x.spam.net", "/", None, "block"),
             ("http://acb.org/", "acb.org", "/", "org/", "allow"), ("http://é.org/ü?x", "é.org", "/ü", "org/", "allow"), ("", "", "", None, "allow"),
             ("http://org/", "org", "/", "org/", "allow"), ("http://e.org/" + "long/" * 5000, "e.org", "/" + "long/" * 5000, "org/", "allow"),
             ("l\n://h\n/p\nq", "h\n", "/p\nq", None, "allow")]
    frame = spark.createDataFrame([(k, c[0], "clash", "clash") for k, c in enumerate(cases)] + [(None, None, "", "")], "page_id long, url string, host string, id string")
    got = {r.page_id: tuple(r)[1:] for r in ur.judge(frame, rules).collect()}
    assert got == {k: c[1:] for k, c in enumerate(cases)} | {None: ("", "", None, "allow")}
    assert ur.judge(frame.filter("false"), rules).count() == 0
    assert {r.verdict for r in ur.judge(frame, [], "block").collect()} == {"block"}
