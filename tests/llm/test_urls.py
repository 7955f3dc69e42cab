import random

import pytest

from cuewise.llm import urls

CASES = [None, "", "no scheme", "http://", "HTTP://EXAMPLE.COM/en/x?y#z", "http://www.example.com/en/a", "https://a.www.example.com/en/", "http://example.com/enx", "http://example.com", "http://notexample.com/en/", "http://x.net/es/1", "http://net/fr/", "http://x.netx/es/", "a://b://c/d", "http://u@x.com:80/p?//q", "http://org?x=http://a.com/", "http://É.com/é#", "http://x..com//", "http://com", "http://net/es", "http://\nx.com/\n/en?", "http://net\x01a/es/", "http://es\x01net/es/"]


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host, rest = rest[:cut], rest[cut:]
    end = min((rest.find(c) for c in "?#" if c in rest), default=len(rest))
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), rest[:end]


def brute(rows, rules, default="allow"):
    out = []
    for k, u in rows:
        host, path = split(u)
        fits = [(len(r.name), len(r.host), r) for r in rules if host and (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        best = max(fits, key=lambda x: x[:2])[2] if fits else None
        out.append((str(k), host, path, best.name if best else None, best.verdict if best else default))
    return sorted(out, key=str)


def pages(spark, rows):
    from pyspark.sql import functions as F

    return spark.createDataFrame(rows, "page_id long, url string").withColumns({c: F.lit("clash") for c in ("host", "path", "k", "at", "part", "rule")})


def check(spark, rows, rules, **options):
    got = urls.judge(pages(spark, rows), rules, **options).collect()
    assert sorted(((str(r["page_id"]), r["host"], r["path"], r["rule"], r["verdict"]) for r in got), key=str) == brute(rows, rules)


def test_equals_brute_force(spark):
    check(spark, list(enumerate(CASES)) + [(3, CASES[4])] * 3 + [(None, CASES[5])], urls.RULES)


@pytest.mark.parametrize("ranges", [2, 9])
def test_many_nested_rules_over_many_ranges(spark, ranges):
    rnd = random.Random(ranges)
    labels = ["a", "b", "ab", "com", "a-b"]
    host = lambda: ".".join(rnd.choice(labels) for _ in range(rnd.randint(1, 4)))
    path = lambda: "/" + "".join(rnd.choice("xy/") for _ in range(rnd.randint(0, 3)))
    rules = {(h, p): urls.Rule(rnd.choice(["allow", "block"]), h, p) for h, p in ((host(), path()) for _ in range(80))}
    rows = [(i, f"http://{host()}{path()}") for i in range(400)] + [(1000 + i, "http://a.com/x") for i in range(300)]
    check(spark, rows, tuple(rules.values()), ranges=ranges)


def test_empty_tables(spark):
    check(spark, [], urls.RULES)
    no_rules = spark.createDataFrame([], "verdict string, host string, path string")
    assert {r["verdict"] for r in urls.judge(pages(spark, [(1, "http://a.com/")]), no_rules, default="block").collect()} == {"block"}


def test_rules_are_read_from_lines():
    assert urls.parse_rule("block example.com/en/") == urls.Rule("block", "example.com", "/en/")


def test_rules_that_tie_and_long_urls(spark):
    """Rules with one host and path: the verdict that comes last in the alphabet; urls of any length."""
    rules = (urls.Rule("block", "a.org", "/x"), urls.Rule("allow", "a.org", "/x"), urls.Rule("allow", "org", "/" + "y" * 3000))
    pages = [(1, "http://a.org/x"), (2, "http://b.org/" + "y" * 100_000), (3, "http://" + "s." * 20_000 + "a.org/x"), (4, None), (1, "http://a.org/x")]
    got = sorted((r["page_id"], r["rule"] and len(r["rule"]), r["verdict"]) for r in urls.judge(spark.createDataFrame(pages, "page_id long, url string"), rules, default="none").collect())
    assert got == [(1, 7, "block"), (1, 7, "block"), (2, 3004, "allow"), (3, 7, "block"), (4, None, "none")]


def test_ranges_are_dealt_evenly(spark):
    """One range a task."""
    pages = spark.range(4000).selectExpr("id AS page_id", "concat('http://h', id % 97, '.example.com/', id) AS url")
    out = urls.judge(pages, ranges=16)
    sizes = sorted(r[0] for r in out.rdd.mapPartitions(lambda rows: [(sum(1 for _ in rows),)]).collect())
    assert len(sizes) == 16 and sizes[0] > 0 and sizes[-1] < 2.5 * 4000 / 16
