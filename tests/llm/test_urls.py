import random
import re

from opsmart.llm import urls


def plain(url, rules, otherwise="allow"):
    m = re.search(r"(?s)://([^/?#]*)([^?#]*)", url or "")
    host = re.sub("[A-Z]", lambda x: x[0].lower(), m[1]) if m else ""
    path = m[2] if m else ""
    fits = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fits, key=lambda r: (r[0].count("."), len(r[1])), default=None)
    return host, path, best and best[0] + best[1], best[2] if best else otherwise


def test_nested_rules_against_plain_search(spark, many_ranges):
    rng = random.Random(2)
    names = ["a", "b", "aa", "ab", "a-b", "é"]
    host = lambda n: ".".join(rng.choice(names) for _ in range(rng.randint(1, n)))
    path = lambda n: "/" + "".join(rng.choice(["a", "b", "/", "ab"]) for _ in range(rng.randint(0, n)))
    rules = {(host(3), rng.choice(["", path(4)])): rng.choice(["allow", "block"]) for _ in range(150)}
    rules = [(h, p, v) for (h, p), v in rules.items()]
    made = [f"http://{host(5)}{path(8)}{rng.choice(['', '?q=/a', '#a'])}" for _ in range(1500)]
    made += [None, "", "no scheme/a", "http://", "x://A.B?/a", "http://a.b.", "://a://b/a", "http://a\n.b/a\nb", "http://b/\U0010ffff"] + made[:40]
    pages = spark.createDataFrame([(i, u, "x", 3) for i, u in enumerate(made)], "page_id long, url string, verdict string, range int")
    got = urls.match_rules(pages, spark.createDataFrame(rules, "host string, path string, verdict string").repartition(3), otherwise="ask")
    assert got.columns == ["page_id", "url", "range", "host", "path", "rule", "verdict"]
    found = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in got.collect()}
    assert len(found) == len(made)
    for i, u in enumerate(made):
        assert found[i] == plain(u, rules, "ask"), u


def test_equal_rules_and_empty_tables(spark):
    pages = spark.createDataFrame([(1, "http://x.org/a"), (1, "http://x.org/a")], "page_id long, url string")
    schema = "host string, path string, verdict string"
    rules = spark.createDataFrame([("ORG", "/", "allow"), ("org", "/", "block"), (None, None, "allow")], schema)
    assert [r["verdict"] for r in urls.match_rules(pages, rules).collect()] == ["block", "block"]
    assert {r["rule"] for r in urls.match_rules(pages, rules.limit(0)).collect()} == {None}
    assert urls.match_rules(pages.limit(0), rules).count() == 0
