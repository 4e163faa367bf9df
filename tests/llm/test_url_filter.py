import random

from pyspark.sql import functions as F
from tidemark.llm import url_filter as U


def brute(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] + [len(rest)])
        host = "".join(c.lower() if c < "\x80" else c for c in rest[:cut])
        path = rest[cut:]
        path = path[: min([path.find(c) for c in "?#" if c in path] + [len(path)])]
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, 0, None, "allow"))
    return host, path, best[2], best[3]


def judged(spark, urls, rules, **kw):
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id int, url string")
    rules = spark.createDataFrame(rules, "host string, path string, verdict string")
    return [tuple(r)[-4:] for r in U.judge(pages, rules, **kw).select("page_id", "host", "path", "rule", "verdict").orderBy("page_id").collect()]


def test_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(U, "ROWS_PER_SWEEP", 7)  # several pieces for a host
    r = random.Random(1)
    hosts = ["com", "a.com", "b.a.com", "c.b.a.com", "net", "x.net", "example.org", "aa.com", "", "a..com"]
    paths = ["", "/", "/en", "/en/", "/en/x", "/e", "/en/x/y?q#f", "/é/\U0010ffffz", "#f", "?q/en/"]
    urls = [r.choice(["http://", "HTTPS://", "", "x"]) + r.choice(hosts).upper() + r.choice(paths) for _ in range(300)]
    urls += [None, "", "://", "a://b://c/d", "http://a.com/en/x"] + ["http://hot.com/en/x"] * 50
    rules = [
        ("com", "/", "allow"), ("a.com", "/en/", "block"), ("b.a.com", "/en/", "allow"), ("a.com", "/en/x", "allow"),
        ("net", "", "block"), ("com", "/é/\U0010ffff", "block"), ("a.com", "/e", "block"),
    ]
    assert judged(spark, urls, rules) == [brute(u, rules) for u in urls]


def test_repeated_rules_nulls_ties_and_no_rules(spark):
    urls = ["http://a.b.c/xy", None]
    rules = [("c", "/xy", "allow"), ("c", "/xy", "block"), ("b.c", "/", "allow"), (None, "/", "block"), ("c", None, "block")]
    # both rules have four characters: the longer host wins
    assert judged(spark, urls, rules) == [("a.b.c", "/xy", "b.c/", "allow"), ("", "", None, "allow")]
    assert judged(spark, urls[:1], rules[:2]) == [("a.b.c", "/xy", "c/xy", "block")]
    assert judged(spark, urls, [], default="block") == [("a.b.c", "/xy", None, "block"), ("", "", None, "block")]
    assert judged(spark, [], rules) == []
    assert judged(spark, [None], [("", "", "block")]) == [("", "", "", "block")]


def test_extra_columns_pass_and_clashing_ones_are_replaced(spark):
    pages = spark.createDataFrame([(1, "http://a.com/", "old", 5)], "page_id int, url string, rule string, top int")
    rules = spark.createDataFrame([("com", "/", "allow")], "host string, path string, verdict string")
    out = U.judge(pages, rules)
    assert out.select("page_id", "top", "rule").first() == (1, 5, "com/")
    assert out.columns.count("rule") == 1


def test_main_path_is_native(spark):
    pages = spark.createDataFrame([(1, "http://a.com/")], "page_id int, url string")
    rules = spark.createDataFrame([("com", "/", "allow")], "host string, path string, verdict string")
    plan = U.judge(pages, rules)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))
