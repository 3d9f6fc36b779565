"""Lists as of the day of the fetch, against a plain walk through the entries."""

import datetime
import random
import re

from pyspark.sql import functions as F

from tidewell.llm.url_filter import judge, validity_intervals

D = datetime.date(2024, 1, 1)


def day(n):
    return None if n is None else D + datetime.timedelta(n)


def plain(captures, entries):
    out = []
    for key, url, at in captures:
        host = re.match(r"[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", (url or "").lower())
        path = re.match(r"[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+(/[^?#]*)", url or "")
        host, path = host[1] if host else "", path[1] if path else ""
        labels = host.split(".")
        names = {host, host + path, host + (re.match(r"/[^/]*", path) or [""])[0]}
        names |= {".".join(labels[i:]) for i in range(max(1, len(labels) - 1))}
        rules = set()
        for name in names if host and at else ():
            for which in ("a", "b"):
                own = [(d, x) for l, p, d, x in entries if l == which and p == name and d is not None and x is not None and d <= at]
                if own and any(x for d, x in own if d == max(own)[0]):
                    rules.add(f"{which}:{name}")
        out.append((key, url, host, at, bool(rules), " ".join(sorted(rules)), len(rules)))
    return sorted(out, key=repr)


def test_against_a_plain_walk(spark):
    rng = random.Random(1)
    hosts = ["a.example.com", "b.a.example.com", "example.com", "x.org", "y.x.org", "localhost"]
    paths = ["", "/", "/en", "/en/1", "/en/1?x=2", "/de/2#y", ":8080/en/1"]
    captures = [(i, "http://" + rng.choice(hosts) + rng.choice(paths), day(rng.randint(0, 20))) for i in range(300)]
    captures += [(1, None, day(1)), (2, "", day(2)), (3, "no url", day(3)), (4, "http://x.org/", None), (None, "HTTP://U@X.ORG/en", day(9))]
    captures += [(5, "http://x.org/", day(9))] * 2 + [(6, "http://x.org/" + "z" * 5000, day(9)), (7, "http://a..b/", day(3))]
    patterns = [*hosts, "com", "x.org/en", "a.example.com/en/1", "x.org/"]
    entries = [(rng.choice("ab"), rng.choice(patterns), day(rng.randint(0, 20)), rng.random() < 0.6) for _ in range(80)]
    entries += [(None, "x.org", day(1), True), ("a", None, day(1), True), ("a", "x.org", None, True), ("b", "x.org", day(0), None)]
    c = spark.createDataFrame(captures, "page_id long, url string, at date").withColumn("pattern", F.lit("clash"))
    e = spark.createDataFrame(entries, "list string, pattern string, day date, listed boolean").withColumn("url", F.lit("clash"))
    found = sorted((tuple(r) for r in judge(c, e, key="page_id", url="url", day="at").collect()), key=repr)
    assert found == plain(captures, entries)
    assert judge(c.limit(0), e, key="page_id", url="url", day="at").collect() == []
    assert all(not r.blocked for r in judge(c, e.limit(0), key="page_id", url="url", day="at").collect())


def test_intervals(spark):
    rows = [("a", "x", day(1), True), ("a", "x", day(3), True), ("a", "x", day(5), False), ("a", "x", day(7), True), ("a", "x", day(5), False)]
    rows += [("b", "x", day(1), False), ("b", "y", day(2), False), ("b", "y", day(2), True)]
    found = {tuple(r) for r in validity_intervals(spark.createDataFrame(rows, "list string, pattern string, day date, listed boolean")).collect()}
    assert found == {("a", "x", day(1), day(5)), ("a", "x", day(7), None), ("b", "y", day(2), None)}


def test_no_python_in_the_plan(spark, data):
    from tidewell.llm.registry import op6_url_filter

    plan = op6_url_filter(spark, data)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
