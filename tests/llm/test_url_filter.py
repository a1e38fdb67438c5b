import random

import pytest
from pyspark.sql import functions as F

from flowlake.llm import queries, url_filter
from flowlake.llm.oracles import ORACLES
from tests.llm import helpers
from tests.parity import compare, duck

URLS = [None, "", "no scheme", "http://", "HTTP://Example.ORG/ES/x", "http://example.org/es/x?q#f",
        "http://a.example.org/en/12", "http://notexample.org/en/1", "http://org", "http://org/",
        "ftp://x.com/fr/a", "ftp://x.com/de/a#/fr/", "http://x.com?/de/", "a://b.com/de/://c.org/",
        "http://com/de/", "http://x.com\n/de/", "http://É.org/"]


def plain(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([i for i in map(rest.find, "/?#") if i >= 0], default=len(rest))
        host = rest[:cut].translate({c: c + 32 for c in range(65, 91)})
        path = rest[cut:].split("?")[0].split("#")[0]
    fits = [(len(h + p), len(h), v, h + p) for h, p, v in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[3], best[2] if best else "allow"


@pytest.mark.parametrize("most_bytes", [32 << 20, -1])
def test_rules_equal_brute_force(spark, most_bytes):
    pick = random.Random(6)
    labels, parts = ["a", "b", "org", "com", "example"], ["", "/", "/x", "/x/", "/xy", "/en/1"]
    rules = list({(".".join(pick.choices(labels, k=pick.randrange(1, 4))), pick.choice(parts)):
                  pick.choice(["allow", "block"]) for _ in range(60)}.items())
    rules = [(h, p, v) for (h, p), v in rules]
    urls = URLS + ["http://" + ".".join(pick.choices(labels, k=pick.randrange(1, 5)))
                   + pick.choice(parts) + pick.choice(["", "z", "?x"]) for _ in range(400)]
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)],
                                  "page_id long, url string, verdict string")
    table = spark.createDataFrame([*rules, (None, "/", "block"), ("a", None, "block")],
                                  "host string, path string, verdict string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict)
           for r in url_filter.judged(pages, table, most_bytes=most_bytes).collect()}
    assert got == {i: plain(u, rules) for i, u in enumerate(urls)}


def test_the_cascade_is_exact_over_the_universe(spark):
    universe = spark.range(5000).selectExpr("concat('k', id) AS key")
    listed = universe.where("crc32(key) % 9 = 0")
    levels = url_filter.build_cascade(listed, universe)
    assert len(levels) > 2
    wrong = universe.where(
        url_filter.member(levels, F.col("key")) != F.expr("crc32(key) % 9 = 0"))
    assert wrong.count() == 0


def test_empty_cases(spark):
    pages = spark.createDataFrame([(1, u) for u in URLS + URLS], "page_id long, url string")
    none = spark.createDataFrame([], "host string, path string, verdict string")
    assert {r.verdict for r in url_filter.judged(pages, none).collect()} == {"allow"}
    rules = spark.createDataFrame(queries.URL_RULES, "host string, path string, verdict string")
    assert url_filter.judged(pages.limit(0), rules).count() == 0
    assert url_filter.judged(pages, rules).count() == 2 * len(URLS)


def test_query_equals_sql(spark):
    got = queries.op6_url_filter(spark, helpers.LARGER)
    assert compare(got, duck(helpers.LARGER), ORACLES["op6_url_filter"]) == []
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Python" not in plan and "Pandas" not in plan
