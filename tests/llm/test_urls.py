from __future__ import annotations

import pytest

from sluicework.llm import urls
from sluicework.llm.queries import HOST_RULES, ORACLES, QUERIES
from tests.compare import connect, difference

FOLDER = "/root/testdata/sf0.01"
RULES = (*HOST_RULES, *urls.SPAM_RULES)
CASES = {
    "http://a.example.com/en/1?x": ("a.example.com", "/en/1", "example.com/en/", "block"),
    "https://WWW.Example.com/en/": ("www.example.com", "/en/", "www.example.com/en/", "allow"),
    "https://x.www.example.com/en/q#f": ("x.www.example.com", "/en/q", "www.example.com/en/", "allow"),
    "http://notexample.com/en/1": ("notexample.com", "/en/1", "com/", "allow"),
    "http://example.com/EN/1": ("example.com", "/EN/1", "com/", "allow"),
    "http://example.com/en": ("example.com", "/en", "com/", "allow"),
    "http://example.com": ("example.com", "", None, "allow"),
    "http://example.com?/en/": ("example.com", "", None, "allow"),
    "http://a.net/es/x": ("a.net", "/es/x", "net/es/", "block"),
    "http://a.net/fr/": ("a.net", "/fr/", "net/fr/", "block"),
    "http://a.net/de/": ("a.net", "/de/", None, "allow"),
    "http://a.org/Cheap-Pills/now": ("a.org", "/Cheap-Pills/now", None, "block"),
    "http://www.cheap-pills.example.org/": ("www.cheap-pills.example.org", "/", None, "block"),
    "http://a.org/cheappills": ("a.org", "/cheappills", None, "allow"),
    "http://cheap-pills.com/": ("cheap-pills.com", "/", "com/", "allow"),
    "ftp://h://x/y": ("h:", "//x/y", None, "allow"),
    "free casino": ("", "", None, "block"),
    "://": ("", "", None, "allow"),
    "": ("", "", None, "allow"),
    "http://x.com:80/": ("x.com:80", "/", None, "allow"),
    "line\nhttp://a.com/\nb": ("a.com", "/\nb", "com/", "allow"),
}


def test_cases_and_messy_rows(spark):
    rows = [(i, u, "h") for i, u in enumerate(CASES)] + [(100, None, "h"), (None, "http://a.net/es/x", "h"), (0, next(iter(CASES)), "h")]
    pages = spark.createDataFrame(rows, "page_id long, url string, rule string")
    got = sorted((r.page_id is None, r.page_id or 0, r.host, r.path, r.rule if r.tier == 1 else None, r.verdict) for r in urls.filter_urls(pages, RULES).collect())
    expected = [(i is None, i or 0, *(CASES[u] if u is not None else ("", "", None, "allow"))) for i, u, _ in rows]
    assert [tuple(map(str, g)) for g in got] == sorted(tuple(map(str, e)) for e in expected) or sorted(map(str, got)) == sorted(map(str, expected))
    assert urls.filter_urls(pages.filter("false"), RULES).count() == 0
    assert {r.verdict for r in urls.filter_urls(pages, ()).collect()} == {"allow"}


def test_query_equals_its_twin(spark):
    got = QUERIES["op7_url_filter"](spark, FOLDER).toPandas()
    assert difference(got, connect(FOLDER).execute(ORACLES["op7_url_filter"]).df()) == ""


def test_rules_are_filed_under_the_rarest_token(spark):
    targets = spark.createDataFrame([("a.com/x",), ("b.com/x",), ("cheap.com/pills",)], "target string")
    rules = urls._rule_table(spark, (urls.host_rule("allow", "com"), urls.word_rule("block", "com", "x"), urls.word_rule("block", "com", "never")))
    filed = {r.rule: r.token for r in urls.index(rules, targets).collect()}
    assert filed == {"com/": "com", "com-x": "x", "com-never": "never"}


@pytest.mark.parametrize("kind", ["EvalPython", "MapInArrow", "MapInPandas", "ExistingRDD", "Cartesian", "NestedLoop"])
def test_filter_runs_without_python(spark, kind):
    assert kind not in QUERIES["op7_url_filter"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
