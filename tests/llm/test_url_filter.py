from pyspark.sql import functions as F

from gavelcast.llm import url_filter as u

RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"),
         ("block", "bad.net"), (None, "x/"), ("block", None)]
CASES = [
    ("https://a.example.org/es/x", "a.example.org", "/es/x", "example.org/es/", "block"),
    ("https://EXAMPLE.org/es", "example.org", "/es", "org/", "allow"),
    ("http://example.org/en/12?x#y", "example.org", "/en/12", "example.org/en/1", "block"),
    ("http://notexample.org/es/", "notexample.org", "/es/", "org/", "allow"),
    ("http://org/", "org", "/", "org/", "allow"), ("http://org", "org", "", None, "allow"),
    ("http://a.b.com/de/q", "a.b.com", "/de/q", "com/de/", "block"), ("x://h?://a.com/de/", "h", "", None, "allow"),
    ("http://www.bad.net#f", "www.bad.net", "", "bad.net", "block"), ("http://bad.net:80/", "bad.net:80", "/", None, "allow"),
    ("no scheme", "", "", None, "allow"), ("", "", "", None, "allow"), (None, "", "", None, "allow"),
    ("://x.com/fr/", "x.com", "/fr/", "com/fr/", "allow"), ("http://x..com/DE/", "x..com", "/DE/", None, "allow"),
    ("http://\u00c9.com/de/\n" + "p" * 5000, "\u00c9.com", "/de/\n" + "p" * 5000, "com/de/", "block"),
]


def test_cases(spark):
    pages = spark.createDataFrame([(i, row[0]) for i, row in enumerate(CASES)] * 2, "page_id long, url string").withColumns(
        {"rule": F.lit("mine"), "digest": F.lit(1), "prefix": F.lit(2)})
    for limit in (100, 0):
        got = u.judge(pages, u.rule_table(spark, RULES), broadcast_rules=limit)
        rows = got.collect()
        assert len(rows) == 2 * len(CASES) and "digest" in got.columns
        for r in rows:
            assert (r["host"], r["path"], r["rule"], r["verdict"]) == CASES[r["page_id"]][1:], r


def test_without_rules_and_without_pages(spark):
    pages = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    none = u.rule_table(spark, [])
    assert u.judge(pages, none, default="block").first()["verdict"] == "block"
    assert u.judge(pages.where("false"), u.rule_table(spark, RULES)).count() == 0


def test_of_two_rules_of_one_string_allow_wins(spark):
    pages = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    both = u.rule_table(spark, [("block", "org/"), ("allow", "ORG/")])
    assert u.judge(pages, both).first()["verdict"] == "allow"
