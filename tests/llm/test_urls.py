from pyspark.sql import functions as F

from holdfast.llm.urls import Cascade, judge_urls

RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("allow", "org", "/fr/")]


def _judged(spark, *urls):
    rows = spark.createDataFrame([(i, u, "old") for i, u in enumerate(urls)], "page_id int, url string, host string")
    return [tuple(r)[2:] for r in judge_urls(rows, RULES).orderBy("page_id").collect()]


def test_rules(spark):
    got = _judged(
        spark,
        "https://A.example.NET/en/x?q#f",
        "http://example.net/de/",
        "http://example.net",
        None,
        "no scheme",
        "http://x.org/fr/?a",
        "http://notnet/",
        "http://a..net/%41",
        "x://net/://y",
        "http://" + "a." * 3000 + "net/" + "p" * 5000,
    )
    assert got[:4] == [
        ("a.example.net", "/en/x", "example.net/en/", "allow"),
        ("example.net", "/de/", "net/", "block"),
        ("example.net", "", None, "allow"),
        ("", "", None, "allow"),
    ]
    assert [g[2:] for g in got[4:9]] == [
        (None, "allow"), ("org/fr/", "allow"), (None, "allow"), ("net/", "block"), ("net/", "block"),
    ]
    assert got[9][2] == "net/"
    assert _judged(spark) == []


def test_no_rules(spark):
    rows = spark.createDataFrame([(1, "http://a/b")], "page_id int, url string")
    assert judge_urls(rows, []).first()["verdict"] == "allow"


def test_cascade_is_exact_for_its_universe(spark, monkeypatch):
    monkeypatch.setattr("holdfast.llm.urls.BITS", 2)  # many wrong positives, so several levels
    universe = spark.range(20_000).select(F.col("id").cast("string").alias("key"))
    cascade = Cascade(universe.filter("cast(key as int) % 7 = 0"), universe)
    assert len(cascade.levels) > 2
    wrong = universe.filter(cascade.member(F.col("key")) != (F.col("key").cast("int") % 7 == 0))
    assert wrong.count() == 0


def test_main_path_has_no_python(spark):
    rows = spark.createDataFrame([(1, "http://a/b")], "page_id int, url string")
    plan = judge_urls(rows, RULES)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Join" not in plan
