"""Columns of the caller that are named like an operator's own."""

from pyspark.sql import functions as F

from holdfast.llm.columns import unused
from holdfast.llm.neardup import keep_one, near_duplicates
from holdfast.llm.packing import pack
from holdfast.llm.urls import judge_urls


def test_unused_names():
    assert unused("a", ["b"]) == "a" and unused("a", ["A", "_a"]) == "__a"


def test_near_duplicates(docs):
    words = "one two three four five six seven"
    rows = docs(words, words, "else").withColumns({"rid": F.col("doc_id") * 10, "label": F.lit("x"), "n": F.lit(1)})
    found = near_duplicates(rows, keep=["rid", "label", "n"]).orderBy("doc_id").collect()
    assert [(r["doc_id"], r["rid"], r["label"], r["n"], r["component_id"]) for r in found] == [
        (0, 0, "x", 1, 0),
        (1, 10, "x", 1, 0),
        (2, 20, "x", 1, 2),
    ]
    kept = keep_one(rows.withColumnRenamed("n", "kept"))
    assert kept.columns == [*rows.columns[:-1], "kept"] and sorted(r["rid"] for r in kept.collect()) == [0, 20]


def test_packing(docs):
    rows = docs("a b", "c").selectExpr("doc_id", "text", "doc_id + 5 as size", "'r' as room", "'x' as `at`", "7 as _length")
    found = pack(rows, keep=["doc_id", "size", "room", "at", "_length"]).orderBy("doc_id").collect()
    assert [(r["size"], r["room"], r["at"], r["_length"], r["length"]) for r in found] == [(5, "r", "x", 7, 2), (6, "r", "x", 7, 1)]


def test_urls(spark):
    pages = spark.createDataFrame([(1, "http://a.net/", "mine", "own")], "page_id int, url string, best string, _best string")
    (row,) = judge_urls(pages, [("block", "net", "/")]).collect()
    assert (row["best"], row["_best"], row["verdict"]) == ("mine", "own", "block")
