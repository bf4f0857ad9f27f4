"""Tables in buckets of users: joins without a shuffle, and the same results as with one."""

import uuid

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from holdfast.operators.joins import colocated_lookup
from holdfast.operators.labels import label_churn_colocated
from holdfast.sources.colocated import save_colocated

ROWS = "user_id bigint, day int, plan string, n int"


@pytest.fixture
def bucketed(spark, tmp_path):
    def save(df, buckets=4):
        name = f"t_{uuid.uuid4().hex}"
        return save_colocated(df, name, f"{tmp_path}/{name}", buckets, sort=df.columns[1:2])

    return save


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_facts_and_users_meet_without_exchange(spark, bucketed):
    users = spark.range(500).select(F.col("id").alias("user_id"), F.lit("2024-01-30").cast("date").alias("event_date"), F.lit("p").alias("plan"))
    asked = bucketed(users.select("user_id", "event_date"))
    kept = bucketed(users.union(users))
    for per in (None, "event_date"):
        got = colocated_lookup(asked, kept, ["plan"], "user_id", per)
        assert "SortMergeJoin" in plan(got) and "Exchange" not in plan(got)
        assert got.filter("plan = 'p'").count() == 500


def test_labels_need_no_exchange(spark, bucketed):
    snapshot = bucketed(spark.sql("select id % 50 as user_id, date_add(date '2024-01-01', cast(id / 50 as int)) as event_date, 's' as segment from range(1000)"))
    history = bucketed(spark.sql("select id % 40 as user_id, date_add(date '2024-01-01', cast(id / 40 as int)) as activity_date from range(1200)"))
    got = label_churn_colocated(snapshot, history)
    assert "SortMergeJoin" in plan(got) and "Exchange hashpartitioning" not in plan(got)  # the last day alone comes together
    assert {r["user_id"] for r in got.filter("label = 1").collect()} == set(range(40, 50))


def test_every_bucket_is_one_file(spark, bucketed):
    table = bucketed(spark.range(10_000).select(F.col("id").alias("user_id"), F.lit(1).alias("day")))
    assert len(table.inputFiles()) == 4 and table.count() == 10_000
    with pytest.raises(ValueError, match="one bucket"):
        bucketed(spark.range(1), buckets=0)


def test_null_keys_repeats_and_empty_tables(spark, bucketed):
    left = spark.createDataFrame([(1, 1, "a"), (1, 1, "a"), (1, 2, "b"), (None, 1, "c"), (2, None, "d")], "user_id bigint, day int, note string")
    right = spark.createDataFrame([(1, 1, "x", 2), (1, 1, "x", 1), (1, 3, "y", 0), (None, 1, "z", 9), (2, None, "w", 8)], ROWS)
    wanted = [("a", "x", 1), ("a", "x", 1), ("b", None, None), ("c", None, None), ("d", None, None)]
    for form in (lambda df: df, bucketed):
        got = colocated_lookup(form(left), form(right), ["plan", "n"], "user_id", "day")
        assert got.columns == ["user_id", "day", "note", "plan", "n"]
        assert sorted(map(tuple, got.select("note", "plan", "n").collect()), key=str) == sorted(wanted, key=str)
        nothing = colocated_lookup(form(left), form(right.limit(0)), ["plan"], "user_id", "day")
        assert nothing.filter("plan is null").count() == 5
        assert colocated_lookup(form(left.limit(0)), form(right), ["plan"], "user_id").count() == 0


def test_queries_agree_with_the_shuffled_forms(spark):
    queries = entry_points.queries()
    for name in ("churn_labels", "target_facts"):
        plain, other = (queries[n](spark, "/root/testdata/sf0.001") for n in (name, f"{name}_colocated"))
        assert other.columns == plain.columns
        assert other.exceptAll(plain).count() == plain.exceptAll(other).count() == 0
