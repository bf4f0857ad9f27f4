"""The shape of physical plans: what is pushed down, shuffled and broadcast."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from holdfast.operators.filters import critical_targets, for_users
from holdfast.operators.labels import label_churn
from holdfast.operators.shows import top_shows, watch_minutes
from holdfast.plans.campaign import with_facts
from holdfast.plans.content import content_list, with_titles
from holdfast.plans.outbox import delivery_list, with_items
from holdfast.session import materialise
from holdfast.sources.standins import LAST_SNAPSHOT as DAY
from holdfast.sources.standins import Inputs
from holdfast.sources.tables import activity_history

DATA = "/root/testdata/sf0.001"
LAZY = [
    "content_list",
    "churn_labels",
    "churn_labels_window",
    "features",
    "target_facts",
    "final_copy_prompt",
    "poster_lookup",
    "semi_join_users",
    "top_shows",
]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    df.collect()
    return plan(df).split("== Initial Plan ==")[0]


@pytest.fixture
def inputs(spark):
    return Inputs(spark, DATA)


@pytest.fixture
def no_broadcast(conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")


def without_subqueries(text):
    """The plan's lines but for those below a subquery, which are one-row aggregates."""
    kept, inside = [], None
    for line in text.splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        if inside is not None and depth > inside:
            continue
        inside = depth if "Subquery subquery" in line else None
        kept.append(line)
    return kept


def test_lists_and_texts_are_not_shuffled_for_posters(spark, inputs, no_broadcast):
    lines = plan(entry_points.queries()["outbox_posters"](spark, DATA)).splitlines()
    assert not any("Exchange hashpartitioning(rec_list" in line for line in lines)


@pytest.mark.parametrize("name", LAZY)
def test_no_products_and_no_single_task_windows(spark, name, no_broadcast):
    text = plan(entry_points.queries()[name](spark, DATA))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in text
    assert not any("Exchange SinglePartition" in line for line in without_subqueries(text))


def test_event_scan_reads_what_it_needs(inputs):
    text = plan(content_list(inputs.watch_events, inputs.content_master, DAY))
    scan = next(line for line in text.splitlines() if "events.parquet" in line)
    assert "EqualTo(event_type,view)" in scan and "GreaterThanOrEqual(ts," in scan
    assert "event_id" not in scan


def test_rank_limit_runs_before_the_shuffle(inputs):
    text = plan(top_shows(watch_minutes(inputs.watch_events)))
    assert text.count("WindowGroupLimit") == 2 and "row_number(), 5, Partial" in text


def test_watch_minutes_are_summed_before_the_user_join(inputs, no_broadcast):
    users = inputs.campaign_targets.select("user_id")
    lines = plan(content_list(inputs.watch_events, inputs.content_master, DAY, users)).splitlines()
    depth = {key: next(i for i, line in enumerate(lines) if key in line) for key in ("LeftSemi", "sum(session")}
    assert depth["LeftSemi"] < depth["sum(session"]


def test_few_users_filter_the_event_scan(inputs):
    users = inputs.campaign_targets.select("user_id").limit(5)
    lines = plan(content_list(inputs.watch_events, inputs.content_master, DAY, users)).splitlines()
    semi = next(i for i, line in enumerate(lines) if "LeftSemi" in line)
    assert "BroadcastHashJoin" in lines[semi]
    assert any("partial_sum(session" in line for line in lines[:semi])


def test_unbounded_keys_are_not_forced_to_broadcast(inputs, no_broadcast):
    targets = inputs.campaign_targets
    assert "BroadcastHashJoin" not in plan(for_users(inputs.watch_events, targets))
    assert "BroadcastHashJoin" not in plan(with_facts(targets, inputs.snapshot))


def test_target_limit_is_a_top_n(inputs):
    assert "TakeOrderedAndProject(limit=5" in plan(critical_targets(inputs.campaign_targets, DAY, 5))
    assert "TakeOrdered" not in plan(critical_targets(inputs.campaign_targets, DAY))


@pytest.fixture
def skew_settings(conf, no_broadcast):
    conf(
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="2000",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="2000",
        spark__sql__adaptive__coalescePartitions__enabled="false",
    )


def test_hot_user_is_split_in_the_label_join(spark, skew_settings):
    day = F.expr("date_add(date'2024-01-01', cast(id % 7 as int))")
    user = F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id"))
    snapshot = materialise(
        spark.range(0, 60_000, 1, 16).select(
            user.alias("user_id"), day.alias("event_date"), F.col("id").alias("row")
        )
    )
    history = spark.createDataFrame(
        [(-1, date(2024, 1, 5)), (5, date(2024, 1, 30))], "user_id long, activity_date date"
    )
    labelled = label_churn(snapshot, history)
    assert "skew=true" in final_plan(labelled)
    assert labelled.filter("label = 0").count() == snapshot.filter(
        "user_id = -1 and event_date < '2024-01-05'"
    ).count()
    assert labelled.count() == 60_000


def test_hot_user_is_split_in_the_delivery_join(spark, skew_settings):
    users = spark.createDataFrame([(-1, 1, "F", "p", None, "e")], "user_id long, age int, gender string, plan string, churn_date date, user_email string")
    messages = materialise(
        spark.range(0, 60_000, 1, 16).select(
            F.lit(DAY).alias("event_date"),
            F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("user_id"),
            F.lit("Save").alias("strategy_code"),
            F.sha2(F.col("id").cast("string"), 256).alias("push_title"),
            F.lit(False).alias("skipped"),
        )
    )
    delivery = delivery_list(messages, users, DAY)
    assert "skew=true" in final_plan(delivery)
    assert delivery.filter("user_email = 'e'").count() == 20_000


def test_hot_user_is_split_in_the_user_filter(spark, skew_settings):
    events = materialise(
        spark.range(0, 60_000, 1, 16).select(
            F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("user_id"),
            F.sha2(F.col("id").cast("string"), 256).alias("props"),
        )
    )
    users = spark.createDataFrame([(-1,), (-1,), (7,), (None,)], "user_id long")
    kept = for_users(events, users)
    assert "skew=true" in final_plan(kept)
    assert kept.count() == 20_001


def test_hot_show_is_split_in_the_title_join(spark, skew_settings):
    shows = materialise(
        spark.range(0, 60_000, 1, 16).select(
            F.sha2(F.col("id").cast("string"), 256).alias("user_id"),
            F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("show_id"),
            F.lit(1).alias("rn"),
        )
    )
    master = spark.createDataFrame([(-1, "hot"), (-1, "other"), (7, "seven")], "show_id long, title string")
    listed = with_titles(shows, master).groupBy("user_id").agg(F.collect_list("title").alias("titles"))
    assert "skew=true" in final_plan(listed)
    assert listed.filter("titles[0] = 'hot'").count() == 20_000


def test_hot_list_is_split_in_the_outbox(spark, skew_settings):
    recs = F.array(
        F.struct(
            F.when(F.col("id") % 3 == 0, "same").otherwise(F.col("id").cast("string")).alias("title"),
            F.lit("d").alias("description"),
        )
    )
    delivery = materialise(
        spark.range(0, 30_000, 1, 16).select(
            F.lit(DAY).alias("event_date"),
            F.col("id").alias("user_id"),
            F.sha2(F.col("id").cast("string"), 256).alias("user_email"),
            recs.alias("rec_list"),
        )
    )
    posters = spark.createDataFrame([("same", "tv", "/s.jpg")], "title string, media_type string, poster_path string")
    found = with_items(delivery, posters)
    assert "skew=true" in final_plan(found)
    assert found.filter("items[0].poster like '%/s.jpg'").count() == 10_000
    assert found.count() == 30_000


def test_labels_shuffle_the_snapshot_twice_at_most(inputs, no_broadcast):
    snapshot = materialise(inputs.snapshot)
    history = materialise(activity_history(inputs.daily_watch_time))
    text = plan(label_churn(snapshot, history))
    assert text.count("Exchange hashpartitioning") == 4  # two of the snapshot, two of the history
    last = history.agg(F.max("activity_date")).first()[0]
    assert label_churn(snapshot, history).agg(F.max("event_date")).first()[0] <= last - timedelta(days=7)
