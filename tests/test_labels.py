import random
from datetime import date, timedelta

import pytest

from holdfast.operators.labels import label_churn, label_churn_colocated, label_churn_window, safe_zone

FORMS = [label_churn, label_churn_window, label_churn_colocated]
SNAPSHOT = "user_id long, event_date date, note string"
HISTORY = "user_id long, activity_date date"
START = date(2024, 1, 1)


def day(n):
    return START + timedelta(days=n)


def labels(df):
    return {(r.user_id, r.event_date): r.label for r in df.collect()}


@pytest.mark.parametrize("form", FORMS)
def test_horizon_edges(spark, form):
    users = {1: 10, 2: 17, 3: 18, 4: 11}
    snapshot = spark.createDataFrame([(u, day(10), "a") for u in users], SNAPSHOT)
    history = [(u, day(n)) for u, n in users.items()] + [(9, day(60))]
    found = labels(form(snapshot, spark.createDataFrame(history, HISTORY)))
    # the same day does not count, days 1 and 7 do, day 8 does not
    assert found == {(1, day(10)): 1, (2, day(10)): 0, (3, day(10)): 1, (4, day(10)): 0}


@pytest.mark.parametrize("form", FORMS)
def test_duplicates_nulls_and_empty_history(spark, form):
    snapshot = spark.createDataFrame(
        [(1, day(0), "a"), (1, day(0), "a"), (1, day(0), "b"), (None, day(0), "c")], SNAPSHOT
    )
    history = spark.createDataFrame(
        [(1, day(3)), (1, day(3)), (None, day(2)), (2, None), (5, day(40))], HISTORY
    )
    rows = sorted((r.note, r.label) for r in form(snapshot, history).collect())
    assert rows == [("a", 0), ("b", 0), ("c", 1)]
    assert form(snapshot, history.limit(0)).count() == 0


@pytest.mark.parametrize("form", FORMS)
@pytest.mark.parametrize("horizon", [1, 7, 10])
def test_forms_match_brute_force(spark, form, horizon):
    rnd = random.Random(horizon)
    # user 0 holds a third of all rows
    users = [0 if rnd.random() < 0.33 else rnd.randrange(1, 12) for _ in range(400)]
    snapshot = {(u, day(rnd.randrange(-40, 40)), "x") for u in users}
    history = {(u if rnd.random() < 0.3 else 99, day(rnd.randrange(-40, 60))) for u in users}
    last = max(d for _, d in history)
    expected = {
        (u, d): int(not any(hu == u and 0 < (hd - d).days <= horizon for hu, hd in history))
        for u, d, _ in snapshot
        if d <= last - timedelta(days=horizon)
    }
    frames = (
        spark.createDataFrame(list(snapshot), SNAPSHOT),
        spark.createDataFrame(list(history), HISTORY),
    )
    assert labels(form(*frames, horizon)) == expected


def test_unique_snapshots_need_no_second_shuffle(spark):
    snapshot = spark.createDataFrame([(1, day(0), "a"), (1, day(0), "a"), (2, day(0), "b")], SNAPSHOT)
    history = spark.createDataFrame([(1, day(3)), (5, day(40))], HISTORY)
    rows = sorted((r.user_id, r.label) for r in label_churn(snapshot, history, deduplicate=False).collect())
    assert rows == [(1, 0), (1, 0), (2, 1)]


def test_safe_zone_keeps_observed_horizons(spark):
    snapshot = spark.createDataFrame([(1, day(n), "") for n in range(5)], SNAPSHOT)
    history = spark.createDataFrame([(1, day(9))], HISTORY)
    assert {r.event_date for r in safe_zone(snapshot, history).collect()} == {day(0), day(1), day(2)}
