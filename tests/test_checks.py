from datetime import date

import pytest

from holdfast.operators import checks
from holdfast.operators.filters import is_suppressed, latest_date, pick_date, trailing_days
from holdfast.plans.content import titles, with_titles


def test_required_columns(spark):
    df = spark.range(1)
    assert checks.require_columns(df, ["id"]) is df
    with pytest.raises(ValueError, match=r"\['a', 'b'\]"):
        checks.require_columns(df, ["b", "id", "a"])


def test_required_rows_and_values(spark):
    df = spark.createDataFrame([(1,), (None,)], "x int")
    assert checks.require_rows(df, "none") is df
    with pytest.raises(RuntimeError, match="none today"):
        checks.require_rows(df.limit(0), "none today")
    with pytest.raises(RuntimeError, match="x"):
        checks.require_not_null(df, "x")
    checks.require_not_null(df.dropna(), "x")


def test_two_classes(spark):
    both = spark.createDataFrame([(0,), (1,)], "label int")
    assert checks.require_two_classes(both) is both
    for rows in (both.filter("label = 1"), both.limit(0)):
        with pytest.raises(ValueError):
            checks.require_two_classes(rows)


DATES = "event_date date"


def test_latest_date(spark):
    df = spark.createDataFrame([(date(2024, 1, n),) for n in (3, 5, 9)], DATES)
    assert pick_date(df, as_of=date(2024, 1, 9)) == date(2024, 1, 5)
    assert pick_date(df, as_of=date(2024, 1, 2)) == date(2024, 1, 1)
    assert pick_date(df, as_of=date(2024, 1, 9), day=" 2024-01-03 ") == date(2024, 1, 3)
    assert pick_date(df) == date(2024, 1, 9)
    assert latest_date(df, date(2024, 1, 10)).first().event_date == date(2024, 1, 9)


def test_trailing_days_are_exact(spark):
    df = spark.sql("select explode(sequence(date'2024-01-01', date'2024-03-10')) as event_date")
    kept = trailing_days(df, "2024-03-01", 30).agg({"event_date": "min"}).first()[0]
    assert kept == date(2024, 2, 1)
    assert trailing_days(df, "2024-03-01", 30).count() == 30


def test_suppression(spark):
    rows = [(1, "Save"), (0, "Save"), (None, "Save"), (1, "Calm"), (1, None)]
    df = spark.createDataFrame(rows, "send_flag int, strategy_code string")
    assert [r[0] for r in df.select(is_suppressed()).collect()] == [False, True, False, True, False]


def test_title_columns_are_resolved(spark):
    shows = spark.createDataFrame([(1,), (2,), (3,)], "show_id long")
    named = spark.createDataFrame(
        [(1, "B"), (1, "A"), (2, None)], "showId long, primaryTitle string"
    )
    assert sorted(r.title for r in with_titles(shows, named).collect()) == ["2", "3", "A"]
    unusable = spark.createDataFrame([(1, "x")], "code long, label string")
    assert titles(unusable) is None
    assert sorted(r.title for r in with_titles(shows, unusable).collect()) == ["1", "2", "3"]
