from datetime import date

import pytest
from pyspark.errors import PySparkException

from holdfast.sources.tables import activity_history, read_date, read_table, replace_date

SCHEMA = "event_date date, user_id long"
D1, D2 = date(2024, 1, 1), date(2024, 1, 2)


def ids(df):
    return sorted(r.user_id for r in df.collect())


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "table")
    replace_date(spark.createDataFrame([(D1, 1), (D1, 2)], SCHEMA), path, D1)
    replace_date(spark.createDataFrame([(D2, 3)], SCHEMA), path, "2024-01-02")
    return path


def test_replaces_one_date_only(spark, table):
    assert replace_date(spark.createDataFrame([(D2, 9), (D2, 8)], SCHEMA), table, D2) == 2
    assert ids(read_date(spark, table, D1)) == [1, 2]
    assert ids(read_date(spark, table, D2)) == [8, 9]


def test_running_again_changes_nothing(spark, table):
    rows = spark.createDataFrame([(D1, 1), (D1, 2)], SCHEMA)
    replace_date(rows, table, D1)
    replace_date(rows, table, D1)
    assert ids(read_table(spark, table)) == [1, 2, 3]


@pytest.mark.parametrize("stray", [D1, None])
def test_row_of_another_date_is_rejected(spark, table, stray):
    with pytest.raises(PySparkException, match="got a row of date"):
        replace_date(spark.createDataFrame([(D2, 9), (stray, 7)], SCHEMA), table, D2)
    assert ids(read_table(spark, table)) == [1, 2, 3]


def test_empty_frame_clears_the_date(spark, table):
    assert replace_date(spark.createDataFrame([], SCHEMA), table, D2) == 0
    assert ids(read_date(spark, table, D2)) == []
    assert ids(read_table(spark, table)) == [1, 2]


def test_new_columns_are_merged_on_read(spark, table):
    wider = spark.createDataFrame([(D2, 3, "x")], SCHEMA + ", note string")
    replace_date(wider, table, D2)
    merged = read_table(spark, table, merge_schema=True)
    assert {(r.user_id, r.note) for r in merged.collect()} == {(1, None), (2, None), (3, "x")}


def test_read_date_prunes_partitions(spark, table):
    plan = read_date(spark, table, D1)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan


def test_activity_history_renames(spark):
    df = spark.createDataFrame([(D1, 1, 2.0)], SCHEMA + ", minutes double")
    assert activity_history(df).columns == ["user_id", "activity_date"]
