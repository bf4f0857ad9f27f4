"""Every registered query against its SQL, and the entry points."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points
from holdfast.catalog.oracles import oracle_queries
from holdfast.catalog.queries import registered_queries

DATA = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in DATA.glob("*.parquet"):
        connection.execute(f"create view {file.stem} as select * from '{file}'")
    return connection


def _rows(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(str(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(entry_points.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    df = entry_points.queries()[name](spark, str(DATA))
    result = duck.execute(entry_points.oracle_sql()[name])
    columns = [column[0] for column in result.description]
    assert sorted(df.columns) == sorted(columns)
    expected = _rows(result.fetchall(), columns)
    assert _rows(df.collect(), df.columns) == expected
    assert expected


def test_only_trained_models_lack_sql():
    missing = set(registered_queries()) - set(oracle_queries())
    assert missing == {"model_metrics", "daily_scores"}


def test_entry_gives_rows(spark):
    assert entry_points.entry(spark).count() == 2


def test_audited_publish_of_users_idle_beyond_20_days(spark, tmp_path):
    con = duckdb.connect()
    con.execute("""create table events as select u as event_id, timestamp '2024-01-01 08:00:00' + to_days(cast(u as int)) as ts,
        u as user_id, 'view' as event_type, 5.0::double as value, '{"k": 1}' as props from range(30) t(u)""")
    con.execute("create table customer as select u as c_custkey, 'BUILDING' as c_mktsegment from range(30) t(u)")
    for name in ("events", "customer"):
        con.execute(f"copy {name} to '{tmp_path}/{name}.parquet'")
    for file in DATA.glob("*.parquet"):
        if file.stem not in ("events", "customer"):
            con.execute(f"create view {file.stem} as select * from '{file}'")
    result = con.execute(oracle_queries()["audited_publish"])
    columns = [column[0] for column in result.description]
    expected = _rows(result.fetchall(), columns)
    df = registered_queries()["audited_publish"](spark, str(tmp_path))
    assert _rows(df.collect(), df.columns) == expected
    assert len(expected) == 30 and df.agg({"churn_probability": "max"}).first()[0] == 1.27
