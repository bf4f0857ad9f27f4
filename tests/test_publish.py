import os
from concurrent.futures import ThreadPoolExecutor
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from holdfast.catalog.queries import fixed_forest
from holdfast.functions.types import common_type, enforce_types
from holdfast.sources import publish, registry
from holdfast.sources.files import Store
from holdfast.sources.publish import Refused, no_null, publish_date, read_published, rows_between
from holdfast.sources.tables import replace_date

D1, D2, D3 = date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 3)


def frame(spark, kind, *rows):
    return spark.createDataFrame(list(rows), f"event_date date, user_id bigint, x {kind}")


def stored(spark, path):
    return sorted((tuple(r) for r in read_published(spark, path).select("event_date", "user_id", "x").collect()), key=str)


def left_over(path):
    return [n for n in os.listdir(path) if n.startswith(("_staged", "_replaced"))]


def test_a_broken_expectation_leaves_the_date(spark, tmp_path):
    path = str(tmp_path)
    assert publish_date(frame(spark, "int", (D1, 1, 5)), path, D1, [rows_between(1)])["rows"] == 1
    before = sorted(os.listdir(f"{path}/event_date={D1}"))
    bad = frame(spark, "int", (D1, 7, 7), (D1, None, 8))
    with pytest.raises(Refused) as error:
        publish_date(bad, path, D1, [rows_between(1), no_null("user_id"), publish.Expectation("sum", F.sum("x"), high=15)])
    assert error.value.broken == {"null user_id": 1.0}
    with pytest.raises(Refused, match="other dates"):
        publish_date(frame(spark, "int", (D1, 1, 1), (D2, 1, 1), (None, 1, 1)), path, D1)
    with pytest.raises(Refused, match="rows"):
        publish_date(bad.limit(0), path, D1, [rows_between(1)])
    assert sorted(os.listdir(f"{path}/event_date={D1}")) == before and not left_over(path)
    publish_date(bad.limit(0), path, D1)
    assert stored(spark, path) == [] and not left_over(path)


def test_a_failing_task_leaves_the_date(spark, tmp_path):
    path = str(tmp_path)
    publish_date(frame(spark, "int", (D1, 1, 5)), path, D1)
    failing = frame(spark, "int", (D1, 2, 6)).withColumn("x", F.raise_error(F.lit("broken")).cast("int"))
    with pytest.raises(Exception, match="broken"):
        publish_date(failing, path, D1)
    assert stored(spark, path) == [(D1, 1, 5)] and not left_over(path)


def test_a_run_that_died_between_the_renames_is_mended(spark, tmp_path):
    path = str(tmp_path)
    publish_date(frame(spark, "int", (D1, 1, 5)), path, D1)
    Store(spark, path).move(f"event_date={D1}", f"_replaced-{D1}")
    with pytest.raises(Refused):
        publish_date(frame(spark, "int", (D1, 1, 6)), path, D1, [rows_between(2)])
    assert stored(spark, path) == [(D1, 1, 5)]


def test_columns_widen_come_and_go(spark, tmp_path):
    path = str(tmp_path)
    publish_date(frame(spark, "int", (D1, 1, 2**31 - 1)).withColumn("old", F.lit("a")), path, D1)
    publish_date(frame(spark, "bigint", (D2, 2, 2**40)), path, D2)
    publish_date(frame(spark, "double", (D3, 3, 0.5)).withColumn("new", F.lit(1)), path, D3)
    table = read_published(spark, path)
    assert dict(table.dtypes) == {"user_id": "bigint", "x": "double", "old": "string", "new": "int", "event_date": "date"}
    rows = {r.user_id: r.asDict() for r in table.collect()}
    assert [rows[i]["x"] for i in (1, 2, 3)] == [2.0**31 - 1, 2.0**40, 0.5]
    assert [rows[i]["old"] for i in (1, 2, 3)] == ["a", None, None] and [rows[i]["new"] for i in (1, 2, 3)] == [None, None, 1]
    with pytest.raises(TypeError, match="x is string, other dates have double"):
        publish_date(frame(spark, "string", (D1, 1, "z")), path, D1)
    # Once the double is gone the table is as wide as what is left; narrower rows are cast to it.
    publish_date(frame(spark, "smallint", (D3, 3, 9)), path, D3)
    assert dict(read_published(spark, path).dtypes)["x"] == "bigint"
    assert stored(spark, path)[-1] == (D3, 3, 9)
    plan = read_published(spark, path).filter(F.col("event_date") == F.lit(D2))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(event_date") == plan.count("FileScan parquet") > 0


def test_dates_without_types_are_read_by_their_files(spark, tmp_path):
    path = str(tmp_path)
    replace_date(frame(spark, "int", (D1, 1, 5)), path, D1)
    publish_date(frame(spark, "bigint", (D2, 2, 2**40)), path, D2)
    assert stored(spark, path) == [(D1, 1, 5), (D2, 2, 2**40)]
    with pytest.raises(LookupError):
        read_published(spark, f"{path}/none")


@pytest.mark.parametrize(
    "one, other, both",
    [
        ("int", "bigint", "bigint"),
        ("tinyint", "float", "double"),
        ("int", "decimal(5,2)", "decimal(12,2)"),
        ("decimal(38,0)", "decimal(10,5)", None),
        ("date", "timestamp_ntz", "timestamp_ntz"),
        ("array<int>", "array<double>", "array<double>"),
        ("string", "int", None),
        ("decimal(5,2)", "double", None),
    ],
)
def test_common_types(one, other, both):
    one, other = DataType.fromDDL(one), DataType.fromDDL(other)
    assert common_type(one, other) == common_type(other, one) == (DataType.fromDDL(both) if both else None)


def test_wrong_types_fail_before_any_task(spark):
    df = spark.createDataFrame([(1, Decimal("1.50"), "x")], "a int, b decimal(5,2), c string")
    df = df.withColumn("a", F.raise_error(F.lit("a task ran")).cast("int"))
    kinds = {n: DataType.fromDDL(k) for n, k in {"a": "double", "b": "double", "c": "int", "d": "int"}.items()}
    with pytest.raises(TypeError, match=r"b is decimal\(5,2\), not double; c is string, not int; d is missing"):
        enforce_types(df, kinds)
    assert enforce_types(df, {"a": kinds["a"]}).dtypes[0] == ("a", "double")


def test_stored_signature_is_enforced(spark, tmp_path):
    root, forest = str(tmp_path), fixed_forest()
    example = spark.createDataFrame([[1.0] * len(forest.inputs)], ", ".join(f"{c} double" for c in forest.inputs))
    registry.save_model(forest, root, {}, example=example)
    registry.save_model(forest, root, {})
    assert registry.load_signature(spark, root) is None
    signature = registry.load_signature(spark, root, version=1)
    assert list(signature.inputs) == list(forest.inputs) and list(signature.outputs) == ["churn_probability"]
    assert signature.check_inputs(example.withColumn(forest.inputs[0], F.lit(3))).first()[0] == 3.0
    with pytest.raises(TypeError, match=forest.inputs[0]):
        signature.check_inputs(example.withColumn(forest.inputs[0], F.lit("3")))
    with pytest.raises(TypeError, match="churn_probability is string"):
        signature.check_outputs(spark.createDataFrame([("x",)], "churn_probability string"))


def test_savers_at_once_get_numbers_of_their_own(spark, tmp_path):
    root = str(tmp_path)
    with ThreadPoolExecutor(4) as pool:
        versions = list(pool.map(lambda _: registry.save_model(fixed_forest(), root, {}), range(4)))
    assert sorted(versions) == [1, 2, 3, 4]
    numbers = [r.number for r in registry.aliases(spark, root).collect()]
    assert len(set(numbers)) == len(numbers) == 4
    assert registry.load_latest(spark, root).rounds == 2
    with ThreadPoolExecutor(8) as pool:
        claimed = list(pool.map(lambda _: Store(spark, root).claim_number("_numbers"), range(40)))
    assert sorted(claimed) == list(range(1, 41))
