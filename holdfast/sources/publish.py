"""Audited writes of one date, and tables whose columns change from date to date.

A date is written to a staging folder while expectations about its rows are measured in the same pass; it
takes the place of the stored date only if all of them hold. Each date carries the name of its column types in a marker file
that moves with the rows. A table is read as one scan per set of types, cast to the types that hold all dates, so a
column may widen, come or go without any stored date being written again.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterable, Sequence
from datetime import date
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from holdfast.functions.types import common_type, enforce_types
from holdfast.sources.files import Store
from holdfast.sources.tables import day_literal

_TYPES = "_types"


class Expectation(NamedTuple):
    """An aggregate over the written rows and the bounds it must keep; None is no bound."""

    name: str
    measure: Column
    low: float | None = None
    high: float | None = None

    def holds(self, value: float | None) -> bool:
        """A measure without a value, such as the smallest of no rows, holds if nothing bounds it."""
        if value is None or value != value:
            return self.low is None and self.high is None
        return (self.low is None or value >= self.low) and (self.high is None or value <= self.high)


class Refused(RuntimeError):
    """A date that was not published; ``broken`` has the measures out of bounds."""

    def __init__(self, day: date | str, broken: dict[str, float | None]):
        super().__init__(f"date {day} is not published: {broken}")
        self.broken = broken


def rows_between(low: int, high: int | None = None) -> Expectation:
    return Expectation("rows", F.count(F.lit(1)), low, high)


def no_null(column: str) -> Expectation:
    return none_where(f"null {column}", F.col(column).isNull())


def none_where(name: str, condition: Column) -> Expectation:
    """No row meets ``condition``; the measure is how many do."""
    return Expectation(name, F.count_if(F.coalesce(condition, F.lit(False))), high=0)


def publish_date(
    df: DataFrame, path: str, day: date | str, expectations: Sequence[Expectation] = (), column: str = "event_date"
) -> dict[str, float | None]:
    """Replace one date of the table at ``path`` if all expectations hold; returns the measures.

    Rows of another date, or of none, always refuse the write (``other dates``). A refused or failed write leaves the stored
    date as it was. Columns keep the widest type that any other date gave them; a type that has none in common
    with the stored one raises TypeError by name, before any task. No rows make an empty date.

    Two renames put the date in place. A run that dies between them leaves the old rows aside, and the next
    publish of that date puts them back first. Two writers of one date at once are not supported.
    """
    spark = df.sparkSession
    store = Store(spark, path)
    folder, aside = f"{column}={day}", f"_replaced-{day}"
    if store.exists(aside):
        if store.exists(folder):
            store.delete(aside)
        else:
            store.move(aside, folder)
    others = [schema for name, schema, _ in _dates_by_types(spark, path, column, but=folder)]
    rows = _in_stored_types(df, others, column)

    checks = [*expectations, none_where("other dates", ~F.col(column).eqNullSafe(day_literal(day)))]
    if len({c.name for c in checks}) < len(checks):
        raise ValueError("expectations need names of their own")
    seen = Observation()
    measures = [c.measure.cast("double").alias(f"m{i}") for i, c in enumerate(checks)]
    staged = f"_staged-{uuid.uuid4().hex}"
    try:
        rows.observe(seen, *measures).drop(column).write.parquet(f"{path}/{staged}")
        found = {c.name: seen.get[f"m{i}"] for i, c in enumerate(checks)}
        broken = {c.name: found[c.name] for c in checks if not c.holds(found[c.name])}
        if broken:
            raise Refused(day, broken)
        store.create(f"{staged}/{_TYPES}-{_keep_types(spark, path, rows.drop(column).schema)}")
        if store.exists(folder):
            store.move(folder, aside)
        store.move(staged, folder)
    except BaseException:
        if store.exists(aside) and not store.exists(folder):
            store.move(aside, folder)
        store.delete(staged)
        raise
    store.delete(aside)
    return found


def read_published(spark: SparkSession, path: str, column: str = "event_date") -> DataFrame:
    """All dates of a table in types that hold them all; columns that a date lacks are null.

    One scan for each distinct set of types; filters on the date prune all of them.
    Dates written without a marker (by ``replace_date``) are one set, merged by their files' footers.
    """
    found = _dates_by_types(spark, path, column)
    if not found:
        raise LookupError(f"no dates under {path}")
    wanted = _union_types(schema for _, schema, _ in found)
    parts = []
    for _, schema, folders in found:
        typed = StructType([*schema.fields]).add(column, "date")
        scan = spark.read.schema(typed).option("basePath", path).parquet(*(f"{path}/{f}" for f in folders))
        has = set(schema.names)
        columns = [(F.col(f"`{n}`") if n in has else F.lit(None)).cast(t).alias(n) for n, t in wanted.items()]
        parts.append(scan.select(*columns, column))
    return reduce(DataFrame.unionByName, parts)


def _dates_by_types(spark: SparkSession, path: str, column: str, but: str = "") -> list[tuple[str, StructType, list[str]]]:
    """Name, column types and folders of each distinct set of types."""
    store = Store(spark, path)
    folders = [f for f in store.names(f"{column}=*") if f != but]
    of = dict(name.split(f"/{_TYPES}-") for name in store.names(f"{column}=*/{_TYPES}-*"))
    sets: dict[str, list[str]] = {}
    for folder in folders:
        sets.setdefault(of.get(folder, ""), []).append(folder)
    found = []
    for name, some in sorted(sets.items()):
        if name:
            text = spark.read.schema("types string").parquet(f"{path}/{_TYPES}/{name}").first()["types"]
            schema = StructType.fromJson(json.loads(text))
        else:
            files = spark.read.option("mergeSchema", True).option("basePath", path)
            merged = files.parquet(*(f"{path}/{f}" for f in some)).schema
            schema = StructType([f for f in merged if f.name != column])
        found.append((name, schema, some))
    return found


def _keep_types(spark: SparkSession, path: str, schema: StructType) -> str:
    """Store column types under a name made from them; equal types are stored once."""
    text = json.dumps(schema.jsonValue(), sort_keys=True)
    name = hashlib.sha1(text.encode()).hexdigest()[:16]
    spark.range(1).select(F.lit(text).alias("types")).coalesce(1).write.mode("ignore").parquet(f"{path}/{_TYPES}/{name}")
    return name


def _union_types(schemas: Iterable[StructType]) -> dict[str, DataType]:
    wanted: dict[str, DataType] = {}
    for schema in schemas:
        for field in schema:
            kind = common_type(wanted.get(field.name, field.dataType), field.dataType)
            if kind is None:
                had = wanted[field.name].simpleString()
                raise TypeError(f"{field.name} is {field.dataType.simpleString()}, other dates have {had}")
            wanted[field.name] = kind
    cases: dict[str, str] = {}
    for name in wanted:
        if cases.setdefault(name.lower(), name) != name:
            raise TypeError(f"columns {cases[name.lower()]} and {name} differ in case only")
    return wanted


def _in_stored_types(df: DataFrame, others: Sequence[StructType], column: str) -> DataFrame:
    own = StructType([f for f in df.schema if f.name != column])
    wanted = _union_types([*others, own])
    return enforce_types(df, {name: wanted[name] for name in own.names})
