"""Train/test splits that move no rows: a cut key is found, then compared."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.operators.checks import has_two_classes
from holdfast.operators.ordering import row_at


def time_split(
    df: DataFrame,
    share: float = 0.8,
    order: str = "event_date",
    tie: Sequence[str] = ("user_id",),
    out: str = "is_train",
) -> DataFrame:
    """Mark the first ``share`` of the rows, by ``order`` and then ``tie``, as train.

    ``order`` is a date or timestamp. Row counts per day find the day the cut falls
    on; only that day's keys are sorted to find the exact cut. All rows then compare
    with one key, so a day with a large part of the rows costs no more than its own
    keys. Rows equal in every column stay on the same side.
    """
    per_day = df.groupBy(F.to_date(order).alias("day")).count().collect()  # the calendar's length
    left = int(sum(row["count"] for row in per_day) * share)
    for row in sorted((r for r in per_day if r["day"] is not None), key=lambda r: r["day"]):
        if left < row["count"]:
            return df.withColumn(out, _before_cut(df, order, row["day"], tie, left))
        left -= row["count"]
    return df.withColumn(out, F.col(order).isNotNull())


def _before_cut(df: DataFrame, order: str, day: date, tie: Sequence[str], left: int) -> Column:
    cut_day = F.lit(day)
    earlier = F.to_date(order) < cut_day
    if left == 0:
        return F.coalesce(earlier, F.lit(False))
    same = F.to_date(order) == cut_day
    keys = {f"_k{i}": F.col(name) for i, name in enumerate([order, *tie])}
    keys["_row"] = F.xxhash64(*df.columns)
    return F.when(same, _cut_at(df, same, keys, left - 1)).otherwise(
        F.coalesce(earlier, F.lit(False))
    )


def stratified_split(
    df: DataFrame,
    share: float = 0.8,
    label: str = "label",
    key: Sequence[str] = ("user_id", "event_date"),
    seed: int = 42,
    out: str = "is_train",
) -> DataFrame:
    """Mark ``share`` of the rows of each label as train, in a seeded hash order."""
    keys = {"_seeded": F.xxhash64(*key, F.lit(seed)), "_row": F.xxhash64(*df.columns)}
    is_train = F.lit(False)
    for row in df.groupBy(label).count().orderBy(label).collect():  # two labels
        same = F.col(label).eqNullSafe(F.lit(row[label]))
        taken = int(row["count"] * share)
        if taken:
            is_train = F.when(same, _cut_at(df, same, keys, taken - 1)).otherwise(is_train)
    return df.withColumn(out, is_train)


def split_for_training(df: DataFrame, share: float = 0.8, label: str = "label") -> DataFrame:
    """The time split, or the stratified one when train would lack a class."""
    by_time = time_split(df, share)
    if has_two_classes(by_time.filter("is_train"), label):
        return by_time
    return stratified_split(df, share, label)


def _cut_at(df: DataFrame, rows: Column, keys: dict[str, Column], position: int) -> Column:
    """Whether a row of ``rows`` is at or before the one at ``position``."""
    named = [key.alias(name) for name, key in keys.items()]
    narrow = df.filter(rows).select(*named)
    cut = row_at(narrow, list(keys), position)
    bound = [F.lit(cut[f.name]).cast(f.dataType).alias(f.name) for f in narrow.schema]
    return F.struct(*named) <= F.struct(*bound)
