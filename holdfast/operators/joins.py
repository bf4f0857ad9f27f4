"""Joins that stay balanced when one key holds a large part of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup(df: DataFrame, unique: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join to ``unique``, which has one row per key."""
    return _spread_join(df, unique, keys, "left")


def matching(df: DataFrame, unique: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key occurs in ``unique``, which has one row per key."""
    return _spread_join(df, unique.select(*keys), keys, "left_semi")


def colocated_lookup(
    df: DataFrame, table: DataFrame, columns: Sequence[str], key: str, per: str | None = None
) -> DataFrame:
    """Left join of two tables stored in equal buckets of ``key``, without a shuffle; adds ``columns``.

    ``per`` is a further key of bounded range (a date or block of days): a user's rows of ``table`` become one map by
    it, so the join needs ``key`` alone, which is what the buckets are dealt by. Of repeated rows of
    ``table`` the least counts; rows of ``df`` are all kept, once each. On tables that are not in buckets the
    result is the same, by way of shuffles. ``columns`` must not be columns of ``df``.
    """
    keys = [key] if per is None else [key, per]
    found = table.dropna(subset=keys).groupBy(*keys).agg(F.min(F.struct(*columns)).alias("_found"))
    if per is not None:
        by_day = F.map_from_entries(F.collect_list(F.struct(per, "_found")))
        found = found.groupBy(key).agg(by_day.alias("_found"))
    joined = df.join(found.hint("merge"), key, "left")
    picked = F.col("_found") if per is None else F.try_element_at("_found", F.col(per))
    return joined.withColumn("_found", picked).select(*df.columns, *(F.col(f"_found.{c}").alias(c) for c in columns))


def _spread_join(df: DataFrame, unique: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join so that a hot key of ``df`` can be split.

    A small ``unique`` is broadcast by Spark, by its measured size. Beyond that
    AQE splits a hot key's partition, but only when both sides of the join are
    fresh shuffles, and a side that was just grouped by the same keys is not. The
    hash of the keys is therefore made part of them: it changes no match, and the
    grouped side, already one row per key, is shuffled once more.
    """
    spread = F.xxhash64(*keys)
    right = unique.withColumn("_spread", spread)
    return df.withColumn("_spread", spread).join(right, [*keys, "_spread"], how).drop("_spread")
