"""Churn labels: 1 when a user shows no activity in the days after a snapshot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast.operators.joins import colocated_lookup, lookup


def safe_zone(snapshot: DataFrame, history: DataFrame, horizon: int = 7) -> DataFrame:
    """Snapshots whose whole horizon lies inside the recorded activity.

    The last recorded day is a scalar subquery, so it reaches the scan as a
    filter. Without any activity nothing is left.
    """
    last_day = history.agg(F.max("activity_date")).scalar()
    return snapshot.filter(F.col("event_date") <= F.date_sub(last_day, horizon))


def label_churn(
    snapshot: DataFrame, history: DataFrame, horizon: int = 7, deduplicate: bool = True
) -> DataFrame:
    """Label the safe-zone snapshots, dropping exact duplicates.

    The horizon of a snapshot reaches over the rest of its own block of
    ``horizon`` days and into the next block. So it is enough to know, per user
    and block, the last active day of the block and the first of the following
    one: the range join becomes an equi join on a key with one row per user and
    block, and a snapshot row is never multiplied.

    Where the snapshot is known to hold no duplicates, ``deduplicate=False`` saves
    one of its two shuffles and lets unused columns be pruned from the scan.
    """
    settled = safe_zone(snapshot, history, horizon)
    if deduplicate:
        settled = settled.dropDuplicates()
    reach = _activity_reach(history, horizon)
    return (
        lookup(
            settled.withColumn("_block", _block(F.col("event_date"), horizon)),
            reach,
            ["user_id", "_block"],
        ).select(*snapshot.columns, _label(_within_reach(horizon)))
    )


def label_churn_colocated(snapshot: DataFrame, history: DataFrame, horizon: int = 7) -> DataFrame:
    """The same labels for tables stored in equal buckets of ``user_id``: nothing is shuffled.

    Each user's reach is one map by block, at most two entries for each week of the calendar.
    """
    settled = safe_zone(snapshot, history, horizon).dropDuplicates()
    placed = settled.withColumn("_block", _block(F.col("event_date"), horizon))
    reach = _activity_reach(history, horizon)
    found = colocated_lookup(placed, reach, ["_last_here", "_first_next"], "user_id", per="_block")
    return found.select(*snapshot.columns, _label(_within_reach(horizon)))


def label_churn_window(snapshot: DataFrame, history: DataFrame, horizon: int = 7) -> DataFrame:
    """The same labels from a range frame over each user's days.

    The frame runs over distinct user days only, so a user's group is bounded by
    the calendar however often the user occurs in either input.
    """
    settled = safe_zone(snapshot, history, horizon)
    days = (
        settled.select("user_id", "event_date", F.lit(None).cast("date").alias("_active"))
        .unionByName(
            history.select(
                "user_id",
                F.col("activity_date").alias("event_date"),
                F.col("activity_date").alias("_active"),
            )
        )
        .dropna(subset=["user_id", "event_date"])
        .groupBy("user_id", "event_date")
        .agg(F.max("_active").alias("_active"))
    )
    ahead = Window.partitionBy("user_id").orderBy(F.unix_date("event_date")).rangeBetween(1, horizon)
    latest = days.select("user_id", "event_date", F.max("_active").over(ahead).alias("_latest"))
    return lookup(settled.dropDuplicates(), latest, ["user_id", "event_date"]).select(
        *snapshot.columns, _label(F.col("_latest").isNotNull())
    )


def _activity_reach(history: DataFrame, horizon: int) -> DataFrame:
    day = F.col("activity_date")
    here = F.struct(
        _block(day, horizon).alias("_block"),
        day.alias("_last_here"),
        F.lit(None).cast("date").alias("_first_next"),
    )
    before = F.struct(
        (_block(day, horizon) - 1).alias("_block"),
        F.lit(None).cast("date").alias("_last_here"),
        day.alias("_first_next"),
    )
    return (
        history.select("user_id", "activity_date")
        .dropna()
        .select("user_id", F.inline(F.array(here, before)))
        .groupBy("user_id", "_block")
        .agg(F.max("_last_here").alias("_last_here"), F.min("_first_next").alias("_first_next"))
    )


def _within_reach(horizon: int) -> Column:
    return (F.col("_last_here") > F.col("event_date")) | (
        F.col("_first_next") <= F.date_add("event_date", horizon)
    )


def _block(day: Column, horizon: int) -> Column:
    return F.floor(F.unix_date(day) / horizon)


def _label(active: Column) -> Column:
    return F.when(F.coalesce(active, F.lit(False)), 0).otherwise(1).alias("label")
