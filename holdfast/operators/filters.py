"""Date, membership and status filters, and the bounded pick of targets."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.operators.joins import matching
from holdfast.sources.tables import day_literal

def active_on(snapshot: DataFrame, day: date | str) -> DataFrame:
    """Users counted as active on one date."""
    return snapshot.filter((F.col("event_date") == day_literal(day)) & (F.col("is_active") == 1))


def trailing_days(df: DataFrame, day: date | str, days: int = 30) -> DataFrame:
    """The ``days`` dates that end with ``day``, which is one of them."""
    last = day_literal(day)
    return df.filter((F.col("event_date") > F.date_sub(last, days)) & (F.col("event_date") <= last))


def for_users(df: DataFrame, users: DataFrame) -> DataFrame:
    """Rows of the users in ``users``; Spark broadcasts the keys by measured size."""
    return matching(df, users.select("user_id").distinct(), ["user_id"])


def latest_date(df: DataFrame, as_of: date) -> DataFrame:
    """One row: the newest ``event_date`` up to yesterday, or yesterday itself."""
    yesterday = F.date_sub(F.lit(as_of), 1)
    return df.filter(F.col("event_date") <= yesterday).agg(
        F.coalesce(F.max("event_date"), yesterday).alias("event_date")
    )


def pick_date(df: DataFrame, as_of: date | None = None, day: date | str | None = None) -> date:
    """The date a job runs for: ``day`` when given, else :func:`latest_date`."""
    if day:
        return day if isinstance(day, date) else date.fromisoformat(day.strip())
    if as_of is None:
        as_of = df.sparkSession.range(1).select(F.current_date()).first()[0]
    return latest_date(df, as_of).first()["event_date"] or as_of - timedelta(days=1)


def critical_targets(targets: DataFrame, day: date | str, limit: int | None = None) -> DataFrame:
    """Critical users of one date; with ``limit``, only that many, most urgent first.

    The limit is the campaign's size. Spark runs it as a per-partition top-n
    followed by a merge of those n rows.
    """
    critical = targets.filter(
        (F.col("event_date") == day_literal(day))
        & (F.col("probability_band") == "Critical")
        & F.col("user_id").isNotNull()
    )
    if limit is None:
        return critical
    return critical.orderBy("priority_rank", "user_id").limit(limit)


def is_suppressed() -> Column:
    """Whether a target gets no message: send flag off, or the Calm strategy."""
    flagged_off = F.coalesce(F.col("send_flag"), F.lit(1)) == 0
    calm = F.coalesce(F.col("strategy_code") == "Calm", F.lit(False))
    return flagged_off | calm
