"""Watch time per user and show, and the shows a user watched most."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def watch_minutes(events: DataFrame) -> DataFrame:
    """Minutes per user and show.

    Summed on the map side first, so a user or a show with most of the events
    sends one row per task. The rounding makes equal totals compare as equal
    whatever order the parts were added in.
    """
    return events.groupBy("user_id", "show_id").agg(
        F.round(F.sum("session_time"), 6).alias("watch_min")
    )


def top_shows(watch: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` most watched shows per user, numbered from 1; ties go by show id.

    Spark applies the rank limit before the shuffle too, so no task sends more
    than ``k`` rows per user.
    """
    ranking = Window.partitionBy("user_id").orderBy(F.desc("watch_min"), "show_id")
    return watch.withColumn("rn", F.row_number().over(ranking)).filter(F.col("rn") <= k)


def activity_days(history: DataFrame) -> DataFrame:
    """Distinct days on which a user was active."""
    return history.select("user_id", "activity_date").distinct()
