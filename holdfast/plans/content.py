"""The titles each user watched most."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.functions.text import bullet_list
from holdfast.operators.checks import resolve_column
from holdfast.operators.filters import for_users, trailing_days
from holdfast.operators.joins import lookup
from holdfast.operators.shows import top_shows, watch_minutes

KEY_NAMES = ["show_id", "showId"]
TITLE_NAMES = ["title", "name", "show_title", "primaryTitle"]


def titles(master: DataFrame) -> DataFrame | None:
    """One title per show id, or None when the table has no usable columns."""
    key, title = resolve_column(master, KEY_NAMES), resolve_column(master, TITLE_NAMES)
    if key is None or title is None:
        return None
    return (
        master.select(F.col(key).alias("show_id"), F.col(title).alias("title"))
        .groupBy("show_id")
        .agg(F.min("title").alias("title"))
    )


def with_titles(shows: DataFrame, master: DataFrame) -> DataFrame:
    """Add the title of each show; the id as text where there is none."""
    known = titles(master)
    fallback = F.col("show_id").cast("string")
    if known is None:
        return shows.withColumn("title", fallback)
    titled = lookup(shows, known, ["show_id"])
    return titled.withColumn("title", F.coalesce("title", fallback))


def content_list(
    events: DataFrame,
    master: DataFrame,
    day: date | str,
    users: DataFrame | None = None,
    k: int = 5,
    days: int = 30,
) -> DataFrame:
    """The ``k`` titles of the last ``days`` dates per user, as a bullet list.

    The user filter comes after the sum per user and show: Spark moves it below
    the sum when the key list is small enough to broadcast, and otherwise joins
    the sums instead of the events.
    """
    watch = watch_minutes(
        trailing_days(events, day, days).select("user_id", "show_id", "session_time")
    )
    if users is not None:
        watch = for_users(watch, users)
    titled = with_titles(top_shows(watch, k), master)
    ranked = F.array_sort(F.collect_list(F.struct("rn", "title")))
    return (
        titled.groupBy("user_id")
        .agg(ranked.alias("ranked"))
        .select("user_id", bullet_list(F.col("ranked.title")).alias("content_list"))
    )
