"""Who to contact on a date, with what is known about them."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.functions import wording
from holdfast.operators.filters import critical_targets
from holdfast.operators.joins import lookup, matching
from holdfast.plans.content import content_list
from holdfast.session import materialise
from holdfast.sources.tables import day_literal

TARGET_COLUMNS = [
    "event_date",
    "user_id",
    "strategy_code",
    "priority_rank",
    "send_flag",
    "probability_band",
]
FACT_COLUMNS = ["segment", "days_since_last_login", "watch_time_7d_min", "watch_time_30d_min"]


def one_per_target(targets: DataFrame) -> DataFrame:
    """One row per date and user: of repeated targets, the most urgent."""
    rest = [c for c in TARGET_COLUMNS if c not in ("event_date", "user_id")]
    first = F.min(F.struct("priority_rank", *(c for c in rest if c != "priority_rank"))).alias("t")
    found = targets.groupBy("event_date", "user_id").agg(first)
    return found.select("event_date", "user_id", *(F.col(f"t.{c}").alias(c) for c in rest))


def with_facts(targets: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Left join the snapshot facts of the same user and date, one row per target row.

    Repeated snapshot rows are reduced to one, only for the keys that are asked for.
    """
    keys = ["event_date", "user_id"]
    wanted = matching(snapshot.select(*keys, *FACT_COLUMNS), targets.select(*keys).distinct(), keys)
    facts = wanted.groupBy(*keys).agg(F.min(F.struct(*FACT_COLUMNS)).alias("f"))
    facts = facts.select(*keys, *(F.col(f"f.{c}").alias(c) for c in FACT_COLUMNS))
    return lookup(targets.select(*TARGET_COLUMNS), facts, keys).select(*TARGET_COLUMNS, *FACT_COLUMNS)


def campaign_brief(
    targets: DataFrame,
    snapshot: DataFrame,
    events: DataFrame,
    master: DataFrame,
    day: date | str,
    limit: int | None = None,
    k: int = 5,
) -> DataFrame:
    """Critical targets of one date with snapshot facts and their content list.

    ``limit`` is the size of the campaign, for callers that have one. The picked
    targets are used three times, so they are written down once.
    """
    critical = critical_targets(one_per_target(targets.select(*TARGET_COLUMNS)), day, limit)
    picked = materialise(critical.select(*TARGET_COLUMNS))
    facts = snapshot.filter(F.col("event_date") == day_literal(day))
    lists = content_list(events, master, day, picked.select("user_id"), k)
    return (
        with_facts(picked, facts)
        .join(lists, "user_id", "left")
        .select(
            *TARGET_COLUMNS,
            *FACT_COLUMNS,
            F.coalesce("content_list", F.lit(wording.DEFAULT_CONTENT_LIST)).alias("content_list"),
        )
    )
