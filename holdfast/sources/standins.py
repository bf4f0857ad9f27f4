"""Stand-ins for the pipeline's input tables, derived from the test tables.

The pipeline's own inputs are made elsewhere. Each function here gives a test
table the columns of one of them; FIXTURES.md has the same views as SQL.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from holdfast.functions.scores import probability_band
from holdfast.sources.tables import load

AS_OF = date(2024, 1, 31)
FIRST_SNAPSHOT = date(2024, 1, 8)
LAST_SNAPSHOT = date(2024, 1, 30)
HIGHEST_SCORE = (29 * 3 + 40) / 100  # of ``predictions``: idle on all but the first of 30 days

STRATEGIES = ["Save", "Start", "Fix", "React", "Finish", "Boost", "Stay", "Calm"]

PLAYBOOK_REST = '","angle":"a","content_direction":"c","cta":"go","tone":"calm","urgency_level":"low"}'


@dataclass(frozen=True)
class Inputs:
    """The input tables of one test data directory, all lazy."""

    spark: SparkSession
    directory: str

    def _table(self, name: str) -> DataFrame:
        return load(self.spark, self.directory, name)

    @cached_property
    def watch_events(self) -> DataFrame:
        return (
            self._table("events")
            .filter(F.col("event_type") == "view")
            .select(
                "user_id",
                F.col("ts").cast("date").alias("event_date"),
                F.get_json_object("props", "$.k").cast("bigint").alias("show_id"),
                F.col("value").alias("session_time"),
            )
        )

    @cached_property
    def daily_watch_time(self) -> DataFrame:
        return self.watch_events.groupBy("user_id", "event_date").agg(
            F.round(F.sum("session_time"), 2).alias("watch_min")
        )

    @cached_property
    def all_users(self) -> DataFrame:
        return self._table("events").select("user_id").distinct()

    @cached_property
    def snapshot(self) -> DataFrame:
        segments = self._table("customer").select(
            F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("segment")
        )
        idle = F.col("days_since_last_login")
        level = (
            F.when(idle.isNull() | (idle > 10), "Churned")
            .when(idle > 6, "Dormant")
            .when(idle > 2, "Soft Churn")
            .otherwise("Active")
        )
        return (
            self._behaviour()
            .join(segments, "user_id", "left")
            .select(
                "user_id",
                "event_date",
                "daily_watch_time_min",
                "watch_time_7d_min",
                "watch_time_30d_min",
                "active_days_7",
                "active_days_30",
                "days_since_last_login",
                F.when(F.col("active_days_30") > 0, 1).otherwise(0).alias("is_active"),
                level.alias("churn_risk_level"),
                "segment",
            )
        )

    def _behaviour(self) -> DataFrame:
        """Trailing sums per user and calendar day, over one row per user and day."""
        calendar = F.sequence(F.lit(FIRST_SNAPSHOT), F.lit(LAST_SNAPSHOT))
        grid = self.all_users.select(
            "user_id",
            F.explode(calendar).alias("event_date"),
            F.lit(None).cast("double").alias("watch_min"),
        )
        days = (
            grid.unionByName(self.daily_watch_time)
            .groupBy("user_id", "event_date")
            .agg(F.max("watch_min").alias("watch_min"))
        )
        week, month = _trailing(7), _trailing(30)
        watched = F.col("watch_min").isNotNull()
        last = F.max(F.when(watched, F.col("event_date"))).over(month)
        return days.select(
            "user_id",
            "event_date",
            _minutes(F.col("watch_min")).alias("daily_watch_time_min"),
            _minutes(F.sum("watch_min").over(week)).alias("watch_time_7d_min"),
            _minutes(F.sum("watch_min").over(month)).alias("watch_time_30d_min"),
            F.count("watch_min").over(week).alias("active_days_7"),
            F.count("watch_min").over(month).alias("active_days_30"),
            F.datediff("event_date", last).alias("days_since_last_login"),
        ).filter(F.col("event_date").between(FIRST_SNAPSHOT, LAST_SNAPSHOT))

    @cached_property
    def predictions(self) -> DataFrame:
        idle = F.col("days_since_last_login")
        return self.snapshot.filter(F.col("is_active") == 1).select(
            "user_id",
            "event_date",
            ((idle * 3 + 40).cast("double") / 100).alias("churn_probability"),
        )

    @cached_property
    def campaign_targets(self) -> DataFrame:
        slot = F.col("user_id") % 8
        codes = F.array(*(F.lit(code) for code in STRATEGIES))
        return self.predictions.select(
            "user_id",
            "event_date",
            F.get(codes, slot.cast("int")).alias("strategy_code"),
            (slot + 1).cast("int").alias("priority_rank"),
            F.when((slot == 7) | (F.col("user_id") % 13 == 0), 0).otherwise(1).alias("send_flag"),
            probability_band(F.col("churn_probability")).alias("probability_band"),
        )

    @cached_property
    def content_master(self) -> DataFrame:
        parts = self._table("part").filter(F.col("p_type") != "PROMO")
        return parts.select(F.col("p_partkey").alias("show_id"), F.col("p_name").alias("title"))

    @cached_property
    def posters(self) -> DataFrame:
        name, movie = F.col("p_name"), F.col("p_size") <= 25
        kept = ~name.like("hot %") & ~(name.like("old %") & movie)
        path = F.concat(F.lit("/"), F.col("p_partkey").cast("string"), F.lit(".jpg"))
        return (
            self._table("part")
            .filter(kept)
            .select(
                name.alias("title"),
                F.when(movie, "movie").otherwise("tv").alias("media_type"),
                path.alias("poster_path"),
            )
        )

    @cached_property
    def users(self) -> DataFrame:
        key, nation = F.col("c_custkey"), F.col("c_nationkey")
        plans = F.array(F.lit("basic"), F.lit("standard"), F.lit("premium"))
        return (
            self._table("customer")
            .filter(F.col("c_acctbal") >= 0)
            .select(
                key.alias("user_id"),
                (key % 60 + 18).cast("int").alias("age"),
                F.when(key % 2 == 0, "F").otherwise("M").alias("gender"),
                F.get(plans, nation % 3).alias("plan"),
                F.lit(None).cast("date").alias("churn_date"),
                F.concat(F.lit("user"), key.cast("string"), F.lit("@example.com")).alias("user_email"),
            )
        )

    @cached_property
    def raw_responses(self) -> DataFrame:
        user = F.col("user_id").cast("string")
        good = F.concat(F.lit('{"hook":"h'), user, F.lit(PLAYBOOK_REST))
        return self.all_users.select(
            "user_id",
            F.get(
                F.array(
                    good,
                    F.concat(F.lit("Sure! "), good, F.lit(" Hope it helps")),
                    F.lit("REFUSAL: no"),
                    F.lit('{"hook":" ","angle":"a"}'),
                    F.lit(None).cast("string"),
                    F.lit('{"hook":1' + PLAYBOOK_REST[1:]),
                ),
                (F.col("user_id") % 6).cast("int"),
            ).alias("raw"),
        )


def _trailing(days: int):
    by_day = Window.partitionBy("user_id").orderBy(F.unix_date("event_date"))
    return by_day.rangeBetween(1 - days, 0)


def _minutes(total: Column) -> Column:
    return F.round(F.coalesce(total, F.lit(0.0)), 2)
