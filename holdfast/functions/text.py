"""Texts built from columns: lists, the user situation and the prompts."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.functions import wording

GUIDE_SCHEMA = (
    "strategy_code string, goal string, tone_candidates array<string>, "
    "urgency_candidates array<string>, angles array<string>, "
    "cta_candidates array<string>, do_not_say array<string>"
)
GUIDE_LISTS = ["tone_candidates", "urgency_candidates", "angles", "cta_candidates", "do_not_say"]


def fill(template: str, **values: Column) -> Column:
    """Put text columns in place of ``<<name>>``; null when one of them is null."""
    parts = re.split(r"<<(\w+)>>", template)
    pieces = [
        values.get(part, F.col(part)) if i % 2 else F.lit(part) for i, part in enumerate(parts)
    ]
    return F.concat(*pieces)


def bullet_list(titles: Column) -> Column:
    """One ``- title`` line per element."""
    return F.concat_ws("\n", F.transform(titles, lambda title: F.concat(F.lit("- "), title)))


def shown(value: Column) -> Column:
    """The value as text, and ``None`` where there is none, as prompts show it."""
    return F.coalesce(value.cast("string"), F.lit("None"))


def plain_number(value: Column) -> Column:
    """A double as text without an exponent, between 1e-4 and 1e16 as prompts show it."""
    size = F.abs(value)
    exponent = ((size >= 1e7) & (size < 1e16)) | ((size >= 1e-4) & (size < 1e-3))
    digits = F.regexp_replace(value.cast("decimal(38, 16)").cast("string"), r"(\.\d+?)0+$", "$1")
    return F.when(exponent, digits).otherwise(value.cast("string"))


def shown_list(values: Column) -> Column:
    """A list of texts in the bracketed, quoted form prompts show it in."""
    return F.coalesce(
        F.concat(F.lit("['"), F.array_join(values, "', '"), F.lit("']")), F.lit("None")
    )


def strategy_guide(spark: SparkSession) -> DataFrame:
    """The guide as a dimension with one row per strategy."""
    return spark.createDataFrame(wording.STRATEGY_GUIDE, GUIDE_SCHEMA)


def with_guide(targets: DataFrame) -> DataFrame:
    """Add the guide's columns; null for a strategy it does not know.

    The guide has eight rows whatever the data, so it is always broadcast.
    """
    guide = strategy_guide(targets.sparkSession)
    return targets.join(F.broadcast(guide), "strategy_code", "left")


def user_situation() -> Column:
    """What is known about a user, one line each; unknown facts have no line."""
    return F.concat_ws(
        "\n",
        fill(wording.SITUATION_STRATEGY, strategy_code=shown(F.col("strategy_code"))),
        fill(wording.SITUATION_BAND, probability_band=shown(F.col("probability_band"))),
        fill(wording.SITUATION_SEGMENT),
        fill(wording.SITUATION_LAST_LOGIN),
        fill(
            wording.SITUATION_WATCH_TIME,
            **{name: plain_number(F.col(name)) for name in ("watch_time_7d_min", "watch_time_30d_min")},
        ),
    )


def playbook_prompt() -> Column:
    """The prompt for a playbook, from target columns joined with the guide."""
    rank = F.coalesce(F.col("priority_rank"), F.lit(wording.DEFAULT_RANK))
    return fill(
        wording.PLAYBOOK_PROMPT,
        strategy_code=shown(F.col("strategy_code")),
        probability_band=shown(F.col("probability_band")),
        priority_rank=rank.cast("string"),
        goal=shown(F.col("goal")),
        **{name: shown_list(F.col(name)) for name in GUIDE_LISTS},
    )


def final_copy_prompt() -> Column:
    """The prompt for the copy, from the situation, the playbook and the titles."""
    return fill(
        wording.FINAL_COPY_PROMPT,
        user_situation=user_situation(),
        strategy_code=shown(F.col("strategy_code")),
        do_not_say=shown_list(F.col("do_not_say")),
        playbook_json=shown(F.col("playbook_json")),
        content_list=shown(F.col("content_list")),
    )
