"""Campaign messages: ask for a playbook, ask for the copy, make both safe."""

from __future__ import annotations

from datetime import datetime, timezone

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.functions.responses import (
    COPY_FIELDS,
    copy_defaults,
    extract_playbook,
    guard_response,
    let,
    parse_copy,
    playbook_fallback,
)
from holdfast.functions.text import final_copy_prompt, playbook_prompt, with_guide
from holdfast.operators.filters import is_suppressed
from holdfast.plans.generation import AnswerLog, Generate, answers, step_log

RESPONSE_SCHEMA = "answered boolean, content string, refusal string"


def with_text(
    df: DataFrame,
    prompt_col: str,
    out_col: str,
    generate: Generate,
    log: AnswerLog | None = None,
) -> DataFrame:
    """Add one guarded text per prompt; a null prompt is not asked and stays null.

    With a ``log`` prompts are asked at once, one by one, and the answers come from it (see
    :mod:`holdfast.plans.generation`).

    ``generate`` gets a batch of prompts as a series. It returns their texts as a
    series, or a frame with any of the columns ``answered``, ``content`` and
    ``refusal``. Calls run in parallel in as many tasks as ``df`` has partitions.
    """

    prompt = F.col(prompt_col)
    if log:
        asked = answers(df, prompt_col, generate, log)
    else:
        # Asking is costly and may differ between calls, so the optimizer must not
        # evaluate it more than once per row.
        asked = df.withColumn("_response", _asking(generate).asNondeterministic()(prompt))
    guarded = let(
        F.col("_response"), lambda r: guard_response(r["answered"], r["content"], r["refusal"])
    )
    return asked.withColumn(out_col, F.when(prompt.isNotNull(), guarded)).drop("_response")


def _asking(generate: Generate):
    # Local functions travel to the executors by value; a module-level one would
    # need this package installed there.
    @F.pandas_udf(RESPONSE_SCHEMA)
    def ask(prompts: pd.Series) -> pd.DataFrame:
        out = pd.DataFrame(
            {"answered": False, "content": None, "refusal": None}, index=prompts.index
        ).astype({"content": object, "refusal": object})
        wanted = prompts.notna()
        if wanted.any():
            got = generate(prompts[wanted])
            if isinstance(got, pd.Series):
                got = got.to_frame("content")
            out.loc[wanted, "answered"] = True
            for name in got.columns:
                out.loc[wanted, name] = got[name].to_numpy()
        return out

    return ask


def with_playbook(
    targets: DataFrame, generate: Generate, attempts: int = 2, log: AnswerLog | None = None
) -> DataFrame:
    """Add ``playbook_json``: the first valid answer, else the guide's fallback.

    Later attempts only ask for rows that have no valid playbook yet.
    """
    df = with_guide(targets).withColumn("playbook_json", F.lit(None).cast("string"))
    for attempt in range(attempts):
        open_row = ~F.col("skipped") & F.col("playbook_json").isNull()
        df = df.withColumn("_prompt", F.when(open_row, playbook_prompt()))
        df = with_text(df, "_prompt", "_raw", generate, log and step_log(log, f"playbook-{attempt}"))
        df = df.withColumn("playbook_json", F.coalesce("playbook_json", extract_playbook(F.col("_raw"))))
    fallback = F.when(~F.col("skipped"), playbook_fallback())
    return df.withColumn("playbook_json", F.coalesce("playbook_json", fallback)).drop("_prompt", "_raw")


def with_copy(df: DataFrame, generate: Generate, log: AnswerLog | None = None) -> DataFrame:
    """Add the five copy fields; null for suppressed targets."""
    asked = with_text(
        df.withColumn("_prompt", F.when(~F.col("skipped"), final_copy_prompt())),
        "_prompt",
        "_raw",
        generate,
        log and step_log(log, "copy"),
    )
    parsed = asked.withColumn("_copy", parse_copy(F.col("_raw"))).select("*", "_copy.*")
    filled = copy_defaults(parsed)
    return filled.withColumns(
        {name: F.when(~F.col("skipped"), F.col(name)) for name in COPY_FIELDS}
    ).drop("_prompt", "_raw", "_copy")


def build_messages(
    brief: DataFrame,
    generate: Generate,
    run_ts: datetime | None = None,
    attempts: int = 2,
    parallelism: int | None = None,
    log: AnswerLog | None = None,
) -> DataFrame:
    """One message per target of the brief, in the message table's columns.

    ``parallelism`` sets the number of tasks that call the generator at a time; by
    default there are as many as the brief has partitions. Save the result before
    using it more than once: reading it again asks again. With a ``log`` it does not, and a run
    that broke off goes on where it was.
    """
    if parallelism:
        brief = brief.repartition(parallelism, "user_id")
    marked = brief.withColumn("skipped", is_suppressed())
    stamp = F.lit(run_ts or datetime.now(timezone.utc))
    return to_messages_schema(with_copy(with_playbook(marked, generate, attempts, log), generate, log), stamp)


def to_messages_schema(df: DataFrame, generated_ts: Column) -> DataFrame:
    """Columns, order and types of the message table."""
    return df.select(
        F.col("event_date").cast("date").alias("event_date"),
        F.col("user_id").cast("bigint").alias("user_id"),
        "strategy_code",
        F.col("priority_rank").cast("int").alias("priority_rank"),
        "probability_band",
        "playbook_json",
        "push_title",
        "push_body",
        "email_title",
        "email_intro",
        "rec_list",
        "content_list",
        generated_ts.cast("timestamp").alias("generated_ts"),
        "skipped",
    )
