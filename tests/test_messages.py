import json
from datetime import date, datetime, timezone

import pandas as pd
import pytest

from holdfast.functions import wording
from holdfast.plans.messages import build_messages, with_text

BRIEF = (
    "event_date date, user_id long, strategy_code string, priority_rank int, send_flag int, "
    "probability_band string, segment string, days_since_last_login int, "
    "watch_time_7d_min double, watch_time_30d_min double, content_list string"
)
DAY = date(2024, 1, 30)
RUN = datetime(2024, 1, 31, 6, tzinfo=timezone.utc)


def brief(spark, *targets):
    rows = [(DAY, u, code, 1, flag, "Critical", "s", 6, 1.0, 2.0, "- a") for u, code, flag in targets]
    return spark.createDataFrame(rows, BRIEF)


@pytest.fixture
def calls(tmp_path):
    """A generator that writes down each prompt; executors share the folder."""
    folder = str(tmp_path)

    def make(reply):
        def generate(prompts: pd.Series) -> pd.Series:
            import os
            import uuid

            replies = []
            for prompt in prompts:
                kind = "playbook" if "strategy_code:" in prompt else "copy"
                seen = len([f for f in os.listdir(folder) if f.startswith(kind)])
                open(os.path.join(folder, f"{kind}-{uuid.uuid4().hex}"), "w").close()
                replies.append(reply(kind, seen))
            return pd.Series(replies, index=prompts.index)

        return generate

    def count(kind):
        return len(list(tmp_path.glob(f"{kind}-*")))

    return make, count


PLAYBOOK = json.dumps({key: "x" for key in wording.PLAYBOOK_KEYS})
COPY = json.dumps({"push_title": "T", "rec_list": [{"title": "a", "description": "d"}]})


def test_second_attempt_only_when_needed(spark, calls):
    make, count = calls

    def reply(kind, seen):
        if kind == "copy":
            return COPY
        return "no json" if seen == 0 else PLAYBOOK

    row = build_messages(brief(spark, (1, "Save", 1)), make(reply), RUN, parallelism=1).first()
    assert (count("playbook"), count("copy")) == (2, 1)
    assert row.playbook_json == PLAYBOOK
    assert (row.push_title, row.push_body) == ("T", wording.DEFAULT_BODY)
    assert row.rec_list[0].description == "d"
    assert row.skipped is False


def test_first_answer_is_kept(spark, calls):
    make, count = calls
    generate = make(lambda kind, seen: PLAYBOOK if kind == "playbook" else COPY)
    build_messages(brief(spark, (1, "Save", 1)), generate, RUN, parallelism=1).collect()
    assert (count("playbook"), count("copy")) == (1, 1)


def test_fallback_after_all_attempts(spark, calls):
    make, count = calls
    row = build_messages(brief(spark, (1, "Fix", 1)), make(lambda k, s: "?"), RUN, attempts=3).first()
    assert count("playbook") == 3
    assert json.loads(row.playbook_json)["tone"] == "helpful"
    assert row.email_title == wording.DEFAULT_TITLE and row.rec_list == []


def test_suppressed_targets_are_not_asked(spark, calls):
    make, count = calls
    targets = brief(spark, (1, "Calm", 1), (2, "Save", 0))
    rows = build_messages(targets, make(lambda k, s: COPY), RUN).collect()
    assert (count("playbook"), count("copy")) == (0, 0)
    for row in rows:
        assert row.skipped and row.content_list == "- a"
        assert row.playbook_json is row.push_title is row.email_intro is row.rec_list is None


def test_message_columns_and_types(spark):
    out = build_messages(brief(spark, (1, "Save", 1)), lambda prompts: prompts, RUN)
    types = dict(out.dtypes)
    assert list(types) == [
        "event_date",
        "user_id",
        "strategy_code",
        "priority_rank",
        "probability_band",
        "playbook_json",
        "push_title",
        "push_body",
        "email_title",
        "email_intro",
        "rec_list",
        "content_list",
        "generated_ts",
        "skipped",
    ]
    assert types["rec_list"] == "array<struct<title:string,description:string>>"
    assert types["generated_ts"] == "timestamp" and types["priority_rank"] == "int"
    assert out.selectExpr("unix_seconds(generated_ts)").first()[0] == int(RUN.timestamp())


def test_answers_may_be_a_frame(spark):
    df = spark.createDataFrame([(1, "p1"), (2, None), (3, "p3"), (4, "p4")], "id int, prompt string")

    def generate(prompts):
        return pd.DataFrame(
            {
                "content": [f"re {p}" for p in prompts],
                "refusal": ["no" if p == "p3" else None for p in prompts],
                "answered": [p != "p4" for p in prompts],
            },
            index=prompts.index,
        )

    rows = with_text(df.coalesce(1), "prompt", "out", generate).orderBy("id").collect()
    assert [r.out for r in rows] == ["re p1", None, "REFUSAL: no", wording.NO_RESPONSE]
