import os
import time
from pathlib import Path

import pandas as pd
import pytest
from pyspark.sql import functions as F

from holdfast.plans.generation import AnswerLog, answers, read_log, step_log
from holdfast.plans.messages import with_text


def counting(folder, act=lambda prompt: prompt.upper()):
    """A generator that leaves a file for every call."""

    def generate(prompts):
        (prompt,) = prompts
        Path(folder, f"{prompt}-{time.monotonic_ns()}").touch()
        return pd.Series([act(prompt)])

    return generate


def calls(folder):
    return sorted(name.rsplit("-", 1)[0] for name in os.listdir(folder))


@pytest.fixture
def place(tmp_path):
    (tmp_path / "calls").mkdir()
    return tmp_path


def table(spark, *prompts):
    return spark.createDataFrame([*enumerate(prompts)], "id int, prompt string")


def test_equal_prompts_are_asked_once_and_null_never(spark, place):
    log = AnswerLog(f"{place}/log", per_task=2)
    rows = table(spark, "a", "b", "a", None, "c")
    got = answers(rows, "prompt", counting(place / "calls"), log).orderBy("id").collect()
    assert [r["_response"]["content"] for r in got] == ["A", "B", "A", None, "C"]
    assert calls(place / "calls") == ["a", "b", "c"]
    answers(table(spark, "c", "d"), "prompt", counting(place / "calls"), log)
    assert calls(place / "calls") == ["a", "b", "c", "d"]


def test_a_killed_run_goes_on(spark, place):
    log = AnswerLog(f"{place}/log", per_task=1)
    prompts = [f"p{i}" for i in range(30)]

    def dying(prompt):
        if prompt == "p7":
            time.sleep(2)
            os._exit(1)
        return prompt

    with pytest.raises(Exception, match="crashed|Job aborted|exited"):
        answers(table(spark, *prompts), "prompt", counting(place / "calls", dying), log)
    logged = {r["content"] for r in read_log(spark, log.path).collect()}
    assert logged and "p7" not in logged
    before = calls(place / "calls")
    got = answers(table(spark, *prompts), "prompt", counting(place / "calls"), log)
    again = calls(place / "calls")
    assert got.filter(F.col("_response.content").isNull()).count() == 0
    assert not [p for p in logged if again.count(p) > before.count(p)]


def test_one_bad_prompt_fails_alone_and_is_given_up(spark, place):
    log = AnswerLog(f"{place}/log", tries=2)

    def failing(prompt):
        if prompt == "bad":
            raise ConnectionError("gone")
        return prompt

    rows = table(spark, "good", "bad")
    for _ in range(4):
        got = answers(rows, "prompt", counting(place / "calls", failing), log).orderBy("id").collect()
    assert [r["_response"]["content"] for r in got] == ["good", None] and not got[1]["_response"]["answered"]
    assert calls(place / "calls") == ["bad", "bad", "good"]
    assert read_log(spark, log.path).filter("error = 'ConnectionError: gone'").count() == 2


def test_slow_calls_are_left(spark, place):
    log = AnswerLog(f"{place}/log", seconds=0.5, tries=1)
    slow = counting(place / "calls", lambda p: time.sleep(3) if p == "slow" else p)
    got = answers(table(spark, "slow", "fast"), "prompt", slow, log).orderBy("id").collect()
    assert [r["_response"]["content"] for r in got] == [None, "fast"]


def test_steps_have_answers_of_their_own(spark, place):
    log = AnswerLog(f"{place}/log")
    rows = table(spark, "a", None)
    for step in ("one", "two", "one"):
        out = with_text(rows, "prompt", "text", counting(place / "calls"), step_log(log, step)).orderBy("id").collect()
        assert [r["text"] for r in out] == ["A", None]
    assert calls(place / "calls") == ["a", "a"]
