import json

import pytest
from pyspark.sql import functions as F

from holdfast.functions import wording
from holdfast.functions.responses import (
    copy_defaults,
    extract_playbook,
    guard_response,
    parse_copy,
    playbook_fallback,
    playbook_valid,
    strict_json,
    strip,
)
from holdfast.functions.text import with_guide

GOOD = {
    "hook": "오늘 \"한\" 편\n더",
    "angle": "a\\b/c",
    "content_direction": "c\t",
    "cta": "go",
    "tone": "calm",
    "urgency_level": "low",
}
TEXT = json.dumps(GOOD, ensure_ascii=False)
COMPACT = json.dumps(GOOD, separators=(",", ":"))


def column(spark, values, expression):
    df = spark.createDataFrame(list(enumerate(values)), "n int, raw string")
    rows = df.select("n", expression(F.col("raw")).alias("out")).orderBy("n").collect()
    return [row.out for row in rows]


def broken(**changes):
    return json.dumps({**GOOD, **changes})


def test_playbook_is_found_and_rewritten(spark):
    extra = {"z": 1, **GOOD, "more": "x"}
    raws = [
        COMPACT,
        f"Sure:\n```json\n{COMPACT}\n``` bye",
        f"  {TEXT}\n",
        json.dumps(extra),
        f"[{COMPACT}]",
    ]
    expected = [TEXT, TEXT, TEXT, json.dumps(extra, ensure_ascii=False), TEXT]
    assert column(spark, raws, extract_playbook) == expected


def test_playbook_is_refused(spark):
    raws = [
        None,
        "",
        "REFUSAL: no",
        "{}",
        "} {",
        broken(hook=" 　\n"),
        broken(hook=None),
        broken(tone=1),
        broken(tone=["calm"]),
        json.dumps({k: v for k, v in GOOD.items() if k != "cta"}),
        COMPACT + " " + COMPACT,
        COMPACT + ", " + COMPACT,
        COMPACT[:-1],
        COMPACT.replace('"', "'"),
    ]
    assert column(spark, raws, extract_playbook) == [None] * len(raws)


def test_last_of_equal_keys_counts(spark):
    again = COMPACT[:-1] + ',"hook":"again"}'
    assert column(spark, [again], extract_playbook) == [json.dumps({**GOOD, "hook": "again"}, ensure_ascii=False)]
    copy = column(spark, ['{"push_title":"a","push_title":"b"}'], parse_copy)[0]
    assert copy["push_title"] == "b"


def test_odd_list_elements_do_not_hide_good_ones(spark):
    raw = '{"rec_list": [{"title": "x", "description": 5}, "z", null, {"other": 1}, {"title": "y"}]}'
    found = column(spark, [raw], parse_copy)[0]["rec_list"]
    assert [tuple(x) for x in found] == [("x", "5"), ("y", None)]


def test_validity_needs_one_object(spark):
    def valid(raw):
        return playbook_valid(strict_json(raw))

    raws = [COMPACT, COMPACT + " x", "[" + COMPACT + "]", '"text"', "1", None]
    assert column(spark, raws, valid) == [True, False, False, False, False, False]


FULL = {
    "push_title": "p",
    "push_body": "b\nc",
    "email_title": "e",
    "email_intro": "i",
    "rec_list": [{"title": "x", "description": "y"}, {"title": "z"}],
}
NOTHING = dict.fromkeys(FULL)


@pytest.mark.parametrize(
    ("raw", "expected"),
    [
        (json.dumps(FULL), {**FULL, "rec_list": [FULL["rec_list"][0], {"title": "z", "description": None}]}),
        ('```json\n{"push_title": "p"}\n```', {**NOTHING, "push_title": "p"}),
        (' ```{"push_body": ""}```\n', {**NOTHING, "push_body": ""}),
        ("{}", NOTHING),
        ('{"push_title": "p"} thanks', NOTHING),
        ('[{"push_title": "p"}]', NOTHING),
        ('"p"', NOTHING),
        ("not json", NOTHING),
        (None, NOTHING),
    ],
)
def test_copy_is_parsed(spark, raw, expected):
    found = column(spark, [raw], parse_copy)[0]
    assert (found.asDict(recursive=True) if found else NOTHING) == expected


def test_copy_defaults_fill_null_and_empty_only(spark):
    schema = "push_title string, push_body string, email_title string, email_intro string, "
    schema += "rec_list array<struct<title: string, description: string>>"
    rows = [(None, "", " ", "x", None), ("t", "b", "", None, [("a", "b")])]
    out = copy_defaults(spark.createDataFrame(rows, schema)).collect()
    assert tuple(out[0]) == (wording.DEFAULT_TITLE, wording.DEFAULT_BODY, " ", "x", [])
    assert tuple(out[1])[:4] == ("t", "b", wording.DEFAULT_TITLE, wording.DEFAULT_BODY)
    assert tuple(out[1].rec_list[0]) == ("a", "b")


def test_guard(spark):
    rows = [
        (None, "x", None),
        (False, "x", None),
        (True, "x", "no"),
        (True, None, None),
        (True, " \n　", None),
        (True, " text ", ""),
    ]
    df = spark.createDataFrame(rows, "answered boolean, content string, refusal string")
    guarded = guard_response(F.col("answered"), F.col("content"), F.col("refusal"))
    assert [r[0] for r in df.select(guarded).collect()] == [
        wording.NO_RESPONSE,
        wording.NO_RESPONSE,
        "REFUSAL: no",
        wording.BLANK_RESPONSE,
        wording.BLANK_RESPONSE,
        " text ",
    ]


def test_strip_takes_any_white_space(spark):
    assert column(spark, ["　\t a b \n", "\x1c x"], strip) == ["a b", "x"]


def test_fallback_uses_the_guide_or_defaults(spark):
    df = spark.createDataFrame([("Start",), ("Other",)], "strategy_code string")
    found = with_guide(df).select("strategy_code", playbook_fallback().alias("p")).collect()
    plans = {r.strategy_code: json.loads(r.p) for r in found}
    assert list(plans["Start"]) == wording.PLAYBOOK_KEYS
    assert (plans["Start"]["tone"], plans["Start"]["cta"]) == ("friendly", "3분만에 시작하기")
    assert (plans["Other"]["angle"], plans["Other"]["urgency_level"]) == ("맞춤 추천", "medium")
