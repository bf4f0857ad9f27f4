from pyspark.sql import functions as F

from holdfast.functions import text, wording

FACTS = (
    "strategy_code string, probability_band string, segment string, days_since_last_login int, "
    "watch_time_7d_min double, watch_time_30d_min double"
)


def test_guide_has_eight_strategies_in_order(spark):
    codes = [r.strategy_code for r in text.strategy_guide(spark).collect()]
    assert codes == ["Save", "Start", "Fix", "React", "Finish", "Boost", "Stay", "Calm"]


def test_situation_leaves_unknown_lines_out(spark):
    rows = [
        ("Save", "Critical", "VIP", 5, 12.5, 100.0),
        ("Fix", None, None, None, 12.5, None),
    ]
    df = spark.createDataFrame(rows, FACTS)
    full, bare = [r[0].split("\n") for r in df.select(text.user_situation()).collect()]
    assert full == [
        "Save 전략 대상 사용자입니다.",
        "위험 단계(probability_band): Critical",
        "세그먼트: VIP",
        "마지막 접속 이후 경과일: 5일",
        "최근 7일 시청시간: 12.5분 / 최근 30일 시청시간: 100.0분",
    ]
    assert bare == ["Fix 전략 대상 사용자입니다.", "위험 단계(probability_band): None"]


def test_playbook_prompt(spark):
    rows = [("Fix", "High", 3), ("Odd", None, None)]
    df = spark.createDataFrame(rows, "strategy_code string, probability_band string, priority_rank int")
    known, unknown = [
        r[0] for r in text.with_guide(df).orderBy("strategy_code").select(text.playbook_prompt()).collect()
    ]
    assert "        - strategy_code: Fix\n        - probability_band: High\n" in known
    assert "- 금지 표현: ['고객님 문제입니다', '기기 탓', '불편하면 나가세요']" in known
    assert "- priority_rank: 8\n" in unknown
    assert "- 목표: None\n        - 추천 톤 후보: None\n" in unknown
    assert not any("<<" in prompt for prompt in (known, unknown))
    assert known == known.strip()


def test_final_prompt_holds_every_part(spark):
    df = spark.createDataFrame(
        [("Stay", "Mid", None, 4, None, None, 1, "{}", "- a\n- b")],
        FACTS + ", priority_rank int, playbook_json string, content_list string",
    )
    prompt = text.with_guide(df).select(text.final_copy_prompt()).first()[0]
    assert "[전략 코드]\n        Stay\n" in prompt
    assert "['긴급', '마지막 기회']" in prompt
    assert "        - a\n- b\n" in prompt
    assert prompt.count("{") == wording.FINAL_COPY_PROMPT.count("{") + 1


def test_bullet_list(spark):
    df = spark.createDataFrame([(["x", "y"],), ([],)], "titles array<string>")
    assert [r[0] for r in df.select(text.bullet_list(F.col("titles"))).collect()] == ["- x\n- y", ""]
