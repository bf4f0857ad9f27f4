"""The strategy guide, prompt texts and default copy.

These texts are data. They have to be the ones below for prompts and messages to
come out as campaigns expect them, so they are stated in full and in their usual
order. ``<<name>>`` marks the place of a value.
"""

from __future__ import annotations

from textwrap import dedent, indent

# strategy, goal, tones, urgencies, angles, calls to action, phrases to avoid
STRATEGY_GUIDE = [
    (
        "Save",
        "해지 직전/장기 미접속 유저 복귀",
        ["urgent"],
        ["high"],
        [
            "놓치면 아쉬운 독점/화제작 한 편 제안",
            "취향 맞춤 한 편으로 복귀 장벽 낮추기",
            "바로 이어보기/짧게 시작 가능한 추천",
        ],
        ["지금 바로 이어보기", "내 취향으로 추천받기", "오늘의 추천 확인"],
        ["지금 안 하면 손해", "마지막 경고", "무조건 할인", "해지하면 후회"],
    ),
    (
        "Start",
        "가입 초기 정착 실패 복구",
        ["friendly", "helpful"],
        ["medium", "low"],
        [
            "3분만에 취향 설정/추천 시작",
            "짧은 러닝타임 콘텐츠로 진입",
            "사용법/추천 흐름을 간단히 안내",
        ],
        ["3분만에 시작하기", "취향 선택하고 추천받기", "가볍게 한 편 보기"],
        ["왜 안 보세요?", "사용법 모르죠?", "당장 결제하세요"],
    ),
    (
        "Fix",
        "기술적 단절/불규칙 접속 해결",
        ["helpful"],
        ["medium"],
        [
            "끊김 없는 시청 경험/기기 최적화 힌트",
            "최근 보던 작품 이어보기 제안",
            "간단한 해결 팁 + 바로 볼 콘텐츠",
        ],
        ["이어보기로 복귀", "설정 한 번에 해결", "바로 재생하기"],
        ["고객님 문제입니다", "기기 탓", "불편하면 나가세요"],
    ),
    (
        "React",
        "고위험 이용 감소 사용자 재참여",
        ["friendly", "urgent"],
        ["high", "medium"],
        [
            "최근 취향 기반 ‘딱 맞는’ 추천",
            "짧게 시작 가능한 화제작",
            "다시 돌아오게 만드는 한 문장 훅",
        ],
        ["오늘 이거부터", "5분만 보고 결정", "지금 확인하기"],
        ["왜 요즘 안 봐요", "당장 돌아와요"],
    ),
    (
        "Finish",
        "몰입 후 급감 사용자 재개 유도",
        ["urgent", "premium"],
        ["high", "medium"],
        [
            "이어보기/다음 회차로 몰입 재점화",
            "결말/후속 시즌 호기심 자극",
            "비슷한 작품으로 자연스러운 연장",
        ],
        ["바로 이어보기", "다음 회차 확인", "끝까지 몰아보기"],
        ["안 보면 손해", "후회합니다"],
    ),
    (
        "Boost",
        "고활동 유저 위험 증가 방지(충성도 유지)",
        ["premium"],
        ["medium"],
        [
            "VIP 케어/취향 정교화",
            "신작/단독 공개/독점 라인업 강조",
            "고활동 유저용 ‘한 단계 위’ 추천",
        ],
        ["프리미엄 추천 받기", "신작 라인업 보기", "취향 더 정교하게"],
        ["초보자 안내", "사용법 가이드 길게"],
    ),
    (
        "Stay",
        "완만한 감소 추세 유지/회복",
        ["friendly", "calm"],
        ["low", "medium"],
        [
            "부담 없는 추천(짧고 가벼운)",
            "주기적 시청 습관 회복",
            "편안한 톤으로 리마인드",
        ],
        ["가볍게 한 편", "오늘의 추천", "짧게 보기"],
        ["긴급", "마지막 기회"],
    ),
    (
        "Calm",
        "발송 억제(안정 상태)",
        ["calm"],
        ["low"],
        ["(발송하지 않음)"],
        ["(none)"],
        ["불필요한 메시지"],
    ),
]


def _prompt(text: str) -> str:
    """Prompts are sent with every line but the first set in by eight spaces."""
    return indent(dedent(text).strip("\n"), " " * 8).strip()


PLAYBOOK_PROMPT = _prompt(
    """
    당신은 OTT 마케팅 전문가입니다.
    아래 입력을 바탕으로 최종 문구를 쓰기 전 '카피 설계도(Playbook)'를 **JSON만** 출력하세요.

    [입력]
    - strategy_code: <<strategy_code>>
    - probability_band: <<probability_band>>
    - priority_rank: <<priority_rank>>

    [전략 가이드]
    - 목표: <<goal>>
    - 추천 톤 후보: <<tone_candidates>>
    - 긴급도 후보: <<urgency_candidates>>
    - 앵글 예시: <<angles>>
    - CTA 예시: <<cta_candidates>>
    - 금지 표현: <<do_not_say>>

    [규칙]
    1) strategy_code는 절대 변경하지 마세요.
    2) 할인/쿠폰은 반드시 필요한 경우에만 사용하세요. 우선은 콘텐츠/경험 기반 대응을 고려하세요.
    3) 위협/압박/허위 혜택 금지.
    4) 반드시 한국어.
    5) JSON 외 텍스트 출력 금지.

    [출력 JSON 스키마]
    {
    "hook": "10~18자 훅",
    "angle": "한 줄 요약",
    "content_direction": "추천 콘텐츠를 어떤 기준으로 활용할지",
    "cta": "짧은 행동 유도",
    "tone": "urgent|friendly|premium|calm|helpful",
    "urgency_level": "low|medium|high"
    }
    """
)

FINAL_COPY_PROMPT = _prompt(
    """
    당신은 OTT 마케팅 전문가입니다. 아래 Playbook을 반드시 따르세요.

    [고객 상황]
    <<user_situation>>

    [전략 코드]
    <<strategy_code>>

    [금지 표현]
    <<do_not_say>>

    [Playbook(JSON)]
    <<playbook_json>>

    [실시간 추천 콘텐츠]
    <<content_list>>

    [항목 작성 규칙]
    push:
    1) 너무 길지 않게: 푸시 1~2줄(권장 60자 내외), 과장 금지.
    2) 추천 콘텐츠 제목/특징을 최소 1개 이상 자연스럽게 포함.
    3) 출력은 반드시 아래 형식만.
    email:
    1) 너무 길지 않게: 이메일 10~15줄(권장 300자 내외), 과장 금지.
    2) 추천 콘텐츠 리스트에 있는 영화의 제목과 특징을 문구에 자연스럽게 녹이세요.
    3) 반드시 한국어로 작성하세요.
    4) intro: 고객의 최근 시청 기록을 언급하며 흥미를 유발하는 3~4줄의 문구.
    5) rec_list: 추천 콘텐츠에 대해 각각 {"title": "...", "description": "..."}을 포함한 리스트 형식.
    6) description은 각 콘텐츠의 핵심 매력을 1문장으로 요약할 것.
    공통:
    1) 출력은 반드시 아래 형식만.

    [출력 형식]
    반드시 아래 JSON 형식으로만 답변하세요. 다른 텍스트는 포함하지 마세요.
    {
        "push_title": "...",
        "push_body": "...",
        "email_title": "...",
        "email_intro": "...",
        "rec_list": [
            {"title": "...", "description": "..."},
            ...
        ]
    }
    """
)

# Lines of the user situation.
SITUATION_STRATEGY = "<<strategy_code>> 전략 대상 사용자입니다."
SITUATION_BAND = "위험 단계(probability_band): <<probability_band>>"
SITUATION_SEGMENT = "세그먼트: <<segment>>"
SITUATION_LAST_LOGIN = "마지막 접속 이후 경과일: <<days_since_last_login>>일"
SITUATION_WATCH_TIME = (
    "최근 7일 시청시간: <<watch_time_7d_min>>분 / 최근 30일 시청시간: <<watch_time_30d_min>>분"
)

# Keys of a playbook, in order, and the values used when the model gives none.
PLAYBOOK_KEYS = ["hook", "angle", "content_direction", "cta", "tone", "urgency_level"]
FALLBACK_HOOK = "오늘 딱 한 편만!"
FALLBACK_DIRECTION = "최근 취향 기반 추천"
FALLBACK_ANGLE = "맞춤 추천"
FALLBACK_CTA = "지금 확인"
FALLBACK_TONE = "friendly"
FALLBACK_URGENCY = "medium"

# Copy used where the model left a field out.
DEFAULT_TITLE = "오늘의 추천이 도착했어요"
DEFAULT_BODY = "지금 바로 확인해보세요."
DEFAULT_CONTENT_LIST = "- 추천 콘텐츠를 준비 중이에요"
DEFAULT_RANK = 8

# Text put in place of a missing, refused or blank response.
NO_RESPONSE = "DEFAULT_MESSAGE: 응답 생성 실패"
REFUSED = "REFUSAL: "
BLANK_RESPONSE = "DEFAULT_MESSAGE: 추천 콘텐츠를 확인해 보세요!"

# Delivery.
EMAIL_ACTION = "지금 시청하러 가기"
CARD_ACTION = "지금 컨텐츠 보러 가기"
