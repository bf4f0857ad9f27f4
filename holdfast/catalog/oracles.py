"""DuckDB SQL that gives the result of each registered query.

The input views come first as common table expressions; FIXTURES.md explains them.
"""

from __future__ import annotations

from holdfast.functions import wording
from holdfast.functions.payloads import POSTER_BASE, POSTER_PLACEHOLDER
from holdfast.sources.standins import PLAYBOOK_REST

VIEWS = {
    "watch_events": """
        select user_id, cast(ts as date) as event_date,
          cast(json_extract_string(props, '$.k') as bigint) as show_id, value as session_time
        from events where event_type = 'view'""",
    "daily_watch_time": """
        select user_id, event_date, round(sum(session_time), 2) as watch_min
        from watch_events group by user_id, event_date""",
    "all_users": "select distinct user_id from events",
    "cal": """
        select cast(unnest(generate_series(date '2024-01-08', date '2024-01-30', interval 1 day)) as date)
          as event_date""",
    "base": """
        select u.user_id, c.event_date,
          round(coalesce(sum(case when d.event_date = c.event_date then d.watch_min end), 0), 2)
            as daily_watch_time_min,
          round(coalesce(sum(case when d.event_date > c.event_date - 7 then d.watch_min end), 0), 2)
            as watch_time_7d_min,
          round(coalesce(sum(d.watch_min), 0), 2) as watch_time_30d_min,
          count(case when d.event_date > c.event_date - 7 then 1 end) as active_days_7,
          count(d.event_date) as active_days_30,
          cast(date_diff('day', max(d.event_date), c.event_date) as int) as days_since_last_login
        from all_users u cross join cal c
        left join daily_watch_time d on d.user_id = u.user_id
          and d.event_date <= c.event_date and d.event_date > c.event_date - 30
        group by u.user_id, c.event_date""",
    "snapshot": """
        select b.*, case when active_days_30 > 0 then 1 else 0 end as is_active,
          case when days_since_last_login is null or days_since_last_login > 10 then 'Churned'
               when days_since_last_login > 6 then 'Dormant'
               when days_since_last_login > 2 then 'Soft Churn' else 'Active' end as churn_risk_level,
          cu.c_mktsegment as segment
        from base b left join customer cu on cu.c_custkey = b.user_id""",
    "predictions": """
        select user_id, event_date, cast(40 + 3 * days_since_last_login as double) / 100
          as churn_probability
        from snapshot where is_active = 1""",
    "campaign_targets": """
        select user_id, event_date,
          case user_id % 8 when 0 then 'Save' when 1 then 'Start' when 2 then 'Fix' when 3 then 'React'
            when 4 then 'Finish' when 5 then 'Boost' when 6 then 'Stay' else 'Calm' end as strategy_code,
          cast(user_id % 8 + 1 as int) as priority_rank,
          case when user_id % 8 = 7 or user_id % 13 = 0 then 0 else 1 end as send_flag,
          case when churn_probability < 0.44 then 'Low' when churn_probability < 0.51 then 'Mid'
            when churn_probability < 0.55 then 'High' else 'Critical' end as probability_band
        from predictions""",
    "content_master": """
        select p_partkey as show_id, p_name as title from part where p_type <> 'PROMO'""",
    "posters": """
        select p_name as title, case when p_size <= 25 then 'movie' else 'tv' end as media_type,
          '/' || cast(p_partkey as varchar) || '.jpg' as poster_path
        from part
        where p_name not like 'hot %' and not (p_name like 'old %' and p_size <= 25)""",
    "users": """
        select c_custkey as user_id, cast(18 + c_custkey % 60 as int) as age,
          case when c_custkey % 2 = 0 then 'F' else 'M' end as gender,
          case c_nationkey % 3 when 0 then 'basic' when 1 then 'standard' else 'premium' end as plan,
          cast(null as date) as churn_date,
          'user' || cast(c_custkey as varchar) || '@example.com' as user_email
        from customer where c_acctbal >= 0""",
    "raw_responses": f"""
        select user_id, case user_id % 6
          when 0 then good when 1 then 'Sure! ' || good || ' Hope it helps'
          when 2 then 'REFUSAL: no' when 3 then '{{"hook":" ","angle":"a"}}'
          when 4 then cast(null as varchar)
          else '{{"hook":1{PLAYBOOK_REST[1:]}' end as raw
        from (select user_id, '{{"hook":"h' || cast(user_id as varchar) || '{PLAYBOOK_REST}' as good
              from all_users)""",
    "churn_labels": """
        select s.user_id, s.event_date, s.segment,
          case when max(h.event_date) is null then 1 else 0 end as label
        from (select distinct * from snapshot) s
        left join (select distinct user_id, event_date from daily_watch_time) h
          on s.user_id = h.user_id and h.event_date > s.event_date and h.event_date <= s.event_date + 7
        where s.event_date <= (select max(event_date) from daily_watch_time) - 7
        group by s.user_id, s.event_date, s.segment""",
    "scored_labels": """
        select p.user_id, p.event_date, p.churn_probability, l.label
        from predictions p join churn_labels l using (user_id, event_date)""",
    "ranked_shows": """
        select *, cast(row_number() over (partition by user_id order by watch_min desc, show_id) as int) as rn
        from (select user_id, show_id, round(sum(session_time), 6) as watch_min
              from watch_events group by user_id, show_id)""",
    "titled_shows": """
        select r.user_id, r.rn, coalesce(m.title, cast(r.show_id as varchar)) as title
        from ranked_shows r left join content_master m using (show_id) where r.rn <= 5""",
    "content_lists": """
        select user_id, string_agg('- ' || title, chr(10) order by rn) as content_list
        from titled_shows group by user_id""",
    "critical": """
        select * from campaign_targets
        where event_date = date '2024-01-30' and probability_band = 'Critical'""",
    "facts": """
        select t.event_date, t.user_id, t.strategy_code, t.priority_rank, t.send_flag, t.probability_band,
          s.segment, s.days_since_last_login, s.watch_time_7d_min, s.watch_time_30d_min
        from campaign_targets t left join snapshot s using (event_date, user_id)""",
    "briefs": f"""
        select f.*, coalesce(c.content_list, '{wording.DEFAULT_CONTENT_LIST}') as content_list
        from facts f left join content_lists c using (user_id)
        where event_date = date '2024-01-30' and probability_band = 'Critical'""",
    "situations": """
        select user_id, event_date, concat_ws(chr(10),
          strategy_code || ' 전략 대상 사용자입니다.',
          '위험 단계(probability_band): ' || probability_band,
          '세그먼트: ' || segment,
          '마지막 접속 이후 경과일: ' || cast(days_since_last_login as varchar) || '일',
          '최근 7일 시청시간: ' || cast(watch_time_7d_min as varchar) || '분 / 최근 30일 시청시간: '
            || cast(watch_time_30d_min as varchar) || '분') as user_situation
        from facts""",
    "poster_paths": """
        select title, coalesce(min(case when media_type = 'movie' then poster_path end),
          min(case when media_type = 'tv' then poster_path end)) as poster_path
        from posters group by title""",
    "skips": """
        select user_id, event_date, strategy_code, send_flag,
          (send_flag = 0 or strategy_code = 'Calm') as skipped
        from campaign_targets""",
}


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _listed(values: list[str]) -> str:
    return _text("['" + "', '".join(values) + "']")


def _guide() -> str:
    rows = []
    for code, goal, tones, urgencies, angles, actions, avoid in wording.STRATEGY_GUIDE:
        lists = [_listed(values) for values in (tones, urgencies, angles, actions, avoid)]
        firsts = [_text(values[0]) for values in (tones, urgencies, angles, actions)]
        rows.append("(" + ", ".join([_text(code), _text(goal), *lists, *firsts]) + ")")
    return f"""
        select * from (values {", ".join(rows)}) t(strategy_code, goal, tone_candidates,
          urgency_candidates, angles, cta_candidates, do_not_say, tone, urgency, angle, cta)"""


def _filled(template: str, **values: str) -> str:
    sql = _text(template)
    for name, value in values.items():
        sql = f"replace({sql}, '<<{name}>>', {value})"
    return sql


_GUIDED = [
    "goal",
    "tone_candidates",
    "urgency_candidates",
    "angles",
    "cta_candidates",
    "do_not_say",
]

VIEWS["guide"] = _guide()
VIEWS["guided"] = "select t.*, g.* exclude (strategy_code) from campaign_targets t left join guide g using (strategy_code)"
VIEWS["fallbacks"] = f"""
    select user_id, event_date, '{{"hook": "{wording.FALLBACK_HOOK}", "angle": "' || angle
      || '", "content_direction": "{wording.FALLBACK_DIRECTION}", "cta": "' || cta
      || '", "tone": "' || tone || '", "urgency_level": "' || urgency || '"}}' as playbook_json
    from guided"""
VIEWS["copies"] = """
    select user_id, user_id % 6 as kind, 't' || cast(user_id as varchar) as title from all_users"""
VIEWS["messages"] = f"""
    select b.event_date, b.user_id, b.strategy_code, b.priority_rank, b.probability_band,
      case when skipped then null when b.strategy_code = 'Fix' then f.playbook_json
        else '{{"hook": "' || b.strategy_code || ' hook", "angle": "a", "content_direction": "c", '
          || '"cta": "go", "tone": "calm", "urgency_level": "low"}}' end as playbook_json,
      case when not skipped then 'Tonight: ' || substr(lines[1], 3) end as push_title,
      case when not skipped then 'Pick one.' || chr(10) || 'Press play.' end as push_body,
      case when not skipped then '{wording.DEFAULT_TITLE}' end as email_title,
      case when not skipped then 'You **watched** these.' end as email_intro,
      case when not skipped then array_to_string(list_transform(lines,
        lambda x: substr(x, 3) || '|About ' || substr(x, 3)), ';') end as recommendations,
      b.content_list, skipped
    from (select *, string_split(content_list, chr(10)) as lines,
            (send_flag = 0 or strategy_code = 'Calm') as skipped from briefs) b
    left join fallbacks f on f.user_id = b.user_id and f.event_date = b.event_date"""
VIEWS["delivery"] = """
    select m.*, u.age, u.gender, u.plan, u.churn_date, u.user_email
    from messages m left join users u using (user_id) where not m.skipped"""
VIEWS["sent"] = """
    select event_date, user_id, 'card' as channel, push_title as subject, cast(null as varchar) as recipient
    from delivery
    union all
    select event_date, user_id, 'email', email_title, user_email from delivery
    where user_email is not null"""

_POSTER = f"""coalesce('{POSTER_BASE}' || p.poster_path,
    '{POSTER_PLACEHOLDER}' || replace(x.title, ' ', '+'))"""

_COPY = {
    "push_title": "case when kind in (0, 1, 2) then title when kind = 3 then '' end",
    "push_body": "case when kind in (0, 1) then 'b' when kind = 2 then ' ' end",
    "email_title": "case when kind in (0, 1) then 'e' end",
    "email_intro": "case when kind in (0, 1) then 'i' end",
    "recommendations": "case when kind in (0, 1) then 'x|y' when kind = 3 then '' end",
}
_COPY_DEFAULT = {
    "push_title": wording.DEFAULT_TITLE,
    "push_body": wording.DEFAULT_BODY,
    "email_title": wording.DEFAULT_TITLE,
    "email_intro": wording.DEFAULT_BODY,
    "recommendations": "",
}

_RATIOS = """
    round(watch_time_7d_min / (watch_time_30d_min / 4 + 1), 6) as watch_time_ratio,
    round(active_days_7 / (active_days_30 / 4 + 1), 6) as active_days_ratio"""
_RISK = """case churn_risk_level when 'Active' then 0 when 'Soft Churn' then 1 when 'Dormant' then 2
    when 'Churned' then 3 end"""

BODIES = {
    # Scans and filters
    "watch_events": "select * from watch_events",
    "history_scan": "select user_id, event_date as activity_date from daily_watch_time",
    "trailing_events": """select * from watch_events
        where event_date > date '2024-01-30' - 14 and event_date <= date '2024-01-30'""",
    "semi_join_users": """select * from watch_events
        where user_id in (select user_id from critical)""",
    "active_users": """select user_id, event_date, churn_risk_level from snapshot
        where event_date = date '2024-01-30' and is_active = 1""",
    "stored_model_scores": f"""select user_id, event_date, round(p, 6) as churn_probability, case when p < 0.44 then 'Low'
        when p < 0.51 then 'Mid' when p < 0.55 then 'High' else 'Critical' end as probability_band
        from (select user_id, event_date, 1 / (1 + exp(-(
            case when coalesce(days_since_last_login, 0) <= 6.5 then -0.3
              when active_days_7 / (active_days_30 / 4 + 1) <= 0.5 then 0.4 else 0.1 end
            + case when {_RISK} <= 1 then -0.2 else 0.25 end))) as p
          from snapshot where event_date = date '2024-01-30' and is_active = 1)""",
    "audited_publish": """select user_id, event_date, churn_probability,
          case when churn_probability < 0.44 then 'Low' when churn_probability < 0.51 then 'Mid'
            when churn_probability < 0.55 then 'High' else 'Critical' end as probability_band,
          cast(count(*) over () as int) as published_rows,
          cast(count(*) filter (where churn_probability + 0.55 > 1) over () as int) as refused_rows
        from predictions where event_date = date '2024-01-30'""",
    "changing_columns": """select user_id, event_date,
          case when event_date = date '2024-01-30' then active_days_7 / 2.0 else active_days_7 end as days,
          case when event_date <> date '2024-01-29' then segment end as segment,
          case when event_date > date '2024-01-28' then cast(is_active as bigint) end as is_active
        from snapshot where event_date between date '2024-01-28' and date '2024-01-30'""",
    "model_versions": """select v.version, (select cast(count(*) as double) from snapshot
            where event_date = date '2024-01-30' and is_active = 1) as active_users, v.version = 2 as latest
        from (values (1), (2), (3)) as v(version)""",
    "active_count": """select event_date, count(*) as n from snapshot where is_active = 1
        group by event_date""",
    "latest_date": """select coalesce(max(event_date), date '2024-01-30') as event_date from snapshot
        where event_date <= date '2024-01-31' - 1""",
    "stored_scores": "select * from predictions where event_date = date '2024-01-30'",
    # Content
    "activity_days": "select distinct user_id, event_date as activity_date from watch_events",
    "watch_minutes": "select user_id, show_id, watch_min from ranked_shows",
    "top_shows": "select * from ranked_shows where rn <= 5",
    "show_titles": """select w.show_id, coalesce(m.title, cast(w.show_id as varchar)) as title
        from (select distinct show_id from watch_events) w left join content_master m using (show_id)""",
    "content_list": "select * from content_lists",
    # Labels and features
    "safe_zone": """select user_id, event_date from snapshot
        where event_date <= (select max(event_date) from daily_watch_time) - 7""",
    "churn_labels": "select * from churn_labels",
    "churn_labels_window": "select * from churn_labels",
    "churn_labels_colocated": "select * from churn_labels",
    "label_counts": "select label, count(*) as n from churn_labels group by label",
    "risk_encoding": f"""select user_id, event_date, churn_risk_level, {_RISK} as risk_level_encoded
        from snapshot""",
    "segment_onehot": """select user_id, event_date, 'seg_' || v.segment as flag,
        cast(coalesce(s.segment = v.segment, false) as int) as is_set
        from snapshot s, (select unnest(['AUTOMOBILE', 'BUILDING',
        'FURNITURE', 'HOUSEHOLD', 'MACHINERY']) as segment) v""",
    "feature_ratios": f"select user_id, event_date, {_RATIOS} from snapshot",
    "clean_features": """select user_id, event_date, coalesce(days_since_last_login, 0)
        as days_since_last_login, watch_time_7d_min, watch_time_30d_min from snapshot""",
    "align_features": """select user_id, event_date, active_days_30, cast(0 as double) as support_calls,
        active_days_7 from snapshot""",
    "features": f"""select user_id, event_date, daily_watch_time_min, watch_time_7d_min, watch_time_30d_min,
        cast(active_days_7 as double) as active_days_7, cast(active_days_30 as double) as active_days_30,
        cast(coalesce(days_since_last_login, 0) as double) as days_since_last_login, {_RATIOS},
        cast({_RISK} as double) as risk_level_encoded from snapshot""",
    # Scores, splits, metrics
    "probability_band": """select p.*, t.probability_band from predictions p
        join campaign_targets t using (user_id, event_date)""",
    "band_counts": """select probability_band, count(*) as n from campaign_targets
        group by probability_band""",
    "score_describe": """select count(churn_probability) as count,
        round(avg(churn_probability), 6) as mean, round(stddev_samp(churn_probability), 6) as std,
        round(min(churn_probability), 6) as min,
        round(quantile_cont(churn_probability, 0.25), 6) as p25,
        round(quantile_cont(churn_probability, 0.5), 6) as p50,
        round(quantile_cont(churn_probability, 0.75), 6) as p75,
        round(quantile_cont(churn_probability, 0.9), 6) as p90,
        round(max(churn_probability), 6) as max from predictions""",
    "row_index": """select user_id, event_date,
        row_number() over (order by event_date, user_id) - 1 as row_index from predictions""",
    "time_split": """select user_id, event_date,
        row_number() over (order by event_date, user_id) <= floor(0.8 * count(*) over ()) as is_train
        from churn_labels""",
    "stratified_counts": """select label, is_train, n from (
          select label, true as is_train, cast(floor(0.8 * count(*)) as bigint) as n
          from churn_labels group by label
          union all
          select label, false, count(*) - cast(floor(0.8 * count(*)) as bigint)
          from churn_labels group by label) where n > 0""",
    "class_weight": """select count(*) filter (label = 0) as negatives,
        count(*) filter (label = 1) as positives,
        round(count(*) filter (label = 0) / nullif(count(*) filter (label = 1), 0), 6) as pos_weight
        from churn_labels""",
    "threshold_metrics": """select
        round(coalesce(count(*) filter (churn_probability > 0.5 and label = 1)
          / nullif(count(*) filter (label = 1), 0), 0), 6) as recall,
        round(coalesce(count(*) filter (churn_probability > 0.5 and label = 1)
          / nullif(count(*) filter (churn_probability > 0.5), 0), 0), 6) as precision
        from scored_labels""",
    "auc_roc": """select round((sum(mid) filter (label = 1) - p * (p + 1) / 2) / (p * n), 6) as auc_roc
        from (select label, rank() over (order by churn_probability)
                + (count(*) over (partition by churn_probability) - 1) / 2 as mid,
                count(*) filter (label = 1) over () as p, count(*) filter (label = 0) over () as n
              from scored_labels)
        group by p, n""",
    # Campaign
    "critical_targets": "select * from critical order by priority_rank, user_id limit 5",
    "target_facts": "select * from facts",
    "target_facts_colocated": "select * from facts",
    "campaign_brief": "select * from briefs",
    "suppressed_targets": "select * from skips",
    "guided_targets": f"select user_id, event_date, strategy_code, {', '.join(_GUIDED)} from guided",
    "user_situation": "select * from situations",
    "playbook_prompt": "select user_id, event_date, "
    + _filled(
        wording.PLAYBOOK_PROMPT,
        strategy_code="strategy_code",
        probability_band="probability_band",
        priority_rank="cast(priority_rank as varchar)",
        **{name: name for name in _GUIDED},
    )
    + " as prompt from guided",
    "final_copy_prompt": "select g.user_id, g.event_date, "
    + _filled(
        wording.FINAL_COPY_PROMPT,
        user_situation="user_situation",
        strategy_code="strategy_code",
        do_not_say="do_not_say",
        playbook_json="playbook_json",
        content_list="coalesce(content_list, 'None')",
    )
    + """ as prompt from guided g join situations using (user_id, event_date)
        join fallbacks using (user_id, event_date) left join content_lists using (user_id)""",
    # Responses
    "response_guard": f"""select user_id, case when user_id % 4 = 0 then '{wording.NO_RESPONSE}'
        when user_id % 4 = 1 then 'REFUSAL: not allowed'
        when raw is null then '{wording.BLANK_RESPONSE}' else raw end as response from raw_responses""",
    "playbook_valid": "select user_id, user_id % 6 in (0, 1) as valid from raw_responses",
    "playbook_extract": """select user_id, case when user_id % 6 in (0, 1) then
        '{"hook": "h' || cast(user_id as varchar) || '", "angle": "a", "content_direction": "c", '
        || '"cta": "go", "tone": "calm", "urgency_level": "low"}' end as playbook_json
        from raw_responses""",
    "playbook_fallback": "select * from fallbacks",
    "copy_parse": "select user_id, "
    + ", ".join(f"{sql} as {name}" for name, sql in _COPY.items())
    + " from copies",
    "copy_defaults": "select user_id, "
    + ", ".join(
        f"coalesce(nullif({sql}, ''), '{_COPY_DEFAULT[name]}') as {name}" for name, sql in _COPY.items()
    )
    + " from copies",
    # Messages and outbox
    "messages": "select * from messages",
    "delivery_list": """select event_date, user_id, strategy_code, age, gender, plan, churn_date, user_email
        from delivery""",
    "poster_lookup": f"""select x.show_id, x.title, {_POSTER} as poster from (
          select w.show_id, coalesce(m.title, cast(w.show_id as varchar)) as title
          from (select distinct show_id from watch_events) w left join content_master m using (show_id)) x
        left join poster_paths p on p.title = x.title""",
    "misspelt_posters": """select w.title, poster_path, cast(edits as int) as edits
        from (select distinct substr(p_name, 1, p_partkey % length(p_name))
            || substr(p_name, p_partkey % length(p_name) + 2) as title from part) w
        left join (
          select w.title, p.poster_path, levenshtein(w.title, p.title) as edits,
            row_number() over (partition by w.title order by levenshtein(w.title, p.title), p.media_type, p.title,
              p.poster_path) as n
          from (select distinct substr(p_name, 1, p_partkey % length(p_name))
              || substr(p_name, p_partkey % length(p_name) + 2) as title from part) w
          join (select distinct * from posters) p on levenshtein(w.title, p.title)
            <= case when length(w.title) < 5 then 0 when length(w.title) < 10 then 1 else 2 end) near
        on near.title = w.title and n = 1""",
    "resumed_messages": """select event_date, user_id, playbook_json, push_title, push_body, email_title,
        timestamp '2024-01-31 06:00:00' as generated_ts, skipped from messages""",
    "outbox_rows": "select * from sent",
    "outbox_posters": f"""select user_id, string_agg({_POSTER}, ' ' order by rn) as posters
        from titled_shows x join delivery using (user_id)
        left join poster_paths p on p.title = x.title group by user_id""",
    "outbox_cards": """select user_id, replace(push_body, chr(10), chr(10) || chr(10)) as body
        from delivery""",
    "outbox_mails": """select user_id, email_title as subject, user_email as address,
        cast(len(string_split(recommendations, ';')) as int) as images,
        cast(len(string_split(recommendations, ';')) - 1 as int) as cells
        from delivery where user_email is not null""",
    "outbox_trial": "select * from sent where user_id = (select min(user_id) from delivery)",
    "outbox_counts": "select event_date, channel, count(*) as n from sent group by event_date, channel",
}


def oracle_queries() -> dict[str, str]:
    """Each query's SQL with the views it needs, directly or through others."""
    return {name: _with_views(body) for name, body in BODIES.items()}


def _with_views(body: str) -> str:
    needed, queue = set(), [body]
    while queue:
        sql = queue.pop()
        used = {name for name in VIEWS if name not in needed and _mentions(sql, name)}
        needed |= used
        queue.extend(VIEWS[name] for name in used)
    ctes = ",\n".join(f"{name} as ({sql})" for name, sql in VIEWS.items() if name in needed)
    return f"with {ctes}\n{body}" if ctes else body


def _mentions(sql: str, name: str) -> bool:
    return any(f"{word} {name}" in " ".join(sql.split()) for word in ("from", "join"))
