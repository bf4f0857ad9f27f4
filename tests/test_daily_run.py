"""The whole daily run over stored tables, the way the README describes it."""

import json
from datetime import date

import pytest

from holdfast.catalog.queries import sample_generator
from holdfast.operators.filters import pick_date
from holdfast.plans.campaign import campaign_brief
from holdfast.plans.messages import build_messages
from holdfast.plans.outbox import delivery_list, outbox
from holdfast.plans.scoring import score_day, score_report
from holdfast.plans.training import TrainParams, train_and_register
from holdfast.sources.registry import load_latest, registry
from holdfast.sources.standins import AS_OF, Inputs
from holdfast.sources.tables import activity_history, read_date, read_table, replace_date

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("lake"))
    inputs = Inputs(spark, DATA)
    for name in ("snapshot", "daily_watch_time", "watch_events", "campaign_targets"):
        getattr(inputs, name).write.partitionBy("event_date").parquet(f"{folder}/{name}")
    for name in ("content_master", "users", "posters"):
        getattr(inputs, name).write.parquet(f"{folder}/{name}")
    return folder


def test_daily_run(spark, lake):
    def table(name):
        return read_table(spark, f"{lake}/{name}")

    snapshot, history = table("snapshot"), activity_history(table("daily_watch_time"))
    assert train_and_register(snapshot, history, f"{lake}/models", TrainParams(rounds=12, patience=4)) == 1
    assert registry(spark, f"{lake}/models").first().metrics["auc_roc"] > 0.5
    model = load_latest(spark, f"{lake}/models")

    day = pick_date(snapshot, AS_OF)
    assert day == date(2024, 1, 30)
    for one in ("2024-01-29", day):
        scored = replace_date(score_day(snapshot, model, one), f"{lake}/predictions", one)
    assert scored == read_date(spark, f"{lake}/predictions", day).count() == 150
    assert table("predictions").count() == 300
    bands, distribution = score_report(read_date(spark, f"{lake}/predictions", day))
    assert sum(r.n for r in bands.collect()) == distribution.first()["count"] == 150

    brief = campaign_brief(
        table("campaign_targets"), snapshot, table("watch_events"), table("content_master"), day, limit=8
    )
    targets = {r.user_id: r for r in brief.collect()}
    assert len(targets) == 8
    assert replace_date(build_messages(brief, sample_generator()), f"{lake}/messages", day) == 8

    delivery = delivery_list(read_date(spark, f"{lake}/messages", day), table("users"), day)
    rows = outbox(delivery, table("posters"))
    written = replace_date(rows, f"{lake}/outbox", day)
    sent = read_date(spark, f"{lake}/outbox", day).collect()
    assert written == len(sent) > 8
    for row in sent:
        target = targets[row.user_id]
        assert target.send_flag == 1 and target.strategy_code != "Calm"
        first_title = target.content_list.split("\n")[0].removeprefix("- ")
        payload = json.loads(row.payload)
        if row.channel == "card":
            assert row.subject == f"Tonight: {first_title}"
            assert payload["attachments"][0]["content"]["body"][0]["text"] == row.subject
        else:
            assert payload["content"]["html"].count("<img ") == 5
            assert f">{first_title}</h2>" in payload["content"]["html"]


def test_brief_scans_one_date(spark, lake):
    brief = campaign_brief(
        *(read_table(spark, f"{lake}/{n}") for n in ("campaign_targets", "snapshot", "watch_events", "content_master")),
        "2024-01-30",
    )
    plan = brief._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert any("(event_date" in s.split("PartitionFilters:")[1] and "= 2024-01-30)" in s for s in scans)
    assert any("> 2023-12-31" in s.split("PartitionFilters:")[1] for s in scans)
