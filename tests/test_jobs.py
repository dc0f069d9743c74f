"""The whole batch path over files: land, score, roll up, retune, score again."""

from __future__ import annotations

import dataclasses
import datetime

import pytest
from pyspark.sql import functions as F

from cardsentry.operators.alerts import by_card
from cardsentry.operators.rules import RuleConfigError, default_rules
from cardsentry.plans import jobs
from cardsentry.schema import VELOCITY
from cardsentry.sources.sample import sample_labels, sample_lines
from cardsentry.sources.days import DayTable
from cardsentry.sources.tables import read_table

SF = "/root/testdata/sf0.001"


def test_the_batch_path(spark, tmp_path):
    root = str(tmp_path)
    jobs.land(sample_lines(spark, SF).select("value"), root)
    assert jobs.landed_dead_letters(spark, root).count() == 70
    jobs.score_all(spark, root, hot_rows=100)
    scored = read_table(spark, f"{root}/scored")
    assert scored.count() == 930
    alerts = jobs.alert_table(spark, root).read()
    assert alerts.count() == scored.filter("score >= 40").count() > 0

    first, last = datetime.date(2024, 1, 1), datetime.date(2024, 1, 31)
    jobs.roll_up(spark, root, first, last)
    whole = DayTable(spark, f"{root}/daily_card_agg", "agg_date").read().drop("computed_at").collect()
    jobs.roll_up(spark, root, first, datetime.date(2024, 1, 3))  # a backfill of three days
    again = DayTable(spark, f"{root}/daily_card_agg", "agg_date").read()
    assert sorted(map(str, again.drop("computed_at").collect())) == sorted(map(str, whole))
    assert again.select("computed_at").distinct().count() == 2
    assert sum(r["txn_count"] for r in whole) == 930

    labels = sample_labels(spark, SF)
    jobs.retune_rules(spark, root, labels, 0.02, now_ms=1, hot_rows=100)
    assert {r.version for r in jobs.current_rules(spark, root).values()} == {2}
    jobs.retune_rules(spark, root, labels, 0.02, now_ms=2)
    rules = jobs.current_rules(spark, root)
    assert {r.version for r in rules.values()} == {3}
    assert read_table(spark, f"{root}/rule_versions").count() == 10
    jobs.score_all(spark, root)
    assert read_table(spark, f"{root}/scored").filter(
        F.exists("hits", lambda h: h["rule_version"] != 3)).count() == 0


def test_days_of_the_rollup_prune_partitions(spark, tmp_path):
    root = str(tmp_path)
    jobs.land(sample_lines(spark, SF).select("value"), root)
    jobs.score_all(spark, root)
    day = read_table(spark, f"{root}/scored").filter("event_date = DATE'2024-01-05'")
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    plan = by_card(jobs.alert_table(spark, root).read(), "card-1")._jdf.queryExecution(
        ).executedPlan().toString()
    assert "EqualTo(card_id,card-1)" in plan.split("PushedFilters")[1]


def test_pushed_rules_are_checked_and_must_be_newer(spark, tmp_path):
    root = str(tmp_path)
    v1 = default_rules()[VELOCITY]
    tuned = dataclasses.replace(v1.with_params(maxCount=7.0), version=2, updated_by="me", updated_ms=1)
    jobs.push_rule(spark, root, tuned, "api")
    assert jobs.current_rules(spark, root)[VELOCITY] == tuned
    with pytest.raises(RuleConfigError, match="version must be > 2, got 2"):
        jobs.push_rule(spark, root, tuned, "api")
    with pytest.raises(RuleConfigError) as error:
        jobs.push_rule(spark, root, dataclasses.replace(
            v1, version=3, params={"maxCount": 1.0, "bogus": 1.0}), "api")
    assert len(error.value.problems) == 3
    with pytest.raises(RuleConfigError, match="source"):
        jobs.push_rule(spark, root, dataclasses.replace(tuned, version=3), "hand")
    assert read_table(spark, f"{root}/rule_versions").count() == 1


def test_a_run_killed_between_two_writes_leaves_the_old_alerts(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    jobs.land(sample_lines(spark, SF).select("value"), root)
    jobs.score_all(spark, root)
    table = jobs.alert_table(spark, root)
    before = sorted(map(str, table.read().select("transaction_id", "score", "inserted_at").collect()))

    def killed(*args):
        raise RuntimeError("killed")

    with monkeypatch.context() as patch:
        patch.setattr(DayTable, "_commit", killed)
        with pytest.raises(RuntimeError, match="killed"):
            jobs.score_all(spark, root)
    assert sorted(map(str, table.read().select("transaction_id", "score", "inserted_at").collect())) == before
    jobs.score_all(spark, root)  # the same rows again: the first insert times stay
    assert sorted(map(str, table.read().select("transaction_id", "score", "inserted_at").collect())) == before
    assert len(table._versions("data")) <= 2


def test_landing_adds_and_a_named_load_replaces_itself(spark, tmp_path):
    root = str(tmp_path)
    lines = sample_lines(spark, SF, keep=("event_ms",))
    half = F.col("event_id") % 2 == 0
    jobs.land(lines.filter(half).select("value"), root, "one")
    jobs.land(lines.filter(~half).select("value"), root, "two")
    jobs.land(lines.filter(~half).select("value"), root, "two")
    assert jobs.landed_transactions(spark, root).count() == 930
    assert jobs.landed_dead_letters(spark, root).count() == 70


def test_days_without_rows_leave_the_table(spark, tmp_path):
    table = DayTable(spark, str(tmp_path / "t"))
    day = [datetime.date(2024, 1, d) for d in (1, 2, 3)]
    rows = spark.createDataFrame([(k, d) for k, d in enumerate(day)], "k int, event_date date")
    assert table.read() is None
    table.replace(day, lambda before: rows)
    table.replace(day[1:], lambda before: before.filter("k = 2"))
    assert sorted(r["k"] for r in table.read().collect()) == [0, 2]
    table.replace(day, lambda before: rows.limit(0))
    assert table.read() is None
