"""Every registered query against its SQL on the smallest tables, and the plans behind them."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from cardsentry.operators import facts
from cardsentry.plans import catalog, oracle
from cardsentry.operators.alerts import flat_alerts
from cardsentry.operators.rules import default_rules
from cardsentry.operators.verdict import score_transactions, scored_only
from cardsentry.sources.sample import sample_transactions
from tests import compare

SF = "/root/testdata/sf0.001"
QUERIES, ORACLE = catalog.QUERIES, oracle.ORACLE_SQL


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert compare.difference(QUERIES[name](spark, SF), con, ORACLE[name]) is None


def test_entry(spark):
    assert contract.entry(spark).count() == 345


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scoring_shuffles_once(spark):
    rows = sample_transactions(spark, SF)
    plan = _plan(flat_alerts(scored_only(score_transactions(rows, default_rules()))))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "Python" not in plan


def test_unused_columns_are_not_read(spark):
    rows = sample_transactions(spark, SF)
    plan = _plan(score_transactions(rows, default_rules()).select("transaction_id", "velocity_count"))
    assert "event_type" not in plan.split("ReadSchema")[1]


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith("stream")))
def test_no_query_multiplies_rows(spark, name):
    plan = _plan(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_tasks_of_cards_do_not_grow_with_the_table(spark, con, monkeypatch):
    """Whole cards are dealt to more tasks, and the rows stay what they are."""
    plan = _plan(QUERIES["alerts_upsert"](spark, SF))
    assert "REPARTITION_BY_NUM" not in plan  # a small table is left to the session
    monkeypatch.setattr(facts, "ROWS_PER_TASK", 20)
    rows = QUERIES["alerts_upsert"](spark, SF)
    plan = _plan(rows)
    parts = -(-sample_transactions(spark, SF).count() // 20)
    assert parts > 20 and "hashpartitioning(card_id" in plan and f", {parts}), REPARTITION_BY_NUM" in plan
    assert "ENSURE_REQUIREMENTS" not in plan.split("REPARTITION_BY_NUM")[0].split("Window")[-1]
    assert compare.difference(rows, con, ORACLE["alerts_upsert"]) is None
