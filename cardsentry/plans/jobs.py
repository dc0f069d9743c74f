"""Whole jobs over tables below one root: land, score, roll up, retune.

Each step reads what the step before wrote, so nothing is worked out twice and a lost
executor costs at most the step it was in.
"""

from __future__ import annotations

import datetime
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cardsentry.functions.risk import Model, logistic_risk
from cardsentry.operators import quality
from cardsentry.operators.alerts import flat_alerts
from cardsentry.operators.facts import HOT_ROWS, card_parts
from cardsentry.operators.feedback import retune
from cardsentry.operators.rollup import daily_card_agg
from cardsentry.operators.rules import (
    Rule, RuleConfigError, RuleSet, load_rules, require_valid, rules_frame)
from cardsentry.operators.verdict import score_transactions, scored_only
from cardsentry.schema import RULE_CONFIG, RULE_SOURCES, TRANSACTION_COLUMNS, event_date
from cardsentry.sources.days import DayTable, days_between, days_in
from cardsentry.sources.parse import dead_letters, parse_lines, unique_transactions
from cardsentry.sources.tables import append_rows, overwrite_days, read_table


def land(lines: DataFrame, root: str, load: str | None = None) -> None:
    """Parses raw lines once and adds them to ``parsed``, accepted and refused ones side by side.

    A load that is given its name again replaces what it brought before.
    """
    name = load or uuid.uuid4().hex
    (parse_lines(lines)
     .withColumn("payload", F.when(F.col("reason").isNotNull(), F.col("payload")))
     .withColumn("refused", F.col("reason").isNotNull().cast("int"))
     .write.mode("overwrite").partitionBy("refused").parquet(f"{root}/parsed/load={name}"))


def landed_transactions(spark: SparkSession, root: str) -> DataFrame:
    """Accepted rows, one per transaction id; refused ones are pruned as a partition."""
    rows = read_table(spark, f"{root}/parsed").filter("refused = 0")
    return unique_transactions(rows.select(*TRANSACTION_COLUMNS))


def landed_dead_letters(spark: SparkSession, root: str) -> DataFrame:
    return dead_letters(read_table(spark, f"{root}/parsed").filter("refused = 1"))


def current_rules(spark: SparkSession, root: str) -> RuleSet:
    """The rules in force of the version table, or the bootstrap rules while there is none."""
    try:
        versions = read_table(spark, f"{root}/rule_versions")
    except AnalysisException:
        return load_rules(None)
    return load_rules(versions.select(*RULE_CONFIG.fieldNames()))


def score_all(spark: SparkSession, root: str, *, model: Model = logistic_risk,
              hot_rows: int | None = HOT_ROWS) -> None:
    """Scores all landed transactions into ``scored`` by day, and the alerts among them."""
    transactions = landed_transactions(spark, root)
    transactions.write.mode("overwrite").parquet(f"{root}/transactions")
    rows = read_table(spark, f"{root}/transactions")
    verdict = scored_only(score_transactions(
        rows, current_rules(spark, root), model=model, hot_rows=hot_rows, parts=card_parts(rows)))
    overwrite_days(verdict.withColumn("event_date", event_date()),
                   f"{root}/scored", "event_date", "card_id", "event_ms")
    scored = read_table(spark, f"{root}/scored")
    quality.require_clean(quality.scored_checks(scored))
    replace_alerts(alert_table(spark, root), scored)


def alert_table(spark: SparkSession, root: str) -> DayTable:
    return DayTable(spark, f"{root}/alerts")


def replace_alerts(table: DayTable, scored: DataFrame, inserted_at: Column | None = None) -> None:
    """For the days of ``scored`` the alert table becomes what alerts there; other days stay.

    What no longer alerts goes; an alert that was there before keeps the time of its first insert.
    """
    def merged(before: DataFrame | None) -> DataFrame:
        fresh = flat_alerts(scored).withColumn("event_date", event_date(F.unix_millis("event_time")))
        now = F.current_timestamp() if inserted_at is None else inserted_at
        fresh = fresh.withColumn("inserted_at", now)
        if before is None:
            return fresh
        first = before.select("transaction_id", F.col("inserted_at").alias("_first"))
        return (fresh.join(first, "transaction_id", "left")
                .withColumn("inserted_at", F.coalesce("_first", "inserted_at")).drop("_first"))

    days = days_in(scored.select(event_date().alias("event_date")))
    table.replace(days, merged, "card_id", "event_time")


def roll_up(spark: SparkSession, root: str, first: datetime.date, last: datetime.date) -> None:
    """Rolls up the days from ``first`` to ``last``, replacing what was there for them."""
    days = read_table(spark, f"{root}/scored").filter(
        F.col("event_date").between(F.lit(first), F.lit(last)))
    rollup = daily_card_agg(days).withColumn("computed_at", F.current_timestamp())
    table = DayTable(spark, f"{root}/daily_card_agg", "agg_date")
    table.replace(days_between(first, last), lambda before: rollup, "card_id")
    fresh = table.read(days_between(first, last))
    if fresh is not None:
        quality.require_clean(quality.rollup_checks(fresh))


def push_rule(spark: SparkSession, root: str, rule: Rule, source: str) -> None:
    """Appends a checked version of one rule; it must be newer than the one in force."""
    require_valid(spark, rule)
    if source not in RULE_SOURCES:
        raise RuleConfigError(rule.rule_id, [f"source must be one of {RULE_SOURCES}, got {source}"])
    current = current_rules(spark, root).get(rule.rule_id)
    if not rule.supersedes(current):
        raise RuleConfigError(rule.rule_id, [
            f"version must be > {current.version}, got {rule.version}"])
    append_rows(rules_frame(spark, [rule]).withColumn("source", F.lit(source)),
                f"{root}/rule_versions")


def retune_rules(spark: SparkSession, root: str, labels: DataFrame, target: float,
                 now_ms: int, hot_rows: int | None = HOT_ROWS) -> None:
    """Appends the next version of every rule to ``rule_versions``; a running stream picks it up."""
    quality.require_clean(quality.label_checks(labels))
    fresh = retune(read_table(spark, f"{root}/transactions"), labels, current_rules(spark, root),
                   target, updated_ms=now_ms, hot_rows=hot_rows)
    append_rows(fresh.drop("chosen", "fpr"), f"{root}/rule_versions")
