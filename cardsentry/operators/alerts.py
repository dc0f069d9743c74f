"""Alerts: the flat rows served to people, their keyed table and its reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cardsentry.schema import ALERT_THRESHOLD, event_time

ALERT_COLUMNS = ["transaction_id", "card_id", "score", "rule_ids", "hits", "amount_minor",
                 "currency", "merchant_id", "merchant_category", "country_code", "event_time",
                 "scored_at"]


def alerting(scored: DataFrame, threshold: int = ALERT_THRESHOLD) -> DataFrame:
    return scored.filter(F.col("score") >= threshold)


def flat_alerts(scored: DataFrame, threshold: int = ALERT_THRESHOLD) -> DataFrame:
    """Twelve flat columns; rule ids sorted, repeated ids kept."""
    rule_ids = F.array_sort(F.transform("hits", lambda h: h["rule_id"]))
    return (alerting(scored, threshold)
            .withColumn("rule_ids", rule_ids).withColumn("event_time", event_time())
            .select(*ALERT_COLUMNS))


def latest_alerts(written: DataFrame) -> DataFrame:
    """One row per transaction id out of all alerts ever written.

    The row scored last wins, and ``inserted_at`` keeps its first value, which makes
    a replay visible. An aggregate, so replayed copies combine before the shuffle.
    """
    columns = [c for c in written.columns if c not in ("transaction_id", "inserted_at")]
    # ``hits`` holds variants, which have no order; it rides along as the value.
    rank = F.struct("scored_at", "inserted_at")
    return (written.groupBy("transaction_id")
            .agg(F.max_by(F.struct(*columns), rank).alias("_row"),
                 F.min("inserted_at").alias("inserted_at"))
            .select("transaction_id", "_row.*", "inserted_at"))


def upsert_alerts(stored: DataFrame, fresh: DataFrame) -> DataFrame:
    """The alert table after ``fresh`` is written to it."""
    return latest_alerts(stored.unionByName(fresh))


def by_card(alerts: DataFrame, card_id: str) -> DataFrame:
    return alerts.filter(F.col("card_id") == card_id)


def by_time(alerts: DataFrame, start: str, end: str) -> DataFrame:
    """Event time from ``start`` up to but not including ``end``.

    Both are timestamps as text; without a zone they are read in that of the session.
    """
    at = F.col("event_time")
    return alerts.filter((at >= F.lit(start).cast("timestamp")) & (at < F.lit(end).cast("timestamp")))


def by_rule(alerts: DataFrame, rule_id: str) -> DataFrame:
    return alerts.filter(F.array_contains("rule_ids", rule_id))


def page(alerts: DataFrame, size: int, after: tuple[str, str] | None = None) -> DataFrame:
    """The next ``size`` alerts, newest first.

    ``after`` is (event_time, transaction_id) of the last row of the page before. A
    predicate instead of an offset, so a deep page costs as much as the first; each
    task keeps only ``size`` rows.
    """
    if after is not None:
        at, key = F.lit(after[0]).cast("timestamp"), F.lit(after[1])
        alerts = alerts.filter((F.col("event_time") < at)
                               | ((F.col("event_time") == at) & (F.col("transaction_id") > key)))
    return alerts.orderBy(F.col("event_time").desc(), F.col("transaction_id")).limit(size)
