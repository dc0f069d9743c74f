"""JSON encoding of the records on the wire: epoch milliseconds, integers, no nulls."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from cardsentry.schema import TRANSACTION_WIRE

_OPTIONS = {"ignoreNullFields": "true"}


def _transaction() -> Column:
    return F.struct(*[F.col(c).alias(w) for c, w in TRANSACTION_WIRE.items()])


def _hits() -> Column:
    return F.transform("hits", lambda h: F.struct(
        h["rule_id"].alias("ruleId"), h["weight"].alias("weight"),
        h["rule_version"].alias("ruleVersion"), h["evidence"].alias("evidence")))


def transaction_json() -> Column:
    return F.to_json(_transaction(), _OPTIONS)


def scored_json() -> Column:
    return F.to_json(F.struct(
        _transaction().alias("transaction"), F.col("score"), _hits().alias("hits"),
        F.unix_millis("scored_at").alias("scoredAt")), _OPTIONS)


def alert_json() -> Column:
    return F.to_json(F.struct(
        F.col("transaction_id").alias("transactionId"), F.col("card_id").alias("cardId"),
        F.col("score"), F.col("rule_ids").alias("ruleIds"), _hits().alias("hits"),
        F.col("amount_minor").alias("amountMinor"), F.col("currency"),
        F.col("merchant_id").alias("merchantId"),
        F.col("merchant_category").alias("merchantCategory"),
        F.col("country_code").alias("countryCode"),
        F.unix_millis("event_time").alias("eventTime"),
        F.unix_millis("scored_at").alias("scoredAt")), _OPTIONS)


def rule_config_json() -> Column:
    return F.to_json(F.struct(
        F.col("rule_id").alias("ruleId"), F.col("version"), F.col("enabled"), F.col("weight"),
        F.col("params"), F.col("updated_by").alias("updatedBy"),
        F.col("updated_ms").alias("updatedAt")), _OPTIONS)
