"""Checks of the batch tables that can fail a nightly run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from cardsentry.schema import LABELS, RULE_IDS, RULE_SOURCES


class QualityError(ValueError):
    """A table broke its contract."""


def duplicate_keys(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Number of keys held by more than one row."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
            .agg(F.count(F.when(F.col("_n") > 1, 1)).alias("violations"))
            .select(F.lit(name).alias("check"), "violations"))


def broken_rows(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """Rows that do not meet each condition; a null condition counts as broken.

    One pass for all conditions, one row per check.
    """
    counted = df.agg(*[F.count(F.when(~F.coalesce(ok, F.lit(False)), 1)).alias(f"_{i}")
                       for i, ok in enumerate(checks.values())])
    pairs = F.array(*[F.struct(F.lit(name).alias("check"), F.col(f"_{i}").alias("violations"))
                      for i, name in enumerate(checks)])
    return counted.select(F.explode(pairs).alias("_c")).select("_c.*")


def scored_checks(scored: DataFrame) -> DataFrame:
    return duplicate_keys(scored, ["transaction_id"], "scored.transaction_id unique").unionByName(
        broken_rows(scored, {
            "scored.amount_minor >= 0": F.col("amount_minor") >= 0,
            "scored.score >= 0": F.col("score") >= 0,
            "scored.currency has 3 letters": F.length("currency") == 3,
            "scored.country_code has 2 letters": F.length("country_code") == 2,
            "scored.rule ids known": F.forall("hits", lambda h: h["rule_id"].isin(*RULE_IDS)),
            "scored.score is the sum of weights": F.col("score") == F.aggregate(
                "hits", F.lit(0), lambda total, h: total + h["weight"]),
        }))


def label_checks(labels: DataFrame) -> DataFrame:
    return duplicate_keys(labels, ["transaction_id"], "labels.transaction_id unique").unionByName(
        broken_rows(labels, {"labels.label allowed": F.col("label").isin(*LABELS)}))


def rollup_checks(rollup: DataFrame) -> DataFrame:
    return duplicate_keys(rollup, ["agg_date", "card_id"], "daily_card_agg key unique").unionByName(
        broken_rows(rollup, {
            "daily_card_agg.alert_count <= txn_count": F.col("alert_count") <= F.col("txn_count"),
            "daily_card_agg.max_score only with alerts":
                F.col("max_score").isNotNull() == (F.col("alert_count") > 0),
        }))


def version_checks(versions: DataFrame) -> DataFrame:
    return duplicate_keys(versions, ["rule_id", "version"], "rule_versions key unique").unionByName(
        broken_rows(versions, {"rule_versions.source allowed": F.col("source").isin(*RULE_SOURCES)}))


def require_clean(checks: DataFrame) -> None:
    """Raises with every broken check. Collects one row per check that failed."""
    broken = checks.filter(F.col("violations") > 0).collect()
    if broken:
        raise QualityError("; ".join(f"{r['check']}: {r['violations']}" for r in broken))
