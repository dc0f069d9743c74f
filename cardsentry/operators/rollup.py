"""Daily rollup per card, and percentiles of the scoring delay."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from cardsentry.operators.facts import TOTAL
from cardsentry.schema import ALERT_THRESHOLD


def daily_card_agg(scored: DataFrame, threshold: int = ALERT_THRESHOLD) -> DataFrame:
    """One row per UTC day and card; max_score is null on a day without an alert.

    Rows are first summed up by (day, card, merchant, country), which combines before the
    shuffle; the distinct counts then run over those few rows, so the size of a card does not
    matter and no row is repeated. The total is a decimal, which no sum of bigints exceeds.
    """
    alert = F.col("score") >= threshold
    day = F.date_from_unix_date(F.floor(F.col("event_ms") / F.lit(86_400_000)).cast("int"))
    parts = (scored.groupBy(day.alias("agg_date"), "card_id", "merchant_id", "country_code")
             .agg(F.count(F.lit(1)).alias("n"), F.count(F.when(alert, 1)).alias("alerts"),
                  F.sum(F.col("amount_minor").cast(TOTAL)).alias("total"),
                  F.max(F.when(alert, F.col("score"))).alias("max_score")))
    return (parts.groupBy("agg_date", "card_id")
            .agg(F.sum("n").alias("txn_count"), F.sum("alerts").alias("alert_count"),
                 F.sum("total").alias("total_amount_minor"),
                 F.countDistinct("merchant_id").cast("int").alias("distinct_merchants"),
                 F.countDistinct("country_code").cast("int").alias("distinct_countries"),
                 F.max("max_score").alias("max_score")))


def delay_percentiles(scored: DataFrame, points: Sequence[float] = (0.5, 0.9, 0.99),
                      accuracy: int = 100_000) -> DataFrame:
    """Percentiles of scored_at - event time in ms, over the rows themselves.

    ``percentile_approx`` merges sketches of bounded size; a rank is off by at most
    1 / accuracy of the rows.
    """
    delay = F.unix_millis("scored_at") - F.col("event_ms")
    found = scored.agg(
        F.count(F.lit(1)).alias("rows"),
        F.percentile_approx(delay, [float(p) for p in points], accuracy).alias("p"))
    return found.select("rows", *[F.col("p")[i].alias(f"p{p * 100:g}".replace(".", "_"))
                                  for i, p in enumerate(points)])
