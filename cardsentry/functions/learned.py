"""A risk model that is learned from labelled transactions, as a plain column in the end.

The features are indicators and the logarithm of the amount, worked out by column expressions for
training and for scoring alike. Spark ML fits the weights; the fitted model is a sum of products
with literal weights, so scoring stays in generated code and ships no objects.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from cardsentry.functions.risk import LARGE_AMOUNT_MINOR, odd_hour, unusual_category


def features() -> dict[str, Column]:
    """Name to value; never null."""
    return {
        "unusual_category": unusual_category(F.col("merchant_category")).cast("double"),
        "no_device": F.col("device_fingerprint").isNull().cast("double"),
        "odd_hour": odd_hour(F.col("event_ms")).cast("double"),
        "large_amount": (F.col("amount_minor") >= LARGE_AMOUNT_MINOR).cast("double"),
        "log_amount": F.log1p(F.greatest(F.col("amount_minor"), F.lit(0)).cast("double")),
    }


@dataclasses.dataclass(frozen=True)
class LinearRisk:
    """A logistic model; calling it gives the probability as a column, as every model does."""

    intercept: float
    weights: Mapping[str, float]

    def __call__(self) -> Column:
        known = features()
        logit = F.lit(float(self.intercept))
        for name, weight in self.weights.items():
            logit = logit + F.lit(float(weight)) * known[name]
        return 1 / (1 + F.exp(-logit))


def fit_risk(transactions: DataFrame, labels: DataFrame, *, penalty: float = 1e-4) -> LinearRisk:
    """Learns from labelled rows (transaction_id, label fraud or legit; others are left out).

    Every labelled row takes part; training is distributed and its state is one weight a feature.
    Rare classes are weighted up, so the probability of a half parts them evenly.
    """
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    known = labels.filter(F.col("label").isin("fraud", "legit"))
    names = list(features())
    rows = transactions.join(known, "transaction_id").select(
        *(c.alias(n) for n, c in features().items()),
        (F.col("label") == "fraud").cast("double").alias("y"))
    n, frauds = rows.agg(F.count(F.lit(1)), F.sum("y")).first()
    if not frauds or frauds == n:
        raise ValueError("both fraudulent and legitimate rows are needed")
    weighted = rows.withColumn("w", F.when(F.col("y") == 1, n / (2 * frauds)).otherwise(n / (2 * (n - frauds))))
    ready = VectorAssembler(inputCols=names, outputCol="x").transform(weighted)
    fitted = LogisticRegression(featuresCol="x", labelCol="y", weightCol="w", regParam=penalty).fit(ready)
    return LinearRisk(fitted.intercept, dict(zip(names, fitted.coefficients.tolist())))
