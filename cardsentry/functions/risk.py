"""Logistic risk probability of a single transaction."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

# Unusual merchant categories, the large amount, the coefficients.
UNUSUAL_CATEGORIES = ("5967", "6051", "7995", "5933", "4829")
LARGE_AMOUNT_MINOR = 100000
INTERCEPT = -3.0
W_UNUSUAL_CATEGORY = 1.6
W_NO_DEVICE = 1.4
W_ODD_HOUR = 1.2
W_LARGE_AMOUNT = 1.3

# A model is any function from nothing to a probability column over transaction columns.
Model = Callable[[], Column]


def odd_hour(event_ms: Column) -> Column:
    """01:00 to 04:59 UTC, from epoch milliseconds, whatever the session time zone."""
    return F.pmod(F.floor(event_ms / F.lit(3600000)), F.lit(24)).between(1, 4)


def unusual_category(category: Column) -> Column:
    """False, not null, for a missing category."""
    return F.coalesce(category.isin(*UNUSUAL_CATEGORIES), F.lit(False))


def logistic_risk() -> Column:
    def term(flag: Column, weight: float) -> Column:
        return F.when(flag, F.lit(weight)).otherwise(F.lit(0.0))

    logit = (F.lit(INTERCEPT)
             + term(unusual_category(F.col("merchant_category")), W_UNUSUAL_CATEGORY)
             + term(F.col("device_fingerprint").isNull(), W_NO_DEVICE)
             + term(odd_hour(F.col("event_ms")), W_ODD_HOUR)
             + term(F.col("amount_minor") >= LARGE_AMOUNT_MINOR, W_LARGE_AMOUNT))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-logit))
