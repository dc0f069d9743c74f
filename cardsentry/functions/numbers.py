"""Rounding and number tests."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def round_to_long(x: Column) -> Column:
    """Nearest whole number; halves go up. For values >= 0."""
    return F.round(x).cast("bigint")


def whole_seconds(ms: Column) -> Column:
    """Milliseconds to seconds, cut towards zero."""
    return F.when(ms >= 0, F.floor(ms / F.lit(1000))).otherwise(F.ceil(ms / F.lit(1000)))


def is_finite(x: Column) -> Column:
    return ~(F.isnan(x) | x.isin(float("inf"), float("-inf")))


def is_whole(x: Column) -> Column:
    return x == F.rint(x)
