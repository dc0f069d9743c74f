from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from cardsentry.functions.geo import haversine_km, km_per_hour
from cardsentry.functions.numbers import is_whole, round_to_long, whole_seconds
from cardsentry.functions.risk import logistic_risk, odd_hour
from cardsentry.schema import event_time, event_time_millis
from cardsentry.sources.centroids import CENTROIDS, centroids
from tests.helpers import frame, transaction

AFTERNOON, NIGHT = 1_767_276_000_000, 1_767_234_600_000  # 14:00 and 02:30 UTC


def _risk(spark, **kw):
    at = kw.pop("at", AFTERNOON)
    rows = frame(spark, [transaction("t", at, **{"amount_minor": 3000, **kw})])
    return rows.select(logistic_risk()).first()[0]


def test_everyday_purchase_scores_low(spark):
    assert _risk(spark) < 0.5


@pytest.mark.parametrize("feature", [
    {"merchant_category": "7995"}, {"device_fingerprint": None}, {"at": NIGHT},
    {"amount_minor": 100000}])
def test_one_feature_stays_below_the_cutoff(spark, feature):
    assert 0 < _risk(spark, **feature) < 0.75


@pytest.mark.parametrize("features,expected", [
    ({"merchant_category": "7995", "device_fingerprint": None, "at": NIGHT}, 0.7685),
    ({"merchant_category": "7995", "device_fingerprint": None, "amount_minor": 100000}, 0.7858),
    ({"merchant_category": "7995", "at": NIGHT, "amount_minor": 100000}, 0.7503),
    ({"device_fingerprint": None, "at": NIGHT, "amount_minor": 100000}, 0.7109),
    ({"merchant_category": "7995", "device_fingerprint": None, "at": NIGHT,
      "amount_minor": 150000}, 0.9241)])
def test_combinations(spark, features, expected):
    assert _risk(spark, **features) == pytest.approx(expected, abs=1e-4)


def test_missing_category_is_not_unusual_and_empty_device_is_a_device(spark):
    assert _risk(spark, merchant_category=None) == _risk(spark)
    assert _risk(spark, device_fingerprint="") == _risk(spark)


def test_odd_hour_bounds_in_any_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    hours = {0: False, 1: True, 4: True, 5: False, 23: False}
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        for hour, odd in hours.items():
            ms = 1_767_225_600_000 + hour * 3_600_000
            assert spark.range(1).select(odd_hour(F.lit(ms))).first()[0] is odd
        assert spark.range(1).select(odd_hour(F.lit(-1 * 22 * 3_600_000))).first()[0] is True
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_haversine(spark):
    def km(a, b):
        (la, lo), (lb, lp) = (CENTROIDS[c] for c in (a, b))
        return spark.range(1).select(haversine_km(*[F.lit(x) for x in (la, lo, lb, lp)])).first()[0]

    def expected(a, b):
        (la, lo), (lb, lp) = ([math.radians(x) for x in CENTROIDS[c]] for c in (a, b))
        h = (math.sin((lb - la) / 2) ** 2
             + math.cos(la) * math.cos(lb) * math.sin((lp - lo) / 2) ** 2)
        return 2 * 6371.0 * math.asin(math.sqrt(h))

    for a, b in (("US", "JP"), ("NO", "JP"), ("NL", "BE"), ("NZ", "AR"), ("FI", "FI")):
        assert km(a, b) == pytest.approx(expected(a, b), abs=1e-6)
    assert centroids(spark).count() == 43


def test_numbers(spark):
    row = spark.range(1).select(
        round_to_long(F.lit(2.5)).alias("a"), round_to_long(F.lit(3.49)).alias("b"),
        whole_seconds(F.lit(1999)).alias("c"), is_whole(F.lit(5.5)).alias("d"),
        is_whole(F.lit(5.0)).alias("e"), km_per_hour(F.lit(100.0), F.lit(1_800_000)).alias("f"),
        km_per_hour(F.lit(100.0), F.lit(0)).alias("g"),
        event_time_millis(event_time(F.lit(1_767_225_600_123))).alias("h")).first()
    assert tuple(row) == (3, 3, 1, False, True, 200.0, None, 1_767_225_600_123)
