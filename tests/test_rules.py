from __future__ import annotations

import dataclasses

import pytest
from pyspark.sql import functions as F

from cardsentry.operators import rules as R
from cardsentry.operators.asof import rules_in_force
from cardsentry.operators.verdict import ROW_RULES, RowRule, score_transactions
from cardsentry.schema import CARD_TESTING, MODEL_SCORE, RULE_IDS, VELOCITY
from tests.helpers import frame, transaction

GOOD = {"windowSeconds": 60.0, "maxCount": 5.0}


def _rule(rule_id=VELOCITY, params=GOOD, version=1, weight=30, **more):
    return R.Rule(rule_id, version, True, weight, params, "test", **more)


@pytest.mark.parametrize("rule,expected", [
    (_rule(), []),
    (_rule("nonsense", {}), ["unknown ruleId"]),
    (_rule(params={"windowSeconds": 60.0}), ["missing param maxCount"]),
    (_rule(params={**GOOD, "maxCount": 1.0}), ["maxCount must be 2.0..1000.0, got 1.0"]),
    (_rule(params={**GOOD, "windowSecond": 60.0}),
     ["unknown param windowSecond (allowed: [maxCount, windowSeconds])"]),
    (_rule(params={**GOOD, "maxCount": 5.5}), ["maxCount must be a whole number, got 5.5"]),
    (_rule(params={**GOOD, "windowSeconds": float("nan")}), ["windowSeconds must be finite"]),
    (_rule(params={**GOOD, "windowSeconds": float("inf")}), ["windowSeconds must be finite"]),
    (_rule(version=0), ["version must be >= 1, got 0"]),
    (_rule(params={"maxCount": 1.0, "bogus": 1.0}, version=0, weight=500),
     ["version must", "weight must be 0..100, got 500", "missing param windowSeconds",
      "maxCount must be", "unknown param bogus"]),
    (_rule(CARD_TESTING, {"probeCount": 3.0, "probeMaxAmountMinor": 50000.0,
                          "largeAmountMinor": 50000.0, "windowSeconds": 300.0}),
     ["probeMaxAmountMinor (50000.0) must be < largeAmountMinor (50000.0)"]),
    (_rule(MODEL_SCORE, {"probThreshold": 0.4}), ["probThreshold must be 0.5..0.999"]),
])
def test_problems(spark, rule, expected):
    found = R.check_rule(spark, rule)
    assert len(found) == len(expected)
    for text, start in zip(found, expected):
        assert text.startswith(start)


def test_defaults_are_valid_and_complete(spark):
    assert set(R.default_rules()) == set(RULE_IDS)
    assert R.valid_configs(R.rules_frame(spark, R.default_rules().values())).count() == 5


def test_supersedes():
    v1, v2 = _rule(version=1), _rule(version=2)
    assert v2.supersedes(v1) and v1.supersedes(None)
    assert not v1.supersedes(v2) and not v1.supersedes(v1)
    assert not _rule(MODEL_SCORE, version=9).supersedes(v1)


def test_last_good_version_stays(spark):
    history = [
        _rule(version=1, updated_ms=10),
        _rule(version=2, params={**GOOD, "maxCount": 7.0}, updated_ms=20),
        _rule(version=3, params={**GOOD, "maxCount": -1.0}, updated_ms=30),  # invalid
        _rule(version=1, params={**GOOD, "maxCount": 9.0}, updated_ms=40),  # stale
        _rule(version=2, params={**GOOD, "maxCount": 8.0}, updated_ms=50),  # not newer
    ]
    rules = R.load_rules(R.rules_frame(spark, history))
    assert (rules[VELOCITY].version, rules[VELOCITY].whole("maxCount")) == (2, 7)
    assert rules[MODEL_SCORE] == R.default_rules()[MODEL_SCORE]
    assert R.load_rules(None) == R.default_rules()


def test_version_in_force_equals_a_row_by_row_search(spark):
    import random
    rng = random.Random(3)
    pushes = [(rng.choice("ab"), rng.randrange(3, 30), rng.randrange(0, 50) * 1000) for _ in range(120)]
    pushes += [("a", 2, None), ("d", 5, None), ("d", 4, 7_000), ("b", 90, 253_402_300_799_999), (None, 7, 0)]
    asked = [(i, rng.choice("abcd"), rng.randrange(-5, 60) * 1000 + rng.choice((0, 1)))
             for i in range(300)]
    asked += [(300, "a", None), (301, None, 5_000), (302, "b", 253_402_300_799_999), (303, "a", -(1 << 50))]
    versions = spark.createDataFrame(pushes, "rule_id string, version bigint, updated_ms bigint")
    questions = spark.createDataFrame(asked, "i int, rule_id string, event_ms bigint")

    def truth(rule_id, at):
        seen = [(v, ms) for r, v, ms in pushes
                if r == rule_id and None not in (r, at) and (ms is None or ms <= at)]
        if not seen:
            return None, None
        best = max(v for v, _ in seen)
        times = [ms for v, ms in seen if v == best]
        return best, None if None in times else min(times)

    for slice_ms in (1_000, 7_000, 3_600_000):
        got = {r["i"]: (r["version_in_force"], r["in_force_since"])
               for r in rules_in_force(questions, versions, slice_ms=slice_ms).collect()}
        assert got == {i: truth(r, at) for i, r, at in asked}


def test_hit_versions_and_first_pushes(spark):
    history = [_rule(version=1, updated_ms=10), _rule(version=1, weight=31, updated_ms=20)]
    versions = R.first_pushes(R.rules_frame(spark, history))
    assert versions.count() == 1 and versions.first()["weight"] == 30
    hits = spark.createDataFrame([("t", VELOCITY, 1), ("u", VELOCITY, 2)],
                                 "transaction_id string, rule_id string, rule_version bigint")
    got = {r["transaction_id"]: r["updated_ms"] for r in R.hit_versions(hits, versions).collect()}
    assert got == {"t": 10, "u": None}


def test_a_rule_of_ones_own(spark):
    """A new rule is an id, its parameters and two expressions."""
    specs = {**R.SPECS, "round_amount": (R.Param("unitMinor", 1, 100000),)}
    mine = _rule("round_amount", {"unitMinor": 5000.0}, weight=41)
    assert R.with_problems(R.rules_frame(spark, [mine]), specs).first()["problems"] == []
    rule = RowRule("round_amount",
                   lambda r: F.col("amount_minor") % r.whole("unitMinor") == 0,
                   lambda r: {"unitMinor": F.lit(r.whole("unitMinor"))})
    rules = {**R.default_rules(), "round_amount": mine}
    rows = [transaction("a", 1, amount_minor=5000), transaction("b", 2, amount_minor=5001, card_id="d")]
    scored = score_transactions(frame(spark, rows), rules, row_rules=(*ROW_RULES, rule))
    assert {r["transaction_id"]: r["score"] for r in scored.select("transaction_id", "score").collect()
            } == {"a": 41, "b": 0}


def test_versions_appear_on_hits(spark):
    rules = R.default_rules()
    rules[MODEL_SCORE] = dataclasses.replace(rules[MODEL_SCORE], version=7, weight=50)
    night = 1_767_234_600_000  # 02:30 UTC
    rows = [transaction("a", night, amount_minor=150000, merchant_category="7995",
                        device_fingerprint=None)]
    hit = score_transactions(frame(spark, rows), rules).selectExpr(
        "hits[0].rule_version AS v", "hits[0].weight AS w").first()
    assert (hit["v"], hit["w"]) == (7, 50)


def test_a_model_of_ones_own(spark):
    """A model is any function that returns a probability column."""
    rows = [transaction("a", 1, amount_minor=10), transaction("b", 2, amount_minor=90)]
    scored = score_transactions(frame(spark, rows), R.default_rules(),
                                model=lambda: F.col("amount_minor") / 100)
    assert {r["transaction_id"]: r["score"] for r in scored.select("transaction_id", "score").collect()
            } == {"a": 0, "b": 35}
