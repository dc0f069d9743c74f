"""Window facts against the row-by-row simulator, and the boundaries of each rule."""

from __future__ import annotations

import random
import time

import pytest
from pyspark.sql import functions as F

from cardsentry.operators import crowded
from cardsentry.functions.learned import fit_risk
from cardsentry.operators.facts import OwnFact, card_facts, hot_cards
from cardsentry.operators.rules import default_rules
from cardsentry.operators.verdict import score_transactions
from cardsentry.schema import AMOUNT_ANOMALY, CARD_TESTING, VELOCITY
from tests import simulator
from tests.helpers import as_dicts, collected_facts, frame, transaction

T0 = 1_700_000_000_000


def _random_rows(seed, n=1500, hot_share=0.4, span_ms=4_000_000):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        card = "hot" if rng.random() < hot_share else f"card-{rng.randrange(12)}"
        amount = rng.choice([rng.randrange(0, 501), rng.randrange(501, 50000),
                             rng.randrange(50000, 90000)])
        # Steps of 500 ms, so that equal times are common.
        rows.append(transaction(f"t{i:05d}", T0 + rng.randrange(span_ms // 500) * 500, card_id=card,
                                amount_minor=amount,
                                country_code=rng.choice(["NL", "US", "JP", "XX"])))
    return rows


@pytest.mark.parametrize("hot_rows", [None, 1_000_000, 200, 20, 3])
@pytest.mark.parametrize("seed", [1, 2])
def test_facts_equal_the_simulator_however_cards_are_cut(spark, hot_rows, seed):
    rows = _random_rows(seed)
    got = collected_facts(card_facts(frame(spark, rows), default_rules(), hot_rows=hot_rows))
    assert got == simulator.facts(as_dicts(rows))


@pytest.mark.parametrize("hot_rows", [None, 50])
def test_other_windows_and_run_lengths(spark, hot_rows):
    rules = default_rules()
    rules[VELOCITY] = rules[VELOCITY].with_params(windowSeconds=600)
    rules[CARD_TESTING] = rules[CARD_TESTING].with_params(probeCount=2, windowSeconds=45)
    rows = _random_rows(5)
    got = collected_facts(card_facts(frame(spark, rows), rules, hot_rows=hot_rows))
    assert got == simulator.facts(as_dicts(rows), velocity_s=600, probes=2, testing_s=45)


def test_one_card_holding_a_third_of_the_rows_within_minutes(spark):
    rows = _random_rows(9, hot_share=0.34, span_ms=600_000)
    got = collected_facts(card_facts(frame(spark, rows), default_rules(), hot_rows=30))
    assert got == simulator.facts(as_dicts(rows))


def test_all_rows_of_a_card_at_one_moment(spark):
    rows = [transaction(f"t{i:03d}", T0, amount_minor=100 if i % 4 else 60000) for i in range(80)]
    got = collected_facts(card_facts(frame(spark, rows), default_rules(), hot_rows=10))
    assert got == simulator.facts(as_dicts(rows))


def test_hot_cards_are_found(spark):
    rows = frame(spark, _random_rows(3))
    assert hot_cards(rows, 1_000).count() == 0
    assert [r["card_id"] for r in hot_cards(rows, 300).collect()] == ["hot"]


@pytest.mark.parametrize("hot_rows", [None, 100, 3])
@pytest.mark.parametrize("forget_s", [60, 400])
def test_a_card_that_stays_away_is_forgotten(spark, hot_rows, forget_s):
    rules = default_rules()
    rules[AMOUNT_ANOMALY] = rules[AMOUNT_ANOMALY].with_params(stateTtlSeconds=float(forget_s))
    rules[VELOCITY] = rules[VELOCITY].with_params(windowSeconds=120.0)
    rows = _random_rows(13, n=600, span_ms=40_000_000)
    for i in range(40):  # runs and large payments on both sides of a gap
        start = T0 + i * 1_000_000
        rows += [transaction(f"g{i:02d}{k}", start + at, card_id="gaps", amount_minor=amount) for k, (at, amount)
                 in enumerate([(0, 100), (10, 100), (20, 100), (forget_s * 1000 + 20 + i % 3, 60000),
                               (forget_s * 1000 + 40, 100), (forget_s * 1000 + 40, 100)])]
    got = collected_facts(card_facts(frame(spark, rows), rules, hot_rows=hot_rows))
    assert got == simulator.facts(as_dicts(rows), velocity_s=120, forget_s=forget_s)


def test_runs_across_buckets_of_numbers(spark, monkeypatch):
    monkeypatch.setattr(crowded, "RUN_BUCKET", 7)
    rules = default_rules()
    rules[CARD_TESTING] = rules[CARD_TESTING].with_params(probeCount=5)
    rows = _random_rows(14, n=400, hot_share=0.9, span_ms=900_000)
    got = collected_facts(card_facts(frame(spark, rows), rules, hot_rows=10))
    assert got == simulator.facts(as_dicts(rows), probes=5)


def _scores(spark, rows, **options):
    scored = score_transactions(frame(spark, rows), default_rules(), **options)
    return {r["transaction_id"]: (r["score"], [h["rule_id"] for h in r["hits"]])
            for r in scored.select("transaction_id", "score",
                                   F.transform("hits", lambda h: F.struct(h["rule_id"])).alias("hits")
                                   ).collect()}


def test_velocity_boundaries(spark):
    outside = [transaction(f"a{i}", T0 + d, card_id="a")
               for i, d in enumerate((0, 10_000, 20_000, 30_000, 40_000, 60_000))]
    inside = [transaction(f"b{i}", T0 + d, card_id="b")
              for i, d in enumerate((1, 10_000, 20_000, 30_000, 40_000, 60_000))]
    tied = [transaction(f"d{i}", T0, card_id="d") for i in range(2)]
    rows = outside + inside + tied
    scores = _scores(spark, rows)
    assert scores["a5"] == (0, [])
    assert scores["b5"] == (30, ["velocity"])
    counts = {r["transaction_id"]: r["velocity_count"]
              for r in card_facts(frame(spark, rows), default_rules()).collect()}
    assert counts["a5"] == 5 and counts["b5"] == 6
    assert (counts["d0"], counts["d1"]) == (1, 2)


def test_amount_boundaries(spark):
    day = 86_400_000
    mean = [transaction(f"{c}{i}", T0 + i * day, card_id=c, amount_minor=1000)
            for c in "abe" for i in range(5)]
    few = [transaction(f"f{i}", T0 + i * day, card_id="f", amount_minor=1000) for i in range(4)]
    rows = mean + few + [
        transaction("a-last", T0 + 9 * day, card_id="a", amount_minor=6000),
        transaction("b-last", T0 + 9 * day, card_id="b", amount_minor=6001),
        transaction("e-last", T0 + 9 * day, card_id="e", amount_minor=4999),
        transaction("f-last", T0 + 9 * day, card_id="f", amount_minor=60010)]
    scores = _scores(spark, rows)
    assert scores["a-last"] == (0, [])
    assert scores["b-last"] == (25, ["amount_anomaly"])
    assert scores["e-last"] == (0, [])
    assert scores["f-last"] == (0, [])


def test_geo_boundaries(spark):
    def pair(card, gap, first="US", second="JP"):
        return [transaction(f"{card}0", T0, card_id=card, country_code=first),
                transaction(f"{card}1", T0 + gap, card_id=card, country_code=second)]

    rows = (pair("a", 0) + pair("b", 21_600_000) + pair("d", 21_600_001)
            + pair("e", 1_000, "US", "US") + pair("f", 60_000, "US", "XX"))
    rows += [transaction("g0", T0, card_id="g", country_code="US"),
             transaction("g1", T0 + 60_000, card_id="g", country_code="XX"),
             transaction("g2", T0 + 120_000, card_id="g", country_code="JP")]
    scores = _scores(spark, rows)
    assert scores["a1"] == (0, [])
    assert scores["b1"] == (40, ["geo_impossible"])
    assert scores["d1"] == scores["e1"] == scores["f1"] == (0, [])
    assert scores["g1"] == scores["g2"] == (0, [])


def _sequence(card, text, step=1_000, start=T0):
    amounts = {"p": 100, "L": 60_000, "o": 900}
    return [transaction(f"{card}{i}", start + i * step, card_id=card, amount_minor=amounts[c])
            for i, c in enumerate(text)]


def test_card_testing_sequences(spark):
    rows = (_sequence("a", "pppL") + _sequence("b", "ppppL") + _sequence("d", "pppLL")
            + _sequence("e", "ppLpL") + _sequence("f", "ppL") + _sequence("g", "popopoL"))
    exact = [transaction(f"h{i}", T0 + d, card_id="h", amount_minor=a)
             for i, (d, a) in enumerate(((0, 100), (1, 100), (2, 100), (300_000, 60_000)))]
    inside = [transaction(f"i{i}", T0 + d, card_id="i", amount_minor=a)
              for i, (d, a) in enumerate(((0, 100), (1, 100), (2, 100), (299_999, 60_000)))]
    rows += exact + inside
    runs = {r["transaction_id"]: len(r["probe_runs"])
            for r in card_facts(frame(spark, rows), default_rules()).collect()}
    fired = {t: n for t, n in runs.items() if n}
    assert fired == {"a3": 1, "b4": 2, "d3": 1, "e4": 1, "g6": 1, "i3": 1}
    # The weights of repeated hits add up.
    scores = _scores(spark, _sequence("b", "ppppL", step=70_000))
    assert scores["b4"] == (90, ["card_testing", "card_testing"])
    once = _scores(spark, _sequence("b", "ppppL", step=70_000), dedupe_hits=True)
    assert once["b4"] == (45, ["card_testing"])


def test_disabled_rules_give_no_hits_but_facts_stay(spark):
    import dataclasses
    rules = {k: dataclasses.replace(r, enabled=False) for k, r in default_rules().items()}
    rows = _random_rows(4, n=300)
    scored = score_transactions(frame(spark, rows), rules)
    assert scored.agg(F.max("score"), F.max(F.size("hits"))).first() == (0, 0)
    assert scored.agg(F.max("prior_count")).first()[0] > 0


def test_invariants(spark):
    rows = _random_rows(7)
    scored = score_transactions(frame(spark, rows), default_rules(), hot_rows=40)
    total = F.aggregate("hits", F.lit(0), lambda n, h: n + h["weight"])
    assert scored.filter(F.col("score") != total).count() == 0
    assert scored.select("transaction_id").distinct().count() == len(rows) == scored.count()


def test_broken_clocks_disturb_nothing(spark):
    """Rows at the epoch or far ahead share a card with ordinary ones."""
    rows = _random_rows(11, n=300)
    rows += [transaction(f"z{i}", ms, card_id="hot", amount_minor=a) for i, (ms, a) in enumerate(
        [(0, 100), (1, 100), (2, 100), (3, 60000), (-5, 60000), (9_000_000_000_000, 100),
         (9_000_000_000_001, 60000)])]
    for hot_rows in (None, 20):
        got = collected_facts(card_facts(frame(spark, rows), default_rules(), hot_rows=hot_rows))
        assert got == simulator.facts(as_dicts(rows))


def _busy_card(spark, n, amount, span_ms):
    """One card of n rows inside ``span_ms``."""
    return spark.range(n).select(
        F.format_string("t%08d", "id").alias("transaction_id"), F.lit("busy").alias("card_id"),
        F.lit(amount).cast("bigint").alias("amount_minor"), F.lit("USD").alias("currency"),
        F.lit("m").alias("merchant_id"), F.lit("5411").alias("merchant_category"),
        F.lit("US").alias("country_code"), F.lit("d").alias("device_fingerprint"),
        (F.lit(T0) + F.floor(F.col("id") * span_ms / n)).cast("bigint").alias("event_ms"))


@pytest.mark.parametrize("amount", [100, 1000])
def test_a_busy_card_costs_as_much_as_a_quiet_one(spark, amount):
    """80,000 rows in 15 minutes: all probes, or none of them; no frame grows with the card."""
    def seconds(span_ms):
        start = time.perf_counter()
        card_facts(_busy_card(spark, 80_000, amount, span_ms), default_rules()).write.format(
            "noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds(900_000)
    spread = min(seconds(80_000 * 600_000) for _ in range(2))
    assert min(seconds(900_000) for _ in range(2)) < 3 * spread + 0.5


def test_amounts_near_the_limit_add_up(spark):
    rows = [transaction(f"t{i}", T0 + i * 1000, amount_minor=9 * 10 ** 18) for i in range(4)]
    for hot_rows in (None, 2):
        got = card_facts(frame(spark, rows), default_rules(), hot_rows=hot_rows).orderBy(
            "transaction_id").collect()
        assert [int(r["prior_total"]) for r in got] == [k * 9 * 10 ** 18 for k in range(4)]
        scored = score_transactions(frame(spark, rows), default_rules(), hot_rows=hot_rows)
        assert scored.count() == 4


@pytest.mark.parametrize("hot_rows", [None, 30])
def test_facts_of_rules_of_ones_own(spark, hot_rows):
    rules = default_rules()
    rules[AMOUNT_ANOMALY] = rules[AMOUNT_ANOMALY].with_params(stateTtlSeconds=60.0)
    rows = _random_rows(21, n=500, span_ms=3_000_000)
    own = [OwnFact("small", "amount_minor <= 500", 90_000), OwnFact("spent", "amount_minor", 7_000)]
    got = {r["transaction_id"]: (r["own_small"], r["own_spent"]) for r in card_facts(
        frame(spark, rows), rules, hot_rows=hot_rows, own=own).collect()}
    expected, seen = {}, {}
    for r in sorted(as_dicts(rows), key=lambda r: (r["event_ms"], r["transaction_id"])):
        past = seen.setdefault(r["card_id"], [])
        if past and r["event_ms"] - past[-1]["event_ms"] > 60_000:
            past.clear()
        past.append(r)
        expected[r["transaction_id"]] = (
            sum(p["amount_minor"] <= 500 for p in past if p["event_ms"] > r["event_ms"] - 90_000),
            sum(p["amount_minor"] for p in past if p["event_ms"] > r["event_ms"] - 7_000))
    assert got == expected


def test_a_model_learned_from_labels(spark):
    rng = random.Random(2)
    rows, labels = [], []
    for k in range(800):
        fraud = rng.random() < 0.2
        rows.append(transaction(f"t{k}", T0 + k * 1000, amount_minor=rng.randrange(1, 9000) * (30 if fraud else 1),
                                device_fingerprint=None if rng.random() < (0.9 if fraud else 0.1) else "d"))
        labels.append((f"t{k}", "unknown" if k % 50 == 0 else "fraud" if fraud else "legit"))
    told = spark.createDataFrame(labels, "transaction_id string, label string")
    model = fit_risk(frame(spark, rows), told)
    right = frame(spark, rows).join(told, "transaction_id").filter("label <> 'unknown'").select(
        ((model() > 0.5) == (F.col("label") == "fraud")).alias("ok")).agg(F.avg(F.col("ok").cast("int"))).first()[0]
    assert right > 0.9 and model.weights["no_device"] > 1
    plan = score_transactions(frame(spark, rows), default_rules(), model=model)._jdf.queryExecution(
        ).executedPlan().toString()
    assert "Python" not in plan.replace("PythonRDD", "") and plan.count("Exchange hashpartitioning") == 1
    with pytest.raises(ValueError):
        fit_risk(frame(spark, rows), told.filter("label = 'legit'"))
