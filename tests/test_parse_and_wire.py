from __future__ import annotations

import json

from pyspark.sql import functions as F

from cardsentry.functions import wire
from cardsentry.operators.alerts import flat_alerts
from cardsentry.operators.rules import (
    default_rules, load_rules, parse_rule_configs, rules_frame, valid_configs)
from cardsentry.operators.verdict import score_transactions
from cardsentry.schema import event_time
from cardsentry.sources.parse import (
    accepted, dead_letter_json, dead_letters, parse_lines, unique_transactions)
from cardsentry.sources.raw import batch_lines
from tests.helpers import frame, transaction

GOOD = ('{"transactionId":"txn-1","cardId":"card-42","amountMinor":12345,"currency":"USD",'
        '"merchantId":"merch-9","merchantCategory":"5411","countryCode":"US",'
        '"deviceFingerprint":"dev-abc","eventTime":1767225600123%s}')


def _lines(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "value string").select(
        F.col("value").cast("binary").alias("value"))


def test_round_trip(spark):
    parsed = accepted(parse_lines(_lines(spark, [GOOD % ""])))
    assert parsed.first().asDict() == {
        "transaction_id": "txn-1", "card_id": "card-42", "amount_minor": 12345, "currency": "USD",
        "merchant_id": "merch-9", "merchant_category": "5411", "country_code": "US",
        "device_fingerprint": "dev-abc", "event_ms": 1767225600123}
    assert parsed.select(wire.transaction_json()).first()[0] == GOOD % ""


def test_nulls_are_left_out_and_unknown_fields_ignored(spark):
    line = GOOD.replace('"deviceFingerprint":"dev-abc",', "") % ',"futureField":{"a":[1]}'
    parsed = accepted(parse_lines(_lines(spark, [line])))
    assert parsed.first()["device_fingerprint"] is None
    assert "deviceFingerprint" not in parsed.select(wire.transaction_json()).first()[0]


def test_refused_lines_and_their_reasons(spark):
    junk = "x" * 5000
    cases = {
        "{not json": "malformed", "": "malformed", "null": "malformed", "[]": "malformed",
        junk: "malformed", '{"transactionId":"t"}': "missing cardId",
        (GOOD % "").replace("12345", "-1"): "negative amountMinor",
        (GOOD % "").replace("12345", "12.7"): "malformed",
        (GOOD % "").replace('"amountMinor":12345,', ""): "missing amountMinor",
        (GOOD % "").replace("1767225600123", "null"): "missing eventTime",
        (GOOD % "").replace('"card-42"', "null"): "missing cardId",
    }
    parsed = parse_lines(_lines(spark, [*cases, GOOD % ""]))
    letters = dead_letters(parsed).collect()
    assert sorted((r["payload"], r["reason"]) for r in letters) == sorted(
        (("x" * 1024 + "...") if p == junk else p, reason) for p, reason in cases.items())
    assert {r["error"] for r in letters} == {"Failed to parse Transaction"}
    # parsed + rejected = input
    assert accepted(parsed).count() + len(letters) == len(cases) + 1
    record = json.loads(dead_letters(parsed).select(dead_letter_json()).first()[0])
    assert set(record) == {"error", "payload"}


def test_payload_of_exactly_the_limit_is_not_cut(spark):
    payloads = {r["payload"] for r in dead_letters(
        parse_lines(_lines(spark, ["y" * 1024, "z" * 1025]))).collect()}
    assert payloads == {"y" * 1024, "z" * 1024 + "..."}


def test_null_value_is_a_dead_letter_with_empty_payload(spark):
    lines = spark.createDataFrame([(None,)], "value binary")
    assert dead_letters(parse_lines(lines)).first()["payload"] == ""


def test_lines_from_files(spark, tmp_path):
    (tmp_path / "a.txt").write_text((GOOD % "") + "\n\n{bad\n")
    parsed = parse_lines(batch_lines(spark, str(tmp_path)))
    assert accepted(parsed).count() == 1 and dead_letters(parsed).count() == 2


def test_unique_transactions_keeps_the_latest(spark):
    rows = [transaction("a", 10, amount_minor=1), transaction("a", 20, amount_minor=2),
            transaction("b", 5)] + [transaction("c", 7)] * 50
    kept = {r["transaction_id"]: (r["event_ms"], r["amount_minor"])
            for r in unique_transactions(frame(spark, rows)).collect()}
    assert kept == {"a": (20, 2), "b": (5, 1000), "c": (7, 1000)}


def test_scored_and_alert_wire_forms(spark):
    rows = [transaction("t0", 1_700_000_000_000, country_code="US"),
            transaction("t1", 1_700_000_060_000, country_code="JP", device_fingerprint=None)]
    scored = score_transactions(frame(spark, rows), default_rules()).withColumn(
        "scored_at", F.timestamp_millis(F.lit(1_700_000_061_000)))
    line = json.loads(scored.filter("transaction_id = 't1'").select(wire.scored_json()).first()[0])
    assert line["score"] == 40 and line["scoredAt"] == 1_700_000_061_000
    assert line["transaction"]["eventTime"] == 1_700_000_060_000
    hit, = line["hits"]
    assert (hit["ruleId"], hit["weight"], hit["ruleVersion"]) == ("geo_impossible", 40, 1)
    assert hit["evidence"]["gapSeconds"] == 60 and hit["evidence"]["fromCountry"] == "US"
    alert = json.loads(flat_alerts(scored).select(wire.alert_json()).first()[0])
    assert alert["ruleIds"] == ["geo_impossible"] and alert["transactionId"] == "t1"
    assert alert["eventTime"] == 1_700_000_060_000 and "deviceFingerprint" not in alert


def test_rule_configs_travel_as_json(spark):
    lines = rules_frame(spark, default_rules().values()).select(wire.rule_config_json().alias("value"))
    back = parse_rule_configs(lines)
    assert valid_configs(back).count() == 5
    rules = load_rules(back)
    assert rules["geo_impossible"].whole("maxGapSeconds") == 21600
    assert rules["geo_impossible"].number("maxKmPerHour") == 900.0
    broken = parse_rule_configs(spark.createDataFrame([("{oops",)], "value string"))
    assert valid_configs(broken).count() == 0


def test_times_no_operator_can_hold_are_refused(spark):
    times = [10 ** 17, -(10 ** 17), 9_223_372_036_854_775_807, 253_402_300_799_999]
    lines = [GOOD.replace("1767225600123", str(t)) % "" for t in times]
    parsed = parse_lines(_lines(spark, lines))
    assert [r["reason"] for r in parsed.select("reason").collect()] == [
        "eventTime out of range"] * 3 + [None]
    assert accepted(parsed).select(event_time()).count() == 1
