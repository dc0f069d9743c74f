from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cardsentry.operators import alerts as A, feedback, merge, quality, rollup
from cardsentry.operators.rules import default_rules
from cardsentry.operators.verdict import hits_per_rule, score_transactions, scored_only
from cardsentry.schema import LABELS, RULE_IDS, VELOCITY
from tests.helpers import frame, transaction

T0 = 1_700_000_000_000
DAY = 86_400_000


@pytest.fixture(scope="module")
def scored(spark):
    """Card a jumps between continents, card b pays small amounts."""
    rows = [transaction(f"a{i}", T0 + i * 600_000, card_id="a", country_code="US" if i % 2 else "JP")
            for i in range(6)]
    rows += [transaction(f"b{i}", T0 + i * DAY, card_id="b", amount_minor=300) for i in range(4)]
    return scored_only(score_transactions(frame(spark, rows), default_rules())).withColumn(
        "scored_at", F.timestamp_millis(F.col("event_ms") + 1000)).cache()


def test_alert_rows_sort_rule_ids(spark):
    hits = F.array(*[F.struct(F.lit(r).alias("rule_id"), F.lit(w).alias("weight"),
                              F.lit(1).cast("bigint").alias("rule_version"),
                              F.parse_json(F.lit("{}")).alias("evidence"))
                     for r, w in (("velocity", 30), ("amount_anomaly", 25))])
    row = (frame(spark, [transaction("t", T0)]).withColumn("score", F.lit(55))
           .withColumn("hits", hits).withColumn("scored_at", F.current_timestamp()))
    alert = A.flat_alerts(row)
    assert alert.columns == A.ALERT_COLUMNS
    assert alert.select("rule_ids").first()[0] == ["amount_anomaly", "velocity"]
    assert alert.selectExpr("hits[0].rule_id").first()[0] == "velocity"


def test_threshold_is_inclusive(scored):
    assert A.alerting(scored, 40).count() == 5
    assert A.alerting(scored, 41).count() == 0


def test_alert_reads(scored):
    alerts = A.flat_alerts(scored)
    assert A.by_card(alerts, "a").count() == 5 and A.by_card(alerts, "b").count() == 0
    assert A.by_rule(alerts, "geo_impossible").count() == 5
    assert A.by_rule(alerts, "velocity").count() == 0
    times = [r["event_time"] for r in alerts.orderBy("event_time").collect()]
    assert A.by_time(alerts, str(times[1]), str(times[3])).count() == 2


def test_pages_cover_all_alerts_once(scored):
    alerts = A.flat_alerts(scored)
    seen, after = [], None
    while True:
        page = A.page(alerts, 2, after).collect()
        if not page:
            break
        seen += [r["transaction_id"] for r in page]
        after = (str(page[-1]["event_time"]), page[-1]["transaction_id"])
    assert seen == ["a5", "a4", "a3", "a2", "a1"]


def test_upsert_is_idempotent_and_keeps_inserted_at(scored):
    first = A.flat_alerts(scored).withColumn("inserted_at", F.timestamp_millis(F.lit(T0)))
    again = (A.flat_alerts(scored).withColumn("scored_at", F.timestamp_millis(F.lit(T0 + DAY)))
             .withColumn("score", F.col("score") + 5)
             .withColumn("inserted_at", F.timestamp_millis(F.lit(T0 + DAY))))
    table = A.upsert_alerts(A.upsert_alerts(first, again), again)
    rows = table.select("score", F.unix_millis("inserted_at").alias("at")).collect()
    assert [tuple(r) for r in rows] == [(45, T0)] * 5


def test_outside_hits_merge_and_orphans(spark, scored):
    hits = spark.createDataFrame(
        [("a1", "x", 10, 1)] * 3 + [("a1", "y", 5, 2), ("b0", "x", 10, 1), ("gone", "x", 10, 1)],
        "transaction_id string, rule_id string, weight int, rule_version bigint")
    merged = {r["transaction_id"]: r for r in merge.merge_scores(scored, hits).select(
        "transaction_id", "score", "extra_hits").collect()}
    assert len(merged) == scored.count()
    assert merged["a1"]["score"] == 40 + 35 and merged["b0"]["score"] == 10
    assert merged["a2"]["score"] == 40 and merged["a2"]["extra_hits"] == []
    assert [(h["rule_id"], h["times"]) for h in merged["a1"]["extra_hits"]] == [("x", 3), ("y", 1)]
    whole = merge.merge_scores(scored, hits)
    assert quality.scored_checks(whole).filter(
        "check = 'scored.score is the sum of weights' AND violations = 0").count() == 1
    alerts = {r["transaction_id"]: r for r in A.flat_alerts(whole).collect()}
    assert alerts["a1"]["score"] == 75
    assert alerts["a1"]["rule_ids"] == ["geo_impossible", "x", "x", "x", "y"]
    orphans = merge.orphan_hits(merge.unite_hits(hits, hits), scored)
    assert [r["transaction_id"] for r in orphans.collect()] == ["gone", "gone"]


def test_hits_per_rule(scored):
    assert [tuple(r) for r in hits_per_rule(scored).collect()] == [("geo_impossible", 5, 200)]


def test_daily_rollup(scored):
    rows = {(str(r["agg_date"]), r["card_id"]): r for r in rollup.daily_card_agg(scored).collect()}
    a = rows[("2023-11-14", "a")]
    assert (a["txn_count"], a["alert_count"], a["total_amount_minor"], a["distinct_merchants"],
            a["distinct_countries"], a["max_score"]) == (6, 5, 6000, 1, 2, 40)
    b = rows[("2023-11-15", "b")]
    assert (b["txn_count"], b["alert_count"], b["max_score"]) == (1, 0, None)
    assert len(rows) == 5


def test_delay_percentiles(spark):
    rows = spark.range(1000).select(F.col("id").alias("event_ms"),
                                    F.timestamp_millis(F.col("id") * 2 + 1).alias("scored_at"))
    r = rollup.delay_percentiles(rows, (0.5, 0.99, 0.999)).first()
    assert (r["rows"], r["p50"], r["p99"], r["p99_9"]) == (1000, 500, 990, 999)


def _labels(spark, pairs):
    return spark.createDataFrame(pairs, "transaction_id string, label string")


def test_false_positive_rate_leaves_unknown_out(spark, scored):
    labels = _labels(spark, [("a0", "legit"), ("a1", "legit"), ("a2", "fraud"), ("a3", "unknown"),
                             ("b0", "legit"), ("b1", "legit")])
    rates = {r["rule_id"]: r for r in feedback.false_positive_rates(scored, labels).collect()}
    geo = rates["geo_impossible"]
    assert (geo["fired"], geo["fired_legit"], geo["legit_rows"], geo["fpr"]) == (2, 1, 4, 0.25)
    assert set(rates) == set(RULE_IDS) and rates[VELOCITY]["fired"] == 0


def test_retune_takes_the_most_sensitive_value_within_target(spark):
    # Card v: eight payments in a minute, all legit, so counts 1..8.
    rows = [transaction(f"v{i}", T0 + i * 1000, card_id="v") for i in range(8)]
    labels = _labels(spark, [(f"v{i}", "legit") for i in range(8)])
    rules = default_rules()

    def chosen(target):
        fresh = feedback.retune(frame(spark, rows), labels, rules, target, updated_ms=T0)
        return {r["rule_id"]: r for r in fresh.collect()}

    # count > c fires on 8 - c rows: c=5 -> 3/8, c=8 -> 0.
    assert chosen(0.4)[VELOCITY]["params"]["maxCount"] == 5.0
    strict = chosen(0.0)
    assert strict[VELOCITY]["params"]["maxCount"] == 8.0
    assert set(strict) == set(RULE_IDS)
    assert {(r["version"], r["source"], r["updated_ms"]) for r in strict.values()} == {
        (2, "airflow", T0)}
    impossible = feedback.retune(frame(spark, rows), labels, rules, -1.0, updated_ms=T0)
    assert impossible.filter("rule_id = 'velocity'").first()["params"]["maxCount"] == 20.0


def test_candidate_large_amounts_change_the_sequence(spark):
    rows = [transaction(f"p{i}", T0 + i * 1000, amount_minor=100) for i in range(3)]
    rows += [transaction("m", T0 + 5000, amount_minor=30000), transaction("l", T0 + 6000, amount_minor=60000)]
    labels = _labels(spark, [("m", "fraud"), ("l", "legit")])
    rates = {r["candidate"]: r["fired_legit"] for r in feedback.candidate_rates(
        frame(spark, rows), labels, default_rules()).filter("rule_id = 'card_testing'").collect()}
    # With 20000 the run ends at m, which is fraud; with 50000 at l.
    assert rates == {20000.0: 0, 50000.0: 1, 100000.0: 0, 200000.0: 0}


def test_quality_checks_pass_and_fail(spark, scored):
    quality.require_clean(quality.scored_checks(scored))
    quality.require_clean(quality.rollup_checks(rollup.daily_card_agg(scored)))
    broken = scored.unionByName(scored.filter("transaction_id = 'a1'"))
    with pytest.raises(quality.QualityError, match="transaction_id unique: 1"):
        quality.require_clean(quality.scored_checks(broken))
    labels = _labels(spark, [("a", x) for x in LABELS[:1]] + [("b", "maybe"), ("c", None)])
    with pytest.raises(quality.QualityError, match="label allowed: 2"):
        quality.require_clean(quality.label_checks(labels))
    versions = spark.createDataFrame([("velocity", 1, "api"), ("velocity", 1, "hand")],
                                     "rule_id string, version bigint, source string")
    with pytest.raises(quality.QualityError, match="key unique: 1; rule_versions.source allowed: 1"):
        quality.require_clean(quality.version_checks(versions))
