"""Registered queries: every operator over the whole sample view of the given tables."""

from __future__ import annotations

import dataclasses
import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cardsentry.functions.learned import LinearRisk
from cardsentry.functions.risk import logistic_risk
from cardsentry.functions.wire import transaction_json
from cardsentry.operators import alerts as A, feedback, merge, quality, rollup, rules as R
from cardsentry.operators.asof import rules_in_force
from cardsentry.operators.facts import HOT_ROWS, OwnFact, card_facts, card_parts
from cardsentry.operators.verdict import (
    ROW_RULES, RowRule, hit_rows, hits_per_rule, score_transactions, scored_only, with_measures)
from cardsentry.schema import (
    AMOUNT_ANOMALY, CARD_TESTING, GEO_IMPOSSIBLE, MODEL_SCORE, RULE_IDS, VELOCITY)
from cardsentry.session import new_folder, written
from cardsentry.plans import jobs
from cardsentry.sources.centroids import country_distances
from cardsentry.sources.days import DayTable
from cardsentry.sources.parse import accepted, dead_letters, parse_lines, unique_transactions
from cardsentry.sources.raw import file_lines
from cardsentry.sources.sample import (
    sample_labels, sample_lines, sample_rule_history, sample_transactions)
from cardsentry.streaming.job import dead_letter_stream, score_stream
from cardsentry.streaming.sinks import Tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# A card with more rows than this is cut into slices in the ``_split`` queries; low
# enough that the sample has such cards.
SPLIT_ROWS = 100
TARGET_FPR = 0.02
# 2024-01-16, the middle of the sample.
_HALF_WAY_MS = 1_705_363_200_000
_FAR_MS = 253_402_300_799_999
# 2024-01-11 and 2024-01-21.
_THIRDS_MS = (1_704_931_200_000, 1_705_795_200_000)
DISABLED = (VELOCITY, GEO_IMPOSSIBLE, CARD_TESTING)


def _query(name: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return register


def _scored_at() -> Column:
    """When the sample scores a transaction: 0.2 to 5.2 seconds after the event."""
    return F.timestamp_millis(F.col("event_ms") + 200 + F.col("event_id") * 7919 % 5000)


def _natural_rules() -> dict[str, R.Rule]:
    """Bootstrap rules with a velocity window that suits unsqueezed days."""
    rules = R.default_rules()
    return {**rules, VELOCITY: rules[VELOCITY].with_params(windowSeconds=3600.0, maxCount=2.0)}


def _scored(spark: SparkSession, sf_dir: str, burst: bool = True, **options) -> DataFrame:
    """Scored sample rows with a repeatable scored_at."""
    rows = sample_transactions(spark, sf_dir, burst, keep=("event_id",)).withColumn("scored_at", _scored_at())
    rules = R.default_rules() if burst else _natural_rules()
    return scored_only(score_transactions(rows, rules, parts=card_parts(rows), **options))


def _flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.flat_alerts(_scored(spark, sf_dir))


def _alert_view(alerts: DataFrame) -> DataFrame:
    """Alerts with scalar columns only."""
    return alerts.select(
        "transaction_id", "card_id", "score", F.concat_ws(",", "rule_ids").alias("rule_ids"),
        F.size("hits").alias("n_hits"), "amount_minor", "currency", "merchant_id",
        "merchant_category", "country_code", F.unix_millis("event_time").alias("event_ms"),
        F.unix_millis("scored_at").alias("scored_ms"))


def _evidence(scored: DataFrame, rule_id: str, fields: dict[str, tuple[str, str]]) -> DataFrame:
    def field(path: str, kind: str) -> Column:
        return F.variant_get("evidence", f"$.{path}", kind)

    return hit_rows(scored).filter(F.col("rule_id") == rule_id).select(
        "transaction_id", "card_id", "event_ms", "weight", "rule_version",
        *[field(path, kind).alias(name) for name, (path, kind) in fields.items()])


@_query("parse_valid")
def parse_valid(spark, sf_dir):
    return accepted(parse_lines(sample_lines(spark, sf_dir).select("value")))


@_query("parse_dlq")
def parse_dlq(spark, sf_dir):
    return dead_letters(parse_lines(sample_lines(spark, sf_dir).select("value")))


@_query("parse_counters")
def parse_counters(spark, sf_dir):
    """Accepted lines and refused ones by reason."""
    parsed = parse_lines(sample_lines(spark, sf_dir).select("value"))
    outcome = F.coalesce("reason", F.lit("parsed"))
    return parsed.groupBy(outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("lines"))


@_query("transaction_wire")
def transaction_wire(spark, sf_dir):
    """Every transaction as the JSON line it travels as."""
    return sample_transactions(spark, sf_dir).select("transaction_id", transaction_json().alias("line"))


@_query("dedupe_transactions")
def dedupe_transactions(spark, sf_dir):
    rows = sample_transactions(spark, sf_dir, keep=("event_id",))
    again = rows.filter(F.col("event_id") % 3 == 0)
    older = rows.filter(F.col("event_id") % 4 == 0).withColumn("event_ms", F.col("event_ms") - 1000)
    return unique_transactions(rows.unionByName(again).unionByName(older).drop("event_id"))


def _facts(spark: SparkSession, sf_dir: str, burst: bool, rules: R.RuleSet,
           hot_rows: int | None) -> DataFrame:
    rows = sample_transactions(spark, sf_dir, burst)
    facts = with_measures(card_facts(rows, rules, hot_rows=hot_rows, parts=card_parts(rows)))
    return facts.select(
        "transaction_id", "velocity_count", "prior_count",
        F.col("prior_total").cast("bigint").alias("prior_total"), "prev_country", "gap_ms",
        F.size("probe_runs").alias("n_runs"), F.round("travel_km", 4).alias("travel_km"))


@_query("card_facts")
def all_facts(spark, sf_dir):
    """What every transaction knows of its card."""
    return _facts(spark, sf_dir, True, R.default_rules(), None)


@_query("card_facts_split")
def all_facts_split(spark, sf_dir):
    """The same facts with every busy card cut into slices of time."""
    return _facts(spark, sf_dir, True, R.default_rules(), SPLIT_ROWS)


@_query("card_facts_ttl")
def all_facts_ttl(spark, sf_dir):
    """Facts when a card that stays away for a day is forgotten."""
    rules = R.default_rules()
    rules[AMOUNT_ANOMALY] = rules[AMOUNT_ANOMALY].with_params(stateTtlSeconds=86400.0)
    return _facts(spark, sf_dir, False, rules, SPLIT_ROWS)


@_query("card_facts_hourly")
def all_facts_hourly(spark, sf_dir):
    """Facts with an hour's velocity window over unsqueezed days."""
    return _facts(spark, sf_dir, False, _natural_rules(), HOT_ROWS)


@_query("risk_probability")
def risk_probability(spark, sf_dir):
    return sample_transactions(spark, sf_dir, burst=False).select(
        "transaction_id", F.round(logistic_risk(), 6).alias("risk"))


@_query("rule_velocity")
def rule_velocity(spark, sf_dir):
    return _evidence(_scored(spark, sf_dir), VELOCITY, {
        "n": ("count", "bigint"), "max_count": ("maxCount", "int"),
        "window_seconds": ("windowSeconds", "int")})


@_query("rule_velocity_hourly")
def rule_velocity_hourly(spark, sf_dir):
    return _evidence(_scored(spark, sf_dir, burst=False), VELOCITY, {
        "n": ("count", "bigint"), "max_count": ("maxCount", "int"),
        "window_seconds": ("windowSeconds", "int")})


@_query("rule_amount_anomaly")
def rule_amount_anomaly(spark, sf_dir):
    return _evidence(_scored(spark, sf_dir), AMOUNT_ANOMALY, {
        "amount_minor": ("amountMinor", "bigint"), "mean_minor": ("rollingMeanMinor", "bigint"),
        "multiplier": ("meanMultiplier", "double"), "observations": ("observations", "bigint")})


_GEO = {"from_country": ("fromCountry", "string"), "to_country": ("toCountry", "string"),
        "km": ("distanceKm", "bigint"), "gap_seconds": ("gapSeconds", "bigint"),
        "kmh": ("impliedKmPerHour", "bigint")}


@_query("rule_geo_impossible")
def rule_geo_impossible(spark, sf_dir):
    return _evidence(_scored(spark, sf_dir), GEO_IMPOSSIBLE, _GEO)


@_query("rule_geo_impossible_natural")
def rule_geo_impossible_natural(spark, sf_dir):
    return _evidence(_scored(spark, sf_dir, burst=False), GEO_IMPOSSIBLE, _GEO)


@_query("rule_card_testing")
def rule_card_testing(spark, sf_dir):
    return _evidence(_scored(spark, sf_dir), CARD_TESTING, {
        "probe_count": ("probeCount", "int"), "probe_total": ("probeTotalMinor", "bigint"),
        "large_amount": ("largeAmountMinor", "bigint"), "span_seconds": ("spanSeconds", "bigint")})


@_query("rule_model_score")
def rule_model_score(spark, sf_dir):
    hits = _evidence(_scored(spark, sf_dir, burst=False), MODEL_SCORE,
                     {"probability": ("probability", "double")})
    return hits.withColumn("probability", F.round("probability", 6))


@_query("haversine_pairs")
def haversine_pairs(spark, sf_dir):
    """Distances from the countries of the transactions to all countries known."""
    seen = sample_transactions(spark, sf_dir).groupBy("country_code").agg(
        F.count(F.lit(1)).alias("n"))
    pairs = country_distances(spark).withColumnRenamed("from_country", "country_code")
    return seen.join(F.broadcast(pairs), "country_code").select(
        "country_code", "to_country", "n", F.round("km", 4).alias("km"))


def _verdict_view(scored: DataFrame) -> DataFrame:
    return scored.select(
        "transaction_id", "card_id", "score", F.size("hits").alias("n_hits"),
        F.concat_ws(",", F.array_sort(F.transform("hits", lambda h: h["rule_id"]))).alias("rule_ids"))


@_query("score_merged")
def score_merged(spark, sf_dir):
    return _verdict_view(_scored(spark, sf_dir))


@_query("score_merged_split")
def score_merged_split(spark, sf_dir):
    """The same result with every busy card cut into slices of time."""
    return _verdict_view(_scored(spark, sf_dir, hot_rows=SPLIT_ROWS))


@_query("score_disabled_rules")
def score_disabled_rules(spark, sf_dir):
    """Verdicts while three of the rules are switched off."""
    rules = {k: dataclasses.replace(r, enabled=k not in DISABLED) for k, r in R.default_rules().items()}
    rows = sample_transactions(spark, sf_dir)
    return _verdict_view(scored_only(score_transactions(rows, rules, parts=card_parts(rows))))


SMALL_AMOUNTS = RowRule(
    "small_amounts",
    lambda rule: F.col("own_small") > rule.whole("maxSmall"),
    lambda rule: {"small": F.col("own_small")},
    lambda rule: [OwnFact("small", "amount_minor <= 2000", 1000 * rule.whole("windowSeconds"))])


@_query("score_own_rule")
def score_own_rule(spark, sf_dir):
    """Verdicts with a sixth rule, which counts the small payments of a card in three minutes."""
    rule = R.Rule("small_amounts", 1, True, 41, {"windowSeconds": 180.0, "maxSmall": 1.0})
    rows = sample_transactions(spark, sf_dir)
    return _verdict_view(scored_only(score_transactions(
        rows, {**R.default_rules(), rule.rule_id: rule}, parts=card_parts(rows),
        row_rules=(*ROW_RULES, SMALL_AMOUNTS))))


@_query("score_own_model")
def score_own_model(spark, sf_dir):
    """Verdicts with another linear model in the place of the built-in one."""
    model = LinearRisk(-2.5, {"odd_hour": 1.5, "no_device": 0.75, "log_amount": 0.25})
    rows = sample_transactions(spark, sf_dir, burst=False)
    return _verdict_view(scored_only(score_transactions(
        rows, R.default_rules(), model=model, parts=card_parts(rows))))


@_query("score_deduped_hits")
def score_deduped_hits(spark, sf_dir):
    return _verdict_view(_scored(spark, sf_dir, dedupe_hits=True))


def _outside_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits as another model might send them: several per transaction, some orphaned."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    prefix = F.when(F.col("event_id") % 10 == 9, F.lit("gone-")).otherwise(F.lit("tx-"))
    base = events.filter(F.col("event_id") % 3 == 0).select(
        F.concat(prefix, F.floor(F.col("event_id") / F.lit(6)) * 6).alias("transaction_id"),
        F.when(F.col("event_type") == "click", F.lit("outside_a")).otherwise(F.lit("outside_b"))
        .alias("rule_id"),
        (F.col("event_id") % 4 * 5).cast("int").alias("weight"),
        (F.col("event_id") % 2 + 1).alias("rule_version"))
    return merge.unite_hits(base, base.filter(F.col("weight") == 15))


@_query("score_with_outside_hits")
def score_with_outside_hits(spark, sf_dir):
    merged = merge.merge_scores(_scored(spark, sf_dir), _outside_hits(spark, sf_dir))
    times = F.aggregate("extra_hits", F.lit(0).cast("bigint"), lambda n, h: n + h["times"])
    versions = F.concat_ws(",", F.transform("extra_hits", lambda h: F.concat(
        h["rule_id"], F.lit(":"), h["rule_version"].cast("string"))))
    return merged.select("transaction_id", "score", times.alias("n_extra"), versions.alias("extra"))


@_query("orphan_hits")
def orphan_hits(spark, sf_dir):
    scored = sample_transactions(spark, sf_dir)
    return (merge.orphan_hits(_outside_hits(spark, sf_dir), scored)
            .groupBy("rule_id").agg(F.count(F.lit(1)).alias("orphans")))


@_query("alerts_flat")
def alerts_flat(spark, sf_dir):
    return _alert_view(_flat(spark, sf_dir))


@_query("alerts_by_card")
def alerts_by_card(spark, sf_dir):
    return _alert_view(A.by_card(_flat(spark, sf_dir), "card-1"))


@_query("alerts_by_time")
def alerts_by_time(spark, sf_dir):
    return _alert_view(A.by_time(_flat(spark, sf_dir), "2024-01-05 00:00:00Z", "2024-01-12 00:00:00Z"))


@_query("alerts_by_rule")
def alerts_by_rule(spark, sf_dir):
    return _alert_view(A.by_rule(_flat(spark, sf_dir), AMOUNT_ANOMALY))


@_query("alerts_page")
def alerts_page(spark, sf_dir):
    """Fifty alerts, newest first, from a given row on."""
    return _alert_view(A.page(_flat(spark, sf_dir), 50, ("2024-01-20 00:05:00Z", "")))


@_query("alerts_upsert")
def alerts_upsert(spark, sf_dir):
    """Alerts after a replay with other weights wrote part of them again."""
    hour = F.expr("INTERVAL 1 HOUR")
    stored = _flat(spark, sf_dir).withColumn("inserted_at", F.col("scored_at"))
    replay = (_flat(spark, sf_dir).filter(F.col("amount_minor") % 2 == 0)
              .withColumn("score", F.col("score") + 1)
              .withColumn("scored_at", F.col("scored_at") + hour)
              .withColumn("inserted_at", F.col("scored_at")))
    return A.upsert_alerts(stored, replay).select(
        "transaction_id", "score", F.size("hits").alias("n_hits"),
        F.unix_millis("scored_at").alias("scored_ms"),
        F.unix_millis("inserted_at").alias("inserted_ms"))


@_query("alerts_rescored")
def alerts_rescored(spark, sf_dir):
    """The alert table by day after its second half was scored again with a heavier rule."""
    def scored(rules, hours: int) -> DataFrame:
        rows = sample_transactions(spark, sf_dir, keep=("event_id",)).withColumn(
            "scored_at", _scored_at() + F.expr(f"INTERVAL {hours} HOURS"))
        return scored_only(score_transactions(rows, rules, parts=card_parts(rows)))

    table = DayTable(spark, new_folder(spark, "alerts"))
    jobs.replace_alerts(table, scored(R.default_rules(), 0), F.col("scored_at"))
    heavier = R.default_rules()
    heavier[VELOCITY] = dataclasses.replace(heavier[VELOCITY], version=2, weight=41)
    jobs.replace_alerts(table, scored(heavier, 1).filter(F.col("event_ms") >= _HALF_WAY_MS),
                        F.col("scored_at"))
    return table.read().select(
        "transaction_id", "score", F.concat_ws(",", "rule_ids").alias("rule_ids"),
        F.unix_millis("scored_at").alias("scored_ms"), F.unix_millis("inserted_at").alias("inserted_ms"))


@_query("hits_per_rule")
def rule_hits(spark, sf_dir):
    return hits_per_rule(_scored(spark, sf_dir))


@_query("rule_config_problems")
def rule_config_problems(spark, sf_dir):
    found = R.with_problems(sample_rule_history(spark, sf_dir))
    brief = F.transform("problems", lambda p: F.regexp_replace(p, ", got .*$", ""))
    return found.select("event_id", "rule_id", F.size("problems").alias("n_problems"),
                        F.concat_ws("; ", brief).alias("problems"))


@_query("rule_latest_valid")
def rule_latest_valid(spark, sf_dir):
    return R.latest_valid(sample_rule_history(spark, sf_dir)).select(
        "rule_id", "version", "enabled", "weight", "updated_by", "updated_ms")


def _staged_in_force(spark: SparkSession, hits: DataFrame, versions: DataFrame) -> DataFrame:
    """The join reads both sides more than once, so they are written first, as tables would be."""
    pushes = versions.select("rule_id", "version", "updated_ms")
    return rules_in_force(written(hits, new_folder(spark, "hits")),
                          written(pushes, new_folder(spark, "pushes")))


@_query("rule_asof")
def rule_asof(spark, sf_dir):
    """Versions in force at each hit; some pushes have no time, some one at the end of year 9999."""
    hits = hit_rows(_scored(spark, sf_dir)).select("transaction_id", "rule_id", "event_ms", "weight")
    pushed = F.when(F.col("event_id") % 97 == 5, None).when(F.col("event_id") % 89 == 3, _FAR_MS)
    odd = sample_rule_history(spark, sf_dir).withColumn("updated_ms", F.when(
        F.col("event_id") % 97 != 5, F.coalesce(pushed, "updated_ms")))
    return _staged_in_force(spark, hits, R.valid_configs(odd))


@_query("hit_rule_version")
def hit_rule_version(spark, sf_dir):
    """Each hit with the configuration it would have come from at its time."""
    versions = R.first_pushes(R.valid_configs(sample_rule_history(spark, sf_dir)))
    hits = hit_rows(_scored(spark, sf_dir)).select("transaction_id", "rule_id", "event_ms")
    stamped = _staged_in_force(spark, hits, versions).withColumnRenamed("version_in_force", "rule_version")
    return R.hit_versions(stamped, versions).select(
        "transaction_id", "rule_id", "rule_version", "enabled", "updated_by",
        F.map_values("params")[0].alias("first_param"))


@_query("daily_card_agg")
def daily_card_agg(spark, sf_dir):
    return rollup.daily_card_agg(_scored(spark, sf_dir))


@_query("label_fpr")
def label_fpr(spark, sf_dir):
    return feedback.false_positive_rates(
        _scored(spark, sf_dir), sample_labels(spark, sf_dir)).withColumn("fpr", F.round("fpr", 6))


@_query("candidate_fpr")
def candidate_fpr(spark, sf_dir):
    return feedback.candidate_rates(
        sample_transactions(spark, sf_dir), sample_labels(spark, sf_dir), R.default_rules()
    ).withColumn("fpr", F.round("fpr", 6))


@_query("rule_retune")
def rule_retune(spark, sf_dir):
    fresh = feedback.retune(
        sample_transactions(spark, sf_dir), sample_labels(spark, sf_dir), R.default_rules(),
        TARGET_FPR, updated_ms=1706745600000)
    return fresh.select("rule_id", "version", "enabled", "weight", "chosen",
                        F.round("fpr", 6).alias("fpr"), "updated_by", "source")


@_query("latency_percentiles")
def latency_percentiles(spark, sf_dir):
    rows = sample_transactions(spark, sf_dir, keep=("event_id",)).withColumn("scored_at", _scored_at())
    return rollup.delay_percentiles(rows)


@_query("quality_checks")
def quality_checks(spark, sf_dir):
    """Checks over scored rows, labels and rollup of which some were damaged on purpose."""
    scored, n = _scored(spark, sf_dir), F.col("event_id")
    damaged = scored.select(
        *[c for c in scored.columns if c not in ("currency", "country_code", "score")],
        F.when(n % 50 != 7, F.col("currency")).alias("currency"),
        F.when(n % 40 == 9, F.lit("NLD")).otherwise(F.col("country_code")).alias("country_code"),
        F.when(n % 30 == 4, F.col("score") + 1).otherwise(F.col("score")).alias("score"))
    twice = damaged.unionByName(damaged.filter(n % 25 == 1))
    labels = sample_labels(spark, sf_dir)
    labels = labels.withColumn("label", F.when(
        F.col("transaction_id").endswith("77"), F.lit("maybe")).otherwise(F.col("label")))
    return (quality.scored_checks(twice)
            .unionByName(quality.label_checks(labels))
            .unionByName(quality.rollup_checks(rollup.daily_card_agg(scored))))


def _work_folder(spark: SparkSession) -> str:
    return new_folder(spark, "stream")


def _stream_parts(spark: SparkSession, root: str, parts: list[DataFrame], start) -> None:
    """Streams parts of the lines, one micro-batch each.

    A part arrives after the query has stopped, so it starts from its checkpoint.
    """
    for number, lines in enumerate(parts):
        lines.select("value").write.text(f"{root}/lines/part={number}")
        start(file_lines(spark, f"{root}/lines/part=*", max_files=1 << 20), root).awaitTermination()


def _halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The whole sample in two parts, earlier days first."""
    lines = sample_lines(spark, sf_dir, keep=("event_ms",))
    earlier = F.col("event_ms") < _HALF_WAY_MS
    return lines.filter(earlier), lines.filter(~earlier)


def _with_replays(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The second part brings every other line of the first one again, up to two weeks old."""
    first, second = _halves(spark, sf_dir)
    return [first, second.unionByName(first.filter(F.col("event_id") % 2 == 0))]


@_query("stream_scored")
def stream_scored(spark, sf_dir):
    """Verdicts of the stream, which must equal those of the batch on the same lines."""
    root = _work_folder(spark)
    _stream_parts(spark, root, list(_halves(spark, sf_dir)), score_stream)
    return _verdict_view(Tables(root).read(spark, "scored"))


@_query("stream_alerts")
def stream_alerts(spark, sf_dir):
    """The alert table of the stream."""
    root = _work_folder(spark)
    _stream_parts(spark, root, list(_halves(spark, sf_dir)), score_stream)
    return Tables(root).alerts(spark).select(
        "transaction_id", "card_id", "score", F.size("hits").alias("n_hits"),
        F.concat_ws(",", "rule_ids").alias("rule_ids"))


@_query("stream_replayed")
def stream_replayed(spark, sf_dir):
    """Verdicts of the stream when half of the first part comes again days later."""
    root = _work_folder(spark)
    _stream_parts(spark, root, _with_replays(spark, sf_dir), score_stream)
    return _verdict_view(Tables(root).read(spark, "scored"))


@_query("stream_counters")
def stream_counters(spark, sf_dir):
    """What the micro-batches of the same stream counted, summed up."""
    root = _work_folder(spark)
    _stream_parts(spark, root, _with_replays(spark, sf_dir), score_stream)
    names = ["parsed", "rejected", "replayed", "scored", "late", "alerts",
             *(f"hits_{r}" for r in RULE_IDS)]
    totals = Tables(root).read(spark, "progress").agg(*(F.sum(n).alias(n) for n in names))
    return totals.unpivot([], names, "counter", "n")


@_query("stream_late_rows")
def stream_late_rows(spark, sf_dir):
    """Which rows count as late when some arrive a third of the sample after their time."""
    lines = sample_lines(spark, sf_dir, keep=("event_ms",))
    third = F.when(F.col("event_ms") < _THIRDS_MS[0], 0).when(F.col("event_ms") < _THIRDS_MS[1], 1).otherwise(2)
    arrives = F.least(F.lit(2), third + F.when(F.col("event_id") % 40 == 7, 1).otherwise(0))
    root = _work_folder(spark)
    _stream_parts(spark, root, [lines.filter(arrives == k) for k in range(3)], score_stream)
    return Tables(root).read(spark, "scored").select(
        "transaction_id", F.col("batch_id").cast("long").alias("batch_id"), "is_late")


@_query("stream_rule_change")
def stream_rule_change(spark, sf_dir):
    """Velocity hits when a stricter version of the rule is pushed between two micro-batches."""
    root, rules = _work_folder(spark), f"{_work_folder(spark)}/rules"
    R.rules_frame(spark, R.default_rules().values()).write.parquet(rules)
    first, second = _halves(spark, sf_dir)
    start = functools.partial(score_stream, rules_path=rules)
    _stream_parts(spark, root, [first], start)
    stricter = R.default_rules()[VELOCITY].with_params(maxCount=2.0)
    R.rules_frame(spark, [dataclasses.replace(stricter, version=2)]).write.mode("append").parquet(rules)
    second.select("value").write.text(f"{root}/lines/part=1")
    start(file_lines(spark, f"{root}/lines/part=*", max_files=1 << 20), root).awaitTermination()
    hits = hit_rows(Tables(root).read(spark, "scored")).filter(F.col("rule_id") == VELOCITY)
    return hits.select("transaction_id", "rule_version",
                       F.variant_get("evidence", "$.count", "bigint").alias("n"))


@_query("stream_dlq")
def stream_dlq(spark, sf_dir):
    root = _work_folder(spark)
    _stream_parts(spark, root, list(_halves(spark, sf_dir)), dead_letter_stream)
    record = F.from_json("value", "error string, payload string")
    return (spark.read.text(f"{root}/dead_letters").select(record.alias("r"))
            .select("r.error", "r.payload"))
