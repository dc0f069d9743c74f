"""From facts to hits, a score and a verdict per transaction.

A rule is a pair of column expressions over transaction and fact columns: when it
fires and the evidence it leaves. Thresholds come in as literals of the rule set,
so the whole verdict is one projection above the fact windows.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from cardsentry.functions.geo import km_per_hour
from cardsentry.functions.numbers import round_to_long, whole_seconds
from cardsentry.functions.risk import Model, logistic_risk
from cardsentry.operators.facts import FACT_COLUMNS, OwnFact, card_facts
from cardsentry.operators.rules import Rule, RuleSet
from cardsentry.schema import (
    AMOUNT_ANOMALY, CARD_TESTING, GEO_IMPOSSIBLE, HIT, MODEL_SCORE, VELOCITY)
from cardsentry.sources.centroids import country_distances

# Columns the verdict derives from the facts, before any threshold.
MEASURE_COLUMNS = ["prior_mean", "gap_ms", "travel_km", "travel_kmh", "risk"]

_NO_HITS = f"array<{HIT.simpleString()}>"


@dataclasses.dataclass(frozen=True)
class RowRule:
    """A rule that gives at most one hit per transaction.

    ``facts`` are what it wants to know of the card beyond the facts that are always there.
    """

    rule_id: str
    fires: Callable[[Rule], Column]
    evidence: Callable[[Rule], dict[str, Column]]
    facts: Callable[[Rule], Sequence[OwnFact]] = lambda rule: ()


def _velocity_fires(rule: Rule) -> Column:
    return F.col("velocity_count") > rule.whole("maxCount")


def _velocity_evidence(rule: Rule) -> dict[str, Column]:
    return {"count": F.col("velocity_count"), "maxCount": F.lit(rule.whole("maxCount")),
            "windowSeconds": F.lit(rule.whole("windowSeconds"))}


def _amount_fires(rule: Rule) -> Column:
    return ((F.col("prior_count") >= rule.whole("minObservations"))
            & (F.col("amount_minor") >= rule.whole("minAmountMinor"))
            & (F.col("amount_minor") > F.col("prior_mean") * rule.number("meanMultiplier")))


def _amount_evidence(rule: Rule) -> dict[str, Column]:
    return {"amountMinor": F.col("amount_minor"),
            "rollingMeanMinor": round_to_long(F.col("prior_mean")),
            "meanMultiplier": F.lit(rule.number("meanMultiplier")),
            "observations": F.col("prior_count")}


def geo_in_scope(rule: Rule) -> Column:
    """Another country than last time, both known, after a gap that can be judged."""
    return ((F.col("prev_country") != F.col("country_code"))
            & F.col("travel_km").isNotNull() & (F.col("gap_ms") > 0)
            & (F.col("gap_ms") <= rule.whole("maxGapSeconds") * 1000))


def _geo_fires(rule: Rule) -> Column:
    return geo_in_scope(rule) & (F.col("travel_kmh") > rule.number("maxKmPerHour"))


def _geo_evidence(rule: Rule) -> dict[str, Column]:
    return {"fromCountry": F.col("prev_country"), "toCountry": F.col("country_code"),
            "distanceKm": round_to_long(F.col("travel_km")),
            "gapSeconds": whole_seconds(F.col("gap_ms")),
            "impliedKmPerHour": round_to_long(F.col("travel_kmh"))}


def _model_fires(rule: Rule) -> Column:
    return F.col("risk") >= rule.number("probThreshold")


def _model_evidence(rule: Rule) -> dict[str, Column]:
    return {"probability": F.col("risk")}


# In the order in which their hits stand in a verdict; card testing follows last.
ROW_RULES: tuple[RowRule, ...] = (
    RowRule(VELOCITY, _velocity_fires, _velocity_evidence),
    RowRule(AMOUNT_ANOMALY, _amount_fires, _amount_evidence),
    RowRule(GEO_IMPOSSIBLE, _geo_fires, _geo_evidence),
    RowRule(MODEL_SCORE, _model_fires, _model_evidence),
)


def with_measures(facts: DataFrame, model: Model = logistic_risk) -> DataFrame:
    """Facts plus prior mean, gap, distance, speed and risk.

    A distance is there only when the country changed. It is looked up among the fixed
    pairs of known countries; for an unknown one it stays null, and the travel rule abstains.
    """
    columns = facts.columns
    pairs = country_distances(facts.sparkSession).select(
        F.col("from_country").alias("prev_country"), F.col("to_country").alias("country_code"),
        F.col("km").alias("_km"))
    moved = F.when(F.col("prev_country") != F.col("country_code"), F.col("_km"))
    located = (facts.join(F.broadcast(pairs), ["prev_country", "country_code"], "left")
               .select(*columns, moved.alias("travel_km")))
    return located.select(
        *columns,
        F.when(F.col("prior_count") > 0,
               F.col("prior_total").cast("double") / F.col("prior_count")).alias("prior_mean"),
        (F.col("event_ms") - F.col("prev_ms")).alias("gap_ms"),
        "travel_km",
        km_per_hour(F.col("travel_km"), F.col("event_ms") - F.col("prev_ms")).alias("travel_kmh"),
        model().alias("risk"))


def _hit(rule: Rule, evidence: dict[str, Column]) -> Column:
    return F.struct(
        F.lit(rule.rule_id).alias("rule_id"), F.lit(rule.weight).alias("weight"),
        F.lit(rule.version).cast("bigint").alias("rule_version"),
        F.to_variant_object(F.struct(*[c.alias(n) for n, c in evidence.items()])).alias("evidence"))


def _testing_hits(rule: Rule) -> Column:
    """One hit per completed run, all on the large transaction."""
    return F.transform("probe_runs", lambda run: _hit(rule, {
        "probeCount": F.lit(rule.whole("probeCount")),
        "probeTotalMinor": run["total_minor"],
        "largeAmountMinor": F.col("amount_minor"),
        "spanSeconds": whole_seconds(F.col("event_ms") - run["first_ms"])}))


def _active(rules: RuleSet, row_rules: Sequence[RowRule]) -> list[tuple[RowRule, Rule]]:
    return [(r, rules[r.rule_id]) for r in row_rules
            if r.rule_id in rules and rules[r.rule_id].enabled]


def own_facts(rules: RuleSet, row_rules: Sequence[RowRule]) -> list[OwnFact]:
    """Facts that the rules bring along; a disabled rule brings them too, as others keep theirs."""
    return [fact for r in row_rules if r.rule_id in rules for fact in r.facts(rules[r.rule_id])]


def with_verdict(measures: DataFrame, rules: RuleSet, *, dedupe_hits: bool = False,
                 row_rules: Sequence[RowRule] = ROW_RULES) -> DataFrame:
    """Adds ``score`` (sum of the weights of all hits) and ``hits``.

    The score does not read the hits, so a filter on it reaches below the building
    of evidence. ``dedupe_hits`` counts card testing once per transaction however
    many runs the large amount completes.
    """
    active = _active(rules, row_rules)
    testing = rules.get(CARD_TESTING)
    runs_on = testing is not None and testing.enabled
    score, parts = F.lit(0), []
    for row_rule, rule in active:
        fired = F.coalesce(row_rule.fires(rule), F.lit(False))
        score = score + F.when(fired, F.lit(rule.weight)).otherwise(F.lit(0))
        parts.append(F.when(fired, F.array(_hit(rule, row_rule.evidence(rule))))
                     .otherwise(F.array().cast(_NO_HITS)))
    if runs_on:
        runs = F.size("probe_runs")
        hits = _testing_hits(testing)
        if dedupe_hits:
            runs, hits = F.least(runs, F.lit(1)), F.slice(hits, 1, 1)
        score = score + runs * testing.weight
        parts.append(hits)
    hits = F.concat(*parts) if parts else F.array().cast(_NO_HITS)
    return measures.select("*", score.cast("int").alias("score"), hits.alias("hits"))


def score_transactions(transactions: DataFrame, rules: RuleSet, *, model: Model = logistic_risk,
                       hot_rows: int | None = None, parts: int | None = None,
                       memory: DataFrame | None = None, dedupe_hits: bool = False,
                       row_rules: Sequence[RowRule] = ROW_RULES) -> DataFrame:
    """One scored row per transaction: its columns, score, hits and scored_at.

    One exchange on the card, whatever the number of rules. Facts and measures are
    left in the result; ``scored_only`` drops them.
    """
    facts = card_facts(transactions, rules, hot_rows=hot_rows, parts=parts, memory=memory,
                       own=own_facts(rules, row_rules))
    verdict = with_verdict(with_measures(facts, model), rules, dedupe_hits=dedupe_hits,
                           row_rules=row_rules)
    if "scored_at" not in verdict.columns:
        verdict = verdict.withColumn("scored_at", F.current_timestamp())
    return verdict


def scored_only(verdict: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Scored rows without their facts, but for those to ``keep``."""
    return verdict.drop(*[c for c in verdict.columns if c not in keep and (
        c in FACT_COLUMNS or c in MEASURE_COLUMNS or c.startswith("own_"))])


def hit_rows(scored: DataFrame) -> DataFrame:
    """One row per hit."""
    return scored.select("transaction_id", "card_id", "event_ms", F.explode("hits").alias("_hit")
                         ).select("transaction_id", "card_id", "event_ms", "_hit.*")


def hits_per_rule(scored: DataFrame) -> DataFrame:
    return (hit_rows(scored).groupBy("rule_id")
            .agg(F.count(F.lit(1)).alias("hits"),
                 F.sum("weight").cast("bigint").alias("points")))
