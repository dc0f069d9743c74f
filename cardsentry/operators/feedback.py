"""False-positive rates against labelled outcomes, and thresholds that hold them down."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from cardsentry.operators.facts import HOT_ROWS, card_facts, card_parts
from cardsentry.operators.rules import RuleSet, rules_frame, valid_configs
from cardsentry.operators.verdict import geo_in_scope, with_measures
from cardsentry.schema import (
    AMOUNT_ANOMALY, CARD_TESTING, GEO_IMPOSSIBLE, MODEL_SCORE, RULE_IDS, VELOCITY)

# The parameter each rule is tuned by, and the values tried, all within bounds. A
# lower value is the more sensitive one for every rule.
TUNED = {
    VELOCITY: "maxCount",
    AMOUNT_ANOMALY: "meanMultiplier",
    GEO_IMPOSSIBLE: "maxKmPerHour",
    CARD_TESTING: "largeAmountMinor",
    MODEL_SCORE: "probThreshold",
}
GRID: dict[str, tuple[float, ...]] = {
    VELOCITY: (2, 3, 5, 8, 12, 20),
    AMOUNT_ANOMALY: (2, 4, 6, 8, 12, 20),
    GEO_IMPOSSIBLE: (200, 500, 900, 1200, 1600, 2000),
    CARD_TESTING: (20000, 50000, 100000, 200000),
    MODEL_SCORE: (0.5, 0.6, 0.75, 0.78, 0.9, 0.95),
}


def adjudicated(scored: DataFrame, labels: DataFrame) -> DataFrame:
    """Scored rows with their label; rows without one, or labelled unknown, are left out.

    Not limited to alerts: legitimate rows that never alerted are the base of the rate.
    """
    known = labels.filter(F.col("label") != "unknown").select("transaction_id", "label")
    return scored.join(known, "transaction_id", "inner")


def false_positive_rates(scored: DataFrame, labels: DataFrame) -> DataFrame:
    """Per rule: adjudicated rows it fired on, legit ones among them, and the rate.

    A row counts once per rule, however many hits of the rule it has. One pass with
    conditional counts; nothing is exploded.
    """
    # Flags go through the join, not hits with their evidence.
    ids = F.transform("hits", lambda h: h["rule_id"])
    flags = scored.select("transaction_id", ids.alias("_ids")).select(
        "transaction_id", *[F.array_contains("_ids", r).alias(f"_r{i}")
                            for i, r in enumerate(RULE_IDS)])
    judged = adjudicated(flags, labels)
    legit = F.col("label") == "legit"
    aggregates = [F.count(F.when(legit, 1)).alias("legit_rows")]
    for i in range(len(RULE_IDS)):
        fired = F.col(f"_r{i}")
        aggregates += [F.count(F.when(fired, 1)).alias(f"_f{i}"),
                       F.count(F.when(fired & legit, 1)).alias(f"_l{i}")]
    rows = F.array(*[F.struct(F.lit(r).alias("rule_id"), F.col(f"_f{i}").alias("fired"),
                              F.col(f"_l{i}").alias("fired_legit"))
                     for i, r in enumerate(RULE_IDS)])
    return (judged.agg(*aggregates)
            .select("legit_rows", F.explode(rows).alias("_r"))
            .select("_r.*", "legit_rows",
                    F.when(F.col("legit_rows") > 0,
                           F.col("fired_legit") / F.col("legit_rows")).alias("fpr")))


def _fires_at(rules: RuleSet) -> dict[str, Column]:
    """Per rule a number that must exceed (model: reach) the tuned value; null when out of scope."""
    amount = rules[AMOUNT_ANOMALY]
    return {
        VELOCITY: F.col("velocity_count").cast("double"),
        AMOUNT_ANOMALY: F.when((F.col("prior_count") >= amount.whole("minObservations"))
                               & (F.col("amount_minor") >= amount.whole("minAmountMinor")),
                               F.col("amount_minor")).cast("double"),
        GEO_IMPOSSIBLE: F.when(geo_in_scope(rules[GEO_IMPOSSIBLE]), F.col("travel_kmh")),
        MODEL_SCORE: F.col("risk"),
    }


def _fires(rule_id: str, measure: Column, value: float) -> Column:
    if rule_id == AMOUNT_ANOMALY:
        return measure > F.col("prior_mean") * F.lit(float(value))
    if rule_id == MODEL_SCORE:
        return measure >= F.lit(float(value))
    return measure > F.lit(float(value))


def _testing_fires(transactions: DataFrame, rules: RuleSet, values: Sequence[float],
                   hot_rows: int | None, parts: int | None) -> DataFrame:
    """(transaction_id, candidate) card testing fires on, for each large amount tried.

    The value decides which row ends a run, so each value is a sequence of its own: the
    card and the value together take the place of the card, and a row at or above the
    value is lifted to the large amount of the rule. Only probes and large rows take part.
    """
    rule = rules[CARD_TESTING]
    probe = F.col("amount_minor") <= rule.whole("probeMaxAmountMinor")
    tried = F.explode(F.array(*[F.lit(int(v)) for v in values])).alias("candidate")
    lifted = F.when(probe, F.col("amount_minor")).otherwise(
        F.greatest(F.col("amount_minor"), F.lit(rule.whole("largeAmountMinor"))))
    part = (transactions.select("transaction_id", "card_id", "amount_minor", "country_code",
                                "event_ms")
            .filter(probe | (F.col("amount_minor") >= int(min(values))))
            .select("*", tried)
            .filter(probe | (F.col("amount_minor") >= F.col("candidate")))
            .withColumn("amount_minor", lifted)
            .withColumn("card_id", F.concat_ws("#", "card_id", F.col("candidate").cast("string"))))
    # As many sequences as values share the cards' rows.
    return (card_facts(part, rules, hot_rows=hot_rows, parts=parts and parts * len(values))
            .filter(F.size("probe_runs") > 0)
            .select("transaction_id", F.col("candidate").cast("double").alias("candidate")))


def candidate_rates(transactions: DataFrame, labels: DataFrame, rules: RuleSet,
                    grid: Mapping[str, Sequence[float]] = GRID,
                    hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """(rule_id, candidate, fired_legit, legit_rows, fpr) for every value of the grid.

    All values of four rules are conditional counts of one pass; card testing takes a
    second one over its probes and large rows.
    """
    parts = card_parts(transactions)
    measured = with_measures(card_facts(transactions, rules, hot_rows=hot_rows, parts=parts))
    judged = adjudicated(measured, labels).filter(F.col("label") == "legit")
    keys, aggregates = [], [F.count(F.lit(1)).alias("legit_rows")]
    for rule_id, measure in _fires_at(rules).items():
        for value in grid[rule_id]:
            aggregates.append(F.count(F.when(_fires(rule_id, measure, value), 1)).alias(f"_{len(keys)}"))
            keys.append((rule_id, float(value)))
    rows = F.array(*[F.struct(F.lit(r).alias("rule_id"), F.lit(v).alias("candidate"),
                              F.col(f"_{i}").alias("fired_legit")) for i, (r, v) in enumerate(keys)])
    plain = (judged.agg(*aggregates).select("legit_rows", F.explode(rows).alias("_r"))
             .select("_r.*", "legit_rows"))

    # A legal value lies above the probe amount.
    values = [v for v in grid[CARD_TESTING] if v > rules[CARD_TESTING].number("probeMaxAmountMinor")]
    legit = labels.filter(F.col("label") == "legit").select("transaction_id")
    fired = _testing_fires(transactions, rules, values, hot_rows, parts)
    # One conditional count per value: a row also for a value that never fires.
    counted = (fired.join(legit, "transaction_id", "left_semi")
               .agg(*[F.count(F.when(F.col("candidate") == float(v), 1)).alias(f"_{i}")
                      for i, v in enumerate(values)]))
    pairs = F.array(*[F.struct(F.lit(float(v)).alias("candidate"), F.col(f"_{i}").alias("fired_legit"))
                      for i, v in enumerate(values)])
    testing = (counted.select(F.explode(pairs).alias("_r"))
               .select(F.lit(CARD_TESTING).alias("rule_id"), "_r.*",
                       F.lit(None).cast("bigint").alias("legit_rows")))
    # One row per value tried; the number of legit rows is the same for all of them.
    every = W.partitionBy(F.lit(0))
    return (plain.unionByName(testing)
            .withColumn("legit_rows", F.max("legit_rows").over(every))
            .withColumn("fpr", F.when(F.col("legit_rows") > 0,
                                      F.col("fired_legit") / F.col("legit_rows"))))


def choose(rates: DataFrame, target: float) -> DataFrame:
    """Per rule the most sensitive value that holds the target, else the least sensitive one."""
    # Values that hold the target first, from the lowest on; then the others from the highest on.
    held = F.coalesce(F.col("fpr") <= target, F.lit(False))
    rank = F.when(held, F.struct(F.lit(0).alias("g"), F.col("candidate").alias("v"))).otherwise(
        F.struct(F.lit(1).alias("g"), (-F.col("candidate")).alias("v")))
    return (rates.groupBy("rule_id").agg(F.min_by(F.struct("candidate", "fpr"), rank).alias("_c"))
            .select("rule_id", F.col("_c.candidate").alias("chosen"), "_c.fpr"))


def retune(transactions: DataFrame, labels: DataFrame, rules: RuleSet, target: float, *,
           updated_ms: int, updated_by: str = "rule_retune",
           grid: Mapping[str, Sequence[float]] = GRID,
           hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """The next version of every rule, as rows for the rule-version table.

    The rule set has one row per rule id, so the join with it is against a handful of rows.
    """
    spark = transactions.sparkSession
    picked = choose(candidate_rates(transactions, labels, rules, grid, hot_rows), target)
    current = rules_frame(spark, [rules[r] for r in TUNED])
    tuned = F.create_map(*[F.lit(x) for pair in TUNED.items() for x in pair])
    fresh = current.join(F.broadcast(picked), "rule_id").select(
        "rule_id", (F.col("version") + 1).alias("version"), "enabled", "weight",
        F.transform_values("params", lambda k, v: F.when(
            k == tuned[F.col("rule_id")], F.col("chosen")).otherwise(v)).alias("params"),
        F.lit(updated_by).alias("updated_by"),
        F.lit(updated_ms).cast("bigint").alias("updated_ms"),
        F.lit("airflow").alias("source"), "chosen", "fpr")
    return valid_configs(fresh)
