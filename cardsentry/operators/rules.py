"""Rule configurations: allowed parameters, validation, latest valid version.

Thresholds live in a table with one row per pushed version. Validation and the
choice of the version in force are DataFrame operations over that table; only the
outcome, at most one row per known rule id, is read to the driver, because window
frames need their widths as literals.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cardsentry import schema
from cardsentry.functions.numbers import is_finite, is_whole
from cardsentry.schema import (
    AMOUNT_ANOMALY, CARD_TESTING, GEO_IMPOSSIBLE, MODEL_SCORE, RULE_CONFIG, VELOCITY)


@dataclasses.dataclass(frozen=True)
class Param:
    """An allowed parameter with inclusive bounds."""

    name: str
    low: float
    high: float
    whole: bool = True


@dataclasses.dataclass(frozen=True)
class Rule:
    rule_id: str
    version: int
    enabled: bool
    weight: int
    params: Mapping[str, float]
    updated_by: str | None = None
    updated_ms: int | None = None

    def number(self, name: str) -> float:
        return float(self.params[name])

    def whole(self, name: str) -> int:
        return int(self.params[name])

    def with_params(self, **params: float) -> Rule:
        return dataclasses.replace(self, params={**self.params, **params})

    def supersedes(self, other: Rule | None) -> bool:
        return other is None or (self.rule_id == other.rule_id and self.version > other.version)


RuleSet = Mapping[str, Rule]

# Allowed parameters per rule, and the top weight.
MAX_WEIGHT = 100
SPECS: dict[str, tuple[Param, ...]] = {
    VELOCITY: (
        Param("windowSeconds", 5, 3600),
        Param("maxCount", 2, 1000)),
    AMOUNT_ANOMALY: (
        Param("meanMultiplier", 1.5, 50, whole=False),
        Param("minObservations", 3, 1000),
        Param("minAmountMinor", 0, 100000000),
        Param("stateTtlSeconds", 60, 2592000)),
    GEO_IMPOSSIBLE: (
        Param("maxKmPerHour", 100, 2000, whole=False),
        Param("maxGapSeconds", 60, 86400)),
    CARD_TESTING: (
        Param("probeCount", 2, 50),
        Param("probeMaxAmountMinor", 1, 50000),
        Param("largeAmountMinor", 1000, 100000000),
        Param("windowSeconds", 10, 3600)),
    MODEL_SCORE: (
        Param("probThreshold", 0.5, 0.999, whole=False),),
}

# The rules a fresh installation starts with.
_DEFAULTS = (
    Rule(VELOCITY, 1, True, 30, {"windowSeconds": 60.0, "maxCount": 5.0}, "bootstrap"),
    Rule(AMOUNT_ANOMALY, 1, True, 25,
         {"meanMultiplier": 6.0, "minObservations": 5.0, "minAmountMinor": 5000.0,
          "stateTtlSeconds": 604800.0}, "bootstrap"),
    Rule(GEO_IMPOSSIBLE, 1, True, 40,
         {"maxKmPerHour": 900.0, "maxGapSeconds": 21600.0}, "bootstrap"),
    Rule(CARD_TESTING, 1, True, 45,
         {"probeCount": 3.0, "probeMaxAmountMinor": 500.0, "largeAmountMinor": 50000.0,
          "windowSeconds": 300.0}, "bootstrap"),
    Rule(MODEL_SCORE, 1, True, 35, {"probThreshold": 0.75}, "bootstrap"),
)

# The longest look-back any legal configuration can ask for.
LONGEST_WINDOW_SECONDS = int(max(
    p.high for params in SPECS.values() for p in params if p.name == "windowSeconds"))


def default_rules() -> dict[str, Rule]:
    return {rule.rule_id: rule for rule in _DEFAULTS}


def rules_frame(spark: SparkSession, rules: Iterable[Rule]) -> DataFrame:
    rows = [(r.rule_id, r.version, r.enabled, r.weight, dict(r.params), r.updated_by, r.updated_ms)
            for r in rules]
    return spark.createDataFrame(rows, RULE_CONFIG)


def parse_rule_configs(lines: DataFrame) -> DataFrame:
    """Wire JSON (``value``) to rule-config columns; text that does not parse yields nulls."""
    wire = ("ruleId string, version bigint, enabled boolean, weight int, "
            "params map<string,double>, updatedBy string, updatedAt bigint")
    config = F.from_json(F.col("value").cast("string"), wire)
    return lines.select(config.alias("c")).select(
        F.col("c.ruleId").alias("rule_id"), F.col("c.version").alias("version"),
        F.col("c.enabled").alias("enabled"), F.col("c.weight").alias("weight"),
        F.coalesce("c.params", F.create_map().cast("map<string,double>")).alias("params"),
        F.col("c.updatedBy").alias("updated_by"), F.col("c.updatedAt").alias("updated_ms"))


def bound_text(x: float) -> str:
    """A bound as text: plain below ten million, with an exponent from there on."""
    if abs(x) < 1e7:
        return str(float(x))
    mantissa, exponent = f"{x:e}".split("e")
    return f"{float(mantissa)}E{int(exponent)}"


def _spec_rows(specs: Mapping[str, tuple[Param, ...]]) -> Column:
    """The allowed parameters of the row's rule as an array of structs; null for an unknown rule."""
    def row(p: Param) -> Column:
        return F.struct(F.lit(p.name).alias("name"), F.lit(float(p.low)).alias("low"),
                        F.lit(float(p.high)).alias("high"), F.lit(p.whole).alias("whole"),
                        F.lit(f"{bound_text(p.low)}..{bound_text(p.high)}").alias("span"))

    table = F.create_map(*[c for rule_id, params in specs.items()
                           for c in (F.lit(rule_id), F.array(*[row(p) for p in params]))])
    return table[F.col("rule_id")]


def _value_problem(p: Column) -> Column:
    """What is wrong with one parameter (a spec struct with its value), or null."""
    name, value = p["name"], p["value"]
    got = F.concat(F.lit(", got "), value.cast("string"))
    return (F.when(value.isNull(), F.concat(F.lit("missing param "), name))
            .when(~is_finite(value), F.concat(name, F.lit(" must be finite"), got))
            .when((value < p["low"]) | (value > p["high"]),
                  F.concat(name, F.lit(" must be "), p["span"], got))
            .when(p["whole"] & ~is_whole(value),
                  F.concat(name, F.lit(" must be a whole number"), got)))


def problems(specs: Mapping[str, tuple[Param, ...]] = SPECS) -> Column:
    """Every problem of a rule-config row, in order; an empty array for a valid row.

    The specs are data inside the expression: each row looks up its own rule and walks
    that rule's parameters.
    """
    version, weight, params = F.col("version"), F.col("weight"), F.col("params")

    def shown(c: Column) -> Column:
        return F.coalesce(c.cast("string"), F.lit("null"))

    common = F.array(
        F.when(version.isNull() | (version < 1),
               F.concat(F.lit("version must be >= 1, got "), shown(version))),
        F.when(weight.isNull() | ~weight.between(0, MAX_WEIGHT),
               F.concat(F.lit(f"weight must be 0..{MAX_WEIGHT}, got "), shown(weight))))
    valued = F.transform(_spec_rows(specs), lambda p: F.struct(
        p["name"].alias("name"), p["low"].alias("low"), p["high"].alias("high"),
        p["whole"].alias("whole"), p["span"].alias("span"), params[p["name"]].alias("value")))
    per_param = F.transform(valued, _value_problem)
    allowed = F.array_sort(F.transform(_spec_rows(specs), lambda p: p["name"]))
    unknown = F.transform(
        F.array_sort(F.array_except(F.map_keys(params), allowed)),
        lambda k: F.concat(F.lit("unknown param "), k, F.lit(" (allowed: ["),
                           F.array_join(allowed, ", "), F.lit("])")))
    probe, large = params["probeMaxAmountMinor"], params["largeAmountMinor"]
    comparable = ~F.isnan(probe) & ~F.isnan(large)  # NaN is above all numbers to Spark
    cross = F.array(F.when((F.col("rule_id") == CARD_TESTING) & comparable & (probe >= large), F.concat(
        F.lit("probeMaxAmountMinor ("), probe.cast("string"),
        F.lit(") must be < largeAmountMinor ("), large.cast("string"),
        F.lit(") for a run to end in a large amount"))))
    known = ", ".join(sorted(specs))
    return F.coalesce(F.array_compact(F.concat(common, per_param, unknown, cross)),
                      F.array(F.lit(f"unknown ruleId (known: [{known}])")))


def with_problems(configs: DataFrame, specs: Mapping[str, tuple[Param, ...]] = SPECS) -> DataFrame:
    return configs.withColumn("problems", problems(specs))


def valid_configs(configs: DataFrame, specs: Mapping[str, tuple[Param, ...]] = SPECS) -> DataFrame:
    return with_problems(configs, specs).filter(F.size("problems") == 0).drop("problems")


def latest_valid(configs: DataFrame, specs: Mapping[str, tuple[Param, ...]] = SPECS) -> DataFrame:
    """The version in force per rule: the newest one that is valid.

    An invalid push or a stale version never wins, so the last good configuration
    stays. Of two rows with one version the earlier one counts: a version replaces
    another only when it is strictly newer. ``max_by`` combines before the shuffle,
    so a long history per rule is no hot spot.
    """
    rank = F.struct(F.col("version"), (-F.coalesce("updated_ms", F.lit(0))).alias("first"))
    columns = [c for c in configs.columns if c != "rule_id"]
    return (valid_configs(configs, specs)
            .groupBy("rule_id").agg(F.max_by(F.struct(*columns), rank).alias("_row"))
            .select("rule_id", "_row.*"))


def first_pushes(configs: DataFrame) -> DataFrame:
    """One row per (rule_id, version): the earliest push, as the unique key of the table asks."""
    columns = [c for c in configs.columns if c not in ("rule_id", "version")]
    return (configs.groupBy("rule_id", "version")
            .agg(F.min_by(F.struct(*columns), "updated_ms").alias("_row"))
            .select("rule_id", "version", "_row.*"))


def load_rules(configs: DataFrame | None = None,
               specs: Mapping[str, tuple[Param, ...]] = SPECS) -> dict[str, Rule]:
    """The rule set in force, with the bootstrap rules where the table has nothing valid.

    Collects at most one row per rule id of ``specs``.
    """
    rules = default_rules()
    if configs is not None:
        for r in latest_valid(configs.select(*RULE_CONFIG.fieldNames()), specs).collect():
            rules[r.rule_id] = Rule(r.rule_id, r.version, r.enabled, r.weight, dict(r.params),
                                    r.updated_by, r.updated_ms)
    return rules


class RuleConfigError(ValueError):
    """A configuration that must not be used, with everything that is wrong with it."""

    def __init__(self, rule_id: str, found: list[str]) -> None:
        super().__init__(f"{rule_id}: {'; '.join(found)}")
        self.rule_id, self.problems = rule_id, found


def check_rule(spark: SparkSession, rule: Rule) -> list[str]:
    """The problems of one configuration, for a caller that wants to refuse it."""
    return with_problems(rules_frame(spark, [rule])).first()["problems"]


def require_valid(spark: SparkSession, rule: Rule) -> Rule:
    """The rule unchanged, or an error with every problem."""
    found = check_rule(spark, rule)
    if found:
        raise RuleConfigError(rule.rule_id, found)
    return rule


def hit_versions(hits: DataFrame, versions: DataFrame) -> DataFrame:
    """Each hit with the configuration that produced it, by rule id and version.

    (rule_id, version) is unique on the version side. A version with a third of
    all hits is a skewed sort-merge join partition, which adaptive execution splits.
    """
    config = versions.select("rule_id", F.col("version").alias("rule_version"),
                             "enabled", "params", "updated_by", "updated_ms")
    return hits.join(config, ["rule_id", "rule_version"], "left")
