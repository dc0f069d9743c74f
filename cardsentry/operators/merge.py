"""Hits that come from elsewhere, such as a second model, joined to scored rows.

The built-in rules need none of this: their hits are made in one place. A hit may
arrive many times for one transaction, so the hits are first reduced per
transaction and configuration. What is collected per transaction afterwards is
bounded by the number of rule versions, not by the number of hits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

_HIT_KEY = ["transaction_id", "rule_id", "weight", "rule_version"]
_EXTRA = ("array<struct<rule_id:string,rule_version:bigint,weight:int,times:bigint,"
          "evidence:variant>>")


def hit_counts(hits: DataFrame) -> DataFrame:
    """(transaction_id, extra_score, extra_hits): the hits of a transaction, counted.

    The evidence of the first of equal hits stands for all of them.
    """
    evidence = F.col("evidence") if "evidence" in hits.columns else F.parse_json(F.lit("{}"))
    counted = hits.withColumn("evidence", evidence).groupBy(*_HIT_KEY).agg(
        F.count(F.lit(1)).alias("times"), F.first("evidence", True).alias("evidence"))
    per_hit = F.struct("rule_id", "rule_version", "weight", "times", "evidence")
    key = lambda h: F.struct(h["rule_id"], h["rule_version"], h["weight"])
    ordered = F.array_sort(F.collect_list(per_hit), lambda a, b: (
        F.when(key(a) < key(b), -1).when(key(a) > key(b), 1).otherwise(0)))
    return counted.groupBy("transaction_id").agg(
        F.sum(F.col("weight") * F.col("times")).cast("bigint").alias("extra_score"),
        ordered.alias("extra_hits"))


def merge_scores(scored: DataFrame, hits: DataFrame) -> DataFrame:
    """Scored rows with all outside hits appended and their weights added; others pass through.

    A hit that came several times stands in ``hits`` as often. ``extra_hits`` says how often
    each rule version fired.
    """
    merged = scored.join(hit_counts(hits), "transaction_id", "left")
    extra = F.coalesce("extra_hits", F.array().cast(_EXTRA))
    copies = F.flatten(F.transform(extra, lambda h: F.array_repeat(
        F.struct(h["rule_id"].alias("rule_id"), h["weight"].alias("weight"),
                 h["rule_version"].alias("rule_version"), h["evidence"].alias("evidence")),
        h["times"].cast("int"))))
    total = F.col("score") + F.coalesce("extra_score", F.lit(0))
    return merged.select(
        *[c for c in scored.columns if c not in ("score", "hits")],
        total.cast("int").alias("score"), F.concat("hits", copies).alias("hits"),
        extra.alias("extra_hits"))


def orphan_hits(hits: DataFrame, scored: DataFrame) -> DataFrame:
    """Hits on a transaction that was never scored; they are dropped, but counted."""
    return hits.join(scored.select("transaction_id"), "transaction_id", "left_anti")


def unite_hits(*streams: DataFrame) -> DataFrame:
    first, *rest = streams
    for other in rest:
        first = first.unionByName(other)
    return first
