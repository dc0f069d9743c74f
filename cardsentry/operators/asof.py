"""Which rule version was in force at a time.

An as-of join with few keys and many rows on both sides: neither one task per rule nor all
pairs per rule would do. Both sides are first reduced to one row per rule and millisecond, which
combines before the shuffle. Time is cut into slices of an hour; a slice that somebody asks
about starts from one carry row, the best version of all slices before, which comes from a
scan over slices. So a task never holds more than an hour of a rule, a row per millisecond, and
the answers meet the questions in an equi join on rule and time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from cardsentry.operators.crowded import BEGINNING

_SLICE_MS = 3_600_000


def rules_in_force(questions: DataFrame, versions: DataFrame, at: str = "event_ms",
                   slice_ms: int = _SLICE_MS) -> DataFrame:
    """``questions`` (rule_id and a time) with the newest version pushed up to then.

    ``versions`` holds valid configurations only. Adds version_in_force and in_force_since;
    both null before the first push of a rule, and for a question without a time. "Newest" is
    the highest version, not the last push, so a stale push changes nothing. A push without a
    time has been in force all along, since null.
    """
    columns = questions.columns
    best = F.max(F.struct("version", (-F.col("_at")).alias("neg_ms"))).alias("_best")
    pushes = (versions.filter(F.col("rule_id").isNotNull())
              .select("rule_id", "version", F.coalesce("updated_ms", F.lit(BEGINNING)).alias("_at"))
              .groupBy("rule_id", "_at").agg(best))
    asked = (questions.select("rule_id", F.col(at).cast("bigint").alias("_at")).dropna()
             .groupBy("rule_id", "_at").agg(F.lit(True).alias("_asked")))

    at_slice = _slice(slice_ms)
    both = pushes.select("rule_id", at_slice, "_best").unionByName(
        asked.select("rule_id", at_slice), allowMissingColumns=True)
    slices = both.groupBy("rule_id", "_slice").agg(F.max("_best").alias("_best"))
    before = W.partitionBy("rule_id").orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    carry = slices.select("rule_id", "_slice", F.lit(BEGINNING).cast("bigint").alias("_at"),
                          F.max("_best").over(before).alias("_best")).filter("_best IS NOT NULL")

    rows = (pushes.select("rule_id", at_slice, "_at", "_best").unionByName(carry)
            .unionByName(asked.select("rule_id", at_slice, "_at", "_asked"), allowMissingColumns=True))
    until = W.partitionBy("rule_id", "_slice").orderBy("_at").rangeBetween(
        W.unboundedPreceding, W.currentRow)
    answers = rows.withColumn("_best", F.max("_best").over(until)).filter("_asked").select(
        "rule_id", "_at", F.col("_best.version").alias("version_in_force"),
        F.nullif(-F.col("_best.neg_ms"), F.lit(BEGINNING)).alias("in_force_since"))

    # A question without a time gets one that nothing answers, and that keeps such rows apart.
    spread = [c for c, kind in questions.dtypes if "map<" not in kind and "variant" not in kind]
    nowhere = 2 * BEGINNING - F.pmod(F.xxhash64(*spread), F.lit(1 << 20))
    return (questions.withColumn("_at", F.coalesce(F.col(at).cast("bigint"), nowhere))
            .join(answers, ["rule_id", "_at"], "left")
            .select(*columns, "version_in_force", "in_force_since"))


def _slice(slice_ms: int) -> Column:
    return F.floor(F.col("_at") / F.lit(slice_ms)).cast("bigint").alias("_slice")
