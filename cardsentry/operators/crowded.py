"""Facts of cards that have too many rows for one task, by prefix sums of two levels.

No window here holds a card, or even the look-back of a card. Rows are first summed per
card and millisecond (combined before the shuffle). These *moments* are scanned inside
stretches of time as long as the look-back, and each stretch starts from one row that holds the
sums of all stretches before: the scan of the stretches themselves. So every moment knows how
many rows, amounts, small payments and large payments came before it, and how many are older
than the velocity window. One carry row per moment takes that to the rows, which are windowed per
millisecond only, and a row's place among all rows of its card follows.

Small payments are numbered through a card; a run of n is found in buckets of numbers that
repeat the last n - 1 of the bucket before. Runs meet the large payment that ends their group in
an equi join, after those too old for it have been left out.

The unit that stays in one task is a millisecond of a card, a look-back of its moments (one row
per millisecond at most), and the runs that one large payment ends, which are its result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

# Kinds of rows in a window, as in ``facts``.
MEMORY, OWN = 0, 2
TOTAL = "decimal(38,0)"
# Sorts before every event time, with room for the frame arithmetic.
BEGINNING = -(1 << 60)
# Small payments of a card that are searched for runs in one task.
RUN_BUCKET = 1 << 16

_SUMS = ("n", "own_n", "own_amount", "probes", "probe_amount", "larges")
_PLACE = "struct<event_ms:bigint,transaction_id:string,country_code:string>"


def _moments(rows: DataFrame, own_facts: list[str]) -> DataFrame:
    """One row per card and millisecond."""
    own = f"_kind = {OWN}"
    amount = F.col("amount_minor").cast(TOTAL)
    return rows.groupBy("card_id", "event_ms").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.expr(f"if({own}, _n, 0)")).alias("own_n"),
        F.sum(F.expr(f"if({own}, _amount, 0)")).cast(TOTAL).alias("own_amount"),
        F.count_if("_probe").alias("probes"),
        F.coalesce(F.sum(F.when(F.col("_probe"), amount)), F.lit(0)).cast(TOTAL).alias("probe_amount"),
        F.count_if("_large").alias("larges"),
        *(F.sum(f"_v_{f}").alias(f"f_{f}") for f in own_facts),
        F.max(F.struct("event_ms", "transaction_id", "country_code")).alias("last"))


def _in_sessions(moments: DataFrame, memory: DataFrame, forget_ms: int) -> DataFrame:
    """Moments with ``_session``: the time at which the card came back after staying away for
    longer than ``forget_ms``, or BEGINNING.

    Moments of one bucket of that length are never so far apart, so gaps are looked for between
    buckets only.
    """
    bucket = F.floor(F.col("event_ms") / F.lit(forget_ms)).cast("bigint")
    pieces = moments.groupBy("card_id", bucket.alias("_bucket")).agg(
        F.min("event_ms").alias("lo"), F.max("event_ms").alias("hi"))
    known = memory.select("card_id", F.lit(None).cast("bigint").alias("_bucket"),
                          F.lit(BEGINNING).cast("bigint").alias("lo"), F.col("event_ms").alias("hi"))
    line = W.partitionBy("card_id").orderBy("lo")
    before = F.max("hi").over(line.rowsBetween(W.unboundedPreceding, -1))
    back = F.when(F.col("lo") - before > forget_ms, F.col("lo"))
    sessions = (pieces.unionByName(known).withColumn("_back", back)
                .select("card_id", "_bucket", F.coalesce(
                    F.max("_back").over(line.rowsBetween(W.unboundedPreceding, 0)),
                    F.lit(BEGINNING)).alias("_session"))
                .filter(F.col("_bucket").isNotNull()))
    return moments.withColumn("_bucket", bucket).join(sessions, ["card_id", "_bucket"]).drop("_bucket")


def _scanned(moments: DataFrame, memory: DataFrame, look_back: int, velocity_ms: int,
             own: list[tuple[str, int]]) -> DataFrame:
    """Moments with the sums of all before them, the rows older than the velocity window, and
    the last place before."""
    sums_of = (*_SUMS, *(f"f_{name}" for name, _ in own))
    stretch = F.floor(F.col("event_ms") / F.lit(look_back)).cast("bigint")
    placed = moments.withColumn("_stretch", stretch)
    known = memory.select(
        "card_id", F.lit(BEGINNING).cast("bigint").alias("_session"),
        F.lit(BEGINNING).cast("bigint").alias("_stretch"), F.col("_n").alias("own_n"),
        F.col("_amount").alias("own_amount"),
        F.struct("event_ms", F.lit("").alias("transaction_id"), "country_code").alias("last"))
    sums = placed.groupBy("card_id", "_session", "_stretch").agg(
        *(F.sum(c).alias(c) for c in sums_of), F.max("last").alias("last"))
    earlier = W.partitionBy("card_id", "_session").orderBy("_stretch").rangeBetween(
        W.unboundedPreceding, -2)
    start = sums.unionByName(known, allowMissingColumns=True).select(
        "card_id", "_session", "_stretch", F.lit(BEGINNING).cast("bigint").alias("event_ms"),
        *(F.sum(c).over(earlier).alias(c) for c in sums_of), F.max("last").over(earlier).alias("last"),
        F.lit(False).alias("_is_own"))
    # A moment also stands in the stretch after its own, whose windows reach back to it.
    copies = placed.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("_next"))
    copies = copies.withColumn("_stretch", F.col("_stretch") + F.col("_next")) \
        .withColumn("_is_own", F.col("_next") == 0).drop("_next")
    stretch_line = W.partitionBy("card_id", "_session", "_stretch").orderBy("event_ms")
    past = stretch_line.rowsBetween(W.unboundedPreceding, -1)
    return copies.unionByName(start).select(
        "card_id", "event_ms", "_session", "_is_own",
        *(F.coalesce(F.sum(c).over(past), F.lit(0)).alias(f"_b_{c}") for c in sums_of),
        *(F.coalesce(F.sum(c).over(stretch_line.rangeBetween(W.unboundedPreceding, -window)),
                     F.lit(0)).alias(name) for c, window, name in
          [("n", velocity_ms, "_outside"), *((f"f_{f}", ms, f"_x_{f}") for f, ms in own)]),
        F.max("last").over(past).alias("_place")).filter("_is_own").drop("_is_own")


def _runs(rows: DataFrame, length: int) -> DataFrame:
    """Runs of ``length`` small payments: card, session, group, first_ms, total_minor."""
    probes = rows.filter("_probe").select(
        "card_id", "_session", "_group", "event_ms", "_q", F.col("amount_minor").cast(TOTAL).alias("amount"))
    bucket = F.floor(F.col("_q") / F.lit(RUN_BUCKET)).cast("bigint")
    at_end = F.col("_q") % RUN_BUCKET >= RUN_BUCKET - length + 1
    placed = probes.select("*", F.explode(F.when(at_end, F.array(
        F.struct(bucket.alias("_at"), F.lit(False).alias("_copy")),
        F.struct((bucket + 1).alias("_at"), F.lit(True).alias("_copy")))).otherwise(F.array(
            F.struct(bucket.alias("_at"), F.lit(False).alias("_copy"))))).alias("_p"))
    line = W.partitionBy("card_id", "_session", "_p._at").orderBy("_q")
    return placed.select(
        "card_id", "_session", "_group", "_p._copy",
        F.lag("event_ms", length - 1).over(line).alias("first_ms"),
        F.sum("amount").over(line.rowsBetween(1 - length, 0)).cast("bigint").alias("total_minor")
    ).filter(F.col("first_ms").isNotNull() & ~F.col("_copy")).drop("_copy")


def crowded_facts(marked: DataFrame, columns: list[str], *, look_back: int, velocity_ms: int,
                  testing_ms: int, probe_count: int, forget_ms: int,
                  own: list[tuple[str, int]]) -> DataFrame:
    """``columns`` of the own rows of ``marked`` with their facts, as ``facts.card_facts`` gives
    them. ``marked`` has the marks of its windows: _kind, _n, _amount, _real, _probe, _large."""
    real, memory = marked.filter("_real"), marked.filter(F.col("_kind") == MEMORY)
    moments = _in_sessions(_moments(real, [name for name, _ in own]), memory, forget_ms)
    scanned = _scanned(moments, memory, look_back, velocity_ms, own)
    carried = [c for c in scanned.columns if c not in ("card_id", "event_ms")]
    both = real.withColumn("_carry", F.lit(False)).unionByName(
        scanned.withColumn("_carry", F.lit(True)), allowMissingColumns=True)

    moment = "PARTITION BY card_id, event_ms ORDER BY _carry DESC, transaction_id"
    upto = f"{moment} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    past = f"{moment} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    mine = f"NOT _carry AND _kind = {OWN}"
    place = "if(_carry, _place, named_struct('event_ms', event_ms, 'transaction_id'," \
            " transaction_id, 'country_code', country_code))"
    numbered = both.selectExpr(
        *[c for c in both.columns if c not in carried],
        f"max(_session) OVER ({upto}) AS _session",
        f"max(_b_n) OVER ({upto}) + count_if(NOT _carry) OVER ({upto}) - max(_outside) OVER ({upto})"
        " AS velocity_count",
        f"max(_b_own_n) OVER ({upto}) + coalesce(sum(if({mine}, _n, 0)) OVER ({past}), 0) AS prior_count",
        f"CAST(max(_b_own_amount) OVER ({upto}) + coalesce(sum(if({mine}, _amount, 0)) OVER ({past}), 0)"
        f" AS {TOTAL}) AS prior_total",
        f"max({place}) OVER ({past}) AS _prev",
        f"max(_b_probes) OVER ({upto}) + count_if(_probe) OVER ({upto}) AS _q",
        f"max(_b_larges) OVER ({upto}) + coalesce(count_if(_large) OVER ({past}), 0) AS _group",
        *[f"max(_b_f_{name}) OVER ({upto}) + sum(if(_carry, 0, _v_{name})) OVER ({upto})"
          f" - max(_x_{name}) OVER ({upto}) AS own_{name}" for name, _ in own],
    ).filter("NOT _carry")

    large = numbered.filter("_large").select("card_id", "_session", "_group", F.col("event_ms").alias("_end_ms"))
    ended = (_runs(numbered, probe_count).join(large, ["card_id", "_session", "_group"])
             .filter(F.col("first_ms") > F.col("_end_ms") - testing_ms)
             .groupBy("card_id", "_session", "_group")
             .agg(F.array_sort(F.collect_list(F.struct("first_ms", "total_minor"))).alias("_found")))
    # Rows that are not large have keys of their own, which meet nothing and spread evenly.
    key = F.when(F.col("_large"), F.col("_group")).otherwise(-1 - F.pmod(F.xxhash64("transaction_id"),
                                                                     F.lit(1 << 40)))
    nothing = F.array().cast("array<struct<first_ms:bigint,total_minor:bigint>>")
    return (numbered.filter(F.col("_kind") == OWN).withColumn("_group", key)
            .join(ended, ["card_id", "_session", "_group"], "left")
            .select(*columns, "velocity_count", "prior_count", "prior_total",
                    F.col("_prev.country_code").alias("prev_country"),
                    F.col("_prev.event_ms").alias("prev_ms"),
                    F.coalesce("_found", nothing).alias("probe_runs"),
                    F.when(F.col("_session") > BEGINNING, F.col("_session")).alias("since_ms"),
                    *(f"own_{name}" for name, _ in own)))
