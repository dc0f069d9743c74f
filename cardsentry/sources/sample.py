"""Transactions and their companions, derived from the generic ``events`` table.

The tables at hand hold no card payments, so every query reads this view of the
whole ``events`` table instead. With ``burst`` each day is squeezed into fifteen
minutes and ten users share a card, so that the rate and sequence rules have
something to find; without it times and users stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cardsentry.operators.rules import default_rules
from cardsentry.schema import RULE_IDS, TRANSACTION_WIRE

_CATEGORIES = ["5411", "5812", "5541", "7995", "5999", "5967", "5311", "6051", "4121", "5732"]
_FAR = ["US", "GB", "JP", "XX", "BR"]
_DAY_MS = 86_400_000


def _pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _epoch_ms() -> Column:
    """``ts`` has no zone and is meant as UTC; this holds in any session time zone."""
    return F.expr("CAST(1000 * CAST(CAST(ts - TIMESTAMP_NTZ'1970-01-01 00:00:00' AS INTERVAL SECOND)"
                  " AS DECIMAL(20, 6)) AS BIGINT)")


def _k() -> Column:
    return F.regexp_extract("props", r"(\d+)", 1).cast("bigint")


def sample_transactions(spark: SparkSession, sf_dir: str, burst: bool = True,
                        keep: tuple[str, ...] = ()) -> DataFrame:
    """Transaction columns; ``keep`` adds columns of ``events``, such as event_id."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("k", _k())
    event_id, user_id, k = F.col("event_id"), F.col("user_id"), F.col("k")
    ms = _epoch_ms()
    if burst:
        # Whole numbers throughout, so both sides of a comparison agree to the millisecond.
        day = ms - ms % _DAY_MS
        ms = day + F.floor((ms % _DAY_MS) / F.lit(96))
        card = F.floor(user_id / F.lit(10))
    else:
        card = user_id
    amount = F.round(F.col("value") * 100).cast("bigint") * F.when(
        F.col("event_type") == "purchase", F.lit(20)).otherwise(F.lit(1))
    country = (F.when(k % 10 == 0, _pick(_FAR, event_id % 5))
               .when(k % 10 == 1, F.lit("BE")).otherwise(F.lit("NL")))
    return events.select(
        F.concat(F.lit("tx-"), event_id).alias("transaction_id"),
        F.concat(F.lit("card-"), card).alias("card_id"),
        amount.cast("bigint").alias("amount_minor"),
        F.lit("USD").alias("currency"),
        F.concat(F.lit("m-"), event_id % 50).alias("merchant_id"),
        F.when(event_id % 97 != 0, _pick(_CATEGORIES, event_id % 10)).alias("merchant_category"),
        country.alias("country_code"),
        F.when(k % 4 != 0, F.concat(F.lit("dev-"), user_id)).alias("device_fingerprint"),
        ms.cast("bigint").alias("event_ms"),
        *keep)


def sample_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(transaction_id, label)."""
    event_id = F.col("event_id")
    label = (F.when(event_id % 7 == 0, F.lit("unknown")).when(event_id % 7 == 1, F.lit("fraud"))
             .otherwise(F.lit("legit")))
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(
        F.concat(F.lit("tx-"), event_id).alias("transaction_id"), label.alias("label"))


def sample_lines(spark: SparkSession, sf_dir: str, burst: bool = True,
                 keep: tuple[str, ...] = ()) -> DataFrame:
    """Wire lines (``value`` and event_id): every transaction, some of them damaged.

    By the last two digits of the event id: 11 is no JSON, 22 lacks all but the id,
    33 has a negative amount, 44 is a long line of junk, 55 is empty, 66 is a JSON
    list, 77 has a fractional amount, 88 has an unknown field (and is fine).
    """
    rows = sample_transactions(spark, sf_dir, burst, keep=("event_id",))
    fields = []
    for name, wire in TRANSACTION_WIRE.items():
        value = F.col(name)
        if name == "amount_minor":
            value = (F.when(F.col("event_id") % 100 == 33, F.concat(F.lit("-1"), value))
                     .when(F.col("event_id") % 100 == 77, F.concat(value, F.lit(".7")))
                     .otherwise(value.cast("string")))
        if name in ("amount_minor", "event_ms"):
            fields.append(F.concat(F.lit(f'"{wire}":'), value))
        else:
            fields.append(F.concat(F.lit(f'"{wire}":"'), value, F.lit('"')))
    body = F.concat(F.lit("{"), F.concat_ws(",", *fields))
    kind = F.col("event_id") % 100
    line = (F.when(kind == 11, F.concat(F.lit("{not json "), F.col("event_id")))
            .when(kind == 22, F.concat(F.lit('{"transactionId":"'), F.col("transaction_id"), F.lit('"}')))
            .when(kind == 44, F.concat(F.col("event_id"), F.repeat(F.lit("x"), 5000)))
            .when(kind == 55, F.lit(""))
            .when(kind == 66, F.lit("[]"))
            .when(kind == 88, F.concat(body, F.lit(',"futureField":1}')))
            .otherwise(F.concat(body, F.lit("}"))))
    return rows.select("event_id", line.alias("value"), *keep)


def sample_rule_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule-config pushes, one per event, of which many are invalid or stale.

    The rule goes by event_id mod 6 (the sixth is unknown), the version by event_id
    div 60, so pushes of one rule repeat versions; every seventh push repeats an old
    one. The first parameter of a rule starts from its bootstrap value and is bent out
    of range, to a fraction, to no number or to another name for some events; the probe
    amount of card testing sometimes reaches the large amount.
    """
    event_id = F.col("event_id")
    rules = default_rules()
    params = F.create_map().cast("map<string,double>")
    for i, rule_id in enumerate(RULE_IDS):
        (name, value), *rest = rules[rule_id].params.items()
        bent = (F.when(event_id % 11 == 3, F.lit(value * 1000000))
                .when(event_id % 11 == 5, F.lit(value + 0.5))
                .when(event_id % 19 == 6, F.lit(float("nan")))
                .otherwise(F.lit(value)))
        entries = [F.lit(name), bent]
        others = []
        for n, v in rest:
            probe = n == "probeMaxAmountMinor"
            others += [F.lit(n), F.when(event_id % 17 == 2, F.lit(50000.0)).otherwise(F.lit(v))
                       if probe else F.lit(v)]
        misspelt = F.create_map(F.lit("bogus"), F.lit(1.0), *others)
        params = (F.when((event_id % 6 == i) & (event_id % 13 == 4), misspelt)
                  .when(event_id % 6 == i, F.create_map(*entries, *others)).otherwise(params))
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(
        _pick([*RULE_IDS, "nonsense"], event_id % 6).alias("rule_id"),
        F.floor(F.when(event_id % 7 == 0, event_id / F.lit(120)).otherwise(event_id / F.lit(60)))
        .alias("version"),
        (event_id % 5 != 0).alias("enabled"),
        (event_id % 110).cast("int").alias("weight"),
        params.alias("params"),
        F.concat(F.lit("user-"), F.col("user_id")).alias("updated_by"),
        _epoch_ms().alias("updated_ms"),
        "event_id")
