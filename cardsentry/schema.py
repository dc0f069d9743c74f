"""Column names and types shared by the batch and the streaming side.

Money is an integer count of minor units, scores are integers, times are epoch
milliseconds in UTC (``event_ms``); ``event_time`` is derived where a timestamp
is wanted.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

# Rule ids are stored data.
VELOCITY = "velocity"
AMOUNT_ANOMALY = "amount_anomaly"
GEO_IMPOSSIBLE = "geo_impossible"
CARD_TESTING = "card_testing"
MODEL_SCORE = "model_score"
RULE_IDS = (VELOCITY, AMOUNT_ANOMALY, GEO_IMPOSSIBLE, CARD_TESTING, MODEL_SCORE)

# Fixed value: score at which a transaction becomes an alert.
ALERT_THRESHOLD = 40

TRANSACTION = T.StructType([
    T.StructField("transaction_id", T.StringType(), False),
    T.StructField("card_id", T.StringType(), False),
    T.StructField("amount_minor", T.LongType(), False),
    T.StructField("currency", T.StringType(), False),
    T.StructField("merchant_id", T.StringType(), False),
    T.StructField("merchant_category", T.StringType(), True),
    T.StructField("country_code", T.StringType(), False),
    T.StructField("device_fingerprint", T.StringType(), True),
    T.StructField("event_ms", T.LongType(), False),
])
TRANSACTION_COLUMNS = TRANSACTION.fieldNames()

# Column name -> wire name, in wire order.
TRANSACTION_WIRE = {
    "transaction_id": "transactionId",
    "card_id": "cardId",
    "amount_minor": "amountMinor",
    "currency": "currency",
    "merchant_id": "merchantId",
    "merchant_category": "merchantCategory",
    "country_code": "countryCode",
    "device_fingerprint": "deviceFingerprint",
    "event_ms": "eventTime",
}

RULE_CONFIG = T.StructType([
    T.StructField("rule_id", T.StringType(), False),
    T.StructField("version", T.LongType(), False),
    T.StructField("enabled", T.BooleanType(), False),
    T.StructField("weight", T.IntegerType(), False),
    T.StructField("params", T.MapType(T.StringType(), T.DoubleType()), False),
    T.StructField("updated_by", T.StringType(), True),
    T.StructField("updated_ms", T.LongType(), True),
])

# Evidence has another shape for each rule, hence a variant.
HIT = T.StructType([
    T.StructField("rule_id", T.StringType(), False),
    T.StructField("weight", T.IntegerType(), False),
    T.StructField("rule_version", T.LongType(), False),
    T.StructField("evidence", T.VariantType(), False),
])

# Allowed labels and allowed origins of a rule version.
LABELS = ("fraud", "legit", "unknown")
RULE_SOURCES = ("api", "airflow", "script")


def event_time(ms: Column | str = "event_ms") -> Column:
    return F.timestamp_millis(F.col(ms) if isinstance(ms, str) else ms)


def event_time_millis(ts: Column | str = "event_time") -> Column:
    return F.unix_millis(F.col(ts) if isinstance(ts, str) else ts)


def event_date(ms: Column | str = "event_ms") -> Column:
    """The UTC day of an event."""
    at = F.col(ms) if isinstance(ms, str) else ms
    return F.date_from_unix_date(F.floor(at / F.lit(86_400_000)).cast("int"))
