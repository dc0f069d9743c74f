from __future__ import annotations

from cardsentry.schema import TRANSACTION


def transaction(transaction_id, event_ms, *, card_id="c", amount_minor=1000, country_code="NL",
                merchant_category="5411", device_fingerprint="dev"):
    return (transaction_id, card_id, amount_minor, "USD", "m-1", merchant_category, country_code,
            device_fingerprint, event_ms)


def frame(spark, rows):
    return spark.createDataFrame(rows, TRANSACTION)


def as_dicts(rows):
    names = TRANSACTION.fieldNames()
    return [dict(zip(names, r)) for r in rows]


def collected_facts(df):
    return {r["transaction_id"]: (
        r["velocity_count"], r["prior_count"], r["prior_total"], r["prev_country"], r["prev_ms"],
        [(p["first_ms"], p["total_minor"]) for p in r["probe_runs"]]) for r in df.collect()}
