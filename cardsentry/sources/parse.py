"""Strict parse of wire JSON, with a dead-letter side for everything it refuses.

A record is refused for text that is not a JSON object of the right types, for a
missing required field, for a negative amount and for a time outside the years 1 to 9999,
which no later operator could hold. Unknown fields are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from cardsentry.schema import TRANSACTION, TRANSACTION_COLUMNS, TRANSACTION_WIRE

# The error text on a dead letter, and how much of the payload it keeps.
PARSE_ERROR = "Failed to parse Transaction"
PAYLOAD_CHARS = 1024

# Event times from the start of year 1 to the end of year 9999: what dates and timestamps hold.
FIRST_MS, LAST_MS = -62_135_596_800_000, 253_402_300_799_999

_CORRUPT = "_corrupt"
_WIRE = T.StructType(
    [T.StructField(TRANSACTION_WIRE[f.name], f.dataType, True) for f in TRANSACTION.fields]
    + [T.StructField(_CORRUPT, T.StringType(), True)])
_REQUIRED = [f.name for f in TRANSACTION.fields if not f.nullable]


def _reason() -> Column:
    # Blank text is no object, but gives nulls rather than a corrupt record.
    blank = F.col("_line").isNull() | ~F.col("_line").rlike(r"\S")
    checks = F.when(blank | F.col(_CORRUPT).isNotNull(), F.lit("malformed"))
    for name in _REQUIRED:
        wire = TRANSACTION_WIRE[name]
        checks = checks.when(F.col(wire).isNull(), F.lit(f"missing {wire}"))
    checks = checks.when(F.col(TRANSACTION_WIRE["amount_minor"]) < 0, F.lit("negative amountMinor"))
    in_span = F.col(TRANSACTION_WIRE["event_ms"]).between(FIRST_MS, LAST_MS)
    return checks.when(~in_span, F.lit("eventTime out of range"))


def parse_lines(lines: DataFrame) -> DataFrame:
    """Transaction columns plus ``payload`` and ``reason`` (null when accepted).

    Needs no shuffle and runs the same on a batch and on a stream. Columns of
    ``lines`` other than ``value`` are kept.
    """
    extra = [c for c in lines.columns if c != "value"]
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    # The generator keeps filters on the outcome above the parse; pushed below, they
    # would parse each line once per field they look at.
    parsed = (lines.withColumn("_line", F.col("value").cast("string"))
              .select(*extra, "_line", F.inline(F.array(F.from_json("_line", _WIRE, options)))))
    return parsed.select(
        *extra, *[F.col(wire).alias(name) for name, wire in TRANSACTION_WIRE.items()],
        F.coalesce("_line", F.lit("")).alias("payload"), _reason().alias("reason"))


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reason").isNull()).drop("payload", "reason")


def dead_letters(parsed: DataFrame) -> DataFrame:
    """(error, payload, reason); a long payload is cut and marked with dots."""
    payload = F.col("payload")
    snippet = F.when(F.length(payload) > PAYLOAD_CHARS,
                     F.concat(F.substring(payload, 1, PAYLOAD_CHARS), F.lit("..."))).otherwise(payload)
    return (parsed.filter(F.col("reason").isNotNull())
            .select(F.lit(PARSE_ERROR).alias("error"), snippet.alias("payload"), "reason"))


def dead_letter_json() -> Column:
    """The line that goes to the dead-letter topic."""
    return F.to_json(F.struct("error", "payload"))


def unique_transactions(transactions: DataFrame) -> DataFrame:
    """One row per transaction id: the one with the latest event time.

    An aggregate rather than a window, so copies are combined before the shuffle
    and a much-repeated id stays cheap.
    """
    others = [c for c in transactions.columns if c not in ("transaction_id", "event_ms")]
    latest = F.max(F.struct("event_ms", *others)).alias("_row")
    return (transactions.groupBy("transaction_id").agg(latest)
            .select("transaction_id", "_row.*")
            .select(*transactions.columns))
