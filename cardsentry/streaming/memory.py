"""What a stream remembers of its cards between micro-batches, as tables.

``cards`` has a row per card that a micro-batch touched: how many rows it has had since it was last
forgotten, their sum, when that time began, and its last place. A micro-batch writes the rows of
its own cards only; every ``MERGE_EVERY`` of them all are merged into one base. The newest row of
a card counts, so a lookup is one aggregate over the base and the few tables after it, for the
cards of the micro-batch. The rows of the last look-back come from the scored tables.

No Python runs per row, and no card stays in one task: what is read goes to the window operators
as memory and context rows, which cut up cards with too many rows.

``ids`` has the transaction ids by the day of their event, so a replayed record is found however
old it is, and only the days that a micro-batch brings are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cardsentry.operators.facts import CONTEXT, MEMORY, TOTAL
from cardsentry.streaming.sinks import Progress, Tables

MERGE_EVERY = 16
# With more days than this in a micro-batch, the whole index is read.
MOST_DAYS = 400

# Columns of context rows that only facts of rules of one's own may read.
_WIDE = ("currency", "merchant_id", "merchant_category", "device_fingerprint")

_CARD = ("card_id string, seen bigint, seen_total decimal(38,0), since_ms bigint, "
         "last struct<event_ms:bigint,transaction_id:string,country_code:string>, as_of bigint")


def new_rows(spark: SparkSession, tables: Tables, rows: DataFrame, days: list[str],
             batch_id: int) -> DataFrame:
    """Rows whose id no earlier micro-batch has scored for the same day."""
    if len(days) > MOST_DAYS:
        paths = [tables.of("ids")] if tables.exists(spark, tables.of("ids")) else []
    else:
        paths = [p for p in (f"{tables.of('ids')}/event_date={d}" for d in days)
                 if tables.exists(spark, p)]
    if not paths:
        return rows
    known = (spark.read.option("basePath", tables.of("ids"))
             .schema("transaction_id string, event_date date, batch_id bigint").parquet(*paths)
             .filter(F.col("batch_id") < batch_id).select("transaction_id", "event_date"))
    return rows.join(known, ["transaction_id", "event_date"], "left_anti").select(*rows.columns)


def index_ids(scored: DataFrame, tables: Tables, batch_id: int) -> None:
    """Adds the ids of a micro-batch; one that runs again replaces what it wrote."""
    (scored.select("transaction_id", "event_date", F.lit(batch_id).alias("batch_id"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("event_date", "batch_id").parquet(tables.of("ids")))


def known_cards(spark: SparkSession, tables: Tables, before: Progress, cards: DataFrame) -> DataFrame:
    """The newest row of each of ``cards`` (card_id) that was seen before."""
    if not before.cards:
        return spark.createDataFrame([], _CARD).drop("as_of")
    rows = spark.read.schema(_CARD).parquet(*[f"{tables.of('cards')}/{name}" for name in before.cards])
    newest = F.max_by(F.struct("seen", "seen_total", "since_ms", "last"), "as_of").alias("_row")
    return (rows.join(cards, "card_id", "left_semi").groupBy("card_id").agg(newest)
            .select("card_id", "_row.*"))


def as_rows(spark: SparkSession, tables: Tables, before: Progress, known: DataFrame,
            cards: DataFrame, first_ms: int, look_back: int) -> DataFrame:
    """Memory and context rows of ``cards`` as the window operators take them.

    Context rows reach ``look_back`` behind the first row of the micro-batch, as far as an hour
    behind the newest row of the stream, and never behind the time at which a card was forgotten.
    """
    memory = known.select(
        "card_id", F.lit(MEMORY).alias("kind"),
        F.lit("").alias("transaction_id"), F.col("last.event_ms").alias("event_ms"),
        F.lit(None).cast("bigint").alias("amount_minor"),
        F.col("last.country_code").alias("country_code"), "seen", "seen_total",
        F.lit(False).alias("is_late"))
    since = first_ms - look_back
    folders = [tables.of("scored", b) for b, newest in before.recent if newest > since]
    if not folders:
        return memory
    recent = (spark.read.parquet(*folders).filter(F.col("event_ms") > since)
              .join(cards, "card_id", "left_semi")
              .join(known.select("card_id", F.col("since_ms").alias("_since")), "card_id", "left")
              .filter(F.col("_since").isNull() | (F.col("event_ms") >= F.col("_since"))))
    return memory.unionByName(recent.select(
        "card_id", F.lit(CONTEXT).alias("kind"), "transaction_id", "event_ms", "amount_minor",
        "country_code", F.lit(None).cast("bigint").alias("seen"),
        F.lit(None).cast(TOTAL).alias("seen_total"), "is_late", *_WIDE), allowMissingColumns=True)


def remember(spark: SparkSession, tables: Tables, before: Progress, scored: DataFrame,
             known: DataFrame, batch_id: int) -> list[str]:
    """Writes what is known of the cards of ``scored`` after it; gives the tables to read next."""
    place = F.struct("event_ms", "transaction_id", "country_code")
    after = F.struct((F.col("prior_count") + 1).alias("seen"),
                     (F.col("prior_total") + F.col("amount_minor")).cast(TOTAL).alias("seen_total"),
                     "since_ms")
    touched = scored.groupBy("card_id").agg(
        F.max_by(after, F.struct("event_ms", "transaction_id")).alias("_after"),
        F.max(place).alias("_last"))
    earlier = known.select("card_id", F.col("since_ms").alias("_since"), F.col("last").alias("_before"))
    name = f"batch={batch_id}"
    (touched.join(earlier, "card_id", "left").select(
        "card_id", "_after.seen", "_after.seen_total",
        F.coalesce("_after.since_ms", "_since").alias("since_ms"),
        F.greatest("_last", "_before").alias("last"), F.lit(batch_id).cast("bigint").alias("as_of"))
     .write.mode("overwrite").parquet(f"{tables.of('cards')}/{name}"))
    names = [*before.cards, name]
    if len(names) <= MERGE_EVERY:
        return names
    merged = spark.read.schema(_CARD).parquet(*[f"{tables.of('cards')}/{n}" for n in names])
    row = F.struct("seen", "seen_total", "since_ms", "last", "as_of")
    (merged.groupBy("card_id").agg(F.max_by(row, "as_of").alias("_row")).select("card_id", "_row.*")
     .write.mode("overwrite").parquet(f"{tables.of('cards')}/base={batch_id}"))
    return [f"base={batch_id}"]
