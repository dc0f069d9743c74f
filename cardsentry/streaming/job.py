"""The scoring job: raw lines in, scored rows, alerts and dead letters out.

Two queries over one source. ``score_stream`` parses, looks up what is known of the cards and
scores each micro-batch with the operators of the batch side; ``dead_letter_stream`` keeps what
does not parse. The stream itself has no state: what a micro-batch leaves to the next one stands
in tables, and its last write, the progress row, names them.
"""

from __future__ import annotations

import logging
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from cardsentry.functions.risk import Model, logistic_risk
from cardsentry.functions.wire import alert_json, scored_json
from cardsentry.operators.alerts import flat_alerts
from cardsentry.operators.facts import HOT_ROWS, hot_cards, look_back_ms, memory_facts
from cardsentry.operators.rules import (
    LONGEST_WINDOW_SECONDS, RuleSet, default_rules, load_rules)
from cardsentry.operators.verdict import score_transactions, scored_only
from cardsentry.schema import ALERT_THRESHOLD, RULE_CONFIG, RULE_IDS, event_date
from cardsentry.session import drop_folder
from cardsentry.sources.parse import (
    accepted, dead_letter_json, dead_letters, parse_lines, unique_transactions)
from cardsentry.streaming import memory
from cardsentry.streaming.sinks import Tables, counters, publish

# Fixed value: how far out of order events may come before they are late.
OUT_OF_ORDER_SECONDS = 5

# Past rows are kept for the longest window any legal rule can have.
KEEP_MS = LONGEST_WINDOW_SECONDS * 1000

_LOG = logging.getLogger(__name__)


class RuleFeed:
    """The rule set in force, read anew for each micro-batch.

    While the table cannot be read the last good set stays in use.
    """

    def __init__(self, path: str | None) -> None:
        self.path = path
        self.rules: RuleSet = default_rules()

    def current(self, spark: SparkSession) -> RuleSet:
        if self.path is not None:
            try:
                self.rules = load_rules(spark.read.schema(RULE_CONFIG).parquet(self.path))
            except (PySparkException, Py4JJavaError) as e:
                _LOG.warning("rule table unreadable, keeping the last good rules: %s", e)
        return self.rules


class BatchScorer:
    """Scores one micro-batch and writes its results, each to a folder of the batch."""

    def __init__(self, spark: SparkSession, tables: Tables, feed: RuleFeed, *,
                 model: Model = logistic_risk, threshold: int = ALERT_THRESHOLD,
                 hot_rows: int | None = HOT_ROWS, kafka: str | None = None) -> None:
        # The session of a stream has adaptive execution switched off; scoring wants it.
        self.spark = spark
        self.tables, self.feed, self.model = tables, feed, model
        self.threshold, self.hot_rows, self.kafka = threshold, hot_rows, kafka

    def _incoming(self, batch: DataFrame, batch_id: int) -> tuple[DataFrame, dict, list[str]]:
        """The accepted rows of a micro-batch, written once, one per id; what was counted on the
        way, and the days they are of."""
        seen = Observation(f"parse-{batch_id}")
        counted = batch.observe(seen, *_outcomes())
        rows = unique_transactions(accepted(counted)).withColumn("event_date", event_date())
        self.tables.write(rows, "incoming", batch_id, by="event_date")
        path = self.tables.of("incoming", batch_id)
        days = self.tables.parts(self.spark, path, "event_date")
        held = (self.spark.read.schema(rows.schema).parquet(path) if days
                else self.spark.createDataFrame([], rows.schema))
        return held, seen.get, days

    def _hot_rows(self, incoming: DataFrame, past: DataFrame) -> int | None:
        """``hot_rows`` where a card has more rows than that here, else None: the plan for such
        cards is worth its making only then."""
        if self.hot_rows is None:
            return None
        rows = incoming.select("card_id").unionAll(past.select("card_id"))
        found = hot_cards(rows, self.hot_rows).limit(1).count()
        return self.hot_rows if found else None

    def _alerts(self, scored: DataFrame, batch_id: int) -> None:
        found = flat_alerts(scored, self.threshold).withColumn("inserted_at", F.current_timestamp())
        alerts = self.tables.write(found, "alerts", batch_id)
        if self.kafka is not None:
            publish(scored, "transaction_id", scored_json(), self.kafka, "scored-transactions")
            publish(alerts, "transaction_id", alert_json(), self.kafka, "alerts")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark, tables = self.spark, self.tables
        before = tables.progress_before(spark, batch_id)
        watermark = before.next_watermark(OUT_OF_ORDER_SECONDS * 1000)
        rules = self.feed.current(spark)
        incoming, parsed, days = self._incoming(batch, batch_id)
        first_ms = incoming.agg(F.min("event_ms")).first()[0] if days else None
        counted = {name: 0 for name in ("scored", "late", "alerts", *(f"hits_{r}" for r in RULE_IDS))}
        counted["newest_ms"], cards = None, before.cards
        if first_ms is not None:
            fresh = memory.new_rows(spark, tables, incoming, days, batch_id).withColumn(
                "is_late", F.col("event_ms") < watermark)
            touched = incoming.select("card_id").distinct()
            known = memory.known_cards(spark, tables, before, touched)
            past = memory.as_rows(spark, tables, before, known, touched, first_ms, look_back_ms(rules))
            verdict = scored_only(score_transactions(
                fresh, rules, model=self.model, hot_rows=self._hot_rows(incoming, past), memory=past),
                keep=memory_facts())
            seen = Observation(f"scored-{batch_id}")
            scored = tables.write(verdict.observe(
                seen, *counters(F.col("score") >= self.threshold)), "scored", batch_id)
            counted = seen.get
            # Three small tables that have nothing to do with each other.
            with ThreadPoolExecutor(3) as side_by_side:
                alerted = side_by_side.submit(self._alerts, scored, batch_id)
                remembered = side_by_side.submit(
                    memory.remember, spark, tables, before, scored, known, batch_id)
                indexed = side_by_side.submit(memory.index_ids, scored, tables, batch_id)
                cards = remembered.result()
                for done in (alerted, indexed):
                    done.result()
        newest, recent = before.after(batch_id, counted.pop("newest_ms"), KEEP_MS)
        # Written last: a batch without it is run again.
        tables.write_progress(spark, batch_id, {
            **parsed, **counted, "replayed": parsed["parsed"] - counted["scored"],
            "newest_ms": newest, "watermark_ms": watermark, "recent": recent, "cards": cards,
            "rules": [(r.rule_id, r.version) for r in rules.values()]})
        drop_folder(spark, tables.of("incoming", batch_id))
        for name in set(before.cards) - set(cards):  # merged into a base that progress names now
            drop_folder(spark, f"{tables.of('cards')}/{name}")


def _outcomes() -> list[Column]:
    return [F.count(F.when(F.col("reason").isNull(), 1)).alias("parsed"),
            F.count(F.when(F.col("reason").isNotNull(), 1)).alias("rejected")]


def _parsed(lines: DataFrame) -> DataFrame:
    """Parsed lines with counts of both outcomes in the progress of the query."""
    return parse_lines(lines).observe("parse", *_outcomes())


def _start(writer: DataStreamWriter, checkpoint: str, trigger: str) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    if trigger == "available":
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=trigger).start()


def score_stream(lines: DataFrame, root: str, *, rules_path: str | None = None,
                 trigger: str = "available", model: Model = logistic_risk,
                 threshold: int = ALERT_THRESHOLD, hot_rows: int | None = HOT_ROWS,
                 kafka: str | None = None) -> StreamingQuery:
    """Starts scoring ``lines`` into tables below ``root``, a folder all executors reach.

    ``trigger`` is "available" (all input there is, then stop) or an interval such as
    "10 seconds", which runs on. Offsets live in ``root``/checkpoint and everything else in the
    tables, so a restart goes on where it stopped. Cards that bring more than ``hot_rows`` rows,
    those of the last look-back included, are found anew in each micro-batch.
    """
    scorer = BatchScorer(lines.sparkSession, Tables(root), RuleFeed(rules_path), model=model,
                         threshold=threshold, hot_rows=hot_rows, kafka=kafka)
    return _start(_parsed(lines).writeStream.queryName("score").foreachBatch(scorer),
                  f"{root}/checkpoint/score", trigger)


def dead_letter_stream(lines: DataFrame, root: str, *, trigger: str = "available",
                       kafka: str | None = None) -> StreamingQuery:
    """Starts writing refused lines as JSON, to a topic or to text files below ``root``."""
    refused = dead_letters(_parsed(lines)).select(dead_letter_json().alias("value"))
    if kafka is not None:
        writer = (refused.writeStream.format("kafka").option("kafka.bootstrap.servers", kafka)
                  .option("topic", "transactions-dlq"))
    else:
        writer = refused.writeStream.format("text").option("path", f"{root}/dead_letters")
    return _start(writer.queryName("dead-letters"), f"{root}/checkpoint/dead_letters", trigger)
