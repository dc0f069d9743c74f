"""The stream against the batch, restarts, replays, late rows and rule changes."""

from __future__ import annotations

import random
import time

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from cardsentry.functions.wire import transaction_json
from cardsentry.operators.rules import RULE_CONFIG, default_rules, rules_frame
from cardsentry.operators.verdict import score_transactions
from cardsentry.schema import VELOCITY
from cardsentry.sources.raw import file_lines
from cardsentry.streaming import memory
from cardsentry.streaming.job import dead_letter_stream, score_stream
from cardsentry.streaming.sinks import CounterListener, LostProgress, Tables
from tests.helpers import frame, transaction

T0 = 1_700_000_000_000


class Feed:
    """Writes lines file by file and runs the stream over what is there."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.parts = spark, str(folder), 0
        self.tables = Tables(f"{self.folder}/out")

    def put(self, rows):
        (frame(self.spark, rows).coalesce(1).select(transaction_json().alias("value"))
         .write.text(f"{self.folder}/in/part={self.parts}"))
        self.parts += 1

    def run(self, **options):
        lines = file_lines(self.spark, f"{self.folder}/in/part=*", max_files=1)
        query = score_stream(lines, self.tables.root, **options)
        assert query.awaitTermination(300)
        return self

    def scores(self):
        return {r["transaction_id"]: r["score"] for r in self.tables.read(self.spark, "scored")
                .select("transaction_id", "score").collect()}

    def progress(self):
        return sorted((r.asDict() for r in self.tables.read(self.spark, "progress").collect()),
                      key=lambda r: r["batch_id"])


def _traffic(seed, n=400):
    rng = random.Random(seed)
    rows, at = [], T0
    for i in range(n):
        at += rng.choice((0, 500, 2_000, 9_000))
        rows.append(transaction(
            f"t{i:05d}", at, card_id=rng.choice(["hot", "hot", "a", "b", "d"]),
            amount_minor=rng.choice([100, 300, 2000, 9000, 70000]),
            country_code=rng.choice(["NL", "NL", "NL", "US", "XX"]),
            device_fingerprint=rng.choice([None, "dev"])))
    return rows


def _view(df):
    return sorted((r["transaction_id"], r["score"], r["h"]) for r in df.select(
        "transaction_id", "score", F.to_json("hits").alias("h")).collect())


@pytest.mark.parametrize("hot_rows,merge_every", [(1_000_000, 16), (20, 1)])
def test_stream_equals_batch_across_restarts(spark, tmp_path, monkeypatch, hot_rows, merge_every):
    monkeypatch.setattr(memory, "MERGE_EVERY", merge_every)
    rows = _traffic(1)
    feed = Feed(spark, tmp_path)
    feed.put(rows[:120])
    feed.put(rows[120:130])
    feed.run(hot_rows=hot_rows)
    feed.put(rows[130:300])
    feed.put(rows[300:])
    feed.run(hot_rows=hot_rows)  # from the checkpoint
    batch = score_transactions(frame(spark, rows), default_rules())
    assert _view(feed.tables.read(spark, "scored")) == _view(batch)
    alerts = feed.tables.alerts(spark)
    expected = batch.filter("score >= 40").count()
    assert alerts.count() == alerts.select("transaction_id").distinct().count() == expected > 0


def test_a_batch_that_failed_half_way_is_run_again_without_a_trace(
        spark, tmp_path, monkeypatch):
    rows = _traffic(6, n=200)
    feed = Feed(spark, tmp_path)
    feed.put(rows[:100])
    feed.run()
    feed.put(rows[100:])

    def broken(*args, **kwargs):
        raise RuntimeError("lost in the middle of a batch")

    # Scored rows, alerts and memory of the batch are written; its progress is not.
    with monkeypatch.context() as patch:
        patch.setattr(Tables, "write_progress", broken)
        with pytest.raises(StreamingQueryException):
            feed.run()
    feed.run()
    batch = score_transactions(frame(spark, rows), default_rules())
    assert _view(feed.tables.read(spark, "scored")) == _view(batch)
    alerts = feed.tables.read(spark, "alerts")
    assert alerts.count() == batch.filter("score >= 40").count()


def test_replayed_records_change_nothing(spark, tmp_path):
    rows = _traffic(2, n=120)
    feed = Feed(spark, tmp_path)
    feed.put(rows[:80] + rows[70:75])
    feed.put(rows[60:])  # twenty records again
    feed.put(rows[100:])
    feed.run()
    batch = score_transactions(frame(spark, rows), default_rules())
    assert _view(feed.tables.read(spark, "scored")) == _view(batch)


def test_a_replay_of_any_age_changes_nothing(spark, tmp_path):
    day = 86_400_000
    rows = [transaction(f"t{k}", T0 + k * day, card_id="ab"[k % 2]) for k in range(12)]
    feed = Feed(spark, tmp_path)
    feed.put(rows[:6])
    feed.put(rows[6:] + rows[:2])
    feed.put(rows[:9])
    feed.run()
    batch = score_transactions(frame(spark, rows), default_rules())
    assert _view(feed.tables.read(spark, "scored")) == _view(batch)
    assert [p["replayed"] for p in feed.progress()] == [0, 2, 9]


def test_lost_progress_is_an_error(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.put(_traffic(4, n=20))
    feed.run()
    with pytest.raises(LostProgress):
        feed.tables.progress_before(spark, 7)


def test_a_card_without_a_name_may_hold_a_third_of_the_rows(spark, tmp_path):
    rng = random.Random(8)
    rows = [transaction(f"t{k:04d}", T0 + k * 700, card_id="x" if k % 3 == 0 else f"c{k}",
                        amount_minor=rng.choice([100, 300, 60000])) for k in range(600)]
    feed = Feed(spark, tmp_path)
    feed.put(rows[:300])
    feed.put(rows[300:])
    feed.run(hot_rows=30)
    assert _view(feed.tables.read(spark, "scored")) == _view(
        score_transactions(frame(spark, rows), default_rules()))


def test_late_rows_are_scored_but_leave_no_trace_in_geo_or_sequences(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.put([transaction("n0", T0, card_id="g", country_code="NL"),
              transaction("n1", T0 + 600_000, card_id="g", country_code="NL"),
              transaction("p0", T0 + 500_000, card_id="s", amount_minor=100),
              transaction("p1", T0 + 500_100, card_id="s", amount_minor=100)])
    feed.put([transaction("late-geo", T0 + 300_000, card_id="g", country_code="US"),
              transaction("late-probe", T0 + 500_050, card_id="s", amount_minor=100)])
    feed.put([transaction("next-geo", T0 + 660_000, card_id="g", country_code="NL"),
              transaction("large", T0 + 620_000, card_id="s", amount_minor=60000)])
    scores = feed.run().scores()
    assert len(scores) == 8  # nothing is dropped
    assert scores["late-geo"] == 0  # a negative gap is not judged
    assert scores["next-geo"] == 0  # and the late country is not the last place
    assert scores["large"] == 0  # two probes and a late one are no run
    assert [p["late"] for p in feed.progress() if p["scored"]] == [0, 2, 0]


def test_rules_change_between_micro_batches_without_a_restart_of_state(spark, tmp_path):
    path = str(tmp_path / "rules")
    rules_frame(spark, default_rules().values()).write.parquet(path)
    burst = [transaction(f"v{i}", T0 + i * 1000, card_id="v") for i in range(8)]
    feed = Feed(spark, tmp_path)
    feed.put(burst[:4])
    assert set(feed.run(rules_path=path).scores().values()) == {0}
    tuned = default_rules()[VELOCITY].with_params(maxCount=4.0)
    import dataclasses
    rules_frame(spark, [dataclasses.replace(tuned, version=2, updated_ms=5),
                        dataclasses.replace(tuned.with_params(maxCount=1.0), version=3, updated_ms=6)]
                ).write.mode("append").parquet(path)
    feed.put(burst[4:])
    # The fifth payment is over the new count; the invalid third version is ignored.
    assert feed.run(rules_path=path).scores()["v4"] == 30
    versions = feed.tables.read(spark, "scored").selectExpr(
        "explode(hits.rule_version)").distinct().collect()
    assert [r[0] for r in versions] == [2]


def test_unreadable_rule_table_keeps_the_last_good_rules(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.put([transaction(f"v{i}", T0 + i * 1000, card_id="v") for i in range(6)])
    assert feed.run(rules_path=str(tmp_path / "nowhere")).scores()["v5"] == 30


def test_a_card_that_returns_after_the_time_to_live_starts_afresh(spark, tmp_path):
    week = 604_800_000
    feed = Feed(spark, tmp_path)
    feed.put([transaction(f"a{i}", T0 + i, card_id="a") for i in range(5)]
             + [transaction(f"b{i}", T0 + i, card_id="b") for i in range(5)])
    feed.put([transaction("a-in", T0 + week, card_id="a", amount_minor=9000),
              transaction("b-out", T0 + week + 10, card_id="b", amount_minor=9000)])
    scores = feed.run().scores()
    assert scores["a-in"] == 25 and scores["b-out"] == 0
    feed.put([transaction("b-more", T0 + week + 20, card_id="b", amount_minor=9000)])
    feed.run()
    seen = {r["transaction_id"]: r["prior_count"] for r in feed.tables.read(spark, "scored").collect()}
    assert (seen["a-in"], seen["b-out"], seen["b-more"]) == (5, 0, 1)


def test_a_query_that_runs_on_scores_what_arrives(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.put([transaction(f"v{i}", T0 + i * 1000, card_id="v") for i in range(4)])
    lines = file_lines(spark, f"{feed.folder}/in/part=*")
    query = score_stream(lines, feed.tables.root, trigger="500 milliseconds")
    try:
        feed.put([transaction(f"v{i}", T0 + i * 1000, card_id="v") for i in range(4, 8)])
        deadline = time.time() + 90
        while time.time() < deadline and sum(p["numInputRows"] for p in query.recentProgress) < 8:
            assert query.exception() is None
            time.sleep(1)
    finally:
        query.stop()
    assert feed.scores() == {f"v{i}": 30 if i > 4 else 0 for i in range(8)}


def test_counters_and_dead_letters(spark, tmp_path):
    rows = _traffic(3, n=60)
    feed = Feed(spark, tmp_path)
    feed.put(rows)
    spark.createDataFrame([("{bad",), ("[]",)], "value string").coalesce(1).write.text(
        f"{feed.folder}/in/part=9")
    listener = CounterListener()
    spark.streams.addListener(listener)
    try:
        feed.run()
        deadline = time.time() + 30
        while time.time() < deadline and listener.totals.get("rejected", 0) < 2:
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(listener)
    assert (listener.totals["parsed"], listener.totals["rejected"]) == (60, 2)
    lines = file_lines(spark, f"{feed.folder}/in/part=*")
    query = dead_letter_stream(lines, feed.tables.root)
    assert query.awaitTermination(120)
    observed = query.recentProgress[0]["observedMetrics"]["parse"]
    assert (observed["parsed"], observed["rejected"]) == (60, 2)
    assert spark.read.text(f"{feed.tables.root}/dead_letters").count() == 2
    progress = feed.progress()
    assert sum(p["scored"] for p in progress) == 60
    scored = feed.tables.read(spark, "scored")
    assert sum(p["alerts"] for p in progress) == scored.filter("score >= 40").count()
    assert sum(p["hits_geo_impossible"] for p in progress) == scored.selectExpr(
        "explode(hits.rule_id) AS r").filter("r = 'geo_impossible'").count()
    assert RULE_CONFIG  # the rule table schema is public
