"""Per-card facts: what each transaction knows about its card at its event time.

Every window starts with the card, so one exchange serves all of them, and no window costs
more than its rows and their sort: running counts and sums stand for sliding frames; a
trailing count is the rank of a row minus the rows at or before the start of its window.

Cards with too many rows for one task take another way, prefix sums of two levels (see
``crowded``), so neither a card nor its busiest hour has to fit into one task.

A card that stays away for longer than ``stateTtlSeconds`` is forgotten and starts anew.

What a stream knows from earlier micro-batches comes as rows too: a *memory* row per card
(count, sum, last place) and *context* rows (copies of the rows of the last look-back).
"""

from __future__ import annotations

import dataclasses
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from cardsentry.operators.crowded import BEGINNING, MEMORY, OWN, TOTAL, crowded_facts
from cardsentry.operators.rules import RuleSet
from cardsentry.schema import AMOUNT_ANOMALY, CARD_TESTING, VELOCITY

# Cards with more rows than this take the way of ``crowded`` in the jobs over whole histories.
HOT_ROWS = 1_000_000
# Rows of whole cards that one task takes, as far as ``card_parts`` can say.
ROWS_PER_TASK = 100_000

# Kinds of rows in a window; memory and own ones are named in ``crowded``.
CONTEXT = 1

FACT_COLUMNS = ["velocity_count", "prior_count", "prior_total", "prev_country", "prev_ms",
                "probe_runs", "since_ms"]


def memory_facts() -> list[str]:
    """Facts of a row from which the memory of its card after it follows."""
    return ["prior_count", "prior_total", "since_ms"]



def look_back_ms(rules: RuleSet, own: Sequence[OwnFact] = ()) -> int:
    return max(1000 * rules[VELOCITY].whole("windowSeconds"),
               1000 * rules[CARD_TESTING].whole("windowSeconds"), *(f.window_ms for f in own))


def forget_ms(rules: RuleSet) -> int:
    """How long a card may stay away before it is forgotten."""
    return 1000 * rules[AMOUNT_ANOMALY].whole("stateTtlSeconds")


def hot_cards(rows: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """card_id of the cards with more rows than ``hot_rows``; a plan, nothing is collected."""
    return (rows.groupBy("card_id").agg(F.count(F.lit(1)).alias("_rows"))
            .filter(F.col("_rows") > hot_rows).select("card_id"))


def card_parts(rows: DataFrame) -> int | None:
    """Partitions by card that leave about ``ROWS_PER_TASK`` rows to each, None for a small table.

    Every row is sorted several times in the task of its card, at some ten times the bytes it has
    in the shuffle, so sizes in bytes make tasks too large. ``rows`` are counted: give a table or a
    selection of its columns, whose footers know the number.
    """
    parts = -(-rows.count() // ROWS_PER_TASK)
    return max(parts, rows.sparkSession.sparkContext.defaultParallelism) if parts > 1 else None


_REMEMBERED = ("card_id", "transaction_id", "event_ms", "amount_minor", "country_code")


def _prepared(rows: DataFrame, memory: DataFrame | None) -> DataFrame:
    """Input rows and, for a stream, the remembered ones, in one shape.

    ``memory`` has card_id, kind (MEMORY or CONTEXT), transaction_id, event_ms,
    amount_minor, country_code, seen (transactions since the card was last forgotten),
    seen_total and any other columns of the rows. Its context rows belong to that time too.
    """
    own = rows.select("*", F.lit(OWN).alias("_kind"), F.lit(1).cast("bigint").alias("_n"),
                      F.col("amount_minor").cast(TOTAL).alias("_amount"))
    if memory is None:
        return own
    remembered = memory.select(
        "card_id", F.col("kind").alias("_kind"), "transaction_id", "event_ms", "amount_minor",
        "country_code",
        F.when(F.col("kind") == MEMORY, F.col("seen")).otherwise(F.lit(0)).alias("_n"),
        F.when(F.col("kind") == MEMORY, F.col("seen_total")).otherwise(F.lit(0)).cast(TOTAL)
        .alias("_amount"),
        *[c for c in memory.columns if c in rows.columns and c not in _REMEMBERED])
    return own.unionByName(remembered, allowMissingColumns=True)


@dataclasses.dataclass(frozen=True)
class OwnFact:
    """A fact that a rule brings along: the sum of ``value`` (SQL, a whole number) over the rows
    of a card in the last ``window_ms``, up to and with the row itself, as column own_<name>."""

    name: str
    value: str
    window_ms: int


def card_facts(rows: DataFrame, rules: RuleSet, *, hot_rows: int | None = None,
               parts: int | None = None, memory: DataFrame | None = None, own: Sequence[OwnFact] = ()) -> DataFrame:
    """``rows`` with the per-card facts of every rule, thresholds not yet applied.

    Adds velocity_count (this row and the earlier ones inside the velocity window),
    prior_count and prior_total (earlier rows of the card), prev_country and prev_ms
    (the place it was last seen), probe_runs (the runs of small amounts which
    this row, when large, completes: array of first_ms, total_minor) and since_ms (when the card
    came back among these rows after it had been forgotten, else null).

    Order within a card is (event_ms, transaction_id). Ids are expected to be unique.
    With ``hot_rows`` rows are counted per card first, and cards above it take the way of
    ``crowded``; without it every card is scored in one piece. ``parts`` is the number of partitions
    by card (see ``card_parts``), else the session's. With a boolean column ``is_late``
    in ``rows``, late rows take no part in card testing. ``own`` adds facts of other rules, in the
    same exchange.
    """
    columns, streaming = rows.columns, memory is not None
    marked = _marked(_prepared(rows, memory), rules, "is_late" in columns)
    for fact in own:
        marked = marked.withColumn(f"_v_{fact.name}", F.expr(
            f"if(_real, coalesce(CAST({fact.value} AS BIGINT), 0), 0)"))
    if hot_rows is None:
        return _windows(_dealt(marked, parts), rules, columns, streaming, own)
    hot = hot_cards(marked.filter("_real"), hot_rows).withColumn("_hot", F.lit(True))
    # There are at most rows / hot_rows such ids, so they go to the rows: a shuffle by card would
    # bring a hot card into one task before it is known as one.
    told = marked.join(F.broadcast(hot), "card_id", "left")
    calm = _windows(_dealt(told.filter("_hot IS NULL"), parts), rules, columns, streaming, own)
    testing = rules[CARD_TESTING]
    return calm.unionByName(crowded_facts(
        told.filter("_hot"), columns, look_back=look_back_ms(rules, own),
        velocity_ms=rules[VELOCITY].whole("windowSeconds") * 1000,
        testing_ms=testing.whole("windowSeconds") * 1000, probe_count=testing.whole("probeCount"),
        forget_ms=forget_ms(rules), own=[(f.name, f.window_ms) for f in own]))


def _dealt(rows: DataFrame, parts: int | None) -> DataFrame:
    """The exchange that the windows need anyway, with its number of partitions."""
    return rows if parts is None else rows.repartition(parts, "card_id")


def _marked(prepared: DataFrame, rules: RuleSet, knows_late: bool) -> DataFrame:
    """Rows with their marks: real ones, small and large payments."""
    testing = rules[CARD_TESTING]
    on_time = "NOT coalesce(is_late, false)" if knows_late else "true"
    return prepared.selectExpr(
        "*",
        f"_kind <> {MEMORY} AS _real",
        f"_kind <> {MEMORY} AND {on_time}"
        f" AND amount_minor <= {testing.whole('probeMaxAmountMinor')} AS _probe",
        f"_kind <> {MEMORY} AND {on_time}"
        f" AND amount_minor >= {testing.whole('largeAmountMinor')} AS _large")


def _windows(marked: DataFrame, rules: RuleSet, columns: list[str], streaming: bool,
             own: Sequence[OwnFact]) -> DataFrame:
    velocity, testing = rules[VELOCITY], rules[CARD_TESTING]
    velocity_ms = velocity.whole("windowSeconds") * 1000
    testing_ms = testing.whole("windowSeconds") * 1000

    card = "PARTITION BY card_id"
    line = f"{card} ORDER BY _at, transaction_id"
    past = f"{line} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    upto = f"{line} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"

    # For a probe: the time of the first of its run, and the amounts of the others.
    before_last = testing.whole("probeCount") - 1
    earlier_probes = " + ".join(
        f"lag(if(_probe, amount_minor, null), {i}) IGNORE NULLS OVER ({line})"
        for i in range(1, before_last + 1))

    # Running facts in event-time order; one sort serves them and the two windows after.
    timed = marked.selectExpr("*", f"if(_kind = {MEMORY}, {BEGINNING}, event_ms) AS _at")
    running = timed.selectExpr(
        "*",
        f"count_if(_real) OVER ({upto}) AS _rank",
        f"sum(if(_kind = {CONTEXT}, 0, _n)) OVER ({past}) AS _prior_count",
        f"sum(if(_kind = {CONTEXT}, CAST(0 AS {TOTAL}), _amount)) OVER ({past}) AS _prior_total",
        f"lag(country_code) OVER ({line}) AS _lag_country",
        f"lag(event_ms) OVER ({line}) AS _lag_ms",
        f"count_if(_large) OVER ({past}) AS _group",
        f"lag(if(_probe, event_ms, null), {before_last}) IGNORE NULLS OVER ({line}) AS _first_ms",
        f"amount_minor + {earlier_probes} AS _run_total",
        *([f"max(if(_real, null, event_ms)) OVER ({past}) AS _mem_ms",
           f"max(if(_real, null, country_code)) OVER ({past}) AS _mem_country"]
          if streaming else []),
        *[f"sum(_v_{f.name}) OVER ({upto}) AS _o_{f.name}" for f in own],
    ).selectExpr(
        "*",
        *[f"coalesce(sum(_v_{f.name}) OVER ({card} ORDER BY _at RANGE BETWEEN UNBOUNDED PRECEDING"
          f" AND {f.window_ms} PRECEDING), 0) AS _x_{f.name}" for f in own],
        f"count_if(_real) OVER ({card} ORDER BY _at RANGE BETWEEN UNBOUNDED PRECEDING"
        f" AND {velocity_ms} PRECEDING) AS _outside")

    # A card that was away for too long: what came before its return no longer counts.
    prev_ms, prev_country = "_lag_ms", "_lag_country"
    if streaming:
        # A row that came late must not become the last known place.
        newer = f"_mem_ms > coalesce(_lag_ms, {BEGINNING})"
        prev_ms = f"if({newer}, _mem_ms, _lag_ms)"
        prev_country = f"if({newer}, _mem_country, _lag_country)"
    returned = running.selectExpr(
        "*", f"{prev_ms} AS _prev_ms", f"{prev_country} AS _prev_country",
        f"coalesce(_kind = {OWN} AND event_ms - ({prev_ms}) > {forget_ms(rules)}, false) AS _back",
    ).selectExpr(
        "*",
        f"coalesce(max(if(_back, event_ms, null)) OVER ({upto}), {BEGINNING}) AS _since",
        f"coalesce(max(if(_back, _rank - 1, null)) OVER ({upto}), 0) AS _rank_before",
        f"coalesce(last(if(_back, _prior_count, null), true) OVER ({upto}), 0) AS _count_before",
        f"coalesce(last(if(_back, _prior_total, null), true) OVER ({upto}), 0) AS _total_before",
        *[f"last(if(_back, _o_{f.name} - _v_{f.name}, null), true) OVER ({upto}) AS _s_{f.name}"
          for f in own])

    # Card testing without a join. The rows up to and with a large one form a group, whose
    # complete runs stand at place 3g, whose large row stands at 3g + 1 and all else at 3g + 2.
    # A run learns from the place after its own when its group ends, and is left out if it is too
    # old then. The frame is the place before one's own: the large row alone sees runs, each run
    # is gathered once, and rows at one place share one frame.
    by_place = f"{card} ORDER BY _place RANGE BETWEEN"
    gathered = returned.selectExpr(
        "*", "_probe AND _first_ms >= _since AS _run_here",
    ).selectExpr(
        "*", "3 * _group + CASE WHEN _large THEN 1 WHEN _run_here THEN 0 ELSE 2 END AS _place",
    ).selectExpr(
        "*",
        f"max(if(_large, event_ms, null)) OVER ({by_place} 1 FOLLOWING AND 1 FOLLOWING) AS _end_ms",
    ).selectExpr(
        "*",
        f"if(_run_here AND _first_ms > _end_ms - {testing_ms},"
        " named_struct('first_ms', _first_ms, 'total_minor', _run_total), null) AS _run",
    ).selectExpr(
        "*", f"collect_list(_run) OVER ({by_place} 1 PRECEDING AND 1 PRECEDING) AS _runs",
    ).filter(F.col("_kind") == OWN)
    return gathered.selectExpr(
        *columns,
        "_rank - greatest(_outside, _rank_before) AS velocity_count",
        "coalesce(_prior_count, 0L) - _count_before AS prior_count",
        f"CAST(coalesce(_prior_total, 0) - _total_before AS {TOTAL}) AS prior_total",
        "if(_back, null, _prev_country) AS prev_country",
        "if(_back, null, _prev_ms) AS prev_ms",
        "if(size(_runs) > 0, array_sort(filter(_runs, r -> r.first_ms >= _since)), _runs) AS probe_runs",
        f"nullif(_since, {BEGINNING}) AS since_ms",
        *[f"_o_{f.name} - if(_since > event_ms - {f.window_ms}, _s_{f.name}, _x_{f.name})"
          f" AS own_{f.name}" for f in own])
