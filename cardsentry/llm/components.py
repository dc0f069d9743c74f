"""Connected components of links, in rounds of two joins whose tables are written in between.

Each round points the larger neighbours of every node at its smallest neighbour, then the smaller
ones (large star, small star). The number of links never grows, a chain of length k needs about
log k rounds, and a hub only ever takes part in sums and joins, which Spark can split.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cardsentry.session import drop_folder, new_folder, written

ROUNDS = 2  # rounds with leaders before the ids of a list meet in full
LEADERS = 4  # of a list and round
RECENT = 16  # tokens before a meeting that are looked at for an earlier one
FILE_ROWS = 100_000  # of links, for each file at least, once every core has one


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(
        links.select(F.col("b").alias("node"), F.col("a").alias("other")))


def _star(pairs: DataFrame, onto_larger: bool) -> DataFrame:
    """Links from a node's neighbours to the smallest of them and itself."""
    least = pairs.groupBy("node").agg(F.min("other").alias("m")).select(
        "node", F.least("m", "node").alias("m"))
    joined = pairs.join(least, "node")
    if onto_larger:
        made = joined.filter(F.col("other") > F.col("node")).select(
            F.col("other").alias("a"), F.col("m").alias("b"))
    else:
        made = joined.select(F.col("other").alias("a"), F.col("m").alias("b")).unionByName(
            least.select(F.col("node").alias("a"), F.col("m").alias("b")))
    return made.filter("a <> b").distinct()


def _is_settled(links: DataFrame) -> bool:
    """Whether every node has one smaller neighbour at most, and that one has none."""
    sides = links.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")) \
        .unionByName(links.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    seen = sides.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return seen.filter("up > 1 OR (up = 1 AND down = 1)").isEmpty()


def connected(links: DataFrame) -> DataFrame:
    """node, label (its component's smallest node) for every node of the links (a, b)."""
    spark = links.sparkSession
    turned = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    folder = new_folder(spark, "components")
    now = written(turned.distinct(), folder)
    # A star never has more links than it was made from.
    parts = max(spark.sparkContext.defaultParallelism, -(-now.count() // FILE_ROWS))
    while not _is_settled(now):
        large = _star(_both_ways(now), True)
        down = large.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("other"))
        before, folder = folder, new_folder(spark, "components")
        now = written(_star(down, False).coalesce(parts), folder)
        drop_folder(spark, before)
    return now.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())


def _round_of_leaders(labelled: DataFrame, waiting: DataFrame, number: int,
                      hub: str | None) -> DataFrame:
    """Each list's ids against a few of its own, drawn anew for every round.

    With ``hub`` one leader is the id where it is largest, others are that of a random quarter of
    the ids; after the first round every other leader is from outside the largest component.
    """
    entry = F.struct(*labelled.columns)

    def drawn(k: int) -> Column:
        mixed = F.xxhash64("id", F.lit(number * LEADERS + k))
        if hub is None:
            return F.min(F.struct(mixed.alias("order"), entry.alias("entry")))["entry"]
        outside = F.when(F.col("label") != F.col("main"), 0).otherwise(1) \
            if number and k % 2 == 0 else F.lit(0)
        within = F.pmod(mixed, F.lit(4)) if number or k else F.lit(0)
        return F.min(F.struct(outside.alias("outside"), F.when(within == 0, 0).otherwise(1).alias("within"),
                              (-F.col(hub)).alias("hub"), mixed.alias("order"),
                              entry.alias("entry")))["entry"]

    drawn = [drawn(k) for k in range(LEADERS)]
    chosen = waiting.groupBy("token").agg(F.array_distinct(F.array(*drawn)).alias("drawn")).select(
        F.explode("drawn").alias("b"))
    chosen = chosen.select(*(F.col(f"b.{c}").alias(f"b_{c}") for c in labelled.columns))
    return (waiting.select(*labelled.columns).join(chosen, F.col("token") == F.col("b_token"))
            .filter(F.col("label") != F.col("b_label")))


def _first_meetings(waiting: DataFrame, columns: list[str], order: str) -> DataFrame:
    """Ids of two components where they meet, the smaller id first; recent and b_recent are the
    up to ``RECENT`` tokens that either has just before."""
    along = Window.partitionBy("id").orderBy(order, "token")
    # A settled list holds no pair that is apart, so only tokens of waiting lists count.
    placed = waiting.withColumn("recent", F.collect_list("token").over(along.rowsBetween(-RECENT, -1))) \
        .withColumn("older", F.greatest(F.lit(0), F.row_number().over(along) - 1 - RECENT))
    placed = written(placed, new_folder(waiting.sparkSession, "lists"))
    names = [*columns, "recent", "older"]
    other = placed.filter("label <> main").select(*(F.col(c).alias(f"b_{c}") for c in names))
    met = placed.join(other, F.col("token") == F.col("b_token")).filter(
        (F.col("label") != F.col("b_label"))
        & ((F.col("label") == F.col("main")) | (F.col("id") < F.col("b_id"))))
    # The main component differs from list to list: all meetings of a pair in one order.
    turned = F.col("b_id") < F.col("id")
    return met.select("recent", "b_recent", *(
        F.when(turned, F.col(one)).otherwise(F.col(two)).alias(name)
        for c in names if c != "recent"
        for name, one, two in ((c, f"b_{c}", c), (f"b_{c}", c, f"b_{c}"))))


def link_lists(spark: SparkSession, lists: DataFrame,
               narrow: Callable[[DataFrame, bool], DataFrame],
               verified: Callable[[DataFrame], DataFrame], order: str = "token",
               hub: str | None = None) -> DataFrame:
    """node, label: connected components of ids that meet in a list and are verified to link.

    ``lists`` has token, id and what ``narrow`` needs; two ids that link share a token. Lists
    whose ids are all connected are done. In ``ROUNDS`` rounds each list links its ids to
    ``LEADERS`` of them; then the ids outside a list's largest component meet all the others of
    other components, once a pair and not in every list that the two share: a meeting behind an
    earlier one counts as that one. ``order`` names the column that says what is earlier; it must
    order the tokens of all ids alike. ``narrow`` filters rows (id ... against b_id ...); in the
    last round it is told so, has the smaller id first, and ``older`` and ``b_older`` say how many
    tokens of each lie too far back to be sure that they are not shared. ``verified`` keeps the
    pairs (a, b) that truly link. No link between two components is left untested.
    """
    lists = written(lists, new_folder(spark, "lists"))
    labels = spark.createDataFrame([], "node long, label long")
    for number in range(ROUNDS + 1):
        folders = new_folder(spark, "lists"), new_folder(spark, "lists")
        if not number:  # no id has a label yet, so the lists are not written a second time
            labelled = lists.withColumn("label", F.col("id"))
        else:
            labelled = lists.join(labels.withColumnRenamed("node", "id"), "id", "left").select(
                *lists.columns, F.coalesce("label", "id").alias("label"))
            labelled = written(labelled, folders[0])
        groups = labelled.groupBy("token", "label").agg(F.count("*").alias("n"))
        state = groups.groupBy("token").agg(
            F.max(F.struct("n", "label"))["label"].alias("main"), F.count("*").alias("k")).filter(
            "k > 1").select("token", "main")
        waiting = written(labelled.join(state, "token"), folders[1])
        last = number == ROUNDS
        if waiting.isEmpty():
            return labels
        met = _first_meetings(waiting, labelled.columns, order) if last \
            else _round_of_leaders(labelled, waiting, number, hub)
        met = narrow(met, last)
        if last:  # after the cheaper filters
            met = met.filter(~F.arrays_overlap("recent", "b_recent"))
        pairs = met.select(F.greatest("id", "b_id").alias("a"), F.least("id", "b_id").alias("b")).distinct()
        known = labels.select(F.col("node").alias("a"), F.col("label").alias("b"))
        labels = connected(known.unionByName(verified(pairs)))
        for folder in folders:
            drop_folder(spark, folder)
    return labels
