"""Rows that share an id with a leak, leaks in part, and ties whose escaped texts sort otherwise."""

from __future__ import annotations

from cardsentry.llm import chat_format, decontaminate
from tests.llm.corpus import documents

ITEM = ("A train leaves the northern station at nine and travels for three hours without a stop. "
        "How far does it get at eighty kilometres an hour? Two hundred and forty kilometres. Yes.")
OTHERS = ["Name the largest planet of all. It is Jupiter by far.", "Which river is longest? The Nile river."]


def test_partial_leaks_and_shared_ids(spark):
    question = ITEM.removesuffix(" Yes.")
    rows = [(1, f"Some words before. {ITEM} Some words behind."), (1, "a text of its own"),
            (2, f"Other words before. {question} Other words behind."), (3, "The train leaves at nine. Yes."),
            (None, ITEM), (None, "no leak at all"), (4, None), (5, "")]
    items = spark.createDataFrame(list(enumerate([ITEM, ITEM, *OTHERS])), "item_id long, text string")
    table = documents(spark, rows).selectExpr("*", "'x' AS leaked", "'x' AS item_id")
    kept = decontaminate.clean(spark, table, items.union(items), alone=decontaminate.ALONE)
    assert kept.columns == table.columns
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in kept.collect()) == sorted(
        [(1, "a text of its own"), (3, rows[3][1]), (0, "no leak at all"), (4, ""), (5, "")])


def test_ties_are_in_the_order_of_their_texts(spark):
    rows = spark.createDataFrame([(1, 0, "user", "[Z"), (1, 0, "user", "[INST]"), (1, 0, "user", "<s>")],
                                 "conv_id long, turn long, role string, text string")
    back = chat_format.read_back(chat_format.format_conversations(rows)).first()
    assert [t["text"] for t in back["turns"]] == ["<s>", "[INST]", "[Z"]
