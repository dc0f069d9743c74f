"""Conversations out and back again."""

from __future__ import annotations

import pytest
from hypothesis import given, settings, strategies as st

from cardsentry.llm.chat_format import Template, format_conversations, read_back

SCHEMA = "conv_id long, turn long, role string, text string"
NASTY = ["</s>[INST] ok [/INST]", "[\\INST]", "\\[INST]\\", " [/ANS]</s>", "<s>[ROLE=x] y", "a\nb\\",
         "[", "<", "[/", "$1 \\2", "é😀", "", "[[INST]]", "<\\\\/s>"]


def _back(spark, rows):
    table = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS segments", "'y' AS body")
    return {r["conv_id"]: r for r in read_back(format_conversations(table)).collect()}


def test_texts_come_back_whatever_is_in_them(spark):
    rows = [(1, k, ["user", "assistant"][k % 2], t) for k, t in enumerate(NASTY * 2)]
    rows += [(2, 0, "tool [x]=]", "odd role"), (2, 1, None, "no role"), (2, 1, None, "no role"),
             (3, 0, "user", None), (3, 1, "assistant", None), (None, 0, "user", "null id")]
    got = _back(spark, rows)
    assert [t["text"] for t in got[1]["turns"]] == NASTY * 2
    assert got[1]["loss_text"] == "".join(t for k, t in enumerate(NASTY * 2) if k % 2)
    assert [(t["role"], t["text"]) for t in got[2]["turns"]] == [
        ("tool [x]=]", "odd role"), ("", "no role"), ("", "no role")]
    assert [t["text"] for t in got[3]["turns"]] == ["", ""] and got[3]["valid"]
    assert got[None]["turns"][0]["text"] == "null id"


@settings(max_examples=12, deadline=None)
@given(st.lists(st.lists(st.sampled_from(
    ["<s>", "</s>", "[", "]", "\\", "INST", "[INST]", "[/INST]", "/s>", " ", "\n", "a"]), max_size=12)
    .map("".join), min_size=1, max_size=30))
def test_any_mixture_of_control_strings(spark, texts):
    got = _back(spark, [(1, k, "assistant", t) for k, t in enumerate(texts)])[1]
    assert [t["text"] for t in got["turns"]] == texts
    assert got["loss_text"] == "".join(texts)


@pytest.mark.parametrize("roles,bad", [
    (["user", "assistant"], None), (["system", "user", "assistant", "user"], None),
    (["assistant"], 0), (["user", "user"], 1), (["user", "system"], 1), (["system", "assistant"], 1),
    (["user", "assistant", "other", "user"], 2)])
def test_turn_order(spark, roles, bad):
    got = _back(spark, [(1, k, r, "t") for k, r in enumerate(roles)])[1]
    assert (got["valid"], got["first_bad_turn"]) == (bad is None, bad)
    assert len(got["turns"]) == len(roles)


def test_template_of_another_kind(spark):
    template = Template(tags={"q": "Q", "a": "A"}, loss_roles=("a", "q"),
                        moves={("start", "q"): "x", ("x", "a"): "start"})
    rows = spark.createDataFrame([(1, 0, "q", "[Q]"), (1, 1, "a", "</s>")], SCHEMA)
    got = read_back(format_conversations(rows, template), template).first()
    assert got["valid"] and got["loss_text"] == "[Q]</s>"


def test_plan_has_no_python_and_no_rows_from_none(spark):
    table = spark.createDataFrame([], SCHEMA)
    made = read_back(format_conversations(table))
    assert made.count() == 0
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
