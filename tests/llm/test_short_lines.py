"""Lines of few words, and of scripts without blanks."""

from __future__ import annotations

from cardsentry.llm import line_dedup as L
from tests.llm.corpus import documents

CHINESE = "这是一个没有空格的很长的段落用来检查重复的文本是否会被删除而不是被保留下来"


def test_short_lines_and_lines_without_blanks(spark):
    rows = [(1, f"All rights reserved.\n{CHINESE}"), (2, f"own text\n {CHINESE}好 \nAll rights reserved."),
            (3, "All rights reserved!\n\n"), (4, "短行\nLes."), (5, "短行"), (6, "\n\n"), (7, "own two\nLes.")]
    table = documents(spark, rows)
    lines = L.judged(spark, table, short=True).collect()
    assert {(r["doc_id"], r["line_no"]) for r in lines} == {
        (d, k) for d, t in rows for k, x in enumerate(t.split("\n")) if x.strip()}
    assert {(r["doc_id"], r["line_no"], r["class_doc_id"], r["class_line_no"])
            for r in lines if not r["kept"]} == {
        (2, 1, 1, 1), (2, 2, 1, 0), (5, 0, 4, 0), (7, 1, 4, 1)}
    assert {r["doc_id"]: r["text"] for r in L.dedup(spark, table).collect()} == {
        1: rows[0][1], 2: "own text", 3: rows[2][1], 4: rows[3][1], 6: "\n\n", 7: "own two"}
