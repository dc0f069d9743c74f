"""Pages whose main text is known."""

from __future__ import annotations

import pytest

from cardsentry.llm import html_text

LONG = "A paragraph of running text, with marks; and more of it, so that it is long enough. Yes."
CASES = [
    (None, ""), ("", ""), ("   ", ""), ("no markup &amp; all text", "no markup & all text"),
    ("<html><body><nav><ul><li><a href='/a'>A</a></li></ul></nav><article><h1>T &eacute;</h1>"
     "<p><b>bold<br><p>two  \n words&nbsp;x</p></article><footer>f, long and longer.</footer>",
     "T é\nbold\ntwo words x"),
    (f"<body><div class='site-header'>Name</div><div id=c><p>{LONG}</p><h2>Sub</h2><p>{LONG}</p>"
     "<p>Short.</p></div><div class='comments'><p>Nice, really. I liked it, and more.</p></div>",
     f"{LONG}\nSub\n{LONG}\nShort."),
    ("<article><p>in</p><script>var t='</p>';</script><style>p{}</style><form>f</form>"
     "<aside>side</aside><div class='ad'>buy</div><p>out</p></article>", "in\nout"),
    ("<article><p>a < b & c &#62; d</p><!-- <p>gone</p> --></article>", "a < b & c > d"),
    ("<article><p>one<p>two<div>three</article><p>after</p>", "one\ntwo\nthree"),
    ("<article><p>never closed <b", "never closed"), ("<div class='cookie-notice'>only</div>", ""),
    ("<article><p>a<b>b</b>c</p><script>never closed", "abc"),
]


@pytest.mark.parametrize("page,text", CASES)
def test_main_text(page, text):
    assert html_text.main_text(page) == text


def test_every_page_gives_a_row(spark):
    rows = [(k, f"u{k}", page) for k, (page, _) in enumerate(CASES)] * 2 + [(None, None, CASES[4][0])]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr(
        "*", "'x' AS text", "1 AS n_chars")
    got = html_text.extract(pages).collect()
    assert len(got) == len(rows)
    for row in got:
        expected = CASES[4 if row["page_id"] is None else row["page_id"]][1]
        assert row["text"] == expected and row["n_chars"] == len(expected)
    assert html_text.extract(pages.limit(0)).count() == 0


def test_very_long_and_deep_pages():
    page = "<div>" * 3000 + "<p>x, y.</p>" * 3000
    assert html_text.main_text(page).count("\n") == 2999
