"""Ratios choose the content; an article only helps where the content lies in it."""

from __future__ import annotations

from cardsentry.llm import html_text
from tests.llm.test_html_text import LONG


def test_teasers_in_articles_are_not_the_page():
    cards = "".join(f"<article><h3>Card {k}</h3><p>Read it</p></article>" for k in range(6))
    page = f"<body><div class=post><h1>Title</h1>{f'<p>{LONG}</p>' * 5}</div><div>{cards}</div>"
    assert html_text.main_text(page) == "\n".join(["Title", *[LONG] * 5])
    page = f"<body><div>{cards}</div><article><h1>Title</h1>{f'<p>{LONG}</p>' * 5}</article>"
    assert html_text.main_text(page).endswith("\n".join(["Title", *[LONG] * 5]))


def test_thin_blocks_between_content_go():
    thin = "".join(f"<div><div><span>item {k}</span></div></div>" for k in range(20))
    page = f"<body><div><p>{LONG}</p><p>Short.</p></div>{thin}<div><h2>Sub</h2><p>{LONG}</p></div>"
    assert html_text.main_text(page) == f"{LONG}\nShort.\nSub\n{LONG}"
