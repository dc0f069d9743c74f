"""Attributes and class names that only look like those of page furniture."""

from __future__ import annotations

import pytest

from cardsentry.llm import html_text
from tests.llm.test_html_text import LONG


@pytest.mark.parametrize("attribute", [
    "style='overflow:hidden'", "class='overflow-hidden'", "class='lg:hidden'", "hidden=false",
    "data-x='display:none'", "title='a hidden thing'"])
@pytest.mark.parametrize("element", ["body", "article", "div"])
def test_visible_elements_stay(attribute, element):
    assert html_text.main_text(f"<{element} {attribute}><p>{LONG}</p><p>{LONG}</p>") == f"{LONG}\n{LONG}"


@pytest.mark.parametrize("attribute", ["hidden", "HIDDEN=''", "style='color:red; display : none'"])
def test_hidden_elements_go(attribute):
    assert html_text.main_text(f"<article><p>{LONG}</p><p {attribute}>{LONG} x</p></article>") == LONG


@pytest.mark.parametrize("name", ["discussion", "legal", "notice", "related", "search", "alert", "banner"])
def test_dense_sections_of_any_name_stay(name):
    page = (f"<article><h1>Title</h1>{f'<p>{LONG}</p>' * 6}<section class='{name}'><h2>Sub</h2><p>{LONG}</p>"
            f"<p>{LONG}</p></section><div class='{name}'><a href=x>More</a> of it</div></article>")
    assert html_text.main_text(page) == "\n".join(["Title", *[LONG] * 6, "Sub", LONG, LONG])
