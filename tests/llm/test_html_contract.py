"""Pages with optional tags, page-wide forms, and comments, adverts and notices by name."""

from __future__ import annotations

import pytest

from cardsentry.llm.html_text import main_text

ONE = "The harbour opened in spring, after a long winter, and the first ships came in at noon."
TWO = "People stood along the quay, cheered, and waited; nobody had seen so many sails before."
SAID = "I was there too, and it was cold, windy, loud, and quite wonderful, if you ask me today."


def test_head_needs_no_end_tag():
    page = f"<html><head><title>x</title><meta name=a><body><article><p>{ONE}</p><p>{TWO}</p></article>"
    assert main_text(page) == f"{ONE}\n{TWO}"
    assert main_text(f"<head><title>x</title><p>{ONE}</p><p>{TWO}</p>") == f"{ONE}\n{TWO}"
    assert main_text(f"<head><title>x</title>{ONE}") == ONE


def test_page_in_one_form():
    page = (f"<body><form action=x><input type=hidden name=state><div><p>{ONE}</p><p>{TWO}</p></div>"
            "</form></body>")
    assert main_text(page) == f"{ONE}\n{TWO}"


def test_forms_of_controls_go():
    form = "<form><label>Name</label><input name=a><label>Mail</label><input name=b></form>"
    assert main_text(f"<body><div><p>{ONE}</p><p>{TWO}</p>{form}</div></body>") == f"{ONE}\n{TWO}"
    assert main_text(f"<body>{form}</body>") == ""


@pytest.mark.parametrize("tag", [
    "section class=comments", "div id=comments", "div class=advert", "div class=newsletter",
    "div class='cookie-notice'", "div id=respond", "div class='sponsored box'"])
@pytest.mark.parametrize("inside", [True, False])
def test_named_regions_go(tag, inside):
    region = f"<{tag}><p>{SAID}</p><p>{SAID} {SAID}</p><p>{SAID}</p></{tag.split()[0]}>"
    post = f"<p>{ONE}</p><p>{TWO}</p>"
    page = f"<article>{post}{region}</article>" if inside else f"<div class=post>{post}</div>{region}"
    assert main_text(f"<html><body>{page}</body></html>") == f"{ONE}\n{TWO}"


def test_a_page_of_comments_is_empty_and_a_wrapper_is_no_region():
    assert main_text(f"<body><div class=comments><p>{SAID}</p><p>{ONE}</p></div></body>") == ""
    page = (f"<body><div class='post has-comments'><p>{ONE}</p><p>{TWO}</p>"
            f"<div class=comments><p>{SAID}</p></div></div></body>")
    assert main_text(page) == f"{ONE}\n{TWO}"
