"""Elements without their end tag, and the text of formulas and examples."""

import pytest

from gradus.llm import html


@pytest.mark.parametrize("tag", ["object", "svg", "canvas", "audio", "video", "template", "iframe", "noframes"])
def test_reading_goes_on(tag):
    page = f"<p>one</p><{tag} class=x><p>two</p><{tag}><p>three</p>"
    assert [b.text for b in html.blocks(page)] == ["one", "two", "three"]
    assert [b.text for b in html.blocks(f"<p>one</p><{tag}>off</{tag}><p>two</p>")] == ["one", "two"]


def test_raw_text_reaches_the_end():
    assert [b.text for b in html.blocks("<p>one</p><script>two <p>three</p>")] == ["one"]


def test_formulas_and_examples_stay():
    page = "<p>one</p><math><mi>x</mi></math><xmp>two</xmp><p>three</p>"
    assert [b.text for b in html.blocks(page)] == ["one", "x", "two", "three"]
