"""Parts of a page that no reader sees, and layouts written by hand, unlike those of the training."""

import pytest

from gradus.llm import base, html


@pytest.fixture(scope="module")
def model(spark, sf):
    return html.train_page_model(base.table(spark, sf, "pages"))


ARTICLE = "<article><h1>A walk by the river</h1><p>The path follows the water for an hour and ends at a mill.</p>{}<p>Bring shoes that may get wet, and something to drink.</p></article>"
TEXT = "A walk by the river\nThe path follows the water for an hour and ends at a mill.\nBring shoes that may get wet, and something to drink."


@pytest.mark.parametrize(
    "part",
    [
        "<noscript>Please enable scripts to read on with all pictures of the walk.</noscript>",
        "<p hidden>This line is for later use by the editors of the page.</p>",
        "<div style='color:red; display: none'><p>Shown to nobody who reads this page today.</p></div>",
        "<div aria-hidden=true>An ornament in words that only some programs see.</div>",
    ],
)
def test_hidden_parts_are_left_out(model, part):
    assert html.extract(ARTICLE.format(part), model) == TEXT
    assert html.extract("<body>" + part + ARTICLE.format("") + "</body>", model) == TEXT


def test_a_page_hidden_until_it_is_loaded(model):
    assert html.extract("<body style='display:none'>" + ARTICLE.format("") + "</body>", model) == TEXT
    assert html.extract(ARTICLE.format("<p hidden=false>Seen.</p>"), model).count("\n") == 3


# Pages of other make: what belongs to the text stands after a bar.
LAYOUTS = [
    """<html><body><div class="topbar"><a href=/>Start</a> <a href=/map>Map</a> <a href=/team>Team</a></div>
    <div class="story-body"><h2>|Bread from the village oven</h2><p>|Every second Friday the oven is lit at five in the morning, and by noon the first loaves are ready.</p>
    <p>|Those who bring their own dough pay a small sum for the wood, nothing more.</p></div>
    <div class="sidebar"><h3>Popular</h3><ul><li><a href=1>Ten soups</a></li><li><a href=2>Old mills</a></li></ul></div>
    <div class="footer">Copyright 2019. All rights reserved. <a href=/imprint>Imprint</a></div></body></html>""",
    """<body><header><a href=/>Log in</a></header><main><section id="content"><h1>|How the bridge was moved</h1>
    <p>|In the spring of that year the old bridge was lifted off its piers and carried down the valley.</p>
    <blockquote>|We had one day, said the engineer, and we needed two of them.</blockquote><p>|It stands there still, between the school and the mill.</p></section>
    <section class="comments"><h3>3 comments</h3><p>Great read, thanks a lot for this!</p><p>My uncle was there that day.</p></section></main>
    <form class="newsletter"><label>Your mail</label><button>Subscribe</button></form></body>""",
    """<table><tr><td class="menu"><a href=a>News</a><br><a href=b>Sport</a><br><a href=c>Weather</a></td>
    <td class="main"><h1>|Rain at last</h1><p>|After nine dry weeks the first rain fell on the hills on Tuesday night, and the wells began to fill.</p>
    <p>|Farmers hope for more of it before the month is over, as the fields are still hard.</p></td></tr></table><div class="cookie-notice">We use cookies. <button>Accept</button></div>""",
]


def test_layouts_of_other_make(model):
    wrong = total = 0
    for page in LAYOUTS:
        found = list(html.blocks(page))
        for block, kept in zip(found, model.decode(found)):
            total += 1
            wrong += kept != block.text.startswith("|")
    assert total == 26 and wrong <= 0.1 * total, (wrong, total)
