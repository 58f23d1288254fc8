"""Pages laid out by hand in ways the trained layouts do not spell out: which blocks the labeller takes for the article."""

from __future__ import annotations

import random

import pytest

from tablewright.llm import html_extraction

PAGES_A_LAYOUT = 30

MENU = "<nav><ul><li><a href=/>Home</a></li><li><a href=/n>News</a></li><li><a href=/c>Contact us</a></li></ul></nav>"
FOOT = "<footer><p>All rights reserved by the owners.</p><p><a href=/i>Imprint</a></p></footer>"
LISTED = "<ul>{}</ul>"
COMMENT = "I do not agree with the author here, this was done long before."

# Each layout is the page around {head} (a heading, a byline) and {body} (paragraphs, a list).
LAYOUTS = {
    "unnamed classes": MENU + "<div class=c1><div class=c2>{body}</div></div>" + FOOT,
    "bare paragraphs": "{body}",
    "bare paragraphs between menu and footer": MENU + "{body}" + FOOT,
    "heading in a plain div": MENU + "<div><h1>{head}</h1>{body}</div>" + FOOT,
    "header of the article": MENU + "<article><header><h1>{head}</h1><p>{by}</p></header>{body}</article>" + FOOT,
    "comments in the article": MENU + "<article><h1>{head}</h1>{body}<section class=comments><h3>2 replies</h3><p>{c}</p><p>{c}</p></section></article>" + FOOT,
    "comments under another id": MENU + "<main><h1>{head}</h1>{body}</main><div id=disqus><div class=reply>{c}</div><div class=reply>{c}</div></div>" + FOOT,
    "section with a made-up id": "<ul class=topmenu><li><a href=/>Start</a></li><li><a href=/b>Blog</a></li></ul><section id=zq7>"
    "<h2>{head}</h2>{body}</section><aside><h3>More</h3><p>Another story altogether.</p></aside>" + FOOT,
    "table layout": "<table><tr><td>{body}</td></tr></table>" + FOOT,
}


def varied(layout: str, number: int, sentences: list[str]) -> tuple[str, list[str]]:
    """A page of the layout and the blocks of its article."""
    chance = random.Random(f"{layout} {number}")
    head, by = " ".join(chance.choice(sentences).split()[:6]).rstrip("."), "By " + chance.choice(sentences).split()[0].rstrip(".")
    parts, wanted = [], []
    for _ in range(chance.randint(2, 6)):
        text = " ".join(chance.sample(sentences, chance.randint(1, 3)))
        parts.append(f"<p>{text}</p>")
        wanted.append(text)
    if chance.random() < 0.4:
        items = [" ".join(chance.choice(sentences).split()[:8]) for _ in range(3)]
        parts.append(LISTED.format("".join(f"<li>{x}</li>" for x in items)))
        wanted += items
    shown = LAYOUTS[layout]
    wanted = ([head] if "{head}" in shown else []) + ([by] if "{by}" in shown else []) + wanted
    return f"<html><head><title>x</title></head><body>{shown.format(head=head, by=by, body=''.join(parts), c=COMMENT)}</body></html>", wanted


@pytest.fixture(scope="module")
def labeller(spark, folder):
    return html_extraction.fit_labeller(spark.read.parquet(f"{folder}/pages.parquet"))


def shares(labeller, layout, sentences):
    extract = html_extraction.make_extractor(labeller)
    right = total = empty = 0
    pages = [varied(layout, n, sentences) for n in range(PAGES_A_LAYOUT)]
    for (page, wanted), found in zip(pages, extract([p for p, _ in pages])[0], strict=True):
        blocks = [b.text for b in html_extraction.blocks_of(page)]
        got = found.split("\n\n") if found else []
        total += len(blocks)
        right += sum((b in wanted) == (b in got) for b in blocks)
        empty += not got
    return right / total, empty


@pytest.mark.parametrize("layout", LAYOUTS)
def test_blocks_of_a_layout(spark, folder, labeller, layout):
    pages = spark.read.parquet(f"{folder}/pages.parquet").limit(40).collect()
    sentences = sorted({s.strip() + "." for r in pages for b in html_extraction.blocks_of(r.html) for s in b.text.split(".") if len(s.split()) > 4})
    share, empty = shares(labeller, layout, sentences)
    assert empty == 0
    assert share >= 0.95, share
