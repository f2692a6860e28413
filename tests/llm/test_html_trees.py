"""HTML extraction: article text that stays whole, link lists, and pages whose elements never close."""

import random
import time

import pytest

from strata.llm.html_extract import main_text

LONG = [f"Paragraph {i} of the article, which goes on for a while, with commas, and says {'more ' * 30}." for i in range(4)]
P = "".join(f"<p>{t}</p>" for t in LONG)
NAV = "<nav><ul><li><a href='/a'>Home</a><li><a href='/b'>News</a></ul></nav>"
LINKS = "<ul><li><a href='/x'>First source</a><li><a href='/y'>Second source</a><li><a href='/z'>Third source</a></ul>"


@pytest.mark.parametrize("body, end", [
    (f"<div class=content><div>{P}</div><div><p>Short closing remark here.</p></div></div>", ["Short closing remark here."]),
    (f"<div>{P}</div><div><p>A short second part.</p></div>", ["A short second part."]),
    (f"<div class=page><div><div><div>{P}</div></div></div><div><div><p>Deeper end.</p></div></div></div>", ["Deeper end."]),
    (f"<article>{P}</article><article><p>Another article.</p></article>", ["Another article."]),
    (f"<article>{P}{LINKS}</article>", ["First source", "Second source", "Third source"]),
    (f"<article>{P}<p><label>Labelled</label> text.</p></article>", ["Labelled text."]),
])
def test_no_text_of_the_article_is_lost(body, end):
    assert main_text(f"<html><body>{NAV}{body}<footer>Imprint</footer></body></html>").split("\n") == LONG + end


def test_the_header_of_an_article_is_part_of_it():
    page = f"<body><header><h1>Site</h1></header><article><header><h1>Title</h1></header>{P}</article></body>"
    assert main_text(page).split("\n") == ["Title", *LONG]


def test_menus_outside_the_article_go():
    for menu in (LINKS, f"<div>{LINKS}</div>", f"<section><a href=1>One</a> <a href=2>Two</a> <a href=3>Three</a></section>"):
        assert main_text(f"<body>{menu}<div>{P}</div>{menu}</body>").split("\n") == LONG
        assert main_text(f"<body><div>{menu}<div>{P}</div>{menu}</div></body>").split("\n") == LONG


@pytest.mark.parametrize("piece", ["<span>x</font>", "<font><div><span></font>", "<b><p>y</i>", "<ul><li><span></p>", "</div><span>"])
def test_elements_that_never_close_take_linear_time(piece):
    def seconds(n):
        started = time.process_time()
        main_text("<article><font>" + piece * n + "</article>")
        return time.process_time() - started

    seconds(500)
    assert seconds(8000) < 1.5


def plain_end(stack, tag):
    """The end tag rule by a walk over the open elements."""
    from strata.llm.html_extract import SCOPE
    for at in range(len(stack) - 1, -1, -1):
        if stack[at] == tag:
            return stack[:at]
        if stack[at] in SCOPE and tag not in SCOPE:
            break
    return stack


def plain_start(stack, tag):
    from strata.llm.html_extract import BLOCK, CLOSES, HEADINGS, SCOPE, VOID
    closing = CLOSES.get(tag, ())
    if tag in BLOCK:
        for at in range(len(stack) - 1, -1, -1):
            name = stack[at]
            if name == "p" or name in closing or (name in HEADINGS and tag in HEADINGS):
                stack = stack[:at]
                if name == "p" and closing:
                    continue
                break
            if name in SCOPE:
                break
    return stack if tag in VOID else [*stack, tag]


def test_open_elements_equal_a_walk_over_them():
    from strata.llm.html_extract import BLOCK, _Page
    rng, tags = random.Random(8), "p div li ul td tr table span b h1 h2 article dt dd dl section br".split()
    for _ in range(400):
        page, stack = _Page(), []
        for _ in range(rng.randint(1, 60)):
            tag = rng.choice(tags)
            if rng.random() < 0.6:
                page.handle_starttag(tag, [])
                stack = plain_start(stack, tag)
            else:
                page.handle_endtag(tag)
                stack = plain_end(stack, tag)
            assert [page.tag[n] for n in page.stack[1:]] == stack
            blocks = [i for i, t in enumerate(stack, 1) if t in BLOCK]
            assert page.holder() == page.stack[blocks[-1] if blocks else 0]
