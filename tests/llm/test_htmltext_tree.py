"""What the tree decides by: pages whose names are taken out, and pages whose names mislead."""

import random
import re
import time

import pytest

from snapmill.llm.htmltext import FEATURES, blocks, describe, is_main, labelled_blocks, learned, main_text

TREE = learned()


def used(node):
    return {node.feature} | used(node.left) | used(node.right) if node.feature >= 0 else set()


def text(odds, n):
    return " ".join(odds.choice(["some", "longer", "words", "of", "text"]) for _ in range(n))


def test_the_tree_fits_its_table_and_asks_words_links_and_neighbours():
    rows, labels = labelled_blocks()
    assert [is_main(TREE, row) for row in rows] == labels.astype(bool).tolist()
    asked = {FEATURES[f] for f in used(TREE)}
    assert {"words", "links", "words_before", "links_before", "words_after", "links_after", "link_run", "element_words", "main_share"} <= asked


def bare_page(odds, wrap):
    """A page with a menu, paragraphs, a list of links with a title, and a footer, none of it named."""
    menu = "".join(f"<{wrap}><a href=x>{text(odds, odds.randrange(1, 3))}</a></{wrap}>" for _ in range(odds.randrange(3, 8)))
    paragraphs = [text(odds, odds.randrange(25, 120)) for _ in range(odds.randrange(2, 9))]
    for _ in range(odds.randrange(2)):
        paragraphs.insert(odds.randrange(1, len(paragraphs)), text(odds, odds.randrange(4, 14)))
    body = "".join(f"<p>{p}</p>" for p in paragraphs)
    links = "".join(f"<li><a href=y>{text(odds, odds.randrange(2, 8))}</a>" for _ in range(odds.randrange(4, 9)))
    return f"<body>{menu}{body}<ul>{links}</ul><{wrap}>© 2024 {text(odds, 3)}</{wrap}>", "\n".join(paragraphs)


@pytest.mark.parametrize("wrap", ["div", "p", "li"])
def test_pages_without_any_names(wrap):
    odds = random.Random(wrap)
    for _ in range(100):
        page, want = bare_page(odds, wrap)
        assert main_text(page, TREE) == want


def test_pages_whose_attributes_are_taken_out():
    """Only the elements' own names are left."""
    odds = random.Random(2)
    for _ in range(100):
        paragraphs = [text(odds, odds.randrange(1, 80)) for _ in range(odds.randrange(2, 8))]
        page = (
            "<body><header class=top><div>Site</div></header><nav class=menu><a href=x>a</a></nav>"
            f"<div class=cookie>{text(odds, 14)}</div><article class=post>{''.join(f'<p class=text>{p}</p>' for p in paragraphs)}</article>"
            f"<div id=comments><p class=comment>{text(odds, 30)}</p></div><footer id=footer>f</footer>"
        )
        bare = re.sub(r" (class|id|role)=\w+", "", page)
        if sum(len(p.split()) for p in paragraphs) > 60:
            assert main_text(bare, TREE) == "\n".join(paragraphs)
        assert main_text(page, TREE) == "\n".join(paragraphs)


LONG = "a long paragraph without any link " * 13
MISLEADING = {
    "a word named as the text before the text": (f"<body><div class=story>Today</div><div><p>{LONG}</p><p>{LONG}</p></div>", ["Today", LONG, LONG]),
    "words that only begin like names": (
        f"<article><h1>Title here</h1><div class='legal-history'><p>{LONG}</p></div><div class=sponsor-free><p>{LONG}</p></div></article>",
        ["Title here", LONG, LONG],
    ),
    "long text under a weak name": (f"<article><p>{LONG}</p><div class=legal><p>{LONG}</p><p>{LONG}</p></div></article>", [LONG, LONG, LONG]),
    "a remark under a weak name": (f"<article><p>{LONG}</p><div class=legal><p>All rights reserved.</p></div><p>{LONG}</p></article>", [LONG, LONG]),
    "a menu in an article": (
        f"<article><p>{LONG}</p><ul>{'<li><a href=x>one more</a>' * 30}</ul><p>{LONG}</p></article>",
        [LONG, LONG],
    ),
    "one link in an article": (f"<article><p>{LONG}</p><p><a href=x>see this</a></p><p>{LONG}</p></article>", [LONG, "see this", LONG]),
    "formulas and objects": (
        "<article><p>The sum <math><mi>a</mi><mo>+</mo><mi>b</mi><annotation>a+b</annotation></math> is <object>shown</object> here.</p></article>",
        ["The sum a+b is shown here."],
    ),
    "names in two words": (
        f"<div class='page-header'>Top</div><div class='main-content'><p>{LONG}</p><div class='adBox'>Buy</div></div><div id=cookie_banner>{LONG}</div>",
        [LONG],
    ),
    "comments are none of the text": (f"<article><p>{LONG}</p></article><section id=comments><p>{LONG}</p><p>{LONG}</p></section>", [LONG]),
}


@pytest.mark.parametrize("name", MISLEADING)
def test_names_that_mislead(name):
    page, want = MISLEADING[name]
    assert main_text(page, TREE) == "\n".join(" ".join(w.split()) for w in want)


HOSTILE = {
    "ends without a start": lambda n: "<div>" * n + "</b>x" * n,
    "attributes without an end": lambda n: "<a href='" * n,
    "attributes without an end and a tag": lambda n: "<p>x</p>" + "<a href='" * n + "\"<p>y",
    "names without an end": lambda n: "<a" * n,
    "comments without an end": lambda n: "<p>x</p>" + "<!-- " * n,
    "starts without an end": lambda n: "<b>" * n + "<p>x</p>" * n,
    "declarations without an end": lambda n: "<!x" * n,
    "scripts without an end": lambda n: "<script>" * n,
    "character references": lambda n: "&amp;&#" * n,
}


@pytest.mark.parametrize("name", HOSTILE)
def test_broken_pages_take_linear_time(name):
    def seconds(n):
        began = time.process_time()
        blocks(HOSTILE[name](n))
        return time.process_time() - began

    seconds(1_000)
    small, large = min(seconds(20_000) for _ in range(2)), min(seconds(80_000) for _ in range(2))
    assert large < 10 * small + 0.2


def test_unclosed_comments_hide_the_rest():
    assert main_text("<article><p>shown</p><!-- hidden <p", TREE) == "shown"
    assert main_text("<article><p>a < b and <i c", TREE) == "a < b and <i c"


def test_features():
    found = blocks("<article><p>one two</p><p><a href=x>three</a></p><div class=legal><p>four five six</p></div></article><p>seven</p>")
    assert describe(found).tolist() == [
        [2, 0, 0, 0, 1, 1, 0, 0, 1, 0, 0, 2 / 3],
        [1, 1, 2, 0, 3, 0, 1, 0, 1, 0, 0, 2 / 3],
        [3, 0, 1, 1, 1, 0, 0, 0, 1, 1, 3, 2 / 3],
        [1, 0, 3, 0, 0, 0, 0, 0, 0, 0, 0, 2 / 3],
    ]
    assert describe([]).shape == (0, len(FEATURES))
