import html
import random

import pytest

from snapmill.llm.htmltext import blocks, extract, is_main, labelled_blocks, learned, main_text

TREE = learned()

PAGES = {
    "marked": (
        "<!doctype html><html><head><title>T</title><style>p{}</style><script>var a='</p><article>x';</script></head><body>"
        "<header><h1>Site</h1></header><nav><ul><li><a href=/>Home</a><li><a href=/a>About</a></ul></nav>"
        "<div class='cookie-notice'>We use cookies, and hope that you agree with all that this means for you.</div>"
        "<!-- <p>hidden</p> --><article><header><h1>Head &amp; line</h1></header><p>First&nbsp;<b>bold</b>er\n text.<p>Second<br>line"
        "<aside>Side</aside><form><label>Name<input></label><button>Go</button></form><ul><li>one<li>two</ul></article>"
        "<section id=comments><article class=comment><p>I liked this piece very much and read all of it.</p></article></section>"
        "<div class=sidebar><p>Popular</p></div><footer>&copy; 2024</footer></body></html>",
        "Head & line\nFirst bolder text.\nSecond line\none\ntwo",
    ),
    "named": (
        "<body><div id='page-header'>Top</div><div class='main-content has-sidebar'><h2>T</h2><p>Text a</p><div class=ad>Buy now</div>"
        "<p>Text b &lt;x&gt; &eacute;</p></div><div id=sidebar><p>more</p></div>",
        "T\nText a\nText b <x> é",
    ),
    "unmarked": (
        "<body><div><a href=/>Home</a></div><div><a href=/b>About us</a></div><div><p>" + "word " * 30 + "</p><p>Short.</p><p>"
        + "more " * 40 + "</p></div><div><a href=1>One</a> <a href=2>Two</a></div></body>",
        "word " * 29 + "word\nShort.\n" + "more " * 39 + "more",
    ),
    "unclosed": ("<div class=ad>Buy<div><article><p><b>One<br><p>Two <a href=x>link</p><p>Three", "One\nTwo link\nThree"),
    "text only": ("just text", "just text"),
    "nothing": ("", ""),
    "null": (None, ""),
    "broken tags": ("<p>a < b and <i c", "a < b and <i c"),
}


@pytest.mark.parametrize("name", PAGES)
def test_pages(name):
    page, text = PAGES[name]
    assert main_text(page, TREE) == text


def test_tree_fits_its_table():
    rows, labels = labelled_blocks()
    wrong = sum(is_main(TREE, row) != bool(label) for row, label in zip(rows, labels))
    assert wrong <= 0.05 * len(labels)


def test_generated_articles_come_back_whole(spark):
    odds = random.Random(4)
    rows, want = [], []
    for i in range(60):
        paragraphs = [" ".join(odds.choice(["a", "b&c", "<d>", "été"]) for _ in range(odds.randrange(1, 60))) for _ in range(odds.randrange(6))]
        body = "".join(f"<p>{html.escape(p)}</p>" for p in paragraphs)
        page = f"<body><nav><a href=x>m</a></nav><{(t := odds.choice(['article', 'main']))}>{body}</{t}><footer>f</footer>"
        rows.append((i if i % 7 else None, None if i % 5 else "u", page, "extra"))
        want.append((rows[-1][0], rows[-1][1], "\n".join(paragraphs)))
    rows += [(99, "u", None, None), (99, "u", None, None)]
    want += [(99, "u", "")] * 2
    df = extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string"))
    assert df.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted(map(repr, map(tuple, df.collect()))) == sorted(repr((*w, len(w[2]))) for w in want)
    assert extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_long_pages_and_deep_ones_take_linear_time():
    assert len(blocks("<p>x</p>" * 50_000)) == 50_000
    assert main_text("<div>" * 5_000 + "deep" + "</div>" * 5_000, TREE) == "deep"
    assert main_text("<a href='" * 3_000, TREE) is not None
