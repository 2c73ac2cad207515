"""Main text of web pages, from flat text blocks that a decision tree classifies.

A page is read as a flat list of text blocks. A block has the number of its words and the share of
them in links, the same of the blocks before and after it, how many blocks of mere links it is among,
and what the elements around it are called. What an element is called says little by itself: names
of forms and comments are told from names that may mislead, and a name counts with the words that the element
holds and with the share of the page's text that is named as such. A decision tree, grown from a
small table of labelled pages, says which blocks are main text.
"""

from __future__ import annotations

import html as references
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from snapmill.llm.common import bound_batches

# Names of elements, and words in class, id and role that tell what an element is.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q ruby rb rp rt s samp "
    "small span strike strong sub sup time tt u var wbr object map svg canvas audio video "
    "math semantics mrow mi mn mo ms mtext mspace mfrac msqrt mroot msub msup msubsup munder mover munderover "
    "mmultiscripts mpadded mphantom mstyle menclose mfenced merror annotation annotation-xml".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
SKIPPED = frozenset(
    "script style textarea title xmp iframe noembed noframes noscript template svg annotation annotation-xml select "
    "option button canvas audio video datalist head".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ASIDE_TAGS = frozenset("nav footer aside form dialog menu".split())
MAIN_TAGS = frozenset("article main".split())
#: Names of what no main text is called.
STRONG_WORDS = frozenset(
    "nav navbar navigation menu menubar footer sidebar aside widget widgets ad ads adv advert adverts advertisement "
    "advertisements advertising adbox adsense cookie cookies consent gdpr popup modal overlay search login signup signin "
    "newsletter subscribe subscription comment comments commentlist disqus reply replies respond breadcrumb breadcrumbs "
    "pagination pager copyright toolbar contentinfo complementary".split()
)
#: Names that main text may have too.
WEAK_WORDS = frozenset(
    "rail sponsor sponsored promo promotion notice notices alert alerts form discussion share sharing social related "
    "recommended recommendations tags legal disclaimer skip".split()
)
HEAD_WORDS = frozenset("header masthead topbar banner banners hero".split())
MAIN_WORDS = frozenset("article main content maincontent post entry story body text articlebody".split())
#: Words that name a place or a part; with them a name in several words means what its others mean.
PART_WORDS = frozenset(
    "page site web top bottom left right center box block wrap wrapper container inner outer area bar list item section "
    "col column row primary secondary global group holder panel pane region zone view full single big small".split()
)

TAG = re.compile(
    r"<!--.*?(?:-->|$)|<[!?][^>]*+>|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)"
    r"(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|[^>]*+>)",
    re.S,
)
HINTS = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)
WORDS_OF = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")

#: What elements are named as: nothing, as beside the text by a weak or a strong name, as the text.
NOTHING, WEAK, STRONG, MAIN = 0, 1, 2, 3


@dataclass
class Block:
    """A text block; ``aside`` is the strongest name beside the text around it and ``element`` the number
    of the outermost element with that; ``main`` whether it is within what is named as the text."""

    text: str
    words: int
    linked: int
    main: bool
    aside: int
    element: int
    heading: bool


def _role(name: str, rest: str, in_main: bool) -> int:
    """What an element is named as. What heads the page is beside the text, what heads the text belongs to it.

    A name counts as a whole: ``legal`` and ``legal-box`` do, ``legal-history`` does not.
    """
    if name in ASIDE_TAGS or name == "header" and not in_main:
        return STRONG
    found = MAIN if name in MAIN_TAGS else NOTHING
    if name in ("html", "body"):
        return found
    for value in HINTS.findall(rest):
        for token in value.strip("\"'").split():
            words = {w.lower() for w in WORDS_OF.findall(token)}
            strong, weak, head, main = (words & known for known in (STRONG_WORDS, WEAK_WORDS, HEAD_WORDS, MAIN_WORDS))
            if words - PART_WORDS - strong - weak - head - main:
                continue
            if strong or head and not (in_main or main):
                return STRONG
            if weak:
                found = WEAK
            elif main and found != WEAK:
                found = MAIN
    return found


def blocks(page: str) -> list[Block]:
    """The text blocks of a page in order, white space and character references resolved."""
    out: list[Block] = []
    open_elements: list[tuple[str, tuple]] = []  # name and what holds inside it
    open_names: Counter = Counter()
    pieces: list[tuple[str, bool]] = []
    nowhere = (False, NOTHING, 0)
    at, linked, inside, heading, skipping, seen_main, elements = 0, False, nowhere, False, 0, False, 0
    last_tag = page.rfind(">")

    def flush() -> None:
        if pieces:
            text = " ".join("".join(p for p, _ in pieces).split())
            if text:
                words = len(text.split())
                in_links = sum(len(p.split()) for p, link in pieces if link)
                out.append(Block(text, words, min(words, in_links), *inside, heading))
            pieces.clear()

    def add(text: str) -> None:
        if text and not skipping:
            pieces.append((references.unescape(text) if "&" in text else text, linked))

    def close(name: str) -> None:
        nonlocal inside, heading, skipping, linked
        if open_names[name]:
            for k in range(len(open_elements) - 1, -1, -1):
                if open_elements[k][0] == name:
                    for closed, _ in open_elements[k:]:
                        open_names[closed] -= 1
                        skipping -= closed in SKIPPED
                        linked = linked and closed != "a"
                    del open_elements[k:]
                    break
        inside = open_elements[-1][1] if open_elements else nowhere
        heading = any(n in HEADINGS for n, _ in open_elements[-3:])

    # Behind the last end of a tag there are no tags, however many begin.
    while at <= last_tag and (m := TAG.search(page, at)):
        add(page[at : m.start()])
        at = m.end()
        name = (m["name"] or "").lower()
        if not name:
            continue
        if name not in INLINE:
            flush()
        elif name == "br":
            add(" ")
        if m["end"]:
            close(name)
            continue
        if name == "body":
            close("head")
        if name in VOID or m["rest"].endswith("/>") and name in SKIPPED:
            continue
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(page, at)
            at = end.start() if end else len(page)
        elif name in ("p", "li", "option", "td", "th", "tr", "dt", "dd", "a") or name in HEADINGS:
            # Elements that end where the next of their kind starts, or a block does.
            top = [n for n, _ in open_elements[-2:]]
            if name in top and name != "tr":
                close(name)
            elif name != "a" and "p" in top:
                close("p")
        main, aside, element = inside
        role = NOTHING if name in INLINE else _role(name, m["rest"], main and not aside)
        if name in MAIN_TAGS and role == MAIN and not seen_main:
            inside = (True, NOTHING, 0)  # the first article is main text even where something before it was not closed
        elif role in (WEAK, STRONG) and role > aside:
            elements += 1
            inside = (main, role, elements)
        elif role == MAIN and not aside:
            inside = (True, NOTHING, 0)
        seen_main = seen_main or inside[0]
        open_elements.append((name, inside))
        open_names[name] += 1
        skipping += name in SKIPPED
        linked = linked or name == "a"
        heading = heading or name in HEADINGS
    rest = page[at:].partition("<!--")[0] if at > last_tag else page[at:]
    add(rest)
    flush()
    return out


FEATURES = (
    "words", "links", "words_before", "links_before", "words_after", "links_after", "link_run", "heading",
    "main", "aside", "element_words", "main_share",
)
#: Share of linked words from which a block is mere links; words from which a neighbour is just long.
MERE_LINKS, LONG_NEIGHBOUR = 0.9, 25


def describe(found: list[Block]) -> np.ndarray:
    """A row of FEATURES for each block; beyond the ends there are blocks without words.

    ``link_run`` is the number of blocks of mere links in a row that a block is one of, ``element_words``
    the unlinked words of the element whose name puts the block beside the text, ``main_share`` the
    share of the page's unlinked words under no such name that are within what is named as the text.
    """
    if not found:
        return np.empty((0, len(FEATURES)))
    words = np.array([0, *(b.words for b in found), 0], float)
    linked = np.array([0, *(b.linked for b in found), 0], float)
    links = linked / np.maximum(words, 1)
    plain = (words - linked)[1:-1]
    main, aside, element = (np.array([getattr(b, name) for b in found]) for name in ("main", "aside", "element"))
    mere = links[1:-1] >= MERE_LINKS
    run = np.cumsum(np.concatenate(([True], mere[1:] != mere[:-1]))) - 1
    link_run = np.where(mere, np.bincount(run)[run], 0)
    element_words = np.where(aside > 0, np.bincount(element, plain)[element], 0)
    free = plain[aside == 0].sum()
    main_share = plain[(aside == 0) & main].sum() / free if free else float(main.any())
    near = np.minimum(words, LONG_NEIGHBOUR)
    return np.column_stack(
        [words[1:-1], links[1:-1], near[:-2], links[:-2], near[2:], links[2:], link_run]
        + [[b.heading for b in found], main, aside, element_words, np.full(len(found), main_share)]
    ).astype(float)


# The decision tree


@dataclass
class Node:
    """A split (at most ``limit`` goes left), or a leaf with the share of main text."""

    share: float
    feature: int = -1
    limit: float = 0.0
    left: Node | None = None
    right: Node | None = None


def grow(rows: np.ndarray, labels: np.ndarray, depth: int = 10, least: int = 2) -> Node:
    """A tree that splits where the Gini impurity falls most; ties go to the first feature and limit."""
    node = Node(float(labels.mean()))
    if depth == 0 or node.share in (0.0, 1.0):
        return node
    best = len(labels) * node.share * (1 - node.share) - 1e-9
    for feature in range(rows.shape[1]):
        values = np.unique(rows[:, feature])
        for limit in (values[1:] + values[:-1]) / 2:
            below = rows[:, feature] <= limit
            sides = labels[below], labels[~below]
            if min(map(len, sides)) < least:
                continue
            impurity = sum(len(s) * s.mean() * (1 - s.mean()) for s in sides)
            if impurity < best:
                best, node.feature, node.limit = impurity, feature, float(limit)
    if node.feature >= 0:
        below = rows[:, node.feature] <= node.limit
        node.left = grow(rows[below], labels[below], depth - 1, least)
        node.right = grow(rows[~below], labels[~below], depth - 1, least)
    return node


def is_main(node: Node, row: np.ndarray) -> bool:
    while node.feature >= 0:
        node = node.left if row[node.feature] <= node.limit else node.right
    return node.share > 0.5


#: Places of labelled blocks: within what is named as the text or not, and the name beside the text around them.
FREE, TEXT = (False, NOTHING), (True, NOTHING)
BESIDE, PERHAPS, BESIDE_TEXT, PERHAPS_TEXT = (False, STRONG), (False, WEAK), (True, STRONG), (True, WEAK)

#: Labelled pages. Of each block: words, words in links, place, whether a heading, and whether main text.
#: Blocks of equal place in a row are in one element.
LABELLED = [
    # menus, an advert, an article with links in its text and a short list, comments, a footer
    [(1, 1, BESIDE, 0, 0), (2, 2, BESIDE, 0, 0), (1, 1, BESIDE, 0, 0), (14, 0, BESIDE, 0, 0), (8, 0, TEXT, 1, 1),
     (60, 0, TEXT, 0, 1), (45, 9, TEXT, 0, 1), (1, 0, TEXT, 0, 1), (90, 0, TEXT, 0, 1), (3, 3, TEXT, 0, 1),
     (6, 0, TEXT, 1, 1), (20, 4, TEXT, 0, 1), (6, 3, TEXT, 0, 1), (3, 0, BESIDE, 1, 0), (22, 0, BESIDE, 0, 0),
     (95, 0, BESIDE, 0, 0), (4, 2, BESIDE, 0, 0), (10, 0, BESIDE, 0, 0)],
    # an article of short paragraphs, one of them a link, another two
    [(3, 3, BESIDE, 0, 0), (6, 0, BESIDE, 0, 0), (5, 0, TEXT, 1, 1), (2, 0, TEXT, 0, 1), (2, 2, TEXT, 0, 1),
     (7, 0, TEXT, 0, 1), (1, 1, TEXT, 0, 1), (1, 1, TEXT, 0, 1), (12, 0, TEXT, 0, 1), (9, 0, BESIDE, 0, 0)],
    # an article that holds a form, an advert and a long list of links
    [(9, 0, TEXT, 1, 1), (70, 0, TEXT, 0, 1), (12, 0, BESIDE_TEXT, 0, 0), (4, 0, BESIDE_TEXT, 0, 0), (50, 2, TEXT, 0, 1),
     (2, 2, TEXT, 0, 0), (3, 3, TEXT, 0, 0), (2, 2, TEXT, 0, 0), (1, 1, TEXT, 0, 0), (4, 4, TEXT, 0, 0), (3, 3, TEXT, 0, 0),
     (30, 0, TEXT, 0, 1), (5, 5, BESIDE, 0, 0), (8, 2, BESIDE, 0, 0)],
    # an article that is all links but for its first lines
    [(6, 0, TEXT, 1, 1), (40, 0, TEXT, 0, 1), (2, 2, TEXT, 0, 0), (2, 2, TEXT, 0, 0), (5, 5, TEXT, 0, 0), (2, 2, TEXT, 0, 0),
     (1, 1, TEXT, 0, 0)],
    # names that mislead: long text under names like legal or sponsor, in an article and without one
    [(7, 0, TEXT, 1, 1), (55, 0, TEXT, 0, 1), (80, 0, PERHAPS_TEXT, 0, 1), (65, 3, PERHAPS_TEXT, 0, 1), (40, 0, TEXT, 0, 1),
     (9, 0, PERHAPS_TEXT, 0, 0), (35, 0, TEXT, 0, 1), (5, 0, PERHAPS_TEXT, 0, 0), (2, 2, PERHAPS_TEXT, 0, 0)],
    [(2, 2, FREE, 0, 0), (1, 1, FREE, 0, 0), (5, 0, PERHAPS, 1, 1), (120, 0, PERHAPS, 0, 1), (85, 0, PERHAPS, 0, 1),
     (6, 0, PERHAPS, 0, 1), (70, 0, PERHAPS, 0, 1), (1, 1, BESIDE, 0, 0), (4, 0, BESIDE, 0, 0)],
    # the same names around what is beside the text indeed
    [(15, 0, PERHAPS, 0, 0), (2, 2, PERHAPS, 0, 0), (8, 0, TEXT, 1, 1), (75, 0, TEXT, 0, 1), (30, 0, TEXT, 0, 1),
     (3, 0, PERHAPS, 1, 0), (4, 4, PERHAPS, 0, 0), (5, 5, PERHAPS, 0, 0), (25, 2, PERHAPS, 0, 0)],
    [(22, 0, PERHAPS, 0, 0), (1, 1, BESIDE, 0, 0), (60, 0, FREE, 0, 1), (45, 0, FREE, 0, 1), (10, 0, PERHAPS, 0, 0)],
    # one word named as the text before or beside the text itself
    [(1, 1, FREE, 0, 0), (1, 1, FREE, 0, 0), (1, 0, TEXT, 0, 1), (80, 0, FREE, 0, 1), (80, 0, FREE, 0, 1), (6, 6, FREE, 0, 0)],
    [(6, 0, FREE, 1, 1), (90, 0, FREE, 0, 1), (3, 0, TEXT, 0, 1), (70, 0, FREE, 0, 1), (4, 0, FREE, 0, 1), (50, 0, FREE, 0, 1)],
    # text outside of what is the text
    [(15, 0, FREE, 0, 0), (2, 2, FREE, 0, 0), (7, 0, TEXT, 1, 1), (65, 0, TEXT, 0, 1), (50, 0, TEXT, 0, 1), (80, 0, TEXT, 0, 1),
     (6, 0, FREE, 1, 0), (35, 0, FREE, 0, 0), (60, 0, FREE, 0, 0), (5, 0, FREE, 0, 0)],
    [(12, 0, FREE, 0, 0), (5, 0, TEXT, 1, 1), (6, 0, TEXT, 0, 1), (9, 0, TEXT, 0, 1), (10, 0, FREE, 0, 0)],
    # nothing is named: menu, title, text with short lines, a footer
    [(1, 1, FREE, 0, 0), (2, 2, FREE, 0, 0), (1, 1, FREE, 0, 0), (8, 0, FREE, 1, 1), (70, 0, FREE, 0, 1), (3, 0, FREE, 0, 1),
     (65, 3, FREE, 0, 1), (18, 0, FREE, 0, 1), (30, 0, FREE, 0, 1), (6, 0, FREE, 1, 1), (55, 0, FREE, 0, 1), (4, 4, FREE, 0, 0),
     (3, 3, FREE, 0, 0), (4, 0, FREE, 0, 0)],
    # a notice among links, a teaser list, text, links to other pages with a title
    [(2, 2, FREE, 0, 0), (9, 0, FREE, 0, 0), (1, 1, FREE, 0, 0), (2, 2, FREE, 0, 0), (50, 0, FREE, 0, 1), (25, 0, FREE, 0, 1),
     (48, 6, FREE, 0, 1), (2, 0, FREE, 1, 0), (6, 6, FREE, 0, 0), (7, 7, FREE, 0, 0), (9, 6, FREE, 0, 0), (10, 8, FREE, 0, 0),
     (6, 1, FREE, 0, 0)],
    [(3, 3, FREE, 0, 0), (5, 0, FREE, 0, 0), (1, 1, FREE, 0, 0), (22, 0, FREE, 0, 1), (35, 1, FREE, 0, 1), (16, 0, FREE, 0, 1),
     (3, 3, FREE, 0, 0), (5, 0, FREE, 0, 0), (2, 2, FREE, 0, 0)],
    # half of a long block in links, and a link between two paragraphs
    [(40, 0, FREE, 0, 1), (30, 22, FREE, 0, 0), (2, 0, FREE, 1, 1), (60, 0, FREE, 0, 1), (5, 5, FREE, 0, 0), (45, 0, FREE, 0, 1)],
    # short last paragraphs, with little or nothing behind them
    [(1, 1, BESIDE, 0, 0), (5, 0, TEXT, 1, 1), (60, 0, TEXT, 0, 1), (8, 0, TEXT, 0, 1)],
    [(40, 0, TEXT, 0, 1), (12, 0, TEXT, 0, 1), (1, 0, BESIDE, 0, 0)],
    [(2, 2, BESIDE, 0, 0), (30, 0, TEXT, 0, 1), (20, 0, TEXT, 0, 1), (3, 0, TEXT, 0, 1), (2, 0, BESIDE, 0, 0), (9, 0, BESIDE, 0, 0)],
    [(22, 3, TEXT, 0, 1), (18, 0, TEXT, 0, 1), (2, 0, TEXT, 0, 1), (1, 1, BESIDE, 0, 0)],
    [(1, 1, FREE, 0, 0), (60, 0, FREE, 0, 1), (40, 0, FREE, 0, 1), (9, 0, FREE, 0, 1)],
    [(45, 0, FREE, 0, 1), (10, 0, FREE, 0, 1), (2, 2, FREE, 0, 0), (1, 1, FREE, 0, 0), (5, 0, FREE, 0, 0)],
    # articles of paragraphs of all lengths, and the same without any names
    [(2, 2, BESIDE, 0, 0), (9, 0, BESIDE, 0, 0), (10, 0, TEXT, 1, 1), (60, 0, TEXT, 0, 1), (10, 0, TEXT, 0, 1), (70, 0, TEXT, 0, 1),
     (14, 0, TEXT, 0, 1), (5, 0, TEXT, 0, 1), (9, 0, TEXT, 0, 1), (80, 0, TEXT, 0, 1), (7, 0, TEXT, 0, 1), (12, 0, TEXT, 0, 1),
     (30, 0, TEXT, 0, 1), (16, 2, TEXT, 0, 1), (40, 0, TEXT, 0, 1), (6, 0, TEXT, 0, 1), (11, 0, BESIDE, 0, 0)],
    [(15, 0, FREE, 0, 0), (4, 0, TEXT, 1, 1), (35, 0, TEXT, 0, 1), (17, 0, TEXT, 0, 1), (8, 0, TEXT, 0, 1), (50, 0, TEXT, 0, 1),
     (13, 0, TEXT, 0, 1), (90, 0, TEXT, 0, 1), (6, 0, TEXT, 0, 1), (28, 0, TEXT, 0, 1), (9, 0, FREE, 0, 0), (24, 0, FREE, 0, 0)],
    [(2, 2, FREE, 0, 0), (1, 1, FREE, 0, 0), (10, 0, FREE, 1, 1), (60, 0, FREE, 0, 1), (10, 0, FREE, 0, 1), (70, 0, FREE, 0, 1),
     (14, 0, FREE, 0, 1), (5, 0, FREE, 0, 1), (9, 0, FREE, 0, 1), (80, 0, FREE, 0, 1), (7, 0, FREE, 0, 1), (12, 0, FREE, 0, 1),
     (30, 0, FREE, 0, 1), (16, 2, FREE, 0, 1), (40, 0, FREE, 0, 1), (2, 2, FREE, 0, 0), (1, 1, FREE, 0, 0), (6, 0, FREE, 0, 0)],
    # words among links: teasers and lists of pages are none of the text
    [(1, 1, FREE, 0, 0), (6, 2, FREE, 0, 0), (4, 4, FREE, 0, 0), (5, 0, FREE, 0, 0), (4, 4, FREE, 0, 0), (7, 0, FREE, 0, 0), (6, 6, FREE, 0, 0),
     (30, 0, FREE, 0, 1), (35, 0, FREE, 0, 1), (3, 3, FREE, 0, 0), (8, 0, FREE, 0, 0), (3, 3, FREE, 0, 0)],
    # the title of a list of links, and a line that leads to a paragraph
    [(50, 0, FREE, 0, 1), (3, 0, FREE, 0, 0), (5, 5, FREE, 0, 0), (6, 6, FREE, 0, 0), (4, 4, FREE, 0, 0), (7, 7, FREE, 0, 0)],
    [(8, 0, FREE, 1, 1), (30, 0, FREE, 0, 1), (4, 0, FREE, 0, 1), (60, 2, FREE, 0, 1), (2, 0, FREE, 0, 0), (4, 4, FREE, 0, 0), (4, 4, FREE, 0, 0)],
    [(2, 2, FREE, 0, 0), (70, 0, FREE, 0, 1), (30, 0, FREE, 0, 1), (3, 0, FREE, 1, 0), (9, 9, FREE, 0, 0), (11, 11, FREE, 0, 0),
     (8, 8, FREE, 0, 0), (12, 12, FREE, 0, 0), (4, 0, FREE, 0, 0)],
    [(5, 0, FREE, 0, 0), (10, 10, FREE, 0, 0), (12, 12, FREE, 0, 0), (9, 9, FREE, 0, 0), (60, 0, FREE, 0, 1), (45, 0, FREE, 0, 1),
     (6, 0, FREE, 0, 0), (14, 14, FREE, 0, 0), (10, 10, FREE, 0, 0), (16, 13, FREE, 0, 0)],
    # a misleading name around many paragraphs, short ones too; the same name around a remark
    [(60, 0, TEXT, 0, 1), (15, 0, PERHAPS_TEXT, 0, 1), (80, 0, PERHAPS_TEXT, 0, 1), (18, 0, PERHAPS_TEXT, 0, 1),
     (60, 0, PERHAPS_TEXT, 0, 1), (6, 0, PERHAPS_TEXT, 0, 1), (90, 0, PERHAPS_TEXT, 0, 1), (40, 0, TEXT, 0, 1)],
    [(50, 0, TEXT, 0, 1), (15, 0, PERHAPS_TEXT, 0, 0), (45, 0, TEXT, 0, 1), (17, 0, PERHAPS_TEXT, 0, 0), (6, 0, PERHAPS_TEXT, 0, 0), (30, 0, TEXT, 0, 1)],
    [(70, 0, TEXT, 0, 1), (75, 0, PERHAPS_TEXT, 0, 1), (60, 0, PERHAPS_TEXT, 0, 1)],
    [(65, 0, PERHAPS_TEXT, 0, 1), (70, 0, PERHAPS_TEXT, 0, 1), (30, 0, TEXT, 0, 1), (4, 0, PERHAPS_TEXT, 0, 0)],
    [(20, 0, PERHAPS, 0, 0), (8, 0, PERHAPS, 0, 0), (70, 0, TEXT, 0, 1), (14, 0, TEXT, 0, 1), (26, 0, PERHAPS, 0, 0), (3, 3, PERHAPS, 0, 0)],
    # links next to paragraphs: one or two are part of the text, more are a menu
    [(75, 0, TEXT, 0, 1), (2, 2, TEXT, 0, 1), (70, 0, TEXT, 0, 1), (9, 0, TEXT, 0, 1), (1, 1, TEXT, 0, 1), (30, 0, TEXT, 0, 1), (4, 4, TEXT, 0, 1)],
    [(30, 0, TEXT, 0, 1), (3, 3, TEXT, 0, 1), (3, 3, TEXT, 0, 1), (8, 0, TEXT, 0, 1), (1, 1, TEXT, 0, 1), (40, 0, TEXT, 0, 1), (12, 0, TEXT, 0, 1)],
    [(80, 0, TEXT, 0, 1), (2, 2, TEXT, 0, 0), (2, 2, TEXT, 0, 0), (2, 2, TEXT, 0, 0), (2, 2, TEXT, 0, 0), (2, 2, TEXT, 0, 0), (75, 0, TEXT, 0, 1)],
    [(70, 0, TEXT, 0, 1), (10, 0, TEXT, 0, 1), (3, 3, TEXT, 0, 0), (4, 4, TEXT, 0, 0), (2, 2, TEXT, 0, 0), (2, 2, TEXT, 0, 0), (6, 0, BESIDE, 0, 0)],
    [(60, 0, FREE, 0, 1), (2, 2, FREE, 0, 0), (1, 1, FREE, 0, 0), (5, 0, FREE, 0, 0)],
    [(28, 0, FREE, 0, 1), (26, 0, FREE, 0, 1), (3, 3, FREE, 0, 0), (3, 3, FREE, 0, 0)],
    # pages that end with text, and one-word blocks within it
    [(1, 1, FREE, 0, 0), (2, 2, FREE, 0, 0), (30, 0, FREE, 0, 1), (1, 0, FREE, 0, 1), (40, 0, FREE, 0, 1), (1, 0, FREE, 0, 1), (25, 0, FREE, 0, 1)],
    [(6, 0, FREE, 1, 1), (60, 0, FREE, 0, 1), (80, 0, FREE, 0, 1)],
    [(2, 2, FREE, 0, 0), (45, 0, FREE, 0, 1), (14, 0, FREE, 0, 1)],
    [(60, 0, FREE, 0, 1), (11, 0, FREE, 0, 1)],
    [(1, 1, FREE, 0, 0), (1, 1, FREE, 0, 0), (26, 0, FREE, 0, 1), (1, 1, FREE, 0, 0)],
    [(9, 0, PERHAPS, 0, 0), (60, 0, FREE, 0, 1), (50, 0, FREE, 0, 1), (16, 0, PERHAPS, 0, 0), (28, 0, PERHAPS, 0, 0)],
    # short lines without links in a row are the head or the foot of a page, single ones part of the text
    [(1, 1, FREE, 0, 0), (2, 2, FREE, 0, 0), (60, 0, FREE, 0, 1), (3, 0, FREE, 0, 1), (45, 0, FREE, 0, 1), (3, 0, FREE, 0, 0),
     (2, 0, FREE, 0, 0), (4, 0, FREE, 0, 0), (3, 0, FREE, 0, 0)],
    [(2, 0, FREE, 0, 0), (4, 0, FREE, 0, 0), (3, 0, FREE, 0, 0), (2, 0, FREE, 0, 0), (7, 0, FREE, 1, 1), (70, 0, FREE, 0, 1), (50, 0, FREE, 0, 1),
     (5, 0, FREE, 0, 1), (40, 0, FREE, 0, 1), (4, 0, FREE, 0, 0), (2, 0, FREE, 0, 0), (1, 0, FREE, 0, 0)],
    # a line at the end, behind links and behind text
    [(2, 2, FREE, 0, 0), (60, 0, FREE, 0, 1), (50, 0, FREE, 0, 1), (3, 3, FREE, 0, 0), (2, 2, FREE, 0, 0), (12, 0, FREE, 0, 0)],
    [(2, 2, FREE, 0, 0), (12, 0, FREE, 0, 1), (70, 0, FREE, 0, 1), (50, 0, FREE, 0, 1), (12, 0, FREE, 0, 1)],
    [(60, 0, FREE, 0, 1), (6, 0, FREE, 0, 1), (45, 0, FREE, 0, 1), (8, 0, FREE, 0, 1), (5, 5, FREE, 0, 0), (8, 0, FREE, 0, 0)],
    # a line that leads to links, and one that leads to text of the same length
    [(60, 0, FREE, 0, 1), (50, 0, FREE, 0, 1), (10, 0, FREE, 0, 0), (9, 9, FREE, 0, 0), (11, 11, FREE, 0, 0), (8, 8, FREE, 0, 0), (10, 10, FREE, 0, 0)],
    [(60, 0, FREE, 0, 1), (50, 0, FREE, 0, 1), (10, 0, FREE, 0, 1), (9, 0, FREE, 0, 1), (11, 0, FREE, 0, 1), (30, 0, FREE, 0, 1)],
    [(1, 1, FREE, 0, 0), (45, 0, FREE, 0, 1), (8, 0, FREE, 0, 0), (12, 12, FREE, 0, 0), (9, 9, FREE, 0, 0), (14, 12, FREE, 0, 0), (7, 0, FREE, 0, 0)],
    # little but text
    [(4, 0, FREE, 0, 1)], [(1, 0, FREE, 0, 1)], [(30, 0, FREE, 0, 1)], [(2, 2, FREE, 0, 0)], [(25, 0, TEXT, 0, 1)], [(1, 0, TEXT, 0, 1)],
    [(3, 0, FREE, 1, 1), (25, 0, FREE, 0, 1)], [(7, 0, FREE, 0, 1), (12, 0, FREE, 0, 1), (9, 0, FREE, 0, 1)],
    [(40, 0, BESIDE, 0, 0)], [(6, 0, BESIDE, 0, 0), (1, 1, BESIDE, 0, 0)],
]


#: The labelled pages are taken with their longer blocks (LONG words or more) as they are, shorter and
#: longer, so that no split hangs on the exact length of a paragraph.
LONG, SCALES = 20, (0.7, 1.0, 1.6, 2.5)


def labelled_blocks(scales: tuple[float, ...] = SCALES) -> tuple[np.ndarray, np.ndarray]:
    """The rows of FEATURES of all labelled blocks, and their labels."""
    rows, labels = [], []
    for scale in scales:
        for page in LABELLED:
            found, element = [], 0
            for i, (words, linked, (main, aside), heading, _) in enumerate(page):
                element += bool(aside and (i == 0 or page[i - 1][2] != (main, aside)))
                by = scale if words >= LONG else 1
                found.append(Block("", round(words * by), round(linked * by), main, aside, element if aside else 0, bool(heading)))
            rows.append(describe(found))
            labels += [label for *_, label in page]
    return np.concatenate(rows), np.array(labels, float)


def learned() -> Node:
    return grow(*labelled_blocks())


def main_text(page: str | None, tree: Node) -> str:
    """The blocks the tree takes for main text, a line each."""
    found = blocks(page or "")
    return "\n".join(b.text for b, row in zip(found, describe(found)) if is_main(tree, row))


def extract(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars.

    Blocks stay in page order and are joined by a line feed; a line break within one is a space.
    Null and empty html, and pages without main text, give an empty text. Unclosed elements end
    with what is around them. Repeated rows get a row each, page_id and url may be null, and
    other columns are not read. No pages give no rows.
    """
    bound_batches(pages.sparkSession)
    kind = pages.schema["page_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = learned()
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                texts = [main_text(h.as_py(), tree) for h in part.column(2)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    ["page_id", "url", "text", "n_chars"],
                )

    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
