"""Main text of web pages by tag-path ratios.

Every text belongs to a root-to-leaf path of tags.  Text length (without links) and punctuation are summed per path and
divided by the path's nodes.  Both ratios saturate, so that a long path cannot raise the bar for short ones; their product
is fused (geometrically) with its average over the paths one tag away, counts more below article or main and less below
elements whose names leave doubt, and is held against a share of the best score.  The result are the blocks of the chosen
paths, the headings over them, lists, tables, quotations and the like beside them and, where most of the chosen text lies in
article or main, all paragraphs, lists and the like in there and nothing outside.  Parts that their tag, role, class or id
marks as menus, headers, footers, sidebars, notices, adverts, forms or comments are left out: for certain if a name says
nothing else (ad-banner, post-comments), by score if it has other words too (related-work, search-results-article).
Time is linear in the page's tags, however deep they nest and however many paths they make.

Defined cases: null and empty pages, and pages cut before their article, have an empty text; unclosed and misnested
tags close with their parent; a tag cut at the page's end is dropped; repeated rows are pages of their own; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from telescry.llm.common import map_rows

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>\"']*(?:\"[^\"]*\"[^>\"']*|'[^']*'[^>\"']*)*)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)|<[!?/][^>]*(?:>|\Z)|<\Z", re.DOTALL
)
_ATTRIBUTE = re.compile(r"""(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.IGNORECASE)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_MARK = re.compile(r"[.,;:!?]")

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript iframe template svg math select xmp".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
_CLOSES = {  # a start tag that ends open elements of these names
    "p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "option": {"option"},
}
_ENDS_P = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol pre section table ul".split())
_SKIP_TAGS = frozenset("head nav footer aside form button dialog object embed canvas audio video menu".split())
_SKIP_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form".split())
_SKIP_SURE = frozenset(  # however they are combined, unless an id names a section
    "ad ads adv advert adverts advertisement advertising sponsor sponsored cookie cookies consent gdpr notice newsletter subscribe paywall popup modal sidebar nav navbar "
    "breadcrumb breadcrumbs comment comments disqus reply replies footer masthead pagination pager".split())
_SKIP_NAMES = _SKIP_SURE | frozenset(  # alone or with words that say nothing
    "banner promo promotion overlay subscription aside menu navigation share sharing social related recommended recommendations toolbar widget login signup search skip tags".split())
_PLAIN_NAMES = frozenset(
    "area article articles bar block blog body bottom box button buttons btn col column container content desktop entry fixed form global group head header heading icon icons inline inner item items js "
    "left link links list main media mobile module outer page pane panel post posts primary reader readers right row secondary section site slot sticky stories story text thread title top unit user users "
    "view wrap wrapper".split())
_STATES = frozenset("has have no not with without hide show is".split())  # of the element, not its kind
_KEEP, _DOUBT, _SKIP = 0, 1, 2

_MARKS, _MARKED, _DOUBTED = frozenset(("article", "main")), 2.0, 0.7  # weights of paths below these
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_LISTS = frozenset("ul ol dl table blockquote pre figure p".split())  # beside chosen blocks they are content, however short
_INNER = _LISTS | _HEADINGS | frozenset("li dt dd tr tbody thead tfoot caption figcaption".split())
_ROOT = 0  # the whole page among elements, and its path among paths


@dataclass(slots=True)
class Node:
    tag: str
    judged: int  # _KEEP, _DOUBT or _SKIP
    parent: Node | None
    inside: bool = False  # an article or main, or in one
    children: list = field(default_factory=list)  # nodes and texts


def _named(value: str, slug: bool) -> int:
    """What the words of a class or id say about an element; a slug may be made of a section's title."""
    worst = _KEEP
    for token in value.split():
        words = [w.lower() for w in _NAME.findall(token)]
        if not words or words[0] in _STATES or _SKIP_NAMES.isdisjoint(words):
            continue
        if all(w in _SKIP_NAMES or w in _PLAIN_NAMES for w in words) or not (slug or _SKIP_SURE.isdisjoint(words)):
            return _SKIP
        worst = _DOUBT
    return worst


def _judge(tag: str, attributes: str, inside: bool) -> int:
    if tag in _SKIP_TAGS or (tag == "header" and not inside):
        return _SKIP
    worst = _KEEP
    for name, *values in _ATTRIBUTE.findall(attributes) if attributes else ():
        name, value = name.lower(), "".join(values)
        if name in ("class", "id"):
            if tag in ("html", "body", "main") or (name == "id" and tag in _HEADINGS):
                continue
            named = _named(value, tag == "article" or (name == "id" and tag == "section"))
            worst = max(worst, _KEEP if named == _DOUBT and tag == "article" else named)
            continue
        value = value.lower()
        if (name == "role" and value in _SKIP_ROLES) or name == "hidden" or (name == "aria-hidden" and value == "true"):
            return _SKIP
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return _SKIP
    return worst


def parse(page: str) -> Node:
    """A lenient tree of the page without comments, scripts, styles and the like."""
    root = here = Node("", _KEEP, None)
    at, size = 0, len(page)
    open_tags: Counter[str] = Counter()
    while at < size:
        found = _TOKEN.search(page, at)
        if found is None or found.start() > at:
            here.children.append(html.unescape(page[at : found.start() if found else size]))
        if found is None:
            break
        at = found.end()
        closing, name = (found[1], found[2]) if found[2] else (found[4], found[5])
        if not name:
            continue
        name = name.lower()
        if closing:
            if open_tags[name] and (up := _opened(here, name)):
                here = _left(here, up.parent, open_tags)
            continue
        if name in _RAW:
            end = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|\Z)", re.IGNORECASE).search(page, at)
            at = end.end() if end else size
            continue
        ends = _CLOSES.get(name) or ({"p"} if name in _ENDS_P else None)
        if ends:
            here = _left(here, _closed(here, ends, root), open_tags)
        if name in _VOID:
            here.children.append(" " if name == "br" else Node(name, _KEEP, here) if name == "hr" else "")
            continue
        node = Node(name, _judge(name, found[3] if found[2] else "", here.inside), here, here.inside or name in _MARKS)
        open_tags[name] += 1
        here.children.append(node)
        here = node
    return root


def _opened(here: Node, name: str) -> Node | None:
    """The innermost open element of this name; an end tag of an inline element closes no block."""
    while here.tag != name:
        if name in _INLINE and here.tag not in _INLINE:
            return None
        here = here.parent
    return here


def _left(here: Node, to: Node, open_tags: Counter[str]) -> Node:
    """The outer place, once all elements down to the inner one are closed."""
    while here is not to:
        open_tags[here.tag] -= 1
        here = here.parent
    return to


def _closed(here: Node, names: set[str], root: Node) -> Node:
    """The place after open elements of these names, and what is inside them, are closed."""
    found, up = here, here
    while up is not root and (up.tag in _INLINE or up.tag in names):
        if up.tag in names:
            found = up.parent
        up = up.parent
    return found


@dataclass(slots=True)
class Element:
    """A block element that is not left out."""

    tag: str
    up: int  # the element around it; elements come in page order, after the one around them
    path: int
    marked: bool  # an article or main, or in one
    doubted: bool  # named so that it may be no content, or in one
    prose: bool  # a paragraph, list or the like, or in one, inside any article and doubt


@dataclass(slots=True)
class Block:
    at: int  # the element whose text it is
    text: str
    link: int  # characters inside links


def blocks(root: Node) -> tuple[list[Block], list[Element], list[int]]:
    """Texts between block boundaries, in page order, outside skipped elements; the elements; of each path of tags, the one above."""
    out: list[Block] = []
    elements = [Element("", -1, _ROOT, False, False, False)]
    above: list[int] = [-1]
    paths: dict[tuple, int] = {}
    pieces: list[str] = []
    links = 0

    def end(at):
        nonlocal links
        if text := " ".join("".join(pieces).split()):
            out.append(Block(at, text, links))
        pieces.clear()
        links = 0

    def element(node, at):
        around = elements[at]
        doubted = around.doubted or node.judged == _DOUBT
        path = paths.setdefault((around.path, node.tag, doubted), len(above))
        if path == len(above):
            above.append(around.path)
        fresh = node.judged == _DOUBT or (node.inside and not around.marked)
        elements.append(Element(node.tag, at, path, node.inside, doubted, node.tag in _LISTS or (around.prose and not fresh)))
        return len(elements) - 1

    stack: list[tuple] = [(root, _ROOT, 0, False)]
    while stack:
        node, at, k, linked = stack.pop()
        while k < len(node.children):
            child = node.children[k]
            k += 1
            if isinstance(child, str):
                pieces.append(child)
                links += len(child) if linked else 0
                continue
            inner = child.tag in _INLINE
            if not inner:
                end(at)
            if child.judged == _SKIP:
                continue
            stack.append((node, at, k, linked))
            node, at, linked, k = child, at if inner else element(child, at), linked or child.tag == "a", 0
        if node.tag not in _INLINE:
            end(at)
    return out, elements, above


def path_scores(found: list[Block], elements: list[Element], above: list[int], near: float = 0.6, half: float = 40.0) -> dict[int, float]:
    """Fused ratio of each path with text: saturated length times punctuation per node, by itself and smoothed over the path above,
    those below and those beside it (of weight near), weighted by article, main and doubt.  Texts of half characters score a half."""
    sums: dict[int, list] = {}
    for b in found:
        e = elements[b.at]
        entry = sums.setdefault(e.path, [0, 0, 0, (_MARKED if e.marked else 1.0) * (_DOUBTED if e.doubted else 1.0)])
        entry[0] += max(0, len(b.text) - b.link)
        entry[1] += len(_MARK.findall(b.text)) if b.link < len(b.text) else 0
        entry[2] += 1
    ratios = {p: (chars / (chars + half * n)) * (0.5 * n + marks) / (n + marks) for p, (chars, marks, n, _) in sums.items()}
    below: dict[int, list] = {}
    for p, r in ratios.items():
        entry = below.setdefault(above[p], [0.0, 0])
        entry[0] += r
        entry[1] += 1
    scores = {}
    for p, r in ratios.items():
        (lower, n), (beside, m) = below.get(p, (0.0, 0)), below[above[p]]
        around, others = lower + beside - r + ratios.get(above[p], 0.0), n + m - 1 + (above[p] in ratios)
        smooth = (r + near * around) / (1 + near * others)
        scores[p] = r**0.75 * smooth**0.25 * sums[p][3]
    return scores


def _beside(found: list[Block], kept: list[bool], elements: list[Element]) -> list[bool]:
    """What else belongs to the kept blocks: headings over them, and prose elements in the elements that hold them directly."""
    out = list(kept)
    holder: list[int] = []  # the element around lists, tables and the like
    for i, e in enumerate(elements):
        holder.append(holder[e.up] if e.tag in _INNER else i)
    parents = {holder[elements[b.at].up if elements[b.at].tag in ("td", "th") else b.at] for b, k in zip(found, kept, strict=True) if k}
    joined: list[int] = []  # the prose element beside kept blocks that an element is, or is in; -1: none
    for i, e in enumerate(elements):
        joined.append(-1 if e.up < 0 else joined[e.up] if joined[e.up] >= 0 else i if e.tag in _LISTS and e.up in parents else -1)
    written = {joined[b.at] for b in found if b.link < len(b.text)} - {-1}  # those that are not links alone
    for i, b in enumerate(found):
        out[i] = out[i] or joined[b.at] in written
    heading = [elements[b.at].tag in _HEADINGS for b in found]
    other, last = [False] * len(elements), [-1] * len(elements)  # whether an element holds more than headings; its last kept block
    for i, b in enumerate(found):
        if not heading[i]:
            other[b.at], last[b.at] = True, i if out[i] else last[b.at]
    for i in range(len(elements) - 1, 0, -1):
        up = elements[i].up
        other[up], last[up] = other[up] or other[i], max(last[up], last[i])
    within: list[int] = []  # the innermost element that holds more than headings
    for i, e in enumerate(elements):
        within.append(i if other[i] or i == _ROOT else within[e.up])
    after: dict[int, list[tuple[int, int]]] = {}  # of an element, from the end: places and ranks of the headings that rise
    following = len(found)  # the next kept block
    for i in range(len(found) - 1, -1, -1):
        if heading[i]:
            e = elements[found[i].at]
            parent, rank = within[e.up], int(e.tag[1])
            rivals = after.setdefault(parent, [])
            while rivals and rivals[-1][1] > rank:
                rivals.pop()
            end = rivals[-1][0] if rivals else len(found)
            rivals.append((i, rank))
            out[i] = out[i] or (following < end and following <= last[parent])
        following = i if out[i] else following
    return out


def main_text(page: str | None, strictness: float = 0.3) -> str:
    """The article's blocks, joined by line feeds."""
    found, elements, above = blocks(parse(page or ""))
    if not found:
        return ""
    scores = path_scores(found, elements, above)
    best = max(scores.values())
    kept = [scores[elements[b.at].path] >= strictness * best and (scores[elements[b.at].path] > 0 or best == 0) for b in found]
    chosen = sum(len(b.text) - b.link for b, k in zip(found, kept, strict=True) if k)
    marked = sum(len(b.text) - b.link for b, k in zip(found, kept, strict=True) if k and elements[b.at].marked)
    if best > 0 and 2 * marked >= chosen:
        for i, b in enumerate(found):
            e = elements[b.at]
            kept[i] = e.marked and (kept[i] or (e.prose and not e.doubted))
    kept = _beside(found, kept, elements)
    own = [b for b, k in zip(found, kept, strict=True) if k]
    lists: dict[int, list[Block]] = {}
    for b in own:
        lists.setdefault(elements[b.at].up, []).append(b)
    menus = {k for k, bs in lists.items() if len(bs) >= 3 and all(b.link >= len(b.text) for b in bs)} if any(b.link < len(b.text) for b in own) else set()
    return "\n".join(b.text for b in own if elements[b.at].up not in menus)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""

    def rows(batch):
        texts = [main_text(x) for x in batch["html"]]
        yield {"page_id": batch["page_id"], "url": batch["url"], "text": texts, "n_chars": [len(t) for t in texts]}

    return map_rows(pages.select("page_id", "url", "html"), f"page_id {pages.schema['page_id'].dataType.simpleString()}, url string, text string, n_chars long", rows)
