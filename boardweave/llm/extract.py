"""Main text of web pages by tag-path ratios.

A page becomes text nodes in order, each with its root-to-leaf path of block
elements (name and first class or id). For every path, text length,
punctuation and linked length are summed and divided by its nodes; the two
ratios are smoothed over the page's order of nodes, fused to one score that falls
with the linked share, and paths whose score reaches a share of the best are
content paths; paths in an article or main element score a quarter more. Menus
are told by their scores alone, a path in one having the linked share of the whole
menu. The nodes of content paths select the content
element: the innermost that holds nearly all of their text, or the outermost
around it in its article that adds little but links.
In it, blocks of content paths are taken, and of the other paths those that
are not mostly links, so that headings and short paragraphs stay, or that are a heading, a
paragraph or a list of sources. What is furniture by its element or by a whole
class or id is not taken. A class or id
removes nothing that holds most of the page's scored text (all of it, for names
of advertisements, comments and the like).

Paths are numbers that elements share, and sums go from elements to their
parents in one pass, so time grows with the page and not with its depth.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

SMOOTH = (0.25, 0.5, 1.0, 0.5, 0.25)
THRESHOLD, HOLDS, LINKED = 0.25, 0.85, 0.6
RAISED = 1.25  # for paths in article and main

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|[^<]+|<""", re.S)
_NAME = re.compile(r"""\b(class|id|role|style|hidden|aria-hidden)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_SIGNS = re.compile(r"[.,;:!?。、，！？…]")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW}
INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data dfn del em font i ins kbd label mark q rp rt ruby s samp small span
    strike strong sub sup time tt u var wbr img br math mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle merror mpadded mphantom
    msub msup msubsup munder mover munderover mmultiscripts mprescripts none mtable mtr mtd semantics annotation annotation-xml""".split())
UNSEEN = frozenset({"annotation", "annotation-xml"})  # inline, and never shown
MENUS = frozenset({"nav", "menu"})
FURNITURE = frozenset("""header footer aside form button select option dialog template svg object audio video canvas
    script style noscript iframe title head textarea fieldset input datalist figure""".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog alertdialog menu menubar toolbar".split())
WORDS = frozenset("""ad ads adv advert advertisement advertising adbox adslot banner sponsor sponsored promo promotion menu nav navbar
    navigation breadcrumb breadcrumbs sidebar side widget footer header masthead topbar cookie cookies consent gdpr notice notification
    alert popup modal overlay newsletter subscribe subscription signup login comment comments reply replies disqus discussion reactions
    share sharing social related recommended recommendations pagination pager toolbar copyright legal disclaimer paywall search form tags
    toc skip hidden""".split())
#: Of a compound name, parts that say only where or what kind of box; a name is furniture if all its parts are of these and WORDS.
PLACES = frozenset("""area bar block bottom box button buttons container global left link links list main menu page panel posts primary
    right secondary section site slot top widget wrap wrapper""".split())
#: Names that are furniture however long it is; they stay only where no other text is.
CERTAIN = frozenset("""ad ads adv advert advertisement advertising adbox adslot sponsor sponsored promo promotion cookie cookies consent gdpr
    newsletter breadcrumb breadcrumbs pagination pager comment comments reply replies disqus discussion reactions""".split())
SOURCES = re.compile(r"""\b(sources?|references?|footnotes?|endnotes?|notes|bibliograph\w*|citations?|further reading|works cited|quellen\w*|literatur\w*|
    einzelnachweise|fuentes|referencias|bibliograf\w*|références?|källor)\b""", re.I | re.X)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PROSE = HEADINGS | {"p", "blockquote", "dd", "figcaption"}
#: An open element of the first kind ends where one of the second begins.
ENDED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot"}, "td": {"td", "th", "tr"},
            "th": {"td", "th", "tr"}, "option": {"option"}, "thead": {"tbody", "tfoot"}, "tbody": {"tbody", "tfoot"}}


class Element:
    __slots__ = ("name", "label", "parent", "out", "article", "menu", "named", "path", "weight", "own", "inside")

    def __init__(self, name: str, label: str, parent: Element | None, out: bool, path: int, named: str = "") -> None:
        self.name, self.label, self.parent, self.path, self.named, self.weight, self.own = name, label, parent, path, named, 0, 0
        self.article = name in ("article", "main") or bool(parent and parent.article)
        self.menu = self if name in MENUS else parent and parent.menu
        self.out = out or bool(parent and parent.out)


class Node:
    """A block of text. ``linked`` counts its linked characters, ``share`` is their share, or the share of the whole menu around it."""

    __slots__ = ("element", "parts", "linked", "share", "text", "signs")

    def __init__(self, element: Element) -> None:
        self.element, self.parts, self.linked = element, [], 0


def _furniture_name(value: str) -> str:
    """The first whole name of a class or id that is one of furniture."""
    for token in value.split():
        parts = {x for x in re.split(r"[_-]+", token) if x}
        if token in WORDS or (parts & WORDS and parts <= WORDS | PLACES):
            return token
    return ""


def _furniture(name: str, attributes: str, inside: bool) -> tuple[bool, str, str]:
    """Whether the element is furniture by itself, its name in paths, and the class or id that calls it furniture."""
    label, named = name, ""
    out = name in FURNITURE and not (inside and name in ("header", "figure"))
    if attributes:
        for key, value in _NAME.findall(attributes):
            key, value = key.lower(), value.strip("\"'").lower()
            if key in ("class", "id"):
                label = f"{label}.{value.split()[0]}" if value.split() and "." not in label else label
                if not named and name not in ("html", "body", "article", "main"):
                    named = _furniture_name(value)
            elif key == "role":
                out |= value in ROLES
            elif key == "style":
                out |= bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value))
            elif key == "aria-hidden":
                out |= value == "true"
            elif key == "hidden":
                out = True
    return out, label, named


def nodes_of(page: str) -> tuple[list[Node], list[Element]]:
    """Text nodes by block, in page order, and all elements, parents first; furniture by element, role or style is left out."""
    root = here = Element("#", "#", None, False, 0)
    elements, paths, unclosed = [root], {}, Counter()
    links, nodes, node, place = 0, [], None, 0
    last = page.rfind(">")  # no tag ends after it

    def entered(name: str, label: str, out: bool, named: str) -> Element:
        unclosed[name] += 1
        elements.append(Element(name, label, here, out, paths.setdefault((here.path, label), len(paths) + 1), named))
        return elements[-1]

    def left(element: Element) -> Element:
        unclosed[element.name] -= 1
        return element.parent

    while place < len(page):
        m = _TAG.match(page, place) if place <= last else None
        piece, place = (m[0], m.end()) if m else (page[place:], len(page))
        name = (m[2] or m[5] or "").lower() if m else ""
        if not name:
            if piece.startswith(("<!", "<?")) or here.out:
                continue
            if node is None:
                node = Node(here)
            node.parts.append(piece)
            node.linked += len(piece.strip()) if links else 0
            continue
        closing, attributes = m[1] or m[4], m[3] or m[6] or ""
        if name in RAW and not closing:  # no tags in it: what follows begins at its closing tag
            end = _RAW_END[name].search(page, place)
            place = end.start() if end else len(page)
            continue
        if name == "br":
            if node is not None:
                node.parts.append(" ")
            continue
        if name in INLINE:
            out, named = False, ""
            if name == "a":
                links = 0 if closing else 1
            elif not closing and attributes:
                out, _, named = _furniture(name, attributes, here.article)
            out |= name in UNSEEN and not closing
            if out and name in UNSEEN and not named:  # leaves the line in one piece
                end = re.compile(rf"</{name}(?=[\s/>])", re.I).search(page, place)
                place = end.start() if end else place
                continue
            if (out or named) and name not in VOID:  # a hidden or foreign part of a line stands as an element of its own
                if node is not None:
                    nodes.append(node)
                here, node = entered(name, name, out, named), None
            elif closing and here.name == name:
                here = left(here)
            continue
        if node is not None:
            nodes.append(node)
            node = None
        if name in VOID:
            continue
        if closing:
            if unclosed[name]:
                while here.name != name:
                    here = left(here)
                here, links = left(here), 0
            continue
        while here.name in INLINE:
            here = left(here)
        if here.name == "p" or name in ENDED_BY.get(here.name, ()):
            here = left(here)
            while here is not root and name in ENDED_BY.get(here.name, ()):
                here = left(here)
        links = 0
        out, label, named = _furniture(name, attributes, here.article)
        here = entered(name, label, out, named)
    if node is not None:
        nodes.append(node)
    kept, menus = [], {}
    for n in nodes:
        n.text = " ".join(html.unescape("".join(n.parts)).split())
        if n.text:
            n.signs = len(_SIGNS.findall(n.text))
            n.linked = min(n.linked, len(n.text))
            kept.append(n)
            if n.element.menu:
                whole = menus.setdefault(n.element.menu, [0, 0])
                whole[0] += n.linked
                whole[1] += len(n.text)
    for n in kept:
        n.share = n.linked / len(n.text)
        if n.element.menu:
            whole = menus[n.element.menu]
            n.share = max(n.share, whole[0] / whole[1])
    return kept, elements


def _summed(nodes: Iterable[Node], elements: list[Element], amount) -> dict[Element, float]:
    """For each element, the amounts of the nodes in it."""
    sums = dict.fromkeys(elements, 0)
    for n in nodes:
        sums[n.element] += amount(n)
    for e in reversed(elements):
        if e.parent is not None:
            sums[e.parent] += sums[e]
    return sums


def path_scores(nodes: list[Node]) -> dict[int, float]:
    """The fused score of each path."""
    sums: dict[int, list[float]] = {}
    for n in nodes:
        s = sums.setdefault(n.element.path, [0, 0, 0, 0])
        for i, x in enumerate((len(n.text), n.signs, n.share * len(n.text), 1)):
            s[i] += x
    length = [sums[n.element.path][0] / sums[n.element.path][3] for n in nodes]
    signs = [sums[n.element.path][1] / sums[n.element.path][3] for n in nodes]

    def smooth(values: list[float]) -> list[float]:
        half, out = len(SMOOTH) // 2, []
        for i in range(len(values)):
            near = [(SMOOTH[j - i + half], values[j]) for j in range(max(0, i - half), min(len(values), i + half + 1))]
            out.append(sum(w * v for w, v in near) / sum(w for w, _ in near))
        return out

    fused: dict[int, list[float]] = {}
    for n, a, b in zip(nodes, smooth(length), smooth(signs), strict=True):
        whole, _, linked, _ = sums[n.element.path]
        fused.setdefault(n.element.path, []).append(math.sqrt(a * (1 + b)) * max(0.0, 1 - linked / whole))
    return {path: sum(v) / len(v) for path, v in fused.items()}


def _content(nodes: list[Node]) -> set[int]:
    """The content paths; article and main raise the score of a path and decide nothing by themselves."""
    scores = path_scores(nodes)
    scores |= {path: RAISED * scores[path] for path in {n.element.path for n in nodes if n.element.article}}
    limit = THRESHOLD * max(scores.values())
    return {path for path, score in scores.items() if score >= limit}


def _without_named(nodes: list[Node], elements: list[Element]) -> list[Node]:
    """Without what a class or id calls furniture, unless that holds most of the page's scored text, or all of it if the name is certain."""
    if not any(e.named for e in elements):
        return nodes
    paths = _content(nodes)
    held = _summed((n for n in nodes if n.element.path in paths), elements, lambda n: len(n.text))
    whole, stays = held[elements[0]], {}
    for e in elements:
        fine = e.parent is None or stays[e.parent]
        if fine and e.named:
            certain = bool(CERTAIN & set(re.split(r"[_-]+", e.named)))
            fine = held[e] >= whole if certain else 2 * held[e] > whole
        stays[e] = fine
    return [n for n in nodes if stays[n.element]] or nodes


def _kept_links(chosen: list[Node], inside: dict[Element, bool], box: Element) -> set[int]:
    """Places of nodes that are a heading, a paragraph or part of a source list of the content element, even if they are links; none of a menu is."""
    about: dict[Element, tuple] = {}  # whether in a heading, in prose or an ordered list or a box named so, in an item
    for e, within in inside.items():
        if within:
            heading, stays, item = about.get(e.parent, (False, False, False)) if e is not box else (False, False, False)
            labelled = bool(SOURCES.search(e.label.partition(".")[2].replace("-", " ").replace("_", " ")))
            found = heading or e.name in HEADINGS, stays or e.name in PROSE or e.name == "ol" or labelled, item or e.name in ("li", "td")
            about[e] = found if e.menu is None else (False, False, False)
    kept, sources = set(), False
    for i, n in enumerate(chosen):
        heading, stays, item = about[n.element]
        if heading:
            sources = bool(SOURCES.search(n.text))
        if stays or (sources and item):
            kept.add(i)
    return kept


def main_text(page: str) -> str:
    """The article's blocks joined by an empty line; empty if there is none."""
    nodes, elements = nodes_of(page)
    nodes = _without_named(nodes, elements)
    if not nodes:
        return ""
    paths = _content(nodes)
    content = [n for n in nodes if n.element.path in paths]
    weight = _summed(content, elements, lambda n: len(n.text))
    total = weight[elements[0]]
    box = [e for e in elements if weight[e] >= HOLDS * total][-1]  # they lie in each other: the last is the innermost with nearly all of the content
    if len(content) > 1 and box.parent is not None and box.name in ("p", "li", "td", "dd", "blockquote"):
        box = box.parent
    if box.article:  # with the short blocks beside it, as long as it holds nearly all that is not linked
        own = _summed(nodes, elements, lambda n: max(0, len(n.text) - n.linked))
        at, best = box, box
        while at.parent is not None and at.parent.article:
            at = at.parent
            if weight[box] >= HOLDS * own[at]:
                best = at
        box = best
    inside: dict[Element, bool] = {}
    for e in elements:
        inside[e] = e is box or bool(e.parent and inside[e.parent])
    chosen = [n for n in nodes if inside[n.element]]
    kept = _kept_links(chosen, inside, box) if any(n.share >= LINKED for n in chosen) else ()
    return "\n\n".join(n.text for i, n in enumerate(chosen) if n.element.path in paths or n.share < LINKED or i in kept)


def main_texts(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page; null html counts as empty. No row leaves its task."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, len(batch), 256):
                part = batch.slice(begin, 256)
                texts = [main_text(h or "") for h in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    ["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInArrow(
        run, "page_id long, url string, text string, n_chars long")
