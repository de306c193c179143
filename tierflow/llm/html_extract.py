"""Main text of web pages by tree scoring.

A page is read into a tree of elements and a list of text blocks.  Elements that are never
article text by tag or role (menus, headers, footers, asides, forms, scripts) are left
out.  A name (notice, advert, comments) makes an element suspect; it is left out if its
text is also short or in links.  Each block of some length passes points to its
ancestors, for its length and its commas, fewer with distance; an element's points are
discounted by the share of its text that is in links.  The best element is the article;
siblings that score well, and headings beside it, are kept with it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tierflow.llm.common import map_rows

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^\"'>]++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*+)(?P<attrs2>[^>]*+)>",
    re.DOTALL,
)
UNFINISHED = re.compile(r"<[a-zA-Z/!?][^>]*\Z")
ATTR = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))|\b(hidden)\b")

#: Their content is not markup; it ends at the end tag.
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: A start tag of the key closes an open element of the value, up to one of ``SCOPES``.
CLOSES = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "option": {"option"},
}
SCOPES = frozenset("ul ol dl table body html article section div".split())

#: Never article text.
DROPPED_TAGS = frozenset(
    "nav footer aside form button select menu dialog svg object canvas map audio video fieldset head".split()
)
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar".split())
#: Whole words of a class or id that make a block element suspect.
SUSPECT_WORDS = frozenset(
    "sidebar promo promotion cookie cookies consent gdpr notice banner "
    "popup modal overlay newsletter subscribe subscription share sharing social related recommend recommended recommendations "
    "breadcrumb breadcrumbs pagination paginator pager navbar navigation nav menu footer masthead topbar toolbar widget login "
    "signup".split()
)
SUSPECT_NAMES = frozenset("header site-header page-header side-bar pop-up sign-up skip-link screen-reader screen-reader-text".split())
#: The same for what readers wrote and what was paid for: much text does not speak for it.
FOREIGN_WORDS = frozenset(
    "comment comments disqus respond replies ad ads adsense advert adverts advertisement sponsor sponsored outbrain taboola".split()
)
GOOD_NAMES = re.compile(r"article|content|entry|main|post|story|text|body", re.IGNORECASE)

#: Suspects within suspects that are looked at one by one.
NESTED = 8
#: A block of fewer characters passes no points.
SCORED_CHARS = 25
#: Points reach so many ancestors.
REACH = 5


class Element:
    __slots__ = ("tag", "parent", "names", "dropped", "inside", "points", "chars", "link_chars", "links", "suspect")

    def __init__(self, tag: str, parent: Element | None, names: str, dropped: bool, inside: bool):
        self.tag, self.parent, self.names = tag, parent, names
        self.dropped, self.inside = dropped, inside
        self.points, self.chars, self.link_chars, self.links = 0.0, 0, 0, 0
        #: 1 if its name makes it suspect, 2 if it seems to hold comments or adverts.
        self.suspect = 0

    def up(self) -> Iterator[Element]:
        at: Element | None = self
        while at is not None:
            yield at
            at = at.parent

    @property
    def link_density(self) -> float:
        return self.link_chars / self.chars if self.chars else 0.0


def parse(html: str) -> tuple[list[Element], list[tuple[Element, str, int]]]:
    """The elements, parents first, and (innermost block element, text, characters in links)
    of each block, in page order.

    Blocks within dropped elements are left out.
    """
    root = Element("#root", None, "", False, False)
    stack = [root]
    elements = [root]
    opened: dict[str, int] = {}
    blocks: list[tuple[Element, str, int]] = []
    run: list[str] = []
    linked = 0
    at = 0

    def text(piece: str) -> None:
        nonlocal linked
        if piece and not stack[-1].dropped:
            run.append(piece)
            if opened.get("a"):
                linked += len("".join(unescape(piece).split()))

    def flush() -> None:
        nonlocal linked
        if run:
            value = " ".join(unescape("".join(run)).split())
            if value:
                owner = next(e for e in reversed(stack) if e.tag not in INLINE)
                blocks.append((owner, value, linked))
            run.clear()
        linked = 0

    def pop() -> None:
        opened[stack.pop().tag] -= 1

    while found := TAG.search(html, at):
        text(html[at : found.start()])
        at = found.end()
        tag = (found["tag"] or found["tag2"] or "").lower()
        if not tag:
            continue
        if found["end"] or found["end2"]:
            if tag == "br":
                text(" ")
            if opened.get(tag):
                if tag not in INLINE:
                    flush()
                while stack[-1].tag != tag:
                    pop()
                pop()
            continue
        if tag == "br" or tag == "wbr":
            text(" " if tag == "br" else "")
            continue
        if tag not in INLINE:
            flush()
            if opened.get("p") and tag != "option":
                depth = _open_depth(stack, {"p"}, frozenset())
                if depth and not any(e.tag in ("button", "object", "table", "td", "th") for e in stack[depth:]):
                    while len(stack) > depth:
                        pop()
            if tag in CLOSES and any(opened.get(t) for t in CLOSES[tag]):
                depth = _open_depth(stack, CLOSES[tag], SCOPES)
                while depth and len(stack) > depth:
                    pop()
        attrs = found["attrs"] or found["attrs2"] or ""
        element = _element(tag, attrs, stack[-1])
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])", re.IGNORECASE).search(html, at)
            at = end.start() if end else len(html)
            if end and (close := html.find(">", at)) >= 0:
                at = close + 1
            else:
                at = len(html)
        elif tag not in VOID and not attrs.rstrip().endswith("/") or tag in ("p", "div", "a", "span"):
            stack.append(element)
            elements.append(element)
            opened[tag] = opened.get(tag, 0) + 1
            element.links = int(tag == "a")
    text(UNFINISHED.sub("", html[at:]))  # a tag that the page's end cuts off is no text
    flush()
    return elements, blocks


def _open_depth(stack: list[Element], tags: set[str], stop: frozenset) -> int:
    """Where the innermost open element of ``tags`` is in the stack; 0 if there is none."""
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].tag in tags:
            return i
        if stack[i].tag in stop:
            return 0
    return 0


def _element(tag: str, attrs: str, parent: Element) -> Element:
    names, dropped = "", parent.dropped
    inside = parent.inside or tag in ("article", "main")
    if attrs:
        for name, *values, bare in ATTR.findall(attrs):
            name, value = name.lower(), next((v for v in values if v), "")
            if name in ("class", "id"):
                names += f" {value}"
            elif name == "role" and value.lower() in DROPPED_ROLES:
                dropped = True
            elif bare or name == "aria-hidden" and value.lower() == "true":
                dropped = True
            elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.IGNORECASE):
                dropped = True
    element = Element(tag, parent, names, dropped or tag in DROPPED_TAGS or tag == "header" and not parent.inside, inside)
    if names and tag not in INLINE and tag not in HEADINGS and tag not in ("html", "body", "#root"):
        whole = names.lower().split()
        words = {w for name in whole for w in re.split(r"[^a-z0-9]+", name)}
        if words & FOREIGN_WORDS:
            element.suspect = 2
        elif tag not in ("main", "article") and (words & SUSPECT_WORDS or not SUSPECT_NAMES.isdisjoint(whole)):
            element.suspect = 1
    return element


def add_up(elements: list[Element], blocks: list[tuple[Element, str, int]]) -> None:
    """Give every element its text's characters, those in links, and its links, all counted once."""
    for element in elements:
        element.chars = element.link_chars = 0
    for owner, value, linked in blocks:
        owner.chars += len(value)
        owner.link_chars += linked
    for element in reversed(elements):
        if element.parent is not None:
            element.parent.chars += element.chars
            element.parent.link_chars += element.link_chars
            element.parent.links += element.links


def without_suspects(elements: list[Element], blocks: list[tuple[Element, str, int]]) -> list[tuple[Element, str, int]]:
    """The blocks outside the elements whose name and text both speak against them.

    A name alone does not: an element stays whose text is mostly not in links and is at
    least half as much as all text outside of suspects, or all there is.  Comments and adverts
    stay only in the last case.  Where the page marks its article, nothing outside of it
    stays.  An element that stays may hold others that do not, ``NESTED`` deep; names
    within those are not believed.
    """
    cleared: set[int] = set()
    for _ in range(NESTED):
        # The outermost suspect around each element, parents first.
        around: dict[int, Element | None] = {}
        for element in elements:
            above = around[id(element.parent)] if element.parent is not None else None
            suspect = element if element.suspect and id(element) not in cleared else None
            around[id(element)] = above or suspect
        outside = [b for b in blocks if around[id(b[0])] is None]
        prose = sum(len(value) - linked for owner, value, linked in outside if len(value) >= SCORED_CHARS and owner.tag not in HEADINGS)
        held = {id(e): e for e in around.values() if e is not None and e.chars}
        marked = any(owner.inside for owner, _, _ in outside)
        loose = [e for e in held.values() if e.link_density < 0.4 and (e.inside or not marked)]
        if not prose and not marked:
            # All text is in suspects: the one with the most of it, comments and adverts last.
            stay = sorted(loose, key=lambda e: (e.suspect, -e.chars))[:1]
        else:
            stay = [e for e in loose if e.suspect == 1 and e.chars - e.link_chars >= prose / 2]
        if not stay:
            return outside
        cleared |= {id(e) for e in stay}
    return blocks


def main_blocks(html: str) -> list[str]:
    """The blocks of the article, in page order."""
    elements, blocks = parse(html)
    add_up(elements, blocks)
    outside = without_suspects(elements, blocks)
    if len(outside) < len(blocks):
        blocks = outside
        for element in elements:
            element.links = int(element.tag == "a")
        add_up(elements, blocks)
    scored: dict[int, Element] = {}
    for owner, value, linked in blocks:
        if len(value) < SCORED_CHARS or owner.tag in HEADINGS:
            continue
        points = 1 + value.count(",") + value.count("，") + min(len(value) / 100, 3)
        points *= 1 - min(linked / len(value), 1)
        container = owner.parent if owner.tag in ("p", "pre", "blockquote", "li", "td") and owner.parent else owner
        for distance, element in enumerate(container.up()):
            if distance > REACH:
                break
            if id(element) not in scored:
                element.points = _standing(element)
                scored[id(element)] = element
            element.points += points / (1 if distance == 0 else 2 if distance == 1 else 3 * (distance - 1))
    if not scored:
        inside = [b for b in blocks if b[0].inside] or blocks
        return [value for owner, value, linked in inside if linked <= len(value) / 2]

    def worth(element: Element) -> float:
        return element.points * (1 - element.link_density)

    best = max(scored.values(), key=worth)
    # An article spread over sections is the element that holds them.
    for element in best.up():
        if element.tag in ("article", "main") and not element.dropped:
            best = element
            break
    threshold = max(10.0, worth(best) / 5)
    kept = {id(best)}
    if best.tag not in ("article", "main"):
        for element in scored.values():
            if element.parent is best.parent and element is not best:
                alike = best.names.strip() and element.names == best.names
                if worth(element) + (worth(best) / 5 if alike else 0) >= threshold:
                    kept.add(id(element))
    # Whether an element is in what is kept, and there in a list of links, parents first.
    within: dict[int, bool] = {}
    listed: dict[int, bool] = {}
    for element in elements:
        above = element.parent is not None and within[id(element.parent)]
        within[id(element)] = above or id(element) in kept
        listed[id(element)] = id(element) not in kept and (
            _link_list(element) or element.parent is not None and listed[id(element.parent)]
        )
    out = []
    for owner, value, linked in blocks:
        if within[id(owner)]:
            if not listed[id(owner)]:
                out.append(value)
        elif best.parent is not None and best.tag not in ("body", "html", "#root"):
            beside = owner.parent is best.parent
            dense = linked / len(value)
            if beside and owner.tag in HEADINGS and dense < 0.5:
                out.append(value)
            elif beside and owner.tag == "p" and (
                len(value) > 80 and dense < 0.25 or dense == 0 and re.search(r"[.!?](?:\s|$)", value)
            ):
                out.append(value)
    return out


def _standing(element: Element) -> float:
    """What an element is worth before any text."""
    points = {"article": 30.0, "main": 20.0, "section": 5.0, "div": 5.0, "pre": 3.0, "td": 3.0, "blockquote": 3.0}.get(
        element.tag, 0.0
    )
    if element.tag in ("ul", "ol", "dl", "li", "address"):
        points -= 3
    if element.names and GOOD_NAMES.search(element.names):
        points += 25
    if element.suspect:
        points -= 25
    return points


def _link_list(element: Element) -> bool:
    """Whether an element is mostly links; one marked as the article's or the main part may list its sources."""
    return (
        element.tag in ("ul", "ol", "div", "table", "dl", "section")
        and not element.inside
        and element.links > 1
        and element.link_density > 0.6
    )


def extract(html: str | None) -> str:
    return "\n\n".join(main_blocks(html or ""))


def main_texts(pages: DataFrame, html: str = "html") -> DataFrame:
    """The columns of ``pages`` but the markup, with ``text`` and ``n_chars`` (code points).

    They replace columns of those names.  A null or empty page, or one without any article
    text, gives an empty text.  A page is worked on whole, whatever its length; repeated
    rows give a row each and an empty table none.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in pages.columns if c != html])
    source = pages.select(row.alias("row"), F.col(html).alias("html"))

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts = [extract(x) for x in batch.column(1).to_pylist()]
        yield pa.record_batch(
            [batch.column(0), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
            ["row", "text", "n_chars"],
        )

    kind = T.StructType([source.schema["row"], *T.StructType.fromDDL("text string, n_chars long")])
    return map_rows(source, run, kind).select(
        *[F.col(f"row.`{c}`").alias(c) for c in pages.columns if c not in (html, "text", "n_chars")],
        "text",
        "n_chars",
    )
