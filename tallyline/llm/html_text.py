"""Main text of web pages by tag-path ratios.

Each block of a page has a path of labels from the root to its element. Text length and punctuation are summed
per path and divided by the number of blocks on it, and fused into one score per block. The scores choose the
content node of a page without a content container; every block inside the container or node is kept, headings
and list items too, unless it stands in an element that is no content by its kind, name or role (menus, forms,
adverts, comments and the like).
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import DataFrame

from tallyline.llm.textmap import with_text_columns

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(?P<end>/?)(?P<tag>[A-Za-z][A-Za-z0-9:-]*)(?P<attributes>(?:\"[^\"]*\"|'[^']*'|[^>\"'])*)>",
    re.S,
)
ATTRIBUTE = re.compile(r"""(class|id|role|hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.I)

# Kinds of HTML elements.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q ruby rb rp rt s samp"
    " small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template noembed noframes xmp".split())
NO_CONTENT = frozenset(
    "head nav header footer aside form button select option input fieldset dialog svg math canvas object audio"
    " video map menu".split()
) | RAW
# An open element of the first kind ends where another begins, unless one of the second stands between.
ENDS_AT_NEXT = {
    "li": ("ul", "ol", "menu"),
    "dt": ("dl",),
    "dd": ("dl",),
    "tr": ("table",),
    "td": ("tr", "table"),
    "th": ("tr", "table"),
    "option": ("select",),
}
PARTNER = {"dt": "dd", "dd": "dt", "td": "th", "th": "td"}
CONTAINERS = frozenset(("article", "main"))
# Whole page or content whatever their class says.
NEVER_NAMED = frozenset(("html", "body", "article", "main"))
NO_CONTENT_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split()
)
CONTENT_NAMES = frozenset("article content main post entry story".split())
NO_CONTENT_NAMES = frozenset(
    "nav navbar navigation menu menubar header masthead topbar footer bottombar sidebar aside rail ad ads advert"
    " adverts advertisement advertising adsense adslot banner sponsor sponsored sponsors promo promotion notice"
    " notices notification alert cookie cookies consent gdpr disclaimer popup modal overlay newsletter subscribe"
    " subscription signup login share sharing social follow comment comments commentlist disqus reply replies"
    " respond discussion related recommended recommendations breadcrumb breadcrumbs pagination pager widget"
    " widgets skip".split()
)
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
PUNCTUATION = re.compile(r"[.,;:!?…。，、；：！？]")

# Elements that can hold an article.
SECTIONS = frozenset(("div", "section", "article", "main"))
# Share of the page's undropped text that its articles need, and that an element named as content has to exceed.
LEAST_HELD, MOST_HELD = 0.2, 0.5
# Share of its parent's score from which an element is the content node.
THRESHOLD = 0.8


@dataclass(slots=True)
class Element:
    tag: str
    label: str
    dropped: bool
    content: bool
    named: bool
    path: str
    parent: Element | None


def _names(value: str) -> set[str]:
    return {part.lower() for part in NAME_PART.findall(value)}


def _element(tag: str, attributes: str, parent: Element | None) -> Element:
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(attributes)} if attributes else {}
    named = f"{found.get('class', '')} {found.get('id', '')}".strip()
    names = _names(named) if named and tag not in NEVER_NAMED else set()
    role = found.get("role", "").strip().lower()
    dropped = (
        tag in NO_CONTENT
        or "hidden" in found
        or role in NO_CONTENT_ROLES
        or bool(names & NO_CONTENT_NAMES)
        or (parent is not None and parent.dropped)
    )
    label = f"{tag}.{named}" if named else tag
    path = f"{parent.path}/{label}" if parent else label
    content = tag in CONTAINERS or (role == "main" and tag in SECTIONS)
    return Element(tag, label, dropped, content, tag in SECTIONS and bool(names & CONTENT_NAMES), path, parent)


def _sections(element: Element | None) -> list[Element]:
    """The element and those around it that can hold an article, outermost first."""
    found = []
    while element:
        if element.tag in SECTIONS:
            found.append(element)
        element = element.parent
    return found[::-1]


def _blocks(page: str) -> list[tuple[Element | None, str]]:
    """The page's runs of text between block boundaries, in order, with the block element each stands in."""
    blocks: list[tuple[Element | None, str]] = []
    stack: list[Element] = []
    texts: list[str] = []

    def holder() -> Element | None:
        return next((e for e in reversed(stack) if e.tag not in INLINE or e.dropped), None)

    def close_block() -> None:
        text = " ".join("".join(texts).split())
        texts.clear()
        if text:
            blocks.append((holder(), text))

    def end_open(tags: tuple[str, ...], stops: tuple[str, ...]) -> None:
        for at in range(len(stack) - 1, -1, -1):
            if stack[at].tag in tags:
                del stack[at:]
                return
            if stack[at].tag in stops or (not stops and stack[at].tag not in INLINE):
                return

    at = 0
    while at < len(page):
        token = TOKEN.search(page, at)
        until = token.start() if token else len(page)
        if until > at:
            texts.append(html.unescape(page[at:until]))
        if token is None:
            break
        at = token.end()
        if token["tag"] is None:
            continue
        tag = token["tag"].lower()
        inline = tag in INLINE
        if token["end"]:
            opened = next((i for i in range(len(stack) - 1, -1, -1) if stack[i].tag == tag), None)
            if opened is None:
                continue
            if not inline or stack[opened].dropped:
                close_block()
            elif any(e.tag not in INLINE for e in stack[opened:]):
                continue
            del stack[opened:]
            continue
        element_dropped = False
        if not inline:
            close_block()
            end_open(("p",), ())
            if tag in ENDS_AT_NEXT:
                end_open((tag, PARTNER.get(tag, tag)), ENDS_AT_NEXT[tag])
        if tag in VOID:
            if tag in ("br", "hr"):
                texts.append(" ")
            continue
        element = _element(tag, token["attributes"], stack[-1] if stack else None)
        element_dropped = inline and element.dropped and not (stack and stack[-1].dropped)
        if element_dropped:
            close_block()
        if token["attributes"].endswith("/") and tag in ("svg", "math"):
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        stack.append(element)
    close_block()
    return blocks


def main_text(page: str | None) -> str:
    """Kept blocks of ``page``, joined by line breaks."""
    blocks = [(e, text) for e, text in _blocks(page or "") if not (e and e.dropped)]
    around = {id(e): _sections(e) for e, _ in blocks}
    total = sum(len(text) for _, text in blocks)

    def joined(kept: list[tuple[Element | None, str]]) -> str:
        return "\n".join(text for _, text in kept)

    # Articles hold the text and what stands outside them does not count, unless they are mere notes beside it.
    held = [b for b in blocks if any(s.content for s in around[id(b[0])])]
    if held and sum(len(text) for _, text in held) >= LEAST_HELD * total:
        return joined(held)
    length: dict[int, int] = defaultdict(int)
    named: dict[int, None] = {}
    for element, text in blocks:
        for section in around[id(element)]:
            length[id(section)] += len(text)
            if section.named:
                named[id(section)] = None
    # The outermost comes first, so a title above the part named as content stays.
    for node in named:
        if length[node] > MOST_HELD * total:
            return joined([b for b in blocks if any(id(s) == node for s in around[id(b[0])])])
    # Ratios by path: text length times punctuation, both a block.
    sizes: dict[str, list[int]] = defaultdict(lambda: [0, 0, 0])
    for element, text in blocks:
        path = sizes[element.path if element else ""]
        path[0] += len(text)
        path[1] += len(PUNCTUATION.findall(text))
        path[2] += 1
    score = {path: n / k * (1 + marks / k) for path, (n, marks, k) in sizes.items()}
    weight: dict[int, float] = defaultdict(float)
    for element, _ in blocks:
        for section in around[id(element)]:
            weight[id(section)] += score[element.path]
    depth, best = 0, sum(score[e.path if e else ""] for e, _ in blocks)
    while True:
        inside = [b for b in blocks if len(around[id(b[0])]) > depth]
        top = max((id(around[id(e)][depth]) for e, _ in inside), key=weight.__getitem__, default=None)
        if top is None or weight[top] < THRESHOLD * best:
            return joined(blocks)
        blocks = [b for b in inside if id(around[id(b[0])][depth]) == top]
        depth, best = depth + 1, weight[top]


def extract_text(df: DataFrame, page: str = "html", text: str = "text") -> DataFrame:
    """``df`` with the main text of each page in a column ``text``.

    White space inside a block becomes one space and blocks are joined by one line break. Null and empty pages
    and pages without content give an empty text; repeated pages are read alike; an existing column named
    ``text`` is replaced.
    """
    return with_text_columns(df, page, f"`{text}` string", lambda: lambda pages: [[main_text(p) for p in pages]])
