"""A tolerant reader of HTML: blocks of text with where they stand, and the page's tokens."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import lru_cache
from html import unescape

import xxhash

_MARKUP = re.compile(
    r"<!--.*?(?:-->|--!>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(>|\Z)", re.S
)
_ATTR = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]*))?")

# Elements by how HTML lays them out or ends them.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search "
    "section summary table tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes plaintext".split())
ENDS_P = BLOCKS - frozenset("body caption head html legend option optgroup tbody td tfoot th thead title tr".split())
#: A start tag ends an open element of these, up to one of the limits.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table", "tbody", "thead", "tfoot"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select", "datalist", "optgroup"}),
    "body": ({"head"}, {"html"}),
}
SCOPE = frozenset("table td th caption html template button object".split())

#: Elements whose text is never the article's.
OUTSIDE = frozenset(
    "head script style noscript template iframe noembed noframes nav footer aside form button select textarea dialog "
    "svg math canvas audio video object search menu".split()
)
OUTSIDE_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar tooltip status".split()
)
#: Class names and ids that mark what is not the article, by themselves or joined with each other and with ``QUALIFIERS``.
OUTSIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertisements advertising adsbygoogle adslot adbox banner banners sponsor sponsored "
    "sponsors promo promos promoted promotion nav navbar navigation menu menus submenu breadcrumb breadcrumbs masthead topbar "
    "footer sitefooter sidebar sidebars aside widget widgets cookie cookies consent gdpr notice notices alert alerts popup "
    "modal overlay newsletter subscribe subscription signup login share sharing social related recommended recommendations "
    "trending comment comments commentlist respond disqus discussion replies pagination pager toolbar skip hidden "
    "paywall search searchbox".split()
)
QUALIFIERS = frozenset(
    "site page global main primary secondary left right top bottom inner outer floating sticky fixed reader user visitor "
    "social post posts article articles story stories news blog category link links list item items area box block bar "
    "section container wrapper wrap panel slot unit zone group form thread count button buttons text title icon icons "
    "visually mobile desktop header head".split()
)
ARTICLE_WORDS = frozenset("article articlebody post postbody entry story content maincontent".split())
HEADER_WORDS = frozenset({"header", "head"})
_WORDS = re.compile(r"[a-z0-9]+")


def _lift(page: "Page", of_blocks: list, of_regions: list) -> None:
    """Settle what elements that only a name or a form marks leave outside.

    They leave it out where the page shows text of an article, a main or a named element without them. Else
    those round an article or main element do not count, and without such those with most of the page's text.
    """
    shown, held, total = False, {}, 0
    for (text, region, _, outside), marked in zip(page.blocks, of_blocks):
        if not outside:
            shown |= not marked and region is not None
            total += len(text)
            for k in marked:
                held[k] = held.get(k, 0) + len(text)
    lifted = set()
    if held and not shown:
        for (kind, _, _, outside), marked in zip(page.regions, of_regions):
            if kind in ("article", "main") and not outside:
                lifted.update(marked)
        # A region may be empty, or what it holds be marked too.
        if not any(m and r is not None and not o and lifted.issuperset(m) for (_, r, _, o), m in zip(page.blocks, of_blocks)):
            lifted.update(k for k, n in held.items() if 2 * n > total)
    page.blocks = [(*b[:3], b[3] or not lifted.issuperset(m)) for b, m in zip(page.blocks, of_blocks)]
    page.regions = [(*r[:3], r[3] or not lifted.issuperset(m)) for r, m in zip(page.regions, of_regions)]


@dataclass
class Element:
    tag: str
    path: int
    outside: bool
    region: int | None
    kind: str | None
    marked: tuple[int, ...] = ()  # the elements around it that only a name or a form marks outside


@dataclass
class Page:
    """``blocks``: (text, region, token, whether any element around it is outside the article)."""

    blocks: list = field(default_factory=list)
    tokens: list = field(default_factory=list)
    regions: list = field(default_factory=list)  # (kind, token of the element, its region above)


def _child(path: int, name: str) -> int:
    return xxhash.xxh64_intdigest(name, path)


def _attributes(text: str) -> dict[str, str]:
    out = {}
    for m in _ATTR.finditer(text):
        value = m[2] or ""
        if value[:1] in "\"'":
            value = value[1:-1]
        out.setdefault(m[1].lower(), unescape(value))
    return out


@lru_cache(maxsize=4096)
def _marks(marks: str, words: frozenset[str]) -> bool:
    """Whether one of the class names is one of the words, or made of such words and qualifiers only."""
    for name in marks.split():
        parts = _WORDS.findall(name)
        if not words.isdisjoint(parts) and all(p in words or p in QUALIFIERS or p.isdigit() for p in parts):
            return True
    return False


def _judge(tag: str, attrs: dict[str, str], in_article: bool) -> tuple[bool, bool, str | None, str]:
    """Whether an element lies outside the article, whether only its name or a form says so, which kind of region
    it starts, and its name for tokens."""
    form = tag == "form"
    if not attrs:
        outside = tag in OUTSIDE or (tag == "header" and not in_article)
        return outside and not form, form, tag if tag in ("article", "main") else None, tag
    marks = f"{attrs.get('class', '')} {attrs.get('id', '')}".lower()
    words = _WORDS.findall(marks)
    role = attrs.get("role", "").lower()
    style = attrs.get("style", "").replace(" ", "").lower()
    outside = (
        (tag in OUTSIDE and not form)
        or (tag == "header" and not in_article)
        or role in OUTSIDE_ROLES
        or "hidden" in attrs
        or "display:none" in style
        or attrs.get("aria-hidden", "").lower() == "true"
    )
    words_mark = tag not in ("html", "body", "article", "main")
    marked = form or (words_mark and _marks(marks, OUTSIDE_WORDS))
    marked = marked or (words_mark and not in_article and _marks(marks, HEADER_WORDS))
    kind = tag if tag in ("article", "main") else None
    if not kind and not outside and not marked:
        if role in ("main", "article") or "articlebody" in attrs.get("itemprop", "").lower():
            kind = "main" if role == "main" else "article"
        elif tag in ("div", "section") and not ARTICLE_WORDS.isdisjoint(words):
            kind = "named"
    return outside, marked and not outside, kind, f"{tag}.{' '.join(sorted(re.sub(r'[0-9]+', '#', marks).split()))}"


def read_page(html: str) -> Page:
    page = Page()
    stack = [Element("", 0, False, None, None)]
    pieces: list[str] = []
    of_blocks: list[tuple[int, ...]] = []
    of_regions: list[tuple[int, ...]] = []
    n_marked = 0

    def flush():
        text = " ".join(unescape("".join(pieces)).split()) if pieces else ""
        pieces.clear()
        if text:
            top = stack[-1]
            token = _child(top.path, f"={text}")
            page.tokens.append(token)
            page.blocks.append((text, top.region, token, top.outside))
            of_blocks.append(top.marked)

    def close(n: int):
        flush()
        for e in reversed(stack[n:]):
            page.tokens.append(_child(e.path, "/"))
        del stack[n:]

    at, end = 0, len(html)
    while at < end:
        m = _MARKUP.search(html, at)
        if not m:
            # A tag that the page's end cuts off is dropped with what it holds.
            pieces.append(html[at:])
            break
        if m.start() > at:
            pieces.append(html[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        if not m[4]:
            break
        tag = m[2].lower()
        if m[1]:
            if tag == "p" and not any(e.tag == "p" for e in stack):
                flush()
                continue
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    if tag in BLOCKS or tag in OUTSIDE:
                        close(i)
                    elif all(e.tag not in BLOCKS for e in stack[i:]):
                        del stack[i:]
                    break
                if stack[i].tag in SCOPE and tag not in SCOPE and tag not in ("body", "html", "article", "main"):
                    break
            continue
        if tag == "br" or tag == "wbr":
            pieces.append(" " if tag == "br" else "")
            continue
        block = tag in BLOCKS or tag in OUTSIDE
        if block:
            flush()
        if tag in ENDS_P:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == "p":
                    close(i)
                    break
                if stack[i].tag in SCOPE:
                    break
        if tag in IMPLIED:
            ends, limits = IMPLIED[tag]
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in ends:
                    close(i)
                elif stack[i].tag in limits:
                    break
        attrs = _attributes(m[3]) if m[3].strip(" /\n\t\r") else {}
        top = stack[-1]
        in_article = any(e.kind in ("article", "named") for e in stack)
        outside, mark, kind, name = _judge(tag, attrs, in_article)
        if tag in VOID:
            page.tokens.append(_child(top.path, name))
            continue
        if not block and not kind and not outside and not mark and tag not in RAW:
            # Inline elements lay out no block; only the path of what they hold would differ.
            stack.append(Element(tag, top.path, top.outside, top.region, None, top.marked))
            continue
        if not block:
            flush()
        path = _child(top.path, name)
        region, marked = top.region, top.marked
        if mark:
            marked = (*marked, n_marked)
            n_marked += 1
        if kind:
            page.regions.append((kind, path, region, outside or top.outside))
            of_regions.append(marked)
            region = len(page.regions) - 1
        page.tokens.append(path)
        stack.append(Element(tag, path, outside or top.outside, region, kind, marked))
        if tag in RAW:
            stop = re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I).search(html, at)
            raw_end = stop.start() if stop else end
            if tag == "title" or tag == "textarea":
                pieces.append(html[at:raw_end])
            at = raw_end
            if not stop:
                break
    close(1)
    if n_marked:
        _lift(page, of_blocks, of_regions)
    return page
