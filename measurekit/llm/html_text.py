"""Main text of web pages by composite text density.

A page becomes a tree of elements. Parts that are no article by their own statement (menus, headers, footers, sidebars, notices, adverts,
forms, scripts, styles, reader comments: by element, role or name) are taken out. Every element that is left has a density: its
characters per tag, lowered by the share of its characters and tags that belong to links, against the same share of the whole body.
The element with the largest sum of its children's densities is the core. The smallest density on the path from it to the body
is the threshold: the path's upper end, and every other part of the body whose density reaches the threshold, by its own
core, belong to the text. An enclosing ``article`` or ``main`` is taken whole, less its lists of links.

Text is put together block by block in page order: character references are decoded, white space inside a block (line breaks and
table cells included) is one space, blocks are joined by a line feed.

Defined results: null and empty pages, and pages with nothing but left-out parts, have the empty text and 0 characters; unclosed and wrongly nested
elements are closed as browsers close them; an unclosed comment, script or tag takes the rest of the page; a page of any length or depth is
read once, in time linear in its length, without recursion; repeated rows stay; other columns stay, those called like an output column are
replaced; an empty table gives an empty table.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import map_column

#: Elements by their part in a page.
VOID = frozenset("area base basefont bgsound br col embed frame hr img input keygen link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span strike "
    "strong sub sup td th time tt u var wbr".split()
)
#: These end an open paragraph.
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup "
    "hr main menu nav ol p pre search section summary table ul li dd dt xmp".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: An element of this kind ends open elements of those kinds, up to the nearest of the third.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dd": ({"dd", "dt"}, {"dl"}),
    "dt": ({"dd", "dt"}, {"dl"}),
    "option": ({"option"}, {"select"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "a": ({"a"}, {"td", "th", "table"}),
}
#: No end tag reaches beyond these.
WALLS = frozenset("table td th caption object button".split())
#: Never part of the main text.
LEFT_OUT = frozenset(
    "script style noscript template nav footer aside form button select option textarea iframe object embed svg math canvas audio video map "
    "dialog menu head title noframes noembed datalist".split()
)
LEFT_OUT_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar tooltip form status".split())
#: Words that begin or end the name (class or id) of a part that is left out.
LEFT_OUT_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adsense sponsor sponsors sponsored promo promos promotion promotions "
    "banner banners sidebar sidebars aside menu menus submenu nav navs navbar navigation breadcrumb breadcrumbs footer footers masthead "
    "topbar toolbar cookie cookies consent gdpr notice notices notification notifications alert alerts disclaimer copyright popup popups modal "
    "overlay newsletter subscribe subscription signup signin login share sharing sharebar social related recommended recommendations "
    "comment comments commentlist disqus discussion reply replies respond form forms widget widgets pagination pager".split()
)
HEADER_NAMES = frozenset({"header", "headers"})
#: Beginnings of names that say what a part has or lacks, not what it is.
HAVING = frozenset("has with no is not without".split())
STATES = frozenset("open closed enabled disabled active on off".split())

TAG = re.compile(r"<(?:(!--)|([!?])|(/?)([a-zA-Z][^\s/>]*))")
COMMENT_END = re.compile(r"--!?>")
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")


@dataclass
class Page:
    """Elements of a page in page order (a parent before its children), and its pieces of text with the breaks between blocks."""

    tags: list[str] = field(default_factory=lambda: ["#page"])
    parents: list[int] = field(default_factory=lambda: [-1])
    names: list[dict[str, str]] = field(default_factory=lambda: [{}])
    #: (element, text, inside a link), with None for a break.
    pieces: list[tuple[int, str, bool] | None] = field(default_factory=list)


def attributes(html: str, at: int) -> tuple[dict[str, str], int, bool]:
    """Attributes from ``at``, the place behind the tag's end (-1: the page ends inside it), and whether the tag closes itself."""
    end = html.find(">", at)
    if end < 0:
        return {}, -1, False
    inside = html[at:end]
    if not inside or inside.isspace() or inside == "/":
        return {}, end + 1, inside.endswith("/")
    found: dict[str, str] = {}
    size = len(html)
    while at < size:
        char = html[at]
        if char == ">":
            return found, at + 1, html[at - 1] == "/"
        if char.isspace() or char == "/":
            at += 1
            continue
        start = at
        at += 1  # an equals sign in front belongs to the name
        while at < size and html[at] not in "=/> \t\n\r\f":
            at += 1
        name = html[start:at].lower()
        stop = at
        while at < size and html[at].isspace():
            at += 1
        if at >= size or html[at] != "=":
            found.setdefault(name, "")
            at = max(stop, at)
            continue
        at += 1
        while at < size and html[at].isspace():
            at += 1
        if at < size and html[at] in "\"'":
            close = html.find(html[at], at + 1)
            if close < 0:
                return found, -1, False
            found.setdefault(name, html[at + 1 : close])
            at = close + 1
        else:
            start = at
            while at < size and html[at] not in "> \t\n\r\f":
                at += 1
            found.setdefault(name, html[start:at])
    return found, -1, False


def raw_end(html: str, name: str, at: int) -> tuple[int, int]:
    """Where the content of a raw element ends, and where the page goes on."""
    for found in re.compile(f"</{re.escape(name)}(?=[\\s/>])", re.IGNORECASE).finditer(html, at):
        close = html.find(">", found.end())
        return found.start(), len(html) if close < 0 else close + 1
    return len(html), len(html)


def parse(html: str) -> Page:
    page = Page()
    tags, parents, names, pieces = page.tags, page.parents, page.names, page.pieces
    stack = [0]
    counts: dict[str, int] = {}
    links = 0

    def close_to(depth: int) -> None:
        nonlocal links
        while len(stack) > depth:
            name = tags[stack.pop()]
            counts[name] -= 1
            links = max(links - (name == "a"), 0)
            if name not in INLINE:
                pieces.append(None)

    def close_open(kinds, until) -> None:
        if not any(counts.get(k) for k in kinds):
            return
        depth, lowest = len(stack) - 1, 0
        while depth > 0:
            name = tags[stack[depth]]
            if name in kinds:
                lowest = depth
                if len(kinds) == 1:
                    break
            elif name in until:
                break
            depth -= 1
        if lowest:
            close_to(lowest)

    def text(piece: str) -> None:
        if piece:
            pieces.append((stack[-1], unescape(piece) if "&" in piece else piece, links > 0))

    at, size = 0, len(html)
    while at < size:
        found = TAG.search(html, at)
        if found is None:
            text(html[at:])
            break
        text(html[at : found.start()])
        comment, bogus, closing, name = found.groups()
        at = found.end()
        if comment:
            if html.startswith(">", at) or html.startswith("->", at):
                at = html.index(">", at) + 1
                continue
            end = COMMENT_END.search(html, at)
            at = size if end is None else end.end()
            continue
        if bogus:
            cdata = html.startswith("[CDATA[", at) and counts.get("svg", 0) + counts.get("math", 0) > 0
            end = html.find("]]>" if cdata else ">", at)
            at = size if end < 0 else end + (3 if cdata else 1)
            continue
        name = name.lower()
        found_attributes, at, itself = attributes(html, at)
        if at < 0:
            break
        if closing:
            if name in ("body", "html"):
                pieces.append(None)  # what follows still belongs to the body
            elif name == "br":
                text(" ")
            elif counts.get(name):
                depth = len(stack) - 1
                inline = name in INLINE and name not in WALLS
                while tags[stack[depth]] != name:
                    other = tags[stack[depth]]
                    if (inline and other not in INLINE) or (other in WALLS and name not in ("table", "tr", "tbody", "thead", "tfoot", *WALLS) and name not in CLOSES_P):
                        depth = 0
                        break
                    depth -= 1
                if depth:
                    close_to(depth)
                elif name == "a":
                    links = 0  # the link ends here, though its element stays open around a block
            elif name == "p":
                pieces.append(None)
            continue
        if name == "html" or name == "body":
            if counts.get(name):
                continue
            if name == "body":
                close_open({"head"}, ())
        if name in CLOSES_P and counts.get("p"):
            close_open({"p"}, WALLS)
        if name in HEADINGS and tags[stack[-1]] in HEADINGS:
            close_to(len(stack) - 1)
        if name in ENDS:
            close_open(*ENDS[name])
        node = len(tags)
        tags.append(name)
        parents.append(stack[-1])
        names.append(found_attributes)
        if name not in INLINE:
            pieces.append(None)
        elif name in ("br", "td", "th"):
            pieces.append((stack[-1], " ", links > 0))
        if name in VOID or (itself and counts.get("svg", 0) + counts.get("math", 0) + (name in ("svg", "math")) > 0):
            continue
        if name in RAW and not (counts.get("svg") or counts.get("math")):
            _, at = raw_end(html, name, at)
            continue
        stack.append(node)
        counts[name] = counts.get(name, 0) + 1
        links += name == "a"
    return page


def says_no_article(value: str, inside: bool) -> bool:
    """Whether a class or id names a part that is left out."""
    for name in value.split():
        words = [w.lower() for w in WORD.findall(name)]
        if not words or words[0] in HAVING or words[-1] in STATES:
            continue
        if words[0] in LEFT_OUT_NAMES or words[-1] in LEFT_OUT_NAMES:
            return True
        if not inside and (words[0] in HEADER_NAMES or words[-1] in HEADER_NAMES):
            return True
    return False


def left_out(page: Page) -> list[bool]:
    """The elements that are no part of the article, with all inside them."""
    tags, parents, names = page.tags, page.parents, page.names
    count = len(tags)
    noted = [False] * count
    for i in range(1, count):
        own = names[i]
        if own:
            noted[i] = says_no_article(own.get("class", ""), True) or says_no_article(own.get("id", ""), True)
    # a wrapper is judged by what it holds, not by its name: the page's heading with paragraphs, a main part or an article
    heads, paragraphs, wraps = [0] * count, [0] * count, [False] * count
    for i in range(count - 1, 0, -1):
        heads[i] += tags[i] == "h1"
        paragraphs[i] += tags[i] == "p"
        wraps[i] = wraps[i] or tags[i] == "main" or (tags[i] == "article" and not noted[i])
        up = parents[i]
        heads[up] += heads[i]
        paragraphs[up] += paragraphs[i]
        wraps[up] = wraps[up] or wraps[i]
    out, inside = [False] * count, [False] * count
    for i in range(1, count):
        up, tag, own = parents[i], tags[i], names[i]
        role = own.get("role", "").strip().lower()
        inside[i] = inside[up] or tag in ("article", "main") or role == "main"
        if out[up]:
            out[i] = True
        elif tag in ("html", "body", "main"):
            continue
        elif tag in LEFT_OUT or role in LEFT_OUT_ROLES or "hidden" in own or own.get("aria-hidden", "").lower() == "true":
            out[i] = not (tag == "form" and wraps[i])
        elif tag == "header" and not inside[up]:
            out[i] = not wraps[i]
        elif own:
            style = own.get("style", "").replace(" ", "").lower()
            if "display:none" in style or "visibility:hidden" in style:
                out[i] = True
            elif noted[i] or says_no_article(own.get("class", ""), inside[up]) or says_no_article(own.get("id", ""), inside[up]):
                out[i] = not (wraps[i] or (heads[i] and paragraphs[i]))
    return out


def densities(page: Page, out: list[bool]) -> tuple[list[float], list[float], list[int], list[int]]:
    """Composite density and density sum of every element, and its characters, all and in links.

    An element's own text, outside of its child blocks, counts in its sum like one more child.
    """
    tags, parents = page.tags, page.parents
    count = len(tags)
    chars, linked, inner, inner_links = [0] * count, [0] * count, [0] * count, [0] * count
    own, own_linked = [0] * count, [0] * count
    holder = [0] * count  # the block around an inline element's text
    for i in range(1, count):
        holder[i] = holder[parents[i]] if tags[i] in INLINE else i
    for piece in page.pieces:
        if piece is None or out[piece[0]] or piece[1].isspace():
            continue
        node, text, link = piece
        chars[node] += len(text)
        own[holder[node]] += len(text)
        if link:
            linked[node] += len(text)
            own_linked[holder[node]] += len(text)
    for i in range(count - 1, 0, -1):
        if not out[i]:
            up = parents[i]
            chars[up] += chars[i]
            linked[up] += linked[i]
            inner[up] += inner[i] + 1
            inner_links[up] += inner_links[i] + (tags[i] == "a")
    whole, whole_linked = max(chars[0], 1), max(linked[0], 1)

    def density(size: int, link: int, n: int, n_links: int) -> float:
        if size <= 0:
            return 0.0
        n, n_links = max(n, 1), max(n_links, 1)
        rest, part = max(size - link, 1), max(link, 1)
        base = math.log(size / rest * part + whole_linked / whole * size + math.e)
        value = size / part * n / n_links
        return size / n * math.log(value) / math.log(base) if value > 1 else 0.0

    dense, sums = [0.0] * count, [0.0] * count
    for i in range(count - 1, -1, -1):
        if out[i] or (tags[i] in INLINE and i):
            continue
        dense[i] = density(chars[i], linked[i], inner[i], inner_links[i])
        sums[i] += density(own[i], own_linked[i], 1, 0)
        if i:
            sums[holder[parents[i]]] += dense[i]
    return dense, sums, chars, linked


def chosen(page: Page, out: list[bool]) -> list[bool]:
    """The elements whose text is the main text."""
    tags, parents, names = page.tags, page.parents, page.names
    count = len(tags)
    dense, sums, chars, linked = densities(page, out)
    body = next((i for i in range(1, count) if tags[i] == "body"), 0)
    block = [not out[i] and (tags[i] not in INLINE or i == 0) for i in range(count)]
    # a block without blocks inside is a part of a text, not its core
    holds = [False] * count
    for i in range(count - 1, body, -1):
        if not out[i] and (holds[i] or tags[i] not in INLINE):
            holds[parents[i]] = True
    best = body
    for i in range(body, count):
        if block[i] and holds[i] and sums[i] > sums[best]:
            best = i
    # the threshold, and the upper end of the path
    path = [best]
    while path[-1] != body and parents[path[-1]] > 0:
        path.append(parents[path[-1]])
    threshold = min(dense[i] for i in path if block[i] and (i != body or i == best))
    on_path = set(path)
    core = best
    for i in path:
        if tags[i] in ("article", "main") or names[i].get("role") == "main":
            core = i
            if tags[i] == "article":
                break
    within, seed = [False] * count, [False] * count
    semantic = tags[core] in ("article", "main") or names[core].get("role") == "main"
    for i in range(body + 1, count):
        up = parents[i]
        if i in on_path or not block[i] or threshold <= 0 or dense[i] < threshold:
            continue
        if not semantic:  # a dense block brings along the blocks beside it
            seed[i if up in on_path or up <= body else up] = True
        elif tags[i] == "article" and up == parents[core]:  # beside an article only articles of the same part count
            seed[i] = True
    for i in range(body, count):
        up = parents[i]
        within[i] = not out[i] and (i == core or seed[i] or (up >= 0 and within[up]))
    # what is left of menus: groups of links without a name of their own
    items, link_count = [0] * count, [0] * count
    for i in range(count - 1, 0, -1):
        link_count[i] += tags[i] == "a"
        items[i] += tags[i] == "li"
        items[parents[i]] += items[i]
        link_count[parents[i]] += link_count[i]
    cut = [False] * count
    for i in range(body, count):
        up = parents[i]
        cut[i] = (up >= 0 and cut[up]) or (tags[i] in ("ul", "ol", "dl", "div", "section", "table", "td") and link_count[i] > 1 and linked[i] * 10 > chars[i] * 9)
    return [within[i] and not cut[i] and not out[i] for i in range(count)]


def main_text(html: str | None) -> str:
    """The main text of one page."""
    if not html:
        return ""
    page = parse(html)
    keep = chosen(page, left_out(page))
    blocks: list[str] = []
    now: list[str] = []
    for piece in page.pieces:
        if piece is None:
            if now:
                blocks.append(" ".join("".join(now).split()))
                now = []
        elif keep[piece[0]]:
            now.append(piece[1])
    blocks.append(" ".join("".join(now).split()))
    return "\n".join(b for b in blocks if b)


def extract(pages: DataFrame, html: str = "html", out: str = "text") -> DataFrame:
    """``pages`` with the main text and ``n_chars``, its number of code points."""

    def make():
        return lambda column: pa.array([main_text(h) for h in column.to_pylist()], pa.string())

    found = map_column(pages, html, out, "string", make)
    return found.withColumn("n_chars", F.length(F.col(f"`{out}`")).cast("long"))
