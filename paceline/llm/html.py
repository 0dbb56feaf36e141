"""Main text of web pages by tree scoring.

Each paragraph passes points for its length and commas to its ancestors, less with distance. A
container's points are discounted by its link density; the best container is the article, and those
siblings are kept that read like part of it. Elements that by tag, role or name are no part of an
article (menus, notices, adverts, forms, comments and the like) are left out beforehand, but only
where they hold a small share of the paragraph points: a wrapper of the whole page may be a form or
have "sidebar" in its class.
"""

from __future__ import annotations

import re
from html import unescape

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paceline.llm.common import in_pieces

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>?"
    r"|<(?P<end>/?)(?P<tag>[A-Za-z][^\s/>]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[A-Za-z][^\s/>]*+)(?P<attrs2>[^>]*+)(?:>|\Z)", re.S)
_ATTR = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no markup.
_RAW = frozenset("script style noscript template iframe textarea title xmp noembed noframes".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong "
    "sub sup time tt u var wbr br".split())
#: A start tag closes these open elements first.
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
           "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"thead", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"}}
_SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"},
           "option": {"select"}, "thead": {"table"}, "tbody": {"table"}, "tfoot": {"table"}}
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_PARAGRAPHS = frozenset("p pre blockquote li dd dt td th figcaption".split()) | _HEADINGS

#: Elements that never hold text of an article.
_NO_TEXT = frozenset(
    "head script style noscript template iframe button select textarea input svg math object canvas audio video map".split())
#: Elements, roles and names that are no part of an article unless most of its paragraphs stand inside.
_LEFT_OUT = frozenset("nav footer aside form dialog menu fieldset".split())
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar status".split())
_NAMES = re.compile(
    r"ads?|advert\w*|adsense|adbox|adslot|sponsor\w*|promo\w*|banner\w*|cookie\w*|consent\w*|notices?|gdpr|popup|modal|overlay|newsletter\w*|"
    r"subscri\w+|signup|login|nav\w*|menus?|breadcrumbs?|sidebar\w*|aside|footer\w*|masthead|toolbar|share|sharing|social\w*|related\w*|"
    r"recommend\w*|widgets?|pager|pagination|skip|disclaimer|alert|warning|form|search\w*")
_COMMENTS = re.compile(r"comments?|commentlist|disqus\w*|respond|guestbook")
#: Comments in some pages, sections of an article in others.
_MAYBE_COMMENTS = re.compile(r"commentary|repl(?:y|ies)|responses?|discussion")
#: Classes that tell the state of a page or a wrapper, not what the element is.
_STATE = re.compile(r"(?:no|has|with|without|hide|hides)[-_].*|.*[-_](?:open|opened|closed|collapsed|expanded|enabled|disabled)")
#: An element stays in spite of its name from this share of the article's or page's points on, and from these points on.
_SHARE, _POINTS = 0.5, 5.0
_HEADER = re.compile(r"headers?|topbar|site-?title|branding")


class _Node:
    __slots__ = ("tag", "parent", "kids", "names", "role", "hidden", "out", "points", "chars", "linked")

    def __init__(self, tag: str, parent: _Node | None, attrs: str = ""):
        self.tag, self.parent, self.kids = tag, parent, []
        self.names, self.role, self.hidden = [], "", False
        self.out, self.points, self.chars, self.linked = False, 0.0, 0, 0
        if attrs and not attrs.isspace():
            for name, a, b, c in _ATTR.findall(attrs):
                name, value = name.lower(), (a or b or c).lower()
                if name in ("class", "id"):
                    self.names += [n for word in value.split() if not _STATE.fullmatch(word) for n in re.split(r"[^a-z0-9]+", word)]
                elif name == "role":
                    self.role = value.strip()
                elif name == "hidden" or (name == "aria-hidden" and value == "true") or (
                        name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value)):
                    self.hidden = True

    def up(self):
        node = self.parent
        while node is not None:
            yield node
            node = node.parent


def parse(html: str) -> _Node:
    """Tree of a page; mistakes are mended the way browsers do, as far as text needs it."""
    root = here = _Node("html", None)
    at, end = 0, len(html)
    while at < end:
        found = _TAG.search(html, at)
        if found is None:
            here.kids.append(html[at:])
            break
        if found.start() > at:
            here.kids.append(html[at:found.start()])
        at = found.end()
        tag = (found["tag"] or found["tag2"] or "").lower()
        if not tag:
            continue
        if found["end"] or found["end2"]:
            node = here
            while node is not root and node.tag != tag:
                if node.tag in ("table", "body") and tag not in ("html", "body", "table", "article", "main", "section", "div"):
                    node = root
                    break
                node = node.parent
            if node is not root:
                here = node.parent
            continue
        if tag in ("html", "body") and (tag == "html" or any(n.tag == "body" for n in (here, *here.up()))):
            continue
        if tag not in _INLINE and tag != "html":  # a block ends an open paragraph, and the headings of a page its head
            for node in (here, *here.up()):
                if node.tag == "p" or (node.tag == "head" and tag not in _RAW | _VOID):
                    here = node.parent
                    break
                if node.tag in ("td", "th", "li", "div", "article", "section", "body", "table"):
                    break
        closes = _CLOSES.get(tag)
        if closes:
            last, node = None, here
            while node is not root and node.tag not in _SCOPES[tag]:
                if node.tag in closes:
                    last = node
                node = node.parent
            if last is not None:
                here = last.parent
        node = _Node(tag, here, found["attrs"] or found["attrs2"] or "")
        here.kids.append(node)
        if tag in _RAW:
            close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(html, at)
            at = close.end() if close else end
        elif tag not in _VOID and not (found["attrs"] or "").rstrip().endswith("/"):
            here = node
        elif tag not in _VOID and tag in _INLINE | _PARAGRAPHS | {"div", "section", "article"}:
            here = node  # a slash does not close these
    return root


def _walk(root: _Node):
    """All nodes in page order."""
    stack = [root]
    while stack:
        node = stack.pop()
        yield node
        stack.extend(k for k in reversed(node.kids) if isinstance(k, _Node))


def _points(text: str) -> float:
    """What a paragraph passes on: for itself, its commas and its length."""
    return 1 + text.count(",") + min(len(text) / 100, 3.0)


def _sums(root: _Node) -> dict[int, float]:
    """Points of all paragraphs inside each element, less their links."""
    sums: dict[int, float] = {}
    for owner, text, linked in _blocks(root):
        if len(text) >= 25 or owner.tag == "p":
            points = _points(text) * (1 - linked / len(text))
            for node in (owner, *owner.up()):
                sums[id(node)] = sums.get(id(node), 0.0) + points
    return sums


def _comments(node: _Node) -> bool:
    """True for an element with readers' comments."""
    if any(map(_COMMENTS.fullmatch, node.names)):
        return True
    if not any(map(_MAYBE_COMMENTS.fullmatch, node.names)):
        return False
    inside = [n for n in _walk(node) if n is not node]
    return any(n.tag in ("form", "textarea") or any(map(_COMMENTS.fullmatch, n.names)) for n in inside) or (
        sum(any(map(_MAYBE_COMMENTS.fullmatch, n.names)) for n in inside) > 1)


def _leave_out(root: _Node) -> None:
    """Mark what is no part of the article: surely, or by name where its share of the points is small."""
    doubtful: list[_Node] = []
    homes: list[_Node] = []
    stack = [(root, False)]  # (element, beside the article by tag or comments)
    while stack:
        node, beside = stack.pop()
        if node.tag not in ("html", "body"):
            if node.hidden or node.tag in _NO_TEXT:
                node.out = True
                continue
            talk = bool(node.names) and _comments(node)
            home = node.tag in ("article", "main") or node.role == "main"
            if home and not talk and not beside:
                homes.append(node)
            elif talk or node.tag in _LEFT_OUT or node.tag == "header" or node.role in _ROLES or (not home and any(
                    _NAMES.fullmatch(n) or _MAYBE_COMMENTS.fullmatch(n) or _HEADER.fullmatch(n) for n in node.names)):
                doubtful.append(node)
            beside = beside or talk or node.tag in ("nav", "footer", "aside")
        stack.extend((k, beside) for k in reversed(node.kids) if isinstance(k, _Node))
    if not doubtful:
        return
    sums = _sums(root)
    # The marked article with most points; a main only where it holds far more than any article.
    most = max((sums.get(id(n), 0.0) for n in homes), default=0.0)
    home = max((n for n in homes if sums.get(id(n), 0.0) >= _SHARE * most),
               key=lambda n: (n.tag == "article", sums.get(id(n), 0.0)), default=None)
    above = {id(n) for n in home.up()} if home is not None else set()
    for node in doubtful:
        inside = home is not None and any(n is home for n in node.up())
        if id(node) in above:
            continue
        own, base = sums.get(id(node), 0.0), sums.get(id(home if inside else root), 0.0)
        if _comments(node):
            node.out = True
        elif (home is None or inside) and own > _SHARE * base and own >= _POINTS:
            continue
        elif inside and not (node.tag in _LEFT_OUT or node.tag == "header" or node.role in _ROLES or any(
                _NAMES.fullmatch(n) or _HEADER.fullmatch(n) for n in node.names)):
            continue  # a discussion that is a section of the article
        elif node.tag == "header" or (any(map(_HEADER.fullmatch, node.names)) and not any(map(_NAMES.fullmatch, node.names))):
            if not any(up.tag in ("article", "main") for up in node.up()):
                node.out = True
            else:  # of an article's own header the title stays
                for kid in node.kids:
                    if isinstance(kid, _Node) and kid.tag not in _HEADINGS and not any(n.tag in _HEADINGS for n in _walk(kid)):
                        kid.out = True
        else:
            node.out = True


def _blocks(root: _Node) -> list[tuple[_Node, str, int]]:
    """(block element, text, characters inside links) of every run of text, in page order."""
    out: list[tuple[_Node, str, int]] = []
    parts: list[str] = []
    linked = 0

    def close(owner: _Node) -> None:
        nonlocal linked
        text = " ".join(unescape("".join(parts)).split())
        if text:
            out.append((owner, text, min(linked, len(text))))
        parts.clear()
        linked = 0

    # (element, position among its kids, its block element, inside a link)
    stack = [(root, 0, root, False)]
    while stack:
        node, at, owner, link = stack.pop()
        if at == len(node.kids):
            if node.tag not in _INLINE:
                close(node)
            continue
        kid = node.kids[at]
        stack.append((node, at + 1, owner, link))
        if isinstance(kid, str):
            parts.append(kid)
            if link:
                linked += len(" ".join(kid.split()))
        elif kid.out:
            if kid.tag not in _INLINE:
                close(owner)
        elif kid.tag in _INLINE:
            if kid.tag == "br":
                parts.append(" ")
            stack.append((kid, 0, owner, link or kid.tag == "a"))
        else:
            close(owner)
            stack.append((kid, 0, kid, link))
    return out


def extract(html: str | None) -> str:
    """Main text of a page: its blocks joined by line breaks; empty for NULL and for pages without text."""
    if not html:
        return ""
    root = parse(html)
    _leave_out(root)
    blocks = _blocks(root)
    if not blocks:
        return ""
    scored = []
    for owner, text, linked in blocks:
        for node in (owner, *owner.up()):
            node.chars += len(text)
            node.linked += linked
        if len(text) >= 25 or owner.tag == "p":
            points = _points(text)
            chain = owner.up() if owner.tag in _PARAGRAPHS else (owner, *owner.up())
            for far, node in enumerate(chain):
                if far > 5:
                    break
                node.points += points if far == 0 else points / 2 if far == 1 else points / (3 * far)
                scored.append(node)

    def value(node: _Node) -> float:
        return node.points * (1 - node.linked / max(node.chars, 1))

    best = max(scored, key=value, default=None)  # of equals the first
    if best is None:
        homes = [n for n in _walk(root) if n.tag in ("article", "main") and not n.out and n.chars]
        best = max(homes, key=lambda n: n.chars, default=root)
    # A marked article is taken as a whole, however its paragraphs are divided.
    for tag in ("article", "main"):
        inside = [n for n in (best, *best.up()) if n.tag == tag or (tag == "main" and n.role == "main")]
        if inside:
            best = inside[-1]
            break
    kept = {id(best)}
    marked = best.tag in ("article", "main") or best.role == "main"
    if best.parent is not None and not marked:
        bar = max(10.0, 0.2 * value(best))
        for kid in best.parent.kids:
            if not isinstance(kid, _Node) or not kid.chars:
                continue
            density = kid.linked / kid.chars
            if value(kid) >= bar or kid.tag in _HEADINGS or (kid.tag in _PARAGRAPHS and density < 0.25) or (kid.chars >= 80 and density < 0.1):
                kept.add(id(kid))
    menus = {id(n) for n in _walk(best) if n.tag in ("ul", "ol", "div", "table") and n.chars and n.linked > 0.9 * n.chars
             and sum(k.tag == "a" for k in _walk(n)) >= 3}
    known: dict[int, bool] = {}

    def stays(node: _Node) -> bool:
        path = []
        result = False
        for n in (node, *node.up()):
            if id(n) in known:
                result = known[id(n)]
                break
            path.append(n)
        for n in reversed(path):
            result = (result or id(n) in kept) and id(n) not in menus
            known[id(n)] = result
        return result

    return "\n".join(text for owner, text, _ in blocks if stays(owner))


def main_text(html: Column) -> Column:
    """Main text of a string column of whole pages."""
    @F.pandas_udf("string")
    def run(pages: pd.Series) -> pd.Series:
        return pages.map(extract)
    return run(html)


def extract_pages(pages: DataFrame, html: str = "html", name: str = "text") -> DataFrame:
    """Append the main text of every page. NULL, empty and textless pages get the empty text; a column of that name is replaced.

    Each page is worked on by itself, so repeated rows and NULLs elsewhere change nothing.
    """
    return in_pieces(pages, 128).withColumn(name, main_text(F.col(html)))
