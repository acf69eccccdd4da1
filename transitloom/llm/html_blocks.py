"""Blocks of text of an HTML page, and where on the page they stand."""

from __future__ import annotations

import html
import re
from typing import NamedTuple

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']+|\"[^\"]*\"|'[^']*'|[\"'])*+)>",
    re.DOTALL,
)
_ATTR = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_NAME_PART = re.compile(r"[a-z0-9]+")

# Elements of HTML by what they are to a reader.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style noscript template iframe textarea title svg math object".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby "
    "s samp small span strike strong sub sup time tt u var wbr img".split()
)
_FURNITURE = frozenset("nav footer aside form head dialog menu button select".split())
_CLOSED_BY_NEXT = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
_SCOPE = frozenset("ul ol dl table select article section div main body".split())
_FURNITURE_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alert alertdialog menu menubar".split()
)
# Parts of class names and ids that name what surrounds an article.
_FURNITURE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo sidebar menu "
    "nav navbar navigation breadcrumb breadcrumbs masthead footer cookie cookies consent gdpr notice "
    "popup modal newsletter subscribe share sharing social comment comments disqus related "
    "pagination pager toolbar signup login".split()
)
_ARTICLE_NAMES = frozenset(
    "article article-body article-content content main-content post-content entry-content story".split()
)


class Block(NamedTuple):
    text: str
    furniture: bool
    rank: int  # 3 in an article element, 2 in the main element, 1 in what is named so, else 0
    linked: bool  # all of it is link text


class _Element(NamedTuple):
    name: str
    furniture: int  # 0 none, 1 by its name or a form: an article inside is one again, 2 by kind
    rank: int


def _element(name: str, attrs: str, inside: _Element) -> _Element:
    furniture, rank = inside.furniture, inside.rank
    found = {}
    if attrs.strip(" /"):
        for key, *values in _ATTR.findall(attrs):
            found.setdefault(key.lower(), html.unescape("".join(values)).lower())
    role = found.get("role", "")
    names = f"{found.get('class', '')} {found.get('id', '')}"
    parts = set(_NAME_PART.findall(names))
    named = bool(parts & _FURNITURE_NAMES) and name not in ("html", "body", "main")
    if name == "article" or found.get("itemprop") == "articlebody":
        own = 3
    elif name == "main" or role == "main":
        own = 2
    else:
        own = 1 if _ARTICLE_NAMES & set(names.split()) else 0
    if own >= 2 and furniture == 1 and not named:
        furniture = 0
    if name == "header" and rank < 3:
        furniture = 2
    elif name == "form" or named:
        furniture = max(furniture, 1)
    elif name in _FURNITURE or role in _FURNITURE_ROLES or "hidden" in found:
        furniture = 2
    return _Element(name, furniture, max(rank, own))


def blocks(page: str) -> list[Block]:
    """The blocks of text of a page in order, white space inside them single spaces.

    A block ends where any element that is not inline begins or ends. Elements left open end
    with the element around them. Scripts, styles and the like, comments and declarations are
    no text. Character references are decoded after the markup is read.
    """
    stack = [_Element("", 0, 0)]
    found: list[Block] = []
    pieces: list[tuple[str, bool, bool]] = []  # text, whether in a link, whether in furniture
    links = 0

    def add(text: str) -> None:
        pieces.append((text, links > 0, stack[-1].furniture > 0))

    def end_block() -> None:
        if pieces:
            around = next(one for one in reversed(stack) if one.name not in _INLINE)
            own = [piece for piece in pieces if around.furniture or not piece[2]]
            text = " ".join(html.unescape("".join(piece[0] for piece in own)).split())
            if text:
                linked = all(piece[1] for piece in own if piece[0].strip())
                found.append(Block(text, around.furniture > 0, around.rank, linked))
            pieces.clear()

    at = 0
    size = len(page)
    while at < size:
        token = _TOKEN.search(page, at)
        if not token:
            add(page[at:])
            break
        if token.start() > at:
            add(page[at : token.start()])
        at = token.end()
        if token["name"] is None:
            if token[0].startswith("<![CDATA["):
                add(html.escape(token[0][9:].removesuffix("]]>")))
            continue
        name = token["name"].lower()
        if name not in _INLINE:
            end_block()
        if name in _RAW:
            if not token["close"] and not token["attrs"].endswith("/"):
                end = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|\Z)", re.IGNORECASE).search(page, at)
                at = end.end() if end else size
        elif token["close"]:
            if name == "a":
                links = max(0, links - 1)
            places = [k for k in range(len(stack) - 1, 0, -1) if stack[k].name == name]
            if places:
                del stack[places[0] :]
        elif name not in _VOID:
            if name not in _INLINE:
                _imply_ends(stack, name)
            if name == "a":
                links = 1
            if name not in _INLINE or token["attrs"]:
                inside = _element(name, token["attrs"], stack[-1])
                if name not in _INLINE or inside.furniture != stack[-1].furniture:
                    stack.append(inside)
    end_block()
    return found


def _imply_ends(stack: list[_Element], name: str) -> None:
    """Close what the start of a block element closes: paragraphs, and its like in a list."""
    closed = _CLOSED_BY_NEXT.get(name, set()) | {"p"}
    for k in range(len(stack) - 1, 0, -1):
        if stack[k].name in closed:
            del stack[k:]
            return
        if stack[k].name in _SCOPE:
            return
