"""Block trees of web pages for the wrapper operator: a small tolerant reader, made for whole pages of any length.

A tree holds the block elements of a page; inline elements melt into the text of their block. Reading is linear in the page,
open elements close as HTML asks for (a block ends an open paragraph, a list item the one before), text that stands after a
cut-off tag or comment is lost with it, and elements nested deeper than `DEEPEST` are joined to their ancestor of that depth
without losing text.
"""

from __future__ import annotations

import html
import re

DEEPEST = 120

# --- fixed values ---------------------------------------------------------------
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
RAW = {"iframe", "noembed", "noframes", "script", "style", "textarea", "title", "xmp"}
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt",
    "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup", "hr",
    "html", "legend", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th",
    "thead", "tr", "ul",
}
BESIDE = {  # elements that are never the main text
    "aside", "button", "canvas", "datalist", "dialog", "footer", "form", "head", "header", "iframe", "menu", "nav", "noembed",
    "noframes", "noscript", "object", "option", "script", "select", "style", "svg", "template", "textarea", "title",
}
BESIDE_ROLES = {"alert", "alertdialog", "banner", "complementary", "contentinfo", "dialog", "form", "menu", "menubar", "navigation", "search", "status", "toolbar"}
BESIDE_WORDS = {  # parts of class and id names
    "ad", "ads", "advert", "advertisement", "advertising", "adverts", "banner", "breadcrumb", "breadcrumbs", "comment", "commentlist",
    "comments", "consent", "cookie", "cookies", "disqus", "footer", "gdpr", "header", "login", "masthead", "menu", "modal", "nav", "navbar",
    "navigation", "newsletter", "notice", "pager", "pagination", "popup", "promo", "related", "replies", "respond", "search", "share",
    "sharing", "sidebar", "signup", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget",
}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
CLOSES = {  # a start tag ends these, if open inside the nearest of the second set
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"table"}), "th": ({"td", "th"}, {"table"}),
}
# --- end of fixed values ----------------------------------------------------------

_NAME = re.compile(r"[A-Za-z][^\s/>]*")
_SIGN = re.compile(r"[>\"']")
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|([^\s=\"'/>]+)")
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])", re.IGNORECASE) for t in RAW}
_WORDS = re.compile(r"[a-z]+")


class Node:
    """A block: its tag, the label it is aligned by, whether it stands beside the main text, and texts and blocks in order."""

    __slots__ = ("tag", "label", "beside", "kids", "linked", "hidden")

    def __init__(self, tag: str, label: str, beside: bool) -> None:
        self.tag, self.label, self.beside = tag, label, beside
        self.kids: list[str | Node] = []
        self.linked = 0  # characters of own text inside links
        self.hidden = 0


def attributes(text: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(text):
        out.setdefault((m[1] or m[5]).lower(), html.unescape(next((g for g in m.groups()[1:4] if g is not None), "")))
    return out


def stands_beside(tag: str, given: dict[str, str]) -> bool:
    """Whether tag, role, class or id name a part beside the main text ("has-sidebar" and the like do not)."""
    if tag in BESIDE:
        return True
    if tag in ("html", "body", "article", "main"):
        names = given.get("class", "").lower().split() if tag == "article" else []
    else:
        names = f"{given.get('class', '')} {given.get('id', '')}".lower().split()
    if given.get("role", "").lower() in BESIDE_ROLES or "hidden" in given or given.get("aria-hidden") == "true":
        return True
    if "display:none" in given.get("style", "").replace(" ", "").lower():
        return True
    for name in names:
        parts = _WORDS.findall(name)
        if parts and parts[0] not in ("has", "no", "with") and not BESIDE_WORDS.isdisjoint(parts):
            return True
    return False


def label_of(tag: str, given: dict[str, str]) -> str:
    """Tag and the class names without digits: names with digits mostly number the page."""
    return ".".join([tag, *sorted({c for c in given.get("class", "").lower().split() if c.isalpha()})])


def tag_end(page: str, at: int, last: dict[str, int]) -> int:
    """Place of the `>` that ends a tag; -1 if none. Quoted values may hold one; a quote without partner is skipped."""
    while True:
        m = _SIGN.search(page, at)
        if m is None or m[0] == ">":
            return -1 if m is None else m.start()
        at = m.end()
        if page[max(0, m.start() - 8) : m.start()].rstrip().endswith("=") and at <= last[m[0]]:
            at = page.find(m[0], at) + 1


def read(page: str) -> Node:
    """The block tree of a page, under a root of its own."""
    root = Node("#", "#", False)
    stack = [("#", root)]  # open elements with the block that takes their text; inline ones share their parent's
    marked: list[bool] = [False]  # inline elements beside the main text, per open element
    links = 0
    last = {'"': page.rfind('"'), "'": page.rfind("'")}
    lower_end = len(page)

    def say(text: str) -> None:
        if not text or marked[-1]:
            return
        if "&" in text:
            text = html.unescape(text)
        node = stack[-1][1]
        if links:
            node.linked += len(text)
        if node.kids and isinstance(node.kids[-1], str):
            node.kids[-1] += text
        else:
            node.kids.append(text)

    def pop_to(n: int) -> None:
        nonlocal links
        while len(stack) > n:
            tag, _ = stack.pop()
            marked.pop()
            links -= tag == "a"

    at = 0
    while at < lower_end:
        sign = page.find("<", at)
        if sign < 0:
            say(page[at:])
            break
        say(page[at:sign])
        nxt = page[sign + 1 : sign + 2]
        if page.startswith("<!--", sign):
            end = page.find("-->", sign + 4)
            at = end + 3 if end >= 0 else lower_end
            continue
        closing = nxt == "/"
        m = _NAME.match(page, sign + 1 + closing)
        if m is None:
            if nxt in ("!", "?", "/"):
                end = page.find(">", sign)
                at = end + 1 if end >= 0 else lower_end
            else:
                say("<")
                at = sign + 1
            continue
        end = tag_end(page, m.end(), last)
        if end < 0:
            break
        tag, at = m[0].lower(), end + 1
        if closing:
            if tag in ("html", "body"):
                continue
            for n in range(len(stack) - 1, 0, -1):
                if stack[n][0] == tag:
                    pop_to(n)
                    break
                if tag not in BLOCK and stack[n][0] in BLOCK:
                    break
            continue
        given = attributes(page[m.end() : end]) if end > m.end() else {}
        if tag in RAW:
            stop = _RAW_END[tag].search(page, at)
            if stop is None:
                break
            end = page.find(">", stop.end())
            at = end + 1 if end >= 0 else lower_end
            continue
        if tag in BLOCK:
            for n in range(len(stack) - 1, 0, -1):
                if stack[n][0] == "p":
                    pop_to(n)
                    break
                if stack[n][0] in BLOCK:
                    break
            if tag in CLOSES:
                ended, inside = CLOSES[tag]
                for n in range(len(stack) - 1, 0, -1):
                    if stack[n][0] in inside:
                        break
                    if stack[n][0] in ended:
                        pop_to(n)
                        if tag != "tr" or stack[-1][0] not in ended:
                            break
        if tag == "br" or tag == "hr":
            if not marked[-1]:
                stack[-1][1].kids.append(Node("br", "br", False))
            continue
        if tag in VOID:
            continue
        beside = stands_beside(tag, given)
        if len(stack) > DEEPEST:  # joined to the open element; a boundary keeps the words apart
            if tag in BLOCK and not marked[-1]:
                stack[-1][1].kids.append(Node("br", "br", False))
            continue
        if tag in BLOCK:
            node = Node(tag, label_of(tag, given), beside)
            if given.get("role", "").lower() == "main" or given.get("itemprop", "").lower() == "articlebody":
                node.hidden = 1  # stands for a main element
            if not marked[-1]:
                stack[-1][1].kids.append(node)
            stack.append((tag, node))
            marked.append(marked[-1])
        else:
            stack.append((tag, stack[-1][1]))
            marked.append(marked[-1] or beside)
            links += tag == "a"
    return root
