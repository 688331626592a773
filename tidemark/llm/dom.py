"""A small forgiving DOM: what the extraction of articles needs to know of a page."""

from __future__ import annotations

import re

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<raw>script|style|noscript|template|svg|iframe|textarea|title)\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|(?P<text>[^<]+|<)",
    re.S | re.I,
)
_ATTR = re.compile(r"([a-zA-Z_:][\w:.-]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_SPLIT = re.compile(r"[^a-z0-9]+")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset("address article aside blockquote body caption center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
#: An opening tag on the left ends an open element on the right.
_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: An implied end does not reach beyond these.
_SCOPE = frozenset("table ul ol dl body html article section div td th menu nav aside main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that are no part of an article.
_OUT_TAGS = frozenset("head nav footer aside form button select dialog menu object canvas audio video".split())
#: Words in class or id that mark such parts.
_OUT_NAMES = frozenset(
    "ad ads advert adverts advertisement advertisements adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription signup "
    "share sharing social sidebar widget widgets related recommended comment comments reply replies disqus respond footer nav navbar navigation menu breadcrumb breadcrumbs pagination pager toolbar login search copyright disclaimer skip".split()
)
_OUT_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert form menu menubar toolbar".split())
_NEVER_BY_NAME = frozenset("html body main article".split())
#: Elements nested deeper than this count as their ancestor at this depth, as in browsers.
DEEPEST = 512


class Node:
    __slots__ = ("tag", "key", "kids", "out")

    def __init__(self, tag: str, key: str, out: bool) -> None:
        self.tag, self.key, self.out = tag, key, out
        self.kids: list[Node | str] = []


def _node(tag: str, raw: str) -> Node:
    if not raw or raw.isspace():
        return Node(tag, tag, tag in _OUT_TAGS)
    attrs = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTR.finditer(raw)}
    names = f"{attrs.get('class', '')} {attrs.get('id', '')}".lower()
    words = _SPLIT.split(names)
    out = tag in _OUT_TAGS or attrs.get("role", "").lower() in _OUT_ROLES or "hidden" in attrs or attrs.get("aria-hidden", "") == "true" or "display:none" in attrs.get("style", "").replace(" ", "")
    if tag not in _NEVER_BY_NAME or "comment" in words or "comments" in words:
        out = out or not _OUT_NAMES.isdisjoint(words)
    if attrs.get("role", "").lower() == "main":
        tag = "main"
    return Node("header" if "header" in words and tag in ("div", "section") else tag, f"{tag}.{' '.join(w for w in words if w.isalpha())}", out)


def parse(html: str) -> Node:
    """The tree of a page. Unclosed, stray and cut-off tags are taken as browsers would, more or less; scripts, styles and titles are left out."""
    root = Node("#root", "#root", False)
    stack = [root]
    for m in _TOKEN.finditer(html):
        kind = m.lastgroup
        if kind == "text":
            stack[-1].kids.append(m["text"])
        elif kind == "attrs" or m["tag"]:
            tag = m["tag"].lower()
            if m["end"]:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].key.partition(".")[0] == tag:
                        del stack[i:]
                        break
                    if tag not in _SCOPE and stack[i].key.partition(".")[0] in _SCOPE:
                        break
                continue
            ended = {"p"} if tag in BLOCKS and tag not in ("html", "body") else set()
            ended |= _ENDS.get(tag, set())
            for i in range(len(stack) - 1, 0, -1):
                name = stack[i].key.partition(".")[0]
                if name in ended:
                    del stack[i:]
                    break
                if name in _SCOPE:
                    break
            node = _node(tag, m["attrs"])
            stack[-1].kids.append(node)
            if tag not in _VOID and not m["attrs"].endswith("/") and len(stack) < DEEPEST:
                stack.append(node)
    return root
