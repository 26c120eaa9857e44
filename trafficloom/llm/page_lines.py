"""HTML to lines: the text of each block of a page, and what its containers say about it.

A small tokenizer, not a browser: tags, comments and raw text elements are told apart, containers
are kept on a stack, an end tag closes what is open above its start tag, one without a start tag is
passed over. Inline elements neither end a line nor add a blank; <br> counts as white space.
"""

from __future__ import annotations

import re
from html import unescape

#: What the containers say: boilerplate, nothing, in the page's declared article.
AWAY, OPEN, ARTICLE = 0, 1, 2

_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)"
    r"|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++))|\bhidden\b")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")

#: Elements whose content is no markup.
RAW = {"script", "style", "textarea", "title", "xmp", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div",
    "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "frameset", "h1", "h2", "h3", "h4", "h5", "h6",
    "head", "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "optgroup", "option", "p",
    "pre", "section", "search", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
#: Elements whose content is never part of an article.
APART = {
    "head", "nav", "footer", "aside", "form", "search", "noscript", "template", "iframe", "object", "svg", "canvas",
    "audio", "video", "button", "select", "dialog", "menu", "datalist", "map",
} | RAW
ROLES = {
    "navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "alertdialog", "dialog", "menu",
    "menubar", "toolbar", "status", "tablist",
}
#: Words of class, id and label names of what is not the article ...
APART_WORDS = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "promotion",
    "banner", "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "sidebar", "footer", "masthead",
    "header", "cookie", "cookies", "consent", "gdpr", "notice", "notices", "alert", "popup", "modal", "overlay",
    "newsletter", "subscribe", "signup", "login", "comment", "comments", "disqus", "respond", "reply", "replies",
    "share", "sharing", "social", "related", "recommended", "recommendations", "widget", "widgets", "toolbar",
    "pagination", "pager", "skip", "search", "topbar", "announcement",
}
#: ... unless a name only says that the element has such a thing ("with-sidebar"), or is a header
#: of the article's own.
HAVING = {"with", "has", "no", "without"}
OWN = {"article", "entry", "post", "story"}
#: Open elements that the start of another ends: a paragraph ends with any block.
ENDED_BY = {
    "p": BLOCKS, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th", "tr"},
    "th": {"td", "th", "tr"}, "tr": {"tr"}, "option": {"option"},
}
#: Names that say where the article is, if no element does.
ARTICLE_NAMES = {
    "content", "main", "article", "post", "entry", "story", "main-content", "maincontent", "article-body",
    "articlebody", "article-content", "post-body", "post-content", "entry-content", "story-body", "page-content",
    "content-main", "article-text", "post-text", "story-text",
}
#: Kinds of declaration, the strongest first: <main>, <article>, what names its article body, names.
_KINDS, _NAMED = 4, 3


def _attributes(text: str) -> dict[str, str]:
    found = {}
    for m in _ATTRIBUTE.finditer(text):
        if m[1]:
            found.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
        else:
            found.setdefault("hidden", "")
    return found


def _apart(tag: str, at: dict[str, str], declared: bool) -> bool:
    """Whether the element is boilerplate; declared: it stands in an article."""
    if tag in APART or (tag == "header" and not declared):
        return True
    if not at or tag in ("html", "body", "main", "article"):
        return False
    if "hidden" in at or at.get("aria-hidden") == "true" or at.get("role", "").lower() in ROLES:
        return True
    if re.search(r"display\s*:\s*none", at.get("style", "")):
        return True
    for name in " ".join((at.get("class", ""), at.get("id", ""))).split():
        words = {w.lower() for w in _WORD.findall(name)}
        if "header" in words and (declared or words & OWN):
            words.remove("header")
        if words & APART_WORDS and not words & HAVING:
            return True
    return False


def _declares(tag: str, at: dict[str, str]) -> int:
    """The kind of declaration of an article, or -1."""
    role = at.get("role", "").lower()
    if tag == "main" or role == "main":
        return 0
    if tag == "article" or role == "article":
        return 1
    if at.get("itemprop", "").lower() == "articlebody":
        return 2
    names = {n.lower().replace("_", "-") for n in (at.get("class", "") + " " + at.get("id", "")).split()}
    return 3 if names & ARTICLE_NAMES else -1


def lines(html: str | None) -> tuple[list[str], list[int]]:
    """The text lines of a page and what their containers say. Where a page declares its article,
    lines outside it are AWAY; those inside are ARTICLE, or OPEN if only a class or id declares it."""
    texts: list[str] = []
    marks: list[int] = []  # AWAY, or OPEN + the kinds of declaration around the line, as bits
    line: list[str] = []
    #: Containers that are open: tag, whether boilerplate, declarations around.
    stack: list[tuple[str, bool, int]] = []
    count: dict[str, int] = {}
    away, declared = False, 0
    html = html or ""

    def end_line() -> None:
        if line:
            text = " ".join("".join(line).split())
            if text:
                texts.append(text)
                marks.append(AWAY if away else OPEN + declared)
            line.clear()

    at, size = 0, len(html)
    while at < size:
        found = _TOKEN.search(html, at)
        start = found.start() if found else size
        if start > at:
            line.append(unescape(html[at:start]))
        if not found:
            break
        at = found.end()
        tag = found[2] or found[5]
        if not tag:
            continue
        tag = tag.lower()
        closing = found[1] or found[4]
        block = tag in BLOCKS
        if tag == "br":
            line.append(" ")
        elif closing:
            if block:
                end_line()
            if count.get(tag):
                end_line()
                while True:
                    top, _, _ = stack.pop()
                    count[top] -= 1
                    if top == tag:
                        break
                away, declared = stack[-1][1:] if stack else (False, 0)
        else:
            if block:
                end_line()
            given = (found[3] or found[6] or "").strip(" \t\r\n\f/")
            attributes = _attributes(given) if given else {}
            if tag in RAW:
                end = re.compile(rf"</{tag}(?=[\s/>])|</{tag}\Z", re.I).search(html, at)
                at = end.start() if end else size
                if end:
                    closed = html.find(">", at)
                    at = closed + 1 if closed >= 0 else size
                continue
            if tag in VOID:
                continue
            while stack and tag in ENDED_BY.get(stack[-1][0], ()):
                count[stack.pop()[0]] -= 1
                away, declared = stack[-1][1:] if stack else (False, 0)
            kind = _declares(tag, attributes)
            apart = away or _apart(tag, attributes, bool(declared))
            # Inline elements matter if they, too, say something: <span class="ad">.
            if (block and tag != "p") or apart != away or kind >= 0 or tag in APART:
                if apart != away:
                    end_line()
                away = apart
                if kind >= 0:
                    declared |= 1 << kind
                stack.append((tag, away, declared))
                count[tag] = count.get(tag, 0) + 1
    end_line()
    return texts, _settled(marks)


def _settled(marks: list[int]) -> list[int]:
    """The strongest kind of declaration that holds any line decides for the page. An element is
    believed; a mere name leaves its lines open."""
    kinds = 0
    for m in marks:
        if m:
            kinds |= m - OPEN
    for kind in range(_KINDS):
        if kinds >> kind & 1:
            inside = ARTICLE if kind < _NAMED else OPEN
            return [inside if m and (m - OPEN) >> kind & 1 else AWAY for m in marks]
    return [OPEN if m else AWAY for m in marks]
