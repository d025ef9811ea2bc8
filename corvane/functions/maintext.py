"""The main text of a web page, by the density of text and links in its blocks.

A page is parsed into blocks (paragraphs, headings, items) that know the elements around them.  A
block of prose, one of some length whose text is mostly outside links, gives its weight to the element it
stands in, half of it to the next one out and so on; the element with the most weight holds the main
text, as a list of paragraphs outweighs each of them and a page outweighs its article only if there is more
of it elsewhere.  Of that element, blocks that are mostly links, and parts labelled as something else, are
left out.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

#: Elements that are no text, that stand alone, and that start a block.
OUT = frozenset(("script", "style", "noscript", "template", "nav", "footer", "aside", "form", "table", "header", "figure", "button", "select", "svg", "iframe"))
VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"))
BLOCK = frozenset(("p", "div", "article", "section", "main", "body", "li", "ul", "ol", "dl", "dd", "dt", "br", "hr", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "td", "tr"))
#: Elements whose end is implied by the start of another of these.
CLOSED_BY = {"p": BLOCK - {"br"}, "li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}}
#: Labels (class or id) of parts that are no main text: these always, and the second ones unless they hold it.
BOILERPLATE = ("related", "recommended", "recommendations", "most-popular", "read-more", "latest-news", "newsletter", "social-share")
UNLIKELY = ("ad", "ads", "advert", "advertisement", "banner", "breadcrumb", "breadcrumbs", "caption", "comment", "comments", "cookie", "consent", "footer", "header", "menu", "meta", "modal", "nav", "popup", "promo", "share", "sharing", "sidebar", "signup", "social", "sponsor", "subscribe", "tags", "teaser", "toolbar", "widget")
LIKELY = ("article", "main")
#: Characters and share of links of a block of prose, and how weight passes on outwards.
PROSE, LINKED, OUTWARD, LEVELS = 40, 0.4, 0.5, 4
_word = lambda names: re.compile(r"(?i)(?:^|[\s_-])(?:" + "|".join(names) + r")(?:$|[\s_-])")
_BARRED, _UNLIKELY = _word(BOILERPLATE), _word(UNLIKELY)
_DATES = frozenset(("article:published_time", "og:article:published_time", "datepublished", "date", "dc.date", "dc.date.issued", "pubdate", "publishdate", "sailthru.date"))


class _Element:
    def __init__(self, tag: str, outer: _Element | None, label: str):
        self.tag, self.outer, self.weight = tag, outer, 0.0
        self.barred = bool(outer and outer.barred) or tag in OUT or bool(_BARRED.search(label))
        self.unlikely = bool(_UNLIKELY.search(label)) and tag not in ("body", "html", *LIKELY)


class _Block:
    def __init__(self, element: _Element):
        self.element, self.parts, self.linked = element, [], 0

    def done(self) -> _Block:
        self.text = " ".join("".join(self.parts).split())
        self.links = self.linked / max(1, len(self.text))
        return self


class _Page(HTMLParser):
    def __init__(self):
        super().__init__()
        self.open = [_Element("html", None, "")]
        self.blocks = [_Block(self.open[0])]
        self.title, self.heading, self.named, self.date, self.links = "", "", "", None, 0

    def _break(self) -> None:
        self.blocks.append(_Block(self.open[-1]))

    def handle_starttag(self, tag, attrs):
        got = {k: v or "" for k, v in attrs}
        if tag == "meta":
            name = got.get("property") or got.get("name") or got.get("itemprop") or ""
            if name.lower() in _DATES:
                self.date = self.date or got.get("content")
            elif name.lower() == "og:title":
                self.named = self.named or got.get("content", "")
        elif tag == "time" and got.get("datetime") and not self.open[-1].barred:
            self.date = self.date or got["datetime"]
        while self.open[-1].tag in CLOSED_BY and tag in CLOSED_BY[self.open[-1].tag]:
            self.open.pop()
        if tag not in VOID:
            self.open.append(_Element(tag, self.open[-1], f" {got.get('class', '')} {got.get('id', '')} "))
            self.links += tag == "a"
        if tag in BLOCK:
            self._break()

    def handle_endtag(self, tag):
        if any(x.tag == tag for x in self.open[1:]):
            while True:
                last = self.open.pop()
                self.links -= last.tag == "a"
                if last.tag == tag:
                    break
        if tag in BLOCK:
            self._break()

    def handle_data(self, data):
        tag = self.open[-1].tag
        if tag == "title":
            self.title += data
        elif not self.open[-1].barred:
            self.blocks[-1].parts.append(data)
            if self.links:
                self.blocks[-1].linked += len(data)
            if tag == "h1":
                self.heading += data


def _inside(element: _Element | None, outer: _Element) -> bool:
    while element is not None and element is not outer:
        if element.unlikely:
            return False
        element = element.outer
    return element is outer


def extract(html: str) -> dict | None:
    """title, date and text of a page, or None if it has no text."""
    page = _Page()
    page.feed(html)
    page.close()
    blocks = [b for b in map(_Block.done, page.blocks) if b.text]
    best = None
    for b in blocks:
        if len(b.text) < PROSE or b.links > LINKED:
            continue
        weight, element = len(b.text) * (1 - b.links), b.element
        if element.tag in ("p", "li", "pre", "blockquote", "dd"):
            element = element.outer
        for _ in range(LEVELS):
            if element is None:
                break
            element.weight += weight * (0.2 if element.unlikely else 1.5 if element.tag in LIKELY else 1)
            if best is None or element.weight > best.weight:
                best = element
            weight, element = weight * OUTWARD, element.outer
    if best is not None:
        kept = [b for b in blocks if _inside(b.element, best) and (b.links <= LINKED or len(b.text) >= 4 * PROSE and b.links <= 2 * LINKED)]
    else:  # no prose: whatever text there is
        kept = [b for b in blocks if b.links <= LINKED and not b.element.unlikely]
    text = "\n".join(b.text for b in kept)
    title = " ".join((page.title or page.named or page.heading).split())
    return {"title": title, "date": page.date, "text": text} if text else None
