"""Main text of HTML and XML. Plain Python, for Arrow UDFs."""

from __future__ import annotations

import re
from html.parser import HTMLParser

# Elements by how their text counts.
HIDDEN = frozenset("script style noscript template svg head nav aside footer form button select iframe".split())
BLOCKS = frozenset("address article blockquote br dd div dl dt figcaption figure h1 h2 h3 h4 h5 h6 hr li main ol p pre section table tr ul header".split())
CELLS = frozenset(("td", "th"))
IN_HEAD = frozenset("base link meta title style script noscript template".split())
OUTER = frozenset("body html main article".split())  # none of these stands in navigation or a form, so one that opens or closes ends what was left open
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())


class _Text(HTMLParser):
    """Text and the elements that are open. What hides text ends with its own end tag, with that of an element around it,
    and where something opens that can't stand in it: a head ends at anything but its own kinds of elements."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out: list[str] = []
        self.open: list[str] = []
        self.hidden: list[str] = []

    def _opened(self, tag):
        while self.hidden and (self.hidden[-1] == "head" and tag not in IN_HEAD or tag in OUTER and self.hidden[-1] not in ("svg", "template", "noscript")):
            self.hidden.pop()
        if tag not in VOID:
            self.open.append(tag)

    def _closed(self, tag):
        """The hidden elements inside of the element that closes end with it."""
        if tag not in self.open:
            return
        while (inner := self.open.pop()) != tag:
            if self.hidden and self.hidden[-1] == inner:
                self.hidden.pop()

    def handle_starttag(self, tag, attrs):
        self._opened(tag)
        if tag in HIDDEN and tag not in VOID:
            self.hidden.append(tag)
        elif not self.hidden and tag in BLOCKS:
            self.out.append("\n")
        elif not self.hidden and tag in CELLS:
            self.out.append(" | ")

    def handle_endtag(self, tag):
        self._closed(tag)
        if tag in self.hidden:
            while self.hidden.pop() != tag:
                pass
        elif not self.hidden and tag in BLOCKS:
            self.out.append("\n")

    def handle_data(self, data):
        if not self.hidden:
            self.out.append(re.sub(r"\s+", " ", data))


def main_text(html: str | None) -> str | None:
    """The text outside navigation, scripts and comments: a line for each block, cells apart by bars; null if nothing is left."""
    if not html:
        return None
    parser = _Text()
    parser.feed(html)
    parser.close()
    lines = (re.sub(r" {2,}", " ", line).strip(" |") for line in "".join(parser.out).split("\n"))
    return "\n".join(line for line in lines if line) or None


def xml_text(xml: str | bytes | None) -> str | None:
    """All character data in document order, three newlines or more as two, stripped; null if it isn't well-formed."""
    import xml.etree.ElementTree as tree

    if not xml:
        return None
    try:
        root = tree.fromstring(xml)
    except (tree.ParseError, ValueError):
        return None
    return re.sub(r"\n{3,}", "\n\n", "".join(root.itertext())).strip()
