"""Elements of a page with their texts, from a stack of open elements and one text buffer.

A start tag can end elements that need no end tag of their own (a paragraph ends where a list begins). What a tag may end
is known from the places of open elements by name, so every tag costs the elements that it closes and no search: time and
memory are in proportion to the page. An element holds two offsets into the page's text; texts are cut out when asked for.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from html.parser import HTMLParser

# The element kinds of the HTML standard's syntax.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Start tags that end an open paragraph.
ENDS_PARAGRAPH = frozenset("address article aside blockquote details dialog div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul".split())
#: Elements that no end tag or start tag inside them reaches beyond.
SCOPES = frozenset("html body table td th caption button template object".split())
#: Of a start tag: the open elements that it ends, and what bounds the search.
SIBLINGS = {
    "li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "option": (("option",), ("select", "datalist")), "optgroup": (("option", "optgroup"), ("select",)),
    "tr": (("tr",), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
    "tbody": (("thead", "tbody", "tfoot", "caption", "colgroup"), ("table",)), "thead": (("caption", "colgroup"), ("table",)), "tfoot": (("thead", "tbody", "caption", "colgroup"), ("table",)),
    "rp": (("rt", "rp"), ("ruby",)), "rt": (("rt", "rp"), ("ruby",)),
}
#: Elements that need no end tag.
OPTIONAL = frozenset(("p", *SIBLINGS))
#: Elements whose content isn't text of the page.
SILENT = frozenset(("script", "style", "template", "noscript"))
#: Elements at whose edges a word ends.
BREAKS = ENDS_PARAGRAPH | frozenset("li dt dd td th tr option body title caption br".split())


@dataclass
class Element:
    """One element; ``end`` is the end of the text for those that the page leaves open."""

    tag: str
    attributes: dict[str, str | None]
    start: int
    end: int = -1
    closed: bool = False


@dataclass
class _Open:
    """Places of open elements, by name."""

    stack: list[Element] = field(default_factory=list)
    places: dict[str, list[int]] = field(default_factory=dict)
    scopes: list[int] = field(default_factory=list)
    silent: int = 0

    def last(self, *names: str) -> int:
        return max((self.places[n][-1] for n in names if self.places.get(n)), default=-1)

    def push(self, element: Element) -> None:
        self.places.setdefault(element.tag, []).append(len(self.stack))
        if element.tag in SCOPES:
            self.scopes.append(len(self.stack))
        self.silent += element.tag in SILENT
        self.stack.append(element)

    def cut(self, place: int, at: int) -> None:
        """End the elements from ``place`` on."""
        while len(self.stack) > place:
            element = self.stack.pop()
            element.end = at
            self.places[element.tag].pop()
            if element.tag in SCOPES:
                self.scopes.pop()
            self.silent -= element.tag in SILENT


class PageTree(HTMLParser):
    """``elements`` of a page in their order; ``text(element)`` with single spaces."""

    def __init__(self, markup: str | None):
        super().__init__(convert_charrefs=True)
        self.elements: list[Element] = []
        self._pieces: list[str] = []
        self._size = 0
        self._open = _Open()
        self.feed(markup or "")
        self.close()
        self._open.cut(0, self._size)
        self._text = "".join(self._pieces)

    def text(self, element: Element | None = None) -> str:
        """An element's text, or the page's."""
        found = self._text if element is None else self._text[element.start : element.end]
        return " ".join(found.split())

    def texts(self, *tags: str) -> list[str]:
        """Texts of the elements of these tags, without empty ones. Of elements that the page fails to close, those inside an open one of their kind add nothing."""
        out, reach = [], {}
        for e in self.elements:
            if e.tag in tags:
                if not e.closed and e.tag not in OPTIONAL:
                    if e.end <= reach.get(e.tag, -1):
                        continue
                    reach[e.tag] = e.end
                out.append(self.text(e))
        return [x for x in out if x]

    def _add(self, data: str) -> None:
        self._pieces.append(data)
        self._size += len(data)

    def handle_starttag(self, tag, attrs):
        held = self._open
        if tag in ENDS_PARAGRAPH and (p := held.last("p")) > (held.scopes[-1] if held.scopes else -1):
            held.cut(p, self._size)
        if tag in SIBLINGS:
            ended, bounds = SIBLINGS[tag]
            if (place := held.last(*ended)) > held.last(*bounds):
                held.cut(place, self._size)
        if tag in BREAKS:
            self._add(" ")
        element = Element(tag, dict(attrs), self._size)
        self.elements.append(element)
        if tag in VOID:
            element.end, element.closed = self._size, True
        else:
            held.push(element)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and ":" in tag:  # only in foreign markup does the slash close an element
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        held = self._open
        place, scope = held.last(tag), held.scopes[-1] if held.scopes else -1
        if place < 0 or (place < scope and tag not in ("table", "html", "body", "tr", "thead", "tbody", "tfoot")):
            return  # closes nothing here
        held.stack[place].closed = True
        held.cut(place, self._size)
        if tag in BREAKS:
            self._add(" ")

    def handle_data(self, data):
        if not self._open.silent:
            self._add(data)
