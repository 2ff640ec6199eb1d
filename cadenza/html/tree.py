"""A small HTML tree builder: void elements, implied end tags, unclosed inline tags, entities."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

# Fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "optgroup": {"option", "optgroup"},
    **dict.fromkeys("address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split(), {"p"}),
}
_SCOPE = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "option": {"select"}, "optgroup": {"select"}}
_BARRIER = frozenset({"div", "section", "article", "td", "th", "li", "table", "body", "ul", "ol", "form", "main", "aside", "header", "footer", "nav", "button"})


class Node:
    __slots__ = ("attrs", "children", "name", "parent", "place")

    def __init__(self, name: str, attrs: dict[str, str] | None = None, parent: Node | None = None) -> None:
        self.name, self.attrs, self.parent = name, attrs or {}, parent
        self.children: list[Node | str] = []
        self.place = 0  # in document order

    def elements(self) -> Iterator[Node]:
        """All elements below, in document order."""
        stack = [c for c in reversed(self.children) if isinstance(c, Node)]
        while stack:
            n = stack.pop()
            yield n
            stack += [c for c in reversed(n.children) if isinstance(c, Node)]

    def strings(self) -> Iterator[str]:
        stack: list[Node | str] = list(reversed(self.children))
        while stack:
            c = stack.pop()
            if isinstance(c, str):
                yield c
            elif c.name not in ("script", "style"):
                stack += reversed(c.children)

    def text(self) -> str:
        """The trimmed pieces of text, joined by blanks."""
        return " ".join(s for x in self.strings() if (s := x.strip()))

    def classes(self) -> list[str]:
        return self.attrs.get("class", "").split()

    def siblings(self) -> list[Node]:
        return [c for c in self.parent.children if isinstance(c, Node)] if self.parent else [self]

    def drop(self) -> None:
        if self.parent:
            self.parent.children = [c for c in self.parent.children if c is not self]
            self.parent = None


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("[document]")

    def handle_starttag(self, tag: str, attrs: list) -> None:
        closed = _CLOSES.get(tag, ())
        n = self.at
        while n.parent and closed:
            if n.name in closed:
                self.at = n.parent
            elif n.name in _SCOPE.get(tag, _BARRIER):
                break
            n = n.parent
        seen: dict[str, str] = {}
        for k, v in attrs:
            seen.setdefault(k, v or "")
        node = Node(tag, seen, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        n = self.at
        while n.parent and n.name != tag:
            if n.name in _BARRIER and tag not in _BARRIER:
                return  # an end tag of an inline element doesn't reach out of a block
            n = n.parent
        if n.parent:
            self.at = n.parent

    def handle_data(self, data: str) -> None:
        if data:
            self.at.children.append(data)


def parse(html: str | None) -> Node:
    """The document node; never fails on malformed markup. Comments and doctypes are left out."""
    b = _Builder()
    b.feed(html or "")
    b.close()
    for i, n in enumerate(b.root.elements()):
        n.place = i + 1
    return b.root
