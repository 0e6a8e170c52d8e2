"""Reads the review cards of one page; the only part of the page readers that needs element nesting."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from html.parser import HTMLParser

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that begin on a line of their own.
LINES = frozenset("address article blockquote div dl dt dd h1 h2 h3 h4 h5 h6 li ol p pre section table td th tr ul".split())


class _Field:
    """Visible text of an open element: character references decoded, line breaks at blocks and breaks."""

    def __init__(self, depth: int):
        self.depth, self.parts, self.fresh = depth, [], True

    def data(self, text: str) -> None:
        if self.fresh:
            text = text.lstrip()
        if text:
            self.parts.append(text)
            self.fresh = False

    def line(self, always: bool = False) -> None:
        if always or not self.fresh:
            text = "".join(self.parts).rstrip(" \t\xa0")
            self.parts = [text] if not text or text.endswith("\n") and not always else [text, "\n"]
            self.fresh = True

    def text(self) -> str:
        return "".join(self.parts).strip()


class CardReader(HTMLParser):
    """``cards``: for each card element the text of its first element of each name, and the flag's label.

    A field ends where its element ends, whatever is nested in it; a card likewise, so
    what follows the last card of a page fills no field.
    """

    def __init__(self, card: str, fields: Mapping[str, str], flag: str):
        super().__init__(convert_charrefs=True)
        self.card, self.columns, self.flag = card, {name: column for column, name in fields.items()}, flag
        self.cards: list[dict[str, str]] = []
        self.open: list[str] = []
        self.fields: dict[str, _Field] = {}
        self.inside = -1

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        given = dict(attrs)
        for field in self.fields.values():
            if tag == "br":
                field.line(always=True)
            elif tag in LINES:
                field.line()
        name = given.get("data-testid")
        if name == self.card:
            self._end(0)
            self.cards.append({})
            self.inside = len(self.open)
        elif self.inside >= 0:
            column = self.columns.get(name or "")
            if column and column not in self.cards[-1] and column not in self.fields and tag not in VOID:
                self.fields[column] = _Field(len(self.open))
            if tag == "img" and self.flag in (given.get("src") or ""):
                self.cards[-1].setdefault("country_text", (given.get("alt") or "").strip())
        if tag not in VOID:
            self.open.append(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag not in self.open:
            return
        depth = len(self.open) - 1 - self.open[::-1].index(tag)
        for field in self.fields.values():
            if tag in LINES and depth > field.depth:
                field.line()
        del self.open[depth:]
        self._end(depth)

    def handle_data(self, data: str) -> None:
        for field in self.fields.values():
            field.data(data)

    def _end(self, depth: int) -> None:
        for column in [c for c, f in self.fields.items() if f.depth >= depth]:
            self.cards[-1][column] = self.fields.pop(column).text()
        if self.inside >= depth:
            self.inside = -1

    def close(self) -> None:
        super().close()
        self._end(0)


def read_cards(page: str, card: str, fields: Mapping[str, str], flag: str) -> Iterable[dict[str, str]]:
    reader = CardReader(card, fields, flag)
    reader.feed(page)
    reader.close()
    return reader.cards
