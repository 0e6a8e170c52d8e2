"""Main text of web pages by paths that a host's pages agree on.

A page is read into elements and text blocks. Containers are scored by the text of the blocks
in them that is neither link text nor inside menus, adverts, forms and the like. Every page
votes with its scores for generalised paths (tags and classes, digits removed) from the body down to a
container. The votes are summed per host in Spark; the path with most of them is widened to the containers around it
that hold at least half as many, as they do unless what they add is mostly links. Every page is extracted again
from the elements on its host's path, or from its own container if that holds more than twice the text.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_TAG = re.compile(
    r"""<(?:
        !--(?:.*?-->|.*)
      | (?P<close>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*+)(?P<rest>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>
      | (?P<close2>/?)(?P<name2>[a-zA-Z][a-zA-Z0-9:-]*+)(?P<rest2>[^>]*+)>
      | [!?/][^>]*+>
    )""",
    re.S | re.X,
)
_NAMES = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\s*+=\s*+(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_DIGITS = re.compile(r"\d+")
_SPLIT = re.compile(r"[^a-z]+")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is not page text; nothing in the first four is markup.
RAW = frozenset("script style textarea title".split())
DROPPED = frozenset("nav header footer aside form button select noscript template iframe object svg canvas math dialog menu label fieldset audio video map figcaption head".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br img".split()
)
#: Words in a class, id or role that tell boilerplate.
BOILER = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar aside menu nav navbar navigation breadcrumb breadcrumbs "
    "cookie cookies consent notice notices gdpr alert popup modal overlay comment comments reply replies discussion respond disqus share sharing social "
    "related recommended recommendations newsletter subscribe signup login footer header masthead pagination pager toolbar widget copyright legal".split()
)
#: Of the page's text outside links, the share (in hundredths) up to which an element is dropped for a class that is such a word, and for one that has it as a part.
WHOLE_NAME, PART_OF_NAME = 90, 50
#: An element that closes an open one of the same group, up to the given enclosing ones.
SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
CONTAINERS = frozenset("article main section div td body center blockquote".split())


@dataclass
class Element:
    name: str
    parent: int
    path: str
    dropped: bool
    link: bool
    #: Greatest share of the page's text, in hundredths, that the element's names let drop; 0 for harmless names.
    suspect: int = 0


@dataclass
class Page:
    """Elements in page order, and blocks: the element that holds them, their text, and how much of it is links."""

    elements: list[Element] = field(default_factory=list)
    blocks: list[tuple[int, str, int]] = field(default_factory=list)


def _described(name: str, rest: str) -> tuple[str, bool, int]:
    """The element's part of a path, whether it is hidden, and the share of the page's text up to which its names tell boilerplate."""
    classes, hidden, suspect = [], False, 0
    if "=" in rest or "hidden" in rest:
        for key, *values in _NAMES.findall(rest):
            value, key = "".join(values).lower(), key.lower()
            if key == "class":
                classes = sorted({_DIGITS.sub("", c) for c in value.split()} - {""})
            if key in ("class", "id", "role"):
                if not BOILER.isdisjoint(_SPLIT.split(value)):
                    suspect = max(suspect, PART_OF_NAME if BOILER.isdisjoint(_DIGITS.sub("", value).split()) else WHOLE_NAME)
            elif key == "aria-hidden":
                hidden |= value == "true"
            elif key == "style":
                hidden |= "display:none" in value.replace(" ", "")
    return ".".join([name, *classes]), hidden, suspect


def _drop_suspects(page: Page) -> None:
    """Drop the elements whose names tell boilerplate, unless they hold most of the page's text, as a wrapper does."""
    held = [0] * len(page.elements)
    for holder, text, linked in page.blocks:
        if not page.elements[holder].dropped:
            held[holder] += max(0, len(text) - linked)
    for k in range(len(held) - 1, 0, -1):
        held[page.elements[k].parent] += held[k]
    for k, own in enumerate(page.elements[1:], 1):
        own.dropped |= page.elements[own.parent].dropped or (own.suspect > 0 and held[k] * 100 <= held[0] * own.suspect)


def parsed(source: str) -> Page:
    page = Page()
    elements, blocks = page.elements, page.blocks
    elements.append(Element("", -1, "", False, False))
    stack = [0]
    words: list[str] = []
    linked = 0

    def flush(holder: int) -> None:
        nonlocal linked
        if words:
            text = " ".join(html.unescape("".join(words)).split())
            if text:
                blocks.append((holder, text, linked))
            words.clear()
        linked = 0

    def holder() -> int:
        k = len(stack) - 1
        while elements[stack[k]].name in INLINE:
            k -= 1
        return stack[k]

    def cut(keep: int) -> None:
        if any(elements[e].name not in INLINE for e in stack[keep:]):
            flush(holder())
        del stack[keep:]

    at, end = 0, len(source)
    while at < end:
        found = _TAG.search(source, at)
        text = source[at : found.start() if found else end]
        if text:
            words.append(text)
            if elements[stack[-1]].link:
                linked += len(text)
        if not found:
            break
        at = found.end()
        name = (found["name"] or found["name2"] or "").lower()
        if not name:
            continue
        if found["close"] or found["close2"]:
            for k in range(len(stack) - 1, 0, -1):
                if elements[stack[k]].name == name:
                    cut(k)
                    break
            continue
        if name == "br" or name == "wbr":
            words.append(" " if name == "br" else "")
            continue
        if name in VOID:
            if name == "hr":
                flush(holder())
            continue
        if name in RAW:
            close = re.compile(f"</{name}[\\s/>]", re.I).search(source, at)
            ended = source.find(">", close.start()) if close else -1
            at = ended + 1 if ended >= 0 else end
            continue
        if name not in INLINE:
            flush(holder())
            groups, fence = SIBLINGS.get(name, ({"p"}, CONTAINERS))
            keep = None
            for k in range(len(stack) - 1, 0, -1):
                own = elements[stack[k]].name
                if own in groups or own == "p":
                    keep = k
                elif own in fence:
                    break
            if keep is not None:
                cut(keep)
        parent = stack[-1]
        above = elements[parent]
        part, hidden, suspect = _described(name, found["rest"] or found["rest2"] or "")
        if name in ("html", "body"):
            part, hidden, suspect = name, False, 0
        path = above.path if name in INLINE else f"{above.path}>{part}"
        elements.append(Element(name, parent, path, above.dropped or hidden or name in DROPPED, above.link or name == "a", suspect))
        if not (found["rest"] or "").rstrip().endswith("/") or name in CONTAINERS or name == "p":
            stack.append(len(elements) - 1)
    flush(holder())
    _drop_suspects(page)
    return page


def container_scores(page: Page) -> dict[str, int]:
    """Score of every container path: characters of its own blocks that are not links, half of them for the container above."""
    scores: dict[str, int] = {}
    for holder, text, linked in page.blocks:
        if page.elements[holder].dropped:
            continue
        worth = 2 * (len(text) - 2 * linked)
        seen, k = 0, holder
        while k >= 0 and seen < 2:
            own = page.elements[k]
            if own.name in CONTAINERS or k == 0:
                scores[own.path] = scores.get(own.path, 0) + (worth if seen == 0 else worth // 2)
                seen += 1
            k = own.parent
    return {path: score for path, score in scores.items() if score > 0}


def best_path(scores: dict[str, int]) -> str | None:
    return min(scores, key=lambda p: (-scores[p], p)) if scores else None


def wide_path(scores: dict[str, int]) -> str | None:
    """The best path, widened to the outermost one around it that has half of its score."""
    best = best_path(scores)
    return best and min((p for p in scores if 2 * scores[p] >= scores[best] and f"{best}>".startswith(f"{p}>")), key=len)


def text_on(page: Page, path: str | None) -> str:
    """Blocks inside the elements on ``path``, without boilerplate in them, one per line."""
    inside: list[bool | None] = [None] * len(page.elements)
    clean = [False] * len(page.elements)
    for k, own in enumerate(page.elements):
        above = own.parent >= 0 and inside[own.parent]
        starts = path is not None and own.path == path and own.name not in INLINE
        inside[k] = bool(above or starts)
        if starts and not above:
            clean[k] = not own.dropped
        elif above:
            clean[k] = clean[own.parent] and not own.dropped
    return "\n".join(text for holder, text, _ in page.blocks if clean[holder])


def host(url: F.Column | str) -> F.Column:
    """Lower-case host of a url; empty where there is none."""
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def _votes(pages: DataFrame) -> DataFrame:
    """host and path of the winner: the highest sum of scores, the first path of equal ones, widened as by ``wide_path``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(own, path, score) for own, source in zip(batch["host"], batch["html"], strict=True) for path, score in container_scores(parsed(source)).items()]
            if rows:
                yield pd.DataFrame(rows, columns=["host", "path", "votes"])

    voted = pages.filter("host <> '' and html is not null").select("host", "html").mapInPandas(run, "host string, path string, votes long")
    summed = voted.groupBy("host", "path").agg(F.sum("votes").alias("votes"))
    best = summed.groupBy("host").agg(F.max("votes").alias("votes"))
    first = summed.join(best, ["host", "votes"]).groupBy("host", "votes").agg(F.min("path").alias("best"))
    around = summed.join(first.select("host", "best", F.col("votes").alias("most")), "host")
    around = around.filter((2 * F.col("votes") >= F.col("most")) & F.concat("best", F.lit(">")).startswith(F.concat("path", F.lit(">"))))
    return around.groupBy("host").agg(F.min_by("path", F.length("path")).alias("winner"))


def main_text(pages: DataFrame) -> DataFrame:
    """Per row of ``pages``: page_id, url, text, n_chars.

    Pages without a host, or whose own best container holds more than twice the text of their host's path, are extracted from
    that container. Null and empty pages, and pages of boilerplate alone, have an empty text. Repeated
    rows have equal results, an empty table gives no rows, and other columns are not read.
    """
    rows = pages.select("page_id", "url", "html", F.coalesce(host("url"), F.lit("")).alias("host"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = []
            for source, winner in zip(batch["html"], batch["winner"], strict=True):
                page = parsed(source or "")
                shared = text_on(page, winner) if isinstance(winner, str) else ""
                own = text_on(page, wide_path(container_scores(page)))
                texts.append(own if len(own) > 2 * len(shared) else shared)
            yield pd.DataFrame({"page_id": batch["page_id"], "url": batch["url"], "text": texts, "n_chars": [len(t) for t in texts]})

    schema = f"page_id {pages.schema['page_id'].dataType.simpleString()}, url string, text string, n_chars long"
    return rows.join(_votes(rows), "host", "left").select("page_id", "url", "html", "winner").mapInPandas(run, schema)
