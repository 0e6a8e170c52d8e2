"""Text expressions with Unicode rules (Java patterns are ASCII-only by default)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters that count as white space, and as part of a word.
SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009"
    "\u200a\u2028\u2029\u202f\u205f\u3000"
)
SPACE_CLASS = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\p{Z}]"
OTHER_CLASS = r"[^\s\x{0b}\x{1c}-\x{1f}\x{85}\p{Z}]"
WORD_PATTERN = r"[\p{L}\p{N}_]+"


def strip(text: Column) -> Column:
    """Without leading and trailing white space of any kind."""
    return F.btrim(text, F.lit(SPACES))


def none_if_blank(text: Column) -> Column:
    """Stripped text, null where nothing is left."""
    return F.nullif(strip(text), F.lit(""))


def word_count(text: Column) -> Column:
    """Number of white-space separated words; 0 for blank or missing text."""
    return F.coalesce(F.regexp_count(text, F.lit(f"{OTHER_CLASS}+")), F.lit(0))


def has_words(text: Column, least: int) -> Column:
    """Whether there are at least ``least`` words; reads no further than the last of them."""
    pattern = rf"^{SPACE_CLASS}*(?:{OTHER_CLASS}+{SPACE_CLASS}+){{{least - 1}}}{OTHER_CLASS}"
    return F.coalesce(F.regexp_like(text, F.lit(pattern)), F.lit(False))


def words(text: Column) -> Column:
    """Lower-case words in order."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD_PATTERN), F.lit(0))


def unescape_html(text: Column) -> Column:
    """Markup of an element turned into its visible text."""
    out = F.regexp_replace(text, r"(?s)<[^>]*>", "")
    # the ampersand comes last so that an escaped entity is not decoded twice
    for entity, char in (
        ("&lt;", "<"),
        ("&gt;", ">"),
        ("&quot;", '"'),
        ("&#39;", "'"),
        ("&nbsp;", " "),
        ("&amp;", "&"),
    ):
        out = F.replace(out, F.lit(entity), F.lit(char))
    return strip(out)


def once(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed a single time, however often the body uses it.

    A plain column would be written out at each use when a filter on the result moves
    towards the scan; a lambda variable is not.
    """
    return F.element_at(F.transform(F.array(value), body), 1)
