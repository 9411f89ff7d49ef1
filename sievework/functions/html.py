"""HTML to text.

The text of a page is every text node outside comments and a few dropped elements, joined by single spaces,
cut to a given length. Regular markup is handled by native expressions. Markup on which a regular expression
cannot follow an HTML parser (unclosed or misnested dropped elements, ``>`` inside attributes, rare entities
...) is recognised by native tests and only those pages are sent to Python workers; all other rows cross
over as NULL, so a table is scanned once and the Python cost follows the number of irregular pages.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.entities import html5

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievework.functions.text import collapse_whitespace

# What a request holds of a page, unless the caller says otherwise.
MAX_CHARS = 8000
MIN_STATIC_CHARS = 200

# Elements whose content is not page text.
DROPPED_ELEMENTS = ("script", "style", "noscript", "header", "footer", "nav")
# Elements whose strings are not plain text nodes and are left out of a page's text as well.
HIDDEN_ELEMENTS = ("template", "rt", "rp")
# Elements that never have content.
VOID_ELEMENTS = (
    "area", "base", "basefont", "bgsound", "br", "col", "command", "embed", "frame", "hr", "image", "img",
    "input", "isindex", "keygen", "link", "menuitem", "meta", "nextid", "param", "source", "spacer", "track",
    "wbr",
)

# Entities decoded natively; any other one sends the page to the parser. ``amp`` must stay last, so that
# ``&amp;lt;`` ends up as ``&lt;``.
NATIVE_ENTITIES = (
    "nbsp", "copy", "reg", "trade", "middot", "bull", "hellip", "ndash", "mdash", "lsquo", "rsquo", "ldquo",
    "rdquo", "laquo", "raquo", "euro", "quot", "apos", "lt", "gt", "amp",
)

_UNSEEN = DROPPED_ELEMENTS + HIDDEN_ELEMENTS
# Patterns start with one plain character, so that a matcher has to look closer at '<', '=' or '&' only.
_BLOCKS = "|".join(rf"{t}(?:\s[^>]*)?>.*?</{t}\s*>" for t in _UNSEEN)
# One alternation, so that whichever construct starts first wins, as in a parser.
_REMOVED = rf"(?is)<(?:!--.*?-->|{_BLOCKS})"
_TAG = r"<[^>]*>"

# Signs, in the text left after removal, that removal or tag stripping did not do what a parser does:
# a leftover tag of a removed element or an unclosed comment, a '<' that starts no tag, a CDATA section,
# an empty end tag (which separates nothing), a tag cut off by the end of the text, a '>' inside a quoted
# attribute.
_IRREGULAR_TAG = rf"(?is)<(?:/?(?:{'|'.join(_UNSEEN)})(?![a-z0-9:_.-])|!--|!\[|/>|(?![a-z/!?])|[^>]*$)"
_IRREGULAR_ATTRIBUTE = r"""=(?:"[^"<]*>[^"]*"|'[^'<]*>[^']*')"""
# Comment ends on which parsers disagree, and self-closing tags of removed elements, which hold nothing.
_IRREGULAR_REMOVAL = r"(?is)^<!--(?:-?>|.*--(?:!|\s+)>)|^<[a-z]+[^>]*/>"
_IRREGULAR_ENTITY = rf"&(?!(?:{'|'.join(NATIVE_ENTITIES)});)[A-Za-z#]"

# Inside a removed element an end tag may close something opened before it. Innermost balanced elements are
# erased a few levels deep; if any tag remains, the page is left to the parser.
_CHILDLESS = (
    rf"(?is)<!--.*?-->|<script(?:\s[^>]*)?>.*?</script\s*>|<style(?:\s[^>]*)?>.*?</style\s*>"
    rf"|<[a-z][^<>]*/>|<(?:{'|'.join(VOID_ELEMENTS)})(?:\s[^<>]*)?>"
)
_INNERMOST = r"(?is)<([a-z][a-z0-9-]*)(?:\s[^<>]*)?>[^<]*</\1\s*>"
_NESTING_LEVELS = 12

# Tags of removed elements and comment signs, in order. Where they do not pair up, a search for an end would run to
# the end of the page from every beginning; such pages go to the parser before anything is searched.
_ENDS = rf"(?i)<!--|-->|</?(?:{'|'.join(_UNSEEN)})(?=[\s/>])"
_PAIR = rf"<!---->|<({'|'.join(_UNSEEN)})</\1"
_PAIRED_LEVELS = 5
# A tag that another one interrupts, or the end of the text; checked without looking further than the next sign.
_OPEN_ANGLE = r"<[^<>]*(?:<|$)"


def with_page_text(pages: DataFrame, html: str = "html", out: str = "page_text", max_chars: int | None = MAX_CHARS) -> DataFrame:
    """Add ``out``, the first ``max_chars`` characters (None: all) of the visible text of ``html``; NULL html gives NULL."""
    kept_columns = [F.col(c) for c in pages.columns]
    even = F.when(_paired(F.col(html)), F.col(html))
    staged = pages.select(
        *kept_columns,
        F.regexp_replace(even, _REMOVED, " ").alias("_kept"),
        F.regexp_extract_all(even, F.lit(_REMOVED), F.lit(0)).alias("_removed"),
    )
    staged = staged.select(
        *kept_columns,
        "_kept",
        "_removed",
        F.regexp_replace(F.when(~F.col("_kept").rlike(_OPEN_ANGLE), F.col("_kept")), _TAG, " ").alias("_bare"),
    )
    irregular = F.when(F.col("_kept").isNull() | F.col("_kept").rlike(_OPEN_ANGLE), True).otherwise(
        F.col("_kept").rlike(_IRREGULAR_TAG)
        | F.col("_kept").rlike(_IRREGULAR_ATTRIBUTE)
        | F.col("_bare").rlike(_IRREGULAR_ENTITY)
        | F.exists("_removed", lambda part: part.rlike(_IRREGULAR_REMOVAL))
        | _misnested(F.col("_removed"))
    )
    native = collapse_whitespace(_decode_entities(F.col("_bare")))
    staged = staged.select(
        *kept_columns,
        F.when(irregular, F.col(html)).alias("_irregular"),
        native.alias("_native"),
    )
    text = F.coalesce(parsed_text("_irregular"), "_native")
    return staged.select(*kept_columns, (text if max_chars is None else F.left(text, F.lit(max_chars))).alias(out))


def _paired(html: Column) -> Column:
    """Whether every tag of a removed element and every comment sign has its counterpart, a few levels deep."""
    ends = F.lower(F.array_join(F.regexp_extract_all(html, F.lit(_ENDS), F.lit(0)), ""))
    for _ in range(_PAIRED_LEVELS):
        ends = F.regexp_replace(ends, _PAIR, "")
    return ends == ""


def _misnested(removed: Column) -> Column:
    """True unless every element inside the removed blocks is opened and closed within its block."""
    blocks = F.filter(removed, lambda part: ~part.rlike(r"(?i)^<(?:!--|script|style)"))
    # The separator keeps one block's text apart from the next one's.
    text = F.regexp_replace(F.array_join(blocks, "\n"), _CHILDLESS, "")
    for _ in range(_NESTING_LEVELS):
        text = F.regexp_replace(text, _INNERMOST, "")
    return F.contains(text, F.lit("<"))


def _decode_entities(text: Column) -> Column:
    decoded = text
    for name in NATIVE_ENTITIES:
        decoded = F.replace(decoded, F.lit(f"&{name};"), F.lit(html5[name + ";"]))
    return F.when(F.contains(text, F.lit("&")), decoded).otherwise(text)


@F.pandas_udf(T.StringType())
def _parsed_text(html: pd.Series) -> pd.Series:
    """The visible text by the scanner, for the rows that carry markup; NULL elsewhere."""
    result = pd.Series([None] * len(html), index=html.index, dtype=object)
    present = html.notna()
    if present.any():
        result[present] = [visible_text(page) for page in html[present]]
    return result


# A filter on the text must not be moved below it and make it twice.
parsed_text = _parsed_text.asNondeterministic()


def visible_text(html: str) -> str:
    """Text of one page of any shape, in time linear in its length."""
    return " ".join("".join(_Scanner(html).pieces()).split())


# Names end where a browser ends them; an attribute is a name and, after '=', a value in quotes or bare.
_TAG_NAME = re.compile(r"[a-zA-Z][^\t\n\r\f />\x00]*")
_BETWEEN = re.compile(r"(?:\s|/(?!>))*+")
_ATTRIBUTE = re.compile(r"[^\s/>][^\s/=>]*+(?:\s*+=+\s*+)?+")
_BARE_VALUE = re.compile(r"[^>\s]*+")
_SECTION_NAME = re.compile(r"<!\[([a-zA-Z]*)")
_CHARACTER = re.compile(r"&#([0-9]+|[xX][0-9a-fA-F]+)(?=[^0-9a-fA-F]);?")
_ENTITY = re.compile(r"&([a-zA-Z][-.a-zA-Z0-9]*)(?=[^a-zA-Z0-9]);?")
_SIGN = re.compile(r"[<&]")
_SPACES = re.compile(r"\s*+")
_COMMENT_END, _SECTION_END, _CONDITION_END = (re.compile(x) for x in (r"--\s*>", r"\]\s*\]\s*>", r"\]\s*>"))
_RAW_ELEMENTS = {name: re.compile(rf"</\s*{name}\s*>", re.I) for name in ("script", "style")}


class _Scanner:
    """Runs through a page once and gives its text nodes outside unseen elements, with spaces where there was markup.

    An end tag closes the nearest open element of its name and everything opened since; one that matches nothing is ignored.
    What starts like markup but doesn't end is text, up to the next '>' or, without one, up to the next '<', as it stands.

    Nothing is searched for twice: the next place of an end sign is kept until it has been passed, and places inside of
    a tag from which its end can't be reached are remembered.
    """

    def __init__(self, html: str) -> None:
        self.html = html
        self._next: dict[object, tuple[int, int]] = {}
        self._endless: set[int] = set()
        self._open: list[str] = []
        self._counts: dict[str, int] = {}
        self._unseen = 0

    def pieces(self) -> Iterator[str]:
        html, at = self.html, 0
        while at < len(html):
            sign = _SIGN.search(html, at)
            start = sign.start() if sign else len(html)
            if start > at and not self._unseen:
                yield html[at:start]
            if not sign:
                return
            text, at = self._markup(start) if html[start] == "<" else self._reference(start)
            if text and not self._unseen:
                yield text

    def _end_of(self, sign: str | re.Pattern, at: int) -> int:
        """Where the next ``sign`` from ``at`` on ends, or -1."""
        start, end = self._next.get(sign, (-1, 0))
        if end >= 0 and start < at:
            if isinstance(sign, str):
                start = self.html.find(sign, at)
                end = start + len(sign) if start >= 0 else -1
            else:
                found = sign.search(self.html, at)
                start, end = found.span() if found else (-1, -1)
            self._next[sign] = start, end
        return end

    def _markup(self, at: int) -> tuple[str, int]:
        html = self.html
        follows = html[at + 1 : at + 2]
        if follows.isascii() and follows.isalpha():
            end = self._start_tag(at)
        elif html.startswith("</>", at):
            return "", at + 3  # separates nothing
        elif follows == "/":
            end = self._end_tag(at)
        elif html.startswith("<!--", at):
            end = self._end_of(_COMMENT_END, at + 4)
        elif html.startswith("<![", at):
            return self._section(at)
        elif follows and follows in "!?":
            end = self._end_of(">", at + 2)
        else:
            return "<", at + 1
        return (" ", end) if end >= 0 else self._unended(at)

    def _unended(self, at: int) -> tuple[str, int]:
        end = self._end_of(">", at + 1)
        if end < 0:
            end = self._end_of("<", at + 1) - 1
            end = end if end >= 0 else at + 1
        return self.html[at:end], end

    def _section(self, at: int) -> tuple[str, int]:
        name = _SECTION_NAME.match(self.html, at)[1].lower()
        if name in ("cdata", "temp", "ignore", "include", "rcdata"):
            end = self._end_of(_SECTION_END, at + 3)
            if end >= 0 and name == "cdata" and self.html.startswith("[", at + 8):
                return f" {self.html[at + 9 : self._next[_SECTION_END][0]]} ", end
        else:
            end = self._end_of(_CONDITION_END if name in ("if", "else", "endif") else ">", at + 3)
        return (" ", end) if end >= 0 else self._unended(at)

    def _start_tag(self, at: int) -> int:
        if self._end_of(">", at + 1) < 0:
            return -1
        html = self.html
        name = _TAG_NAME.match(html, at + 1)
        place, passed = name.end(), []
        while True:
            place = _BETWEEN.match(html, place).end()
            if place in self._endless:
                break
            passed.append(place)
            sign = html[place : place + 1]
            if sign == ">" or html.startswith("/>", place):
                end = place + 1 + (sign == "/")
                self._opened(name[0].lower(), sign == "/")
                raw = _RAW_ELEMENTS.get(name[0].lower()) if sign == ">" else None
                if raw:  # its content is no markup; without an end tag it goes on to the end of the page
                    last = self._end_of(raw, end)
                    self._closed(name[0].lower()) if last >= 0 else None
                    return last if last >= 0 else len(html)
                return end
            attribute = _ATTRIBUTE.match(html, place)
            if not attribute:  # the end of the page
                break
            place = attribute.end()
            if "=" in attribute[0][1:]:
                quote = html[place : place + 1]
                if quote and quote in "\"'":
                    place = self._end_of(quote, place + 1)
                    if place < 0:
                        break
                else:
                    place = _BARE_VALUE.match(html, place).end()
        self._endless.update(passed)
        return -1

    def _end_tag(self, at: int) -> int:
        end = self._end_of(">", at + 2)
        found = _TAG_NAME.match(self.html, _SPACES.match(self.html, at + 2).end())
        if end >= 0 and found:
            self._closed(found[0].lower())
        return end

    def _opened(self, tag: str, alone: bool) -> None:
        if not alone and tag not in VOID_ELEMENTS:
            self._open.append(tag)
            self._counts[tag] = self._counts.get(tag, 0) + 1
            self._unseen += tag in _UNSEEN

    def _closed(self, tag: str) -> None:
        if self._counts.get(tag):
            closed = None
            while closed != tag:
                closed = self._open.pop()
                self._counts[closed] -= 1
                self._unseen -= closed in _UNSEEN

    def _reference(self, at: int) -> tuple[str, int]:
        found = _CHARACTER.match(self.html, at)
        if found:
            return _character(found[1]), found.end()
        found = _ENTITY.match(self.html, at)
        if not found:
            return "&", at + 1
        # A name that is no entity stays as written, without its semicolon.
        return html5.get(found[1] + ";") or html5.get(found[1]) or "&" + found[1], found.end()


def _character(reference: str) -> str:
    """The character for ``#`` references; codes below 256 are read as Windows-1252 where that is defined."""
    hexadecimal = reference[:1] in "xX"
    try:
        code = int(reference.lstrip("xX"), 16) if hexadecimal else int(reference)
        if code < 256:
            try:
                return bytes([code]).decode("windows-1252")
            except UnicodeDecodeError:
                pass
        return chr(code)
    except (ValueError, OverflowError):
        return "\ufffd"


def rendered_or_static(static_text: Column, rendered_text: Column | None) -> Column:
    """Keep static text of at least ``MIN_STATIC_CHARS``; else take the rendered page's text, or nothing.

    A short static text is not reused when rendering gave nothing. Without a rendered column it is kept.
    """
    if rendered_text is None:
        return static_text
    return F.when(F.length(static_text) >= MIN_STATIC_CHARS, static_text).otherwise(
        F.coalesce(rendered_text, F.lit(""))
    )
