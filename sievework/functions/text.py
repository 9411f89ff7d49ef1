"""String helpers with Python's idea of whitespace, as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip() removes and its \s matches. Spark's trim() removes U+0020 only and
# Java's \s is ASCII only. All of them are in the basic plane.
WHITESPACE = "".join(chr(c) for c in range(0x10000) if chr(c).isspace())
# All of them but the space. The first half turns most characters away with one comparison.
_NOT_SPACE = (
    r"[[^ -\x84]&&[\t-\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]]"
)


def strip(text: Column) -> Column:
    """Remove leading and trailing Unicode whitespace."""
    return F.btrim(text, F.lit(WHITESPACE))


def is_blank(text: Column) -> Column:
    """True for text that is empty after stripping; NULL stays NULL."""
    return strip(text) == ""


def collapse_whitespace(text: Column) -> Column:
    """Turn every run of whitespace into one space and strip the ends."""
    return F.btrim(F.regexp_replace(F.regexp_replace(text, _NOT_SPACE, " "), "  +", " "))
