"""String primitives shared by the chat, token and reward expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as whitespace when text is stripped and when a pattern
# says "any whitespace". Spark's trim() only knows the space and Java's \s misses most of them.
WHITESPACE = (
    "\u0009\u000a\u000b\u000c\u000d\u001c\u001d\u001e\u001f\u0020\u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
WHITESPACE_CLASS = "[" + "".join(f"\\x{{{ord(c):04x}}}" for c in WHITESPACE) + "]"


def strip(text: Column) -> Column:
    """Remove leading and trailing whitespace (full Unicode set)."""
    return F.btrim(text, F.lit(WHITESPACE))


def is_blank(text: Column) -> Column:
    return F.octet_length(strip(text)) == 0


def occurs_once(text: Column, literal: str) -> Column:
    """Whether an ASCII literal occurs exactly once, counting from the left without overlaps.

    Byte lengths are stored with the string, so this costs one replace and no character count.
    """
    removed = F.octet_length(text) - F.octet_length(F.replace(text, F.lit(literal), F.lit("")))
    return removed == len(literal)


def last_piece(text: Column, literal: str) -> Column:
    """What follows the last delimiter when the text is split from the left.

    substring_index(-1) searches from the right, which differs for delimiters that can overlap
    themselves, hence the split.
    """
    return F.element_at(F.split(text, f"\\Q{literal}\\E", -1), -1)
