"""Text clean-up expressions. Cleaning always sees the whole text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space as a Unicode-aware strip or \s sees it. Spelled out
# because Java's \s and SQL trim() know ASCII blanks only.
BLANK_CHARACTERS = (
    "\t\n\v\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")
BLANKS = (r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
          r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]")

# Fixed value: width of a preview of a long text.
STORED_TEXT = 4000


def clip(text: Column, width: int | None) -> Column:
    """Leftmost ``width`` characters; None keeps the whole text."""
    return text if width is None else F.left(text, F.lit(width))


def strip(text: Column) -> Column:
    """Blanks off both ends; looks at the ends only, unlike a pattern."""
    return F.btrim(text, F.lit(BLANK_CHARACTERS))


def html_to_text(html: Column, width: int | None = None) -> Column:
    """Tags to blanks, blank runs to one space, ends stripped."""
    no_tags = F.regexp_replace(html, "<[^>]+>", " ")
    return clip(F.trim(F.regexp_replace(no_tags, rf"{BLANKS}+", " ")), width)


def normalise_newlines(text: Column, width: int | None = None) -> Column:
    """Runs of three or more newlines become two, ends stripped."""
    return clip(strip(F.regexp_replace(text, "\n{3,}", "\n\n")), width)


def b64url_to_text(data: Column) -> Column:
    """base64url (padding optional) to text; invalid UTF-8 becomes U+FFFD."""
    standard = F.replace(F.replace(data, F.lit("-"), F.lit("+")), F.lit("_"), F.lit("/"))
    return F.make_valid_utf8(F.try_to_binary(standard, F.lit("base64")).cast("string"))


def is_blank(text: Column) -> Column:
    return F.trim(text) == ""
