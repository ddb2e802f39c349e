"""Dirty cells: numbers, blanks, whitespace, HTML text."""

from __future__ import annotations

import html

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from folioscope import fixed_values as fv

CELL = "struct<s:string,n:double>"
PLAIN_NUMBER = r"^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def collapse(col: Column) -> Column:
    """Whitespace runs become one space, ends are trimmed. Texts with single spaces only are left as they are."""
    return F.trim(F.when(col.rlike(r"[\t\n\x0B\f\r]|  "), F.regexp_replace(col, r"\s+", " ")).otherwise(col))


def try_number(text: Column) -> Column:
    """Plain decimal text as a double, anything else null (ANSI safe)."""
    bare = F.trim(text)
    return F.when(bare.rlike(PLAIN_NUMBER), bare.try_cast("double"))


def null_blanks(text: Column) -> Column:
    """The blank vocabulary becomes null."""
    return F.when(~F.lower(F.trim(text)).isin(fv.BLANK_WORDS), text)


def cell_number(cell: Column) -> Column:
    """Number of a cell: the typed number, else numeric text."""
    return F.coalesce(cell["n"], try_number(cell["s"]))


def cell_text(cell: Column) -> Column:
    """Printed form of a cell; whole numbers without a fraction."""
    n = cell["n"]
    whole = (n == F.floor(n)) & (F.abs(n) < 1e15)
    return F.coalesce(cell["s"], F.when(whole, n.try_cast("bigint").cast("string")).otherwise(n.cast("string")))


def typed_cell(number: Column | None = None, text: Column | None = None) -> Column:
    """Build a cell from a number column or a text column."""
    s = F.lit(None).cast("string") if text is None else text.cast("string")
    n = F.lit(None).cast("double") if number is None else number.cast("double")
    return F.struct(s.alias("s"), n.alias("n"))


def contains_any(text: Column, words: list[str]) -> Column:
    """True when any of the words occurs in the text."""
    hit = F.lit(False)
    for word in words:
        hit = hit | text.contains(word)
    return hit


@F.udf(StringType(), useArrow=False)
def unescape_entities(text: str | None) -> str | None:
    """HTML entities to characters; the full entity table lives in Python's stdlib only.

    Whole pages come through, so rows go one by one: an Arrow batch would hold up to 10,000 pages at a time.
    """
    return html.unescape(text) if text is not None and "&" in text else text


def clean_html_text(text: Column) -> Column:
    """Tags out, entities decoded, dashes folded, whitespace collapsed."""
    bare = unescape_entities(F.regexp_replace(text, r"<[^>]+>", " "))
    return collapse(F.translate(bare, "–—‑", "---"))
