"""Text cleaning, tokenising and keyword predicates as built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventlens.constants import TOKEN_PATTERN, WHITESPACE_CLASS


def clean_text(c: Column) -> Column:
    """NULL → '', lower-case, every run of Unicode whitespace → one space, strip.

    CR and LF are whitespace, so they fold into the same single space.
    Whitespace is Python's Unicode set (no-break space, ideographic space...),
    not Java's ASCII default.
    """
    lowered = F.lower(F.coalesce(c.cast("string"), F.lit("")))
    collapsed = F.regexp_replace(lowered, WHITESPACE_CLASS + "+", " ")
    return F.trim(collapsed)


def has_text(c: Column) -> Column:
    """Whether ``clean_text`` leaves anything: some character is no whitespace (read up to the first)."""
    return F.coalesce(c.cast("string").rlike(f"[^{WHITESPACE_CLASS[1:]}"), F.lit(False))


def clean_target(c: Column, null_as: str | None = None) -> Column:
    """Label to text with Unicode whitespace stripped at both ends.

    NULL stays NULL (later filtered out as blank) unless ``null_as`` is given,
    e.g. ``null_as='nan'`` to keep empty cells as the text 'nan'.
    """
    text = c.cast("string")
    if null_as is not None:
        text = F.coalesce(text, F.lit(null_as))
    return F.regexp_replace(text, f"^{WHITESPACE_CLASS}+|{WHITESPACE_CLASS}+$", "")


def tokens(c: Column, pattern: str = TOKEN_PATTERN) -> Column:
    """Array of Unicode words of two or more characters, in text order."""
    return F.regexp_extract_all(c, F.lit(pattern), 0)


def has_keyword(c: Column, keyword: str) -> Column:
    """``lower(c) LIKE '%keyword%'`` as a literal substring test (NULL → false)."""
    return F.coalesce(F.lower(c).contains(keyword.lower()), F.lit(False))


def flag(predicate: Column) -> Column:
    """``CASE WHEN predicate THEN 1 ELSE 0 END`` (NULL predicate → 0)."""
    return F.when(predicate, F.lit(1)).otherwise(F.lit(0))
