"""Tolerant casts for text columns read from raw files.

All are built-in Column expressions, evaluated inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A timestamp text must start with a full calendar date.  Spark's cast also
# accepts a bare year ('2025') or a bare time ('17:08:06'); those are refused.
_DATE_PREFIX = r"^\s*\d{4}-\d{2}-\d{2}"
# A trailing bracketed zone name, e.g. '[Europe/Moscow]'.
_BRACKET_ZONE = r"\[.*\]$"


def blank_to_null(c: Column) -> Column:
    """``nullif(trim(c), '')``: strip spaces; an empty result becomes NULL."""
    return F.nullif(F.trim(c), F.lit(""))


def safe_timestamp(c: Column) -> Column:
    """Text → instant, NULL when it does not parse.

    Drops a trailing ``[Zone/Name]``, turns the ``T`` separator into a space,
    requires a leading ``yyyy-MM-dd`` and then casts.  An explicit offset
    fixes the instant; text without one is read in the session zone.
    """
    stripped = F.replace(F.regexp_replace(c, _BRACKET_ZONE, ""), F.lit("T"), F.lit(" "))
    return F.when(stripped.rlike(_DATE_PREFIX), stripped.try_cast("timestamp"))


def safe_long(c: Column, lenient: bool = False) -> Column:
    """Text → bigint, NULL when it does not parse.

    Strict by default: only integer text is accepted.  ``lenient=True`` also
    accepts decimals and exponents and rounds half away from zero ('1.5' → 2,
    '1e3' → 1000), going through an exact decimal so ids above 2^53 survive.
    """
    text = blank_to_null(c)
    if not lenient:
        return text.try_cast("bigint")
    exact = text.try_cast("decimal(38,10)")
    via_double = F.when(exact.isNull(), F.round(text.try_cast("double")))
    return F.coalesce(F.round(exact, 0), via_double).try_cast("bigint")


def safe_int(c: Column, lenient: bool = False) -> Column:
    """Text → int, NULL when it does not parse or does not fit."""
    return safe_long(c, lenient).try_cast("int")
