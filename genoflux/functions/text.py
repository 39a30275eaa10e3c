"""Null and whitespace handling as plain Column expressions (JVM-side)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters the record semantics treat as white space
# (Java's isWhitespace or isSpaceChar): tab, line feed, vertical tab, form
# feed, carriage return, the four information separators U+001C-U+001F,
# space, no-break space, ogham space mark, the en quad .. hair space block
# U+2000-U+200A, line separator, paragraph separator, narrow no-break space,
# medium mathematical space, ideographic space.
WHITESPACE = ("\t\n\u000b\f\r\u001c\u001d\u001e\u001f \u00a0\u1680"
              + "".join(chr(c) for c in range(0x2000, 0x200B))
              + "\u2028\u2029\u202f\u205f\u3000")
# Spark's trim() strips only the space character; btrim with this set
# strips all of them, without a regular expression.


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def utrim(c) -> Column:
    """Strip leading/trailing white space (tab, NBSP, ... see WHITESPACE)."""
    return F.btrim(_c(c), F.lit(WHITESPACE))


def not_blank(c) -> Column:
    """False for null, empty or all-white-space text (never null)."""
    return F.coalesce(F.length(utrim(c)) > 0, F.lit(False))


def is_blank(c) -> Column:
    """True for null, empty or all-white-space text (never null)."""
    return ~not_blank(c)


def null_if_in(c, values: Iterable[str]) -> Column:
    """Exact, case-sensitive replacement of the given markers by null."""
    c = _c(c)
    values = list(values)
    if not values:
        return c
    return F.when(c.isin(values), F.lit(None).cast("string")).otherwise(c)


def empty_to_null(c) -> Column:
    return F.nullif(_c(c), F.lit(""))
