"""Typed parsing of text metadata: partial dates, integers, doubles.

Each parser is a Column -> Column (or dict of Columns) built from native
expressions.  Spark's casts are more permissive than the record semantics
(they trim, accept ``2022``/``2022-5-1`` as dates and ``inf`` as a double),
so each lenient cast sits behind a regular-expression guard.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _c

_FULL_DATE = r"^\d{4}-\d{2}-\d{2}\z"
_PARTIAL_DATE = r"^(\d{4})(-\d{2})?(-\d{2})?\z"
_INTEGER = r"^[+-]?\d+\z"
# Spark's double cast also takes inf/infinity/nan in any case; the record
# semantics (Java's parser) only take the exact spellings below.
_SPECIAL_ANY_CASE = r"(?i)^\s*[+-]?(inf|infinity|nan)\s*\z"
_SPECIAL_EXACT = r"^\s*[+-]?(Infinity|NaN)\s*\z"


def parse_partial_date(c) -> dict[str, Column]:
    """Complete ISO dates keep their text; anything else nulls the date and
    keeps whatever year / month / day parts validate after ``X`` -> ``0``.

    Returns the five output columns keyed by suffix: ``""`` (the date text),
    ``Year``, ``Month``, ``Day``, ``OriginalValue``.
    """
    s = _c(c)
    full_y = F.substring(s, 1, 4).try_cast("int")
    full_m = F.substring(s, 6, 2).try_cast("int")
    full_d = F.substring(s, 9, 2).try_cast("int")
    # A calendar check by arithmetic (proleptic ISO, year 0000 included),
    # not a date cast: Spark's date type starts at year 1.
    leap = ((full_y % 4 == 0) & (full_y % 100 != 0)) | (full_y % 400 == 0)
    month_len = (F.when(full_m == 2, F.when(leap, F.lit(29)).otherwise(F.lit(28)))
                 .when(full_m.isin(4, 6, 9, 11), F.lit(30)).otherwise(F.lit(31)))
    shaped = F.coalesce(s.rlike(_FULL_DATE), F.lit(False))
    complete = shaped & F.when(shaped, (full_m >= 1) & (full_m <= 12) & (full_d >= 1)
                               & (full_d <= month_len)).otherwise(F.lit(False))
    z = F.translate(s, "X", "0")
    # The shapes are fixed-width (YYYY, YYYY-MM, YYYY-MM-DD): one anchored
    # match, then the parts by position.
    matches = F.coalesce(z.rlike(_PARTIAL_DATE), F.lit(False))
    n = F.length(z)
    y = F.substring(z, 1, 4).try_cast("int")
    m = F.when(n >= 7, F.substring(z, 6, 2).try_cast("int"))
    d = F.when(n == 10, F.substring(z, 9, 2).try_cast("int"))
    return {
        "": F.when(complete, s),
        "Year": F.when(complete, full_y).when(matches & (y > 0), y),
        "Month": F.when(complete, full_m).when(matches & (m >= 1) & (m <= 12), m),
        "Day": F.when(complete, full_d).when(matches & (d >= 1) & (d <= 31), d),
        "OriginalValue": s,
    }


def _strict(s: Column, parsed: Column, what: str) -> Column:
    return F.when(s.isNotNull() & parsed.isNull(),
                  F.raise_error(F.concat(F.lit(f"cannot parse {what}: "), s))
                  ).otherwise(parsed)


def parse_int(c, ignore_errors: bool = False) -> Column:
    """Integer text (optional sign, digits only, no spaces) to int."""
    s = _c(c)
    parsed = F.when(s.rlike(_INTEGER), s.try_cast("int")).cast("int")
    return parsed if ignore_errors else _strict(s, parsed, "integer")


def parse_double(c, ignore_errors: bool = False) -> Column:
    """Decimal / scientific text to double; ``inf``-style spellings Spark
    alone would accept are rejected."""
    s = _c(c)
    special_ok = ~s.rlike(_SPECIAL_ANY_CASE) | s.rlike(_SPECIAL_EXACT)
    parsed = F.when(special_ok, s.try_cast("double")).cast("double")
    return parsed if ignore_errors else _strict(s, parsed, "double")
