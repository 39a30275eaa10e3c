"""Location text handling and JSON-path lookups."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _c, not_blank, utrim

GEO_LEVELS = ("region", "country", "division", "location")


def split_location(c, sep: str = "/") -> list[Column]:
    """``Europe / CH / ZH`` -> four trimmed parts, missing parts null; blank
    (or null -- a deliberate relaxation, not a crash) -> four nulls."""
    s = _c(c)
    parts = F.split(s, sep if sep != "/" else "/")
    return [F.when(not_blank(s), utrim(F.get(parts, i))) for i in range(4)]


def geo_normalise(c) -> Column:
    """Before rule lookup: null -> "" and Unicode trim."""
    return utrim(F.coalesce(_c(c), F.lit("")))


def json_path(c, path: str) -> Column:
    """JSON-path lookup on a JSON text column (e.g. ``$[0].version.tag``)."""
    return F.get_json_object(_c(c), path)
