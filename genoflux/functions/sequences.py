"""Sequence and insertion expressions: gap masking, unknown fill, insertion
lists.  All native Column expressions -- no per-row Python."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import _c, not_blank


def mask_edge_gaps(c, fill: str = "N", leading: bool = True,
                   trailing: bool = True, gap: str = "-") -> Column:
    """Replace the run of ``gap`` characters at the start and/or end of a
    sequence by ``fill``; inner gaps stay, length is preserved, null stays
    null.  An all-gap sequence becomes all ``fill``."""
    s = _c(c)
    n = F.length(s)
    # run lengths by trimming the gap character (no regular expression)
    lead = (n - F.length(F.ltrim(s, F.lit(gap)))) if leading else F.lit(0)
    trail = (n - F.length(F.rtrim(s, F.lit(gap)))) if trailing else F.lit(0)
    # An all-gap string: the leading run already covers it; do not count twice.
    trail = F.when(lead == n, F.lit(0)).otherwise(trail)
    middle = s.substr(lead + 1, n - lead - trail)
    masked = F.concat(F.repeat(F.lit(fill), lead), middle, F.repeat(F.lit(fill), trail))
    return F.when(s.isNull(), F.lit(None).cast("string")).otherwise(masked)


def unknown_like(c, fill: str) -> Column:
    """``fill`` repeated to the length of ``c`` (template -> unknown)."""
    return F.repeat(F.lit(fill), F.length(_c(c)))


def unknown_template(m, fill: str) -> Column:
    """Every value of a name -> sequence map replaced by ``fill`` x length."""
    return F.transform_values(_c(m), lambda k, v: F.repeat(F.lit(fill), F.length(v)))


def fill_from_template(m, template: Mapping[str, int | str], fill: str | None = None) -> Column:
    """For each template name whose value in map ``m`` is null or absent, use
    the template string (or ``fill`` x length when an int is given); names not
    in the template are left untouched."""
    m = _c(m)
    names = list(template)
    kept = F.map_filter(m, lambda k, v: ~k.isin(names))
    pairs = []
    for name in names:
        t = template[name]
        tcol = F.repeat(F.lit(fill or "N"), F.lit(int(t))) if isinstance(t, int) else F.lit(t)
        pairs += [F.lit(name), F.coalesce(F.try_element_at(m, F.lit(name)), tcol)]
    if not pairs:
        return m
    filled = F.create_map(*pairs)
    return F.map_concat(F.coalesce(kept, F.create_map().cast("map<string,string>")), filled)


def insertion_list(c) -> Column:
    """Comma-separated insertions to an array; null/blank -> empty array."""
    s = _c(c)
    return F.when(not_blank(s), F.split(s, ",")).otherwise(
        F.array().cast("array<string>"))


def insertions_by_gene(c, genes: Iterable[str]) -> Column:
    """``S:214:EPE,N:3:K`` -> map gene -> [text after the first ``:``]; every
    known gene present (possibly empty).  A piece without ``:`` or naming an
    unknown gene fails the job."""
    s = _c(c)
    known = F.array(*[F.lit(g) for g in genes]).cast("array<string>")
    items = F.when(not_blank(s), F.split(s, ",")).otherwise(F.array().cast("array<string>"))
    pairs = F.transform(items, lambda x: F.split(x, ":", 2))

    def by_gene(split):
        bad = F.exists(split, lambda p: (F.size(p) < 2) | ~F.array_contains(known, F.get(p, 0)))
        grouped = F.map_from_entries(F.transform(known, lambda g: F.struct(
            g, F.transform(F.filter(split, lambda p: F.get(p, 0) == g), lambda p: F.get(p, 1)))))
        return F.when(bad, F.raise_error(F.concat(F.lit("bad amino-acid insertion list: "), s))
                      ).otherwise(grouped)
    # the split list is bound once, as the variable of a one-element transform
    return F.get(F.transform(F.array(pairs), by_gene), 0)


def sorted_map(m) -> Column:
    """Map with keys in ascending order (canonical serialisation)."""
    # sort_array is compiled; array_sort compares by a function called for each pair
    return F.map_from_entries(F.sort_array(F.map_entries(_c(m))))


def canonical_maps(c, kind: T.DataType) -> Column:
    """``c``, of type ``kind``, with the keys of its maps in ascending order,
    at any depth; unchanged where the type holds no map."""
    c = _c(c)
    if not _holds_map(kind):
        return c
    if isinstance(kind, T.MapType):
        if not _holds_map(kind.valueType):
            return sorted_map(c)
        # entries whose values hold maps have no order of their own
        entries = F.array_sort(F.map_entries(c), lambda a, b: F.when(a["key"] < b["key"], -1).when(
            a["key"] > b["key"], 1).otherwise(0))
        return F.map_from_entries(F.transform(entries, lambda e: F.struct(
            e["key"].alias("key"), canonical_maps(e["value"], kind.valueType).alias("value"))))
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda x: canonical_maps(x, kind.elementType))
    fields = F.struct(*[canonical_maps(c[f.name], f.dataType).alias(f.name) for f in kind.fields])
    return F.when(c.isNotNull(), fields)


def _holds_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_holds_map(f.dataType) for f in kind.fields)
    return isinstance(kind, T.MapType) or isinstance(kind, T.ArrayType) and _holds_map(kind.elementType)
