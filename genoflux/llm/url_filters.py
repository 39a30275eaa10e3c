"""URL filter by temporal list join, on DataFrame functions only.

A list is a set of dated entries: on ``day`` a pattern was added or removed.
Three kinds of pattern: ``host`` (that host), ``domain`` (that host and all
below it), ``prefix`` (host and leading path segments, ``host/a/b``).

1. Entries of a pattern and day are merged (an addition wins over a removal
   of the same day), which bounds a pattern's entries by the days of its
   history.  Each addition then opens a validity interval that ends, open,
   at the pattern's next entry.
2. A capture offers its host, the suffixes of its host and the leading parts
   of its path -- no deeper than the deepest listed pattern.  Offers of
   unlisted patterns go at once.
3. The months of the remaining offers, once for each pattern, cut that
   pattern's intervals, so the as-of join is an equi-join on (kind, pattern,
   month) that leaves at most the intervals of one month to compare days
   with.  No month is made that no capture has: neither an open interval nor
   a capture of a far date makes rows.  Matches are reduced per capture and
   joined back, so every capture gets one verdict.

Each side of the list is broadcast if measured small; otherwise the equi-join
shuffles and Spark splits a hot host's captures.

Defined cases: a capture without url, host or fetch day matches nothing; a
null in an entry voids the entry; captures repeated in id, url and day share
their verdict; empty captures give no rows, an empty list blocks nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, maybe_broadcast

SCHEME = r"^[A-Za-z][A-Za-z0-9+.\-]*://"


def host_of(url: Column) -> Column:
    """Lower-case host without user, port and final dots; '' if there is none."""
    authority = F.regexp_extract(url, SCHEME + r"([^/?#\\]*)", 1)
    host = F.regexp_replace(F.regexp_replace(authority, r"^.*@", ""), r":[0-9]*$", "")
    return F.lower(F.rtrim(host, F.lit(".")))


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, SCHEME + r"[^/?#\\]*([^?#]*)", 1)


def segments(path: Column) -> Column:
    return F.filter(F.split(path, "/"), lambda s: s != "")


def _month(day: Column) -> Column:
    return F.year(day) * 12 + F.month(day)


def validity(entries: DataFrame) -> DataFrame:
    """(kind, pattern, since, until): disjoint intervals, ``until`` exclusive
    and null while the pattern is listed."""
    whole = entries.where("kind is not null and pattern is not null and day is not null "
                          "and action in ('add', 'remove')")
    merged = whole.groupBy("kind", F.lower("pattern").alias("pattern"), F.to_date("day").alias("since")) \
        .agg(F.max(F.col("action") == "add").alias("listed"))
    # a prefix keeps the case of its path
    exact = whole.where("kind = 'prefix'").groupBy("kind", "pattern", F.to_date("day").alias("since")) \
        .agg(F.max(F.col("action") == "add").alias("listed"))
    merged = merged.where("kind <> 'prefix'").unionByName(exact)
    later = Window.partitionBy("kind", "pattern").orderBy("since")
    return (merged.withColumn("until", F.lead("since").over(later)).where("listed")
            .select("kind", "pattern", "since", "until"))


def filter_captures(captures: DataFrame, entries: DataFrame, id_col: str = "page_id",
                    url_col: str = "url", day_col: str = "fetched") -> DataFrame:
    """One row per capture: ``page_id, url, fetched, host, blocked,
    n_matches, matched`` (the first ``kind:pattern`` in order) and
    ``since`` (when the earliest of the matching intervals began)."""
    rows = captures.select(captures[id_col].alias("page_id"), captures[url_col].alias("url"),
                           F.to_date(captures[day_col]).alias("fetched"))
    rows = rows.withColumn("host", F.coalesce(host_of(F.col("url")), F.lit("")))
    intervals = cut_lineage(validity(entries), "list-intervals")
    depth = intervals.agg(
        F.max(F.when(F.col("kind") == "domain", F.size(F.split("pattern", r"\.")))).alias("labels"),
        F.max(F.when(F.col("kind") == "prefix", F.size(F.split("pattern", "/")) - 1)).alias("segments"),
    ).first()
    labels, parts = F.split("host", r"\."), segments(path_of(F.col("url")))
    deep, far = int(depth["labels"] or 0), int(depth["segments"] or 0)

    def offers(kind, patterns):
        return F.transform(patterns, lambda p: F.struct(F.lit(kind).alias("kind"), p.alias("pattern")))
    upto = [offers("host", F.array("host"))]
    if deep:
        upto.append(offers("domain", F.transform(
            F.sequence(F.lit(1), F.least(F.size(labels), F.lit(deep))),
            lambda i: F.array_join(F.slice(labels, F.lit(0) - i, i), "."))))
    if far:
        upto.append(offers("prefix", F.transform(
            F.filter(F.sequence(F.lit(0), F.least(F.size(parts), F.lit(far))), lambda i: i > 0),
            lambda i: F.concat("host", F.lit("/"), F.array_join(F.slice(parts, 1, i), "/")))))
    looked = (rows.where("host <> '' and fetched is not null").distinct()
              .select("page_id", "url", "fetched", F.explode(F.concat(*upto)).alias("offer"))
              .select("page_id", "url", "fetched", "offer.kind", "offer.pattern",
                      _month(F.col("fetched")).alias("month")))
    listed = maybe_broadcast(intervals.select("kind", "pattern").distinct())
    looked = cut_lineage(looked.join(listed, ["kind", "pattern"], "left_semi"), "listed-offers")
    months = looked.select("kind", "pattern", "month").distinct()
    by_month = cut_lineage(months.join(maybe_broadcast(intervals), ["kind", "pattern"]).where(
        (_month(F.col("since")) <= F.col("month"))
        & (F.col("until").isNull() | (F.col("month") <= _month(F.col("until"))))), "intervals-by-month")
    hits = looked.join(maybe_broadcast(by_month), ["kind", "pattern", "month"]).where(
        (F.col("since") <= F.col("fetched"))
        & (F.col("until").isNull() | (F.col("fetched") < F.col("until"))))
    verdict = hits.groupBy(F.col("page_id").alias("__id"), F.col("url").alias("__url"),
                           F.col("fetched").alias("__day")).agg(
        F.count(F.lit(1)).alias("n_matches"),
        F.min(F.concat_ws(":", "kind", "pattern")).alias("matched"), F.min("since").alias("since"))
    same = (rows["page_id"].eqNullSafe(verdict["__id"]) & (rows["url"] == verdict["__url"])
            & (rows["fetched"] == verdict["__day"]))
    return rows.join(verdict, same, "left").select(
        "page_id", "url", "fetched", "host", F.col("n_matches").isNotNull().alias("blocked"),
        F.coalesce("n_matches", F.lit(0)).alias("n_matches"), "matched", "since")
