"""Fingerprints and snapshot diffs.

The diff of two snapshots is a *long table* ``(id, status)`` with status in
``added / changed / unchanged / deleted`` -- never id lists held in memory.
Only the narrow ``(id, md5)`` projections are shuffled; wide sequence
columns are joined back last, through a semi-join on the id.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import row_md5
from ..session import BROADCAST_MAX_BYTES, cut_lineage, payload_bytes

ADDED, CHANGED, UNCHANGED, DELETED = "added", "changed", "unchanged", "deleted"
STATUSES = (ADDED, CHANGED, UNCHANGED, DELETED)


def fingerprint(df: DataFrame, id_col: str, cols: Sequence[str] | None = None,
                framing: str = "plain", keep: Sequence[str] = ()) -> DataFrame:
    """``(id, md5)`` per row; the digest covers ``cols`` (default: all
    columns, id included) in canonical JSON form."""
    cols = list(cols) if cols is not None else list(df.columns)
    return df.select(F.col(id_col).alias("id"), row_md5(df, cols, framing).alias("md5"),
                     *[F.col(k) for k in keep])


def dedup_last(df: DataFrame, id_col: str = "id", value_col: str = "md5",
               ordinal_col: str = "ordinal") -> DataFrame:
    """Last value per id by ordinal (``max_by``: partial aggregation, so a
    hot id is combined map-side instead of landing in one task)."""
    return df.groupBy(id_col).agg(F.max_by(value_col, ordinal_col).alias(value_col))


def snapshot_diff(old: DataFrame, new: DataFrame, id_col: str = "id",
                  hash_col: str = "md5", old_ordinal: str | None = None) -> DataFrame:
    """Classify by ``(id, md5)``.

    * duplicate ids in ``old``: the last by ``old_ordinal`` wins; without an
      ordinal a deterministic one (the largest digest) -- either way ``old``
      is one row per id, and that aggregation's partitioning on ``id`` is
      reused by the join;
    * every row of ``new`` is classified, so a duplicated new id can appear
      in two statuses;
    * ``deleted`` = old ids absent from new.

    Every row that is shuffled holds a digest, also for the deleted ids: the
    bytes by which AQE puts shuffled partitions together then tell how many
    rows a task gets.  Ids alone may compress to a few bytes each, and a task
    would get tens of millions of them to sort.
    """
    o = old.select(F.col(id_col).alias("id"), F.col(hash_col).alias("old_md5"),
                   *([F.col(old_ordinal).alias("_ord")] if old_ordinal else []))
    if old_ordinal:
        o = o.groupBy("id").agg(F.max_by("old_md5", "_ord").alias("old_md5"))
    else:
        o = o.groupBy("id").agg(F.max("old_md5").alias("old_md5"))
    n = new.select(F.col(id_col).alias("id"), F.col(hash_col).alias("new_md5"))
    # new LEFT JOIN old: AQE can split a skewed new-side id (not possible for
    # a full outer join), the old side is one row per id.
    classified = n.join(o, "id", "left").select(
        "id",
        F.when(F.col("old_md5").isNull(), F.lit(ADDED))
        .when(F.col("old_md5") == F.col("new_md5"), F.lit(UNCHANGED))
        .otherwise(F.lit(CHANGED)).alias("status"))
    new_ids = n.groupBy(F.col("id").alias("_nid")).agg(F.max("new_md5").alias("_any"))  # map-side combine of duplicates
    # true of any two digests; it keeps them in the rows that are shuffled
    held = F.coalesce(F.greatest("old_md5", "_any").cast("string"), F.lit("")) >= ""
    deleted = o.join(new_ids, (F.col("id") == F.col("_nid")) & held, "left_anti").select("id", F.lit(DELETED).alias("status"))
    return classified.unionByName(deleted)


def diff_summary(diff: DataFrame) -> DataFrame:
    """Number of ids per status (A3 as a summary)."""
    return diff.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def status_bytes(diff: DataFrame) -> dict[str, int]:
    """Payload of the ids of each status (repeated ids counted each time): a
    bound for every id set that the gates below weigh, in one aggregate."""
    rows = diff.groupBy("status").agg(F.sum(F.coalesce(
        F.octet_length(F.col("id").cast("string")), F.lit(0)).cast("long") + F.lit(16)).alias("b")).collect()  # a row a status
    return {r["status"]: int(r["b"]) for r in rows}


def ids_with_status(diff: DataFrame, statuses: Iterable[str]) -> DataFrame:
    """Distinct ids whose status is in ``statuses`` (e.g. added | changed)."""
    return diff.where(F.col("status").isin(list(statuses))).select("id").distinct()


def extract_by_status(entries: DataFrame, diff: DataFrame, statuses: Iterable[str],
                      entry_id: str = "id", exclude: Iterable[str] = ()) -> DataFrame:
    """Rows of ``entries`` whose id has one of ``statuses`` (left semi-join);
    ids that also have a status in ``exclude`` are dropped (strict mode).
    Merge joins by hint: the ids of a written diff are many times the size of
    its files, by which Spark would choose to broadcast them."""
    ids = ids_with_status(diff, statuses).hint("merge")
    out = entries.join(ids, entries[entry_id] == ids["id"], "left_semi")
    exclude = list(exclude)
    if exclude:
        ex = ids_with_status(diff, exclude).hint("merge")
        out = out.join(ex, out[entry_id] == ex["id"], "left_anti")
    return out


def _all_in_diff(df: DataFrame, id_col: str, diff: DataFrame) -> bool:
    """Whether every non-null id of ``df`` is classified by ``diff`` (a join
    of the id columns alone)."""
    ids = df.select(F.col(id_col).alias("id")).where("id is not null").distinct()
    return ids.join(diff.select("id").distinct().hint("merge"), "id", "left_anti").isEmpty()


#: Where a landed row lies: its file's name and its number there.
FILE, ROW = "_file", "_row"
# Fixed value: rows that one bitmap of Spark's bitmap functions covers.
BITMAP_ROWS = 32_768


def with_place(landed: DataFrame) -> DataFrame:
    """A scan of a Parquet stage table with ``FILE`` and ``ROW``."""
    return landed.withColumns({FILE: F.col("_metadata.file_name"), ROW: F.col("_metadata.row_index")})


def _place_bitmaps(places: DataFrame, ids: DataFrame) -> DataFrame:
    """(_bf, _bb, bits): the rows of ``places`` (id, FILE, ROW) whose id is in
    ``ids``, as one bit a row.  Narrow tables are joined."""
    at = places.join(ids.hint("merge"), "id", "left_semi").select(
        F.col(FILE).alias("_bf"), F.floor(F.col(ROW) / BITMAP_ROWS).alias("_bb"), F.expr(f"{ROW} % {BITMAP_ROWS}").alias("_bit"))
    return at.groupBy("_bf", "_bb").agg(F.bitmap_construct_agg("_bit").alias("bits"))


def _at_places(entries: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """The entries whose bit is set; the bitmaps are broadcast."""
    b = F.broadcast(bitmaps)
    held = entries.join(b, (entries[FILE] == b["_bf"]) & (F.floor(entries[ROW] / BITMAP_ROWS) == b["_bb"]))
    bit = F.col(ROW) % BITMAP_ROWS
    byte = F.conv(F.hex(F.substring("bits", F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return held.where(F.getbit(byte, (bit % 8).cast("int")) == 1).select(*[entries[c] for c in entries.columns])


def extract_added_or_changed(entries: DataFrame, diff: DataFrame, entry_id: str = "id",
                             diff_covers_entries: bool = False,
                             max_bytes: int = BROADCAST_MAX_BYTES,
                             sizes: dict[str, int] | None = None,
                             places: DataFrame | None = None, covered: bool = False) -> DataFrame:
    """Rows of ``entries`` whose id was added or changed.  A row with a null
    id, or with an id the diff does not know, is never among them.

    With ``diff_covers_entries=True`` (the diff was computed from these
    entries) the wide entries are filtered map-side against whichever id set
    measures small enough to broadcast: the added/changed ids (steady state:
    few records move) with a semi-join, else -- once the id columns prove
    that the diff knows every entry, or the caller knows it (``covered``) -- the ids that are *only* unchanged with
    an anti-join (an initial load, where everything is added).  Where neither
    is small but the entries carry ``FILE`` and ``ROW`` and ``places`` tells
    them by id (id, FILE, ROW), the rows to keep are sent as bitmaps, one bit
    a landed row instead of an id: 64 MB tell 500 million rows.  Beyond that,
    the shuffled semi-join.  All give the same rows."""
    if diff_covers_entries:
        sizes = sizes or status_bytes(diff)
        moving = ids_with_status(diff, (ADDED, CHANGED))
        if sizes.get(ADDED, 0) + sizes.get(CHANGED, 0) <= max_bytes:
            return entries.join(F.broadcast(moving), entries[entry_id] == moving["id"], "left_semi")
        still = (diff.groupBy("id").agg(F.max(F.col("status").isin(ADDED, CHANGED)).alias("_m"))
                 .where(~F.col("_m")).select("id"))
        if sizes.get(UNCHANGED, 0) <= max_bytes and (covered or _all_in_diff(entries, entry_id, diff)):
            return entries.where(F.col(entry_id).isNotNull()).join(
                F.broadcast(still), entries[entry_id] == still["id"], "left_anti")
        if places is not None:
            bitmaps = cut_lineage(_place_bitmaps(places, moving), "moved-rows")
            if payload_bytes(bitmaps, bitmaps.columns) <= max_bytes:
                return _at_places(entries, bitmaps)
    return extract_by_status(entries, diff, (ADDED, CHANGED), entry_id)


def moved_ids(diff: DataFrame) -> DataFrame:
    """Ids of the diff with no ``unchanged`` status (added, changed, deleted).
    A narrow aggregate; usually a small fraction of a snapshot."""
    return (diff.groupBy("id").agg(F.max(F.col("status") == F.lit(UNCHANGED)).alias("_u"))
            .where(~F.col("_u")).select("id"))


def extract_unchanged(previous: DataFrame, diff: DataFrame, entry_id: str = "id",
                      strict: bool = False, previous_matches_diff: bool = False,
                      max_bytes: int = BROADCAST_MAX_BYTES,
                      sizes: dict[str, int] | None = None) -> DataFrame:
    """Rows of the previous snapshot whose id is unchanged.  A row with a
    null id, or with an id the diff does not know, is never among them.

    With ``previous_matches_diff=True`` (the previous snapshot was published
    with the previous fingerprints) and the diff knowing every one of its
    ids, which the id columns prove, this is the previous snapshot minus the
    *moved* ids; when the moved set measures small it is broadcast, so the
    wide snapshot is filtered map-side instead of being shuffled.  Otherwise
    it is the semi-join with the unchanged ids; both give the same rows."""
    if previous_matches_diff and not strict:
        sizes = sizes or status_bytes(diff)
        moved = moved_ids(diff)
        bound = sum(b for status, b in sizes.items() if status != UNCHANGED)
        if bound <= max_bytes and _all_in_diff(previous, entry_id, diff):
            return previous.where(F.col(entry_id).isNotNull()).join(
                F.broadcast(moved), previous[entry_id] == moved["id"], "left_anti")
    return extract_by_status(previous, diff, (UNCHANGED,), entry_id,
                             exclude=(ADDED, CHANGED) if strict else ())


def deleted_ids(old_ids: DataFrame, new_ids: DataFrame, id_col: str = "id") -> DataFrame:
    """Old ids minus new ids, distinct."""
    return (old_ids.select(id_col).distinct()
            .join(new_ids.select(id_col).distinct(), id_col, "left_anti"))
