"""User-level jobs: full rebuild and the two halves of an incremental
refresh (``prepare`` before the external aligner, ``finish`` after it).

Every job is a lazy DataFrame plan; writing is left to the caller (see
``sources.writers.publish_snapshot``).  Narrow ``(id, md5)`` tables carry the
diff; wide sequence columns only meet a shuffle in the final semi-joins.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import row_md5
from ..operators.diff import DELETED, FILE, ROW, extract_added_or_changed, extract_unchanged, snapshot_diff, with_place
from ..operators.frames import SEQUENCE_COLS, empty_map, flatten_publish, map_to_null, project_feed
from ..operators.georules import map_locations
from ..operators.sets import sort_output, union_all, union_distinct
from .clean import FEED, FEED_NULL_MARKERS, OPEN, CleanSpec
from .enrich import enrich_entries, enrich_open, lineages
from ..session import BROADCAST_MAX_BYTES, cut_lineage
from ..session import land as land_table


ORDINAL = "ordinal"


def normalise_feed(feed: DataFrame, rules: DataFrame | None, framing: str = "plain",
                   land: bool = False) -> DataFrame:
    """Feed -> entry frame with location rules applied and an ``md5``
    fingerprint of the whole entry (taken after location mapping, so changed
    rules re-process the affected records).  A column ``ordinal`` (the feed's
    row order) is carried beside the fingerprint, not inside it.

    ``land=True`` writes the projected entries once as a Parquet stage table
    before the location pass: the distinct-location job then reads four
    columns of it and the final pass reads it instead of parsing the feed
    text a second time.  The entries then carry the place of their landed row
    (``operators.diff.FILE``, ``ROW``)."""
    e = project_feed(feed, ordinal=ORDINAL)
    e = map_to_null(e, FEED_NULL_MARKERS)
    if land:
        # the maps that are empty until the aligner has run are not written
        full, empty = e.columns, [c for c in SEQUENCE_COLS if c != "unaligned_nuc"]
        kinds = dict(e.dtypes)
        landed = with_place(land_table(e.drop(*empty), "feed-landed"))
        e = landed.withColumns({c: empty_map(kinds[c]) for c in empty}).select(*full, FILE, ROW)
    if rules is not None:
        e = map_locations(e, rules)
    return e.withColumn("md5", row_md5(e, [c for c in e.columns if c not in (ORDINAL, FILE, ROW)], framing))


def hash_table(entries: DataFrame, id_col: str = "gisaidEpiIsl") -> DataFrame:
    """Side output ``(gisaidEpiIsl, md5)``, with the feed's ``ordinal`` and
    the places of landed rows where they are known.  A record without an id fails the job: it could never be
    matched with its next version."""
    ident = F.when(F.col(id_col).isNull(), F.raise_error(F.lit(
        f"a feed record has no {id_col}")).cast("string")).otherwise(F.col(id_col))
    return entries.select(ident.alias(id_col), F.col("md5"),
                          *[F.col(c) for c in (ORDINAL, FILE, ROW) if c in entries.columns])


@dataclass
class Prepared:
    entries: DataFrame
    hashes: DataFrame
    diff: DataFrame
    changed: DataFrame


def prepare(feed: DataFrame, rules: DataFrame | None, previous_hashes: DataFrame,
            id_col: str = "gisaidEpiIsl", sort_changed: bool = False,
            old_ordinal: str | None = None, stage: bool = True,
            stage_root: str | None = None, max_bytes: int = BROADCAST_MAX_BYTES) -> Prepared:
    """Normalise + fingerprint the feed, diff against the previous hashes and
    extract the added/changed entries.  ``sort_changed`` orders them by id
    (a global sort of wide rows, only worth it when a consumer needs sorted
    files; Spark's own joins do not), records of one id in feed order.

    A feed read with an ``ordinal`` column keeps it in the hashes, where it
    lets the last of duplicate ids win in the next diff, and in ``changed``,
    where it pairs duplicates with the aligner's rows.

    With ``stage=True`` the wide rows are written twice: once as they are
    landed, and the added/changed ones once more, normalised.  The narrow
    (id, ordinal, md5, place) table and the diff are stage tables of their own; all
    lie in the shared checkpoint folder, so a lost executor re-reads files
    instead of recomputing the feed.  With ``stage_root`` the narrow tables
    and ``changed`` are kept there (``hashes``, ``diff``, ``changed``)."""
    def at(name):
        return f"{stage_root.rstrip('/')}/{name}" if stage_root else None
    entries = normalise_feed(feed, rules, land=stage)
    hashes = hash_table(entries, id_col)
    if stage:
        hashes = cut_lineage(hashes, "hashes", path=at("hashes"))
    diff = _diff(previous_hashes, hashes, id_col,
                 old_ordinal or (ORDINAL if ORDINAL in previous_hashes.columns else None))
    if stage:
        diff = cut_lineage(diff, "diff", path=at("diff"))
    places = hashes.select(F.col(id_col).alias("id"), FILE, ROW) if stage else None
    hashes = hashes.drop(FILE, ROW)
    # The diff was written from the hashes, a row for each of theirs, and they
    # from the landed rows: with as many rows it knows every entry's id.
    covered = stage and hashes.count() == diff.where(F.col("status") != DELETED).count()
    changed = extract_added_or_changed(entries.drop("md5"), diff, id_col, diff_covers_entries=True,
                                       places=places, max_bytes=max_bytes, covered=covered).drop(FILE, ROW)
    if sort_changed:
        changed = sort_output(changed, id_col, [ORDINAL] if ORDINAL in changed.columns else [])
    if stage:
        changed = cut_lineage(changed, "changed", path=at("changed"))
    return Prepared(entries.drop("md5", FILE, ROW), hashes, diff, changed)


def _diff(previous: DataFrame, hashes: DataFrame, id_col: str, old_ordinal: str | None) -> DataFrame:
    old = previous.withColumnRenamed(id_col, "id") if id_col in previous.columns else previous
    new = hashes.withColumnRenamed(id_col, "id").select("id", "md5")
    return snapshot_diff(old, new, "id", "md5", old_ordinal=old_ordinal)


def enriched_rows(changed: DataFrame, qc: DataFrame, aligned: DataFrame, translations: DataFrame,
                  genes: Sequence[str], dataset_version: str, spec: CleanSpec = FEED,
                  aligned_aa: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """The re-processed entries enriched by the aligner's output, and as
    published rows."""
    enriched = enrich_entries(changed, qc, aligned, translations, genes, dataset_version, spec)
    return enriched, flatten_publish(enriched, aligned_aa=list(aligned_aa if aligned_aa is not None else genes))


def finish(changed: DataFrame, qc: DataFrame, aligned: DataFrame, translations: DataFrame,
           genes: Sequence[str], previous_published: DataFrame, diff: DataFrame,
           previous_lineages: DataFrame | None, dataset_version: str,
           id_col: str = "gisaidEpiIsl", spec: CleanSpec = FEED,
           aligned_aa: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Enrich the re-processed entries, publish-flatten them, and merge with
    the unchanged rows of the previous published snapshot.  Returns
    ``(published, lineages)``.  (An archive is refreshed by
    ``archive.publish_refresh``, which does not move the unchanged rows.)"""
    enriched, new_rows = enriched_rows(changed, qc, aligned, translations, genes, dataset_version, spec, aligned_aa)
    # The previous published snapshot and the previous fingerprints were
    # written together, so the moved-id anti-join applies.
    unchanged = extract_unchanged(previous_published, diff, id_col, previous_matches_diff=True)
    published = union_all([unchanged, new_rows])
    lin = lineages(enriched)
    if previous_lineages is not None:
        lin = union_distinct([previous_lineages.select("value"), lin])
    return published, lin


def full_rebuild(metadata: DataFrame, qc: DataFrame, sequences: DataFrame, aligned: DataFrame,
                 translations: DataFrame, genes: Sequence[str], spec: CleanSpec = OPEN
                 ) -> tuple[DataFrame, DataFrame]:
    """All inputs joined by strain, cleaned, flattened.  Returns
    ``(published, lineages)``."""
    entries = enrich_open(metadata, qc, sequences, aligned, translations, genes, spec)
    return flatten_publish(entries, aligned_aa=list(genes)), lineages(entries)
