"""Whole-frame transforms of entry tables.

An *entry frame* has an ``id`` column, the metadata as flat top-level
columns, and the sequence maps in the columns listed in ``SEQUENCE_COLS``.
(A fixed schema means an absent metadata key and a null one are the same --
a deliberate simplification of the dynamic record map.)  Every transform
compiles to one ``select`` so long chains stay one projection.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.location import GEO_LEVELS, split_location
from ..functions.text import null_if_in

SEQUENCE_COLS = ("unaligned_nuc", "aligned_nuc", "aligned_aa", "nuc_insertions", "aa_insertions")
SEQ_MAP = "map<string,string>"
INS_MAP = "map<string,array<string>>"


def q(name: str) -> Column:
    """Column by exact name (names may contain dots)."""
    return F.col(f"`{name}`")


def metadata_cols(df: DataFrame, reserved: Iterable[str] = ("id", *SEQUENCE_COLS)) -> list[str]:
    reserved = set(reserved)
    return [c for c in df.columns if c not in reserved]


def empty_map(kind: str = SEQ_MAP) -> Column:
    return F.create_map().cast(kind)


# ---------------------------------------------------------------- projection

# Feed field -> metadata name, as the feed stage maps them.
FEED_FIELDS = (
    ("covv_accession_id", "gisaidEpiIsl"),
    ("covv_virus_name", "strain"),
    ("covv_collection_date", "date"),
    ("covv_subm_date", "dateSubmitted"),
    ("covv_host", "host"),
    ("covv_patient_age", "age"),
    ("covv_gender", "sex"),
    ("covv_sampling_strategy", "samplingStrategy"),
    ("covv_lineage", "pangoLineage"),
)


def project_feed(feed: DataFrame, location_col: str = "covv_location",
                 sequence_col: str = "sequence", id_col: str = "covv_accession_id",
                 ordinal: str | None = None) -> DataFrame:
    """Feed rows -> entry frame: renamed fields, the location text split in
    four levels, the sequence as ``unaligned_nuc['main']``, other maps empty;
    ``ordinal``, the feed's row order, is carried along if it is a column."""
    loc = split_location(q(location_col))
    meta = [q(src).cast("string").alias(dst) for src, dst in FEED_FIELDS]
    geo = [c.alias(n) for c, n in zip(loc, GEO_LEVELS)]
    return feed.select(
        q(id_col).cast("string").alias("id"), *meta, *geo,
        F.create_map(F.lit("main"), q(sequence_col).cast("string")).alias("unaligned_nuc"),
        empty_map().alias("aligned_nuc"), empty_map().alias("aligned_aa"),
        empty_map(INS_MAP).alias("nuc_insertions"), empty_map(INS_MAP).alias("aa_insertions"),
        *([q(ordinal)] if ordinal in feed.columns else []))


def ordered_rename(df: DataFrame, pairs: Sequence[tuple[str, str]],
                   reserved: Iterable[str] = ("id", *SEQUENCE_COLS)) -> DataFrame:
    """Apply ``new := old; drop old`` for each pair in order.  A missing
    source makes the target null (overwriting it); with repeated targets the
    last pair wins.  Simulated on the plan, executed as one select."""
    reserved = list(reserved)
    exprs: dict[str, Column] = {c: q(c) for c in metadata_cols(df, reserved)}
    for old, new in pairs:
        src = exprs.pop(old, None)
        exprs[new] = src if src is not None else F.lit(None).cast("string")
    head = [q(c) for c in df.columns if c in reserved]
    return df.select(*head, *[e.alias(n) for n, e in exprs.items()])


def whitelist(df: DataFrame, names: Iterable[str],
              reserved: Iterable[str] = ("id", *SEQUENCE_COLS), types: Mapping[str, str] | None = None
              ) -> DataFrame:
    """Keep only the listed metadata columns (in the listed order); a listed
    name that is absent becomes a typed null column."""
    reserved = list(reserved)
    types = dict(types or {})
    have = set(df.columns)
    head = [q(c) for c in df.columns if c in reserved]
    body = [q(n) if n in have else F.lit(None).cast(types.get(n, "string")).alias(n)
            for n in names]
    return df.select(*head, *body)


def map_to_null(df: DataFrame, values: Iterable[str] = ("", "?"),
                cols: Iterable[str] | None = None) -> DataFrame:
    """Replace the given text markers by null in every (or the listed)
    string metadata column."""
    values = list(values)
    types = dict(df.dtypes)
    targets = set(cols) if cols is not None else {
        c for c in metadata_cols(df) if types[c] == "string"}
    return df.select(*[null_if_in(q(c), values).alias(c) if c in targets else q(c)
                       for c in df.columns])


LINEAGE_NULL_VALUES = ("Unassigned", "unclassifiable")  # fixed values


def map_lineage_to_null(df: DataFrame, cols: Iterable[str],
                        values: Iterable[str] = LINEAGE_NULL_VALUES) -> DataFrame:
    return map_to_null(df, values, cols)


def set_null(df: DataFrame, cols: Mapping[str, str]) -> DataFrame:
    """Column suppression: each listed column becomes a typed constant null
    (added if absent)."""
    return df.withColumns({c: F.lit(None).cast(t) for c, t in cols.items()})


def with_literal(df: DataFrame, name: str, value) -> DataFrame:
    return df.withColumn(name, F.lit(value))


def copy_column(df: DataFrame, src: str, dst: str) -> DataFrame:
    return df.withColumn(dst, q(src) if src in df.columns else F.lit(None).cast("string"))


def override_when(df: DataFrame, cond: Column, target: str, value) -> DataFrame:
    """``target := value`` where ``cond`` holds (e.g. database='rki' implies
    host='Homo sapiens')."""
    return df.withColumn(target, F.when(cond, F.lit(value)).otherwise(q(target)))


def overlay_columns(df: DataFrame, present: Column, pairs: Mapping[str, str]) -> DataFrame:
    """``pairs``: target column -> overlay column.  Target takes the overlay
    value when ``present`` (row presence, not non-nullness); the overlay
    columns are dropped."""
    out = df.withColumns({t: F.when(present, q(o)).otherwise(q(t)) if t in df.columns else
                          F.when(present, q(o)) for t, o in pairs.items()})
    return out.drop(*[o for o in pairs.values() if o not in pairs])


def flatten_publish(df: DataFrame, unaligned: Sequence[str] = ("main",),
                    aligned_nuc: Sequence[str] = ("main",),
                    aligned_aa: Sequence[str] = (),
                    reserved: Iterable[str] = ("id", *SEQUENCE_COLS)) -> DataFrame:
    """Entry -> published row: metadata columns, ``unaligned_<segment>``
    text, and per aligned segment/gene ``struct(sequence, insertions)`` --
    null when the aligned sequence is null; missing insertions -> []."""
    meta = [q(c) for c in metadata_cols(df, reserved)]
    cols = list(meta)
    for seg in unaligned:
        cols.append(F.try_element_at("unaligned_nuc", F.lit(seg)).alias(f"unaligned_{seg}"))

    def cell(seqs: str, ins: str, name: str) -> Column:
        s = F.try_element_at(seqs, F.lit(name))
        i = F.coalesce(F.try_element_at(ins, F.lit(name)), F.array().cast("array<string>"))
        return F.when(s.isNotNull(), F.struct(s.alias("sequence"), i.alias("insertions"))).alias(name)

    cols += [cell("aligned_nuc", "nuc_insertions", n) for n in aligned_nuc]
    cols += [cell("aligned_aa", "aa_insertions", n) for n in aligned_aa]
    return df.select(*cols)
