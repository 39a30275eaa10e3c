"""The record-cleaning chain as one configurable ``DataFrame.transform``.

Order (fixed): edge-gap masking -> ordered rename -> whitelist -> null
markers -> partial dates -> integers -> doubles -> template fill -> lineage
null markers -> column suppression.  Two presets mirror the two job
flavours: ``FEED`` (incremental feed + aligner output) and ``OPEN`` (full
rebuild from metadata/QC tables).
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.parse import parse_double, parse_int, parse_partial_date
from ..functions.sequences import fill_from_template, mask_edge_gaps
from ..operators.frames import (map_lineage_to_null, map_to_null, ordered_rename, q,
                                set_null, whitelist)

# ----------------------------------------------------------- fixed values
# Metadata names kept by both presets, in this order.
SELECTED_METADATA = (
    "strain", "genbankAccession", "genbankAccessionRev", "sraAccession", "gisaidEpiIsl",
    "database", "date", "dateSubmitted", "dateUpdated", "region", "country", "division",
    "location", "regionExposure", "countryExposure", "divisionExposure", "host",
    "hospitalized", "died", "fullyVaccinated", "age", "sex", "samplingStrategy",
    "pangoLineage", "nextcladePangoLineage", "nextstrainClade", "whoClade", "gisaidClade",
    "ace2Binding", "immuneEscape", "originatingLab", "submittingLab", "authors",
    "nextcladeQcOverallScore", "nextcladeQcMissingDataScore", "nextcladeQcMixedSitesScore",
    "nextcladeQcPrivateMutationsScore", "nextcladeQcSnpClustersScore",
    "nextcladeQcFrameShiftsScore", "nextcladeQcStopCodonsScore", "nextcladeCoverage",
)

# Renames applied after the aligner QC columns were overlaid (feed flavour).
FEED_RENAMES = (
    ("clade_nextstrain", "nextstrainClade"),
    ("clade_who", "whoClade"),
    ("Nextclade_pango", "nextcladePangoLineage"),
    ("qc.overallScore", "nextcladeQcOverallScore"),
    ("qc.missingData.score", "nextcladeQcMissingDataScore"),
    ("qc.mixedSites.score", "nextcladeQcMixedSitesScore"),
    ("qc.privateMutations.score", "nextcladeQcPrivateMutationsScore"),
    ("qc.snpClusters.score", "nextcladeQcSnpClustersScore"),
    ("qc.frameShifts.score", "nextcladeQcFrameShiftsScore"),
    ("qc.stopCodons.score", "nextcladeQcStopCodonsScore"),
    ("coverage", "nextcladeCoverage"),
)

# Renames for the open metadata table + QC (full-rebuild flavour).  Note the
# two sources of nextstrainClade: the later pair always wins.
OPEN_RENAMES = (
    ("gisaid_epi_isl", "gisaidEpiIsl"),
    ("genbank_accession", "genbankAccession"),
    ("genbank_accession_rev", "genbankAccessionRev"),
    ("sra_accession", "sraAccession"),
    ("region_exposure", "regionExposure"),
    ("country_exposure", "countryExposure"),
    ("division_exposure", "divisionExposure"),
    ("Nextstrain_clade", "nextstrainClade"),
    ("pango_lineage", "pangoLineage"),
    ("GISAID_clade", "gisaidClade"),
    ("originating_lab", "originatingLab"),
    ("submitting_lab", "submittingLab"),
    ("date_submitted", "dateSubmitted"),
    ("date_updated", "dateUpdated"),
    ("sampling_strategy", "samplingStrategy"),
    ("clade_nextstrain", "nextstrainClade"),
    ("clade_who", "whoClade"),
    ("Nextclade_pango", "nextcladePangoLineage"),
    ("immune_escape", "immuneEscape"),
    ("ace2_binding", "ace2Binding"),
    ("QC_overall_score", "nextcladeQcOverallScore"),
    ("qc.missingData.score", "nextcladeQcMissingDataScore"),
    ("qc.mixedSites.score", "nextcladeQcMixedSitesScore"),
    ("qc.privateMutations.score", "nextcladeQcPrivateMutationsScore"),
    ("qc.snpClusters.score", "nextcladeQcSnpClustersScore"),
    ("qc.frameShifts.score", "nextcladeQcFrameShiftsScore"),
    ("qc.stopCodons.score", "nextcladeQcStopCodonsScore"),
    ("coverage", "nextcladeCoverage"),
)

DATE_FIELDS = ("date", "dateSubmitted", "dateUpdated")
INT_FIELDS = ("age",)
FLOAT_FIELDS = (
    "ace2Binding", "immuneEscape", "nextcladeQcOverallScore", "nextcladeQcMissingDataScore",
    "nextcladeQcMixedSitesScore", "nextcladeQcPrivateMutationsScore",
    "nextcladeQcSnpClustersScore", "nextcladeQcFrameShiftsScore",
    "nextcladeQcStopCodonsScore", "nextcladeCoverage",
)
LINEAGE_FIELDS = ("pangoLineage", "nextcladePangoLineage")
NULL_MARKERS = ("", "?")
FEED_NULL_MARKERS = ("", "unknown")

FEED_SUPPRESSED = (
    "genbankAccession", "sraAccession", "regionExposure", "countryExposure",
    "divisionExposure", "gisaidClade", "ace2Binding", "immuneEscape", "originatingLab",
    "submittingLab", "authors", "dateUpdated", "died", "fullyVaccinated", "hospitalized",
)
OPEN_SUPPRESSED = ("died", "fullyVaccinated", "hospitalized", "nextcladeDatasetVersion")

# Masking: map column -> {name: (fill, leading, trailing)}.
DEFAULT_MASKS = {
    "aligned_nuc": {"main": ("N", True, True)},
    "aligned_aa": {"ORF1a": ("X", True, False)},
}
# ------------------------------------------------------- end fixed values


@dataclass(frozen=True)
class CleanSpec:
    renames: tuple = ()
    selected: tuple = SELECTED_METADATA
    null_markers: tuple = NULL_MARKERS
    date_fields: tuple = DATE_FIELDS
    int_fields: tuple = INT_FIELDS
    int_lenient: bool = False
    float_fields: tuple = FLOAT_FIELDS
    float_lenient: bool = False
    lineage_fields: tuple = LINEAGE_FIELDS
    suppressed: tuple = ()
    masks: Mapping = field(default_factory=lambda: DEFAULT_MASKS)
    # template: map column -> {name: length}; names whose sequence is missing
    # get fill x length ("N" for nucleotides, "X" for amino acids).
    template_nuc: Mapping | None = None
    template_aa: Mapping | None = None


FEED = CleanSpec(renames=FEED_RENAMES, int_lenient=True, suppressed=FEED_SUPPRESSED)
OPEN = CleanSpec(renames=OPEN_RENAMES, int_lenient=False, suppressed=OPEN_SUPPRESSED)


def with_template(spec: CleanSpec, nuc: Mapping[str, int], aa: Mapping[str, int]) -> CleanSpec:
    """``spec`` that fills missing aligned sequences with N or X of the
    template's lengths."""
    return replace(spec, template_nuc=dict(nuc), template_aa=dict(aa))


def _masker(spec: Mapping):
    def tv(k, v):
        expr = v
        for name, (fill, lead, trail) in spec.items():
            expr = F.when(k == F.lit(name), mask_edge_gaps(v, fill, lead, trail)).otherwise(expr)
        return expr
    return tv


def mask_sequences(df: DataFrame, masks: Mapping) -> DataFrame:
    """Edge-gap masking inside the sequence maps; absent names stay absent."""
    out = {}
    for mcol, spec in masks.items():
        if mcol not in df.columns:
            continue

        out[mcol] = F.transform_values(q(mcol), _masker(spec))
    return df.withColumns(out) if out else df


def parse_fields(df: DataFrame, spec: CleanSpec) -> DataFrame:
    cols: dict = {}
    for f in spec.date_fields:
        for suffix, c in parse_partial_date(q(f)).items():
            cols[f + suffix] = c
    for f in spec.int_fields:
        cols[f] = parse_int(q(f), ignore_errors=spec.int_lenient)
    for f in spec.float_fields:
        cols[f] = parse_double(q(f), ignore_errors=spec.float_lenient)
    return df.withColumns(cols)


def clean(df: DataFrame, spec: CleanSpec) -> DataFrame:
    """Entry frame -> cleaned entry frame (see module docstring for order)."""
    out = mask_sequences(df, spec.masks)
    out = ordered_rename(out, spec.renames)
    out = whitelist(out, spec.selected)
    out = map_to_null(out, spec.null_markers)
    out = parse_fields(out, spec)
    fills = {}
    if spec.template_nuc:
        fills["aligned_nuc"] = fill_from_template(q("aligned_nuc"), spec.template_nuc, "N")
    if spec.template_aa:
        fills["aligned_aa"] = fill_from_template(q("aligned_aa"), spec.template_aa, "X")
    if fills:
        out = out.withColumns(fills)
    out = map_lineage_to_null(out, spec.lineage_fields)
    types = dict(out.dtypes)
    return set_null(out, {c: types.get(c, "string") for c in spec.suppressed})
