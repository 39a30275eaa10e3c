"""Enrichment joins: entries (or metadata rows) + aligner QC + aligned
sequences + per-gene translations, matched positionally on the sample key.

All inputs are numbered within their key (``rn``) and joined on
``(key, rn)``; only positions present in the first input are kept.  The
per-gene translations arrive as one long table ``(key, gene, sequence)`` and
cost one grouped shuffle instead of one join per gene.  The join chain shares
the ``(key, rn)`` hash partitioning, so only the inputs are shuffled.  The
joins are merge joins by hint: the inputs are as large as the first one, but as
stage tables they compress so well that Spark, which goes by the size of the
files, would broadcast millions of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.sequences import insertion_list, insertions_by_gene
from ..operators.frames import SEQUENCE_COLS, copy_column, override_when, q
from ..operators.sets import distinct_values
from ..operators.zipjoin import (content_ordinal, fallback_key, hot_limit, key_row_number,
                                 key_stats, zip_names)
from .clean import FEED, LINEAGE_FIELDS, OPEN, CleanSpec, clean

KEY, RN = "_key", "_rn"
QC_PREFIX, GENE_PREFIX = "qc::", "gene::"


def _keyed(df: DataFrame, primary: str, alternative: str, ordinal: str) -> DataFrame:
    if ordinal not in df.columns:
        # No file order recorded: a content hash is a deterministic tiebreak
        # (rows with equal hashes are identical in practice).
        df = content_ordinal(df, ordinal)
    return fallback_key(df, primary, alternative, KEY)


def _assemble(joined: DataFrame, base_cols: list[str], qc_cols: list[str], genes: Sequence[str],
              unaligned_col: str | None) -> DataFrame:
    present = F.col("_qc_present").isNotNull()
    meta = {}
    for c in base_cols:
        if c in SEQUENCE_COLS or c == "id":
            continue
        meta[c] = q(c)
    for c in qc_cols:
        meta[c] = F.when(present, q(QC_PREFIX + c)).otherwise(meta[c]) if c in meta else \
            q(QC_PREFIX + c)
    ins = q(QC_PREFIX + "insertions") if "insertions" in qc_cols else F.lit(None).cast("string")
    aa_ins = q(QC_PREFIX + "aaInsertions") if "aaInsertions" in qc_cols else F.lit(None).cast("string")
    aa_pairs = []
    for g in genes:
        aa_pairs += [F.lit(g), q(GENE_PREFIX + g)]
    maps = {
        "aligned_nuc": F.create_map(F.lit("main"), F.col("_aligned")),
        "aligned_aa": F.create_map(*aa_pairs) if aa_pairs else F.create_map().cast("map<string,string>"),
        "nuc_insertions": F.create_map(F.lit("main"), insertion_list(ins)),
        "aa_insertions": insertions_by_gene(aa_ins, genes),
    }
    if unaligned_col is not None:
        maps["unaligned_nuc"] = F.create_map(F.lit("main"), F.col(unaligned_col))
    elif "unaligned_nuc" in base_cols:
        maps["unaligned_nuc"] = q("unaligned_nuc")
    else:
        maps["unaligned_nuc"] = F.create_map().cast("map<string,string>")
    head = [q("id")] if "id" in base_cols else []
    return joined.select(*head, *[e.alias(n) for n, e in meta.items()],
                         *[maps[c].alias(c) for c in SEQUENCE_COLS])


def _join_inputs(base: DataFrame, base_key: str, qc: DataFrame, aligned: DataFrame,
                 translations: DataFrame, sequences: DataFrame | None, ordinal: str,
                 hot_rows: int | None, genes: Sequence[str]) -> tuple[DataFrame, list[str]]:
    qc_cols = [c for c in qc.columns if c != ordinal]
    inputs = [(_keyed(base, base_key, "seqName", ordinal), [KEY]),
              (_keyed(qc, base_key, "seqName", ordinal), [KEY]),
              (_keyed(aligned, "sample_name", "seqName", ordinal), [KEY])]
    if sequences is not None:
        inputs.append((_keyed(sequences, "sample_name", "seqName", ordinal), [KEY]))
    inputs.append((_keyed(translations, "sample_name", "seqName", ordinal), [KEY, "gene"]))
    limit = hot_limit(base, hot_rows)
    stats = key_stats(inputs, limit)  # one job for every input's key statistics
    for given, st in zip((base, qc, aligned, *([] if sequences is None else [sequences]), translations),
                         stats):
        if (st["mx"] or 0) > 1 and ordinal not in given.columns:
            raise ValueError(f"an input repeats a key and has no column {ordinal!r} that orders its rows")

    def number(i):
        return key_row_number(inputs[i][0], KEY, ordinal, RN, limit, stats[i])

    b = number(0)
    qn = number(1).select(KEY, RN, F.lit(True).alias("_qc_present"),
                          *[q(c).alias(QC_PREFIX + c) for c in qc_cols])
    an = number(2).select(KEY, RN, F.col("sequence").alias("_aligned"))
    out = b.join(qn.hint("merge"), [KEY, RN], "left").join(an.hint("merge"), [KEY, RN], "left")
    if sequences is not None:
        sn = number(3).select(KEY, RN, F.col("sequence").alias("_unaligned"))
        out = out.join(sn.hint("merge"), [KEY, RN], "left")
    gn = zip_names(inputs[-1][0], KEY, "gene", "sequence", ordinal, {g: GENE_PREFIX + g for g in genes}, RN,
                   limit, stats[-1])
    out = out.join(gn.hint("merge"), [KEY, RN], "left")
    return out, qc_cols


def enrich_entries(entries: DataFrame, qc: DataFrame, aligned: DataFrame,
                   translations: DataFrame, genes: Sequence[str], dataset_version: str | None,
                   spec: CleanSpec = FEED, ordinal: str = "ordinal",
                   hot_rows: int | None = None) -> DataFrame:
    """Feed flavour: normalised entries (key ``id``) + aligner output ->
    cleaned entries carrying ``nextcladeDatasetVersion``."""
    base_cols = [c for c in entries.columns if c != ordinal]
    joined, qc_cols = _join_inputs(entries, "id", qc, aligned, translations, None,
                                   ordinal, hot_rows, genes)
    out = clean(_assemble(joined, base_cols, qc_cols, genes, None), spec)
    return out.withColumn("nextcladeDatasetVersion", F.lit(dataset_version).cast("string"))


def enrich_open(metadata: DataFrame, qc: DataFrame, sequences: DataFrame, aligned: DataFrame,
                translations: DataFrame, genes: Sequence[str], spec: CleanSpec = OPEN,
                ordinal: str = "ordinal", hot_rows: int | None = None) -> DataFrame:
    """Full-rebuild flavour: metadata rows (key ``strain``) + QC + raw and
    aligned sequences + translations -> cleaned entries keyed by strain."""
    base_cols = [c for c in metadata.columns if c != ordinal]
    # rows whose strain is a null marker are dropped in the end; they share a
    # few keys, so they go before the joins
    metadata = metadata.where(q("strain").isNull() | ~q("strain").isin(list(spec.null_markers)))
    joined, qc_cols = _join_inputs(metadata, "strain", qc, aligned, translations, sequences,
                                   ordinal, hot_rows, genes)
    assembled = _assemble(joined, base_cols, qc_cols, genes, "_unaligned")
    assembled = assembled.withColumn("id", q("strain")).select("id", *[
        q(c) for c in assembled.columns if c != "id"])
    out = clean(assembled, spec)
    out = copy_column(out, "genbankAccessionRev", "usherTree")
    out = out.where(F.col("strain").isNotNull())
    return override_when(out, F.col("database") == F.lit("rki"), "host", "Homo sapiens")


def lineages(entries: DataFrame, fields: Sequence[str] = LINEAGE_FIELDS) -> DataFrame:
    """Distinct lineage names found in the lineage columns."""
    return distinct_values(entries, [f for f in fields if f in entries.columns])
