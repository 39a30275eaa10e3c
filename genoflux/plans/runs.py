"""File-level runs of the two jobs (what the command line of a
scheduled batch does): read the landed inputs, run the job, publish a version.

* ``run_full_rebuild``: metadata TSV + QC TSV + raw, aligned and per-gene
  FASTA files + the alignment template -> published snapshot (data + lineages).
* ``run_prepare``: feed NDJSON + location rules + the latest published
  version -> stage folder with the entries to re-process as FASTA (the
  external aligner's input), their entry table, fingerprints and the diff.
* ``run_finish``: that stage folder + the aligner's QC TSV, aligned FASTA
  and per-gene FASTA -> next published version (files of the previous version
  that hold unchanged rows are carried over, dataset version recorded on new
  rows).

Each run keeps its stage tables in one folder of the shared checkpoint
folder and removes it once its result is committed.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..operators.diff import FILE, ROW
from ..operators.sets import union_distinct
from ..session import land, remove_folder, stage_run
from ..sources import archive as A
from ..sources import readers as R
from ..sources import writers as W
from .clean import FEED, OPEN, CleanSpec, with_template
from .enrich import lineages
from .jobs import enriched_rows, full_rebuild, prepare


def run_full_rebuild(spark: SparkSession, metadata_tsv: str, qc_tsv: str, sequences_fasta: str,
                     aligned_fasta: str, gene_fastas: Mapping[str, str], archive_root: str,
                     version: str | None = None, spec: CleanSpec = OPEN,
                     template_json: str | None = None, fmt: str = "parquet",
                     compression: str | None = None) -> str:
    """Full rebuild from files; returns the published version (NDJSON with
    ``fmt='json'`` and a text codec, else Parquet).  With the
    alignment template, a missing aligned sequence becomes N or X of the
    template's length."""
    with stage_run(spark):
        return _full_rebuild(spark, metadata_tsv, qc_tsv, sequences_fasta, aligned_fasta, gene_fastas, archive_root,
                             version, _templated(spark, spec, template_json), fmt, compression)


def _full_rebuild(spark, metadata_tsv, qc_tsv, sequences_fasta, aligned_fasta, gene_fastas, archive_root,
                  version, spec, fmt, compression) -> str:
    # Each text input is parsed once and landed as Parquet: the key
    # statistics then read one column and the joins read the landed files.
    metadata = land(R.read_tsv_records(spark, metadata_tsv, ordinal="ordinal"))
    qc = land(R.read_tsv_records(spark, qc_tsv, ordinal="ordinal"))
    seqs = land(R.read_fasta(spark, sequences_fasta, ordinal="ordinal"))
    aligned = land(R.read_fasta(spark, aligned_fasta, ordinal="ordinal"))
    genes = land(R.read_translations(spark, gene_fastas))
    published, _ = full_rebuild(metadata, qc, seqs, aligned, genes, list(gene_fastas), spec)
    return A.publish_snapshot(spark, archive_root, published, lineages=lineages_of, version=version,
                              fmt=fmt, compression=compression)


def _templated(spark: SparkSession, spec: CleanSpec, path: str | None) -> CleanSpec:
    return spec if path is None else with_template(spec, *R.template_names(R.read_template(spark, path)))


def run_prepare(spark: SparkSession, feed_path: str, rules_path: str | None, archive_root: str,
                stage_dir: str, id_col: str = "gisaidEpiIsl") -> dict:
    """First half of an incremental refresh.  Writes under ``stage_dir``:
    ``hashes``, ``diff``, ``changed`` and ``aligner_input`` (FASTA of the
    added/changed records' sequences, in feed order within an id).  Returns counts per
    diff status."""
    with stage_run(spark):
        feed = R.read_ndjson(spark, feed_path, R.FEED_SCHEMA, ordinal="ordinal")
        rules = R.read_geo_rules(spark, rules_path) if rules_path else None
        prev = A.latest_version(spark, archive_root)
        if prev is None:
            previous_hashes = spark.createDataFrame([], f"`{id_col}` string, md5 string")
        else:
            previous_hashes = R.read_snapshot(spark, archive_root, prev, "hashes")
        stage = stage_dir.rstrip("/")
        p = prepare(feed, rules, previous_hashes, id_col, stage_root=stage)
        W.write_fasta(p.changed, f"{stage}/aligner_input", id_col, F.col("unaligned_nuc")["main"])
        spark.createDataFrame([(prev or "",)], "previous string").write.parquet(f"{stage}/previous")
        counts = p.diff.groupBy("status").count().collect()
        return {r["status"]: r["count"] for r in counts}


def run_finish(spark: SparkSession, stage_dir: str, qc_tsv: str, aligned_fasta: str,
               gene_fastas: Mapping[str, str], archive_root: str, dataset_version: str,
               version: str | None = None, id_col: str = "gisaidEpiIsl",
               spec: CleanSpec = FEED, template_json: str | None = None,
               fmt: str = "parquet", compression: str | None = None, remove_stage: bool = False) -> str:
    """Second half: enrich the re-processed records with the aligner output
    and publish them with the unchanged rows of the previous version, whose
    files are carried over (``archive.publish_refresh``; the format is that
    of the first version).  With the alignment template, a missing aligned
    sequence becomes N or X of the template's length.  ``remove_stage``
    removes ``stage_dir`` once the version is committed."""
    stage = stage_dir.rstrip("/")
    with stage_run(spark):
        spec = _templated(spark, spec, template_json)
        changed = spark.read.parquet(f"{stage}/changed")
        diff = spark.read.parquet(f"{stage}/diff")
        hashes = spark.read.parquet(f"{stage}/hashes").drop(FILE, ROW)
        prev = spark.read.parquet(f"{stage}/previous").first()["previous"] or None
        qc = land(R.read_tsv_records(spark, qc_tsv, ordinal="ordinal"))
        aligned = land(R.read_fasta(spark, aligned_fasta, ordinal="ordinal"))
        genes = land(R.read_translations(spark, gene_fastas))
        _, new_rows = enriched_rows(changed, qc, aligned, genes, list(gene_fastas), dataset_version, spec)
        if prev is None:
            v = A.publish_snapshot(spark, archive_root, new_rows, lineages=lineages_of, hashes=hashes,
                                   version=version, fmt=fmt, compression=compression, id_col=id_col)
        else:
            previous_lineages = R.read_snapshot(spark, archive_root, prev, "lineages").select("value")

            # the previous list has those of the rows that are carried over
            def merged_lineages(written):
                return union_distinct([previous_lineages, lineages_of(written)])
            v = A.publish_refresh(spark, archive_root, prev, diff, new_rows, lineages=merged_lineages,
                                  hashes=hashes, version=version, compression=compression)
    if remove_stage:
        remove_folder(spark, stage)
    return v


def lineages_of(published):
    """Distinct lineage names of published rows (two columns read)."""
    return lineages(published)
