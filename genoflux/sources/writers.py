"""Sinks: NDJSON (nulls written, map keys sorted), FASTA, line lists,
fingerprint and diff tables, and the ``noop`` pass used as an I/O floor.
Snapshots are published by ``archive``.

Compression follows the sink: Parquet stage tables use ``zstd``; text sinks
take a Hadoop codec name (``gzip``, ``bzip2``; Spark's text sinks have no
``zstd`` codec).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.sequences import canonical_maps


def _canonical_maps(df: DataFrame) -> DataFrame:
    return df.select(*[canonical_maps(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields])


def write_ndjson(df: DataFrame, path: str, compression: str | None = None,
                 mode: str = "errorifexists") -> None:
    """One object per line; null fields written; map keys sorted at any depth."""
    w = _canonical_maps(df).write.mode(mode).option("ignoreNullFields", False)
    if compression:
        w = w.option("compression", compression)
    w.json(path)


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists",
                  partition_by: list[str] | None = None) -> None:
    w = df.write.mode(mode).option("compression", "zstd")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def fasta_text(df: DataFrame, id_col: str, sequence) -> DataFrame:
    """``>id\\nsequence`` records; a null id or sequence fails the job."""
    seq = F.col(sequence) if isinstance(sequence, str) else sequence
    idc = F.col(f"`{id_col}`")
    rec = F.concat(F.lit(">"), idc, F.lit("\n"), seq)
    bad = idc.isNull() | seq.isNull()
    return df.select(F.when(bad, F.raise_error(F.lit("FASTA record without id or sequence"))
                            .cast("string")).otherwise(rec).alias("value"))


def write_fasta(df: DataFrame, path: str, id_col: str, sequence,
                compression: str | None = None, mode: str = "errorifexists") -> None:
    """Entries -> FASTA (one named unaligned sequence per record)."""
    w = fasta_text(df, id_col, sequence).write.mode(mode)
    if compression:
        w = w.option("compression", compression)
    w.text(path)


def write_line_list(df: DataFrame, path: str, col: str = "value", mode: str = "errorifexists") -> None:
    df.select(F.col(col).alias("value")).write.mode(mode).text(path)


def write_hashes(entries: DataFrame, path: str, id_col: str = "gisaidEpiIsl",
                 mode: str = "errorifexists") -> None:
    """Side output ``(id, md5)`` from an entries table carrying ``md5``."""
    write_parquet(entries.select(F.col(id_col), F.col("md5")), path, mode)


def write_diff(diff: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """The long diff table, partitioned by status."""
    write_parquet(diff.select("id", "status"), path, mode, partition_by=["status"])


def noop(df: DataFrame) -> None:
    """Read and discard: the I/O + decode floor of a pass over ``df``."""
    df.write.format("noop").mode("overwrite").save()


def publish_snapshot(spark: SparkSession, root: str, data: DataFrame, **options) -> str:
    """``archive.publish_snapshot``."""
    from . import archive
    return archive.publish_snapshot(spark, root, data, **options)


def latest_version(spark: SparkSession, root: str) -> str | None:
    """``archive.latest_version``."""
    from . import archive
    return archive.latest_version(spark, root)
