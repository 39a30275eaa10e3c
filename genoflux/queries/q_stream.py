"""The feed stage run as a stream over landed feed files."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.location import GEO_LEVELS
from ..session import shared_path
from ..sources import writers as W
from ..streaming import process_landed_feed
from .q_columns import FEED_OUT, SQL_FEED_ENTRIES, events_feed


def feed_stream_landed(spark, sf):
    """The feed projection of W2a (no rules) over landed files: the events feed lands as several NDJSON files,
    a file-source stream (one file per micro-batch) normalises and
    fingerprints them; the written entries are read back."""
    root = shared_path(spark, "landing")
    W.write_ndjson(events_feed(spark, sf).repartition(4, "covv_accession_id"), f"{root}/in")
    n = process_landed_feed(spark, f"{root}/in", f"{root}/out", f"{root}/_stream", max_files=1)
    assert n >= 1
    e = spark.read.parquet(f"{root}/out/entries")
    return e.select("id", *FEED_OUT, *GEO_LEVELS, F.col("unaligned_nuc")["main"].alias("unaligned_main"))


QUERIES = {"feed_stream_landed": feed_stream_landed}

ORACLE = {
    "feed_stream_landed": f"""
      SELECT id, {', '.join(FEED_OUT)}, {', '.join(GEO_LEVELS)}, unaligned_main
      FROM ({SQL_FEED_ENTRIES})""",
}
