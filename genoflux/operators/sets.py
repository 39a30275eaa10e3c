"""Set operations, distinct label lists and sorted output."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .frames import q
from .zipjoin import with_file_ordinal


def distinct_values(df: DataFrame, cols: Sequence[str], name: str = "value") -> DataFrame:
    """Distinct non-null string values found in any of ``cols`` (e.g. the two
    lineage columns).  Only the listed columns are read."""
    vals = F.explode(F.array(*[q(c).cast("string") for c in cols]))
    return df.select(vals.alias(name)).where(F.col(name).isNotNull()).distinct()


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    """Bag union by column name; columns missing on one side become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_distinct(frames: Iterable[DataFrame]) -> DataFrame:
    return union_all(frames).distinct()


def sort_key(df: DataFrame, key: str) -> Column:
    """What rows are sorted by: for text its UTF-16 code units (Spark's own
    order is that of UTF-8 bytes, which puts U+E000-U+FFFF before the
    characters beyond), other types as they are.  A null fails the job."""
    c = q(key)
    text = dict(df.dtypes).get(key) == "string"
    ordered = F.encode(c, "UTF-16BE") if text else c
    fail = F.raise_error(F.lit(f"a row has no {key} to sort by"))
    return F.when(c.isNull(), fail.cast("binary" if text else df.schema[key].dataType)).otherwise(ordered)


def _with_row_order(df: DataFrame, name: str) -> DataFrame:
    """A column that orders the rows as the input has them: by file, split
    and row for a scan (Spark deals large files out first, so the order of
    its partitions is another), by partition and row otherwise."""
    try:
        df.select("_metadata.file_path")
    except AnalysisException:
        return df.withColumn(name, F.monotonically_increasing_id())
    return with_file_ordinal(df, name)


def sort_output(df: DataFrame, key: str, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Stable global sort by one key (range partitioning + per-task sort), in
    the order of ``sort_key``.  Ties keep ``tiebreak`` order; without one, the
    order of the input rows (that of the files for a scan).  A null key fails
    the job.  Only needed for sorted *output*."""
    keyed = df.withColumn("_key16", sort_key(df, key))
    if tiebreak:
        return keyed.orderBy("_key16", *[q(t) for t in tiebreak]).drop("_key16")
    return _with_row_order(keyed, "_row").orderBy("_key16", "_row").drop("_key16", "_row")


def sorted_positions(df: DataFrame, key: str, tiebreak: Sequence[str] = (), name: str = "pos",
                     partitions: int | None = None) -> DataFrame:
    """1-based position of each row in the global order ``(key, tiebreak)``,
    the key as in ``sort_key``, without funnelling rows through one task: range-partition + per-task
    sort, local index from the task's row counter, and per-partition offsets
    from a table with one row per partition (bounded, broadcast).  The
    sorted rows are written once to the shared checkpoint folder so counts
    and rows come from the same partitioning (a re-planned range exchange
    could sample different bounds)."""
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["_key16", *tiebreak]
    ranged = cut_lineage(
        df.withColumn("_key16", sort_key(df, key)).repartitionByRange(n, *order).sortWithinPartitions(*order)
        .withColumn("_pid", F.spark_partition_id().cast("long"))
        .withColumn("_loc", F.monotonically_increasing_id() - F.col("_pid") * F.lit(1 << 33)))
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_cnt").over(w), F.lit(0)).alias("_off"))
    return (ranged.join(F.broadcast(offsets), "_pid")
            .withColumn(name, (F.col("_off") + F.col("_loc") + 1).cast("long"))
            .drop("_pid", "_loc", "_off", "_key16"))
