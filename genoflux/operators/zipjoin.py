"""Positional multi-way outer join ("zip" on duplicate keys).

Inputs are matched on a string key; rows sharing a key are paired *by
position* (1st with 1st, 2nd with 2nd, ...), never crossed.  In Spark this
is an equi-join on ``(key, rn)`` where ``rn`` is the row's position within
its key by a deterministic ordinal (file order or a unique id).

Position numbering starts from key statistics (one key-only partial
aggregation, for several inputs at once): when every key is unique -- the
usual one-row-per-sample input -- the position is 1 and nothing moves.
If a few keys repeat, only their (key, ordinal) pairs are numbered, as a
narrow table that is joined back by a broadcast; the wide rows stay where
they are.  Otherwise it is skew-safe: keys with more than ``hot_rows`` rows (their
number is bounded by ``rows / hot_rows``, so that list may be broadcast) are
numbered over a range-partitioned sort that splits each hot key across many
tasks, materialised once; all other keys use an ordinary window whose
groups are then bounded by ``hot_rows``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import BROADCAST_MAX_BYTES, cut_lineage, maybe_broadcast, payload_bytes

HOT_ROWS_CONF = "genoflux.zip.hotKeyRows"
# A key above this many rows is numbered on the split (hot) path.  With
# ~30 kB sequence rows a window group below it is at most ~1.5 GB.
DEFAULT_HOT_ROWS = 50_000
# Up to this share of rows whose key repeats, those alone are numbered.
SPARSE_SHARE = 0.1


def hot_limit(df: DataFrame, hot_rows: int | None) -> int:
    """The hot-key row limit: explicit, else ``genoflux.zip.hotKeyRows``."""
    if hot_rows is not None:
        return hot_rows
    v = df.sparkSession.conf.get(HOT_ROWS_CONF, None)
    return int(v) if v else DEFAULT_HOT_ROWS


def content_ordinal(df: DataFrame, name: str = "ordinal") -> DataFrame:
    """A deterministic tiebreak when no file order is recorded: a 64-bit
    hash of the row content (maps hashed as their key-sorted entry arrays).
    Rows with equal hashes are identical in practice, so their relative
    order does not change the result."""
    parts = []
    for c, t in df.dtypes:
        col = F.col(f"`{c}`")
        parts.append(F.array_sort(F.map_entries(col)) if t.startswith("map<") else col)
    return df.withColumn(name, F.xxhash64(*parts))


def with_file_ordinal(df: DataFrame, name: str = "ordinal") -> DataFrame:
    """Deterministic file order for a file scan: (path, split start, row
    position within the split).  Must be applied directly on the scan,
    before any shuffle."""
    return df.withColumn(name, F.struct(
        F.col("_metadata.file_path").alias("f"),
        F.col("_metadata.file_block_start").alias("b"),
        F.monotonically_increasing_id().alias("i")))


def key_stats(inputs: Sequence[tuple[DataFrame, Sequence[str]]], limit: int) -> list[dict]:
    """For each ``(df, keys)``: the largest group size, the number of keys
    above ``limit``, the rows of keys that repeat and all rows -- all inputs in ONE job (key-only projections unioned,
    one partial aggregation; the result has one row per input)."""
    parts = []
    for tag, (df, keys) in enumerate(inputs):
        k = F.concat_ws("\u0001", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\u0002"))
                                   for c in keys])
        parts.append(df.select(F.lit(tag).alias("_t"), k.alias("_k")))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    per_key = u.groupBy("_t", "_k").agg(F.count(F.lit(1)).alias("_n"))
    rows = per_key.groupBy("_t").agg(F.max("_n").alias("mx"),
                                     F.count_if(F.col("_n") > limit).alias("hot"),
                                     F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n"))), F.lit(0)).alias("rep"),
                                     F.sum("_n").alias("n")).collect()
    got = {r["_t"]: {k: r[k] for k in ("mx", "hot", "rep", "n")} for r in rows}
    return [got.get(t, {"mx": None, "hot": 0, "rep": 0, "n": 0}) for t in range(len(inputs))]


def _sparse_numbers(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame | None:
    """(_h0.., _o0.., _n) of the rows whose key repeats, ready to be joined
    back; None if that table is not small or does not tell rows apart."""
    kcols, ocols = [F.col(f"`{k}`") for k in keys], [F.col(f"`{o}`") for o in order]
    named = [*[c.alias(f"_h{i}") for i, c in enumerate(kcols)], *[c.alias(f"_o{i}") for i, c in enumerate(ocols)]]
    hs, os = [f"_h{i}" for i in range(len(keys))], [f"_o{i}" for i in range(len(order))]
    repeated = df.groupBy(*kcols).agg(F.count(F.lit(1)).alias("_c")).where("_c > 1").select(
        *[c.alias(f"_r{i}") for i, c in enumerate(kcols)])
    same = F.lit(True)
    for i, h in enumerate(hs):
        same = same & F.col(h).eqNullSafe(F.col(f"_r{i}"))
    pairs = df.select(*named).join(maybe_broadcast(cut_lineage(repeated, "repeated-keys")), same, "left_semi")
    w = Window.partitionBy(*hs).orderBy(*os)
    numbered = pairs.withColumns({"_n": F.row_number().over(w).cast("long"),
                                  "_tie": F.count(F.lit(1)).over(Window.partitionBy(*hs, *os))})
    numbered = cut_lineage(numbered, "repeated-rows")
    if payload_bytes(numbered, numbered.columns) > BROADCAST_MAX_BYTES or not numbered.where("_tie > 1").isEmpty():
        return None
    return F.broadcast(numbered.drop("_tie"))


def key_row_number(df: DataFrame, keys: Sequence[str] | str, order: Sequence[str] | str,
                   rn: str = "rn", hot_rows: int | None = None, stats: dict | None = None
                   ) -> DataFrame:
    """Add ``rn`` = 1-based position of the row within its key by ``order``
    (``order`` must be unique within a key for a deterministic result).

    One key-only aggregate (partial, map-side combined) gives the largest
    group and the number of keys above the hot limit (``stats`` when already
    computed by ``key_stats`` for several inputs at once).  All keys unique
    (the usual one-row-per-sample input): ``rn = 1`` with no shuffle at all.
    Few rows of keys that repeat: those alone are numbered, narrow.
    No hot keys: a plain window.  With hot keys, their rows
    are range-partitioned on ``(key, order)`` -- a hot key spreads over many
    tasks -- and each row's task-local index is written once with the rows
    to the shared checkpoint folder, so the per-(partition, key) offsets and
    the rows themselves come from the same materialised partitioning (a
    re-planned range exchange could sample different bounds)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    order = [order] if isinstance(order, str) else list(order)
    spark = df.sparkSession
    limit = hot_limit(df, hot_rows)
    kcols = [F.col(f"`{k}`") for k in keys]

    if stats is None:
        stats = key_stats([(df, keys)], limit)[0]
    if stats["mx"] is None or stats["mx"] <= 1:
        # every key unique (the usual one-row-per-sample input): no window
        return df.withColumn(rn, F.lit(1).cast("long"))
    w = Window.partitionBy(*kcols).orderBy(*[F.col(f"`{o}`") for o in order])
    if not stats["hot"]:
        # 64 bytes a row is a low guess; the table itself is measured
        few = stats["rep"] <= SPARSE_SHARE * stats["n"] and 64 * stats["rep"] <= BROADCAST_MAX_BYTES
        sparse = _sparse_numbers(df, keys, order) if few else None
        if sparse is not None:
            same = F.lit(True)
            for i, k in enumerate(keys):
                same = same & df[f"`{k}`"].eqNullSafe(sparse[f"_h{i}"])
            for i, o in enumerate(order):
                same = same & df[f"`{o}`"].eqNullSafe(sparse[f"_o{i}"])
            return df.join(sparse, same, "left").select(
                *[F.col(f"`{c}`") for c in df.columns], F.coalesce("_n", F.lit(1)).cast("long").alias(rn))
        return df.withColumn(rn, F.row_number().over(w).cast("long"))
    counts = df.groupBy(*kcols).agg(F.count(F.lit(1)).alias("_n"))
    hot = counts.where(F.col("_n") > limit).select(*kcols)

    # At most rows / limit keys can exceed the limit; the list is also
    # measured before it is broadcast.
    hot_b = maybe_broadcast(cut_lineage(hot.select(*[c.alias(f"_h{i}") for i, c in enumerate(kcols)])))
    is_hot = F.lit(True)
    for i, k in enumerate(keys):  # a null key may be the hot one
        is_hot = is_hot & df[f"`{k}`"].eqNullSafe(hot_b[f"_h{i}"])
    cold_rn = df.join(hot_b, is_hot, "left_anti").withColumn(rn, F.row_number().over(w).cast("long"))

    nparts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = cut_lineage(
        df.join(hot_b, is_hot, "left_semi")
        .repartitionByRange(nparts, *kcols, *[F.col(f"`{o}`") for o in order])
        .sortWithinPartitions(*kcols, *[F.col(f"`{o}`") for o in order])
        .withColumn("_pid", F.spark_partition_id().cast("long"))
        .withColumn("_pos", F.monotonically_increasing_id() - F.col("_pid") * F.lit(1 << 33)))
    # One row per (partition, hot key): bounded by hot keys x partitions.
    spans = ranged.groupBy("_pid", *kcols).agg(F.min("_pos").alias("_first"),
                                              F.count(F.lit(1)).alias("_cnt"))
    ws = Window.partitionBy(*kcols).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("_off", F.coalesce(F.sum("_cnt").over(ws), F.lit(0)))
    spans = maybe_broadcast(spans.select(F.col("_pid").alias("_spid"), "_first", "_off",
                                         *[c.alias(f"_h{i}") for i, c in enumerate(kcols)]))
    same = ranged["_pid"] == spans["_spid"]
    for i, k in enumerate(keys):
        same = same & ranged[f"`{k}`"].eqNullSafe(spans[f"_h{i}"])
    hot_rn = (ranged.join(spans, same)
              .withColumn(rn, (F.col("_off") + F.col("_pos") - F.col("_first") + 1).cast("long"))
              .drop("_pid", "_pos", "_first", "_off"))
    return cold_rn.unionByName(hot_rn.select(*[F.col(f"`{c}`") for c in cold_rn.columns]))


def fallback_key(df: DataFrame, primary: str, alternative: str, name: str = "key",
                 allow_null: bool = False) -> DataFrame:
    """Join key = ``primary`` if present else ``alternative``; a row with
    neither fails the job unless ``allow_null``."""
    cols = set(df.columns)
    p = F.col(f"`{primary}`") if primary in cols else F.lit(None).cast("string")
    a = F.col(f"`{alternative}`") if alternative in cols else F.lit(None).cast("string")
    k = F.coalesce(p.cast("string"), a.cast("string"))
    if not allow_null:
        k = F.when(k.isNull(), F.raise_error(F.lit("row without join key"))).otherwise(k)
    return df.withColumn(name, k)


def zip_join(frames: Sequence[DataFrame], key: str = "key", rn: str = "rn",
             keep: str = "all") -> DataFrame:
    """Join frames that each carry ``key`` and ``rn`` on ``(key, rn)``.

    ``keep='all'``: full outer (every position of every input);
    ``keep='first'``: only positions present in the first input (left joins).
    Payload column names must be distinct across frames.

    More than two inputs of an outer join are tagged, stacked and grouped by
    ``(key, rn)`` once, instead of a chain of full joins on merged keys.  A
    null key pairs with nothing.
    """
    if keep == "all" and len(frames) > 2:
        return _zip_stacked(frames, key, rn)
    how = {"all": "full", "first": "left"}[keep]
    out = frames[0]
    for f in frames[1:]:
        out = out.join(f, [key, rn], how)
    return out


def _zip_stacked(frames: Sequence[DataFrame], key: str, rn: str) -> DataFrame:
    payloads = [[c for c in f.columns if c not in (key, rn)] for f in frames]
    stacked = None
    for i, f in enumerate(frames):
        rows = f.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{rn}`").alias("_rn"),
                        F.when(F.col(f"`{key}`").isNull(), F.lit(i)).alias("_alone"),
                        F.struct(F.lit(True).alias("_there"), *[F.col(f"`{c}`") for c in payloads[i]]).alias(f"_p{i}"))
        stacked = rows if stacked is None else stacked.unionByName(rows, allowMissingColumns=True)
    merged = stacked.groupBy("_key", "_rn", "_alone").agg(
        *[F.first(f"_p{i}", ignorenulls=True).alias(f"_p{i}") for i in range(len(frames))])
    return merged.select(F.col("_key").alias(key), F.col("_rn").alias(rn), *[
        F.col(f"_p{i}")[c].alias(c) for i, cols in enumerate(payloads) for c in cols])


def zip_inputs(frames: Sequence[tuple[DataFrame, str, Sequence[str] | str]],
               key: str = "key", rn: str = "rn", keep: str = "all",
               hot_rows: int | None = None) -> DataFrame:
    """Number each input ``(df, key column, order columns)`` and zip-join."""
    renamed = [(df if kcol == key else df.withColumnRenamed(kcol, key), order)
                for df, kcol, order in frames]
    limit = hot_limit(renamed[0][0], hot_rows)
    stats = key_stats([(d, [key]) for d, _ in renamed], limit)
    numbered = [key_row_number(d, key, order, rn, limit, st)
                for (d, order), st in zip(renamed, stats)]
    return zip_join(numbered, key, rn, keep)


def zip_long(df: DataFrame, key: str, name_col: str, value_col: str,
             order: Sequence[str] | str, rn: str = "rn", out: str = "values",
             hot_rows: int | None = None, stats: dict | None = None) -> DataFrame:
    """Many same-shaped inputs stacked as one long table ``(key, name,
    value)`` -> one row per ``(key, rn)`` with a ``name -> value`` map.
    One shuffle instead of one join per input; each group holds at most one
    row per name."""
    numbered = key_row_number(df, [key, name_col], order, rn, hot_rows, stats)
    return numbered.groupBy(key, rn).agg(
        F.map_from_entries(F.collect_list(F.struct(F.col(name_col), F.col(value_col)))).alias(out))


def zip_names(df: DataFrame, key: str, name_col: str, value_col: str, order: Sequence[str] | str,
              names: dict[str, str], rn: str = "rn", hot_rows: int | None = None,
              stats: dict | None = None) -> DataFrame:
    """``zip_long`` for a known list of names: one row per ``(key, rn)`` with
    a column for each, called as ``names`` says.  A row without a name fails
    the job; values of other names are left out.

    No lists are built.  A group has one row per name at most, so the rows are
    dealt by ``(key, rn)`` before they are grouped (nothing could be combined
    sooner), and the sort that groups them also serves a merge join."""
    limit = hot_limit(df, hot_rows)
    stats = stats or key_stats([(df, [key, name_col])], limit)[0]
    name = F.when(F.col(name_col).isNull(), F.raise_error(F.lit("row without name")).cast("string")).otherwise(
        F.col(name_col))
    rows = key_row_number(df, [key, name_col], order, rn, limit, stats).select(
        key, rn, name.alias("_name"), F.col(value_col).alias("_value"))
    if (stats["mx"] or 0) > 1:
        rows = rows.repartition(key, rn)
    return rows.groupBy(key, rn).agg(*[
        F.max(F.when(F.col("_name") == F.lit(n), F.col("_value"))).alias(c) for n, c in names.items()])
