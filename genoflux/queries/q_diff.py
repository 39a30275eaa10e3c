"""Fingerprint / snapshot-diff family on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import diff as D
from ..operators.sets import union_all
from .common import (ORDER_FIELDS, SQL_DIFF, SQL_NEW, SQL_OLD, new_orders, old_orders,
                     sql_md5_json, table)


def _diffed(spark, sf):
    old = D.fingerprint(old_orders(spark, sf), "o_orderkey", ORDER_FIELDS)
    new = D.fingerprint(new_orders(spark, sf), "o_orderkey", ORDER_FIELDS)
    return D.snapshot_diff(old, new)


def snapshot_diff(spark, sf):
    """P23 + J5 + U4: (id, status) between two snapshots of orders."""
    return _diffed(spark, sf)


def diff_summary(spark, sf):
    """A3: ids per status."""
    return D.diff_summary(_diffed(spark, sf))


def row_fingerprint(spark, sf):
    """md5 of the canonical JSON of each customer record."""
    c = table(spark, sf, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_mktsegment",
        F.round(F.col("c_acctbal") * 100).cast("long").alias("c_acctbal_cents"))
    return D.fingerprint(c, "c_custkey").withColumnRenamed("id", "c_custkey")


def fingerprint_dedup_last(spark, sf):
    """A2: per conversation, the fingerprint of its last turn (last wins)."""
    conv = table(spark, sf, "conversations")
    h = D.fingerprint(conv.select("conv_id", "turn", "role", "text"), "conv_id",
                      keep=["turn"])
    return D.dedup_last(h, "id", "md5", "turn").withColumnRenamed("id", "conv_id")


def extract_added_or_changed(spark, sf):
    """J6a + U3: new-snapshot rows whose id was added or changed."""
    new = new_orders(spark, sf)
    return D.extract_added_or_changed(new, _diffed(spark, sf), "o_orderkey")


def extract_unchanged(spark, sf):
    """Previous-snapshot rows whose id is unchanged."""
    old = old_orders(spark, sf)
    return D.extract_unchanged(old, _diffed(spark, sf), "o_orderkey", strict=True)


def incremental_merge(spark, sf):
    """Unchanged previous rows + re-processed new rows (version tagged)."""
    d = _diffed(spark, sf)
    old = old_orders(spark, sf).withColumn("version", F.lit("v1"))
    new = new_orders(spark, sf).withColumn("o_orderpriority", F.upper("o_orderpriority")) \
        .withColumn("version", F.lit("v2"))
    return union_all([D.extract_unchanged(old, d, "o_orderkey"),
                      D.extract_added_or_changed(new, d, "o_orderkey")])


def deleted_ids(spark, sf):
    """U4: old ids minus new ids."""
    old = old_orders(spark, sf).select(F.col("o_orderkey").alias("id"))
    new = new_orders(spark, sf).select(F.col("o_orderkey").alias("id"))
    return D.deleted_ids(old, new)


QUERIES = {
    "snapshot_diff": snapshot_diff,
    "diff_summary": diff_summary,
    "row_fingerprint": row_fingerprint,
    "fingerprint_dedup_last": fingerprint_dedup_last,
    "extract_added_or_changed": extract_added_or_changed,
    "extract_unchanged": extract_unchanged,
    "incremental_merge": incremental_merge,
    "deleted_ids": deleted_ids,
}

_CUST = ("c_acctbal_cents", "c_custkey", "c_mktsegment", "c_name", "c_nationkey")
_CONV = ("conv_id", "role", "text", "turn")

ORACLE = {
    "snapshot_diff": SQL_DIFF,
    "diff_summary": f"SELECT status, count(*) AS n FROM ({SQL_DIFF}) GROUP BY status",
    "row_fingerprint": f"""
      SELECT c_custkey, {sql_md5_json(_CUST)} AS md5 FROM (
        SELECT c_custkey, c_name, c_nationkey, c_mktsegment,
               CAST(round(c_acctbal * 100) AS BIGINT) AS c_acctbal_cents FROM customer)""",
    "fingerprint_dedup_last": f"""
      SELECT conv_id, arg_max({sql_md5_json(_CONV)}, turn) AS md5
      FROM conversations GROUP BY conv_id""",
    "extract_added_or_changed": f"""
      SELECT * FROM ({SQL_NEW}) WHERE o_orderkey IN (
        SELECT id FROM ({SQL_DIFF}) WHERE status IN ('added', 'changed'))""",
    "extract_unchanged": f"""
      SELECT * FROM ({SQL_OLD}) WHERE o_orderkey IN (
        SELECT id FROM ({SQL_DIFF}) WHERE status = 'unchanged')
        AND o_orderkey NOT IN (SELECT id FROM ({SQL_DIFF}) WHERE status IN ('added', 'changed'))""",
    "incremental_merge": f"""
      SELECT *, 'v1' AS version FROM ({SQL_OLD}) WHERE o_orderkey IN (
        SELECT id FROM ({SQL_DIFF}) WHERE status = 'unchanged')
      UNION ALL
      SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice_cents, o_orderdate,
             upper(o_orderpriority) AS o_orderpriority, 'v2' AS version
      FROM ({SQL_NEW}) WHERE o_orderkey IN (
        SELECT id FROM ({SQL_DIFF}) WHERE status IN ('added', 'changed'))""",
    "deleted_ids": f"""
      SELECT DISTINCT o_orderkey AS id FROM ({SQL_OLD})
      EXCEPT SELECT o_orderkey FROM ({SQL_NEW})""",
}
