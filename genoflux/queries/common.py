"""Shared helpers for the driver-table queries.

Snapshot derivation used by the diff family: the ``orders`` table read
whole and seen at two points in time.  The *old* snapshot holds the orders
placed before 2000; the *new* one holds every order except finished orders
from before 1996 (archived, hence deleted), and pending orders have been
re-prioritised since (changed).  Every row is read and fingerprinted; the
predicates only decide which snapshot a row belongs to.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def order_record(orders: DataFrame) -> DataFrame:
    """Orders as a fingerprintable record (ints and ASCII text only)."""
    return orders.select(
        "o_orderkey", "o_custkey", "o_orderstatus",
        F.round(F.col("o_totalprice") * 100).cast("long").alias("o_totalprice_cents"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"),
        "o_orderpriority")


ORDER_FIELDS = ("o_custkey", "o_orderdate", "o_orderkey", "o_orderpriority",
                "o_orderstatus", "o_totalprice_cents")


SNAPSHOT_TIME = "2000-01-01"   # the old snapshot was taken then
ARCHIVED_BEFORE = "1996-01-01"  # finished orders older than this left the new one


def old_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return order_record(o.where(F.col("o_orderdate") < F.lit(SNAPSHOT_TIME).cast("timestamp_ntz")))


def new_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    archived = (F.col("o_orderstatus") == "F") & (
        F.col("o_orderdate") < F.lit(ARCHIVED_BEFORE).cast("timestamp_ntz"))
    rec = order_record(o.where(~archived))
    return rec.withColumn("o_orderpriority", F.when(
        F.col("o_orderstatus") == "P", F.concat("o_orderpriority", F.lit("*"))
    ).otherwise(F.col("o_orderpriority")))


# --- the same derivation in DuckDB SQL -------------------------------------

SQL_ORDER_RECORD = """
  SELECT o_orderkey, o_custkey, o_orderstatus,
         CAST(round(o_totalprice * 100) AS BIGINT) AS o_totalprice_cents,
         strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority
  FROM orders"""

SQL_OLD = f"SELECT * FROM ({SQL_ORDER_RECORD}) WHERE o_orderdate < '{SNAPSHOT_TIME}'"
SQL_NEW = f"""SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice_cents, o_orderdate,
         CASE WHEN o_orderstatus = 'P' THEN o_orderpriority || '*' ELSE o_orderpriority END
           AS o_orderpriority
  FROM ({SQL_ORDER_RECORD})
  WHERE NOT (o_orderstatus = 'F' AND o_orderdate < '{ARCHIVED_BEFORE}')"""


def sql_md5_json(fields, alias: str = "") -> str:
    p = f"{alias}." if alias else ""
    items = ", ".join(f"'{f}': {p}{f}" for f in sorted(fields))
    return f"md5(CAST(to_json({{{items}}}) AS VARCHAR))"


SQL_OLD_H = f"SELECT o_orderkey AS id, {sql_md5_json(ORDER_FIELDS)} AS md5 FROM ({SQL_OLD})"
SQL_NEW_H = f"SELECT o_orderkey AS id, {sql_md5_json(ORDER_FIELDS)} AS md5 FROM ({SQL_NEW})"

SQL_DIFF = f"""
  WITH o AS ({SQL_OLD_H}), n AS ({SQL_NEW_H})
  SELECT n.id AS id,
         CASE WHEN o.id IS NULL THEN 'added' WHEN o.md5 = n.md5 THEN 'unchanged'
              ELSE 'changed' END AS status
  FROM n LEFT JOIN o ON n.id = o.id
  UNION ALL
  SELECT o.id AS id, 'deleted' AS status FROM o WHERE o.id NOT IN (SELECT id FROM n)"""
