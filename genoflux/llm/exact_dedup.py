"""Exact deduplication by skew-safe combining, on DataFrame functions only.

Two texts are equal when they are identical after lower-casing A-Z.  The
work runs in three combining steps, each of which groups by digest *and*
full normalised text, so a digest collision can never merge two texts:

1. local: the map-side half of the first aggregation merges equal texts of
   one input partition, so a partition ships a text once;
2. salted: partial winners meet by (salt, digest, text), where the salt
   comes from the input partition -- a text held by a third of all rows is
   spread over ``salts`` tasks;
3. global: at most ``salts`` winners of a text meet by (digest, text).

Rows then learn their winner over the digest alone (narrow rows, text left
behind).  A digest that stands for several texts is resolved in a branch of
its own, on digest and text.

Defined cases: a null text is the empty text; an empty table gives no rows;
a null id is smaller than any other (it stays only when its whole group has
null ids); of rows repeated with id and text exactly one is kept.  Only the
id and text columns are read, so extra columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, maybe_broadcast
from .common import id_and_text

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _combine(rows: DataFrame, salts: int) -> DataFrame:
    """(digest, norm, keep_id, group_size), one row per distinct text."""
    salted = (rows.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
              .groupBy("salt", "digest", "norm")
              .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("n")))
    return (salted.groupBy("digest", "norm")
            .agg(F.max("keep_id").alias("keep_id"), F.sum("n").alias("group_size")))


def decide(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 64,
           digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """One row per distinct (id, text): ``doc_id``, ``digest`` (binary),
    ``rows`` (how often that pair occurs), ``keep_id``, ``group_size``.

    ``digest`` maps normalised text to a binary key; any function gives the
    same groups, a weak one only sends more texts through the collision
    branch."""
    rows = id_and_text(docs, id_col, text_col).select(
        "doc_id", normalised(F.col("text")).alias("norm"))
    rows = rows.withColumn("digest", digest(F.col("norm")))
    winners = cut_lineage(
        _combine(rows, salts).groupBy("digest").agg(
            F.count(F.lit(1)).alias("texts"), F.max("keep_id").alias("keep_id"),
            F.max("group_size").alias("group_size")), "exact-winners")

    plain = (rows.groupBy("digest", "doc_id").agg(F.count(F.lit(1)).alias("rows"))
             .join(winners.where("texts = 1").drop("texts"), "digest"))
    out = plain.select("doc_id", "digest", "rows", "keep_id", "group_size")
    collided = winners.where("texts > 1").select("digest")
    if collided.isEmpty():
        return out
    clash = rows.join(maybe_broadcast(collided), "digest", "left_semi")
    clash = (clash.groupBy("digest", "norm", "doc_id").agg(F.count(F.lit(1)).alias("rows"))
             .join(_combine(clash, salts), ["digest", "norm"]))
    return out.unionByName(clash.select("doc_id", "digest", "rows", "keep_id", "group_size"))


def mark_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    salts: int = 64) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept,
    text_sha256``.  Of equal texts the row with the largest id is kept."""
    d = decide(docs, id_col, text_col, salts)
    nth = F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows")))
    return d.select("doc_id", "keep_id", "group_size", "digest", nth.alias("nth")).select(
        "doc_id", "keep_id", "group_size",
        ((F.col("nth") == 1) & F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    salts: int = 64) -> DataFrame:
    """``docs``, all columns, with one row of each group of equal texts: the
    row of the largest id (of rows repeated with id and text, any one)."""
    d = cut_lineage(decide(docs, id_col, text_col, salts), "exact-decisions")
    winner = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    key = sha256(normalised(docs[text_col]))

    def matches(side: DataFrame):
        return docs[id_col].cast("long").eqNullSafe(side["__id"]) & (key == side["__digest"])

    def keys(cond) -> DataFrame:
        return maybe_broadcast(d.where(cond).select(
            F.col("doc_id").alias("__id"), F.col("digest").alias("__digest")))

    losers = keys(~winner)
    kept = docs.join(losers, matches(losers), "left_anti")
    if d.where(winner & (F.col("rows") > 1)).isEmpty():
        return kept
    again = keys(winner & (F.col("rows") > 1))
    repeated = (kept.join(again, matches(again), "left_semi")
                .withColumn("__digest", key).dropDuplicates([id_col, "__digest"]).drop("__digest"))
    return kept.join(again, matches(again), "left_anti").unionByName(repeated)
