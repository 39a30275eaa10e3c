"""Mixing sources to target weights by Poisson replication, on DataFrame
functions only.

A source with ``n`` of all ``N`` documents and target weight ``w`` (weights
are scaled to sum to one) has the mean repetition rate ``w * N * epochs / n``.
Each document's count is a Poisson variable of that mean, made by inverting
its distribution function at a uniform number hashed from (seed, id), or from
the whole row where it has no id: the
count is the number of table entries not above it.  Rates above ``STEP`` are
the sum of several draws, each with a hash of its own, so that the table
stays short and does not underflow.  Copies are exploded and dealt out by a
hash of (seed, id, copy), which also orders them within a partition: a
global shuffle.  Rows that repeat an id have equal hashes; their place in the
input deals them on, so that an id, or repeated rows without one, that hold
a great part of the table do not meet in one task.

Draws are independent, so no source's rows ever have to meet; the hot source
is as parallel as the input.  The rates are a row a source; they are
broadcast if measured small, else joined by a shuffle that splits hot keys.

Defined cases: a null source is a source; a null text stays null; documents
repeated with an id are drawn alike; a row without id draws by the digest of
all its columns; a source without weight, or of weight zero, has rate zero; a negative weight
is an error; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, maybe_broadcast

#: Largest mean of one draw.
STEP = 16.0
#: Parts that the rows of one shuffle key are dealt to.
SPREAD = 1024


def uniform(seed: int, ident: Column, draw: Column) -> Column:
    """[0, 1) from the first 52 bits of a digest of (seed, id, draw)."""
    text = F.concat_ws("|", F.lit(str(seed)), ident, draw.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def distribution(mean: Column) -> Column:
    """Array of P(X <= k) for k = 0, 1, ... until nothing of weight is left."""
    last = F.ceil(mean + 12 * F.sqrt(mean) + 20).cast("int")
    state = F.struct(F.exp(-mean).alias("p"), F.exp(-mean).alias("sum"),
                     F.array(F.exp(-mean)).alias("table"))

    def step(s, k):
        p = s["p"] * mean / k
        return F.struct(p.alias("p"), (s["sum"] + p).alias("sum"),
                        F.concat(s["table"], F.array(s["sum"] + p)).alias("table"))
    return F.aggregate(F.sequence(F.lit(1), last), state, step, lambda s: s["table"])


def tempered(docs: DataFrame, source_col: str = "source") -> DataFrame:
    """(source, weight) with weight the root of the source's size: between
    its own share and equal shares."""
    return docs.groupBy(F.col(source_col).alias("source")).agg(
        F.sqrt(F.count(F.lit(1)).cast("double")).alias("weight"))


def rates(docs: DataFrame, weights: DataFrame, epochs: float = 1.0,
          source_col: str = "source") -> DataFrame:
    """(source, rate, draws, table): a row for each source of ``docs``."""
    w = weights.groupBy("source").agg(F.sum("weight").alias("weight"))
    total_weight = F.sum("weight").cast("double").alias("total_weight")
    sizes = docs.groupBy(F.col(source_col).alias("source")).agg(F.count(F.lit(1)).alias("n"))
    own = sizes.withColumnRenamed("source", "__source").join(
        w, F.col("__source").eqNullSafe(F.col("source")), "left").select(
        F.col("__source").alias("source"), "n", F.coalesce("weight", F.lit(0.0)).alias("weight"))
    totals = own.agg(F.sum("n").alias("total"), total_weight,
                     F.min("weight").alias("least"))  # one row
    own = own.crossJoin(F.broadcast(totals))
    rate = F.when(F.col("least") < 0, F.raise_error(F.lit("a target weight is negative"))).otherwise(
        F.when(F.col("total_weight") > 0, F.col("weight") / F.col("total_weight")
               * F.col("total") / F.col("n") * F.lit(float(epochs))).otherwise(F.lit(0.0)))
    own = own.select("source", rate.cast("double").alias("rate"))
    own = own.withColumn("draws", F.greatest(F.lit(1), F.ceil(F.col("rate") / F.lit(STEP))).cast("int"))
    return own.withColumn("table", distribution(F.col("rate") / F.col("draws")))


def mix(docs: DataFrame, weights: DataFrame, epochs: float = 1.0, seed: int = 7,
        id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """``docs``, all columns, replicated and shuffled; ``__copy`` (from 1),
    ``__copies`` and ``__order`` (the shuffle key) are added."""
    table = cut_lineage(rates(docs, weights, epochs, source_col).select(
        F.col("source").alias("__source"), F.col("draws").alias("__draws"),
        F.col("table").alias("__table")), "mixing-rates")
    table = maybe_broadcast(table)
    drawn = docs.join(table, docs[source_col].eqNullSafe(table["__source"]))
    ident = F.coalesce(docs[id_col].cast("string"), F.concat(F.lit("null:"), F.md5(F.to_json(F.struct(
        *[docs[c] for c in docs.columns])).cast("binary"))))

    def draw(total, j):
        u = uniform(seed, ident, j)
        return total + F.size(F.filter("__table", lambda c: c <= u))
    copies = F.aggregate(F.sequence(F.lit(1), F.col("__draws")), F.lit(0), draw)
    drawn = drawn.withColumn("__copies", copies).where("__copies > 0")
    drawn = drawn.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies"))))
    order = F.md5(F.concat_ws("|", F.lit(f"{seed}s"), ident, F.col("__copy").cast("string")))
    drawn = drawn.withColumn("__order", order)
    place = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(SPREAD))
    return (drawn.select(*docs.columns, "__copy", "__copies", "__order").withColumn("__place", place)
            .repartition("__order", "__place").drop("__place").sortWithinPartitions("__order"))
