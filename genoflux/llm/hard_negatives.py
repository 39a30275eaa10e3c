"""Hard negatives of anchor vectors by spanning-tree bounds.

A component x becomes floor(256 * x); a row's score for an anchor is the
integer inner product, higher first, ties by smaller vec_id.  An anchor's
positives are its first rows of the same label.  For each positive its hard
negatives are the first rows of another label whose score lies in the window
from ``LEAST`` to ``MOST`` hundredths of the positive's score.

The anchors are a stated query set and are compared with all rows, in blocks:

1. Anchors are sorted by the signs of their first components, so that near
   ones stand together, and cut into groups of at most ``TREE``.  A task links
   each group by its minimum spanning tree and writes every anchor with its
   parent and the length of its edge.
2. About ``ANCHORS`` anchors at a time are sent to the tasks (measured in
   rows, so their size is bounded), each of which reads its rows in blocks.
   At a tree's root all scores are computed.  At a child, a row's score lies
   within its parent's score, or bounds, plus or minus the edge's length times
   the row's norm.  Only rows whose bounds overlap what can still count are
   rescored; the others carry their bounds on to the next level.
3. What can count: for positives, a score that reaches the task's k-th best
   one so far; for negatives, the windows of the positives, likewise raised by
   what the task has found.  Tasks return their best rows, and the best of
   these are taken in two steps, salted ones first.

The bounds never decide a result, only what is rescored: every returned score
is computed.  Where the anchors are far apart (random vectors) they exclude
nothing and all rows are rescored, as one matrix product a level.

Defined cases: rows with a null id, label, vector or component, or with one
whose 256-fold is not finite, take no part; a shorter vector counts as filled
up with zeros; anchors equal in all three are one; rows of the anchor's own id
are none of its positives or negatives, other repeated rows each count; an
anchor without positives or negatives gives no rows; an empty table gives
none.  A floored component of ``LARGEST`` or more fails the job: the sums
would not be exact.  Other columns are not read.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import small_batches

POSITIVES, NEGATIVES, LEAST, MOST = 5, 5, 80, 100
TREE, ANCHORS = 512, 8192
ROWS = 2048
LARGEST = 1 << 20
SALTS = 64


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, vector) of the rows that take part."""
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                       F.col("embedding").cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & (F.abs(x * 256) < float("inf")))  # NaN sorts above infinity
    return v.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull()).where(finite)


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    """Floored components as doubles (exact integers), filled up with zeros."""
    sizes = np.array(pc.list_value_length(column), dtype=np.int64)
    out = np.zeros((len(sizes), width))
    flat = np.floor(256 * np.array(column.flatten(), dtype=np.float64))
    if len(flat) and np.abs(flat).max() >= LARGEST:
        raise ValueError(f"a component of {LARGEST} or more after scaling: scores would not be exact")
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def spanning_tree(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each point's parent (the root's is itself) and the length of the edge
    to it, of a minimum spanning tree grown from the first point."""
    n = len(points)
    parent, length = np.zeros(n, dtype=np.int64), np.full(n, np.inf)
    open_ = np.ones(n, dtype=bool)
    length[0], at = 0.0, 0
    for _ in range(n - 1):
        open_[at] = False
        away = np.sqrt(((points - points[at]) ** 2).sum(axis=1))
        nearer = open_ & (away < length)
        parent[nearer], length[nearer] = at, away[nearer]
        at = int(np.argmin(np.where(open_, length, np.inf)))
    return parent, length


def anchor_trees(anchors: DataFrame, n_anchors: int, width: int) -> DataFrame:
    """(tree, pos, parent, length, vec_id, label, vector): anchors in groups
    of ``TREE`` at most, each linked by its spanning tree."""
    schema = pa.schema([("tree", pa.int64()), ("pos", pa.int64()), ("parent", pa.int64()), ("length", pa.float64()),
                        ("vec_id", pa.int64()), ("label", pa.int64()), ("vector", pa.list_(pa.float64()))])

    def run(batches):
        held, rows, no = [], 0, TaskContext.get().partitionId() << 32

        def grown():
            t = pa.Table.from_batches(held).combine_chunks()
            vector = t.column("vector").combine_chunks()
            points = _matrix(vector, width)
            parent, length = spanning_tree(points)
            return pa.RecordBatch.from_arrays([
                pa.array(np.full(len(points), no)), pa.array(np.arange(len(points))), pa.array(parent), pa.array(length),
                t.column("vec_id").combine_chunks(), t.column("label").combine_chunks(), vector], schema=schema)
        for b in batches:
            while b.num_rows:
                part = b.slice(0, TREE - rows)
                b = b.slice(part.num_rows)
                held.append(part)
                rows += part.num_rows
                if rows == TREE:
                    yield grown()
                    held, rows, no = [], 0, no + 1
        if held:
            yield grown()
    signs = F.expr("concat_ws('', transform(slice(vector, 1, 16), x -> if(x < 0, '0', '1')))")
    parts = max(1, -(-n_anchors // TREE))
    dealt = anchors.withColumn("signs", signs).repartitionByRange(parts, "signs", "vec_id").sortWithinPartitions(
        "signs", "vec_id").select("vec_id", "label", "vector")
    return dealt.mapInArrow(run, "tree long, pos long, parent long, length double, vec_id long, label long, vector array<double>")


def _forest(rows: list, width: int) -> list[dict]:
    """The collected anchors of a block as trees with their levels."""
    trees: dict[int, list] = {}
    for r in rows:
        trees.setdefault(r["tree"], []).append(r)
    out, first = [], 0
    for _, nodes in sorted(trees.items()):
        nodes.sort(key=lambda r: r["pos"])
        parent = np.array([r["parent"] for r in nodes])
        depth = np.zeros(len(nodes), dtype=np.int64)
        up = parent.copy()
        while up.any():
            depth += up > 0
            up = parent[up]
        depth[1:] += 1
        out.append({"no": first + np.arange(len(nodes)), "parent": parent, "length": np.array([r["length"] for r in nodes]),
                    "levels": [np.flatnonzero(depth == d) for d in range(int(depth.max()) + 1)],
                    "points": _matrix(pa.array([r["vector"] for r in nodes], pa.list_(pa.float64())), width),
                    "id": np.array([r["vec_id"] for r in nodes]), "label": np.array([r["label"] for r in nodes])})
        first += len(nodes)
    return out


def scan_tree(tree: dict, rows: np.ndarray, allowed: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple:
    """(anchor, row, score, how many were rescored): pairs that ``allowed``
    admits and whose score lies between the anchor's ``low`` and ``high``."""
    norms = np.sqrt((rows ** 2).sum(axis=1))
    least, most = np.empty(allowed.shape), np.empty(allowed.shape)
    found, rescored = [], 0
    for depth, nodes in enumerate(tree["levels"]):
        if depth:
            up = tree["parent"][nodes]
            # the slack covers the rounding of lengths and norms
            reach = tree["length"][nodes][:, None] * norms * (1 + 1e-9) + 1e-3
            least[nodes], most[nodes] = least[up] - reach, most[up] + reach
            need = allowed[nodes] & (most[nodes] >= low[nodes][:, None]) & (least[nodes] <= high[nodes][:, None])
            i, j = np.nonzero(need)
            if 8 * len(i) > need.size:
                score = (tree["points"][nodes] @ rows.T)[i, j]
            else:
                score = np.einsum("nd,nd->n", tree["points"][nodes[i]], rows[j])
            least[nodes[i], j] = most[nodes[i], j] = score
        else:
            i, j = (x.ravel() for x in np.indices((1, len(rows))))
            score = tree["points"][0] @ rows.T
            least[0], most[0] = score, score
        rescored += len(i)
        good = allowed[nodes[i], j] & (score >= low[nodes[i]]) & (score <= high[nodes[i]])
        found.append((nodes[i[good]], j[good], score[good]))
    return (*(np.concatenate(p) for p in zip(*found, strict=True)), rescored)


def _best(key: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> tuple:
    """The k best of each key."""
    order = np.lexsort((ids, -score, key))
    key, score, ids = key[order], score[order], ids[order]
    first = np.searchsorted(key, key)
    keep = np.arange(len(key)) - first < k
    return key[keep], score[keep], ids[keep]


def _kth(found: tuple, n_keys: int, k: int) -> np.ndarray:
    """Each key's k-th best score, minus infinity where it has fewer."""
    out = np.full(n_keys, -np.inf)
    key, score, _ = found
    last = np.searchsorted(key, np.arange(n_keys), side="right") - 1
    full = np.bincount(key, minlength=n_keys) == k
    out[full] = score[last[full]]
    return out


_NONE = (np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64))


def _blocks(batches, width: int):
    for b in batches:
        for at in range(0, b.num_rows, ROWS):
            part = b.slice(at, ROWS)
            yield np.array(part.column(0)), np.array(part.column(1)), _matrix(part.column(2), width)


_FOUND = pa.schema([("key", pa.int64()), ("score", pa.int64()), ("vec_id", pa.int64())])


def _emit(found: tuple):
    key, score, ids = found
    yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(score.astype(np.int64)), pa.array(ids)], schema=_FOUND)


def _top(rows: DataFrame, k: int) -> DataFrame:
    order = [F.desc("score"), F.asc("vec_id")]
    salted = Window.partitionBy("key", F.pmod(F.xxhash64("vec_id"), F.lit(SALTS))).orderBy(*order)
    whole = Window.partitionBy("key").orderBy(*order)
    rows = rows.withColumn("rank", F.row_number().over(salted)).where(F.col("rank") <= k)
    return rows.withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= k)


def _mine_block(rows: DataFrame, collected: list, width: int) -> DataFrame:
    spark = rows.sparkSession
    forest = _forest(collected, width)
    n = sum(len(t["id"]) for t in forest)
    sent = spark.sparkContext.broadcast(forest)

    def positives(batches):
        found = _NONE
        for ids, labels, points in _blocks(batches, width):
            low, parts = _kth(found, n, POSITIVES), [found]
            for t in sent.value:
                allowed = (t["label"][:, None] == labels) & (t["id"][:, None] != ids)
                i, j, score, _ = scan_tree(t, points, allowed, low[t["no"]], np.full(len(t["id"]), np.inf))
                parts.append((t["no"][i], score, ids[j]))
            found = _best(*(np.concatenate(p) for p in zip(*parts, strict=True)), POSITIVES)
        yield from _emit(found)

    best = _top(rows.mapInArrow(positives, "key long, score long, vec_id long"), POSITIVES).collect()  # bounded by the block
    score = np.full((n, POSITIVES), np.nan)
    ids_of = np.zeros((n, POSITIVES), dtype=np.int64)
    for r in best:
        score[r["key"], r["rank"] - 1], ids_of[r["key"], r["rank"] - 1] = r["score"], r["vec_id"]
    windows = spark.sparkContext.broadcast(score)

    def negatives(batches):
        found, pos = _NONE, windows.value
        for ids, labels, points in _blocks(batches, width):
            low = np.fmax(np.ceil(LEAST * pos / 100), _kth(found, pos.size, NEGATIVES).reshape(pos.shape))
            low, high = np.where(np.isnan(pos), np.inf, low), np.where(np.isnan(pos), -np.inf, np.floor(MOST * pos / 100))
            parts = [found]
            for t in sent.value:
                no = t["no"]
                allowed = t["label"][:, None] != labels
                i, j, s, _ = scan_tree(t, points, allowed, low[no].min(axis=1), high[no].max(axis=1))
                at, slot = np.nonzero((s[:, None] >= low[no[i]]) & (s[:, None] <= high[no[i]]))
                parts.append((no[i[at]] * POSITIVES + slot, s[at], ids[j[at]]))
            found = _best(*(np.concatenate(p) for p in zip(*parts, strict=True)), NEGATIVES)
        yield from _emit(found)

    best = _top(rows.mapInArrow(negatives, "key long, score long, vec_id long"), NEGATIVES)
    anchor = np.concatenate([t["id"] for t in forest])
    pairs = [(int(a * POSITIVES + s), int(anchor[a]), int(ids_of[a, s]), int(score[a, s]))
             for a in range(n) for s in range(POSITIVES) if not np.isnan(score[a, s])]
    named = spark.createDataFrame(pairs, "key long, anchor_id long, positive_id long, positive_score long")
    return cut_lineage(best.join(F.broadcast(named), "key").select(  # POSITIVES * ANCHORS rows, about
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score")), "negatives")


def mine(vectors: DataFrame, anchor: str = "vec_id % 100 = 0") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score); ``anchor`` tells which rows are anchors."""
    spark = vectors.sparkSession
    small_batches(spark)
    rows = cut_lineage(usable(vectors), "vectors")
    width = rows.agg(F.max(F.size("vector"))).first()[0] or 1
    anchors = rows.where(anchor).distinct()
    n_anchors = anchors.count()
    trees = cut_lineage(anchor_trees(anchors, n_anchors, max(1, width)), "anchors")
    n_blocks = max(1, -(-n_anchors // ANCHORS))
    parts = []
    for b in range(n_blocks):
        block = trees.where(F.pmod(F.xxhash64("tree"), F.lit(n_blocks)) == b).collect()
        if block:
            parts.append(_mine_block(rows, block, max(1, width)))
    if not parts:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, "
                                         "positive_score long, negative_score long")
    return reduce(DataFrame.unionByName, parts)
