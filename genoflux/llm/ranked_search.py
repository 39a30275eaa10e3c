"""Ranked lexical search over whole documents by presence-mask grouping.

A term is a maximal run of digits, letters and characters beyond ASCII, A-Z
lower-cased.  With N documents that have a term, L terms in all, n in a
document, df documents holding a term and tf its occurrences in one, a term
weighs w = floor(1000 * ln((2N + 2) / (2df + 1))), a document's length factor
is m = 25 + (75 * n * N) div L, and its score for an item sums
w * ((10^9 * tf) div (1000 * tf + 8 * m)) over the item's terms, repeats
included (integers of 64 bits).

1. One pass over the texts (as UTF-8 bytes) writes each document's length and
   its counts of the items' terms; N, L and df come from that table.
2. A task takes its documents in blocks.  For an item, each of its terms sets
   its bit in the masks of the documents that hold it; documents of equal
   masks form a group.  All of a group's documents share the sum of weights,
   so that sum at the group's largest tf and least m is the group's maximum
   score.  Groups are evaluated by descending maximum, whole groups at a time,
   until the next maximum is below the k-th best score the task has seen for
   the item; an equal one is still evaluated, for the ties.
3. Each task returns k documents an item; the best of these are taken in two
   steps, salted ones first.  Nothing else is shuffled.

The items are a stated query set.  They are measured and dealt to blocks of
about ``ITEM_BYTES`` of text; a block's items, weights and best documents
are what a task holds beside a block of documents, and what the driver sends.

Defined cases: a null or term-free text is no document (it counts in neither
N nor L); an item without terms, and a document without a score above 0, give
no rows; equal item rows count once, rows that share an id but not the text
are ranked each by itself; rows of a repeated doc_id are documents of their
own; equal scores rank by ascending doc_id, a null one last; empty tables
give no rows.  Other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, payload_bytes
from .common import id_and_text, slices, small_batches

TOP = 10
ITEM_BYTES = 4 << 20
#: A block of a task's documents: so many, or so many term counts.
BLOCK_DOCS, BLOCK_COUNTS = 8192, 2_000_000
SALTS = 64

_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
RESULT = "item_no int, item_id long, doc_id long, score long"


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_LETTERS).split()


def term_counts(docs: DataFrame, numbers: dict[bytes, int], id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """(doc_id, n, terms, tfs) of each document that has a term: its length
    and its counts of the terms in ``numbers``."""
    spark = docs.sparkSession
    small_batches(spark)
    known = spark.sparkContext.broadcast(numbers)
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())),
                        ("tfs", pa.list_(pa.int64()))])

    def run(batches):
        number = known.value.get
        for b in slices(batches):
            out = ([], [], [], [])
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                terms = terms_of(text)
                if terms:
                    held = Counter(map(number, terms))
                    held.pop(None, None)
                    for column, value in zip(out, (doc_id, len(terms), list(held), list(held.values())), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, schema.types, strict=True)], schema=schema)
    rows = id_and_text(docs, id_col, text_col)
    return rows.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(
        run, "doc_id long, n long, terms array<int>, tfs array<long>")


def _saturated(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


class _Block:
    """A block of documents: counts by document and, sorted, by term."""

    def __init__(self, columns: list, n_docs: int, n_terms: int, total: int):
        ids, n, terms, tfs = columns
        self.ids, self.no_id = np.array(ids.fill_null(0)), np.array(ids.is_null())
        self.m = 25 + (75 * np.array(n) * n_docs) // total
        sizes = np.array(pc.list_value_length(terms))
        self.at = np.concatenate([[0], np.cumsum(sizes)])
        self.terms, self.tfs = np.array(terms.flatten()), np.array(tfs.flatten())
        order = np.argsort(self.terms, kind="stable")
        self.by_term = np.repeat(np.arange(len(n)), sizes)[order]
        self.tf_by_term = self.tfs[order]
        self.term_at = np.searchsorted(self.terms[order], np.arange(n_terms + 1))

    def groups(self, item: list[tuple[int, int]]) -> tuple:
        """The documents that hold a term, sorted by mask, with each group's
        start, and the groups' maximum scores."""
        words = np.zeros(((len(item) + 63) // 64, len(self.m)), dtype=np.uint64)
        weight, most = np.zeros(len(self.m), dtype=np.int64), np.zeros(len(self.m), dtype=np.int64)
        for bit, (term, w) in enumerate(item):
            lo, hi = self.term_at[term], self.term_at[term + 1]
            if lo < hi:
                docs, tf = self.by_term[lo:hi], self.tf_by_term[lo:hi]
                words[bit // 64, docs] |= np.uint64(1 << bit % 64)
                weight[docs] += w
                most[docs] = np.maximum(most[docs], tf)
        held = np.flatnonzero(most)
        held = held[np.lexsort(words[:, held])]
        if not len(held):
            return held, held, held
        new = np.concatenate([[True], (words[:, held[1:]] != words[:, held[:-1]]).any(axis=0)])
        starts = np.flatnonzero(new)
        best = weight[held[starts]] * _saturated(np.maximum.reduceat(most[held], starts),
                                                 np.minimum.reduceat(self.m[held], starts))
        return held, starts, best

    def scores(self, docs: np.ndarray, weights: np.ndarray) -> np.ndarray:
        sizes = self.at[docs + 1] - self.at[docs]
        ends = np.cumsum(sizes)
        flat = np.arange(ends[-1]) + np.repeat(self.at[docs] - ends + sizes, sizes)
        parts = weights[self.terms[flat]] * _saturated(self.tfs[flat], np.repeat(self.m[docs], sizes))
        return np.add.reduceat(parts, ends - sizes)  # each of these documents has a term


def _best(found: tuple, k: int) -> tuple:
    score, no_id, ids = found
    keep = np.lexsort((ids, no_id, -score))[:k]
    return score[keep], no_id[keep], ids[keep]


def evaluate(block: _Block, item: list[tuple[int, int]], weights: np.ndarray, found: tuple, k: int) -> tuple:
    """``found`` (scores, null ids, ids: k at most) merged with the block's
    documents, mask groups by descending maximum until safely finished."""
    held, starts, best = block.groups(item)
    ends = np.append(starts[1:], len(held))
    order = np.argsort(-best, kind="stable")
    at, want = 0, k
    while at < len(order):
        least = max(1, found[0][-1]) if len(found[0]) == k else 1
        if best[order[at]] < least:
            break
        taken = np.cumsum(ends[order[at:]] - starts[order[at:]])
        upto = at + int(np.searchsorted(taken, want)) + 1
        groups = [g for g in order[at:upto] if best[g] >= least]
        docs = np.concatenate([held[starts[g]:ends[g]] for g in groups])
        score = block.scores(docs, weights)
        good = score >= least
        found = _best(tuple(np.concatenate(p) for p in zip(
            found, (score[good], block.no_id[docs[good]], block.ids[docs[good]]), strict=True)), k)
        at, want = upto, 4 * want
    return found


def _blocks(batches):
    held, rows, counts = [], 0, 0
    for b in batches:
        if b.num_rows:
            held.append(b)
            rows, counts = rows + b.num_rows, counts + len(b.column(2).flatten())
        if rows >= BLOCK_DOCS or counts >= BLOCK_COUNTS:
            yield held
            held, rows, counts = [], 0, 0
    if held:
        yield held


def _rank_block(docs: DataFrame, rows: list, k: int) -> DataFrame | None:
    """RESULT rows of one block of items: k at most for each task."""
    spark = docs.sparkSession
    numbers: dict[bytes, int] = {}
    items = []
    for r in rows:
        counted = Counter(terms_of(r["text"].encode()))
        if counted:
            items.append((r["item_id"], [(numbers.setdefault(t, len(numbers)), c) for t, c in counted.items()]))
    if not items:
        return None
    counts = cut_lineage(term_counts(docs, numbers), "search-counts")
    stats = counts.agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("total")).first()
    n_docs, total, n_terms = stats["docs"], stats["total"], len(numbers)
    if not n_docs:
        return None
    df = np.zeros(n_terms)
    for r in counts.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        df[r["term"]] = r["count"]  # a row for each of the block's terms at most
    w = np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df + 1))).astype(np.int64)
    sent = spark.sparkContext.broadcast([(i, [(t, c * int(w[t])) for t, c in terms]) for i, terms in items])
    schema = pa.schema([("item_no", pa.int32()), ("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def run(batches):
        found = [(np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64))] * len(sent.value)
        weights = np.zeros(n_terms, dtype=np.int64)
        for held in _blocks(batches):
            columns = [pa.concat_arrays([b.column(c) for b in held]) for c in range(4)]
            block = _Block(columns, n_docs, n_terms, total)
            for no, (_, item) in enumerate(sent.value):
                at, value = zip(*item, strict=True)
                weights[list(at)] = value
                found[no] = evaluate(block, item, weights, found[no], k)
                weights[list(at)] = 0
        for no, (item_id, _) in enumerate(sent.value):
            score, no_id, ids = found[no]
            if len(score):
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(score), no, np.int32)), pa.array([item_id] * len(score), pa.int64()),
                    pa.array(ids, mask=no_id), pa.array(score)], schema=schema)
    return counts.mapInArrow(run, RESULT)


def search(docs: DataFrame, items: DataFrame, k: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's k best documents."""
    spark = docs.sparkSession
    wanted = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    wanted = cut_lineage(wanted.where("text is not null").distinct(), "search-items")
    n_blocks = 1 + payload_bytes(wanted, ["item_id", "text"]) // ITEM_BYTES
    by_block = wanted.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)))
    parts = []
    for b in range(n_blocks):
        part = _rank_block(docs, by_block.where(F.col("block") == b).orderBy("item_id", "text").collect(), k)
        if part is not None:
            parts.append(part.withColumn("block", F.lit(b)))
    if not parts:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    best = reduce(DataFrame.unionByName, parts).withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    salted = Window.partitionBy("block", "item_no", "salt").orderBy(*order)
    whole = Window.partitionBy("block", "item_no").orderBy(*order)
    best = best.withColumn("rank", F.row_number().over(salted)).where(F.col("rank") <= k)
    best = best.withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= k)
    return best.select("item_id", "rank", "doc_id", "score")
