"""Near-duplicate join: word n-gram Jaccard with Bayesian candidate pruning.

Documents are sets of five-word shingles (lower-cased words between white
space; a text of fewer words is one shingle).  Two documents are linked when
the Jaccard similarity of their sets is at least ``threshold``.

1. One pass over the texts hashes shingles and reduces each set to a digest
   and ``bands`` keys, each made of ``rows`` MinHash values.  Documents of
   equal digest are copies, and one *class* stands for them from here on.
2. Classes that share a band key belong to one candidate component.  A key
   links its classes to the smallest of them -- a star, not all pairs.
3. The classes of a component meet in blocks of bounded size.  A component of
   one block is compared whole, and so is a larger one, in all pairs of its
   blocks, if its classes share band keys about as densely as that (copies of
   one text do).  In any other larger component, such as a chain of texts
   that share a little with their neighbours, classes meet by band key
   instead, a large key in blocks, and a pair is compared at the first key it
   shares only.  So the work follows the pairs that share a key, not the
   square of a component.
   In a block MinHash values are compared incrementally, ``CHUNK`` at a time.
   With m matches out of n, a uniform prior gives a Beta posterior for the
   similarity; a pair is dropped once the posterior probability of reaching
   the threshold is below ``tolerance``.  The rest are verified exactly on
   their shingle sets.
4. Blocks return link counts and a spanning forest of their links, never
   the pairs; forests of components that took several blocks are merged.

At a similarity of 0.8 a pair shares no band with probability 5e-6 and is
pruned with probability below 16 * ``tolerance``; both fall steeply above.
There is no cap on partners, candidates or block pairs.  Texts are told
apart by 128 bits of hash, shingle sets by their 128-bit digest.

Defined cases: a null text is empty; texts without words form one class with
no links; null and repeated ids get a row each; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, maybe_broadcast
from .common import hand_back, id_and_text, slices, small_batches
from .components import components

NGRAM, THRESHOLD = 5, 0.8
BANDS, ROWS = 40, 6
CHUNK, TOLERANCE = 16, 1e-8
#: Classes and shingles of one block, about.
BLOCK_CLASSES, BLOCK_SHINGLES = 512, 1_000_000
#: A component of several blocks is compared whole if its pairs are at most so
#: many times the pairs that its band keys hold.
DENSE = 4
#: Distinct words whose hashes a task remembers before it starts anew.
MEMO_WORDS = 200_000

_rng = np.random.default_rng(20240229)
_MULTIPLY = _rng.integers(0, 1 << 31, BANDS * ROWS).astype(np.uint32) * np.uint32(2) + np.uint32(1)
_ADD = _rng.integers(0, 1 << 32, BANDS * ROWS).astype(np.uint32)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX2 = np.uint64(0xBF58476D1CE4E5B9)


class _Hashes(dict):
    def __missing__(self, word):
        import xxhash
        h = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return h


_HASHES = _Hashes()


def shingles(text: str, n: int = NGRAM) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word n-grams."""
    if len(_HASHES) > MEMO_WORDS:
        _HASHES.clear()
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    width = min(n, len(h))
    out = np.zeros(len(h) - width + 1, np.uint64)
    for k in range(width):
        out = (out ^ h[k:k + len(out)]) * _MIX
        out ^= out >> np.uint64(29)
    out *= _MIX2
    out ^= out >> np.uint64(32)
    return np.unique(out)


def signature(hashes: np.ndarray) -> np.ndarray:
    low = np.full(len(_ADD), 0xFFFFFFFF, np.uint32)
    h = (hashes >> np.uint64(32)).astype(np.uint32)
    for i in range(0, len(h), 1024):
        np.minimum(low, (h[i:i + 1024, None] * _MULTIPLY + _ADD).min(axis=0), out=low)
    return low


def band_keys(sig: np.ndarray) -> np.ndarray:
    out = np.arange(1, BANDS + 1, dtype=np.uint64) * _MIX2
    for column in sig.reshape(BANDS, ROWS).T:
        out = (out ^ column) * _MIX
        out ^= out >> np.uint64(31)
    return out.astype(np.int64)


def least_matches(threshold: float, tolerance: float) -> np.ndarray:
    """Per number of compared values the least number of matches that keeps
    a pair: with m matches of n and a uniform prior, P(similarity >= t) is
    P(Binomial(n + 1, t) <= m)."""
    out = []
    for n in range(CHUNK, BANDS * ROWS + 1, CHUNK):
        p, m = 0.0, -1
        while m < n:
            m += 1
            p += math.comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
            if p >= tolerance:
                break
        out.append(m)
    return np.array(out)


def block_links(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, copies: np.ndarray,
                threshold: float, tolerance: float, band: int | None = None):
    """Links between the rows in ``left`` and those in ``right`` (the same
    array: all pairs once; with ``band``, only pairs whose first shared band
    key it is).  Returns per row the number of linked classes, of linked
    documents, and its cluster's smallest row."""
    n = len(sets)
    links, docs, parent = np.zeros(n, np.int64), np.zeros(n, np.int64), np.arange(n)

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    sizes = np.array([len(s) for s in sets])
    ends = np.cumsum(sizes)
    starts = ends - sizes
    codes = np.unique(np.concatenate(sets), return_inverse=True)[1] if ends[-1] else np.empty(0, int)
    mark = np.zeros(len(codes) + 1, bool)
    sigs = np.array([signature(s) for s in sets])
    keys = None if band is None else np.array([band_keys(x) for x in sigs])
    least, same = least_matches(threshold, tolerance), left is right
    order = right[np.argsort(sizes[right], kind="stable")]
    ordered = sizes[order]
    place = {int(x): i for i, x in enumerate(order)} if same else None
    for a in left:
        size = sizes[a]
        if not size:
            continue
        lo = np.searchsorted(ordered, math.ceil(threshold * size - 1e-9), "left")
        hi = np.searchsorted(ordered, math.floor(size / threshold + 1e-9), "right")
        if same:  # each pair once: partners behind a in the order of sizes
            lo = max(lo, place[int(a)] + 1)
        live = order[lo:hi]
        live = live[sizes[live] > 0]
        if keys is not None and len(live):
            live = live[keys[a][(keys[live] == keys[a]).argmax(axis=1)] == band]
        matches = np.zeros(len(live), np.int64)
        for i, most in enumerate(least):
            if not len(live):
                break
            part = slice(i * CHUNK, (i + 1) * CHUNK)
            matches += (sigs[live, part] == sigs[a, part]).sum(axis=1)
            keep = matches >= most
            if not keep.all():
                live, matches = live[keep], matches[keep]
        if not len(live):
            continue
        own = codes[starts[a]:ends[a]]
        mark[own] = True
        stop = np.cumsum(sizes[live])
        at = np.repeat(ends[live] - stop, sizes[live]) + np.arange(stop[-1])
        common = np.add.reduceat(mark[codes[at]].astype(np.int64), stop - sizes[live])
        mark[own] = False
        linked = live[common >= threshold * (size + sizes[live] - common) - 1e-9]
        links[a] += len(linked)
        docs[a] += copies[linked].sum()
        links[linked] += 1
        docs[linked] += copies[a]
        for b in linked:
            x, y = root(a), root(b)
            if x != y:
                parent[max(x, y)] = min(x, y)
    return links, docs, np.array([root(x) for x in range(n)])


def text_key(text: Column) -> Column:
    return F.xxhash64(text)


def _digests(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, digest (16 bytes), n (shingles), bands."""
    schema = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("digest", pa.binary()),
                        ("n", pa.int64()), ("bands", pa.list_(pa.int64()))])

    def run(batches):
        import xxhash
        for b in slices(batches):
            digest, n, bands = [], [], []
            for t in b.column(1).to_pylist():
                s = shingles(t)
                digest.append(xxhash.xxh3_128_digest(s.tobytes()))
                n.append(len(s))
                bands.append(band_keys(signature(s)) if len(s) else [])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array(digest, pa.binary()), pa.array(n, pa.int64()),
                 pa.array(bands, pa.list_(pa.int64()))], schema=schema)
        _HASHES.clear()
        hand_back()

    return docs.select("doc_id", "text", text_key(F.col("text")).alias("text_key")).mapInArrow(
        run, "doc_id long, text_key long, digest binary, n long, bands array<long>")


def _sets(texts: DataFrame) -> DataFrame:
    """digest and shingle set (binary) of each text."""
    schema = pa.schema([("digest", pa.binary()), ("shingles", pa.binary())])

    def run(batches):
        import xxhash
        for b in slices(batches):
            sets = [shingles(t).tobytes() for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([xxhash.xxh3_128_digest(s) for s in sets], pa.binary()),
                 pa.array(sets, pa.binary())], schema=schema)
        _HASHES.clear()
        hand_back()

    return texts.select("text").mapInArrow(run, "digest binary, shingles binary")


def _candidates(classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The classes that share a band key with another one, with their
    ``component`` and the keys they share (``shared``); and the keys of two
    classes and more: (band, least, size).  Classes go by a 64-bit key here;
    two classes of one key would only meet in a component."""
    bands = classes.select("class_key", F.explode("bands").alias("band"))
    shared = cut_lineage(
        bands.groupBy("band").agg(F.min("class_key").alias("least"), F.max("class_key").alias("most"),
                                  F.count(F.lit(1)).alias("size"))
        .where("least < most").select("band", "least", "size"), "band-stars")
    edges = bands.join(maybe_broadcast(shared), "band").select("class_key", "least")
    roots = components(edges, "class_key", "least")
    nodes = roots.select(F.col("u").alias("class_key"), F.col("v").alias("component")).unionByName(
        roots.select(F.col("v").alias("class_key"), F.col("v").alias("component")).distinct())
    return classes.join(maybe_broadcast(nodes), "class_key"), shared


def _blocks(members: DataFrame, shared: DataFrame) -> DataFrame:
    """Members once for each pair of blocks they take part in: blocks of
    their component (``band`` null) or of a band key."""
    width = F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_CLASSES), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int")
    size = cut_lineage(members.groupBy("component").agg(F.count(F.lit(1)).alias("classes"), width.alias("blocks"))
                       .where("blocks > 1"), "large-components")
    narrow = members.select("class_key", "digest", "component", "copies", "n")
    if size.isEmpty():
        large = None
    else:
        of_key = members.select(F.col("class_key").alias("least"), "component")
        pairs = (shared.join(of_key.join(maybe_broadcast(size.select("component")), "component"), "least")
                 .groupBy("component").agg(F.sum(F.col("size").cast("double") * F.col("size")).alias("pairs")))
        large = cut_lineage(size.join(pairs, "component").select(
            "component", "blocks",
            (F.col("classes").cast("double") * F.col("classes") > DENSE * F.col("pairs")).alias("by_band")),
            "component-modes")
        narrow = narrow.join(maybe_broadcast(large), "component", "left")
    if large is None:
        whole = narrow.withColumn("blocks", F.lit(1))
    else:
        whole = narrow.where("not coalesce(by_band, false)").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    whole = whole.select("digest", "copies", "component", F.lit(None).cast("long").alias("band"), "blocks",
                         F.col("blocks").alias("parts"))
    if large is not None and not large.where("by_band").isEmpty():
        # classes meet by band key; their forests are merged like those of several blocks
        chosen = members.join(maybe_broadcast(large.where("by_band").select("component")), "component", "left_semi")
        held = cut_lineage(chosen.select("digest", "copies", "n", F.explode("bands").alias("band"))
                           .join(maybe_broadcast(shared.select("band")), "band", "left_semi"), "band-members")
        parts = held.groupBy("band").agg(width.alias("parts"))
        by_band = held.join(maybe_broadcast(parts), "band").select(
            "digest", "copies", F.lit(None).cast("long").alias("component"), "band", F.lit(2).alias("blocks"), "parts")
        whole = whole.unionByName(by_band)
    block = F.when(F.col("parts") == 1, F.lit(0)).otherwise(F.pmod(F.xxhash64("digest"), F.col("parts"))).cast("int")
    return (whole.withColumn("block", block)
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
            .withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
            .select("digest", "component", "band", "i", "j", "block", "blocks", "copies"))


def _verify(rows: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    schema = pa.schema([("digest", pa.binary()), ("links", pa.int64()), ("linked_docs", pa.int64()),
                        ("root", pa.binary()), ("blocks", pa.int32())])

    def run(table: pa.Table) -> pa.Table:
        digest = table["digest"].to_pylist()
        sets = [np.frombuffer(x, np.uint64) for x in table["shingles"].to_pylist()]
        block, (i, j) = table["block"].to_numpy(), (table["i"][0].as_py(), table["j"][0].as_py())
        left = np.flatnonzero(block == i)
        right = left if i == j else np.flatnonzero(block == j)
        links, docs, root = block_links(sets, left, right, table["copies"].to_numpy(),
                                        threshold, tolerance, table["band"][0].as_py())
        return pa.table([pa.array(digest, pa.binary()), pa.array(links), pa.array(docs),
                         pa.array([digest[r] for r in root], pa.binary()), table["blocks"]],
                        schema=schema)

    return rows.groupBy("component", "band", "i", "j").applyInArrow(
        run, "digest binary, links long, linked_docs long, root binary, blocks int")


def _assign(docs: DataFrame, threshold: float, tolerance: float, id_col: str,
            text_col: str) -> DataFrame:
    """The columns of ``join`` per row, with the text's hash ``text_key`` and
    the class's key ``root``."""
    small_batches(docs.sparkSession)
    rows = id_and_text(docs, id_col, text_col)
    hashed = cut_lineage(_digests(rows), "shingle-digests")
    class_key = F.conv(F.substring(F.hex("digest"), 1, 15), 16, 10).cast("long")
    # the map side keeps one row a digest, so a group of copies is no hot key
    counted = hashed.groupBy("digest").agg(
        F.min("doc_id").alias("set_id"), F.count(F.lit(1)).alias("copies"),
        F.max("n").alias("n"), F.min("text_key").alias("text_key"))
    bands = hashed.where("n > 0").select("digest", "bands").dropDuplicates(["digest"])
    classes = cut_lineage(counted.join(bands, "digest").withColumn("class_key", class_key), "classes")

    members, shared = _candidates(classes)
    members = cut_lineage(members, "members")
    keys = maybe_broadcast(members.select("text_key").distinct())
    # texts of one key stay apart by the second hash, and a digest counts once
    texts = (rows.select("text", text_key(F.col("text")).alias("text_key"),
                         F.xxhash64(F.lit(1), "text").alias("second")).join(keys, "text_key", "left_semi")
             .dropDuplicates(["text_key", "second"]))
    sets = cut_lineage(_sets(texts), "shingle-sets").dropDuplicates(["digest"])
    verified = cut_lineage(_verify(_blocks(members, shared).join(sets, "digest"), threshold, tolerance), "links")

    linked = verified.groupBy("digest").agg(F.sum("links").alias("n_links"),
                                            F.sum("linked_docs").alias("n_linked_docs"))
    alone = verified.where("blocks = 1").select("digest", "root")
    merged = components(verified.where("blocks > 1"), "digest", "root")
    roots = alone.unionByName(merged.select(F.col("u").alias("digest"), F.col("v").alias("root")))

    info = (counted.select("digest", "set_id", "copies").join(linked, "digest", "left")
            .join(roots, "digest", "left").withColumn("root", F.coalesce("root", "digest")))
    info = cut_lineage(info, "class-info")
    least = info.groupBy("root").agg(F.min("set_id").alias("class_id"))
    info = info.join(least, "root").select(
        "digest", "root", "class_id", "set_id", F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("n_linked_docs", F.lit(0)).alias("n_linked_docs"), F.col("copies").alias("n_copies"))
    return hashed.select("doc_id", "text_key", "digest").join(info, "digest").drop("digest")


def join(docs: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id``; ``class_id``, the smallest id among
    the documents it is connected with by links or as a copy; ``set_id``, the
    smallest id among its copies (equal shingle sets); ``n_links``, the
    number of other shingle sets linked to its own; ``n_linked_docs``, the
    documents that hold these; ``n_copies`` (itself included)."""
    return _assign(docs, threshold, tolerance, id_col, text_col).drop("text_key", "root")


def keep_one(docs: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs``, all columns, with one document of each class: the one of
    the smallest id (null only when the class has no other; of several rows
    with that id the one of the smallest text hash, of repeated rows any)."""
    found = cut_lineage(_assign(docs, threshold, tolerance, id_col, text_col)
                        .select("doc_id", "text_key", "root", "class_id"), "near-classes")
    stays = F.col("doc_id").eqNullSafe(F.col("class_id"))
    several = (found.where(stays).groupBy("root").agg(
        F.count(F.lit(1)).alias("n"), F.min("text_key").alias("best")).where("n > 1"))
    key = text_key(F.coalesce(docs[text_col], F.lit("")))

    def matches(side: DataFrame):
        return docs[id_col].cast("long").eqNullSafe(side["__id"]) & (key == side["__key"])

    def keys(rows: DataFrame) -> DataFrame:
        return maybe_broadcast(rows.select(F.col("doc_id").alias("__id"),
                                           F.col("text_key").alias("__key")).distinct())

    losers = found.where(~stays).select("doc_id", "text_key")
    repeated = not several.isEmpty()
    if repeated:
        rivals = found.where(stays).join(several, "root")
        losers = losers.unionByName(rivals.where("text_key <> best").select("doc_id", "text_key"))
    losers = keys(losers)
    kept = docs.join(losers, matches(losers), "left_anti")
    if not repeated:
        return kept
    again = keys(rivals.where("text_key = best"))
    return kept.join(again, matches(again), "left_anti").unionByName(
        kept.join(again, matches(again), "left_semi").withColumn("__key", key)
        .dropDuplicates([id_col, "__key"]).drop("__key"))
