"""Token counts by offset-mapped attribution.

A document is encoded once, whole.  The vocabulary is byte-level: its tokens
put together are the UTF-8 bytes of the text, so token spans are the running
sum of token lengths.  They are interval-joined to the sections of the
document by binary search on the sorted section bounds.

Allocation rule: a token belongs to the section it shares most bytes with,
the earlier one of equals.  A token that touches no section (the break
between two) belongs to the last section that starts before it ends, the
first section if there is none.  So the counts of a document's sections sum
to the tokens of the document.

Sections come from the lines of the text, from given spans (code points, end
exclusive, disjoint), or from several text columns put together.

Defined cases: a null text is empty; an empty text has one empty section and
no tokens; a document without given sections, or with null or empty spans
only, is one section as a whole; equal spans are one, spans that overlap fail
the job; null and repeated ids are counted row by
row; an empty table gives no rows.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, slices, small_batches

SCHEMA = ("doc_id long, section long, start long, end long, n_tokens long, n_crossing long, "
          "doc_tokens long")
ARROW = pa.schema([(c, pa.int64()) for c in (
    "doc_id", "section", "start", "end", "n_tokens", "n_crossing", "doc_tokens")])


class ByteEncoder:
    """Token byte lengths of a text under a rank file."""

    def __init__(self, path: str, pattern: str):
        import tiktoken
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks,
                                          special_tokens={})
        self.lengths = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, i in ranks.items():
            self.lengths[i] = len(token)

    def ends(self, text: str) -> np.ndarray:
        ids = self.encoding.encode_to_numpy(text, disallowed_special=())
        return np.cumsum(self.lengths[ids])


_ENCODERS: dict[str, ByteEncoder] = {}


def encoder(path: str, pattern: str) -> ByteEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = ByteEncoder(path, pattern)
    return _ENCODERS[path]


def allocate(ends: np.ndarray, first: np.ndarray, last: np.ndarray):
    """Tokens and crossing tokens per section.  ``ends``: token ends;
    ``first`` and ``last``: bounds of the sections, disjoint and in order
    (all in bytes)."""
    k = len(first)
    starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    lo = np.searchsorted(last, starts, "right")     # first section that ends behind the start
    hi = np.searchsorted(first, ends, "left") - 1   # last section that starts before the end
    owner = np.clip(hi, 0, k - 1)
    crossing = np.zeros(len(ends), bool)
    for t in np.flatnonzero(lo < hi):
        shared = np.minimum(last[lo[t]:hi[t] + 1], ends[t]) - np.maximum(first[lo[t]:hi[t] + 1], starts[t])
        owner[t] = lo[t] + int(np.argmax(shared))
        crossing[t] = (shared > 0).sum() > 1
    return (np.bincount(owner, minlength=k),
            np.bincount(owner[crossing], minlength=k))


def count(text: str, spans: list[tuple[int, int]] | None, encode: ByteEncoder):
    """(starts, ends, tokens, crossing tokens, tokens of the document) of the
    sections; ``spans`` None: the lines."""
    data = np.frombuffer(text.encode(), np.uint8)
    ends = encode.ends(text)
    heads = None if len(data) == len(text) else np.flatnonzero((data & 0xC0) != 0x80)
    if spans is None:
        breaks = np.flatnonzero(data == 10)
        first = np.concatenate([[0], breaks + 1])
        last = np.concatenate([breaks, [len(data)]])
        if heads is None:
            a, b = first, last
        else:
            a, b = np.searchsorted(heads, first), np.searchsorted(heads, last)
    else:
        spans = np.array(sorted(set(spans)) or [(0, len(text))], np.int64)
        a, b = np.clip(spans.T, 0, len(text))
        if (a[1:] < b[:-1]).any():
            raise ValueError("sections of a document overlap: their tokens would count twice")
        at = np.arange(len(data) + 1) if heads is None else np.append(heads, len(data))
        first, last = at[a], at[b]
    tokens, crossing = allocate(ends, first, last)
    return a, b, tokens, crossing, len(ends)


def _run(rows: DataFrame, path: str, pattern: str, given: bool) -> DataFrame:
    small_batches(rows.sparkSession)

    def run(batches):
        encode = encoder(path, pattern)
        for b in slices(batches, limit=1_000_000):
            columns = [[] for _ in ARROW]
            spans = b.column(2).to_pylist() if given else [None] * b.num_rows
            for i, t, s in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), spans):
                if given:
                    s = [(x["start"], x["end"]) for x in s or () if x["start"] < x["end"]]
                start, end, tokens, crossing, total = count(t, s, encode)
                n = len(start)
                for c, v in zip(columns, (
                        [i] * n, range(n), start.tolist(), end.tolist(), tokens.tolist(),
                        crossing.tolist(), [total] * n)):
                    c.extend(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=ARROW)
    return rows.mapInArrow(run, SCHEMA)


def count_lines(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """A row per line of each document: ``section`` (from 0), ``start``,
    ``end`` (code points), ``n_tokens`` allocated to it, ``n_crossing`` (of
    these, tokens that other sections share), ``doc_tokens``."""
    return _run(id_and_text(docs, id_col, text_col), path, pattern, given=False)


def count_sections(docs: DataFrame, sections: DataFrame, path: str, pattern: str,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As ``count_lines`` for ``sections`` (``doc_id, start, end``; numbered
    in the order of their starts within a document)."""
    spans = (sections.where("start is not null and end is not null").groupBy(
        F.col("doc_id").cast("long").alias("__id"))
        .agg(F.collect_list(F.struct("start", "end")).alias("spans")))
    rows = id_and_text(docs, id_col, text_col)
    rows = rows.join(spans, rows["doc_id"].eqNullSafe(spans["__id"]), "left")
    return _run(rows.select("doc_id", "text", "spans"), path, pattern, given=True)


def count_fields(docs: DataFrame, fields: list[str], path: str, pattern: str,
                 separator: str = "\n", id_col: str = "doc_id") -> DataFrame:
    """As ``count_lines`` for text columns put together with ``separator``
    and encoded as one document; a section per column that is not empty."""
    texts = F.array(*[F.coalesce(docs[f].cast("string"), F.lit("")) for f in fields])
    texts = F.filter(texts, lambda t: t != "")
    span = F.aggregate(
        texts, F.expr("array(struct(bigint(0) AS start, bigint(0) AS end))"),
        lambda acc, t: F.concat(acc, F.array(F.struct(
            F.when(F.size(acc) > 1, F.element_at(acc, -1)["end"] + len(separator))
            .otherwise(F.lit(0).cast("long")).alias("start"),
            (F.when(F.size(acc) > 1, F.element_at(acc, -1)["end"] + len(separator))
             .otherwise(F.lit(0).cast("long")) + F.length(t)).alias("end")))))
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"),
                       F.array_join(texts, separator).alias("text"),
                       F.slice(span, 2, F.greatest(F.size(span) - 1, F.lit(1))).alias("spans"))
    return _run(rows, path, pattern, given=True)
