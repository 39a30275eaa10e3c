"""Substring dedup by hashing the units of lines.

Lines are cut into sentences, so that a passage pasted into the middle of a
line is found too.  A unit is a sentence of at least ``unit_words`` words; a
line without such a sentence is one unit if it has ``min_words`` words.  A
unit is normalised (lower case, runs of white space as one space) and hashed.
Of all units of a digest in the whole table the earliest ranked one --
smallest id, then position -- stays; the others are repeats.  The short
sentences before and behind a unit belong to a repeat where they equal those
around the unit that stays.  Neighbouring repeats of a document form a run;
a run of at least ``min_words`` words is cut from the text, and its offsets
in the original text (code points, end exclusive) are returned with the rest.

With ``whole_lines``, every line that is not blank is a unit too, whatever
its length, under a digest of its own kind: each later occurrence of a line
is cut, by itself or as part of a run.  So ``unit_words`` and ``min_words``
bound only what is cut from inside a line, and passages laid out in short
lines go line by line.

Words are counted at white space; in scripts without spaces two Chinese or
Japanese characters, or four Thai, Lao, Burmese or Khmer ones, count as one
more word, and sentences also end behind the full stops of these scripts.

1. A first pass sends 64-bit unit hashes alone, counted on the map side, to
   find those that occur twice or more.
2. A second pass keeps the units of these hashes, now with 128-bit digests,
   and finds each digest's first occurrence (again combined on the map side).
3. Repeats are gathered by document (no more than its own units) and joined
   to the texts.

Defined cases: a null text is empty; documents repeated with id and text
share a rank, so they keep or lose the same units; a null id ranks first; a
text without repeats comes back unchanged; an empty table gives no rows.
"""

from __future__ import annotations

import re
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, maybe_broadcast
from .common import id_and_text, slices, small_batches

#: Words of a sentence that is a unit, and of a run that is cut.
UNIT_WORDS, MIN_WORDS = 5, 8

#: White space before a capital, or behind the end of a sentence.
BOUNDARY = re.compile(r"\s(?=[A-ZÀ-ÖØ-Þ])|(?<=[.!?])\s")

#: Scripts without spaces: characters that make half a word, a quarter of one.
HALVES = "\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
QUARTERS = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff"
HALF, QUARTER, UNSPACED = (re.compile(f"[{c}]") for c in (HALVES, QUARTERS, HALVES + QUARTERS))
#: Also behind a full stop without a space (and its closing mark), and at
#: the spaces between the phrases of Thai and its like.
UNSPACED_BOUNDARY = re.compile(
    BOUNDARY.pattern + "|(?<=[。｡！？])(?![。｡！？」』”’）])\\s?|(?<=[。｡！？][」』”’）])\\s?"
    + f"|\\s(?=[{QUARTERS}])|(?<=[{QUARTERS}])\\s")

#: Seeds of the digests of sentences and of whole lines.
SENTENCE, LINE = 0, 1


class Unit(NamedTuple):
    """A unit's span and words, and the short sentences around it: where
    those before it start, where those behind it end, and their words."""
    start: int
    end: int
    words: str
    lead_start: int
    lead: str
    tail_end: int
    tail: str


def _spaced(text: str) -> bool:
    try:
        text.encode("latin-1")
        return True
    except UnicodeEncodeError:
        return not UNSPACED.search(text)


def _length(text: str) -> int:
    """Words of a text, in scripts without spaces by its characters."""
    n = len(text.split())
    return n if _spaced(text) else n + len(HALF.findall(text)) // 2 + len(QUARTER.findall(text)) // 4


def _sentences(line: str, offset: int, boundary: re.Pattern = BOUNDARY):
    at = 0
    for m in boundary.finditer(line):
        if m.start() > at:
            yield offset + at, offset + m.start(), line[at:m.start()].lower().split()
        at = m.end()
    yield offset + at, offset + len(line), line[at:].lower().split()


def units(text: str, unit_words: int = UNIT_WORDS, min_words: int = MIN_WORDS) -> list[Unit]:
    out, offset = [], 0
    spaced = _spaced(text)
    boundary = BOUNDARY if spaced else UNSPACED_BOUNDARY
    for line in text.split("\n"):
        parts = [p for p in _sentences(line, offset, boundary) if p[2]] if line else []
        offset += len(line) + 1
        size = [len(p[2]) if spaced else _length(" ".join(p[2])) for p in parts]
        long = [i for i, n in enumerate(size) if n >= unit_words]
        if not long and sum(size) >= min_words:
            parts, long = [(parts[0][0], parts[-1][1], [w for p in parts for w in p[2]])], [0]
        for k, i in enumerate(long):
            before = parts[long[k - 1] + 1 if k else 0:i]
            behind = parts[i + 1:long[k + 1] if k + 1 < len(long) else len(parts)]
            out.append(Unit(
                parts[i][0], parts[i][1], " ".join(parts[i][2]),
                before[0][0] if before else parts[i][0], " ".join(w for p in before for w in p[2]),
                behind[-1][1] if behind else parts[i][1], " ".join(w for p in behind for w in p[2])))
    return out


def lines(text: str) -> list[Unit]:
    """The lines that are not blank, each with nothing around it."""
    out, offset = [], 0
    for line in text.split("\n"):
        end = offset + len(line)
        words = " ".join(line.lower().split())
        if words:
            out.append(Unit(offset, end, words, offset, "", end, ""))
        offset = end + 1
    return out


def _all_units(text: str, unit_words: int, min_words: int, whole_lines: bool):
    """(seed, unit) of the sentences and, if asked for, the whole lines."""
    out = [(SENTENCE, u) for u in units(text, unit_words, min_words)]
    return out + [(LINE, u) for u in lines(text)] if whole_lines else out


def _runs(text: str, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans joined where white space only lies between them."""
    runs = []
    for start, end in sorted(spans):
        if runs and not text[runs[-1][1]:start].strip():
            runs[-1][1] = max(end, runs[-1][1])
        else:
            runs.append([start, end])
    return [(a, b) for a, b in runs]


def cut(text: str, repeats: list[tuple[int, int]], min_words: int = MIN_WORDS,
        whole: list[tuple[int, int]] = ()):
    """The text without its runs of repeats, and the (start, end) cut out;
    between the repeats of a run lies white space only.  ``whole`` are
    repeated lines, which go however short the run is."""
    runs = [(a, b) for a, b in _runs(text, [*repeats, *whole]) if _length(text[a:b]) >= min_words]
    out, kept, at = [], [], 0
    for start, end in _runs(text, [*runs, *whole]):
        kept.append(text[at:start])
        out.append((start, end))
        at = end + (end < len(text))  # the break behind it goes with it
    kept.append(text[at:])
    return "".join(kept), out


def _unit_hashes(rows: DataFrame, *sizes) -> DataFrame:
    schema = pa.schema([("hash", pa.int64())])

    def run(batches):
        import xxhash
        for b in slices(batches):
            out = [xxhash.xxh3_64_intdigest(u.words, seed) - (1 << 63)
                   for t in b.column(0).to_pylist() for seed, u in _all_units(t, *sizes)]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.int64())], schema=schema)
    return rows.select("text").mapInArrow(run, "hash long")


def _units(rows: DataFrame, *sizes) -> DataFrame:
    names = ("doc_id", "text_key", "start", "end", "lead_start", "tail_end", "lead", "tail", "kind", "hash")
    schema = pa.schema([*((n, pa.int64()) for n in names), ("digest", pa.binary())])

    def run(batches):
        from xxhash import xxh3_64_intdigest as short, xxh3_128_digest as full
        for b in slices(batches):
            out = [[] for _ in schema]
            for i, t, k in zip(*(b.column(c).to_pylist() for c in range(3))):
                for seed, u in _all_units(t, *sizes):
                    for column, v in zip(out, (
                            i, k, u.start, u.end, u.lead_start, u.tail_end, short(u.lead) - (1 << 63),
                            short(u.tail) - (1 << 63), seed, short(u.words, seed) - (1 << 63),
                            full(u.words, seed))):
                        column.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema)],
                                             schema=schema)
    return rows.select("doc_id", "text", "text_key").mapInArrow(
        run, ", ".join([*(f"`{n}` long" for n in names), "digest binary"]))


def dedup_units(docs: DataFrame, unit_words: int = UNIT_WORDS, min_words: int = MIN_WORDS,
                id_col: str = "doc_id", text_col: str = "text", whole_lines: bool = False) -> DataFrame:
    """One row per document: ``doc_id``, ``text`` (without repeats),
    ``n_removed`` (runs cut), ``removed_chars`` and ``removed``, the cut
    spans ``start:end`` in the original text, comma-joined."""
    small_batches(docs.sparkSession)
    rows = id_and_text(docs, id_col, text_col).withColumn("text_key", F.xxhash64("text"))
    sizes = unit_words, min_words, whole_lines
    hashes = _unit_hashes(rows, *sizes)
    twice = cut_lineage(hashes.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
                        .select("hash"), "repeated-hashes")
    found = cut_lineage(_units(rows, *sizes).join(maybe_broadcast(twice), "hash", "left_semi")
                        .drop("hash"), "repeated-units")
    first = found.groupBy("digest").agg(
        F.min(F.struct("doc_id", "text_key", "start", "lead", "tail")).alias("first"),
        F.count(F.lit(1)).alias("n"))
    first = cut_lineage(first.where("n > 1").select("digest", "first"), "first-units")
    repeats = found.join(maybe_broadcast(first), "digest").where(
        ~F.struct("doc_id", "text_key", "start").eqNullSafe(
            F.struct("first.doc_id", "first.text_key", "first.start")))
    cuts = repeats.select(
        F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"),
        F.when(F.col("lead") == F.col("first.lead"), F.col("lead_start")).otherwise(F.col("start")).alias("start"),
        F.when(F.col("tail") == F.col("first.tail"), F.col("tail_end")).otherwise(F.col("end")).alias("end"),
        "kind").distinct().groupBy("__id", "__key").agg(F.collect_list(F.struct("start", "end", "kind")).alias("cuts"))
    joined = rows.join(cuts, rows["doc_id"].eqNullSafe(cuts["__id"])
                       & (rows["text_key"] == cuts["__key"]), "left").select("doc_id", "text", "cuts")
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("n_removed", pa.int64()),
                        ("removed_chars", pa.int64()), ("removed", pa.string())])

    def run(batches):
        for b in slices(batches):
            texts, spans = [], []
            for t, c in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                spans_of = [[(x["start"], x["end"]) for x in c or () if x["kind"] == k] for k in (SENTENCE, LINE)]
                t, s = cut(t, spans_of[0], min_words, spans_of[1])
                texts.append(t)
                spans.append(s)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(texts, pa.string()), pa.array(map(len, spans), pa.int64()),
                 pa.array((sum(b - a for a, b in s) for s in spans), pa.int64()),
                 pa.array((",".join(f"{a}:{b}" for a, b in s) for s in spans), pa.string())],
                schema=schema)

    return joined.mapInArrow(
        run, "doc_id long, text string, n_removed long, removed_chars long, removed string")
