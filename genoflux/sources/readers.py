"""Scans: NDJSON, FASTA, TSV, rule lines, alignment template, line lists,
fingerprint and diff tables, versioned snapshots.

Every reader declares its schema (no inference) and fails fast on malformed
input.  Compressed inputs are decoded by extension (``.zst``, ``.gz``,
``.bz2``); ``.xz`` has no Hadoop codec and must be landed first.
"""

from __future__ import annotations

import csv
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.location import json_path
from ..functions.text import not_blank
from ..operators.georules import parse_rules
from ..operators.zipjoin import with_file_ordinal
from ..session import cut_lineage, maybe_broadcast
from .archive import read_snapshot  # noqa: F401
from .tsv import read_tsv_records  # noqa: F401

FEED_SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in (
    "covv_accession_id", "covv_virus_name", "covv_collection_date", "covv_subm_date",
    "covv_host", "covv_patient_age", "covv_gender", "covv_sampling_strategy",
    "covv_lineage", "covv_location", "sequence")])

TEMPLATE_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("nucleotideSequences", T.MapType(T.StringType(), T.StringType())),
    T.StructField("aminoAcidSequences", T.MapType(T.StringType(), T.StringType())),
])


def read_ndjson(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str,
                ordinal: str | None = None) -> DataFrame:
    """One JSON object per line, explicit schema, FAILFAST."""
    df = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    return with_file_ordinal(df, ordinal) if ordinal else df


def read_fasta(spark: SparkSession, path: str | Sequence[str], id_col: str = "sample_name",
               ordinal: str | None = None, preamble: str = "error") -> DataFrame:
    """FASTA records ``(id, sequence)``.

    The header is the whole first line after ``>`` (description kept, not
    trimmed); the sequence is the following non-blank lines concatenated
    untrimmed; an empty sequence is allowed.  Records are cut by Hadoop's
    record reader on the separator ``\\n>``, so one large file splits across
    many tasks with no driver involvement; within a record a line ends at
    ``\\n``, ``\\r\\n`` or a lone ``\\r`` (a lone one before a header fails).

    ``\\n``, ``\\r\\n`` or a lone ``\\r``, also before a header.

    The separator consumes the ``>`` of every record but a file's first; each
    file's first record is found by a narrow pass (one row per file).  Blank
    lines before it are skipped.  Text before the first header fails the job
    (``preamble='error'``) or is put before the first record's sequence
    (``'prepend'``).
    """
    if preamble not in ("error", "prepend"):
        raise ValueError(f"preamble must be 'error' or 'prepend', not {preamble!r}")
    raw = with_file_ordinal(spark.read.option("lineSep", "\n>").text(path), "_o")
    # a header behind a lone carriage return starts a record too
    raw = raw.select(F.posexplode(F.split("value", "\r>")).alias("_k", "value"), "_o").select("value", F.struct(
        "_o.f", "_o.b", "_o.i", F.col("_k").alias("k")).alias("_o"))
    keep = [F.col("_o").alias(ordinal)] if ordinal else []
    firsts = maybe_broadcast(raw.where(F.col("_o.b") == 0).groupBy(F.col("_o.f").alias("_f"))
                             .agg(F.min(F.struct("_o.i", "_o.k")).alias("_i0")))
    rec = raw.join(firsts, raw["_o.f"] == firsts["_f"], "left")
    is_first = F.coalesce((F.col("_o.b") == 0) & (F.struct("_o.i", "_o.k") == F.col("_i0")), F.lit(False))
    rec = rec.select("_o", F.split("value", "\r\n|\n|\r").alias("_lines"), is_first.alias("_first"),
                     (is_first & ~F.col("value").startswith(">")).alias("_pre"))
    rec = rec.where(~(F.col("_pre") & F.forall("_lines", lambda x: ~not_blank(x))))
    lines = F.col("_lines")
    head = F.get(lines, 0)
    header = F.when(F.col("_first"), F.substr(head, F.lit(2))).otherwise(head)
    body = F.array_join(F.filter(F.slice(lines, 2, F.size(lines)), not_blank), "")
    if preamble == "error":
        header = F.when(F.col("_pre"), F.raise_error(F.concat(
            F.lit("text before the first FASTA header in "), F.col("_o.f"))).cast("string")
        ).otherwise(header)
        return rec.select(header.alias(id_col), body.alias("sequence"), *keep)
    # The preamble chunk holds no header: all its non-blank lines are text
    # for the file's next record (one row per such file).
    pre_text = F.array_join(F.filter(lines, not_blank), "")
    pre = rec.where("_pre").select(F.col("_o.f").alias("_pf"), pre_text.alias("_ptext"))
    nxt = (rec.where(~F.col("_first")).groupBy(F.col("_o.f").alias("_nf"))
           .agg(F.min("_o").alias("_no")))
    target = maybe_broadcast(pre.join(nxt, pre["_pf"] == nxt["_nf"]).select("_pf", "_no", "_ptext"))
    out = rec.where(~F.col("_pre")).join(
        target, (F.col("_o.f") == F.col("_pf")) & (F.col("_o") == F.col("_no")), "left")
    seq = F.concat(F.coalesce(F.col("_ptext"), F.lit("")), body)
    return out.select(header.alias(id_col), seq.alias("sequence"), *keep)


def _tsv_cells(line: str) -> list[str]:
    return [h.strip() for h in next(csv.reader([line.rstrip("\r")], delimiter="\t"), [])]


def read_tsv(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str] | None = None,
             ordinal: str | None = None) -> DataFrame:
    """Tab-separated text with a header row; every value a string; quoted
    cells honoured; surrounding spaces stripped; empty cells read as ``""``.
    A ragged row fails the job -- fewer cells than the header, as in the
    record semantics, and also more cells (stricter: those would otherwise be
    dropped silently).  A header naming a column twice keeps the *last*
    such column (cells are mapped by position, then the last position of each
    name wins).  Every file must have the same header, or the job fails: the
    scan compares each file's header with the expected names (a header with a
    repeated name is compared by a pass over the files' first lines).
    ``columns`` gives the names up front; otherwise the first line is read
    (one row) to learn them."""
    if columns is None:
        first = spark.read.text(path).first()
        columns = [] if first is None else _tsv_cells(first["value"])
    columns = list(columns)
    unique = len({c.lower() for c in columns}) == len(columns)
    names = columns if unique else [f"_c{i}" for i in range(len(columns))]
    reader = (spark.read.option("sep", "\t").option("header", True).option("quote", '"')
              .option("escape", '"').option("ignoreLeadingWhiteSpace", True)
              .option("ignoreTrailingWhiteSpace", True).option("mode", "FAILFAST")
              .option("emptyValue", "").option("enforceSchema", not unique)
              .schema(T.StructType([T.StructField(c, T.StringType()) for c in names])))
    df = reader.csv(path)
    if not unique:
        lines = with_file_ordinal(spark.read.text(path), "_o").where(F.col("_o.b") == 0)
        heads = lines.groupBy("_o.f").agg(F.min_by("value", "_o").alias("head")).select(
            F.regexp_replace("head", r"\s+$", "").alias("head")).distinct()
        if heads.count() > 1:
            raise ValueError(f"the files under {path} do not share one header")
    if ordinal:
        df = with_file_ordinal(df, ordinal)
    last = {name: i for i, name in enumerate(columns)}  # later positions overwrite
    picked = [F.coalesce(F.col(f"`{names[i]}`"), F.lit("")).alias(name)
              for name, i in sorted(last.items(), key=lambda kv: kv[1])]
    if not picked:
        return df
    return df.select(*picked, *([F.col(ordinal)] if ordinal else []))


def read_lines(spark: SparkSession, path: str | Sequence[str], ordinal: str | None = None) -> DataFrame:
    df = spark.read.text(path)
    return with_file_ordinal(df, ordinal) if ordinal else df


def read_geo_rules(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Rule file ``left<TAB>right`` -> parsed, validated, last-wins rules."""
    lines = read_lines(spark, path, "ordinal")
    return parse_rules(lines, "value", "ordinal")


def read_template(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Alignment template JSON: an object with two name -> sequence maps --
    one pretty-printed object per file (``multi_line=True``) or one object
    per line (many templates, split across tasks)."""
    return spark.read.schema(TEMPLATE_SCHEMA).option("multiLine", multi_line).option(
        "mode", "FAILFAST").json(path)


def template_lengths(template: DataFrame, keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """``(name, length)`` tables for nucleotide and amino-acid templates
    (``keep``: template columns carried along, e.g. an id)."""
    nuc = template.select(*keep, F.explode("nucleotideSequences").alias("name", "seq")).select(
        *keep, "name", F.length("seq").alias("length"))
    aa = template.select(*keep, F.explode("aminoAcidSequences").alias("name", "seq")).select(
        *keep, "name", F.length("seq").alias("length"))
    return nuc, aa


def template_names(template: DataFrame) -> tuple[dict[str, int], dict[str, int]]:
    """``{name: length}`` of the nucleotide and amino-acid sequences of an
    alignment template, which is one record (a name per segment or gene)."""
    nuc, aa = template_lengths(template)
    if len(template.limit(2).collect()) != 1:
        raise ValueError("an alignment template is exactly one record")
    return tuple({r["name"]: r["length"] for r in t.collect()} for t in (nuc, aa))


def read_line_list(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """One value per line -> distinct non-empty values."""
    return spark.read.text(path).where(F.col("value") != "").distinct()


def read_hashes(spark: SparkSession, path: str, id_col: str = "gisaidEpiIsl",
                fmt: str = "parquet") -> DataFrame:
    """Fingerprint table -> ``(id, md5)``."""
    df = spark.read.format(fmt).load(path) if fmt != "json" else spark.read.schema(
        f"`{id_col}` string, md5 string").json(path)
    return df.select(F.col(f"`{id_col}`").cast("string").alias("id"), F.col("md5"))


DIFF_PARTS = ("added", "changed", "deleted", "unchanged")


def read_diff(spark: SparkSession, path: str, legacy: bool = False) -> DataFrame:
    """Diff as the long ``(id, status)`` table; ``legacy=True`` reads one JSON
    object of four id arrays a file.

    The object is scanned as a stream: the text is cut at its quotes, in as
    many tasks as it has splits.  A narrow row a split (its number of pieces)
    gives each piece its place in the file; strings are the pieces at odd
    places.  The names of the arrays are the strings before a colon, four a
    file, so a string's array is the last name before its place.  (Ids with
    an escaped quote leave no such parity; such a file is parsed whole.)"""
    if not legacy:
        return spark.read.parquet(path).select("id", "status")
    pieces = with_file_ordinal(spark.read.option("lineSep", '"').text(path), "_o").select(
        "value", F.col("_o.f").alias("f"), F.col("_o.b").alias("b"), F.col("_o.i").alias("i"))
    splits = pieces.groupBy("f", "b").agg(F.min("i").alias("first"), F.count(F.lit(1)).alias("n"),
                                          F.bool_or(F.col("value").endswith("\\")).alias("escaped"))
    splits = cut_lineage(splits, "diff-splits")
    if not splits.where("escaped").isEmpty():
        return _read_diff_objects(spark, path)
    before = Window.partitionBy("f").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    splits = maybe_broadcast(splits.select(
        F.col("f").alias("sf"), F.col("b").alias("sb"), "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("off")))
    placed = pieces.join(splits, (F.col("f") == F.col("sf")) & (F.col("b") == F.col("sb"))).select(
        "f", (F.col("off") + F.col("i") - F.col("first")).alias("place"), "value")
    strings = placed.where("place % 2 = 1")
    colons = placed.where((F.col("place") % 2 == 0) & F.col("value").contains(":")).select(
        F.col("f").alias("cf"), (F.col("place") - 1).alias("at"))
    names = strings.join(maybe_broadcast(colons), (F.col("f") == F.col("cf")) & (F.col("place") == F.col("at"))).select(
        "f", "value", "place")
    names = cut_lineage(names, "diff-names")  # four a file
    unknown = names.where(~F.col("value").isin(*DIFF_PARTS)).first()
    if unknown is not None:
        raise ValueError(f"a diff object has no array {unknown['value']!r}")
    of_file = names.groupBy(F.col("f").alias("nf")).agg(F.array_sort(F.collect_list(F.struct("place", "value"))).alias("names"))
    held = strings.join(maybe_broadcast(of_file), F.col("f") == F.col("nf"))
    upto = F.filter("names", lambda x: x["place"] <= F.col("place"))
    last = F.element_at(upto, -1)
    text = F.when(F.col("value").contains("\\"), F.get(F.from_json(
        F.concat(F.lit('["'), "value", F.lit('"]')), "array<string>"), 0)).otherwise(F.col("value"))
    return held.where(last["place"] < F.col("place")).select(text.alias("id"), last["value"].alias("status"))


def _read_diff_objects(spark: SparkSession, path: str) -> DataFrame:
    obj = spark.read.schema(", ".join(f"{p} array<string>" for p in DIFF_PARTS)).option("multiLine", True).json(path)
    parts = F.array(*[F.struct(F.col(p).alias("ids"), F.lit(p).alias("status")) for p in DIFF_PARTS])
    each = obj.select(F.explode(parts).alias("part"))
    return each.select(F.explode("part.ids").alias("id"), F.col("part.status").alias("status"))


def dataset_version(listing: DataFrame, col: str = "value") -> DataFrame:
    """The first array element's ``version.tag`` of a dataset listing JSON."""
    return listing.select(json_path(F.col(col), "$[0].version.tag").alias("version"))


def read_translations(spark: SparkSession, paths: Mapping[str, str],
                      ordinal: str = "ordinal") -> DataFrame:
    """One FASTA per gene -> one long table ``(gene, sample_name, sequence)``
    by ``unionByName`` (each gene one scan; no join per gene)."""
    frames = [read_fasta(spark, p, ordinal=ordinal).withColumn("gene", F.lit(g))
              for g, p in paths.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
