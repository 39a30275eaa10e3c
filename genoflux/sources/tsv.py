"""TSV with quoted line breaks, as a segmented scan over lines.

A line on its own does not tell whether it starts inside a quoted cell, but it
tells what becomes of either case: each line is a function of two states.  In
a split those functions are composed in line order; one narrow row a split is
then composed over the file, so the state at the start of every split, and
with it of every line, is known without any task reading a file as a whole.
A record is a line that starts outside quotes and the lines that continue it.

A pass over the lines first looks for such continued lines.  Where there are
none -- the usual file -- a line is a record and nothing is shuffled; only
files that have some go through the scan.

Cells: tab-separated; a cell whose first character besides white space is a
quote runs to the closing quote, a doubled quote inside standing for one; a
quote elsewhere is itself.  White space around cells is stripped, inside
quotes it stays; a line break in a cell is read as ``\\n``.  Empty lines are
skipped.  A file's first record names its columns; cells are bound by the
file's own header (of a repeated name the last cell counts), cells beyond it
are ignored, a row with fewer fails the job, and so does text behind a
closing quote or a quote that is never closed.  A column that a file does not have is null in its rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.zipjoin import with_file_ordinal
from ..session import cut_lineage, maybe_broadcast

# States at a point of a record: at the start of a cell or behind its blanks,
# in an unquoted cell, in a quoted one, behind a quote within a quoted one.
START, TEXT, QUOTED, QUOTE = 0, 1, 2, 3
# Characters that no text holds (Unicode noncharacters) mark what the scan has
# found: between cells, at an opening quote, at a closing one.
CELL, OPEN, CLOSE = "﷐", "﷑", "﷒"
# White space around cells (fixed values: Java's isWhitespace, the tab apart).
BLANKS = "\n\u000b\f\r\u001c\u001d\u001e\u001f  " + "".join(
    chr(c) for c in (*range(0x2000, 0x2007), 0x2008, 0x2009, 0x200A, 0x2028, 0x2029, 0x205F, 0x3000))


def _blank(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANKS)) == ""


def _behind(state: Column, text: Column) -> Column:
    """The state behind ``text``, which holds no quote."""
    last = F.substring_index(text, "\t", -1)
    outside = F.when(text.contains("\t") | (state == START), F.when(_blank(last), START).otherwise(TEXT)).otherwise(TEXT)
    return F.when((text == "") | (state == QUOTED), state).otherwise(outside)


def _on_quote(state: Column) -> Column:
    return F.when(state == START, QUOTED).when(state == TEXT, TEXT).when(state == QUOTED, QUOTE).otherwise(QUOTED)


def _ends_quoted(line: Column, start: int) -> Column:
    """Whether a line that starts in state ``start`` ends inside quotes."""
    pieces = F.split(line, '"')
    first = _behind(F.lit(start), F.get(pieces, 0))
    end = F.aggregate(F.slice(pieces, 2, F.size(pieces)), first, lambda s, p: _behind(_on_quote(s), p))
    return end == QUOTED


def cells(record: Column) -> Column:
    """The cells of a whole record."""
    pieces = F.split(record, '"')
    first = _behind(F.lit(START), F.get(pieces, 0))
    # the state before each quote and in the piece behind it
    steps = F.aggregate(
        F.slice(pieces, 2, F.size(pieces)),
        F.struct(first.alias("end"), F.array(F.struct(F.lit(-1).alias("before"), F.lit(START).alias("inside"))).alias("all")),
        lambda s, p: F.struct(
            _behind(_on_quote(s["end"]), p).alias("end"),
            F.concat(s["all"], F.array(F.struct(s["end"].alias("before"), _on_quote(s["end"]).alias("inside")))).alias("all")),
        lambda s: s["all"])

    def mark(p, s):
        text = F.when(s["inside"] == QUOTED, p).otherwise(F.replace(p, F.lit("\t"), F.lit(CELL)))
        quote = F.when(s["before"] == START, F.lit(OPEN)).when(s["before"].isin(QUOTED, QUOTE), F.lit(CLOSE)).when(
            s["before"] == TEXT, F.lit('"')).otherwise(F.lit(""))
        return F.concat(quote, text)
    marked = F.array_join(F.zip_with(pieces, steps, mark), "")
    # a doubled quote within quotes is marked twice
    marked = F.replace(marked, F.lit(CLOSE + CLOSE), F.lit('"'))

    def value(cell):
        opened = F.instr(cell, OPEN)
        inner = F.substring_index(F.substring(cell, opened + 1, F.length(cell)), CLOSE, 1)
        behind = F.substring_index(cell, CLOSE, -1)
        bad = cell.contains(CLOSE) & ~_blank(behind)
        open_ = ~cell.contains(CLOSE)
        return F.when(opened == 0, F.btrim(cell, F.lit(BLANKS))).when(
            open_, F.raise_error(F.lit("a quoted cell is not closed")).cast("string")).when(
            bad, F.raise_error(F.lit("text behind a closing quote")).cast("string")).otherwise(inner)
    return F.transform(F.split(marked, CELL), value)


def _scanned(lines: DataFrame) -> DataFrame:
    """(_o, record) of files with continued lines, from (_o, value, out, in_):
    the line's end state by its start state."""
    in_split = Window.partitionBy("_f", "_b").orderBy("_o")
    upto = in_split.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = in_split.rowsBetween(Window.unboundedPreceding, -1)
    # A line that ends alike from both states sets the state; one that keeps
    # both does nothing; one that exchanges them flips it.
    sets = F.when(F.col("out") == F.col("in_"), F.col("out"))
    flips = (F.col("out") & ~F.col("in_")).cast("int")
    rows = lines.withColumn("_f", F.col("_o.f")).withColumn("_b", F.col("_o.b"))
    rows = rows.withColumn("_set", F.when(sets.isNotNull(), F.struct(sets.alias("to"), (F.sum(flips).over(upto)).alias("at"))))
    rows = rows.withColumn("_flips", F.coalesce(F.sum(flips).over(before), F.lit(0)))
    rows = rows.withColumn("_last", F.last("_set", ignorenulls=True).over(before))
    rows = cut_lineage(rows.withColumn("_all", flips), "tsv-lines")
    # one narrow row a split: what it sets or flips as a whole
    splits = rows.groupBy("_f", "_b").agg(F.sum("_all").alias("flips"), F.max_by("_set", F.when(
        F.col("_set").isNotNull(), F.col("_o"))).alias("set"))
    flipped = F.col("flips") - F.coalesce(F.col("set.at"), F.lit(0))
    splits = splits.select("_f", "_b", F.col("set.to").alias("to"), (flipped % 2).alias("odd"))
    by_file = Window.partitionBy("_f").orderBy("_b")
    prior = by_file.rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("_n", F.sum("odd").over(by_file)).withColumn(
        "_mark", F.when(F.col("to").isNotNull(), F.struct("to", (F.col("_n") - F.col("odd")).alias("at"))))
    splits = splits.withColumn("_lastmark", F.last("_mark", ignorenulls=True).over(prior))
    odd = F.coalesce(F.sum("odd").over(prior), F.lit(0)) - F.coalesce(F.col("_lastmark.at"), F.lit(0))
    start = F.coalesce(F.col("_lastmark.to"), F.lit(False)) != (odd % 2 == 1)
    splits = splits.select(F.col("_f").alias("_sf"), F.col("_b").alias("_sb"), start.alias("_quoted"))

    rows = rows.join(maybe_broadcast(splits), (F.col("_f") == F.col("_sf")) & (F.col("_b") == F.col("_sb")))
    odd = F.col("_flips") - F.coalesce(F.col("_last.at"), F.lit(0))
    inside = F.coalesce(F.col("_last.to"), F.col("_quoted")) != (odd % 2 == 1)
    rows = rows.withColumn("_head", F.when(~inside, F.col("_o")))
    # a record that goes on in the next splits: their last head is carried on
    heads = rows.groupBy("_f", "_b").agg(F.max("_head").alias("_h")).withColumn(
        "_carried", F.last("_h", ignorenulls=True).over(prior))
    heads = maybe_broadcast(heads.select(F.col("_f").alias("_sf"), F.col("_b").alias("_sb"), "_carried"))
    rows = rows.drop("_sf", "_sb").join(heads, (F.col("_f") == F.col("_sf")) & (F.col("_b") == F.col("_sb")))
    rows = rows.withColumn("_record", F.coalesce(F.last("_head", ignorenulls=True).over(upto), F.col("_carried")))
    return rows.groupBy(F.col("_record").alias("_o")).agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("_o", "value"))), lambda x: x["value"]), "\n").alias("record"))


def read_records(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(_o, record): the records of TSV files as text, ``_o`` their place."""
    lines = with_file_ordinal(spark.read.text(path), "_o")
    lines = lines.withColumn("out", _ends_quoted(F.col("value"), START))
    spanning = cut_lineage(lines.where("out").select(F.col("_o.f").alias("_f")).distinct(), "tsv-files")
    if spanning.isEmpty():
        records = lines.select("_o", F.col("value").alias("record"))
    else:
        spanning = maybe_broadcast(spanning)  # a row a file
        plain = lines.join(spanning, lines["_o.f"] == F.col("_f"), "left_anti")
        held = lines.join(spanning, lines["_o.f"] == F.col("_f"), "left_semi")
        scanned = _scanned(held.withColumn("in_", _ends_quoted(F.col("value"), QUOTED)))
        records = plain.select("_o", F.col("value").alias("record")).unionByName(scanned)
    return records.where("record <> ''")


def read_tsv_records(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str] | None = None,
                     ordinal: str | None = None) -> DataFrame:
    """Tables with headers, every value a string.  ``columns``: the columns to
    return; otherwise all those that some file's header names."""
    records = read_records(spark, path).select("_o", cells(F.col("record")).alias("_cells"))
    first = records.groupBy(F.col("_o.f").alias("_f")).agg(F.min(F.struct("_o", "_cells")).alias("h"))
    first = cut_lineage(first.select("_f", F.col("h._o").alias("_h"), F.col("h._cells").alias("_names")), "tsv-headers")
    if columns is None:
        seen = first.select("_names").distinct().collect()  # a row for each different header
        columns = list(dict.fromkeys(n for r in sorted(seen) for n in r["_names"]))
    heads = maybe_broadcast(first)
    rows = records.join(heads, F.col("_o.f") == F.col("_f")).where("_o <> _h")
    short = F.size("_cells") < F.size("_names")
    held = rows.withColumn("_cells", F.when(short, F.raise_error(F.concat(
        F.lit("a row with fewer cells than the header in "), F.col("_f"))).cast("array<string>")).otherwise(F.col("_cells")))

    def value(name):
        # the last cell of that name
        at = F.array_position(F.reverse("_names"), F.lit(name))
        return F.when(at > 0, F.element_at("_cells", (F.size("_names") - at + 1).cast("int")))
    return held.select(*[value(c).alias(c) for c in columns], *([F.col("_o").alias(ordinal)] if ordinal else []))
