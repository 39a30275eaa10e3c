"""Sources and sinks on the driver tables: each query writes a table in the
format to a fresh folder under the shared checkpoint root and scans it back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import diff as D
from ..operators.sets import distinct_values
from ..session import shared_path
from ..sources import readers as R
from ..sources import writers as W
from .common import ORDER_FIELDS, SQL_DIFF, SQL_ORDER_RECORD, order_record, sql_md5_json, table
from .q_columns import SQL_FEED, events_feed
from .q_diff import _diffed


def ndjson_roundtrip(spark, sf):
    """K1 + S1: feed rows -> NDJSON (nulls written) -> explicit-schema scan."""
    path = shared_path(spark, "ndjson")
    W.write_ndjson(events_feed(spark, sf), path)
    return R.read_ndjson(spark, path, R.FEED_SCHEMA)


def _tsv_source(spark, sf):
    c = table(spark, sf, "customer")
    return c.select(
        F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("seqName"),
        F.round(F.col("c_acctbal") * 100).cast("long").cast("string").alias("qc.overallScore"),
        F.col("c_mktsegment").alias("clade"),
        F.when(F.col("c_custkey") % 3 == 0, F.lit("")).otherwise(F.col("c_name")).alias("maybe_empty"),
        F.concat(F.lit('a "q" '), F.col("c_custkey").cast("string")).alias("quoted"))


def tsv_scan(spark, sf):
    """Header TSV with quoted cells, empty cells and dotted headers."""
    path = shared_path(spark, "tsv")
    (_tsv_source(spark, sf).write.option("sep", "\t").option("header", True)
     .option("quote", '"').option("escape", '"').csv(path))
    return R.read_tsv(spark, path)


def tsv_records(spark, sf):
    """S5 with line breaks in cells: documents (whole texts) as TSV files of
    two header orders, by language, one with a column more; scanned back."""
    path = shared_path(spark, "tsv-records")
    d = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("strain"), F.coalesce(
        "text", F.lit("")).alias("note"), F.coalesce("lang", F.lit("")).alias("country"), F.lit("x").alias("more"))
    for name, side, columns in (("a", F.col("country") == "en", ("strain", "note", "country")),
                                ("b", F.col("country") != "en", ("country", "more", "note", "strain"))):
        (d.where(side).select(*columns).write.option("sep", "\t").option("header", True).option("quoteAll", True)
         .option("escape", '"').csv(f"{path}/{name}"))
    return R.read_tsv_records(spark, [f"{path}/a", f"{path}/b"], columns=["strain", "note", "country"])


def fasta_scan(spark, sf):
    """S3: documents (whole texts) as FASTA, scanned back into (header,
    sequence).  A text line that starts like a header gets a blank before."""
    path = shared_path(spark, "fasta")
    d = table(spark, sf, "documents")
    text = F.regexp_replace(F.col("text"), "(?m)^>", " >")
    rec = F.concat(F.lit(">doc"), F.col("doc_id").cast("string"), F.lit(" "), F.col("lang"),
                   F.lit("\n"), text)
    d.select(rec.alias("value")).write.text(path)
    return R.read_fasta(spark, path)


def fasta_sink(spark, sf):
    """K3: entries -> FASTA of one named unaligned sequence; lines read back."""
    path = shared_path(spark, "fasta-sink")
    p = table(spark, sf, "pages").select(
        F.concat(F.lit("page"), F.col("page_id").cast("string")).alias("id"),
        F.create_map(F.lit("main"), F.col("html")).alias("unaligned_nuc"))
    W.write_fasta(p, path, "id", F.col("unaligned_nuc")["main"])
    return spark.read.text(path)


def line_scan(spark, sf):
    """The lines of all documents, written and scanned in file order."""
    path = shared_path(spark, "line-scan")
    table(spark, sf, "documents").select(F.col("text").alias("value")).write.text(path)
    return R.read_lines(spark, path, "ordinal").select("value")


def geo_rule_scan(spark, sf):
    """S7 from a file: one rule line per customer; of lines with the same
    left side the last one of the file wins."""
    path = shared_path(spark, "geo-rules")
    c, n, r = (table(spark, sf, t) for t in ("customer", "nation", "region"))
    at = (c.join(n, F.col("c_nationkey") == F.col("n_nationkey"))
          .join(r, F.col("n_regionkey") == F.col("r_regionkey")))
    line = F.concat(F.concat_ws("/", "r_name", "n_name", "c_mktsegment", F.lit("*")), F.lit("\t"),
                    F.concat_ws("/", "r_name", "n_name", F.col("c_custkey").cast("string"), F.lit("*")))
    at.orderBy("c_custkey").select(line.alias("value")).write.text(path)
    return R.read_geo_rules(spark, path)


def parquet_sink(spark, sf):
    """K2: line items written partitioned by status and read back."""
    path = shared_path(spark, "parquet-sink")
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")
    W.write_parquet(li, path, partition_by=["l_returnflag"])
    return spark.read.parquet(path)


def line_list_roundtrip(spark, sf):
    """K6 + S9: a distinct label list written as lines and read back."""
    path = shared_path(spark, "lines")
    W.write_line_list(distinct_values(table(spark, sf, "part"), ["p_brand"]), path)
    return R.read_line_list(spark, path)


def template_scan(spark, sf):
    """S8 + P12: alignment templates (name -> sequence maps), one object per
    part, written as JSON lines, scanned, and turned into unknown-filled
    sequences of the template lengths."""
    path = shared_path(spark, "template")
    p = table(spark, sf, "part")
    size = (F.col("p_size") % 7 + 1).cast("int")
    p.select(
        F.col("p_partkey").cast("string").alias("id"),
        F.create_map(F.lit("main"), F.repeat(F.lit("ACGT"), size),
                     F.lit("extra"), F.col("p_name")).alias("nucleotideSequences"),
        F.create_map(F.col("p_brand"), F.repeat(F.lit("MK"), size)).alias("aminoAcidSequences"),
    ).write.json(path)
    t = R.read_template(spark, path, multi_line=False)
    nl, al = R.template_lengths(t, keep=["id"])
    return (nl.select("id", F.lit("nuc").alias("kind"), "name", "length",
                      F.repeat(F.lit("N"), F.col("length")).alias("unknown"))
            .unionByName(al.select("id", F.lit("aa").alias("kind"), "name", "length",
                                   F.repeat(F.lit("X"), F.col("length")).alias("unknown"))))


def snapshot_publish(spark, sf):
    """K7 + S12: publish a versioned snapshot, read its data part back."""
    root = shared_path(spark, "snapshots")
    old = order_record(table(spark, sf, "orders"))
    hashes = D.fingerprint(old, "o_orderkey", ORDER_FIELDS)
    lin = distinct_values(old, ["o_orderpriority"])
    v = W.publish_snapshot(spark, root, old, lineages=lin, hashes=hashes, version="1700000000")
    assert W.latest_version(spark, root) == v
    return R.read_snapshot(spark, root, v, "data")


def legacy_diff_scan(spark, sf):
    """S11, legacy form: the diff written as one JSON object of four arrays
    in one file, and scanned back as a stream."""
    path = shared_path(spark, "legacy-diff")
    _legacy_lines(_diffed(spark, sf)).coalesce(1).write.text(path)
    return R.read_diff(spark, path, legacy=True)


def _legacy_lines(diff):
    """The lines of the object in order.  They are sorted by many tasks and
    checkpointed, so that the one task that writes the file only copies them;
    a sort in that task would hold all of them."""
    rows = diff.select("status", F.lit(1).alias("kind"), F.col("id").cast("string").alias("text"))
    marks = diff.sparkSession.createDataFrame(
        [(p, k, v) for n, p in enumerate(R.DIFF_PARTS) for k, v in (
            (0, ("{" if n == 0 else ",") + f' "{p}": ['), (2, f'"last-{p}"]' + ("}" if n == 3 else "")))],
        "status string, kind int, text string")
    line = F.when(F.col("kind") == 1, F.concat(F.lit('"'), "text", F.lit('",'))).otherwise(F.col("text"))
    return rows.unionByName(marks).orderBy("status", "kind", "text").select(line.alias("value")).checkpoint()


def hash_table_scan(spark, sf):
    """K4 + S10: the (id, md5) side table written and read back."""
    path = shared_path(spark, "hashes")
    h = D.fingerprint(order_record(table(spark, sf, "orders")), "o_orderkey", ORDER_FIELDS).select(
        F.col("id").cast("string").alias("gisaidEpiIsl"), "md5")
    W.write_hashes(h, path)
    return R.read_hashes(spark, path)


def diff_table_roundtrip(spark, sf):
    """K5 + S11: the long diff table written by status and read back."""
    path = shared_path(spark, "diff")
    W.write_diff(_diffed(spark, sf), path)
    return R.read_diff(spark, path)


def noop_pass(spark, sf):
    """K8: a full read of lineitem into the noop sink (timing floor)."""
    li = table(spark, sf, "lineitem")
    W.noop(li)
    return li.agg(F.count(F.lit(1)).alias("n"))


QUERIES = {
    "ndjson_roundtrip": ndjson_roundtrip,
    "tsv_scan": tsv_scan,
    "tsv_records": tsv_records,
    "fasta_scan": fasta_scan,
    "fasta_sink": fasta_sink,
    "line_scan": line_scan,
    "geo_rule_scan": geo_rule_scan,
    "parquet_sink": parquet_sink,
    "line_list_roundtrip": line_list_roundtrip,
    "template_scan": template_scan,
    "snapshot_publish": snapshot_publish,
    "hash_table_scan": hash_table_scan,
    "legacy_diff_scan": legacy_diff_scan,
    "diff_table_roundtrip": diff_table_roundtrip,
    "noop_pass": noop_pass,
}

ORACLE = {
    "legacy_diff_scan": f"""
      SELECT CAST(id AS VARCHAR) AS id, status FROM ({SQL_DIFF})
      UNION ALL SELECT 'last-' || s, s FROM (VALUES ('added'), ('changed'), ('deleted'), ('unchanged')) v(s)""",
    "tsv_records": r"""
      SELECT CAST(doc_id AS VARCHAR) AS strain, regexp_replace(coalesce(text, ''), '\r\n?', chr(10), 'g') AS note,
             coalesce(lang, '') AS country
      FROM documents""",
    "ndjson_roundtrip": SQL_FEED,
    "tsv_scan": """
      SELECT 'C' || c_custkey AS seqName,
             CAST(CAST(round(c_acctbal * 100) AS BIGINT) AS VARCHAR) AS "qc.overallScore",
             c_mktsegment AS clade,
             CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_name END AS maybe_empty,
             'a "q" ' || c_custkey AS quoted
      FROM customer""",
    "fasta_scan": """
      SELECT 'doc' || doc_id || ' ' || lang AS sample_name,
             array_to_string(list_filter(list_transform(string_split(text, chr(10)),
               lambda x: CASE WHEN x[1] = '>' THEN ' ' || x ELSE x END), lambda x: regexp_matches(x, '\\S')), '')
               AS sequence
      FROM documents""",
    "fasta_sink": """
      SELECT '>page' || page_id AS value FROM pages
      UNION ALL SELECT unnest(string_split(html, chr(10))) AS value FROM pages""",
    "line_scan": "SELECT unnest(string_split(text, chr(10))) AS value FROM documents",
    "geo_rule_scan": """
      SELECT lower(r_name) AS l0, lower(n_name) AS l1, lower(c_mktsegment) AS l2, '*' AS l3,
             r_name AS r0, n_name AS r1, CAST(max(c_custkey) AS VARCHAR) AS r2, '*' AS r3
      FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
      GROUP BY r_name, n_name, c_mktsegment""",
    "parquet_sink": "SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag FROM lineitem",
    "line_list_roundtrip": "SELECT DISTINCT p_brand AS value FROM part WHERE p_brand <> ''",
    "template_scan": """
      SELECT CAST(p_partkey AS VARCHAR) AS id, 'nuc' AS kind, 'main' AS name,
             CAST(4 * (p_size % 7 + 1) AS INTEGER) AS length,
             repeat('N', CAST(4 * (p_size % 7 + 1) AS INTEGER)) AS unknown FROM part
      UNION ALL
      SELECT CAST(p_partkey AS VARCHAR), 'nuc', 'extra', CAST(length(p_name) AS INTEGER),
             repeat('N', CAST(length(p_name) AS INTEGER)) FROM part
      UNION ALL
      SELECT CAST(p_partkey AS VARCHAR), 'aa', p_brand, CAST(2 * (p_size % 7 + 1) AS INTEGER),
             repeat('X', CAST(2 * (p_size % 7 + 1) AS INTEGER)) FROM part""",
    "snapshot_publish": SQL_ORDER_RECORD,
    "hash_table_scan": f"""SELECT CAST(o_orderkey AS VARCHAR) AS id, {sql_md5_json(ORDER_FIELDS)} AS md5
      FROM ({SQL_ORDER_RECORD})""",
    "diff_table_roundtrip": SQL_DIFF,
    "noop_pass": "SELECT count(*) AS n FROM lineitem",
}
