"""Column and frame transforms on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import (insertion_list, insertions_by_gene, json_path, parse_double,
                         parse_int, parse_partial_date, split_location)
from ..functions import unknown_template as to_unknown
from ..functions.location import GEO_LEVELS, geo_normalise
from ..functions.sequences import fill_from_template
from ..functions.text import empty_to_null
from ..operators import frames as FR
from ..operators.sets import distinct_values, union_distinct
from ..plans.clean import CleanSpec, clean, mask_sequences
from .common import table

# ------------------------------------------------------------ shared inputs


def degraded_dates(orders):
    """Order dates written in the partial forms a submitter may use."""
    d = F.col("o_orderdate")
    k = F.col("o_orderkey") % 8
    full = F.date_format(d, "yyyy-MM-dd")
    return (F.when(k == 0, full)
            .when(k == 1, F.date_format(d, "yyyy-MM"))
            .when(k == 2, F.date_format(d, "yyyy"))
            .when(k == 3, F.concat(F.date_format(d, "yyyy"), F.lit("-XX-XX")))
            .when(k == 4, F.concat(F.lit("20XX"), F.date_format(d, "-MM-dd")))
            .when(k == 5, F.concat(F.date_format(d, "yyyy"), F.lit("-02-30")))
            .when(k == 6, F.lit(None).cast("string"))
            .otherwise(F.concat(F.date_format(d, "yyyy-MM"), F.lit("-XX"))))


SQL_DEGRADED = """CASE o_orderkey % 8
      WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d')
      WHEN 1 THEN strftime(o_orderdate, '%Y-%m')
      WHEN 2 THEN strftime(o_orderdate, '%Y')
      WHEN 3 THEN strftime(o_orderdate, '%Y') || '-XX-XX'
      WHEN 4 THEN '20XX' || strftime(o_orderdate, '-%m-%d')
      WHEN 5 THEN strftime(o_orderdate, '%Y') || '-02-30'
      WHEN 6 THEN NULL
      ELSE strftime(o_orderdate, '%Y-%m') || '-XX' END"""


def sql_partial_date(s: str, f: str) -> str:
    """Partial-date parse in DuckDB SQL: five output columns named f*."""
    z = f"replace({s}, 'X', '0')"
    complete = (f"(regexp_full_match({s}, '\\d{{4}}-\\d{{2}}-\\d{{2}}') "
                f"AND try_strptime({s}, '%Y-%m-%d') IS NOT NULL)")
    m = f"regexp_full_match({z}, '\\d{{4}}(-\\d{{2}})?(-\\d{{2}})?')"
    y = f"TRY_CAST(substr({z}, 1, 4) AS INTEGER)"
    mo = f"CASE WHEN regexp_full_match({z}, '\\d{{4}}-\\d{{2}}(-\\d{{2}})?') THEN TRY_CAST(substr({z}, 6, 2) AS INTEGER) END"
    d = f"CASE WHEN regexp_full_match({z}, '\\d{{4}}-\\d{{2}}-\\d{{2}}') THEN TRY_CAST(substr({z}, 9, 2) AS INTEGER) END"
    return f"""CASE WHEN {complete} THEN {s} END AS {f},
      CAST(CASE WHEN {complete} THEN CAST(substr({s}, 1, 4) AS INTEGER)
           WHEN {m} AND {y} > 0 THEN {y} END AS INTEGER) AS {f}Year,
      CAST(CASE WHEN {complete} THEN CAST(substr({s}, 6, 2) AS INTEGER)
           WHEN {m} AND {mo} BETWEEN 1 AND 12 THEN {mo} END AS INTEGER) AS {f}Month,
      CAST(CASE WHEN {complete} THEN CAST(substr({s}, 9, 2) AS INTEGER)
           WHEN {m} AND {d} BETWEEN 1 AND 31 THEN {d} END AS INTEGER) AS {f}Day,
      {s} AS {f}OriginalValue"""


def events_feed(spark, sf):
    """``events`` presented as the incoming sequence feed."""
    e = table(spark, sf, "events")
    k = json_path(F.col("props"), "$.k")
    return e.select(
        F.concat(F.lit("EPI_"), F.col("event_id").cast("string")).alias("covv_accession_id"),
        F.when(F.col("user_id") % 7 == 0, F.lit(None)).otherwise(
            F.concat(F.lit("hCoV/"), F.col("user_id").cast("string"), F.lit("/"),
                     F.col("event_id").cast("string"))).alias("covv_virus_name"),
        F.date_format("ts", "yyyy-MM-dd").alias("covv_collection_date"),
        F.date_format("ts", "yyyy-MM").alias("covv_subm_date"),
        F.when(F.col("event_type") == "error", F.lit("unknown")).otherwise(F.lit("Human"))
        .alias("covv_host"),
        k.alias("covv_patient_age"),
        F.when(F.col("user_id") % 3 == 0, F.lit("Male")).when(F.col("user_id") % 3 == 1, F.lit("Female"))
        .otherwise(F.lit("")).alias("covv_gender"),
        F.col("event_type").alias("covv_sampling_strategy"),
        F.concat(F.lit("B.1."), (F.col("user_id") % 50).cast("string")).alias("covv_lineage"),
        F.when(F.col("event_id") % 9 == 0, F.lit("  ")).otherwise(F.concat(
            F.lit("Europe / "), F.col("event_type"), F.lit(" / "), F.col("user_id").cast("string")))
        .alias("covv_location"),
        F.repeat(F.lit("ACGT"), (F.col("event_id") % 5).cast("int")).alias("sequence"))


SQL_FEED = """SELECT
      'EPI_' || event_id AS covv_accession_id,
      CASE WHEN user_id % 7 = 0 THEN NULL ELSE 'hCoV/' || user_id || '/' || event_id END AS covv_virus_name,
      strftime(ts, '%Y-%m-%d') AS covv_collection_date,
      strftime(ts, '%Y-%m') AS covv_subm_date,
      CASE WHEN event_type = 'error' THEN 'unknown' ELSE 'Human' END AS covv_host,
      json_extract_string(props, '$.k') AS covv_patient_age,
      CASE user_id % 3 WHEN 0 THEN 'Male' WHEN 1 THEN 'Female' ELSE '' END AS covv_gender,
      event_type AS covv_sampling_strategy,
      'B.1.' || (user_id % 50) AS covv_lineage,
      CASE WHEN event_id % 9 = 0 THEN '  ' ELSE 'Europe / ' || event_type || ' / ' || user_id END AS covv_location,
      repeat('ACGT', CAST(event_id % 5 AS INTEGER)) AS sequence
    FROM events"""

FEED_OUT = ("gisaidEpiIsl", "strain", "date", "dateSubmitted", "host", "age", "sex",
            "samplingStrategy", "pangoLineage")


def feed_entries(spark, sf):
    e = FR.project_feed(events_feed(spark, sf))
    return FR.map_to_null(e, ("", "unknown"))


def _sql_nullmark(c: str, vals=("", "unknown")) -> str:
    lst = ", ".join(f"'{v}'" for v in vals)
    return f"CASE WHEN {c} IN ({lst}) THEN NULL ELSE {c} END"


def _sql_loc(i: int, src: str = "covv_location") -> str:
    part = f"nullif(trim(split_part({src}, '/', {i + 1})), '')" if i else \
        f"trim(split_part({src}, '/', 1))"
    return f"CASE WHEN {src} IS NULL OR trim({src}) = '' THEN NULL ELSE {part} END"


SQL_FEED_ENTRIES = f"""SELECT covv_accession_id AS id,
      {_sql_nullmark('covv_accession_id')} AS gisaidEpiIsl,
      {_sql_nullmark('covv_virus_name')} AS strain,
      {_sql_nullmark('covv_collection_date')} AS date,
      {_sql_nullmark('covv_subm_date')} AS dateSubmitted,
      {_sql_nullmark('covv_host')} AS host,
      {_sql_nullmark('covv_patient_age')} AS age,
      {_sql_nullmark('covv_gender')} AS sex,
      {_sql_nullmark('covv_sampling_strategy')} AS samplingStrategy,
      {_sql_nullmark('covv_lineage')} AS pangoLineage,
      {_sql_nullmark(_sql_loc(0))} AS region,
      {_sql_nullmark(_sql_loc(1))} AS country,
      {_sql_nullmark(_sql_loc(2))} AS division,
      {_sql_nullmark(_sql_loc(3))} AS location,
      sequence AS unaligned_main
    FROM ({SQL_FEED})"""


# ------------------------------------------------------------------ queries


def nullify_values(spark, sf):
    """P5 + P6: chosen markers -> null in every text column, lineage-style
    markers in one listed column."""
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), "o_orderstatus",
                                          "o_orderpriority", "o_custkey")
    o = FR.map_to_null(o, ("4-NOT SPECIFIED", "5-LOW"))
    return FR.map_lineage_to_null(o, ["o_orderstatus"], ("P",))


def ordered_rename(spark, sf):
    """P3 + P4: ordered renames (repeated target, missing source) then a
    whitelist with an absent name."""
    e = table(spark, sf, "events").select(F.col("event_id").alias("id"), "event_type", "props",
                                          F.col("user_id").cast("string").alias("user_id"), "value")
    e = FR.ordered_rename(e, [("event_type", "kind"), ("props", "kind"), ("user_id", "owner"),
                              ("no_such_field", "owner"), ("value", "amount")])
    return FR.whitelist(e, ["kind", "owner", "amount", "extra"])


def partial_date_parse(spark, sf):
    """P7 over every order date, degraded into partial forms."""
    o = table(spark, sf, "orders").select("o_orderkey", degraded_dates(
        table(spark, sf, "orders")).alias("d"))
    p = parse_partial_date(F.col("d"))
    return o.select("o_orderkey", *[c.alias("date" + k) for k, c in p.items()])


def parse_integer_lenient(spark, sf):
    """P8 (lenient): integer text in several shapes -> int or null."""
    e = table(spark, sf, "events")
    k = json_path(F.col("props"), "$.k")
    v = F.col("event_id") % 6
    txt = (F.when(v == 0, k).when(v == 1, F.concat(F.lit("+"), k))
           .when(v == 2, F.concat(F.lit(" "), k, F.lit(" ")))
           .when(v == 3, F.concat(k, F.lit(".0")))
           .when(v == 4, F.concat(k, F.lit("-"), (k.cast("int") + 9).cast("string"))))
    return e.select("event_id", txt.alias("txt")).select(
        "event_id", "txt", parse_int(F.col("txt"), ignore_errors=True).alias("age"))


def parse_float(spark, sf):
    """Strict parse of valid decimal text, lenient parse of mixed text."""
    e = table(spark, sf, "events")
    k = json_path(F.col("props"), "$.k")
    v = F.col("event_id") % 4
    good = (F.when(v == 0, F.concat(k, F.lit("."), (F.col("event_id") % 100).cast("string")))
            .when(v == 1, F.concat(F.lit(" "), k, F.lit(" ")))
            .when(v == 2, F.concat(k, F.lit("e-2")))
            .otherwise(F.concat(F.lit("-"), k, F.lit(".5"))))
    w = F.col("event_id") % 3
    mixed = F.when(w == 0, F.lit("n/a")).when(w == 1, F.lit("inf")).otherwise(k)
    return e.select("event_id", good.alias("txt"), mixed.alias("txt2")).select(
        "event_id", "txt", "txt2", parse_double(F.col("txt")).alias("score"),
        parse_double(F.col("txt2"), ignore_errors=True).alias("score2"))


def _gapped_parts(spark, sf):
    p = table(spark, sf, "part")
    s = F.concat(F.repeat(F.lit("-"), (F.col("p_partkey") % 4).cast("int")),
                 F.regexp_replace("p_name", " ", "-"),
                 F.repeat(F.lit("-"), (F.floor(F.col("p_partkey") / 4) % 3).cast("int")))
    return p.select("p_partkey", s.alias("s"))


def edge_gap_mask(spark, sf):
    """P10: leading+trailing gaps -> N in the nucleotide map, leading gaps
    -> X for ORF1a, through the cleaning step's map masking."""
    p = _gapped_parts(spark, sf).select(
        "p_partkey", F.create_map(F.lit("main"), F.col("s")).alias("aligned_nuc"),
        F.create_map(F.lit("ORF1a"), F.col("s"), F.lit("S"), F.col("s")).alias("aligned_aa"))
    m = mask_sequences(p, {"aligned_nuc": {"main": ("N", True, True)},
                           "aligned_aa": {"ORF1a": ("X", True, False)}})
    return m.select("p_partkey", F.col("aligned_nuc")["main"].alias("main"),
                    F.col("aligned_aa")["ORF1a"].alias("orf1a"),
                    F.col("aligned_aa")["S"].alias("s_gene"))


TEMPLATE_NUC = {"main": 20, "S": 9, "ORF1a": 5}  # example template lengths (a parameter)


def template_fill(spark, sf):
    """Missing template names get N x template length; others kept."""
    c = table(spark, sf, "customer")
    m = F.create_map(
        F.lit("main"), F.when(F.col("c_custkey") % 3 == 0, F.lit(None)).otherwise(F.col("c_name")),
        F.lit("S"), F.when(F.col("c_custkey") % 5 == 0, F.lit(None)).otherwise(F.col("c_mktsegment")),
        F.lit("extra"), F.when(F.col("c_custkey") % 2 == 0, F.lit(None)).otherwise(F.col("c_name")))
    filled = fill_from_template(m, TEMPLATE_NUC, "N")
    out = c.select("c_custkey", filled.alias("m"))
    return out.select("c_custkey", *[F.try_element_at("m", F.lit(n)).alias(n)
                                     for n in ("main", "S", "ORF1a", "extra")],
                      F.size("m").alias("n_names"))


def unknown_template(spark, sf):
    """Template sequences -> N / X of the same length."""
    p = table(spark, sf, "part")
    nuc = F.create_map(F.lit("main"), F.col("p_name"), F.lit("S"), F.col("p_type"))
    aa = F.create_map(F.lit("ORF1a"), F.concat("p_brand", "p_type"))
    out = p.select("p_partkey", to_unknown(nuc, "N").alias("nuc"), to_unknown(aa, "X").alias("aa"))
    return out.select("p_partkey", F.col("nuc")["main"].alias("main"),
                      F.col("nuc")["S"].alias("s_gene"), F.col("aa")["ORF1a"].alias("orf1a"))


def _ins_text():
    v = F.col("l_linenumber") % 4
    return (F.when(v == 0, F.lit(None).cast("string")).when(v == 1, F.lit(" "))
            .when(v == 2, F.concat(F.col("l_partkey").cast("string"), F.lit(":GAG")))
            .otherwise(F.concat(F.col("l_partkey").cast("string"), F.lit(":T,"),
                                F.col("l_suppkey").cast("string"), F.lit(":AC"))))


def insertion_list_q(spark, sf):
    """Comma list -> array; null/blank -> []."""
    li = table(spark, sf, "lineitem")
    arr = insertion_list(_ins_text())
    return li.select("l_orderkey", "l_linenumber", F.size(arr).alias("n_ins"),
                     F.array_join(arr, ";").alias("ins"))


GENES = ("S", "N", "E")


def _aa_text():
    return F.when(F.col("l_linenumber") % 5 == 0, F.lit("")).otherwise(F.concat(
        F.lit("S:"), F.col("l_partkey").cast("string"), F.lit(":EPE"),
        F.when(F.col("l_linenumber") % 2 == 0, F.concat(
            F.lit(",N:"), F.col("l_suppkey").cast("string"), F.lit(":K"))).otherwise(F.lit("")),
        F.when(F.col("l_linenumber") % 3 == 0, F.lit(",S:1:A")).otherwise(F.lit(""))))


def insertions_by_gene_q(spark, sf):
    """Amino-acid insertions grouped by gene, every gene present."""
    li = table(spark, sf, "lineitem")
    m = insertions_by_gene(_aa_text(), GENES)
    return li.select("l_orderkey", "l_linenumber", F.explode(m).alias("gene", "ins")).select(
        "l_orderkey", "l_linenumber", "gene", F.array_join("ins", ";").alias("ins"))


def _loc_text():
    v = F.col("c_custkey") % 5
    return (F.when(v == 0, F.concat_ws(" / ", "r_name", "n_name", "c_mktsegment"))
            .when(v == 1, F.concat(F.col("r_name"), F.lit("//"), F.col("c_mktsegment")))
            .when(v == 2, F.concat_ws("/", "r_name", "n_name", "c_mktsegment", "c_name",
                                      F.lit("extra")))
            .when(v == 3, F.lit("   "))
            .otherwise(F.concat(F.lit("  "), F.col("r_name"), F.lit(" /"), F.col("n_name"))))


def _geo_base(spark, sf):
    c = table(spark, sf, "customer")
    n = table(spark, sf, "nation")
    r = table(spark, sf, "region")
    return c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).join(
        r, F.col("n_regionkey") == F.col("r_regionkey"))


def location_split(spark, sf):
    """P2 + P22: location text -> four trimmed levels, blanks -> null."""
    b = _geo_base(spark, sf).select("c_custkey", _loc_text().alias("loc"))
    parts = split_location(F.col("loc"))
    return b.select("c_custkey", *[empty_to_null(geo_normalise(p)).alias(n)
                                   for p, n in zip(parts, GEO_LEVELS)])


def json_path_version(spark, sf):
    """``$[0].version.tag`` of a listing JSON built per event."""
    e = table(spark, sf, "events")
    listing = F.concat(F.lit('[{"version": {"tag": "'), F.col("event_type"), F.lit("-"),
                       json_path(F.col("props"), "$.k"), F.lit('"}}, {"version": {"tag": "old"}}]'))
    return e.select("event_id", json_path(listing, "$[0].version.tag").alias("version"))


def feed_projection(spark, sf):
    """P1 (+P2, P5 with the feed's markers): feed -> entry, flattened."""
    e = feed_entries(spark, sf)
    return e.select("id", *FEED_OUT, *GEO_LEVELS,
                    F.col("unaligned_nuc")["main"].alias("unaligned_main"))


def suppress_and_derive(spark, sf):
    """P13-P16 + F2: suppressed columns, a literal, a copied column, a
    conditional override and the drop of rows without strain."""
    e = feed_entries(spark, sf).withColumn("database", F.when(
        F.col("samplingStrategy") == "click", F.lit("rki")).otherwise(F.lit("genbank")))
    e = FR.set_null(e, {"died": "string", "hospitalized": "string", "age": "string"})
    e = FR.with_literal(e, "nextcladeDatasetVersion", "2024-01-01--00-00-00Z")
    e = FR.copy_column(e, "strain", "usherTree")
    e = e.where(F.col("strain").isNotNull())
    e = FR.override_when(e, F.col("database") == F.lit("rki"), "host", "Homo sapiens")
    return e.select("id", "strain", "host", "database", "usherTree", "died", "hospitalized",
                    "age", "nextcladeDatasetVersion")


# Example cleaning spec for orders-as-metadata (a parameter of the query).
ORDER_CLEAN = CleanSpec(
    renames=(("gisaid_epi_isl", "gisaidEpiIsl"), ("Nextstrain_clade", "nextstrainClade"),
             ("pango_lineage", "pangoLineage"), ("date_submitted", "dateSubmitted"),
             ("clade_nextstrain", "nextstrainClade"), ("QC_overall_score", "nextcladeQcOverallScore"),
             ("sampling_strategy", "samplingStrategy")),
    int_lenient=False,
    suppressed=("died", "hospitalized"),
    template_aa={"S": 4},
)


def _orders_metadata(spark, sf):
    o = table(spark, sf, "orders")
    k = F.col("o_orderkey")
    return o.select(
        F.concat(F.lit("S"), k.cast("string")).alias("id"),
        F.concat(F.lit("S"), k.cast("string")).alias("strain"),
        F.when(k % 4 == 0, F.lit("?")).otherwise(F.concat(F.lit("EPI_"), k.cast("string")))
        .alias("gisaid_epi_isl"),
        degraded_dates(o).alias("date"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date_submitted"),
        F.when(k % 5 == 0, F.lit("")).otherwise((F.col("o_custkey") % 90).cast("string")).alias("age"),
        F.concat((F.round(F.col("o_totalprice") * 100).cast("long") % 1000).cast("string"),
                 F.lit(".5")).alias("QC_overall_score"),
        F.col("o_orderpriority").alias("Nextstrain_clade"),
        F.when(k % 3 == 0, F.lit(None)).otherwise(F.col("o_orderstatus")).alias("clade_nextstrain"),
        F.when(k % 6 == 0, F.lit("Unassigned")).otherwise(
            F.concat(F.lit("B."), (F.col("o_custkey") % 20).cast("string"))).alias("pango_lineage"),
        F.col("o_orderpriority").alias("sampling_strategy"),
        F.create_map(F.lit("main"), F.concat(F.repeat(F.lit("-"), (k % 3).cast("int")), F.lit("ACGT"),
                                             F.repeat(F.lit("-"), (k % 2).cast("int")))).alias("aligned_nuc"),
        F.create_map(F.lit("ORF1a"), F.concat(F.repeat(F.lit("-"), (k % 2).cast("int")), F.lit("MK-")))
        .alias("aligned_aa"))


def clean_chain(spark, sf):
    """The full cleaning chain on orders presented as metadata."""
    c = clean(_orders_metadata(spark, sf), ORDER_CLEAN)
    return c.select("id", "strain", "gisaidEpiIsl", "date", "dateYear", "dateMonth", "dateDay",
                    "dateOriginalValue", "dateSubmitted", "dateSubmittedYear", "age",
                    "nextcladeQcOverallScore", "nextstrainClade", "pangoLineage",
                    "samplingStrategy", "died", "genbankAccession",
                    F.col("aligned_nuc")["main"].alias("main"),
                    F.col("aligned_aa")["ORF1a"].alias("orf1a"),
                    F.col("aligned_aa")["S"].alias("s_gene"))


def publish_flatten(spark, sf):
    """Entry -> published row (whole document text as the sequence)."""
    d = table(spark, sf, "documents")
    k = F.col("doc_id")
    e = d.select(
        k.cast("string").alias("id"), "lang", "source",
        F.create_map(F.lit("main"), F.col("text")).alias("unaligned_nuc"),
        F.create_map(F.lit("main"), F.when(k % 4 == 0, F.lit(None)).otherwise(
            F.concat("lang", "source"))).alias("aligned_nuc"),
        F.create_map(F.lit("S"), F.upper("lang")).alias("aligned_aa"),
        F.when(k % 3 == 0, F.create_map(F.lit("main"), F.split("source", "c")))
        .otherwise(FR.empty_map(FR.INS_MAP)).alias("nuc_insertions"),
        F.create_map(F.lit("S"), F.array("lang")).alias("aa_insertions"))
    p = FR.flatten_publish(e, aligned_aa=["S"])
    return p.select("lang", "source", "unaligned_main",
                    F.col("main.sequence").alias("main_sequence"),
                    F.array_join("main.insertions", ",").alias("main_insertions"),
                    F.col("main").isNull().alias("main_missing"),
                    F.col("S.sequence").alias("s_sequence"),
                    F.array_join("S.insertions", ",").alias("s_insertions"))


def distinct_labels_two_columns(spark, sf):
    """A1 + F3: distinct non-null values over two label columns."""
    return distinct_values(table(spark, sf, "part"), ["p_brand", "p_type"])


def label_list_union(spark, sf):
    """Previous label list union the new one, distinct."""
    p = table(spark, sf, "part")
    prev = distinct_values(p, ["p_brand"])
    new = distinct_values(p, ["p_type", "p_brand"])
    return union_distinct([prev, new])


QUERIES = {
    "nullify_values": nullify_values,
    "ordered_rename": ordered_rename,
    "partial_date_parse": partial_date_parse,
    "parse_integer_lenient": parse_integer_lenient,
    "parse_float": parse_float,
    "edge_gap_mask": edge_gap_mask,
    "template_fill": template_fill,
    "unknown_template": unknown_template,
    "insertion_list": insertion_list_q,
    "insertions_by_gene": insertions_by_gene_q,
    "location_split": location_split,
    "json_path_version": json_path_version,
    "feed_projection": feed_projection,
    "suppress_and_derive": suppress_and_derive,
    "clean_chain": clean_chain,
    "publish_flatten": publish_flatten,
    "distinct_labels_two_columns": distinct_labels_two_columns,
    "label_list_union": label_list_union,
}

_SQL_GAPPED = """SELECT p_partkey,
      repeat('-', CAST(p_partkey % 4 AS INTEGER)) || replace(p_name, ' ', '-')
        || repeat('-', CAST(floor(p_partkey / 4) % 3 AS INTEGER)) AS s FROM part"""

_SQL_INS = """CASE l_linenumber % 4 WHEN 0 THEN NULL WHEN 1 THEN ' '
      WHEN 2 THEN l_partkey || ':GAG' ELSE l_partkey || ':T,' || l_suppkey || ':AC' END"""

_SQL_AA = """CASE WHEN l_linenumber % 5 = 0 THEN '' ELSE 'S:' || l_partkey || ':EPE'
      || CASE WHEN l_linenumber % 2 = 0 THEN ',N:' || l_suppkey || ':K' ELSE '' END
      || CASE WHEN l_linenumber % 3 = 0 THEN ',S:1:A' ELSE '' END END"""

_SQL_LOC = """CASE c_custkey % 5
      WHEN 0 THEN r_name || ' / ' || n_name || ' / ' || c_mktsegment
      WHEN 1 THEN r_name || '//' || c_mktsegment
      WHEN 2 THEN r_name || '/' || n_name || '/' || c_mktsegment || '/' || c_name || '/extra'
      WHEN 3 THEN '   '
      ELSE '  ' || r_name || ' /' || n_name END"""

_SQL_GEO_BASE = """customer JOIN nation ON c_nationkey = n_nationkey
      JOIN region ON n_regionkey = r_regionkey"""

_SQL_ORDERS_META = f"""SELECT 'S' || o_orderkey AS id, 'S' || o_orderkey AS strain,
      CASE WHEN o_orderkey % 4 = 0 THEN '?' ELSE 'EPI_' || o_orderkey END AS gisaid_epi_isl,
      {SQL_DEGRADED} AS date,
      strftime(o_orderdate, '%Y-%m-%d') AS date_submitted,
      CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE CAST(o_custkey % 90 AS VARCHAR) END AS age,
      CAST(CAST(round(o_totalprice * 100) AS BIGINT) % 1000 AS VARCHAR) || '.5' AS QC_overall_score,
      o_orderpriority AS Nextstrain_clade,
      CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderstatus END AS clade_nextstrain,
      CASE WHEN o_orderkey % 6 = 0 THEN 'Unassigned' ELSE 'B.' || (o_custkey % 20) END AS pango_lineage,
      o_orderpriority AS sampling_strategy,
      repeat('-', CAST(o_orderkey % 3 AS INTEGER)) || 'ACGT' || repeat('-', CAST(o_orderkey % 2 AS INTEGER)) AS nuc,
      repeat('-', CAST(o_orderkey % 2 AS INTEGER)) || 'MK-' AS orf1a
    FROM orders"""


def _sql_mask_both(s: str, fill: str) -> str:
    lead = f"(length({s}) - length(ltrim({s}, '-')))"
    trail = f"(length({s}) - length(rtrim({s}, '-')))"
    return f"""CASE WHEN {s} IS NULL THEN NULL WHEN {lead} = length({s}) THEN repeat('{fill}', length({s}))
      ELSE repeat('{fill}', {lead}) || substr({s}, {lead} + 1, length({s}) - {lead} - {trail})
           || repeat('{fill}', {trail}) END"""


def _sql_mask_lead(s: str, fill: str) -> str:
    lead = f"(length({s}) - length(ltrim({s}, '-')))"
    return f"CASE WHEN {s} IS NULL THEN NULL ELSE repeat('{fill}', {lead}) || substr({s}, {lead} + 1) END"


def _nm(c: str) -> str:
    return f"CASE WHEN {c} IN ('', '?') THEN NULL ELSE {c} END"


ORACLE = {
    "nullify_values": """
      SELECT o_orderkey AS id,
        CASE WHEN o_orderstatus IN ('4-NOT SPECIFIED', '5-LOW', 'P') THEN NULL ELSE o_orderstatus END
          AS o_orderstatus,
        CASE WHEN o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW') THEN NULL ELSE o_orderpriority END
          AS o_orderpriority,
        o_custkey
      FROM orders""",
    "ordered_rename": """
      SELECT event_id AS id, props AS kind, CAST(NULL AS VARCHAR) AS owner, value AS amount,
             CAST(NULL AS VARCHAR) AS extra FROM events""",
    "partial_date_parse": f"""
      SELECT o_orderkey, {sql_partial_date('d', 'date')}
      FROM (SELECT o_orderkey, {SQL_DEGRADED} AS d FROM orders)""",
    "parse_integer_lenient": """
      SELECT event_id, txt,
        CASE WHEN regexp_full_match(txt, '[+-]?[0-9]+') THEN TRY_CAST(txt AS INTEGER) END AS age
      FROM (SELECT event_id, CASE event_id % 6
              WHEN 0 THEN k WHEN 1 THEN '+' || k WHEN 2 THEN ' ' || k || ' '
              WHEN 3 THEN k || '.0' WHEN 4 THEN k || '-' || (CAST(k AS INTEGER) + 9) END AS txt
            FROM (SELECT event_id, json_extract_string(props, '$.k') AS k FROM events))""",
    "parse_float": """
      SELECT event_id, txt, txt2, CAST(trim(txt) AS DOUBLE) AS score,
        CASE WHEN regexp_matches(lower(txt2), 'inf|nan') THEN NULL ELSE TRY_CAST(txt2 AS DOUBLE) END AS score2
      FROM (SELECT event_id,
              CASE event_id % 4 WHEN 0 THEN k || '.' || (event_id % 100) WHEN 1 THEN ' ' || k || ' '
                   WHEN 2 THEN k || 'e-2' ELSE '-' || k || '.5' END AS txt,
              CASE event_id % 3 WHEN 0 THEN 'n/a' WHEN 1 THEN 'inf' ELSE k END AS txt2
            FROM (SELECT event_id, json_extract_string(props, '$.k') AS k FROM events))""",
    "edge_gap_mask": f"""
      SELECT p_partkey, {_sql_mask_both('s', 'N')} AS main, {_sql_mask_lead('s', 'X')} AS orf1a,
             s AS s_gene
      FROM ({_SQL_GAPPED})""",
    "template_fill": """
      SELECT c_custkey,
        coalesce(CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_name END, repeat('N', 20)) AS main,
        coalesce(CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_mktsegment END, repeat('N', 9)) AS S,
        repeat('N', 5) AS ORF1a,
        CASE WHEN c_custkey % 2 = 0 THEN NULL ELSE c_name END AS extra,
        4 AS n_names
      FROM customer""",
    "unknown_template": """
      SELECT p_partkey, repeat('N', length(p_name)) AS main, repeat('N', length(p_type)) AS s_gene,
             repeat('X', length(p_brand || p_type)) AS orf1a
      FROM part""",
    "insertion_list": f"""
      SELECT l_orderkey, l_linenumber, CAST(len(arr) AS INTEGER) AS n_ins, array_to_string(arr, ';') AS ins
      FROM (SELECT l_orderkey, l_linenumber,
              CASE WHEN t IS NULL OR trim(t) = '' THEN []::VARCHAR[] ELSE string_split(t, ',') END AS arr
            FROM (SELECT l_orderkey, l_linenumber, {_SQL_INS} AS t FROM lineitem))""",
    "insertions_by_gene": f"""
      SELECT l_orderkey, l_linenumber, gene,
        array_to_string(list_transform(
          list_filter(CASE WHEN trim(t) = '' THEN []::VARCHAR[] ELSE string_split(t, ',') END,
                      lambda x: split_part(x, ':', 1) = gene),
          lambda x: substr(x, strpos(x, ':') + 1)), ';') AS ins
      FROM (SELECT l_orderkey, l_linenumber, {_SQL_AA} AS t FROM lineitem),
           (SELECT unnest(['S', 'N', 'E']) AS gene)""",
    "location_split": f"""
      SELECT c_custkey,
        {' , '.join(f"CASE WHEN trim(loc) = '' THEN NULL ELSE nullif(trim(split_part(loc, '/', {i + 1})), '') END AS {n}" for i, n in enumerate(GEO_LEVELS))}
      FROM (SELECT c_custkey, {_SQL_LOC} AS loc FROM {_SQL_GEO_BASE})""",
    "json_path_version": """
      SELECT event_id, event_type || '-' || json_extract_string(props, '$.k') AS version FROM events""",
    "feed_projection": f"""
      SELECT id, {', '.join(FEED_OUT)}, {', '.join(GEO_LEVELS)}, unaligned_main
      FROM ({SQL_FEED_ENTRIES})""",
    "suppress_and_derive": f"""
      SELECT id, strain,
        CASE WHEN samplingStrategy = 'click' THEN 'Homo sapiens' ELSE host END AS host,
        CASE WHEN samplingStrategy = 'click' THEN 'rki' ELSE 'genbank' END AS database,
        strain AS usherTree, CAST(NULL AS VARCHAR) AS died, CAST(NULL AS VARCHAR) AS hospitalized,
        CAST(NULL AS VARCHAR) AS age, '2024-01-01--00-00-00Z' AS nextcladeDatasetVersion
      FROM ({SQL_FEED_ENTRIES}) WHERE strain IS NOT NULL""",
    "clean_chain": f"""
      SELECT id, strain, gisaidEpiIsl, date, dateYear, dateMonth, dateDay, dateOriginalValue,
        dateSubmitted, dateSubmittedYear, age, nextcladeQcOverallScore, nextstrainClade, pangoLineage,
        samplingStrategy, CAST(NULL AS VARCHAR) AS died, CAST(NULL AS VARCHAR) AS genbankAccession,
        main, orf1a, s_gene
      FROM (SELECT id, strain, gisaidEpiIsl, {sql_partial_date('d0', 'date')},
              {sql_partial_date('d1', 'dateSubmitted')},
              CAST(age AS INTEGER) AS age, CAST(qc AS DOUBLE) AS nextcladeQcOverallScore,
              nextstrainClade,
              CASE WHEN pangoLineage IN ('Unassigned', 'unclassifiable') THEN NULL ELSE pangoLineage END
                AS pangoLineage,
              samplingStrategy, main, orf1a, 'XXXX' AS s_gene
            FROM (SELECT id, {_nm('strain')} AS strain, {_nm('gisaid_epi_isl')} AS gisaidEpiIsl,
                    {_nm('date')} AS d0, {_nm('date_submitted')} AS d1, {_nm('age')} AS age,
                    {_nm('QC_overall_score')} AS qc, {_nm('clade_nextstrain')} AS nextstrainClade,
                    {_nm('pango_lineage')} AS pangoLineage, {_nm('sampling_strategy')} AS samplingStrategy,
                    {_sql_mask_both('nuc', 'N')} AS main, {_sql_mask_lead('orf1a', 'X')} AS orf1a
                  FROM ({_SQL_ORDERS_META})))""",
    "publish_flatten": """
      SELECT lang, source, text AS unaligned_main,
        CASE WHEN doc_id % 4 = 0 THEN NULL ELSE lang || source END AS main_sequence,
        CASE WHEN doc_id % 4 = 0 THEN NULL
             WHEN doc_id % 3 = 0 THEN array_to_string(string_split(source, 'c'), ',') ELSE '' END
          AS main_insertions,
        doc_id % 4 = 0 AS main_missing,
        upper(lang) AS s_sequence, lang AS s_insertions
      FROM documents""",
    "distinct_labels_two_columns": """
      SELECT DISTINCT value FROM (SELECT p_brand AS value FROM part UNION ALL SELECT p_type FROM part)
      WHERE value IS NOT NULL""",
    "label_list_union": """
      SELECT p_brand AS value FROM part UNION SELECT p_type FROM part""",
}
