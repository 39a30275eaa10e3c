"""Join family on the driver tables: positional zip joins (J1, J2, P20),
enrichment with presence overlay (J3/J4, F1, P19) and location rules
(J7, J8, S7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.location import GEO_LEVELS
from ..operators import frames as FR
from ..operators import georules as G
from ..operators.zipjoin import fallback_key, key_row_number, zip_inputs, zip_join, zip_long
from .common import table


def zip_outer_join(spark, sf):
    """Orders and events paired positionally per customer/user key."""
    o = table(spark, sf, "orders").select(F.col("o_custkey").cast("string").alias("key"),
                                          "o_orderkey")
    e = table(spark, sf, "events").select(F.col("user_id").cast("string").alias("key"),
                                          "event_id")
    return zip_inputs([(o, "key", "o_orderkey"), (e, "key", "event_id")], "key", "rn", "all")


def zip_three_inputs(spark, sf):
    """J1 over three inputs with repeated keys: every position of each, in
    one grouped shuffle."""
    o = table(spark, sf, "orders").select(F.col("o_custkey").cast("string").alias("key"), "o_orderkey")
    e = table(spark, sf, "events").select(F.col("user_id").cast("string").alias("key"), "event_id")
    c = table(spark, sf, "customer").select(F.col("c_nationkey").cast("string").alias("key"), "c_custkey")
    return zip_inputs([(o, "key", "o_orderkey"), (e, "key", "event_id"), (c, "key", "c_custkey")],
                      "key", "rn", "all")


def zip_multiway_join(spark, sf):
    """J1 + P20: one input per role, stacked as a long table and assembled
    with one grouped shuffle: one row per (conversation, position)."""
    c = table(spark, sf, "conversations").select(
        F.col("conv_id").cast("string").alias("key"), "role", "turn",
        F.col("turn").cast("string").alias("v"))
    z = zip_long(c, "key", "role", "v", "turn", "rn", "turns")
    return z.select("key", "rn", *[F.try_element_at("turns", F.lit(r)).cast("long").alias(f"{r}_turn")
                                   for r in ("user", "assistant", "system")])


def fallback_key_join(spark, sf):
    """J2 + F1: key = strain if present else seqName; keep left positions."""
    n = table(spark, sf, "nation").select(F.col("n_name").alias("strain"), "n_nationkey")
    s = table(spark, sf, "supplier").select(
        F.when(F.col("s_suppkey") % 4 == 0, F.concat(F.lit("NATION_"),
               ((F.col("s_nationkey") + 1) % 25).cast("string"))).alias("strain"),
        F.concat(F.lit("NATION_"), F.col("s_nationkey").cast("string")).alias("seqName"),
        "s_suppkey")
    left = key_row_number(fallback_key(n, "strain", "seqName"), "key", "n_nationkey")
    right = key_row_number(fallback_key(s, "strain", "seqName"), "key", "s_suppkey")
    return zip_join([left.select("key", "rn", "n_nationkey"),
                     right.select("key", "rn", "s_suppkey")], keep="first")


def _docs_with_labels(spark, sf, null_every: int | None):
    d = table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("key"), "doc_id", "lang",
        (F.col("n_chars") % 2).cast("int").alias("quality"))
    lab = table(spark, sf, "labels")
    q = F.col("quality")
    if null_every:
        q = F.when(F.col("doc_id") % null_every == 0, F.lit(None).cast("int")).otherwise(q)
    lab = lab.select(F.col("doc_id").cast("string").alias("key"), "doc_id",
                     q.alias("qc::quality"), F.col("toxic").alias("qc::toxic"),
                     F.lit(True).alias("_present"))
    left = key_row_number(d, "key", "doc_id")
    right = key_row_number(lab, "key", "doc_id").drop("doc_id")
    joined = zip_join([left, right], keep="first")
    out = FR.overlay_columns(joined, F.col("_present").isNotNull(),
                             {"quality": "qc::quality", "toxic": "qc::toxic"})
    return out.withColumn("has_label", F.col("_present").isNotNull())


def enrich_left_join(spark, sf):
    """J3/J4 + F1 + P19: documents enriched by their label rows."""
    return _docs_with_labels(spark, sf, None).select("doc_id", "lang", "quality", "toxic",
                                                     "has_label")


def overlay_by_presence(spark, sf):
    """A present label row wins even where its value is null."""
    return _docs_with_labels(spark, sf, 5).select("doc_id", "quality", "has_label")


# Example rule set (a user parameter), exercising: a case-only rewrite, the
# shallow-merge lookup (the asia/nation_7 pair), a two-step chain, an empty
# part on the left and on the right, and a repeated left side (last wins).
GEO_RULES = (
    ("africa/*/*/*", "Africa/*/*/*"),
    ("asia/*/*/*", "Asia-Generic/*/*/*"),
    ("*/nation_7/building/loc1", "*/*/*/Loc-One"),
    ("europe/nation_3/*/*", "Europe/Nation Three/*/*"),
    ("europe/nation three/*/*", "*/Nation-3-Final/*/*"),
    ("middle east/*/*/", "Middle East/*/*/unknown-loc"),
    ("*/*/household/*", "*/*//*"),
    ("america/*/*/*", "Am1/*/*/*"),
    ("america/*/*/*", "America/*/*/*"),
)


def _geo_rows(spark, sf):
    c = table(spark, sf, "customer")
    n = table(spark, sf, "nation")
    r = table(spark, sf, "region")
    b = c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).join(
        r, F.col("n_regionkey") == F.col("r_regionkey"))
    loc = F.when(F.col("c_custkey") % 4 == 0, F.lit("")).otherwise(
        F.concat(F.lit("loc"), (F.col("c_custkey") % 3).cast("string")))
    return b.select("c_custkey", F.col("r_name").alias("region"), F.col("n_name").alias("country"),
                    F.col("c_mktsegment").alias("division"), loc.alias("location"))


def geo_rule_lookup(spark, sf):
    """J7 + S7: the applicable rule (right side) per distinct tuple."""
    rules = G.rules_from_pairs(spark, GEO_RULES)
    rows = _geo_rows(spark, sf)
    tuples = rows.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(GEO_LEVELS)]).distinct()
    found = G.lookup(tuples, G.prefix_table(rules))
    return found.select("c0", "c1", "c2", "c3",
                        *[F.col("rule")[f"r{i}"].alias(f"r{i}") for i in range(4)])


def geo_rule_fixpoint(spark, sf):
    """Rules applied to a fixpoint on every customer location."""
    rules = G.rules_from_pairs(spark, GEO_RULES)
    return G.map_locations(_geo_rows(spark, sf), rules)


QUERIES = {
    "zip_outer_join": zip_outer_join,
    "zip_multiway_join": zip_multiway_join,
    "zip_three_inputs": zip_three_inputs,
    "fallback_key_join": fallback_key_join,
    "enrich_left_join": enrich_left_join,
    "overlay_by_presence": overlay_by_presence,
    "geo_rule_lookup": geo_rule_lookup,
    "geo_rule_fixpoint": geo_rule_fixpoint,
}

# ----------------------------------------------------------------- oracles

_SEP = "§"


def _prefix_values() -> str:
    """Rule prefixes (last line wins for a repeated left side) as VALUES."""
    last = {}
    for left, right in GEO_RULES:
        last[tuple(left.lower().split("/"))] = right.split("/")
    rows = {}
    for left, right in last.items():
        for d in range(1, 5):
            path = _SEP + _SEP.join(left[:d])
            if d == 4:
                rows[path] = right
            else:
                rows.setdefault(path, None)

    def lit(v):
        return "NULL" if v is None else "'" + v.replace("'", "''") + "'"
    vals = []
    for path, right in rows.items():
        r = right or [None] * 4
        vals.append(f"({lit(path)}, {', '.join(lit(x) for x in r)})")
    return "SELECT * FROM (VALUES " + ", ".join(vals) + ") AS p(path, r0, r1, r2, r3)"


def sql_geo_lookup(src: str, cols=("c0", "c1", "c2", "c3"), carry=()) -> str:
    """Rule right side (r0..r3, null if none) for each row of ``src``."""
    keep = ", ".join((*carry, *cols))
    q = f"SELECT {keep}, {', '.join(f'lower({c}) AS k{i}' for i, c in enumerate(cols))}, " \
        f"'' AS a0, CAST(NULL AS VARCHAR) AS b0, true AS alive0 FROM ({src})"
    inP = "IN (SELECT path FROM prefixes)"
    for lv in range(4):
        ae = f"(a{lv} || '{_SEP}' || k{lv})"
        be = f"(b{lv} || '{_SEP}' || k{lv})"
        aw = f"(a{lv} || '{_SEP}*')"
        bw = f"(b{lv} || '{_SEP}*')"
        full = f"CASE WHEN {ae} {inP} THEN {ae} WHEN {be} {inP} THEN {be} END"
        wild = f"CASE WHEN {aw} {inP} THEN {aw} WHEN {bw} {inP} THEN {bw} END"
        q = f"SELECT *, {full} AS f{lv}, {wild} AS w{lv} FROM ({q})"
        q = (f"SELECT *, coalesce(f{lv}, w{lv}) AS a{lv + 1}, "
             f"CASE WHEN f{lv} IS NOT NULL THEN w{lv} END AS b{lv + 1}, "
             f"alive{lv} AND (f{lv} IS NOT NULL OR w{lv} IS NOT NULL) AS alive{lv + 1} FROM ({q})")
    q = f"SELECT {keep}, CASE WHEN alive4 THEN a4 END AS leaf FROM ({q})"
    return (f"SELECT {', '.join('s.' + c for c in (*carry, *cols))}, p.r0, p.r1, p.r2, p.r3 FROM ({q}) s "
            f"LEFT JOIN prefixes p ON p.path = s.leaf")


def _sql_geo_rows() -> str:
    return """SELECT c_custkey, r_name AS region, n_name AS country, c_mktsegment AS division,
        CASE WHEN c_custkey % 4 = 0 THEN '' ELSE 'loc' || (c_custkey % 3) END AS location
      FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""


def _sql_fixpoint(rounds: int = 6) -> str:
    src = (f"SELECT c_custkey, coalesce(trim(region), '') AS c0, coalesce(trim(country), '') AS c1, "
           f"coalesce(trim(division), '') AS c2, coalesce(trim(location), '') AS c3 "
           f"FROM ({_sql_geo_rows()})")
    cur = src
    for _ in range(rounds):
        looked = sql_geo_lookup(cur, carry=("c_custkey",))
        cur = (f"SELECT c_custkey, " + ", ".join(
            f"CASE WHEN r{i} IS NULL OR r{i} = '*' THEN c{i} ELSE r{i} END AS c{i}" for i in range(4))
            + f" FROM ({looked})")
    return (f"WITH prefixes AS ({_prefix_values()}) SELECT c_custkey, "
            + ", ".join(f"nullif(c{i}, '') AS {n}" for i, n in enumerate(GEO_LEVELS))
            + f" FROM ({cur})")


def _sql_lookup_distinct() -> str:
    src = ("SELECT DISTINCT region AS c0, country AS c1, division AS c2, location AS c3 "
           f"FROM ({_sql_geo_rows()})")
    return f"WITH prefixes AS ({_prefix_values()}) {sql_geo_lookup(src)}"


ORACLE = {
    "zip_three_inputs": """
      WITH o AS (SELECT CAST(o_custkey AS VARCHAR) AS key, o_orderkey,
                        row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders),
      e AS (SELECT CAST(user_id AS VARCHAR) AS key, event_id,
                   row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events),
      c AS (SELECT CAST(c_nationkey AS VARCHAR) AS key, c_custkey,
                   row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS rn FROM customer)
      SELECT key, rn, o_orderkey, event_id, c_custkey
      FROM o FULL JOIN e USING (key, rn) FULL JOIN c USING (key, rn)""",
    "zip_outer_join": """
      WITH a AS (SELECT CAST(o_custkey AS VARCHAR) AS key,
                        row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn, o_orderkey
                 FROM orders),
           b AS (SELECT CAST(user_id AS VARCHAR) AS key,
                        row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn, event_id
                 FROM events)
      SELECT coalesce(a.key, b.key) AS key, coalesce(a.rn, b.rn) AS rn, o_orderkey, event_id
      FROM a FULL JOIN b ON a.key = b.key AND a.rn = b.rn""",
    "zip_multiway_join": """
      SELECT CAST(conv_id AS VARCHAR) AS key, rn,
             max(CASE WHEN role = 'user' THEN turn END) AS user_turn,
             max(CASE WHEN role = 'assistant' THEN turn END) AS assistant_turn,
             max(CASE WHEN role = 'system' THEN turn END) AS system_turn
      FROM (SELECT conv_id, role, turn,
                   row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) AS rn
            FROM conversations)
      GROUP BY conv_id, rn""",
    "fallback_key_join": """
      WITH a AS (SELECT n_name AS key, row_number() OVER (PARTITION BY n_name ORDER BY n_nationkey) AS rn,
                        n_nationkey FROM nation),
           s AS (SELECT coalesce(CASE WHEN s_suppkey % 4 = 0 THEN 'NATION_' || ((s_nationkey + 1) % 25) END,
                                 'NATION_' || s_nationkey) AS key, s_suppkey FROM supplier),
           b AS (SELECT key, row_number() OVER (PARTITION BY key ORDER BY s_suppkey) AS rn, s_suppkey FROM s)
      SELECT a.key, a.rn, n_nationkey, s_suppkey FROM a LEFT JOIN b ON a.key = b.key AND a.rn = b.rn""",
    "enrich_left_join": """
      SELECT d.doc_id, d.lang,
             CASE WHEN l.doc_id IS NOT NULL THEN l.quality ELSE CAST(d.n_chars % 2 AS INTEGER) END AS quality,
             l.toxic, l.doc_id IS NOT NULL AS has_label
      FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "overlay_by_presence": """
      SELECT d.doc_id,
             CASE WHEN l.doc_id IS NOT NULL THEN (CASE WHEN l.doc_id % 5 = 0 THEN NULL ELSE l.quality END)
                  ELSE CAST(d.n_chars % 2 AS INTEGER) END AS quality,
             l.doc_id IS NOT NULL AS has_label
      FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "geo_rule_lookup": _sql_lookup_distinct(),
    "geo_rule_fixpoint": _sql_fixpoint(),
}
