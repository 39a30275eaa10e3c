"""User-level jobs on the driver tables: sorted output (O1/O2), full rebuild
(W1, S13) and incremental refresh (W2, W2a-c)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import diff as D
from ..operators import georules as G
from ..operators.sets import sorted_positions
from ..plans import jobs as J
from ..plans import runs
from ..plans.clean import FEED, OPEN, with_template
from ..session import cut_lineage, shared_path
from ..sources import archive as A
from ..sources import readers as R
from ..sources import writers as W
from .common import ARCHIVED_BEFORE, ORDER_FIELDS, SNAPSHOT_TIME, SQL_ORDER_RECORD, order_record, table
from .q_joins import GEO_RULES, _prefix_values, sql_geo_lookup


def sorted_output(spark, sf):
    """O1 + O2: orders in (priority, key) order -> position of each row."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return sorted_positions(o, "o_orderpriority", ["o_orderkey"]).select("o_orderkey", "pos")


# ------------------------------------------------------------ full rebuild

GENES = ("S", "ORF1a")


# The alignment template of the derived inputs: sequence lengths by name.
TEMPLATE_NUC, TEMPLATE_AA = {"main": 12}, {"S": 9, "ORF1a": 5}


def rebuild_inputs(spark, sf):
    """The named input set (S13): documents as metadata, labels as QC,
    document texts as raw sequences, embeddings as aligned sequences,
    pages as two gene translations (one long table)."""
    d = table(spark, sf, "documents")
    k = F.col("doc_id")
    metadata = d.select(
        F.when(k % 11 == 0, F.lit("?")).otherwise(F.concat(F.lit("doc"), k.cast("string"))).alias("strain"),
        F.when(k % 3 == 0, F.concat(F.lit("2021-0"), (1 + k % 9).cast("string"), F.lit("-1"),
                                    (k % 10).cast("string")))
        .when(k % 3 == 1, F.lit("2021-XX-XX")).otherwise(F.lit("2021")).alias("date"),
        F.lit("Europe").alias("region"), F.col("lang").alias("country"),
        F.col("source").alias("division"),
        F.when(k % 5 == 0, F.lit("")).otherwise(F.lit("Human")).alias("host"),
        F.when(F.col("source").isin("src1", "src2"), F.lit("rki")).otherwise(F.lit("genbank"))
        .alias("database"),
        (F.col("n_chars") % 90).cast("string").alias("age"),
        F.when(k % 4 == 0, F.lit("?")).otherwise(F.lit("female")).alias("sex"),
        F.concat(F.lit("GB"), k.cast("string")).alias("genbank_accession_rev"),
        F.concat(F.lit("20"), F.lit("ABC").substr((k % 3 + 1).cast("int"), F.lit(1))).alias("Nextstrain_clade"),
        F.col("doc_id").alias("ordinal"))
    lab = table(spark, sf, "labels")
    lk = F.col("doc_id")
    qc = lab.select(
        F.concat(F.lit("doc"), lk.cast("string")).alias("seqName"),
        F.concat(F.lit("Q"), F.col("quality").cast("string")).alias("clade_nextstrain"),
        F.concat(F.col("toxic").cast("string"), F.lit(".25")).alias("qc.overallScore"),
        F.concat(F.col("quality").cast("string"), F.lit(".5")).alias("qc.missingData.score"),
        F.when(lk % 2 == 0, F.lit("100:A,200:CC")).otherwise(F.lit("")).alias("insertions"),
        F.when(lk % 3 == 0, F.lit("S:5:K,ORF1a:7:M")).otherwise(F.lit("")).alias("aaInsertions"),
        F.when(F.col("quality") == 1, F.lit("B.1")).otherwise(F.lit("Unassigned")).alias("Nextclade_pango"),
        lk.alias("ordinal"))
    sequences = d.select(F.concat(F.lit("doc"), k.cast("string")).alias("sample_name"),
                         F.col("text").alias("sequence"), k.alias("ordinal"))
    emb = table(spark, sf, "embeddings")
    ek = F.col("vec_id")
    aligned = emb.select(
        F.concat(F.lit("doc"), ek.cast("string")).alias("sample_name"),
        F.concat(F.repeat(F.lit("-"), (ek % 3).cast("int")), F.lit("ACGTN"),
                 F.repeat(F.lit("-"), (F.col("label") % 2 + 1).cast("int"))).alias("sequence"),
        ek.alias("ordinal"))
    pg = table(spark, sf, "pages")
    pk = F.col("page_id")
    s_gene = pg.select(F.concat(F.lit("doc"), pk.cast("string")).alias("sample_name"),
                       F.lit("S").alias("gene"), F.col("url").alias("sequence"),
                       pk.alias("ordinal"))
    orf = pg.select(F.concat(F.lit("doc"), pk.cast("string")).alias("sample_name"),
                    F.lit("ORF1a").alias("gene"),
                    F.concat(F.repeat(F.lit("-"), (pk % 2).cast("int")), F.lit("MK")).alias("sequence"),
                    pk.alias("ordinal"))
    return {"metadata": metadata, "qc": qc, "sequences": sequences, "aligned": aligned,
            "translations": s_gene.unionByName(orf)}


REBUILD_OUT = ("strain", "date", "dateYear", "dateMonth", "dateDay", "country", "division", "host",
               "database", "age", "sex", "usherTree", "nextstrainClade", "nextcladeQcOverallScore",
               "nextcladeQcMissingDataScore",
               "nextcladePangoLineage", "genbankAccessionRev", "died")


def full_rebuild(spark, sf):
    """All inputs joined by strain, cleaned, published flat."""
    i = rebuild_inputs(spark, sf)
    published, _lin = J.full_rebuild(i["metadata"], i["qc"], i["sequences"], i["aligned"],
                                     i["translations"], GENES,
                                     with_template(OPEN, TEMPLATE_NUC, TEMPLATE_AA))
    return _rebuilt(published)


def _rebuilt(published):
    return published.select(
        *REBUILD_OUT, "unaligned_main",
        F.col("main.sequence").alias("main_seq"), F.array_join("main.insertions", ",").alias("main_ins"),
        F.col("S.sequence").alias("s_seq"), F.array_join("S.insertions", ",").alias("s_ins"),
        F.col("ORF1a.sequence").alias("orf1a_seq"), F.array_join("ORF1a.insertions", ",").alias("orf1a_ins"))


def rebuild_lineages(spark, sf):
    """A1 side output of W1: distinct lineages of the rebuilt snapshot."""
    i = rebuild_inputs(spark, sf)
    _pub, lin = J.full_rebuild(i["metadata"], i["qc"], i["sequences"], i["aligned"],
                               i["translations"], GENES)
    return lin


# ------------------------------------------------------- incremental refresh


def _feed(spark, sf, version: int):
    """Orders as a sequence feed seen at two times (as in ``common``): v1
    holds the orders placed before 2000; v2 drops finished orders from before
    1996 and re-prioritises the pending ones."""
    o = table(spark, sf, "orders")
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = table(spark, sf, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf, "region").select("r_regionkey", "r_name")
    b = (o.join(c, F.col("o_custkey") == F.col("c_custkey"))
         .join(n, F.col("c_nationkey") == F.col("n_nationkey"))
         .join(r, F.col("n_regionkey") == F.col("r_regionkey")))
    k = F.col("o_orderkey")
    prio = F.col("o_orderpriority")
    if version == 1:
        b = b.where(F.col("o_orderdate") < F.lit(SNAPSHOT_TIME).cast("timestamp_ntz"))
    else:
        b = b.where(~((F.col("o_orderstatus") == "F")
                      & (F.col("o_orderdate") < F.lit(ARCHIVED_BEFORE).cast("timestamp_ntz"))))
        prio = F.when(F.col("o_orderstatus") == "P", F.concat(prio, F.lit("*"))).otherwise(prio)
    return b.select(
        F.concat(F.lit("EPI_"), k.cast("string")).alias("covv_accession_id"),
        F.concat(F.lit("hCoV/"), F.col("o_custkey").cast("string"), F.lit("/"), k.cast("string"))
        .alias("covv_virus_name"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("covv_collection_date"),
        F.date_format("o_orderdate", "yyyy-MM").alias("covv_subm_date"),
        F.lit("Human").alias("covv_host"),
        (F.col("o_custkey") % 90).cast("string").alias("covv_patient_age"),
        F.col("o_orderstatus").alias("covv_gender"),
        prio.alias("covv_sampling_strategy"),
        F.concat(F.lit("B."), (F.col("o_custkey") % 30).cast("string")).alias("covv_lineage"),
        F.concat_ws(" / ", "r_name", "n_name", "c_mktsegment").alias("covv_location"),
        F.repeat(F.lit("ACGT"), (1 + k % 3).cast("int")).alias("sequence"))


def _aligner_output(spark, sf, changed):
    """Stand-in for the external aligner: QC, aligned and translated rows
    for the records handed to it (derived from their fields); it fails to
    align the records whose id ends in 7."""
    ids = changed.select(F.col("id").alias("seqName"), "samplingStrategy", "pangoLineage")
    qc = ids.select("seqName",
                    F.concat(F.lit("clade-"), F.substring("samplingStrategy", 1, 1)).alias("clade_nextstrain"),
                    F.col("pangoLineage").alias("Nextclade_pango"),
                    F.lit("").alias("insertions"), F.lit("").alias("aaInsertions"))
    aligned = changed.where(~F.col("id").endswith("7")).select(
        F.col("id").alias("sample_name"), F.concat(F.lit("--"), F.col("unaligned_nuc")["main"], F.lit("-"))
        .alias("sequence"))
    tr = changed.select(F.col("id").alias("sample_name"), F.lit("S").alias("gene"),
                        F.lit("MKV").alias("sequence"))
    return qc, aligned, tr


W2_OUT = ("gisaidEpiIsl", "strain", "samplingStrategy", "pangoLineage", "nextcladePangoLineage",
          "region", "country", "division", "nextstrainClade", "nextcladeDatasetVersion", "age",
          "date", "dateMonth")


REFRESH_SPEC = with_template(FEED, {"main": 6}, {"S": 3})


def _refresh(spark, sf):
    rules = G.rules_from_pairs(spark, GEO_RULES)
    # previous snapshot: v1 processed against an empty history
    empty = spark.createDataFrame([], "gisaidEpiIsl string, md5 string")
    p1 = J.prepare(_feed(spark, sf, 1), rules, empty)
    qc1, al1, tr1 = _aligner_output(spark, sf, p1.changed)
    empty_pub = spark.createDataFrame([], "gisaidEpiIsl string")
    pub1, _ = J.finish(p1.changed, qc1, al1, tr1, ["S"], empty_pub, p1.diff, None, "v1", spec=REFRESH_SPEC)
    # the previous snapshot is a written table, as after a publish; its label
    # list is read from the written rows
    pub1 = cut_lineage(pub1, "published")
    # current run: v2 against v1's hashes and published rows
    p2 = J.prepare(_feed(spark, sf, 2), rules, p1.hashes)
    qc2, al2, tr2 = _aligner_output(spark, sf, p2.changed)
    return J.finish(p2.changed, qc2, al2, tr2, ["S"], pub1, p2.diff, J.lineages(pub1), "v2", spec=REFRESH_SPEC)


def incremental_refresh(spark, sf):
    """W2 (W2a normalise + fingerprint, J5 diff, W2b extract, enrichment,
    J6b unchanged, U1 merge): unchanged rows keep the old dataset version."""
    published, _lin = _refresh(spark, sf)
    return published.select(*W2_OUT, F.col("main.sequence").alias("main_seq"))


def paired_refresh(spark, sf):
    """J1/J3 in the job: a feed with several records per id (the lines of an
    order); QC rows are paired with them by position."""
    li = table(spark, sf, "lineitem")
    n = F.col("l_linenumber")
    ident = F.concat(F.lit("L"), F.col("l_orderkey").cast("string"))
    fields = {c: F.lit(None).cast("string") for c in R.FEED_SCHEMA.fieldNames()}
    fields |= {"covv_accession_id": ident, "sequence": F.lit("AC"), "covv_virus_name": F.concat_ws(
        "-", F.col("l_orderkey").cast("string"), n.cast("string"))}
    feed = li.select(*[c.alias(k) for k, c in fields.items()], n.alias("ordinal"))
    empty = spark.createDataFrame([], "gisaidEpiIsl string, md5 string")
    p = J.prepare(feed, None, empty)
    qc = li.select(ident.alias("seqName"), F.concat(F.lit("c"), n.cast("string")).alias("clade_nextstrain"),
                   n.alias("ordinal"))
    aligned = li.select(ident.alias("sample_name"), F.repeat(F.lit("A"), n.cast("int")).alias("sequence"),
                        n.alias("ordinal"))
    genes = aligned.withColumn("gene", F.lit("S"))
    published, _ = J.finish(p.changed, qc, aligned, genes, ["S"], spark.createDataFrame(
        [], "gisaidEpiIsl string"), p.diff, None, "v1")
    return published.select("gisaidEpiIsl", "strain", "nextstrainClade", F.col("main.sequence").alias("main_seq"),
                            F.col("S.sequence").alias("s_seq"))


def sorted_changed(spark, sf):
    """W2b + O1/O2: the records to re-process in a global stable order by a
    chosen column (id, or strain); position of each in both orders."""
    empty = spark.createDataFrame([], "gisaidEpiIsl string, md5 string")
    p = J.prepare(_feed(spark, sf, 2).withColumn("ordinal", F.col("covv_accession_id")), None, empty,
                  sort_changed=True)
    by_id = sorted_positions(p.changed.select("gisaidEpiIsl", "strain"), "gisaidEpiIsl", name="by_id")
    return sorted_positions(by_id, "strain", name="by_strain").select("gisaidEpiIsl", "by_id", "by_strain")


def _write_rules(spark, path):
    spark.createDataFrame([("\n".join("\t".join(pair) for pair in GEO_RULES),)], "value string") \
        .coalesce(1).write.text(path)


def _write_template(spark, path, nuc, aa):
    template = spark.createDataFrame([("t", {k: "A" * n for k, n in nuc.items()}, {k: "A" * n for k, n in aa.items()})],
                                     R.TEMPLATE_SCHEMA)
    template.coalesce(1).write.json(path)


def aligner_input(spark, sf):
    """W2 first half from files (W2a, W2c, S1): feed NDJSON and rules file ->
    fingerprints, diff, and the aligner's FASTA, read back."""
    root = shared_path(spark, "prepare")
    W.write_ndjson(_feed(spark, sf, 2), f"{root}/feed")
    _write_rules(spark, f"{root}/rules")
    runs.run_prepare(spark, f"{root}/feed", f"{root}/rules", f"{root}/archive", f"{root}/stage")
    return R.read_fasta(spark, f"{root}/stage/aligner_input")


def refresh_from_files(spark, sf):
    """W2 from files, both halves and both feeds: NDJSON and rules file ->
    prepare -> the aligner's TSV and FASTA files -> finish, published, and
    the second version read back.  Same rows as ``incremental_refresh``."""
    root = shared_path(spark, "refresh")
    _write_rules(spark, f"{root}/rules")
    _write_template(spark, f"{root}/template", {"main": 6}, {"S": 3})
    for n in (1, 2):
        feed, stage, out = f"{root}/feed{n}", f"{root}/stage{n}", f"{root}/aligner{n}"
        W.write_ndjson(_feed(spark, sf, n), feed)
        runs.run_prepare(spark, feed, f"{root}/rules", f"{root}/archive", stage)
        changed = spark.read.parquet(f"{stage}/changed").withColumn("id", F.col("gisaidEpiIsl"))
        qc, aligned, genes = _aligner_output(spark, sf, changed)
        _write_tsv(qc, f"{out}/qc")
        W.write_fasta(aligned, f"{out}/aligned", "sample_name", "sequence")
        W.write_fasta(genes, f"{out}/S", "sample_name", "sequence")
        v = runs.run_finish(spark, stage, f"{out}/qc", f"{out}/aligned", {"S": f"{out}/S"}, f"{root}/archive",
                            f"v{n}", version=str(n), template_json=f"{root}/template", remove_stage=True)
    published = R.read_snapshot(spark, f"{root}/archive", v, "data")
    return published.select(*W2_OUT, F.col("main.sequence").alias("main_seq"))


FEW_BEFORE, FEW_SINCE = "1995-02-01", "2001-01-01"


def refresh_few(spark, sf):
    """U1 + K7, copy on write: all orders published; then the latest urgent
    pending ones are re-prioritised and the oldest finished ones leave, about one in
    a hundred; the next version carries the other rows' files over."""
    root = shared_path(spark, "few")
    old = order_record(table(spark, sf, "orders"))
    gone = (F.col("o_orderstatus") == "F") & (F.col("o_orderdate") < FEW_BEFORE)
    urgent = (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "1-URGENT") & (
        F.col("o_orderdate") >= FEW_SINCE)
    new = old.where(~gone).withColumn("o_orderpriority", F.when(
        urgent, F.concat("o_orderpriority", F.lit("*"))).otherwise(F.col("o_orderpriority")))
    A.publish_snapshot(spark, root, old, hashes=D.fingerprint(old, "o_orderkey", ORDER_FIELDS), version="1",
                       id_col="o_orderkey")
    hashes = D.fingerprint(new, "o_orderkey", ORDER_FIELDS)
    diff = cut_lineage(D.snapshot_diff(R.read_snapshot(spark, root, "1", "hashes"), hashes), "few-diff")
    changed = D.extract_added_or_changed(new, diff, "o_orderkey", diff_covers_entries=True)
    A.publish_refresh(spark, root, "1", diff, changed, hashes=hashes, version="2")
    return R.read_snapshot(spark, root, "2")


def _write_tsv(df, path):
    (df.write.option("sep", "\t").option("header", True).option("quote", '"').option("escape", '"')
     .option("emptyValue", "").csv(path))


def rebuild_from_files(spark, sf):
    """W1 from files (S13): the named input set written as TSV, FASTA and
    template JSON, run, published as NDJSON (K7) and read back."""
    root = shared_path(spark, "rebuild")
    i = rebuild_inputs(spark, sf)
    for name in ("metadata", "qc"):
        _write_tsv(i[name].drop("ordinal"), f"{root}/{name}")
    # whole texts; a line that starts like a header gets a blank before
    texts = i["sequences"].select("sample_name", F.regexp_replace(
        F.coalesce("sequence", F.lit("")), "(?m)^>", " >").alias("sequence"))
    W.write_fasta(texts, f"{root}/sequences", "sample_name", "sequence")
    W.write_fasta(i["aligned"], f"{root}/aligned", "sample_name", "sequence")
    for g in GENES:
        W.write_fasta(i["translations"].where(F.col("gene") == g), f"{root}/{g}", "sample_name", "sequence")
    template = spark.createDataFrame([(
        "t", {k: "A" * n for k, n in TEMPLATE_NUC.items()}, {k: "A" * n for k, n in TEMPLATE_AA.items()})],
        R.TEMPLATE_SCHEMA)
    template.coalesce(1).write.json(f"{root}/template")
    v = runs.run_full_rebuild(spark, f"{root}/metadata", f"{root}/qc", f"{root}/sequences", f"{root}/aligned",
                              {g: f"{root}/{g}" for g in GENES}, f"{root}/archive", version="1",
                              template_json=f"{root}/template", fmt="json", compression="gzip")
    return _rebuilt(R.read_snapshot(spark, f"{root}/archive", v, "data"))


QUERIES = {
    "paired_refresh": paired_refresh,
    "sorted_changed": sorted_changed,
    "aligner_input": aligner_input,
    "refresh_from_files": refresh_from_files,
    "refresh_few": refresh_few,
    "rebuild_from_files": rebuild_from_files,
    "sorted_output": sorted_output,
    "full_rebuild": full_rebuild,
    "rebuild_lineages": rebuild_lineages,
    "incremental_refresh": incremental_refresh,
}

# ----------------------------------------------------------------- oracles


def _nm(c: str) -> str:
    return f"CASE WHEN {c} IN ('', '?') THEN NULL ELSE {c} END"


def _pd(s: str, f: str) -> str:
    from .q_columns import sql_partial_date
    return sql_partial_date(s, f)


_SQL_REBUILD_JOINED = f"""
  SELECT m.*, q.clade_nextstrain, q.qc_missing, q.ins, q.aa_ins, q.pango, q.seqName IS NOT NULL AS has_qc,
         s.useq, a.aseq, g.sseq, o.oseq
  FROM (SELECT CASE WHEN doc_id % 11 = 0 THEN '?' ELSE 'doc' || doc_id END AS strain_raw,
               CASE doc_id % 3 WHEN 0 THEN '2021-0' || (1 + doc_id % 9) || '-1' || (doc_id % 10)
                    WHEN 1 THEN '2021-XX-XX' ELSE '2021' END AS date_raw,
               lang AS country, source AS division,
               CASE WHEN doc_id % 5 = 0 THEN '' ELSE 'Human' END AS host_raw,
               CASE WHEN source IN ('src1', 'src2') THEN 'rki' ELSE 'genbank' END AS database,
               CAST(n_chars % 90 AS VARCHAR) AS age_raw,
               CASE WHEN doc_id % 4 = 0 THEN '?' ELSE 'female' END AS sex_raw,
               'GB' || doc_id AS gbrev,
               '20' || substr('ABC', CAST(doc_id % 3 + 1 AS INTEGER), 1) AS ns_clade,
               doc_id
        FROM documents) m
  LEFT JOIN (SELECT 'doc' || doc_id AS seqName, 'Q' || quality AS clade_nextstrain,
                    quality || '.5' AS qc_missing,
                    CASE WHEN doc_id % 2 = 0 THEN '100:A,200:CC' ELSE '' END AS ins,
                    CASE WHEN doc_id % 3 = 0 THEN 'S:5:K,ORF1a:7:M' ELSE '' END AS aa_ins,
                    CASE WHEN quality = 1 THEN 'B.1' ELSE 'Unassigned' END AS pango
             FROM labels) q ON q.seqName = m.strain_raw
  LEFT JOIN (SELECT 'doc' || doc_id AS k, text AS useq FROM documents) s
    ON s.k = m.strain_raw
  LEFT JOIN (SELECT 'doc' || vec_id AS k,
                    repeat('-', CAST(vec_id % 3 AS INTEGER)) || 'ACGTN'
                      || repeat('-', CAST(label % 2 + 1 AS INTEGER)) AS aseq FROM embeddings) a
    ON a.k = m.strain_raw
  LEFT JOIN (SELECT 'doc' || page_id AS k, url AS sseq FROM pages) g
    ON g.k = m.strain_raw
  LEFT JOIN (SELECT 'doc' || page_id AS k, repeat('-', CAST(page_id % 2 AS INTEGER)) || 'MK' AS oseq
             FROM pages) o ON o.k = m.strain_raw"""


def _mask_both(s: str, fill: str) -> str:
    from .q_columns import _sql_mask_both
    return _sql_mask_both(s, fill)


def _mask_lead(s: str, fill: str) -> str:
    from .q_columns import _sql_mask_lead
    return _sql_mask_lead(s, fill)


_SQL_REBUILD = f"""
  SELECT strain, date, dateYear, dateMonth, dateDay, country, division,
         CASE WHEN database = 'rki' THEN 'Homo sapiens' ELSE host END AS host,
         database, age, sex, genbankAccessionRev AS usherTree, nextstrainClade,
         nextcladeQcOverallScore, nextcladeQcMissingDataScore, nextcladePangoLineage, genbankAccessionRev,
         CAST(NULL AS VARCHAR) AS died, unaligned_main,
         -- a missing aligned sequence is N or X of the template's length
         coalesce(main_seq, repeat('N', 12)) AS main_seq, ins AS main_ins,
         coalesce(s_seq, repeat('X', 9)) AS s_seq, s_ins,
         coalesce(orf1a_seq, repeat('X', 5)) AS orf1a_seq, orf1a_ins
  FROM (SELECT {_nm('strain_raw')} AS strain, {_pd(_nm('date_raw'), 'date')},
               country, division, {_nm('host_raw')} AS host, database,
               CAST(age_raw AS INTEGER) AS age, {_nm('sex_raw')} AS sex, gbrev AS genbankAccessionRev,
               CASE WHEN has_qc THEN clade_nextstrain END AS nextstrainClade,
               -- the open flavour maps QC_overall_score (absent here), not qc.overallScore
               CAST(NULL AS DOUBLE) AS nextcladeQcOverallScore,
               CASE WHEN has_qc THEN CAST(qc_missing AS DOUBLE) END AS nextcladeQcMissingDataScore,
               CASE WHEN pango IN ('Unassigned', 'unclassifiable') THEN NULL ELSE pango END
                 AS nextcladePangoLineage,
               useq AS unaligned_main,
               {_mask_both('aseq', 'N')} AS main_seq,
               CASE WHEN ins IS NULL OR trim(ins) = '' THEN '' ELSE ins END AS ins,
               sseq AS s_seq,
               CASE WHEN aa_ins LIKE '%S:%' THEN '5:K' ELSE '' END AS s_ins,
               {_mask_lead('oseq', 'X')} AS orf1a_seq,
               CASE WHEN aa_ins LIKE '%ORF1a:%' THEN '7:M' ELSE '' END AS orf1a_ins
        FROM ({_SQL_REBUILD_JOINED}))
  WHERE strain IS NOT NULL"""

# Incremental refresh, derived without fingerprints: an id present in both
# feeds is "changed" exactly when its priority was edited (pending orders);
# unchanged ids keep their v1 rows (dataset version v1).

_SQL_FEED_BASE = """
  SELECT o_orderkey, o_orderstatus AS st, 'EPI_' || o_orderkey AS id,
         'hCoV/' || o_custkey || '/' || o_orderkey AS strain,
         strftime(o_orderdate, '%Y-%m-%d') AS date_raw, CAST(o_custkey % 90 AS INTEGER) AS age,
         o_orderpriority AS prio, 'B.' || (o_custkey % 30) AS pango,
         r_name AS c0, n_name AS c1, c_mktsegment AS c2, '' AS c3
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
       JOIN region ON n_regionkey = r_regionkey"""


def _sql_geo_resolve(src: str, rounds: int = 6) -> str:
    cur = src
    carry = ("o_orderkey", "st", "id", "strain", "date_raw", "age", "prio", "pango")
    for _ in range(rounds):
        looked = sql_geo_lookup(cur, carry=carry)
        cur = (f"SELECT {', '.join(carry)}, " + ", ".join(
            f"CASE WHEN r{i} IS NULL OR r{i} = '*' THEN c{i} ELSE r{i} END AS c{i}" for i in range(4))
            + f" FROM ({looked})")
    return cur


def _sql_refresh() -> str:
    geo = _sql_geo_resolve(f"SELECT * FROM ({_SQL_FEED_BASE})")
    return f"""
  WITH prefixes AS ({_prefix_values()}),
  base AS ({geo}),
  v1 AS (SELECT * FROM base WHERE date_raw < '{SNAPSHOT_TIME}'),
  v2 AS (SELECT o_orderkey, st, id, strain, date_raw, age,
                CASE WHEN st = 'P' THEN prio || '*' ELSE prio END AS prio, pango, c0, c1, c2, c3
         FROM base WHERE NOT (st = 'F' AND date_raw < '{ARCHIVED_BEFORE}')),
  rows AS (
    SELECT v1.*, 'v1' AS ver FROM v1
      WHERE o_orderkey IN (SELECT o_orderkey FROM v2) AND st <> 'P'
    UNION ALL
    SELECT v2.*, 'v2' AS ver FROM v2
      WHERE o_orderkey NOT IN (SELECT o_orderkey FROM v1) OR st = 'P')
  SELECT id AS gisaidEpiIsl, strain, prio AS samplingStrategy, pango AS pangoLineage,
         pango AS nextcladePangoLineage,
         nullif(c0, '') AS region, nullif(c1, '') AS country, nullif(c2, '') AS division,
         'clade-' || substr(prio, 1, 1) AS nextstrainClade, ver AS nextcladeDatasetVersion, age,
         date_raw AS date, CAST(substr(date_raw, 6, 2) AS INTEGER) AS dateMonth,
         CASE WHEN o_orderkey % 10 = 7 THEN repeat('N', 6)
              ELSE 'NN' || repeat('ACGT', CAST(1 + o_orderkey % 3 AS INTEGER)) || 'N' END AS main_seq
  FROM rows"""


ORACLE = {
    "paired_refresh": """
      SELECT 'L' || l_orderkey AS gisaidEpiIsl, l_orderkey || '-' || l_linenumber AS strain,
             'c' || l_linenumber AS nextstrainClade, repeat('A', CAST(l_linenumber AS INTEGER)) AS main_seq,
             repeat('A', CAST(l_linenumber AS INTEGER)) AS s_seq
      FROM lineitem""",
    "sorted_changed": f"""
      SELECT id AS gisaidEpiIsl, row_number() OVER (ORDER BY id) AS by_id, row_number() OVER (ORDER BY strain) AS by_strain
      FROM ({_SQL_FEED_BASE}) WHERE NOT (st = 'F' AND date_raw < '{ARCHIVED_BEFORE}')""",
    "aligner_input": f"""
      SELECT id AS sample_name, repeat('ACGT', CAST(1 + o_orderkey % 3 AS INTEGER)) AS sequence
      FROM ({_SQL_FEED_BASE}) WHERE NOT (st = 'F' AND date_raw < '{ARCHIVED_BEFORE}')""",
    # a FASTA record's sequence is its lines that are not blank, put together
    "rebuild_from_files": _SQL_REBUILD.replace("text AS useq FROM documents", """array_to_string(list_filter(
             list_transform(string_split(coalesce(text, ''), chr(10)),
               lambda x: CASE WHEN x[1] = '>' THEN ' ' || x ELSE x END),
             lambda x: regexp_matches(x, '\\S')), '') AS useq FROM documents"""),
    "sorted_output": """
      SELECT o_orderkey, row_number() OVER (ORDER BY o_orderpriority, o_orderkey) AS pos FROM orders""",
    "full_rebuild": _SQL_REBUILD,
    "rebuild_lineages": f"""
      SELECT DISTINCT value FROM (
        SELECT CASE WHEN pango IN ('Unassigned', 'unclassifiable') THEN NULL ELSE pango END AS value
        FROM ({_SQL_REBUILD_JOINED}) WHERE strain_raw <> '?')
      WHERE value IS NOT NULL""",
    "incremental_refresh": _sql_refresh(),
    "refresh_from_files": _sql_refresh(),
    "refresh_few": f"""
      SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice_cents, o_orderdate,
             CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT'
                  AND o_orderdate >= '{FEW_SINCE}' THEN o_orderpriority || '*'
                  ELSE o_orderpriority END AS o_orderpriority
      FROM ({SQL_ORDER_RECORD}) WHERE NOT (o_orderstatus = 'F' AND o_orderdate < '{FEW_BEFORE}')""",
}
