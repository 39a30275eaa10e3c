"""File-level runs: full rebuild from TSV/FASTA files; incremental refresh
prepare -> (simulated aligner) -> finish, twice, against a versioned archive."""
import os

from pyspark.sql import functions as F

from genoflux.plans import runs
from genoflux.sources import readers as R
from genoflux.sources import writers as W

SF = "/root/testdata/sf0.001"


def _tsv(df, path):
    df.coalesce(2).write.option("sep", "\t").option("header", True).option("quote", '"') \
        .option("escape", '"').csv(path)


def test_full_rebuild_from_files(spark, tmp_dir):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    meta = d.select(F.concat(F.lit("s"), F.col("doc_id").cast("string")).alias("strain"),
                    F.lit("2021-05-03").alias("date"), F.col("lang").alias("country"),
                    F.when(F.col("doc_id") % 2 == 0, F.lit("rki")).otherwise(F.lit("genbank")).alias("database"),
                    F.lit("").alias("host"), F.lit("42").alias("age"))
    qc = d.where(F.col("doc_id") % 3 == 0).select(
        F.concat(F.lit("s"), F.col("doc_id").cast("string")).alias("seqName"),
        F.lit("20A").alias("clade_nextstrain"), F.lit("0.5").alias("qc.missingData.score"),
        F.lit("1:A").alias("insertions"), F.lit("S:2:K").alias("aaInsertions"))
    fasta = d.select(F.concat(F.lit(">s"), F.col("doc_id").cast("string"), F.lit("\n"),
                              F.lit("--ACGT-")).alias("value"))
    s_gene = d.select(F.concat(F.lit(">s"), F.col("doc_id").cast("string"), F.lit("\nMKV")).alias("value"))
    _tsv(meta, f"{tmp_dir}/meta"); _tsv(qc, f"{tmp_dir}/qc")
    fasta.write.text(f"{tmp_dir}/seq"); fasta.write.text(f"{tmp_dir}/aln"); s_gene.write.text(f"{tmp_dir}/S")
    v = runs.run_full_rebuild(spark, f"{tmp_dir}/meta", f"{tmp_dir}/qc", f"{tmp_dir}/seq", f"{tmp_dir}/aln",
                              {"S": f"{tmp_dir}/S"}, f"{tmp_dir}/archive", version="1")
    out = R.read_snapshot(spark, f"{tmp_dir}/archive", v, "data")
    assert out.count() == d.count()
    r = out.where("strain = 's3'").first().asDict(recursive=True)
    assert r["main"]["sequence"] == "NNACGTN" and r["unaligned_main"] == "--ACGT-"
    assert r["nextstrainClade"] == "20A" and r["nextcladeQcMissingDataScore"] == 0.5
    assert r["S"] == {"sequence": "MKV", "insertions": ["2:K"]}
    assert r["host"] in (None, "Homo sapiens") and r["age"] == 42 and r["dateYear"] == 2021


def _feed_file(spark, path, version):
    o = spark.read.parquet(f"{SF}/orders.parquet")
    k = F.col("o_orderkey")
    o = o.where(k % 10 != (0 if version == 1 else 1))
    prio = F.col("o_orderpriority") if version == 1 else F.when(
        k % 7 == 0, F.concat("o_orderpriority", F.lit("*"))).otherwise(F.col("o_orderpriority"))
    feed = o.select(F.concat(F.lit("EPI_"), k.cast("string")).alias("covv_accession_id"),
                    F.concat(F.lit("v/"), k.cast("string")).alias("covv_virus_name"),
                    prio.alias("covv_sampling_strategy"),
                    F.lit("europe / nation_3 / x").alias("covv_location"),
                    F.lit("AC").alias("sequence"))
    W.write_ndjson(feed, path)
    return feed.count()


def _aligner(spark, stage, out):
    changed = spark.read.parquet(f"{stage}/changed")
    _tsv(changed.select(F.col("gisaidEpiIsl").alias("seqName"), F.lit("21K").alias("clade_nextstrain"),
                        F.lit("").alias("insertions"), F.lit("").alias("aaInsertions")), f"{out}/qc")
    # the aligner reads the FASTA the prepare step wrote
    fa = R.read_fasta(spark, f"{stage}/aligner_input")
    fa.select(F.concat(F.lit(">"), "sample_name", F.lit("\n-"), "sequence").alias("value")).write.text(f"{out}/aln")
    fa.select(F.concat(F.lit(">"), "sample_name", F.lit("\nMK")).alias("value")).write.text(f"{out}/S")


def test_incremental_runs(spark, tmp_dir):
    rules = os.path.join(tmp_dir, "rules.tsv")
    with open(rules, "w") as f:
        f.write("europe/nation_3/*/*\tEurope/Nation Three/*/*\n")
    archive = f"{tmp_dir}/archive"
    n1 = _feed_file(spark, f"{tmp_dir}/feed1", 1)
    c1 = runs.run_prepare(spark, f"{tmp_dir}/feed1", rules, archive, f"{tmp_dir}/stage1")
    assert c1 == {"added": n1}
    _aligner(spark, f"{tmp_dir}/stage1", f"{tmp_dir}/al1")
    v1 = runs.run_finish(spark, f"{tmp_dir}/stage1", f"{tmp_dir}/al1/qc", f"{tmp_dir}/al1/aln",
                         {"S": f"{tmp_dir}/al1/S"}, archive, "ds1", version="100")
    n2 = _feed_file(spark, f"{tmp_dir}/feed2", 2)
    c2 = runs.run_prepare(spark, f"{tmp_dir}/feed2", rules, archive, f"{tmp_dir}/stage2")
    assert set(c2) == {"added", "changed", "unchanged", "deleted"}
    _aligner(spark, f"{tmp_dir}/stage2", f"{tmp_dir}/al2")
    v2 = runs.run_finish(spark, f"{tmp_dir}/stage2", f"{tmp_dir}/al2/qc", f"{tmp_dir}/al2/aln",
                         {"S": f"{tmp_dir}/al2/S"}, archive, "ds2", version="200")
    assert (v1, v2) == ("100", "200") and W.latest_version(spark, archive) == "200"
    pub = R.read_snapshot(spark, archive, v2, "data")
    assert pub.count() == n2
    by_ver = {r["nextcladeDatasetVersion"]: r["count"] for r in
              pub.groupBy("nextcladeDatasetVersion").count().collect()}
    assert by_ver == {"ds1": c2["unchanged"], "ds2": c2["added"] + c2["changed"]}
    row = pub.first().asDict(recursive=True)
    assert row["country"] == "Nation Three" and row["main"]["sequence"] == "NAC"


def test_duplicate_ids_pair_in_feed_order(spark, tmp_dir):
    """20 ids with two records each, the aligner's files in feed order: every
    published row carries its own record's clade, and a missing aligned
    sequence is filled from the template."""
    import json
    lines, ids = [], [f"EPI_{i}" for i in range(20)]
    for copy in (1, 2):
        for i in ids if copy == 1 else reversed(ids):
            lines.append({"covv_accession_id": i, "covv_virus_name": f"v{copy}{i}", "covv_host": f"h{(copy * 7) % 3}",
                          "covv_location": "a / b", "sequence": "AC"})
    os.makedirs(f"{tmp_dir}/feed")
    with open(f"{tmp_dir}/feed/f.json", "w") as f:
        f.write("".join(json.dumps(r) + "\n" for r in lines))
    with open(f"{tmp_dir}/template.json", "w") as f:
        json.dump({"id": "t", "nucleotideSequences": {"main": "ACGTA"}, "aminoAcidSequences": {"S": "MKV", "N": "MK"}}, f)
    counts = runs.run_prepare(spark, f"{tmp_dir}/feed", None, f"{tmp_dir}/archive", f"{tmp_dir}/stage")
    assert counts == {"added": 40}
    with open(f"{tmp_dir}/qc.tsv", "w") as q, open(f"{tmp_dir}/aln", "w") as a, open(f"{tmp_dir}/S", "w") as s, \
            open(f"{tmp_dir}/N", "w") as n:
        q.write("seqName\tclade_nextstrain\tinsertions\taaInsertions\n")
        n.write(">nobody\nMK\n")
        for k, r in enumerate(lines):
            q.write(f"{r['covv_accession_id']}\tclade-{r['covv_virus_name']}\t1:A\t\n")
            a.write(f">{r['covv_accession_id']}\n-{'ACGT'[k % 4]}\n")
            s.write(f">{r['covv_accession_id']}\nM\n")
    v = runs.run_finish(spark, f"{tmp_dir}/stage", f"{tmp_dir}/qc.tsv", f"{tmp_dir}/aln",
                        {"S": f"{tmp_dir}/S", "N": f"{tmp_dir}/N"}, f"{tmp_dir}/archive", "d1", version="1",
                        template_json=f"{tmp_dir}/template.json")
    rows = R.read_snapshot(spark, f"{tmp_dir}/archive", v, "data").collect()
    assert len(rows) == 40 and all(r["nextstrainClade"] == f"clade-{r['strain']}" for r in rows)
    own = {r["covv_virus_name"]: "N" + "ACGT"[k % 4] for k, r in enumerate(lines)}
    assert all(r["main"]["sequence"] == own[r["strain"]] for r in rows)
    assert {r["N"]["sequence"] for r in rows} == {"XX"}


def test_a_feed_record_without_id_fails(spark, tmp_dir):
    with open(f"{tmp_dir}/f.json", "w") as f:
        f.write('{"covv_accession_id": "unknown", "sequence": "A"}\n')
    import pytest
    with pytest.raises(Exception, match="no gisaidEpiIsl"):
        runs.run_prepare(spark, f"{tmp_dir}/f.json", None, f"{tmp_dir}/archive", f"{tmp_dir}/stage")


def test_repeated_keys_without_an_order_fail(spark):
    import pytest
    from genoflux.plans import enrich
    base = spark.createDataFrame([("a", "x"), ("a", "y")], "strain string, region string")
    one = spark.createDataFrame([("a", "s")], "sample_name string, sequence string")
    genes = one.selectExpr("sample_name", "'S' AS gene", "sequence")
    qc = spark.createDataFrame([("a", "c")], "seqName string, clade string")
    with pytest.raises(ValueError, match="orders its rows"):
        enrich.enrich_open(base, qc, one, one, genes, ["S"])
