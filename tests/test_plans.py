"""Plan regressions: no Python evaluation anywhere, pruned scans, and the
shuffle-free paths the design relies on."""
import pytest

import __spark_entry__ as E
from genoflux.queries import registry
from genoflux.operators import diff as D

SF = "/root/testdata/sf0.001"
PY_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas",
            "PythonUDF", "MapInArrow")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(registry.all_queries()))
def test_no_python_in_plan(spark, name):
    p = plan_of(E.queries()[name](spark, SF))
    assert not any(n in p for n in PY_NODES), name


def test_scan_prunes_columns(spark):
    p = plan_of(E.queries()["deleted_ids"](spark, SF))
    assert "o_totalprice" not in p and "o_custkey" not in p


def test_unchanged_is_broadcast_anti_join(spark):
    prev = spark.range(1000).selectExpr("cast(id as string) as id", "repeat('A', 100) as seq")
    diff = spark.range(1000).selectExpr("cast(id as string) as id",
                                        "case when id % 10 = 0 then 'changed' else 'unchanged' end as status")
    out = D.extract_unchanged(prev, diff, previous_matches_diff=True)
    p = plan_of(out)
    assert "BroadcastHashJoin" in p and "LeftAnti" in p
    assert out.count() == 900


def test_unique_keys_number_without_window(spark):
    from genoflux.operators.zipjoin import key_row_number
    df = spark.range(100).selectExpr("cast(id as string) as k", "id as o")
    p = plan_of(key_row_number(df, "k", "o"))
    assert "Window" not in p


def test_enrichment_does_not_broadcast_by_file_size(spark):
    """Stage tables of the aligner's rows compress to a small part of what
    they hold; the joins with them are merge joins."""
    from genoflux.plans.enrich import enrich_entries
    from genoflux.session import cut_lineage
    k = "concat('EPI_', id)"
    rows = spark.range(5_000)
    changed = cut_lineage(rows.selectExpr(f"{k} as id", "map('main', 'ACGT') as unaligned_nuc"), "changed")
    qc = cut_lineage(rows.selectExpr(f"{k} as seqName", "'20A' as clade_nextstrain"), "qc")
    aligned = cut_lineage(rows.selectExpr(f"{k} as sample_name", "'ACGT' as sequence"), "aligned")
    genes = cut_lineage(rows.selectExpr(f"{k} as sample_name", "'S' as gene", "'MK' as sequence"), "genes")
    out = enrich_entries(changed, qc, aligned, genes, ["S"], "v1")
    assert "BroadcastHashJoin" not in plan_of(out) and plan_of(out).count("SortMergeJoin") == 3
    assert out.where("aligned_aa['S'] = 'MK'").count() == 5_000


def _paired_inputs(spark):
    """Records whose key repeats (k0 .. k4, 1 to 5 times) and aligner rows for
    some of their positions, two genes and one that no one asks for."""
    keys = [(f"k{i}", n) for i in range(5) for n in range(i + 1)]
    entries = spark.createDataFrame([(k, f"{k}-{n}", {"main": "ACGT"}, n) for k, n in keys],
                                    "id string, strain string, unaligned_nuc map<string,string>, ordinal int")
    qc = spark.createDataFrame([(k, f"c{n}", n) for k, n in keys if n != 3],
                               "seqName string, clade_nextstrain string, ordinal int")
    aligned = spark.createDataFrame([(k, "A" * (n + 1), n) for k, n in keys if k != "k1"],
                                    "sample_name string, sequence string, ordinal int")
    genes = spark.createDataFrame(
        [(k, "S", "M" * (n + 1), n) for k, n in keys] + [("other", "S", "M", 1)]
        + [(k, "N", "K" * (n + 1), n) for k, n in keys if n % 2] + [(k, "E", "Q", n) for k, n in keys],
        "sample_name string, gene string, sequence string, ordinal int")
    return keys, entries, qc, aligned, genes


def test_gene_rows_are_put_together_without_lists(spark):
    from genoflux.plans.enrich import enrich_entries
    keys, *inputs = _paired_inputs(spark)
    out = enrich_entries(*inputs, ["S", "N"], "v1")
    assert "collect_list" not in plan_of(out)
    got = {r.strain: (r.aligned_nuc["main"], dict(r.aligned_aa)) for r in out.collect()}
    # positions of N: the odd n come 1st, 2nd, ..
    assert got == {f"{k}-{n}": (None if k == "k1" else "A" * (n + 1), {
        "S": "M" * (n + 1), "N": "K" * (2 * n + 2) if 2 * n + 1 <= int(k[1]) else None}) for k, n in keys}


def test_a_gene_row_without_a_name_fails(spark):
    from genoflux.plans.enrich import enrich_entries
    _, entries, qc, aligned, genes = _paired_inputs(spark)
    unnamed = genes.unionByName(spark.createDataFrame([("k4", None, "M", 9)], genes.schema))
    with pytest.raises(Exception, match="without name"):
        enrich_entries(entries, qc, aligned, unnamed, ["S"], "v1").collect()


def test_prepare_tells_by_counts_that_the_diff_knows_every_entry(spark, monkeypatch):
    """The diff has a row for each landed row; no join of ids has to show it."""
    from genoflux.plans import jobs as J
    from genoflux.queries import q_jobs as Q

    def joined(*_):
        raise AssertionError("ids of entries and diff were joined")
    monkeypatch.setattr(D, "_all_in_diff", joined)
    empty = spark.createDataFrame([], "gisaidEpiIsl string, md5 string")
    p = J.prepare(Q._feed(spark, SF, 1), None, empty, max_bytes=100)
    assert p.changed.count() == p.hashes.count() > 0


def test_landed_feed_leaves_out_the_empty_maps(spark):
    from genoflux.plans import jobs as J
    from genoflux.queries import q_jobs as Q
    e = J.normalise_feed(Q._feed(spark, SF, 1), None, land=True)
    kept = J.normalise_feed(Q._feed(spark, SF, 1), None)
    scan = next(line for line in plan_of(e).splitlines() if "FileScan" in line)
    assert "unaligned_nuc" in scan and "aa_insertions" not in scan
    assert e.drop(D.FILE, D.ROW).dtypes == kept.dtypes
    assert sorted(e.select("id", "md5").collect()) == sorted(kept.select("id", "md5").collect())
