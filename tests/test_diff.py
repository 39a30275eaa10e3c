"""Snapshot diff (F12) and its invariants."""
from pyspark.sql import functions as F

from genoflux.operators import diff as D
from genoflux.session import cut_lineage


def _diff(spark, old, new):
    o = spark.createDataFrame([(i, h, n) for n, (i, h) in enumerate(old)], "id string, md5 string, ord long")
    nn = spark.createDataFrame(new, "id string, md5 string")
    d = D.snapshot_diff(o, nn, old_ordinal="ord")
    out = {}
    for r in d.collect():
        out.setdefault(r["status"], []).append(r["id"])
    return {k: sorted(v) for k, v in out.items()}


def test_fixture_example(spark):
    old = [("a", "1"), ("b", "2"), ("c", "3"), ("c", "4")]
    new = [("b", "2"), ("c", "4"), ("d", "9"), ("a", "7")]
    assert _diff(spark, old, new) == {"added": ["d"], "changed": ["a"], "unchanged": ["b", "c"]}
    assert _diff(spark, old, [("b", "2")]) == {"unchanged": ["b"], "deleted": ["a", "c"]}


def test_new_duplicates_each_classified(spark):
    got = _diff(spark, [("a", "1")], [("a", "1"), ("a", "2")])
    assert got == {"unchanged": ["a"], "changed": ["a"]}


def test_second_run_all_unchanged_and_cover(spark):
    import random
    rnd = random.Random(3)
    old = [(f"id{i}", str(rnd.randint(0, 3))) for i in range(300)]
    new = [(f"id{i}", str(rnd.randint(0, 3))) for i in range(100, 400)]
    got = _diff(spark, old, new)
    assert set(sum(got.values(), [])) == {i for i, _ in old} | {i for i, _ in new}
    again = _diff(spark, new, new)
    assert list(again) == ["unchanged"] and len(again["unchanged"]) == 300


def test_extract_semijoins(spark):
    entries = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "id string, v long")
    diff = spark.createDataFrame([("a", "added"), ("b", "unchanged"), ("c", "changed"), ("c", "unchanged")],
                                 "id string, status string")
    assert sorted(r.id for r in D.extract_added_or_changed(entries, diff).collect()) == ["a", "c"]
    assert sorted(r.id for r in D.extract_unchanged(entries, diff).collect()) == ["b", "c"]
    assert sorted(r.id for r in D.extract_unchanged(entries, diff, strict=True).collect()) == ["b"]


def test_unchanged_via_moved_ids_matches_semijoin(spark):
    prev = spark.createDataFrame([(i, f"v{i}") for i in ("a", "b", "c", "d")], "id string, v string")
    diff = spark.createDataFrame([("a", "unchanged"), ("b", "changed"), ("c", "deleted"),
                                  ("d", "unchanged"), ("d", "changed"), ("e", "added")],
                                 "id string, status string")
    semi = sorted(r.id for r in D.extract_unchanged(prev, diff).collect())
    anti = sorted(r.id for r in D.extract_unchanged(prev, diff, previous_matches_diff=True).collect())
    assert semi == anti == ["a", "d"]


def test_added_or_changed_paths_agree(spark):
    entries = spark.createDataFrame([(i, i) for i in ("a", "b", "c", "d")], "id string, v string")
    diff = spark.createDataFrame([("a", "unchanged"), ("b", "changed"), ("c", "added"),
                                  ("d", "unchanged"), ("d", "changed"), ("z", "deleted")],
                                 "id string, status string")
    plain = sorted(r.id for r in D.extract_added_or_changed(entries, diff).collect())
    fast = sorted(r.id for r in D.extract_added_or_changed(entries, diff, diff_covers_entries=True).collect())
    assert plain == fast == ["b", "c", "d"]


def test_old_duplicates_without_ordinal_one_status(spark):
    o = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "3")], "id string, md5 string")
    n = spark.createDataFrame([("a", "2"), ("b", "3")], "id string, md5 string")
    got = sorted((r.id, r.status) for r in D.snapshot_diff(o, n).collect())
    assert got == [("a", "unchanged"), ("b", "unchanged")]


def _branch_frames(spark):
    entries = spark.createDataFrame(
        [("a", 1), ("b", 2), ("b", 3), ("c", 4), (None, 5), ("u", 6), ("d", 7)], "id string, v int")
    diff = spark.createDataFrame(
        [("a", "added"), ("b", "changed"), ("b", "unchanged"), ("c", "unchanged"), ("d", "deleted"),
         (None, "added"), ("x", "added")], "id string, status string")
    return entries, diff


def test_extracts_give_the_same_rows_on_every_branch(spark):
    """Null, duplicate and unknown ids; a gate of 0 bytes stands for sets too
    large to broadcast, one between the two set sizes forces the anti-join."""
    entries, diff = _branch_frames(spark)
    for known in (entries, entries.where("id is null or id <> 'u'")):
        want = sorted(r.v for r in D.extract_added_or_changed(known, diff).collect())
        assert want == [1, 2, 3]
        for gate in (0, 48, 60, 1 << 20):
            got = D.extract_added_or_changed(known, diff, diff_covers_entries=True, max_bytes=gate)
            assert sorted(r.v for r in got.collect()) == want
        want = sorted(r.v for r in D.extract_unchanged(known, diff).collect())
        assert want == [2, 3, 4]
        for gate in (0, 1 << 20):
            got = D.extract_unchanged(known, diff, previous_matches_diff=True, max_bytes=gate)
            assert sorted(r.v for r in got.collect()) == want


def test_initial_load_takes_the_anti_join(spark):
    entries = spark.createDataFrame([(f"id{i}", i) for i in range(50)] + [("same", 99), (None, 100)], "id string, v int")
    diff = spark.createDataFrame([(f"id{i}", "added") for i in range(50)] + [("same", "unchanged"), (None, "added")],
                                 "id string, status string")
    out = D.extract_added_or_changed(entries, diff, diff_covers_entries=True, max_bytes=100)
    assert "LeftAnti" in out._jdf.queryExecution().toString()
    assert sorted(r.v for r in out.collect()) == list(range(50))


def test_extract_by_places_moves_no_wide_rows(spark):
    """No id set passes the gate: the rows to keep go as bitmaps."""
    rows = [(f"EPI_ISL_{i:024d}", f"v{i % 3}", "ACGT" * 20) for i in range(60_000)] + [
        ("EPI_ISL_" + "0" * 24, "again", "AC"), (None, "x", "AC")]
    landed = cut_lineage(spark.createDataFrame(rows, "id string, v string, sequence string").repartition(2), "landed")
    entries = D.with_place(landed)
    status = F.when(F.col("v") == "v1", "changed").when(F.col("v") == "v2", "added").otherwise("unchanged")
    diff = cut_lineage(entries.where("id is not null").select("id", status.alias("status")), "diff")
    places = entries.select("id", D.FILE, D.ROW)
    for gate in (100_000, 10):  # bitmaps pass the first only
        got = D.extract_added_or_changed(entries, diff, diff_covers_entries=True, max_bytes=gate, places=places)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert ("Exchange hashpartitioning" in plan) == (gate == 10)
        want = [r for r in rows if r[0] and r[1] in ("v1", "v2")]
        assert sorted(map(tuple, got.select("id", "v", "sequence").collect())) == sorted(want)


def test_shuffled_rows_of_a_diff_hold_digests(spark):
    """Every shuffled row holds a digest; null ids match nothing."""
    o = spark.createDataFrame([("a", "1"), ("b", "2"), ("b", "3"), (None, "4"), (None, "5"), ("n", None), ("g", "6")],
                              "id string, md5 string")
    n = spark.createDataFrame([("a", "1"), ("b", "2"), ("b", "3"), (None, "5"), (None, "5"), ("n", "7"), ("x", None)],
                              "id string, md5 string")
    d = D.snapshot_diff(o, n)
    plan = d._jdf.queryExecution().executedPlan().toString()
    (anti,) = [x for x in plan.splitlines() if "LeftAnti" in x]
    assert "old_md5" in anti and "_any" in anti
    got = sorted((str(r.id), r.status) for r in d.collect())
    assert got == [("None", "added"), ("None", "added"), ("None", "deleted"), ("a", "unchanged"), ("b", "changed"),
                   ("b", "unchanged"), ("g", "deleted"), ("n", "added"), ("x", "added")]


def test_ids_of_a_written_diff_are_not_broadcast_by_file_size(spark):
    """200,000 ids of a written diff fill files far below Spark's own limit."""
    diff = cut_lineage(spark.range(200_000).selectExpr("concat('EPI_', id) as id", "'added' as status"), "diff")
    entries = diff.select("id", F.lit("ACGT").alias("sequence"))
    for out in (D.extract_by_status(entries, diff, ("added",)), D.extract_by_status(entries, diff, ("added",), exclude=("changed",))):
        assert "BroadcastHashJoin" not in out._jdf.queryExecution().executedPlan().toString()
        assert out.count() == 200_000
