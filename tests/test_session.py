"""Session helpers: measured broadcast gate and stage tables under the
shared checkpoint folder."""
from genoflux.session import cut_lineage, land, maybe_broadcast, payload_bytes, shared_path


def test_payload_bytes_exact(spark):
    df = spark.createDataFrame([("abc", 1), ("de", 2), (None, 3)], "s string, n long")
    # per row: len(s) + 8 for the long + 16 overhead
    assert payload_bytes(df, ["s", "n"]) == (3 + 8 + 16) + (2 + 8 + 16) + (0 + 8 + 16)


def test_broadcast_gate(spark):
    small = spark.range(10).toDF("id")
    hinted = maybe_broadcast(small)
    assert "broadcast" in hinted._jdf.queryExecution().analyzed().toString().lower()
    # above the gate Spark must not broadcast on an estimate of its own
    for how in ("inner", "left_semi", "left"):
        plan = spark.range(5).join(maybe_broadcast(small, max_bytes=1), "id", how)._jdf.queryExecution().executedPlan()
        assert "SortMergeJoin" in plan.toString() and "Broadcast" not in plan.toString()


def test_stage_tables_under_checkpoint_dir(spark):
    root = spark.sparkContext.getCheckpointDir()
    assert shared_path(spark, "x").startswith(root.rstrip("/"))
    df = spark.range(5).toDF("id")
    staged = cut_lineage(df)
    files = staged.inputFiles()
    assert files and all(f.startswith(root.rstrip("/")) or root.split(":", 1)[-1] in f for f in files)
    assert sorted(r.id for r in land(df).collect()) == [0, 1, 2, 3, 4]
