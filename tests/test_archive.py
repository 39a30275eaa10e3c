"""The archive: safe commits, copy-on-write refreshes against a plain merge,
the life of stage tables."""
import os
import random

import pytest
from pyspark.sql import functions as F

from genoflux.session import cut_lineage, ensure_checkpoint_dir, stage_run
from genoflux.sources import archive as A

SCHEMA = "id string, value long, note string"


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def read(spark, root, version):
    return rows_of(A.read_snapshot(spark, root, version).select("id", "value", "note"))


@pytest.mark.parametrize("fmt", ["parquet", "json"])
@pytest.mark.parametrize("share", [0.0, 0.2, 2.0])
def test_refreshes_equal_a_plain_merge(spark, tmp_dir, fmt, share):
    """Several versions; share 0: touched files are always rewritten, 2: never."""
    rng = random.Random(1)
    held = [(f"i{i}", i, "x" * 50) for i in range(400)] + [("i7", 700, "twice"), (None, -1, "no id"), ("gone", 1, None)]
    root = f"{tmp_dir}/archive"
    A.publish_snapshot(spark, root, spark.createDataFrame(held, SCHEMA).repartition(8), version="1", fmt=fmt, id_col="id")
    assert read(spark, root, "1") == sorted(held, key=str)
    for n in range(2, 6):
        ids = sorted({r[0] for r in held if r[0]})
        moved = set(rng.sample(ids, 60 if n == 3 else 4)) | ({"i7"} if n == 4 else set())
        dropped = set(rng.sample(ids, 3))
        new = [(i, 1000 * n + k, f"v{n}") for k, i in enumerate(sorted(moved - dropped))] + [(f"new{n}", n, None)]
        status = [(i, "deleted" if i in dropped else "changed" if i in moved else "unchanged") for i in ids if i != "gone"]
        status += [(f"new{n}", "added")] + ([(min(moved - dropped), "unchanged")] if n == 5 else [])
        diff = spark.createDataFrame(status, "id string, status string")
        A.publish_refresh(spark, root, str(n - 1), diff, spark.createDataFrame(new, SCHEMA).repartition(2),
                          version=str(n), rewrite_share=share)
        unchanged = {i for i, s in status if s == "unchanged"}
        held = [r for r in held if r[0] in unchanged] + new
        assert read(spark, root, str(n)) == sorted(held, key=str), n
    files = A.files_of(spark, root, "5").collect()
    assert sum(r["rows"] - r["gone"] for r in files) == len(held)
    assert len({r["path"].split("/")[1] for r in files}) > 1 and all(r["path"].startswith("attempts/") for r in files)


def test_new_columns_and_an_empty_previous_version(spark, tmp_dir):
    root = f"{tmp_dir}/archive"
    A.publish_snapshot(spark, root, spark.createDataFrame([], "id string, value long"), version="1", id_col="id")
    diff = spark.createDataFrame([("a", "added")], "id string, status string")
    A.publish_refresh(spark, root, "1", diff, spark.createDataFrame([("a", 1, "n")], SCHEMA), version="2")
    assert read(spark, root, "2") == [("a", 1, "n")]
    diff = spark.createDataFrame([("a", "deleted")], "id string, status string")
    A.publish_refresh(spark, root, "2", diff, spark.createDataFrame([], SCHEMA), version="3")
    assert read(spark, root, "3") == []


def test_a_refresh_of_few_ids_writes_little(spark, tmp_dir):
    """One id in a hundred moves, spread over all files."""
    snapshot = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select(
        F.col("doc_id").cast("string").alias("id"), "text")
    snapshot = snapshot.unionByName(snapshot.select(F.concat(F.lit("b"), "id").alias("id"), "text")).repartition(4)
    root = f"{tmp_dir}/archive"
    A.publish_snapshot(spark, root, snapshot, version="1", id_col="id")
    moves = (F.pmod(F.xxhash64("id"), F.lit(100)) == 0)
    diff = snapshot.select("id", F.when(moves, "changed").otherwise("unchanged").alias("status"))
    new = snapshot.where(moves).withColumn("text", F.lit("new"))
    A.publish_refresh(spark, root, "1", diff, new, version="2")
    own, whole = A.written_bytes(spark, root, "2")
    assert own < 0.03 * whole
    got = A.read_snapshot(spark, root, "2")
    assert got.count() == snapshot.count() and got.where("text = 'new'").count() == new.count() > 5


def test_two_writers_of_one_version(spark, tmp_dir):
    """The second commits while the first is at work: the first fails and the
    committed rows stay whole."""
    root = f"{tmp_dir}/archive"
    first = spark.createDataFrame([("a", 1, "first")], SCHEMA)
    second = spark.createDataFrame([("b", 2, "second")], SCHEMA)

    def meanwhile(written):
        assert A.latest_version(spark, root) is None
        A.publish_snapshot(spark, root, second, version="5", id_col="id", hashes=second.select("id"))
        return written.select(F.col("note").alias("value"))
    with pytest.raises(FileExistsError):
        A.publish_snapshot(spark, root, first, lineages=meanwhile, version="5", id_col="id")
    assert read(spark, root, "5") == [("b", 2, "second")] and A.latest_version(spark, root) == "5"
    assert A.read_snapshot(spark, root, "5", "hashes").count() == 1
    with pytest.raises(FileNotFoundError):  # the loser wrote lineages, the winner did not
        A.read_snapshot(spark, root, "5", "lineages")
    with pytest.raises(FileExistsError):
        A.publish_snapshot(spark, root, first, version="5")
    assert not [f for f in os.listdir(f"{root}/_manifest") if f.startswith(".") and not f.endswith(".crc")]


def test_parts_of_an_uncommitted_version_cannot_be_read(spark, tmp_dir):
    root = f"{tmp_dir}/archive"
    data = spark.createDataFrame([("a", 1, "x")], SCHEMA)

    def fails(written):
        raise RuntimeError("stopped")
    with pytest.raises(RuntimeError):
        A.publish_snapshot(spark, root, data, hashes=data.select("id"), lineages=fails, version="9", id_col="id")
    assert os.listdir(f"{root}/attempts")
    for part in ("data", "hashes", "lineages"):
        with pytest.raises(FileNotFoundError):
            A.read_snapshot(spark, root, "9", part)
    assert A.latest_version(spark, root) is None
    A.publish_snapshot(spark, root, data, version="9", id_col="id")
    assert read(spark, root, "9") == [("a", 1, "x")]


def test_stage_tables_go_with_their_run(spark):
    stage = f"{ensure_checkpoint_dir(spark).removeprefix('file:')}/genoflux-stage"
    os.makedirs(stage, exist_ok=True)
    before = set(os.listdir(stage))
    with stage_run(spark):
        cut_lineage(spark.range(3), "inner").count()
        made = set(os.listdir(stage)) - before
        assert len(made) == 1 and all(n.startswith("run-") for n in made)
    assert set(os.listdir(stage)) == before
    with pytest.raises(RuntimeError), stage_run(spark) as folder:
        cut_lineage(spark.range(3), "inner")
        raise RuntimeError("stopped")
    assert set(os.listdir(stage)) - before == {os.path.basename(folder)}
