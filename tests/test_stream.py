"""Streaming feed stage: only newly landed files are processed."""
import os

from genoflux.streaming import process_landed_feed

LINE = ('{{"covv_accession_id": "EPI_{i}", "covv_virus_name": "v{i}", "covv_location": '
        '"Europe / CH", "covv_host": "unknown", "sequence": "ACGT"}}\n')


def test_incremental_landing(spark, tmp_dir):
    land, out, ck = (os.path.join(tmp_dir, d) for d in ("in", "out", "ck"))
    os.makedirs(land)
    with open(os.path.join(land, "a.json"), "w") as f:
        f.write("".join(LINE.format(i=i) for i in range(3)))
    assert process_landed_feed(spark, land, out, ck) == 1
    assert process_landed_feed(spark, land, out, ck) == 0
    with open(os.path.join(land, "b.json"), "w") as f:
        f.write("".join(LINE.format(i=i) for i in range(3, 5)))
    assert process_landed_feed(spark, land, out, ck) == 1
    e = spark.read.parquet(os.path.join(out, "entries"))
    rows = {r.id: (r.host, r.region, r.country) for r in e.collect()}
    assert sorted(rows) == [f"EPI_{i}" for i in range(5)]
    assert rows["EPI_0"] == (None, "Europe", "CH")
    assert spark.read.parquet(os.path.join(out, "hashes")).count() == 5
