"""Exact sort order, positions of few repeated keys, maps at any depth, the
legacy diff object as a stream."""
import json
import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from genoflux.operators import zipjoin as Z
from genoflux.operators.sets import sort_output, sorted_positions
from genoflux.sources import readers as R
from genoflux.sources import writers as W

KEYS = ["\U0001F600", "～", "", "a", "Z", "", "é", "\U00010000x", "퟿", "ab", "￿"]


def utf16(text):
    return text.encode("utf-16-be")


def test_keys_sort_by_code_units(spark):
    df = spark.createDataFrame([(k, i) for i, k in enumerate(KEYS * 3)], "k string, i int").repartition(5, "i")
    got = [(r["k"], r["i"]) for r in sort_output(df, "k", ["i"]).collect()]
    assert got == sorted(((k, i) for i, k in enumerate(KEYS * 3)), key=lambda x: (utf16(x[0]), x[1]))
    placed = sorted_positions(df, "k", ["i"]).orderBy("pos").collect()
    assert [(r["k"], r["i"]) for r in placed] == got and placed[0].asDict().keys() == {"k", "i", "pos"}


def test_a_null_key_fails(spark):
    df = spark.createDataFrame([("a", 1), (None, 2)], "k string, i int")
    for run in (lambda: sort_output(df, "k"), lambda: sorted_positions(df, "k")):
        with pytest.raises(Exception, match="no k to sort by"):
            run().collect()


def test_ties_keep_the_order_of_the_files(spark, tmp_dir):
    """Spark deals large files out first: the small file still comes first."""
    with open(os.path.join(tmp_dir, "a.json"), "w") as f:
        f.write('{"k": "x", "v": "first"}\n')
    with open(os.path.join(tmp_dir, "b.json"), "w") as f:
        f.writelines(json.dumps({"k": "xy"[i % 2], "v": str(i)}) + "\n" for i in range(20_000))
    cost = "spark.sql.files.openCostInBytes"
    spark.conf.set(cost, "0")
    try:
        df = R.read_ndjson(spark, tmp_dir, "k string, v string")
        got = [(r["k"], r["v"]) for r in sort_output(df, "k").collect()]
    finally:
        spark.conf.unset(cost)
    rows = [("x", "first")] + [("xy"[i % 2], str(i)) for i in range(20_000)]
    assert got == sorted(rows, key=lambda r: r[0])


def test_few_repeated_keys_are_numbered_without_moving_wide_rows(spark):
    rows = [(f"k{i}", i, "wide" * 50) for i in range(500)] + [("k7", 900, "w"), ("k7", 800, "w"), (None, 1, "n"), (None, 2, "n")]
    df = spark.createDataFrame(rows, "k string, o long, w string").repartition(4)
    out = Z.key_row_number(df, "k", "o")
    assert "Window" not in out._jdf.queryExecution().optimizedPlan().toString()
    got = {(r["k"], r["o"]): r["rn"] for r in out.collect()}
    assert len(got) == len(rows) and got[None, 1] == 1 and got[None, 2] == 2
    assert (got["k7", 7], got["k7", 800], got["k7", 900]) == (1, 2, 3)
    assert all(v == 1 for (k, _), v in got.items() if k not in ("k7", None))


def test_repeated_keys_whose_order_ties_use_a_window(spark):
    rest = [(f"b{i:02d}", 1, "y") for i in range(30)]
    df = spark.createDataFrame([("a", 1, "x"), ("a", 1, "x"), *rest], "k string, o long, w string")
    out = Z.key_row_number(df, "k", "o")
    assert sorted((r["k"], r["rn"]) for r in out.collect()) == [("a", 1), ("a", 2), *((k, 1) for k, *_ in rest)]


def test_exchanges_of_a_join_of_two_inputs_with_repeats(spark):
    left = spark.createDataFrame([("a", i, "l") for i in range(3)] + [(f"b{i}", 9, "l") for i in range(40)], "key string, o long, x string")
    right = spark.createDataFrame([("a", i, "r") for i in range(2)] + [(f"c{i}", 9, "r") for i in range(40)], "key string, o long, y string")
    out = Z.zip_inputs([(left, "key", "o"), (right, "key", "o")])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and "Window" not in plan  # the join's own two
    assert out.count() == 83


def test_maps_are_sorted_at_any_depth(spark, tmp_dir):
    inner = T.MapType(T.StringType(), T.LongType())
    schema = T.StructType([
        T.StructField("a", T.ArrayType(T.StructType([T.StructField("m", inner), T.StructField("x", T.LongType())]))),
        T.StructField("n", T.MapType(T.StringType(), T.MapType(T.StringType(), T.ArrayType(inner)))),
        T.StructField("s", T.StructType([T.StructField("m", inner)])), T.StructField("p", T.LongType())])
    m = {"z": 1, "b": 2, "k": 3}
    rows = [([({"z": 1, "a": 2}, 5), (None, 6), None], {"y": {"q": [m, None], "c": None}, "d": None}, (m,), 1), (None, None, None, 2)]
    W.write_ndjson(spark.createDataFrame(rows, schema).coalesce(1), f"{tmp_dir}/out")
    text = sorted(r["value"] for r in spark.read.text(f"{tmp_dir}/out").collect())
    assert text == [
        '{"a":[{"m":{"a":2,"z":1},"x":5},{"m":null,"x":6},null],"n":{"d":null,"y":{"c":null,"q":[{"b":2,"k":3,"z":1},null]}},'
        '"s":{"m":{"b":2,"k":3,"z":1}},"p":1}',
        '{"a":null,"n":null,"s":null,"p":2}']


@pytest.mark.parametrize("escaped", [False, True])
def test_legacy_diff_in_many_splits(spark, tmp_dir, escaped):
    rng = random.Random(2)
    want = []
    for f in range(2):
        parts = {p: [f"EPI_{f}_{p[0]}{i}" + rng.choice(["", ", x", " [y]: ", "é\\/"]) for i in range(300 * (p != "changed"))]
                 for p in rng.sample(R.DIFF_PARTS, 4)}
        parts["deleted"] += ["added"] + (['with "quotes" \\'] if escaped else [])
        text = json.dumps(parts, indent=2 if f else None, ensure_ascii=bool(f))
        with open(os.path.join(tmp_dir, f"d{f}.json"), "w") as out:
            out.write(text)
        want += [(i, p) for p, ids in parts.items() for i in ids]
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        df = R.read_diff(spark, tmp_dir, legacy=True)
        got = sorted(tuple(r) for r in df.collect())
        tasks = df.rdd.getNumPartitions()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert got == sorted(want)
    assert escaped or tasks > 5


def test_legacy_diff_of_unknown_arrays_fails(spark, tmp_dir):
    with open(os.path.join(tmp_dir, "d.json"), "w") as out:
        out.write('{"added": [], "moved": ["x"]}')
    with pytest.raises(ValueError, match="moved"):
        R.read_diff(spark, tmp_dir, legacy=True)


def test_the_writer_of_a_legacy_diff_only_copies(spark, tmp_dir):
    """The one task that writes the object has nothing to sort; its lines
    come in order from many tasks."""
    from genoflux.queries.q_io import _legacy_lines
    diff = spark.range(5_000).selectExpr("id", "array('added', 'changed', 'deleted', 'unchanged')[cast(id % 4 as int)] as status")
    lines = _legacy_lines(diff).coalesce(1)
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "Exchange" not in plan
    lines.write.text(f"{tmp_dir}/d")
    assert spark.read.text(f"{tmp_dir}/d", wholetext=True).count() == 1
    (whole,) = [r.value for r in spark.read.text(f"{tmp_dir}/d", wholetext=True).collect()]
    got = json.loads(whole)
    for n, part in enumerate(("added", "changed", "deleted", "unchanged")):
        assert got[part] == [*sorted(str(i) for i in range(n, 5_000, 4)), f"last-{part}"]
