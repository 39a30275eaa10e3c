"""Positional zip join (F11) vs a plain-Python zip, on both numbering paths."""
import random

import pytest

from genoflux.operators.zipjoin import key_row_number, zip_inputs, zip_join


def python_zip(left, right, keep_all=True):
    from collections import defaultdict
    a, b = defaultdict(list), defaultdict(list)
    for k, o, v in sorted(left, key=lambda r: (r[0], r[1])):
        a[k].append(v)
    for k, o, v in sorted(right, key=lambda r: (r[0], r[1])):
        b[k].append(v)
    out = set()
    for k in set(a) | set(b):
        if not keep_all and k not in a:
            continue
        n = max(len(a[k]), len(b[k])) if keep_all else len(a[k])
        for i in range(n):
            out.add((k, i + 1, a[k][i] if i < len(a[k]) else None, b[k][i] if i < len(b[k]) else None))
    return out


def run(spark, left, right, keep, hot):
    l_df = spark.createDataFrame(left, "key string, o long, a string")
    r_df = spark.createDataFrame(right, "key string, o long, b string")
    z = zip_inputs([(l_df, "key", "o"), (r_df, "key", "o")], keep=keep, hot_rows=hot)
    return {(r.key, r.rn, r.a, r.b) for r in z.select("key", "rn", "a", "b").collect()}


def test_fixture_example(spark):
    left = [("x", 1, "a1"), ("x", 2, "a2"), ("y", 3, "a3")]
    right = [("x", 1, "b1"), ("z", 2, "b2")]
    assert run(spark, left, right, "all", None) == {
        ("x", 1, "a1", "b1"), ("x", 2, "a2", None), ("y", 1, "a3", None), ("z", 1, None, "b2")}
    assert run(spark, left, right, "first", None) == {
        ("x", 1, "a1", "b1"), ("x", 2, "a2", None), ("y", 1, "a3", None)}


@pytest.mark.parametrize("hot", [None, 3])
def test_random_against_python(spark, hot):
    rnd = random.Random(11 if hot else 5)
    # one key holds about a third of the rows
    keys = ["hot"] * 40 + [f"k{i}" for i in range(20)] * 4
    left = [(rnd.choice(keys), i, f"a{i}") for i in range(150)]
    right = [(rnd.choice(keys), 1000 + i, f"b{i}") for i in range(120)]
    assert run(spark, left, right, "all", hot) == python_zip(left, right)
    assert run(spark, left, right, "first", hot) == python_zip(left, right, keep_all=False)


def test_hot_path_numbers_contiguously(spark):
    df = spark.createDataFrame([("h", i) for i in range(500)] + [("c", i) for i in range(5)], "k string, o long")
    out = key_row_number(df, "k", "o", hot_rows=10)
    got = {(r.k, r.o): r.rn for r in out.collect()}
    assert all(got[("h", i)] == i + 1 for i in range(500))
    assert all(got[("c", i)] == i + 1 for i in range(5))


def test_hot_limit_from_session_conf(spark):
    from genoflux.operators.zipjoin import HOT_ROWS_CONF, hot_limit
    df = spark.createDataFrame([("h", i) for i in range(50)] + [("c", 0)], "k string, o long")
    spark.conf.set(HOT_ROWS_CONF, "10")
    try:
        assert hot_limit(df, None) == 10
        got = {(r.k, r.o): r.rn for r in key_row_number(df, "k", "o").collect()}
    finally:
        spark.conf.unset(HOT_ROWS_CONF)
    assert [got[("h", i)] for i in range(50)] == list(range(1, 51)) and got[("c", 0)] == 1


def test_null_key_can_be_the_hot_one(spark):
    rows = [(None, i) for i in range(40)] + [("a", i) for i in range(30)] + [("b", 1)]
    df = spark.createDataFrame(rows, "key string, o long").repartition(5)
    got = sorted((r.key or "", r.o, r.rn) for r in key_row_number(df, "key", "o", "rn", hot_rows=10).collect())
    assert got == sorted([("", i, i + 1) for i in range(40)] + [("a", i, i + 1) for i in range(30)] + [("b", 1, 1)])


def test_three_way_outer_zip_equals_chained_full_joins(spark):
    a = spark.createDataFrame([("x", 1, 10), ("x", 2, 11), (None, 1, 12)], "key string, rn long, a int")
    b = spark.createDataFrame([("x", 1, None), ("y", 1, 21), (None, 1, 22)], "key string, rn long, b int")
    c = spark.createDataFrame([("y", 1, 31), ("x", 3, 32)], "key string, rn long, c int")
    chained = a.join(b, ["key", "rn"], "full").join(c, ["key", "rn"], "full")
    got = zip_join([a, b, c])
    assert sorted(map(str, got.select("key", "rn", "a", "b", "c").collect())) == \
        sorted(map(str, chained.select("key", "rn", "a", "b", "c").collect()))
