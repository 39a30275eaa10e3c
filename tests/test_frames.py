"""Frame transforms: ordered rename (F14), whitelist, overlay, flatten."""
from pyspark.sql import functions as F

from genoflux.operators import frames as FR


def test_ordered_rename_last_wins_and_missing_source(spark):
    df = spark.createDataFrame([("i1", "1", "2"), ("i2", "1", None)], "id string, p string, q string")
    out = FR.ordered_rename(df, [("p", "t"), ("q", "t")])
    assert out.columns == ["id", "t"]
    assert [tuple(r) for r in out.orderBy("id").collect()] == [("i1", "2"), ("i2", None)]
    out2 = FR.ordered_rename(df.drop("q"), [("p", "t"), ("q", "t")])
    assert [r["t"] for r in out2.collect()] == [None, None]


def test_whitelist_adds_typed_nulls(spark):
    df = spark.createDataFrame([("i", "a", "b")], "id string, x string, y string")
    out = FR.whitelist(df, ["y", "z"])
    assert out.columns == ["id", "y", "z"]
    assert tuple(out.first()) == ("i", "b", None)


def test_map_to_null_only_exact_markers(spark):
    df = spark.createDataFrame([("i", "", "?", "Unknown", " ")], "id string, a string, b string, c string, d string")
    out = FR.map_to_null(df)
    assert tuple(out.first()) == ("i", None, None, "Unknown", " ")


def test_overlay_by_presence_not_nullness(spark):
    df = spark.createDataFrame([("a", "m1", "q1", True), ("b", "m2", None, True), ("c", "m3", None, None)],
                               "id string, v string, qv string, present boolean")
    out = FR.overlay_columns(df, F.col("present").isNotNull(), {"v": "qv"})
    assert [tuple(r) for r in out.select("id", "v").orderBy("id").collect()] == [
        ("a", "q1"), ("b", None), ("c", "m3")]


def test_flatten_publish(spark):
    df = spark.createDataFrame(
        [("x", "meta", {"main": None}, {"main": "ACG", "S": None}, {}, {}, {})],
        "id string, m string, unaligned_nuc map<string,string>, aligned_nuc map<string,string>, "
        "aligned_aa map<string,string>, nuc_insertions map<string,array<string>>, "
        "aa_insertions map<string,array<string>>")
    out = FR.flatten_publish(df, aligned_nuc=["main", "S"]).first().asDict(recursive=True)
    assert out["unaligned_main"] is None
    assert out["main"] == {"sequence": "ACG", "insertions": []}
    assert out["S"] is None
    assert out["m"] == "meta"
