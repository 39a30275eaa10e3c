"""Truth tables for the column functions (FIXTURES F7-F9, F13, F16)."""
import pytest
from pyspark.sql import functions as F

from genoflux.functions import (insertion_list, insertions_by_gene, mask_edge_gaps, parse_double,
                                parse_int, parse_partial_date, split_location, utrim)


def rows(spark, values, expr_fn, schema="s string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [tuple(r) for r in df.select(*expr_fn(F.col("s"))).collect()]


DATES = [
    ("2022-08-15", ("2022-08-15", 2022, 8, 15)),
    ("2022-08", (None, 2022, 8, None)),
    ("2022", (None, 2022, None, None)),
    ("2022-XX-XX", (None, 2022, None, None)),
    ("2022-05-XX", (None, 2022, 5, None)),
    ("2022-02-30", (None, 2022, 2, 30)),
    ("2022-13-40", (None, 2022, None, None)),
    ("20XX-05-01", (None, 2000, 5, 1)),
    ("XXXX-05-01", (None, None, 5, 1)),
    ("2022-5-1", (None, None, None, None)),
    ("junk", (None, None, None, None)),
    ("2022-08-15T00", (None, None, None, None)),
    ("0000-01-01", ("0000-01-01", 0, 1, 1)),
    ("2024-02-29", ("2024-02-29", 2024, 2, 29)),
    ("2023-02-29", (None, 2023, 2, 29)),
    ("1900-02-29", (None, 1900, 2, 29)),
    ("2000-02-29", ("2000-02-29", 2000, 2, 29)),
    ("2022-04-31", (None, 2022, 4, 31)),
    (None, (None, None, None, None)),
]


def test_partial_dates(spark):
    def fn(c):
        p = parse_partial_date(c)
        return [p[""], p["Year"], p["Month"], p["Day"], p["OriginalValue"]]
    got = rows(spark, [d for d, _ in DATES], fn)
    for (inp, exp), g in zip(DATES, got):
        assert g[:4] == exp, inp
        assert g[4] == inp


def test_numbers_lenient(spark):
    vals = ["45", "+5", " 7 ", "5.0", "40-49", None, "inf", "Infinity", "1e3", "-3"]
    got = rows(spark, vals, lambda c: [parse_int(c, True), parse_double(c, True)])
    assert [g[0] for g in got] == [45, 5, None, None, None, None, None, None, None, -3]
    assert [g[1] for g in got] == [45.0, 5.0, 7.0, 5.0, None, None, None, float("inf"), 1000.0, -3.0]


@pytest.mark.parametrize("bad", [" 7 ", "5.0", "40-49"])
def test_integer_strict_fails(spark, bad):
    df = spark.createDataFrame([(bad,)], "s string")
    with pytest.raises(Exception):
        df.select(parse_int(F.col("s"))).collect()


def test_double_strict_fails(spark):
    df = spark.createDataFrame([("40-49",)], "s string")
    with pytest.raises(Exception):
        df.select(parse_double(F.col("s"))).collect()


def test_edge_gap_masking(spark):
    vals = ["--AC-G--", "----", "", None, "AC"]
    got = rows(spark, vals, lambda c: [mask_edge_gaps(c, "N"), mask_edge_gaps(c, "X", True, False)])
    assert got == [("NNAC-GNN", "XXAC-G--"), ("NNNN", "XXXX"), ("", ""), (None, None), ("AC", "AC")]


def test_masking_preserves_length(spark):
    import random
    rnd = random.Random(7)
    vals = ["".join(rnd.choice("-AC") for _ in range(rnd.randint(0, 12))) for _ in range(200)]
    got = rows(spark, vals, lambda c: [mask_edge_gaps(c, "N")])
    for v, (m,) in zip(vals, got):
        assert len(m) == len(v)
        assert m.strip("N") == v.strip("-") or set(v) == {"-"}


def test_insertions(spark):
    df = spark.createDataFrame([("22204:GAG,5:T", "S:214:EPE,N:3:K"), (None, ""), (" ", None)],
                               "a string, b string")
    got = df.select(insertion_list("a"), insertions_by_gene("b", ["S", "N", "E"])).collect()
    assert got[0][0] == ["22204:GAG", "5:T"]
    assert got[0][1] == {"S": ["214:EPE"], "N": ["3:K"], "E": []}
    assert got[1][0] == [] and got[1][1] == {"S": [], "N": [], "E": []}
    assert got[2][0] == []


@pytest.mark.parametrize("bad", ["X:1:A", "S214"])
def test_insertions_unknown_gene_fails(spark, bad):
    df = spark.createDataFrame([(bad,)], "b string")
    with pytest.raises(Exception):
        df.select(insertions_by_gene("b", ["S", "N"])).collect()


def test_location_split(spark):
    vals = ["Europe / CH / ZH", "A/B/C/D/E", "  ", None, "\tX / Y"]
    got = rows(spark, vals, lambda c: split_location(c))
    assert got == [("Europe", "CH", "ZH", None), ("A", "B", "C", "D"),
                   (None, None, None, None), (None, None, None, None), ("X", "Y", None, None)]


def test_utrim_unicode(spark):
    got = rows(spark, ["\t a  ", "b"], lambda c: [utrim(c)])
    assert got == [("a",), ("b",)]


def test_whitespace_set(spark):
    from genoflux.functions import not_blank
    got = rows(spark, ["\u001c x ", "\u0085x", "　\t", None],
               lambda c: [utrim(c), not_blank(c)])
    assert got == [("x", True), ("\u0085x", True), ("", False), (None, False)]
