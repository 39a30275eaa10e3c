"""Scans and sinks: FASTA (F15), TSV, NDJSON, line lists, publish."""
import os

import pytest
from pyspark.sql import functions as F

from genoflux.sources import readers as R
from genoflux.sources import writers as W


def write(path, name, text):
    os.makedirs(path, exist_ok=True)
    p = os.path.join(path, name)
    with open(p, "w") as f:
        f.write(text)
    return p


def test_fasta_fixture(spark, tmp_dir):
    write(tmp_dir, "a.fasta", ">s1 desc\nACGT\n\nTT\n>s2\n>s3\nAA\n")
    got = [tuple(r) for r in R.read_fasta(spark, tmp_dir).collect()]
    assert sorted(got) == [("s1 desc", "ACGTTT"), ("s2", ""), ("s3", "AA")]


def test_fasta_crlf_and_many_files(spark, tmp_dir):
    write(tmp_dir, "a.fasta", ">a\r\nAC\r\nGT\r\n")
    write(tmp_dir, "b.fasta", ">b\nTT\n>c\nGG")
    got = sorted(tuple(r) for r in R.read_fasta(spark, tmp_dir).collect())
    assert got == [("a", "ACGT"), ("b", "TT"), ("c", "GG")]


def test_fasta_preamble_fails(spark, tmp_dir):
    write(tmp_dir, "a.fasta", "junk\n>s1\nAC\n")
    with pytest.raises(Exception):
        R.read_fasta(spark, tmp_dir).collect()


def test_fasta_records_of_several_files(spark, tmp_dir):
    write(tmp_dir, "a.fasta", ">s1 desc\nACGT\n\nTT\n>s2\n>s3\nAA\n")
    write(tmp_dir, "b.fasta", ">t1\nGG\n")
    got = sorted(tuple(r) for r in R.read_fasta(spark, tmp_dir).collect())
    assert got == [("s1 desc", "ACGTTT"), ("s2", ""), ("s3", "AA"), ("t1", "GG")]


def test_fasta_lone_carriage_return_ends_a_line(spark, tmp_dir):
    with open(os.path.join(tmp_dir, "a.fasta"), "w", newline="") as f:
        f.write(">s1 x\rAC\rGT\r\n>s2\r\nTT")
    assert sorted(map(tuple, R.read_fasta(spark, tmp_dir).collect())) == [("s1 x", "ACGT"), ("s2", "TT")]


def test_tsv_files_with_other_headers_fail(spark, tmp_dir):
    write(tmp_dir, "a.tsv", "strain\tage\ns1\t4\n")
    write(tmp_dir, "b.tsv", "age\tstrain\n5\ts2\n")
    with pytest.raises(Exception, match="(?i)header"):
        R.read_tsv(spark, tmp_dir).collect()


def test_tsv_files_with_repeated_names_share_a_header(spark, tmp_dir):
    write(tmp_dir, "a.tsv", "x\ty\tx\n1\t2\t3\n")
    write(tmp_dir, "b.tsv", "x\ty\tx\n4\t5\t6\n")
    assert sorted(tuple(r) for r in R.read_tsv(spark, tmp_dir).collect()) == [("2", "3"), ("5", "6")]
    write(tmp_dir, "c.tsv", "y\tx\tx\n4\t5\t6\n")
    with pytest.raises(ValueError, match="header"):
        R.read_tsv(spark, tmp_dir)


def test_tsv_header_with_a_quoted_tab(spark, tmp_dir):
    write(tmp_dir, "a.tsv", '"a\tb"\tc\n1\t2\n')
    df = R.read_tsv(spark, tmp_dir)
    assert df.columns == ["a\tb", "c"] and tuple(df.first()) == ("1", "2")


def test_fasta_roundtrip(spark, tmp_dir):
    df = spark.createDataFrame([("x", "ACGT" * 50), ("y", "")], "id string, s string")
    out = os.path.join(tmp_dir, "out")
    W.write_fasta(df, out, "id", "s")
    got = sorted(tuple(r) for r in R.read_fasta(spark, out).collect())
    assert got == [("x", "ACGT" * 50), ("y", "")]


def test_fasta_sink_rejects_null(spark, tmp_dir):
    df = spark.createDataFrame([("x", None)], "id string, s string")
    with pytest.raises(Exception):
        W.write_fasta(df, os.path.join(tmp_dir, "o"), "id", "s")


def test_tsv(spark, tmp_dir):
    write(tmp_dir, "a.tsv", 'seqName\tqc.overallScore\tnote\n s1 \t12.5\t"a\tb"\ns2\t\tx\n')
    got = R.read_tsv(spark, tmp_dir)
    assert got.columns == ["seqName", "qc.overallScore", "note"]
    assert sorted(tuple(r) for r in got.collect()) == [("s1", "12.5", "a\tb"), ("s2", "", "x")]


def test_ndjson_nulls_and_sorted_keys(spark, tmp_dir):
    df = spark.createDataFrame([("i", None, {"b": "2", "a": "1"})], "id string, x string, m map<string,string>")
    out = os.path.join(tmp_dir, "j")
    W.write_ndjson(df, out)
    text = "".join(open(os.path.join(out, f)).read() for f in os.listdir(out) if f.startswith("part"))
    assert '"x":null' in text and text.index('"a"') < text.index('"b"')
    back = R.read_ndjson(spark, out, "id string, x string, m map<string,string>").first()
    assert back["x"] is None and back["m"] == {"a": "1", "b": "2"}


def test_line_list_and_publish(spark, tmp_dir):
    df = spark.createDataFrame([("A",), ("B",), ("A",)], "value string")
    root = os.path.join(tmp_dir, "snap")
    v = W.publish_snapshot(spark, root, df, lineages=df.distinct(), version="7")
    assert v == "7" and W.latest_version(spark, root) == "7"
    assert sorted(r.value for r in R.read_snapshot(spark, root, "7", "lineages").collect()) == ["A", "B"]
    with pytest.raises(FileExistsError):
        W.publish_snapshot(spark, root, df, version="7")


def test_legacy_diff_object(spark, tmp_dir):
    write(tmp_dir, "c.json", '{"added": ["a"], "changed": [], "deleted": ["d"], "unchanged": ["u", "v"]}')
    got = sorted(tuple(r) for r in R.read_diff(spark, tmp_dir, legacy=True).collect())
    assert got == [("a", "added"), ("d", "deleted"), ("u", "unchanged"), ("v", "unchanged")]


def test_dataset_version(spark):
    df = spark.createDataFrame([('[{"version": {"tag": "2024-01-01"}}, {"version": {"tag": "old"}}]',)],
                               "value string")
    assert R.dataset_version(df).first()["version"] == "2024-01-01"


def test_java_framed_md5(spark):
    from genoflux.functions.hashing import md5_of_json
    import hashlib
    payload = '{"a":1}'.encode()
    framed = bytes.fromhex("ACED0005757200025B42ACF317F8060854E00200007870") + len(payload).to_bytes(4, "big") + payload
    df = spark.createDataFrame([('{"a":1}',)], "j string")
    assert df.select(md5_of_json(F.col("j"), "java")).first()[0] == hashlib.md5(framed).hexdigest()


def test_compressed_inputs_by_extension(spark, tmp_dir):
    import gzip

    import zstandard
    body = b'{"covv_accession_id": "EPI_1", "sequence": "AC"}\n{"covv_accession_id": "EPI_2"}\n'
    os.makedirs(os.path.join(tmp_dir, "z"))
    with open(os.path.join(tmp_dir, "z", "feed.ndjson.zst"), "wb") as f:
        # two concatenated frames, as an appending writer produces
        f.write(zstandard.ZstdCompressor().compress(body[:49]))
        f.write(zstandard.ZstdCompressor().compress(body[49:]))
    with gzip.open(os.path.join(tmp_dir, "z", "more.ndjson.gz"), "wb") as f:
        f.write(b'{"covv_accession_id": "EPI_3"}\n')
    got = sorted(r.covv_accession_id for r in R.read_ndjson(spark, os.path.join(tmp_dir, "z"), R.FEED_SCHEMA).collect())
    assert got == ["EPI_1", "EPI_2", "EPI_3"]


def test_compressed_sinks(spark, tmp_dir):
    df = spark.createDataFrame([("a", {"k": "v"})], "id string, m map<string,string>")
    out = os.path.join(tmp_dir, "gz")
    W.write_ndjson(df, out, compression="gzip")
    assert any(f.endswith(".gz") for f in os.listdir(out))
    assert R.read_ndjson(spark, out, "id string, m map<string,string>").first()["m"] == {"k": "v"}
    W.write_parquet(df, os.path.join(tmp_dir, "pq"))
    assert any("zstd" in f for f in os.listdir(os.path.join(tmp_dir, "pq")))


def test_tsv_duplicate_header_last_wins(spark, tmp_dir):
    write(tmp_dir, "d.tsv", "a\tb\ta\n1\t2\t3\n")
    got = R.read_tsv(spark, tmp_dir)
    assert got.columns == ["b", "a"]
    assert tuple(got.first()) == ("2", "3")


def test_tsv_ragged_rows_fail(spark, tmp_dir):
    write(os.path.join(tmp_dir, "ok"), "x.tsv", "a\tb\n4\t\n")
    assert [tuple(r) for r in R.read_tsv(spark, os.path.join(tmp_dir, "ok")).collect()] == [("4", "")]
    for name, text in (("short", "a\tb\tc\n1\t2\n"), ("long", "a\tb\n1\t2\t3\n")):
        write(os.path.join(tmp_dir, name), "x.tsv", text)
        with pytest.raises(Exception):
            R.read_tsv(spark, os.path.join(tmp_dir, name)).collect()


def test_fasta_preamble_prepend(spark, tmp_dir):
    write(tmp_dir, "a.fasta", "junk\n\nMORE\n>s1\nAC\n>s2\nGG\n")
    write(tmp_dir, "b.fasta", ">t1\nTT\n")
    got = sorted(tuple(r) for r in R.read_fasta(spark, tmp_dir,
                                                 preamble="prepend").collect())
    assert got == [("s1", "junkMOREAC"), ("s2", "GG"), ("t1", "TT")]
