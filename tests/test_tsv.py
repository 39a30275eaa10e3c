"""The quote-aware TSV scan against a plain character reader, over files cut
into many small splits."""
import os
import random

import pytest

from genoflux.sources import readers as R
from genoflux.sources.tsv import read_tsv_records


def write(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", newline="") as f:
        f.write(text)


def plain(text):
    """Records of cells, character by character."""
    records, cells, cell, state, some = [], [], "", "start", False
    at = 0
    while at <= len(text):
        c = text[at] if at < len(text) else "\n"
        if state == "quoted":
            if c == '"' and text[at + 1:at + 2] == '"':
                cell += '"'
                at += 1
            elif c == '"':
                state = "closed"
            else:
                cell += c
        elif c in "\t\n":
            cells.append(cell if state == "closed" else cell.strip())
            cell, state = "", "start"
            if c == "\n":
                if some or len(cells) > 1:
                    records.append(cells)
                cells, some = [], False
        elif c == '"' and state == "start":
            state, cell, some = "quoted", "", True
        else:
            some = True
            if state != "closed":
                cell += c
                state = "start" if not cell.strip() else "text"
        at += 1
    return records


def expected(text):
    head, *rows = plain(text)
    return [tuple(dict(zip(head, r)).get(c) for c in dict.fromkeys(head)) for r in rows]


def table_text(rng, rows, header):
    def cell():
        kind = rng.randrange(8)
        body = "".join(rng.choice(["a", "bc", " ", "\t", "\n", '"', "\n\n", "é", '""']) for _ in range(rng.randrange(6)))
        if kind < 3:
            return rng.choice(["x", " y ", "", 'five" wide', "z"])
        return rng.choice(["", " "]) + '"' + body.replace('"', '""') + '"' + rng.choice(["", " "])
    lines = ["\t".join(header)]
    for _ in range(rows):
        lines.append("\t".join(cell() for _ in range(len(header) + rng.choice([0, 0, 0, 1]))))
        if rng.random() < .1:
            lines.append("")
    return "\n".join(lines) + rng.choice(["", "\n"])


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_tables_over_many_splits(spark, tmp_dir, seed):
    rng = random.Random(seed)
    text = table_text(rng, 300, ["strain", "note", "age"])
    write(tmp_dir, "a.tsv", text)
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(200 + seed * 37))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        df = read_tsv_records(spark, tmp_dir, ordinal="o").select("strain", "note", "age", "o")
        got = [tuple(r)[:3] for r in sorted(df.collect(), key=lambda r: r["o"])]
        assert spark.read.text(tmp_dir).rdd.getNumPartitions() > 8
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == expected(text)


def test_a_record_over_several_splits(spark, tmp_dir):
    long = "\n".join(f'line {i} ""q""\t' for i in range(400))
    write(tmp_dir, "a.tsv", f'k\tv\n1\t"{long}"\n2\tplain\n3\t"two\nlines"\n')
    write(tmp_dir, "b.tsv", "k\tv\n4\tother file\n")
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
        got = dict(map(tuple, read_tsv_records(spark, tmp_dir).select("k", "v").collect()))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert got == {"1": long.replace('""', '"'), "2": "plain", "3": "two\nlines", "4": "other file"}


def test_header_orders_extra_cells_and_repeated_names(spark, tmp_dir):
    write(tmp_dir, "a.tsv", "strain\tage\tqc.score\ns1\t4\t.5\tmore\tcells\n\ns2\t\t\n")
    write(tmp_dir, "b.tsv", "age\tstrain\tage\r\n5\ts3\t6\r\n")
    df = read_tsv_records(spark, tmp_dir).select("strain", "age", "`qc.score`")
    assert sorted(map(tuple, df.collect())) == [("s1", "4", ".5"), ("s2", "", ""), ("s3", "6", None)]
    assert read_tsv_records(spark, tmp_dir, columns=["age", "absent"]).columns == ["age", "absent"]


@pytest.mark.parametrize(("text", "message"), [
    ("a\tb\n1\n", "fewer cells"), ('a\tb\n1\t"x" y\n', "closing quote"), ('a\tb\n1\t"x\n2\ty\n', "not closed")])
def test_bad_rows_fail(spark, tmp_dir, text, message):
    write(tmp_dir, "a.tsv", text)
    with pytest.raises(Exception, match=message):
        read_tsv_records(spark, tmp_dir).collect()


def test_plain_files_are_not_shuffled(spark, tmp_dir):
    write(tmp_dir, "a.tsv", 'a\tb\n1\t"x ""y"""\n')
    df = read_tsv_records(spark, tmp_dir)
    assert [tuple(r) for r in df.collect()] == [("1", 'x "y"')]
    assert "Exchange hashpartitioning" not in df._jdf.queryExecution().executedPlan().toString()


def test_empty_files(spark, tmp_dir):
    write(tmp_dir, "a.tsv", "a\tb\n")
    write(tmp_dir, "b.tsv", "")
    assert read_tsv_records(spark, tmp_dir).count() == 0


def test_fasta_blank_lines_and_lone_carriage_returns(spark, tmp_dir):
    write(tmp_dir, "a.fasta", "\n \n>s1\nAC\n")
    write(tmp_dir, "b.fasta", "\r\n\r\n>t1\r\nTT\r\n\r\n>t2\r\n")
    write(tmp_dir, "c.fasta", "\r>u1\rGG\rCC\r>u2 x\rA\r\r>u3\n>u4\nT")
    write(tmp_dir, "d.fasta", "\n\n")
    got = sorted(tuple(r) for r in R.read_fasta(spark, tmp_dir).collect())
    assert got == [("s1", "AC"), ("t1", "TT"), ("t2", ""), ("u1", "GGCC"), ("u2 x", "A"), ("u3", ""), ("u4", "T")]
    ordered = R.read_fasta(spark, f"{tmp_dir}/c.fasta", ordinal="o").orderBy("o")
    assert [r["sample_name"] for r in ordered.collect()] == ["u1", "u2 x", "u3", "u4"]
    write(tmp_dir, "a.fasta", "\n\ntext\n\n>s1\nAC\n")
    with pytest.raises(Exception, match="before the first"):
        R.read_fasta(spark, tmp_dir).collect()
    assert ("s1", "textAC") in [tuple(r) for r in R.read_fasta(spark, tmp_dir, preamble="prepend").collect()]
