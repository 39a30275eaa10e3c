"""Exact dedup against plain Python, packing by an exact round trip."""
import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from genoflux.llm import exact_dedup as D
from genoflux.llm import packing as P

LOWER = str.maketrans(D.UPPER, D.UPPER.lower())
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
ODD = [(1, "Same"), (2, "sAME"), (3, "same "), (2, "same"), (None, "same"), (4, None), (5, ""),
       (None, "alone"), (None, "ALONE"), (6, "É"), (7, "é"), (8, "x" * 200_000), (9, "X" * 200_000)]


def expected(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault((t or "").translate(LOWER), []).append(i)
    out = []
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        left = 1
        for i in ids:
            kept = i == keep and left > 0
            left -= kept
            out.append((i, keep, len(ids), kept, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=str)


def test_marks_against_plain_python(spark):
    docs = spark.createDataFrame(ODD, "doc_id long, text string").repartition(4)
    docs = docs.withColumn("digest", F.lit(1)).withColumn("keep_id", F.lit("clash"))
    got = sorted((tuple(r) for r in D.mark_duplicates(docs, salts=3).collect()), key=str)
    assert got == expected(ODD)


def test_colliding_digests_change_nothing(spark):
    docs = spark.createDataFrame(ODD + [(20 + i, f"t{i % 7}") for i in range(60)],
                                 "doc_id long, text string").repartition(5)
    columns = ["doc_id", "rows", "keep_id", "group_size"]
    strong = D.decide(docs).select(columns)
    weak = D.decide(docs, digest=lambda c: F.unhex(F.substring(F.sha2(c, 256), 1, 1).cast("string")))
    assert sorted(map(str, strong.collect())) == sorted(map(str, weak.select(columns).collect()))


def test_drop_keeps_one_row_of_each_text(spark):
    docs = spark.createDataFrame(ODD, "doc_id long, text string").repartition(3)
    kept = [(r["doc_id"], (r["text"] or "").translate(LOWER)) for r in D.drop_duplicates(docs).collect()]
    want = [(k, t) for i, k, _, kept_, t in expected(ODD) if kept_]
    assert sorted((i, hashlib.sha256(t.encode()).hexdigest()) for i, t in kept if i is not None) == \
        sorted((i, t) for i, t in want if i is not None)
    assert len(kept) == len(want)


def test_dedup_of_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert D.mark_duplicates(docs).count() == 0 and D.drop_duplicates(docs).count() == 0


def check_pieces(rows, docs, capacity=P.CAPACITY):
    """Every id lies in exactly one piece and every sequence is gapless."""
    tokenizer = Tokenizer.from_file(VOCABULARY)
    sequences, by_doc = {}, {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        by_doc.setdefault(r["doc_id"], []).append(r)
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    for doc_id, text in docs:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        at = 0
        for r in sorted(by_doc.pop(doc_id), key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            part = ids[at:at + r["length"]]
            assert r["ids_crc32"] == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in part))
            at += r["length"]
        assert at == len(ids)
    assert not by_doc
    return sequences


def test_packing_round_trip(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(2, "doc_id")
    rows = P.pack(docs, VOCABULARY).collect()
    sequences = check_pieces(rows, [(r["doc_id"], r["text"]) for r in docs.collect()])
    tokens = sum(r["length"] for r in rows)
    assert len(sequences) * P.CAPACITY - tokens <= 0.006 * tokens + 2 * P.CAPACITY


def test_packing_of_odd_texts(spark):
    odd = ["", None, "a  b\n\nc", "É  é x\t<|endoftext|>y", "<|ENDOFTEXT|> <|endoftext|>",
           "it's we'll İstanbul ΣΑΣ ΟΔΟΣ x", "a.b c,, d., ,e '.s'.", "ª º µ², don't.'s ℌ ⅷ",
           "\x1c\x85 a b　c d", "word " * 9000, "q" * 20000, "!!! ??? .. Ab. aB"]
    rows = list(enumerate(odd))
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("start", F.lit("x"))
    check_pieces(P.pack(docs.repartition(1), VOCABULARY).collect(), rows)


def test_packing_of_an_empty_table_and_null_ids(spark):
    assert P.pack(spark.createDataFrame([], "doc_id long, text string"), VOCABULARY).count() == 0
    one = P.pack(spark.createDataFrame([(None, "x"), (None, "x")], "doc_id long, text string"), VOCABULARY)
    assert [r["doc_id"] for r in one.collect()] == [None, None]


@pytest.mark.parametrize("sizes", [[4096], [1], [4095, 4095, 2], [3000] * 7, [10] * 900, [2049] * 5,
                                   list(range(1, 400))])
def test_windows_hold_every_token_once(sizes):
    windows = P.fill_windows(sizes)
    pieces = sorted(p for w in windows for p in w)
    at = [0] * len(sizes)
    for i, start, length in pieces:
        assert start == at[i]
        at[i] += length
    assert at == sizes
    assert max(sum(p[2] for p in w) for w in windows) <= P.CAPACITY
    assert len(windows) <= max(-(-sum(sizes) // P.CAPACITY), -(-int(sum(sizes) * 1.005 + 1) // P.CAPACITY))


@pytest.mark.parametrize("mix", ["even", "around 3000", "around 400"])
def test_differencing_alone_meets_the_capacity(mix):
    rng = np.random.default_rng(0)
    sizes = {"even": lambda: rng.integers(1500, 4001, 360),
             "around 3000": lambda: rng.lognormal(np.log(3000), .3, 340).astype(int).clip(1, 4095),
             "around 400": lambda: rng.lognormal(np.log(400), .8, 1800).astype(int).clip(1, 4095)}[mix]()
    windows = P.fill_windows(sizes.tolist())
    used = [sum(length for *_, length in w) for w in windows]
    assert max(used) <= P.CAPACITY and sum(used) == sizes.sum()
    assert len(windows) * P.CAPACITY - sum(used) < 0.01 * sum(used)
    # pieces end where the items were cut beforehand: nothing was cut to fit
    assert all(start % P.PIECE == 0 and (length % P.PIECE == 0 or start + length == sizes[i])
               for w in windows for i, start, length in w)


@pytest.mark.parametrize("parts", [64, 400])
def test_padding_does_not_depend_on_the_partitions(spark, parts):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").repartition(parts)
    rows = P.pack(docs, VOCABULARY).collect()
    tokens = sum(r["length"] for r in rows)
    assert len({r["sequence_id"] for r in rows}) * P.CAPACITY < 1.02 * tokens


def test_differencing_balances():
    import numpy as np
    sizes = np.random.default_rng(1).integers(1, 4096, 400)
    sums = [int(sizes[w].sum()) for w in P.difference(sizes, 60)]
    assert len(sums) == 60 and sum(sums) == sizes.sum() and max(sums) - min(sums) < 0.05 * sizes.sum() / 60


def test_encoder_forgets_rare_words_only(monkeypatch):
    words = P.WordEncoder(VOCABULARY)
    plain = Tokenizer.from_file(VOCABULARY)
    texts = [f"common Words, here rare{i}x unique{i}." for i in range(60)]
    for t in texts:
        got = words.encode([t, ""])
        assert got[0][:-1].tolist() == plain.encode(t, add_special_tokens=False).ids and len(got[1]) == 1
        words.forget(20)
    assert len(words.codes) <= 24 and "common" in words.codes
    words.forget(1)
    assert list(words.codes) == [""]
    assert words.encode(["common"])[0][:-1].tolist() == plain.encode("common", add_special_tokens=False).ids
