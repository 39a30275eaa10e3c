"""The Jaccard join against all pairs compared by brute force."""
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from genoflux.llm import jaccard_join as J


def sets_of(text):
    w = (text or "").lower().split()
    n = min(5, len(w))
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if w else frozenset()


def brute(rows):
    """doc_id -> columns of the join, for unique ids."""
    sets = {i: sets_of(t) for i, t in rows}
    members = defaultdict(list)
    for i, s in sets.items():
        members[s].append(i)
    keys = list(members)
    parent = list(range(len(keys)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    links, docs = [0] * len(keys), [0] * len(keys)
    for a in range(len(keys)):
        for b in range(a):
            x, y = keys[a], keys[b]
            if not x or not y or min(len(x), len(y)) < 0.8 * max(len(x), len(y)):
                continue
            common = len(x & y)
            if common >= 0.8 * (len(x) + len(y) - common) - 1e-9:
                links[a] += 1
                links[b] += 1
                docs[a] += len(members[y])
                docs[b] += len(members[x])
                parent[root(a)] = root(b)
    least = defaultdict(lambda: 1 << 60)
    for k, s in enumerate(keys):
        least[root(k)] = min(least[root(k)], min(members[s]))
    return {i: (least[root(k)], min(members[s]), links[k], docs[k], len(members[s]))
            for k, s in enumerate(keys) for i in members[s]}


def result(df):
    return {r["doc_id"]: (r["class_id"], r["set_id"], r["n_links"], r["n_linked_docs"], r["n_copies"])
            for r in df.collect()}


def near_copies(n_groups=12, seed=5):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for g in range(n_groups):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(3, 160))]
        for c in range(rng.randint(1, 14)):
            words = list(base)
            for _ in range(rng.randint(0, 4)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(words)))
    return rows + [(len(rows), ""), (len(rows) + 1, None), (len(rows) + 2, "one"), (len(rows) + 3, "ONE")]


def test_sample_table_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert result(J.join(docs)) == brute(rows)


@pytest.mark.parametrize(("block", "dense"), [(512, 4), (3, 4), (3, 0), (3, 1e9)])
def test_near_copies_against_brute_force(spark, monkeypatch, block, dense):
    monkeypatch.setattr(J, "BLOCK_CLASSES", block)  # 3: components span several blocks
    monkeypatch.setattr(J, "DENSE", dense)  # 0: all of them by band key; 1e9: none
    rows = near_copies()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert result(J.join(docs)) == brute(rows)


def test_keep_one_holds_one_row_per_class_and_all_columns(spark):
    rows = [(3, "a b c d e f g", "x"), (1, "a b c d e f g", "y"), (1, "a b c d e f g", "y"),
            (7, "lone words here", "z"), (None, None, "n"), (None, "", "m"), (9, "zz " * 3000, "long")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, digest string")
    kept = J.keep_one(docs)
    assert kept.columns == docs.columns
    got = sorted((r["doc_id"] or 0, r["digest"]) for r in kept.collect())
    assert [g[0] for g in got] == [0, 1, 7, 9] and got[1][1] == "y"


def test_repeated_id_with_other_text_is_judged_by_its_own_text(spark):
    rows = [(1, "p q r s t u v"), (5, "a b c d e f g"), (5, "p q r s t u v")]
    kept = J.keep_one(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, kept.collect())) == [(1, "p q r s t u v"), (5, "a b c d e f g")]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert J.join(docs).count() == 0 and J.keep_one(docs).count() == 0


def test_pruning_keeps_pairs_at_the_threshold():
    least = J.least_matches(0.8, 1e-8)
    rng = np.random.default_rng(3)
    n = np.arange(1, len(least) + 1) * J.CHUNK
    draws = rng.random((2000, J.BANDS * J.ROWS)) < 0.8
    matches = draws.cumsum(axis=1)[:, n - 1]
    assert (matches >= least).all()
    low = rng.random((200, J.BANDS * J.ROWS)) < 0.4
    assert (low.cumsum(axis=1)[:, n - 1] < least).any(axis=1).all()


def chain(n):
    """Texts that share 108 of 122 words with the next one: similarity 0.79 and below."""
    return [(i, " ".join(f"w{14 * i + k}" for k in range(122))) for i in range(n)]


def test_chain_of_neighbours_sends_rows_in_proportion(spark, monkeypatch):
    monkeypatch.setattr(J, "BLOCK_CLASSES", 32)
    sent = []
    blocks = J._blocks

    def counted(*a):
        out = blocks(*a)
        sent.append(out.count())
        return out
    monkeypatch.setattr(J, "_blocks", counted)
    for n in (300, 900):
        docs = spark.createDataFrame(chain(n), "doc_id long, text string").repartition(4)
        assert all(r["n_links"] == 0 for r in J.join(docs).collect())
    assert sent[1] < 3.5 * sent[0] and sent[1] < 900 * J.BANDS


def test_texts_of_one_hash_keep_their_links(spark, monkeypatch):
    rows = near_copies()
    monkeypatch.setattr(J, "text_key", lambda text: F.pmod(F.xxhash64(text), F.lit(3)))
    assert result(J.join(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))) == brute(rows)
