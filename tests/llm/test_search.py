"""Ranked search, hard negatives and SimHash classes against plain versions
over all rows, odd rows included."""
import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
import xxhash

from genoflux.llm import hard_negatives, queries, ranked_search, simhash

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", ["op11_ranked_search", "op12_hard_negatives"])
def test_query_matches_sql(spark, con, name):
    df = queries.QUERIES[name](spark, SF)
    cur = con.execute(queries.ORACLE[name])
    names = [d[0] for d in cur.description]
    assert sorted(map(tuple, df.select(*names).collect())) == sorted(cur.fetchall())


# --- ranked search ---------------------------------------------------------

def search_brute(docs, items, k=10):
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

    def terms(text):
        return pattern.findall((text or "").translate(lower))
    held = [(i, Counter(terms(t))) for i, t in docs]
    held = [(i, c, sum(c.values())) for i, c in held if c]
    total, out = sum(n for *_, n in held), []
    df = Counter(t for _, c, _ in held for t in c)
    for item, text in {x for x in items if x[1] is not None}:
        scored = []
        for i, c, n in held:
            m = 25 + (75 * n * len(held)) // total
            s = sum(math.floor(1000 * math.log((2 * len(held) + 2) / (2 * df[t] + 1)))
                    * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in terms(text) if c[t])
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        scored.sort(key=lambda x: x[:3])
        out += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(scored[:k], 1)]
    return sorted(out, key=str)


def search_run(spark, docs, items, **kw):
    d = spark.createDataFrame([(*r, "x", 1) for r in docs], "doc_id long, text string, terms string, score int")
    q = spark.createDataFrame([(*r, "x", 1) for r in items], "item_id long, text string, rank string, n int")
    return sorted(map(tuple, ranked_search.search(d.repartition(3), q, **kw).collect()), key=str)


def test_search_odd_rows(spark):
    docs = [(1, "Alpha beta"), (2, "alpha, BETA"), (3, None), (4, ""), (5, " ... "), (None, "alpha beta"),
            (7, "alpha " * 9000), (8, "été ÉTÉ 42 beta"), (8, "été 42"), (9, "gamma\x00delta"), (10, "rare beta beta")]
    items = [(1, "alpha beta"), (1, "alpha beta"), (1, "beta"), (2, None), (3, "?!"), (4, "ÉTÉ été 42 42"),
             (None, "delta rare rare"), (6, "unseen")]
    got = search_run(spark, docs, items)
    assert got == search_brute(docs, items)
    ties = [r for r in got if r[0] == 4]
    assert [r[2] for r in ties] == [8, 8]


@pytest.mark.parametrize("block", [8192, 7])
def test_search_random_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(ranked_search, "BLOCK_DOCS", block)  # 7: thresholds carry over many blocks
    rng = random.Random(5)
    words = [f"w{i}" for i in range(150)]
    pick = lambda n: " ".join(words[int(149 * rng.random() ** 3)] for _ in range(n))
    docs = [(i // 2 if i % 50 == 0 else i, pick(rng.choice([1, 3, 20, 200]))) for i in range(400)]
    items = [(i, pick(rng.choice([1, 5, 30, 120]))) for i in range(25)]  # 120: masks of more than 64 terms
    assert search_run(spark, docs, items) == search_brute(docs, items)
    assert search_run(spark, docs, items, k=3) == search_brute(docs, items, 3)


def test_search_in_blocks_of_items(spark, monkeypatch):
    monkeypatch.setattr(ranked_search, "ITEM_BYTES", 64)
    docs = [(i, f"a{i % 3} b{i % 7} c{i}") for i in range(60)]
    items = [(i, f"a{i % 3} c{i}") for i in range(12)]
    assert search_run(spark, docs, items) == search_brute(docs, items)


def test_search_evaluates_few_groups():
    """A block where one mask holds the best documents: the rest is left."""
    scored = []

    class Counting(ranked_search._Block):
        def scores(self, docs, weights):
            scored.extend(docs.tolist())
            return super().scores(docs, weights)
    import pyarrow as pa
    n = 500
    columns = [pa.array(range(n)), pa.array([10] * n), pa.array([[0, 1] if i < 20 else [1] for i in range(n)], pa.list_(pa.int32())),
               pa.array([[1, 1] if i < 20 else [1] for i in range(n)], pa.list_(pa.int64()))]
    block = Counting(columns, n, 2, 10 * n)
    none = (np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64))
    found = ranked_search.evaluate(block, [(0, 900), (1, 100)], np.array([900, 100]), none, 10)
    assert found[2].tolist() == list(range(10)) and sorted(scored) == list(range(20))


def test_search_empty_tables(spark):
    assert search_run(spark, [(1, "a")], []) == [] and search_run(spark, [], [(1, "a")]) == []
    assert search_run(spark, [(1, "?")], [(1, "a")]) == []


# --- hard negatives --------------------------------------------------------

def mine_brute(rows, k=5):
    ok = [(i, lab, [math.floor(256 * x) for x in v]) for i, lab, v in rows if None not in (i, lab, v)
          and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a in {(i, lab, tuple(v)) for i, lab, v in ok if i % 100 == 0}:
        scored = sorted((-sum(x * y for x, y in zip(a[2], v, strict=False)), i, lab) for i, lab, v in ok if i != a[0])
        for p, pid, _ in [s for s in scored if s[2] == a[1]][:k]:
            inside = [s for s in scored if s[2] != a[1] and 80 * -p <= 100 * -s[0] <= 100 * -p][:k]
            out += [(a[0], pid, r, i, -p, -s) for r, (s, i, _) in enumerate(inside, 1)]
    return sorted(out)


VECTORS = "vec_id long, embedding array<float>, label int, key string, score int"


def mine_run(spark, rows):
    df = spark.createDataFrame([(i, v, lab, "clash", 1) for i, lab, v in rows], VECTORS)
    return sorted(map(tuple, hard_negatives.mine(df.repartition(3)).collect()))


def clustered(n, clusters, width=6, seed=2):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clusters, width)) * 2
    return [(i, int(rng.integers(3)), [float(np.float32(x)) for x in centres[rng.integers(clusters)] + rng.normal(size=width) * .05])
            for i in range(n)]


@pytest.mark.parametrize(("tree", "anchors"), [(512, 8192), (3, 8192), (2, 3)])
def test_mining_against_brute_force(spark, monkeypatch, tree, anchors):
    monkeypatch.setattr(hard_negatives, "TREE", tree)
    monkeypatch.setattr(hard_negatives, "ANCHORS", anchors)  # 3: several blocks of anchors
    monkeypatch.setattr(hard_negatives, "ROWS", 64)
    rows = clustered(1500, 4)
    rows += [(i, 1, rows[0][2]) for i in range(1500, 1720)]  # one vector very often, anchors among its rows
    assert mine_run(spark, rows) == mine_brute(rows)


def test_mining_odd_rows(spark):
    v = [1.0, 0.5]
    rows = [(0, 1, v), (0, 1, v), (1, 1, v), (2, 1, [0.9, 0.5]), (2, 1, [0.9, 0.5]), (3, 2, [0.9, 0.5]), (4, 2, [0.8]),
            (5, 2, [0.9, 0.5]), (6, None, v), (7, 2, None), (8, 2, [1.0, None]), (9, 2, [float("nan"), 1.0]), (10, 2, []),
            (11, 2, [float("inf"), 0.0]), (None, 2, [0.9, 0.5]), (100, 3, v), (200, 1, [-1.0, 0.0]), (300, None, v),
            (12, 2, [-0.9, -0.1]), (13, 1, [-.3, .2])]
    assert mine_run(spark, rows) == mine_brute(rows)


def test_mining_empty_and_no_anchor(spark):
    assert mine_run(spark, []) == [] and mine_run(spark, [(1, 1, [1.0]), (2, 2, [1.0])]) == []


def test_mining_fails_on_components_beyond_exact_sums(spark):
    with pytest.raises(Exception, match="would not be exact"):
        mine_run(spark, [(0, 1, [1e9]), (1, 1, [1.0])])


def test_tree_bounds_rescore_only_what_overlaps():
    rng = np.random.default_rng(1)
    points = np.floor(256 * (np.array([2.0, 1, 0, 1]) + rng.normal(size=(40, 4)) * .01))
    rows = np.floor(256 * rng.normal(size=(1000, 4)))
    parent, length = hard_negatives.spanning_tree(points)
    assert length[1:].sum() < np.sqrt(((points[1:] - points[0]) ** 2).sum(axis=1)).sum()
    node = {"vec_id": 0, "label": 0}
    forest = hard_negatives._forest([node | {"tree": 0, "pos": i, "parent": int(parent[i]), "length": float(length[i]),
                                             "vector": (points[i] / 256).tolist()} for i in range(40)], 4)
    low, high = np.full(40, 200_000.0), np.full(40, 250_000.0)
    i, j, s, rescored = hard_negatives.scan_tree(forest[0], rows, np.ones((40, 1000), bool), low, high)
    whole = points @ rows.T
    assert sorted(zip(i, j, s, strict=True)) == sorted((a, b, whole[a, b]) for a, b in np.argwhere((whole >= 2e5) & (whole <= 2.5e5)))
    assert 0 < len(i) and rescored < 0.5 * whole.size


# --- SimHash ---------------------------------------------------------------

def fp_brute(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_brute(rows):
    fps = {fp_brute(t) for _, t in rows}
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f
    ordered = sorted(fps)
    for x, a in enumerate(ordered):
        for b in ordered[:x]:
            if (a ^ b).bit_count() <= 2:
                root[find(a)] = find(b)
    least = {}
    for i, t in rows:
        if i is not None:
            f = find(fp_brute(t))
            least[f] = min(i, least.get(f, i))
    return sorted(((i, f"{fp_brute(t):016x}", least.get(find(fp_brute(t)))) for i, t in rows), key=str)


def near_run(spark, rows):
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, fp string, root int")
    return sorted(map(tuple, simhash.near_duplicates(df.repartition(3)).collect()), key=str)


def test_simhash_sample_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    got = sorted(map(tuple, queries.QUERIES["op13_simhash_near_dedup"](spark, SF).collect()), key=str)
    assert got == near_brute([tuple(r) for r in docs.collect()])


def test_simhash_odd_rows(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "One"), (5, "one"), (6, "one two"), (None, "one two"), (8, " x y"),
            (9, "ÉÀ x y z"), (10, "long " * 30_000), (10, "one"), (None, "lone words here")]
    for _ in range(25):  # near copies, whose fingerprints differ in few bits
        base = [rng.choice(words) for _ in range(rng.randint(60, 400))]
        for _ in range(8):
            copy = list(base)
            copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append((rng.randrange(10_000), " ".join(copy)))
    got = near_run(spark, rows)
    assert got == near_brute(rows)
    assert len({r[2] for r in got}) < len({r[1] for r in got})


def test_simhash_links_are_all_pairs_within_two_bits_once(spark):
    rng = random.Random(9)
    fps = set()
    for _ in range(40):
        f = rng.choice([rng.getrandbits(64), 0, (1 << 64) - 1, 0x5555555555555555])
        fps |= {f} | {f ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) ^ rng.choice([0, 1 << rng.randrange(64)]) for _ in range(12)}
    signed = [f - (1 << 64) if f >> 63 else f for f in sorted(fps)]
    for distance in (1, 2):
        got = [(*sorted((r["a"], r["b"])), r["bits"]) for r in simhash.links(
            spark.createDataFrame([(f,) for f in signed], "fp long"), distance).collect()]
        bits = lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count()
        assert sorted(got) == sorted((*sorted((a, b)), bits(a, b)) for x, a in enumerate(signed) for b in signed[:x] if bits(a, b) <= distance)


def test_simhash_empty_table(spark):
    assert near_run(spark, []) == []
