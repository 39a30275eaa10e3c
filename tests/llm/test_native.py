"""URL filter, mixing, tool-call linking and the pipeline: fixtures with
known answers, brute force, odd rows; plans free of Python."""
import hashlib
import json
import math
import random
from datetime import date

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from genoflux.llm import exact_dedup, mixing, queries, tool_calls, url_filters

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().toString()


@pytest.mark.parametrize("name", ["op2_url_filters", "op5_mixing", "op7_exact_dedup", "op10_tool_calls"])
def test_native_plans_run_no_python(spark, name):
    text = plan(queries.QUERIES[name](spark, SF))
    assert "Python" not in text and "Arrow" not in text and "Pandas" not in text


# --- URL filter ------------------------------------------------------------

ENTRY = "kind string, pattern string, action string, day date"
CAPTURE = "page_id long, url string, fetched date, host string"


def captures(spark, rows):
    return spark.createDataFrame([(*r, "clash") for r in rows], CAPTURE)


def verdicts(df):
    return {r["page_id"]: (r["blocked"], r["n_matches"], r["matched"]) for r in df.collect()}


def test_entries_are_judged_as_of_the_fetch_day(spark):
    d = lambda n: date(2024, 1 + n // 28, 1 + n % 28)
    entries = spark.createDataFrame([
        ("host", "Bad.example", "add", d(10)), ("host", "bad.example", "remove", d(40)),
        ("host", "bad.example", "add", d(100)), ("host", "bad.example", "add", d(100)),
        ("domain", "spam.example", "add", d(0)), ("prefix", "x.example/Ads", "add", d(5)),
        ("host", "same.example", "add", d(9)), ("host", "same.example", "remove", d(9)),
        ("host", None, "add", d(1)), (None, "n.example", "add", d(1)), ("host", "n.example", "add", None),
    ], ENTRY)
    rows = [
        (1, "http://bad.example/a", d(9)), (2, "https://user@BAD.example.:8080/a", d(10)),
        (3, "http://bad.example", d(39)), (4, "http://bad.example/", d(40)), (5, "http://bad.example/", d(300)),
        (6, "http://a.b.spam.example/x", d(3)), (7, "http://notspam.example/x", d(3)),
        (8, "http://x.example/Ads/1?q=/", d(5)), (9, "http://x.example/Adsx", d(5)),
        (10, "http://x.example//Ads#f", d(6)), (11, "http://x.example/ads", d(6)),
        (12, "http://same.example/", d(9)), (13, None, d(9)), (14, "no url", d(9)),
        (15, "http://bad.example/", None), (16, "http://n.example/", d(300)), (None, "http://bad.example/", d(11)),
    ]
    got = verdicts(url_filters.filter_captures(captures(spark, rows), entries))
    assert {k for k, v in got.items() if v[0]} == {2, 3, 5, 6, 8, 10, 12, None}
    assert got[6] == (True, 1, "domain:spam.example") and got[8][2] == "prefix:x.example/Ads"


def test_repeated_captures_and_empty_sides(spark):
    entries = spark.createDataFrame([("host", "a.b", "add", date(2024, 1, 1))], ENTRY)
    rows = [(1, "http://a.b/x", date(2024, 2, 1))] * 3
    out = url_filters.filter_captures(captures(spark, rows), entries).collect()
    assert len(out) == 3 and all(r["blocked"] and r["n_matches"] == 1 for r in out)
    none = url_filters.filter_captures(captures(spark, rows), entries.limit(0)).collect()
    assert len(none) == 3 and not any(r["blocked"] for r in none)
    assert url_filters.filter_captures(captures(spark, rows).limit(0), entries).count() == 0


def test_far_dates_cut_no_more_intervals(spark, monkeypatch):
    """Rows of cut intervals are as many for captures of 9999 as of 2024."""
    made = {}
    write = url_filters.cut_lineage

    def counted(df, name):
        out = write(df, name)
        made[name] = made.get(name, []) + [out.count()]
        return out
    monkeypatch.setattr(url_filters, "cut_lineage", counted)
    entries = spark.createDataFrame([("host", f"h{i}.example", "add", date(2024, 1, 1)) for i in range(300)]
                                    + [("host", "h1.example", "remove", date(2500, 6, 15))], ENTRY)
    for last in (date(2024, 3, 1), date(9999, 12, 31)):
        rows = [(i, f"http://h{i}.example/", date(2024, 2, 1)) for i in range(300)] + [(-i, f"http://h{i}.example/", last) for i in (1, 2)]
        got = verdicts(url_filters.filter_captures(captures(spark, rows), entries))
        assert all(got[i][0] for i in range(300)) and got[-1][0] == (last.year == 2024) and got[-2][0]
    near, far = made["intervals-by-month"]
    assert abs(near - far) <= 1


def test_very_long_url(spark):
    url = "http://h.example/" + "a/" * 20_000
    entries = spark.createDataFrame([("prefix", "h.example/a/a", "add", date(2024, 1, 1))], ENTRY)
    got = verdicts(url_filters.filter_captures(captures(spark, [(1, url, date(2025, 1, 1))]), entries))
    assert got[1][:2] == (True, 1)


# --- mixing ----------------------------------------------------------------

def poisson_inverse(u, rate):
    p = total = math.exp(-rate)
    k = 0
    while total <= u and k < 400:
        k += 1
        p *= rate / k
        total += p
    return k


def test_counts_invert_the_distribution(spark):
    import hashlib
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"),
                                    F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 3 == 1, "b").alias("source"))
    weights = spark.createDataFrame([("a", 1.0), ("b", 20.0), (None, 2.0), ("absent", 0.0)], "source string, weight double")
    got = {}
    for r in mixing.mix(docs, weights, epochs=7.0, seed=3).collect():
        got.setdefault(r["doc_id"], []).append((r["__copy"], r["__copies"]))
    for i in range(3000):
        rate = {0: 1, 1: 20, 2: 2}[i % 3] / 23 * 3000 / 1000 * 7
        draws = max(1, math.ceil(rate / mixing.STEP))
        u = [int(hashlib.md5(f"3|{i}|{j}".encode()).hexdigest()[:13], 16) / 2 ** 52 for j in range(1, draws + 1)]
        n = sum(poisson_inverse(x, rate / draws) for x in u)
        assert sorted(got.get(i, [])) == [(c, n) for c in range(1, n + 1)]
    b = sum(len(v) for i, v in got.items() if i % 3 == 1)
    assert abs(b - 20 / 23 * 21000) < 5 * math.sqrt(20 / 23 * 21000)


def test_mixing_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, "a", 5), (1, None, "a", 5), (None, "x", None, 6), (2, "y", "b", 7)],
                                 "doc_id long, text string, source string, weight int")
    weights = spark.createDataFrame([("a", 0.0), (None, 1.0), (None, 1.0)], "source string, weight double")
    out = mixing.mix(docs, weights, epochs=30.0)
    assert out.columns[:4] == docs.columns
    assert {r["source"] for r in out.collect()} == {None}  # a: weight zero, b: no weight
    assert mixing.mix(docs.limit(0), weights).count() == 0
    with pytest.raises(Exception, match="negative"):
        mixing.mix(docs, spark.createDataFrame([("a", -1.0)], "source string, weight double")).count()


def test_rows_without_id_draw_each_by_itself(spark):
    docs = spark.createDataFrame([(None, f"t{i}", "a") for i in range(1000)], "doc_id long, text string, source string")
    out = mixing.mix(docs, mixing.tempered(docs))
    copies = [r["n"] for r in out.groupBy("text").agg(F.count(F.lit(1)).alias("n")).collect()]
    assert len(set(copies)) > 3 and 500 < len(copies) < 760  # about 1 - 1/e of them are drawn at all
    same = spark.createDataFrame([(None, "t", "a")] * 2000, "doc_id long, text string, source string").repartition(4)
    held = mixing.mix(same.unionByName(docs), spark.createDataFrame([("a", 1.0)], "source string, weight double"), epochs=3)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = held.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) == 8 and max(r["count"] for r in sizes) < 2 * sum(r["count"] for r in sizes) / 8


def test_mixing_repeats_exactly(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    runs = [sorted((r["doc_id"], r["__copy"], r["__order"])
                   for r in mixing.mix(d, mixing.tempered(d)).collect()) for d in (docs, docs.repartition(5))]
    assert runs[0] == runs[1]


# --- tool calls ------------------------------------------------------------

CALLS = "conv_id long, turn long, call_id string, tool string, arguments string, after string"
RESULTS = "conv_id long, turn long, call_id string, content string"
SCHEMAS = "tool string, arg string, type string, required boolean, least double, most double"
SEARCH = [("s", "q", "string", True, None, None), ("s", "n", "integer", False, 1.0, 9.0),
          ("s", "f", "boolean", False, None, None), ("s", "x", "number", False, None, 2.5),
          ("s", "l", "array", False, None, None), ("s", "o", "object", False, None, None)]


def linked(spark, calls, results):
    df = tool_calls.link(spark.createDataFrame(calls, CALLS), spark.createDataFrame(results, RESULTS),
                         spark.createDataFrame(SEARCH, SCHEMAS))
    return {(r["conv_id"], r["call_id"]): r for r in df.collect()}


def test_arguments_are_validated(spark):
    cases = {
        "ok": ('{"q": "a", "n": 3, "f": true, "x": 2.5, "l": [], "o": {}}', ""),
        "int_as_number": ('{"q": "a", "x": 2}', ""), "missing": ("{}", "missing q"),
        "null_value": ('{"q": null}', "type q"), "type": ('{"q": 1, "n": 1.5, "f": "t"}', "type f;type n;type q"),
        "range": ('{"q": "", "n": 10, "x": 3}', "range n;range x"), "unknown": ('{"q": "a", "z": 1}', "unknown z"),
        "array": ("[1]", "bad arguments"), "broken": ('{"q": "a"', "bad arguments"), "none": (None, "bad arguments"),
        "twice": ('{"q": "a", "q": "b"}', "bad arguments"), "text": ("", "bad arguments"),
    }
    got = linked(spark, [(1, i, k, "s", a, None) for i, (k, (a, _)) in enumerate(cases.items())], [])
    assert {k: got[1, k]["errors"] for k in cases} == {k: e for k, (_, e) in cases.items()}


def test_records_are_canonical_json(spark):
    arguments = ' { "q" : "é\\u00e9\\n/", "n": 1.50, "b": {"z": 1, "a": [1e2, null]} } '
    got = linked(spark, [(1, 0, "c", "t", arguments, None), (1, 1, "d", 'q"t', "nonsense", None)],
                 [(1, 2, "c", 'line\n"quoted"')])
    assert got[1, "c"]["record"] == ('{"arguments":{"b":{"a":[100,null],"z":1},"n":1.5,"q":"éé\\n/"},"call_id":"c",'
                                     '"level":0,"result":"line\\n\\"quoted\\"","tool":"t"}')
    assert json.loads(got[1, "d"]["record"]) == {"arguments": "nonsense", "call_id": "d", "level": 0,
                                                 "result": None, "tool": 'q"t'}


def test_numbers_of_equal_value_have_one_text_and_one_verdict(spark):
    same = [["100", "1e2", "100.0", "10e1", "1.00E+2", "1000e-1"], ["0", "-0", "0.0", "-0e5", "0e9"], ["-2.5", "-25e-1", "-2.50"],
            ["0.001", "1e-3", "0.0010"], ["12345678901234567890", "12345678901234567890.0"], ["1e300", "10e299"], ["1.5e-300", "15e-301"],
            ["1e41", "1" + "0" * 41], ["7"], ["7.5"], ["123456.789", "1.23456789e5"]]
    forms = [(g, t) for g, ts in enumerate(same) for t in ts]
    calls = [(1, i, f"c{i}", "s", f'{{"q": "1e2 \\"1.0\\" \\\\", "x": {t}, "l": [{t},[{t}]], "n": {t}}}', None)
             for i, (_, t) in enumerate(forms)]
    got = linked(spark, calls, [])
    seen = {}
    for i, (g, t) in enumerate(forms):
        record = got[1, f"c{i}"]["record"].replace(f'"c{i}"', '"c"')
        seen.setdefault(g, set()).add((record, got[1, f"c{i}"]["errors"]))
        args = json.loads(record)["arguments"]
        assert math.isclose(args["x"], float(t), rel_tol=1e-15) and args["l"] == [args["x"], [args["x"]]]
        assert args["q"] == '1e2 "1.0" \\'
        assert ("type n" in got[1, f"c{i}"]["errors"]) == (not float(t).is_integer())
    assert all(len(v) == 1 for v in seen.values()) and len(set().union(*seen.values())) == len(same)
    assert '"x":100}' in min(seen[0])[0] and '"x":0.001}' in min(seen[3])[0] and '"x":1e+300}' in min(seen[5])[0]


def test_very_long_text_in_arguments(spark):
    text = '\\\\ "1e2" ' * 60_000
    got = linked(spark, [(1, 0, "c", "s", json.dumps({"q": text, "x": 1.0}), None)], [(1, 1, "c", text)])
    record = json.loads(got[1, "c"]["record"])
    assert record["arguments"] == {"q": text, "x": 1} and record["result"] == text and got[1, "c"]["errors"] == ""


def test_levels_of_calls_that_need_several(spark):
    """Against a plain topological sort."""
    rng = random.Random(4)
    rows, want = [], {}
    for conv in (1, 2, 3, None):
        n = 60
        needs = {i: {rng.randrange(i) for _ in range(rng.choice([0, 1, 1, 1, 2, 3]))} if i else set() for i in range(n)}
        if conv == 2:  # a cycle among calls that need several, one among calls that need one
            needs[5] = {9, 2}
            needs[9] |= {5}
            needs[20], needs[21] = {21}, {20}
        level = {}
        while True:
            more = {i: 1 + max((level[j] for j in d), default=-1) for i, d in needs.items() if i not in level and d <= level.keys()}
            if not more:
                break
            level |= more
        want |= {(conv, f"c{i}"): level.get(i, -1) for i in needs}
        for i, d in needs.items():
            after = [f"c{j}" for j in sorted(d)] + ([f"c{min(d)}", None] if d and i % 5 == 0 else [])
            rows.append((conv, i, f"c{i}", "s", "{}", (after or None) if i % 7 else [*after, "gone"]))
    calls = spark.createDataFrame(rows, CALLS.replace("after string", "after array<string>"))
    got = tool_calls.levels(calls).collect()
    assert {(r["conv_id"], r["call_id"]): r["level"] for r in got} == want and len(got) == len(want)
    assert all(r["dangling"] == (int(r["call_id"][1:]) % 7 == 0) for r in got)
    out = tool_calls.link(calls, spark.createDataFrame([], RESULTS), spark.createDataFrame(SEARCH, SCHEMAS)).collect()
    assert {(r["conv_id"], r["call_id"]): r["level"] for r in out} == want


def test_linking_and_order(spark):
    calls = [(1, 5, "a", "s", "{}", None), (1, 3, "b", "s", "{}", "a"), (1, 1, "c", "s", "{}", "b"),
             (1, 7, "d", "s", "{}", "gone"), (2, 0, "a", "s", "{}", "b"), (2, 1, "b", "s", "{}", "a"),
             (2, 2, "e", "s", "{}", "b"), (2, 3, "self", "s", "{}", "self"), (None, 0, "a", None, None, None),
             (3, 0, None, "s", "{}", None), (1, 9, "a", "s", "{}", "c"), (1, 5, "a", "s", "{}", None)]
    results = [(1, 8, "a", "late"), (1, 6, "a", "early"), (1, 9, "orphan", "o"), (None, 1, "a", "null conv"),
               (4, 0, None, "lost")]
    got = linked(spark, calls, results)
    level = {k: r["level"] for k, r in got.items()}
    assert [level[1, c] for c in "abcd"] == [0, 1, 2, 0]
    assert [level[2, c] for c in ("a", "b", "e", "self")] == [-1] * 4
    assert got[1, "d"]["errors"].startswith("after unknown") and got[2, "e"]["errors"].startswith("cycle")
    assert '"result":"early"' in got[1, "a"]["record"] and got[1, "a"]["repeats"] == 3
    assert got[1, "orphan"]["status"] == "orphan" and got[1, "b"]["status"] == "unanswered"
    assert got[None, "a"]["status"] == "linked" and got[None, "a"]["errors"] == "unknown tool"
    assert got[3, None]["status"] == got[4, None]["status"] == "unidentified"


def test_later_rows_that_differ_are_returned(spark):
    calls = [(1, 1, "a", "s", '{"q": "x"}', None), (1, 3, "a", "s", '{"q": "x"}', None),
             (1, 5, "a", "s", '{"q": 1}', None), (1, 7, "a", "s", '{"q": 1}', None), (1, 8, "b", "s", '{"q": "y"}', "a"),
             (None, 1, "n", "s", None, None), (None, 2, "n", "s", '{"q": "z"}', None), (2, 1, None, "s", "{}", None)]
    results = [(1, 2, "a", "part 1"), (1, 4, "a", "part 2"), (1, 6, "a", "part 1"), (3, 1, "o", None), (3, 2, "o", "late")]
    frames = [spark.createDataFrame(*x) for x in ((calls, CALLS), (results, RESULTS), (SEARCH, SCHEMAS))]
    rows = tool_calls.link(*frames, later_rows=True).collect()
    got = sorted(((r["conv_id"] or 0, r["call_id"] or "", r["turn"], r["status"], r["repeats"], r["level"], r["errors"])
                  for r in rows), key=lambda r: r[:3])
    assert got == [
        (0, "n", 1, "unanswered", 0, 0, "bad arguments"), (0, "n", 2, "repeated", 0, None, ""),
        (1, "a", 1, "linked", 2, 0, ""), (1, "a", 4, "repeated", 0, None, ""), (1, "a", 5, "repeated", 1, None, "type q"),
        (1, "b", 8, "unanswered", 0, 1, ""), (2, "", 1, "unidentified", 0, None, ""),
        (3, "o", 1, "orphan", 0, None, ""), (3, "o", 2, "repeated", 0, None, "")]
    records = {(r["conv_id"], r["turn"]): json.loads(r["record"]) for r in rows}
    assert records[1, 4]["result"] == "part 2" and records[1, 5]["arguments"] == {"q": 1}
    assert records[3, 2]["result"] == "late" and records[1, 1]["result"] == "part 1"


def test_long_chain_takes_few_rounds(spark):
    n = 700
    calls = [(1, i, f"c{i}", "s", "{}", f"c{i - 1}" if i else None) for i in range(n)]
    one = spark.createDataFrame(calls, CALLS)
    assert sorted(r["level"] for r in tool_calls.levels(one).collect()) == list(range(n))


def test_linking_of_empty_tables(spark):
    assert linked(spark, [], []) == {}


# --- pipeline --------------------------------------------------------------

def test_stages_keep_the_columns_and_take_effect(spark, tmp_path):
    docs = first = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, "/root/testdata/sf0.01").write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.schema == first.schema
        rows.append(docs.count())
        if name == "quality_rules":
            gone = first.join(docs, "doc_id", "left_anti").join(labels, "doc_id")
            assert gone.where("quality = 1").join(
                queries.quality_rules.statistics(first).where(queries.quality_rules.base_failed()),
                "doc_id", "left_anti").count() <= 2
        if name == "exact_dedup":
            norm = docs.select(exact_dedup.normalised(F.col("text")).alias("t"))
            assert norm.distinct().count() == docs.count()
        if name == "ngram_jaccard_join":
            assert queries.jaccard_join.join(docs).where("n_links > 0 or n_copies > 1").count() == 0
    assert rows[0] > rows[1] > rows[2] > rows[3]
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, "").groupBy("sequence_id").agg(F.sum("length").alias("n"))
    assert pieces.agg(F.max("n")).first()[0] <= 4096
    kept = docs.groupBy("doc_id").count()
    assert kept.agg(F.max("count")).first()[0] > 1  # replication took place


def test_pipeline_accepts_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0


def test_vocabularies_are_not_in_the_repository():
    assert queries.vocabulary("word_bpe_49k.json") == public_tokenizers.path("word_bpe_49k.json")


def test_pipeline_against_a_plain_chain(spark):
    """All stages behind the learned one in plain Python, on what it keeps."""
    docs = corpus_pipeline.quality(spark, spark.read.parquet(f"{SF}/documents.parquet"), SF)
    rows = [(r["doc_id"], r["text"] or "", r["source"]) for r in docs.collect()]
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    by_text = {}
    for r in sorted(rows):
        by_text[r[1].translate(str.maketrans(upper, upper.lower()))] = r  # the largest id stays
    rows = sorted(by_text.values())

    def shingles(text):
        words = text.lower().split()
        width = min(5, len(words))
        return {tuple(words[i:i + width]) for i in range(len(words) - width + 1)} if words else set()
    sets = {r[0]: shingles(r[1]) for r in rows}
    root = {r[0]: r[0] for r in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, (a, *_) in enumerate(rows):
        for b, *_ in rows[:i]:
            x, y = sets[a], sets[b]
            if not (x or y) or x and y and len(x & y) >= 0.8 * len(x | y):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    rows = [r for r in rows if find(r[0]) == r[0]]

    sizes = {}
    for r in rows:
        sizes[r[2]] = sizes.get(r[2], 0) + 1
    total, weights = len(rows), sum(math.sqrt(n) for n in sizes.values())
    tokenizer = Tokenizer.from_file(queries.vocabulary("word_bpe_49k.json"))
    want = {}
    for i, text, source in rows:
        rate = math.sqrt(sizes[source]) / weights * total / sizes[source]
        u = int(hashlib.md5(f"7|{i}|1".encode()).hexdigest()[:13], 16) / 2 ** 52
        copies, p, below = 0, math.exp(-rate), math.exp(-rate)
        while below <= u:
            copies += 1
            p *= rate / copies
            below += p
        if copies:
            want[i] = (len(tokenizer.encode(text, add_special_tokens=False).ids) + 1, copies)
    got = {}
    for r in corpus_pipeline.run(spark, SF).collect():
        tokens, held = got.get(r["doc_id"], (r["doc_tokens"], 0))
        got[r["doc_id"]] = (tokens, held + r["length"])
    assert got == {i: (n, n * copies) for i, (n, copies) in want.items()}
