"""Quality rules as a learned decision list.

Statistics of every whole text (word, symbol, line and repetition counts)
feed two verdicts.  The base rules are fixed.  The learned part is an
ordered list of rules, each a conjunction of ``feature <= t`` or
``feature > t``, found by sequential covering on labelled documents:

* a rule grows on two thirds of the rows by the condition of largest
  information gain until it covers no good document;
* it is pruned on the remaining third: final conditions go while that does
  not lower its (bad - good) / covered there;
* it is accepted if it is precise enough on rows it was not grown on; the
  rows it covers leave both parts and the next rule is grown.

The list is emitted as one ordered Spark ``when`` expression over the
statistics, so scoring is a projection.

Labels: a document whose labels disagree, or are null, teaches nothing.  At
most ``sample`` labelled ids are used, those of the smallest id hashes; all
documents are scored.  Without labelled bad documents the list is empty and
keeps everything.  Defined cases: a null text has no words and fails the
base rules; null and repeated ids are scored row by row; an empty table
gives no rows.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, map_text, small_batches

#: Largest number of labelled documents the list is learned from.
SAMPLE = 20_000
MAX_RULES, MAX_CONDITIONS, CUTS = 16, 4, 200
MIN_PRECISION, MIN_COVERED = 0.9, 5

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MORE = ("n_lines", "n_upper", "n_lower", "n_digits", "n_marks", "n_distinct_words")
COUNTS = BASE + MORE
SCHEMA = ", ".join(["doc_id long", *(f"{c} long" for c in COUNTS)])
ARROW = pa.schema([(c, pa.int64()) for c in ("doc_id", *COUNTS)])

# The symbol characters and the base rules' limits.
SYMBOLS = "#*$%&|<>"
MIN_WORDS, REPEAT_PERCENT = 50, 50


class _Codes(dict):
    def __missing__(self, word):
        code = self[word] = len(self)
        return code


def repeated_words(codes: np.ndarray, distinct: int) -> int:
    """Words that lie in a three-word window found twice or more."""
    n = len(codes)
    if n < 4:
        return 0
    key = codes[:-2] * distinct + codes[1:-1]
    if distinct >= 1 << 20:
        key = np.unique(key, return_inverse=True)[1]
    key = key * distinct + codes[2:]
    order = np.argsort(key)
    same = key[order[1:]] == key[order[:-1]]
    windows = np.zeros(n, bool)
    windows[order[1:][same]] = True
    windows[order[:-1][same]] = True
    inside = windows.copy()
    inside[1:] |= windows[:-1]
    inside[2:] |= windows[:-2]
    return int(inside.sum())


def text_counts(text: str) -> tuple[int, ...]:
    """The statistics in the order of ``COUNTS``.  Words end at the six
    ASCII white-space characters, which is how bytes are split."""
    data = text.encode("utf-8", "surrogatepass")
    freq = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    words = data.split()
    seen = _Codes()
    codes = np.fromiter(map(seen.__getitem__, words), np.int64, len(words))
    lines = [x for x in data.split(b"\n") if x.strip()]
    total = lambda chars: int(freq[list(chars.encode())].sum())
    return (len(words), len(text) - int(freq[9:14].sum()) - int(freq[32]), total(SYMBOLS),
            len(lines) - len(set(lines)), repeated_words(codes, len(seen)), len(lines),
            int(freq[65:91].sum()), int(freq[97:123].sum()), int(freq[48:58].sum()),
            total("!?.,;:"), len(seen))


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``COUNTS`` of every row."""
    def counts(ids, texts):
        rows = [text_counts(t) for t in texts]
        return {"doc_id": ids} | {c: [r[i] for r in rows] for i, c in enumerate(COUNTS)}
    return map_text(id_and_text(docs, id_col, text_col), counts, SCHEMA, ARROW)


def _count_column(text: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([text_counts(t) for t in text], columns=list(COUNTS), dtype="int64")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


# Features: one count over another; a document without the latter has 0.
FEATURES = {
    "words": ("n_words", None),
    "word_length": ("word_chars", "n_words"),
    "symbols_per_word": ("n_symbols", "n_words"),
    "repeated_lines": ("n_dup_lines", "n_lines"),
    "repeated_words": ("n_repeat_words", "n_words"),
    "words_per_line": ("n_words", "n_lines"),
    "upper_share": ("n_upper", "word_chars"),
    "lower_share": ("n_lower", "word_chars"),
    "digit_share": ("n_digits", "word_chars"),
    "marks_per_word": ("n_marks", "n_words"),
    "distinct_words": ("n_distinct_words", "n_words"),
}


class Condition(NamedTuple):
    feature: str
    above: bool
    threshold: float

    def covers(self, x: dict[str, np.ndarray]) -> np.ndarray:
        v = x[self.feature]
        return v > self.threshold if self.above else v <= self.threshold

    def column(self) -> Column:
        top, bottom = FEATURES[self.feature]
        v = F.col(top).cast("double")
        if bottom:
            v = F.when(F.col(bottom) > 0, v / F.col(bottom)).otherwise(F.lit(0.0))
        return v > F.lit(self.threshold) if self.above else v <= F.lit(self.threshold)


Rule = tuple[Condition, ...]


def feature_values(counts: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    out = {}
    for name, (top, bottom) in FEATURES.items():
        v = counts[top].astype(float)
        if bottom:
            d = counts[bottom]
            v = np.where(d > 0, v / np.maximum(d, 1), 0.0)
        out[name] = v
    return out


def covered(rule: Rule, x: dict[str, np.ndarray], n: int) -> np.ndarray:
    out = np.ones(n, bool)
    for c in rule:
        out &= c.covers(x)
    return out


def _best_condition(x, y, inside) -> Condition | None:
    """The condition of largest gain: bad rows still covered times the rise
    in log precision."""
    bad, good = int((inside & y).sum()), int((inside & ~y).sum())
    before = np.log2(bad / (bad + good))
    best, found = 1e-9, None
    for name, v in x.items():
        cuts = np.unique(np.quantile(v[inside], np.linspace(0, 1, CUTS + 1), method="lower"))[:-1]
        if not len(cuts):
            continue
        vb, vg = np.sort(v[inside & y]), np.sort(v[inside & ~y])
        upto = [np.searchsorted(s, cuts, "right") for s in (vb, vg)]
        for above in (False, True):
            p, q = ((bad - upto[0], good - upto[1]) if above else upto)
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(p > 0, p * (np.log2(p / np.maximum(p + q, 1)) - before), 0.0)
            i = int(np.argmax(gain))
            if gain[i] > best:
                best, found = float(gain[i]), Condition(name, above, _between(v[inside], cuts[i]))
    return found


def _between(values: np.ndarray, cut: float) -> float:
    """Half way from ``cut`` to the next larger value."""
    return float((cut + values[values > cut].min()) / 2)


def learn(counts: dict[str, np.ndarray], bad: np.ndarray) -> list[Rule]:
    """Sequential covering; rows are taken in the order given."""
    x, n = feature_values(counts), len(bad)
    prune = np.arange(n) % 3 == 2
    left, rules = np.ones(n, bool), []
    while len(rules) < MAX_RULES:
        grow = left & ~prune
        if (grow & bad).sum() < MIN_COVERED:
            break
        inside, rule = grow.copy(), ()
        while len(rule) < MAX_CONDITIONS and (inside & ~bad).any():
            c = _best_condition(x, bad, inside)
            if c is None:
                break
            rule += (c,)
            inside &= c.covers(x)

        def worth(r: Rule) -> float:
            hit = covered(r, x, n) & left & prune
            b, g = int((hit & bad).sum()), int((hit & ~bad).sum())
            return (b - g) / (b + g) if b + g else -1.0

        while len(rule) > 1 and worth(rule[:-1]) >= worth(rule):
            rule = rule[:-1]
        hit = covered(rule, x, n) & left if rule else np.zeros(n, bool)
        held = hit & prune
        if (hit & bad).sum() < MIN_COVERED or (hit & bad).sum() < MIN_PRECISION * hit.sum() or (
                held & bad).sum() < MIN_PRECISION * held.sum():
            break
        rules.append(rule)
        left &= ~hit
    return rules


def labelled_sample(labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id",
                    label_col: str = "quality") -> DataFrame:
    """(doc_id, bad) of at most ``sample`` documents with an agreed label."""
    agreed = (labels.select(labels[id_col].cast("long").alias("doc_id"),
                            labels[label_col].alias("label"))
              .where("doc_id is not null and label is not null").groupBy("doc_id")
              .agg(F.min("label").alias("label"), F.max("label").alias("most"))
              .where("label = most"))
    return (agreed.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
            .select("doc_id", (F.col("label") == 0).alias("bad")))


def learn_from(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id",
               text_col: str = "text") -> list[Rule]:
    """The decision list learned from the labelled documents that pass the
    base rules.  The ids broadcast and the rows collected number ``sample``
    at most (repeated ids apart)."""
    chosen = labelled_sample(labels, sample)
    rows = id_and_text(docs, id_col, text_col).join(F.broadcast(chosen), "doc_id")
    taught = (statistics(rows).where(~base_failed()).join(F.broadcast(chosen), "doc_id")
              .orderBy(F.xxhash64("doc_id"), "doc_id", *COUNTS).limit(sample).toArrow())
    counts = {c: taught[c].to_numpy() for c in COUNTS}
    return learn(counts, taught["bad"].to_numpy().astype(bool))


def rule_number(rules: list[Rule]) -> Column:
    """The list as one ordered conditional: the number of the first rule
    that holds, 0 when none does."""
    out = None
    for i, rule in enumerate(rules, 1):
        cond = F.lit(True)
        for c in rule:
            cond = cond & c.column()
        out = (F.when if out is None else out.when)(cond, F.lit(i))
    return F.lit(0) if out is None else out.otherwise(F.lit(0))


def judge(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """One row per document: the base counts, ``base_failed``, ``kept`` and
    ``rule`` (the number of the learned rule that rejects it, else 0)."""
    rules = learn_from(docs, labels, sample, id_col, text_col)
    scored = statistics(docs, id_col, text_col).withColumn("base_failed", base_failed())
    scored = scored.withColumn("rule", rule_number(rules))
    return scored.select("doc_id", *BASE, "base_failed",
                         (~F.col("base_failed") & (F.col("rule") == 0)).alias("kept"), "rule")


def keep_good(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """``docs``, all columns, without the rows that are not ``kept``.  The
    statistics are computed beside the row's own columns, which pass through
    the same tasks: no shuffle, no join back."""
    rules = learn_from(docs, labels, sample, id_col, text_col)
    small_batches(docs.sparkSession)
    counts = F.struct(*[F.col(f"__counts.{c}").alias(c) for c in COUNTS])
    counts_of = F.pandas_udf(_count_column, ", ".join(f"{c} long" for c in COUNTS))
    rows = docs.withColumn("__counts", counts_of(F.coalesce(docs[text_col], F.lit(""))))
    bare = rows.select(F.struct(*docs.columns).alias("__row"), counts.alias("__c")).select("__row", "__c.*")
    return bare.where(~base_failed() & (rule_number(rules) == 0)).select("__row.*")
