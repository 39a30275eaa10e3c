"""Secret scan: fixed patterns and sliding-window Shannon entropy.

Base findings are the leftmost, non-overlapping matches of three patterns;
a match that fails its length test is consumed and dropped.  On top of them
come spans of high entropy.  For each character class the candidate strings
are the maximal runs of its characters, at least one window long.  A window
slides over the candidate one character at a time; its entropy is kept by
incremental counts (one character enters, one leaves, and only their two
terms of the sum change).  Windows at or above the class's threshold that
also hold the kinds of characters the class demands are merged into spans.
The allow list (placeholders, alphabets, UUIDs) is searched in the candidate;
a window that overlaps a match does not count, all others do.  Base findings
are never suppressed.

Every text is scanned whole.  Defined cases: a null text is empty and has no
findings (the digest is that of the empty string); null and repeated ids are
passed through row by row; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
import re
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import id_and_text, map_text

# The patterns of the base findings and their least lengths.
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
                    r"([A-Za-z0-9+/_.=-]+)", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_VALUE, ACCESS_LENGTH = 6, 20

WINDOW = 20


class CharacterClass(NamedTuple):
    """Runs of ``chars``; a window counts from ``bits`` of entropy on, if it
    holds a character of each pattern in ``needs``."""
    kind: str
    chars: str
    bits: float
    needs: tuple[str, ...]


CLASSES = (
    CharacterClass("entropy_hex", "0-9A-Fa-f", 3.0, ("[0-9]", "[A-Fa-f]")),
    CharacterClass("entropy_base64", "A-Za-z0-9+/_=-", 3.9, ("[0-9]", "[a-z]", "[A-Z]")),
    # letters of one case with digits; a letter beyond hex tells them from that class
    CharacterClass("entropy_base36", "0-9a-z", 3.5, ("[0-9]", "[g-z]")),
    CharacterClass("entropy_base32", "0-9A-Z", 3.4, ("[0-9]", "[G-Z]")),
)

ALLOW = (
    r"(?i)example|sample|dummy|placeholder|changeme|your[_-]?(key|token|secret)|redacted",
    r"(?i)0123456789|abcdefghij|qwertyuiop",
    r"(.)\1{7}",
    r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
)

KINDS = ("assign", "access", "hex", *(c.kind for c in CLASSES))

SCHEMA = ("doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, "
          "spans string, n_entropy long")
ARROW = pa.schema([("doc_id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()),
                   ("n_hex", pa.int64()), ("base_sha256", pa.string()), ("spans", pa.string()),
                   ("n_entropy", pa.int64())])


def base_findings(text: str) -> list[tuple[int, int, str]]:
    found = []
    if "=" in text or ":" in text:
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text)
                  if m.end(2) - m.start(2) >= ASSIGN_VALUE]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)
                  if m.end() - m.start() >= ACCESS_LENGTH]
    # a run's prefix rule plays no part here: runs are maximal, so asking for
    # 24 characters keeps the runs that are long enough
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return found


def allowed_windows(candidate: str, window: int, allow: list[re.Pattern]) -> bytearray | None:
    """Marks the starts of the windows that overlap a match of the allow
    list, overlapping matches included; None without a match."""
    marks = None
    for a in allow:
        m = a.search(candidate)
        while m:
            marks = marks or bytearray(len(candidate))
            first = max(m.start() - window + 1, 0)
            marks[first:m.end()] = b"\1" * (m.end() - first)
            m = a.search(candidate, m.start() + 1)
    return marks


def hot_windows(candidate: str, window: int, bits: float, needs: list[re.Pattern],
                allowed: bytearray | None = None):
    """Merged (start, end) of the windows with at least ``bits`` of entropy
    whose start is not marked in ``allowed``.

    With counts c of the window's characters, entropy is
    ``log2(w) - sum(c * log2 c) / w``."""
    term = [0.0] + [c * math.log2(c) for c in range(1, window + 2)]  # one enters before one leaves
    counts: dict[str, int] = {}
    total, spans = 0.0, []
    most = window * (math.log2(window) - bits) + 1e-9
    for i, c in enumerate(candidate):
        n = counts.get(c, 0)
        counts[c] = n + 1
        total += term[n + 1] - term[n]
        if i >= window:
            gone = candidate[i - window]
            n = counts[gone]
            counts[gone] = n - 1
            total += term[n - 1] - term[n]
        start = i - window + 1
        if start >= 0 and total <= most and not (allowed and allowed[start]) and all(
                p.search(candidate, start, i + 1) for p in needs):
            if spans and start <= spans[-1][1]:
                spans[-1][1] = i + 1
            else:
                spans.append([start, i + 1])
    return spans


class Scanner:
    def __init__(self, classes=CLASSES, allow=ALLOW, window: int = WINDOW):
        self.window = window
        self.classes = [(c, re.compile(f"[{c.chars}]{{{window},}}"), [re.compile(n) for n in c.needs])
                        for c in classes]
        self.allow = [re.compile(a) for a in allow]

    def entropy_findings(self, text: str) -> list[tuple[int, int, str]]:
        found = []
        for c, runs, needs in self.classes:
            for m in runs.finditer(text):
                candidate = m.group()
                if not all(p.search(candidate) for p in needs):
                    continue
                spans = hot_windows(candidate, self.window, c.bits, needs)
                allowed = allowed_windows(candidate, self.window, self.allow) if spans else None
                if allowed:
                    spans = hot_windows(candidate, self.window, c.bits, needs, allowed)
                if spans:
                    found += [(m.start() + a, m.start() + b, c.kind) for a, b in spans]
        return found


def joined(found: list[tuple[int, int, str]]) -> str:
    """``kind:start:end`` by start, then kind in the order of ``KINDS``."""
    return ",".join(f"{k}:{a}:{b}" for a, b, k in sorted(
        found, key=lambda f: (f[0], KINDS.index(f[2]), f[1])))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
         allow: tuple[str, ...] = ALLOW) -> DataFrame:
    """One row per document: numbers of base findings per kind, the digest
    of the base spans, and all spans (code points, end exclusive)."""
    def findings(ids, texts):
        scanner = Scanner(allow=allow, window=window)
        out = {f.name: [] for f in ARROW}
        out["doc_id"] = ids
        for t in texts:
            base, more = base_findings(t), scanner.entropy_findings(t)
            kinds = [k for _, _, k in base]
            for k in ("assign", "access", "hex"):
                out[f"n_{k}"].append(kinds.count(k))
            out["base_sha256"].append(hashlib.sha256(joined(base).encode()).hexdigest())
            out["spans"].append(joined(base + more))
            out["n_entropy"].append(len(more))
        return out

    return map_text(id_and_text(docs, id_col, text_col), findings, SCHEMA, ARROW)
