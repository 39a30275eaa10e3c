"""Packing by Karmarkar-Karp multiway differencing.

Each task tokenises its documents and packs them as they come, in groups of
about ``group_tokens`` tokens, so memory does not depend on the input.  Of a
document every full window is cut off as a sequence of its own; the remainder
is cut into pieces of at most ``PIECE`` tokens, and a group's pieces are the
items to divide.  What a task holds last, less than a group, is written with
its ids; a second pass packs these rests of many tasks in groups again, so
padding does not depend on how the input is dealt to tasks.

Differencing keeps a heap of partial partitions, each of ``k`` windows and
first holding one item.  The two with the largest imbalance are merged, the
fullest window of one onto the emptiest of the other, until one partition is
left.  ``k`` starts at the least count that could hold the group and rises
whenever the fullest window exceeds the capacity.  Pieces are small against a
window, so windows come out nearly equal and ``k`` rises by a few at most.
Pieces of a remainder that meet in one window and follow each other are one
piece of the result.

A text is tokenised by its distinct space-delimited words: the vocabulary
drops white space and never merges across it, so the ids are those of the
whole text, and each distinct word is encoded once per task.

Defined cases: a null text is empty and is the end token alone; a null or
repeated id is packed like any other; an empty table gives no rows; a text
of any length is cut into as many windows as it needs.
"""

from __future__ import annotations

import heapq
import os
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import hand_back, id_and_text, slices, small_batches

CAPACITY = 4096
END_ID = 2
GROUP_TOKENS = 1_000_000
#: Largest piece of a remainder; and groups that a task of the second pass gets, about.
PIECE, REST_GROUPS = 512, 2
#: Distinct words (and their characters) above which a task forgets rare ones,
#: words that a worker keeps between tasks, and uses that make a word common.
MEMO_WORDS, MEMO_CHARS, IDLE_WORDS, COMMON = 600_000, 8_000_000, 200_000, 3

SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")
ARROW = pa.schema([(c, pa.int64()) for c in (
    "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")])


#: A word whose token boundaries are known: letters, at times one of these behind.
TAIL = ".,;:!?"


class _Codes(dict):
    """Word -> code; a word not met before gets the next code and is noted."""

    def __init__(self, words=()):
        super().__init__({"": 0})
        self.new = []
        self.update(zip(words, range(1, len(words) + 1)))

    def __missing__(self, word):
        self.new.append(word)
        code = self[word] = len(self)
        return code


class WordEncoder:
    """Token ids of texts through a table of the words met so far."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(path)
        # the same merges for words that need no normalising and no pattern
        self.plain = Tokenizer.from_file(path)
        self.plain.normalizer = normalizers.Sequence([])
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocab = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(vocab.values()) + 1, bool)
        self.closes[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.tails = dict(zip(TAIL, self._ids(list(TAIL))))
        self.clear()

    def clear(self):
        self.codes, self.chars = _Codes(), 0
        self.flat = np.empty(1 << 16, np.int32)
        self.ends = np.zeros(1, np.int64)
        self.seen = np.zeros(1, np.int64)

    def forget(self, words: int, chars: int = 0):
        """Above ``words`` words or ``chars`` characters keep the common ones
        only (none if those are too many)."""
        if len(self.codes) <= words and (not chars or self.chars <= chars):
            return
        common = self.seen >= COMMON
        common[0] = False
        kept = [w for w, k in zip(self.codes, common.tolist()) if k]
        if len(kept) > words // 2 or (chars and sum(map(len, kept)) > chars // 2):
            return self.clear()
        codes = np.flatnonzero(common)
        ends = self.ends[codes]
        sizes = ends - self.ends[codes - 1]
        stop = np.cumsum(sizes)
        total = int(stop[-1]) if len(stop) else 0
        self.flat = self.flat[np.repeat(ends - stop, sizes) + np.arange(total)]
        self.ends = np.concatenate([[0], stop]).astype(np.int64)
        self.codes, self.chars = _Codes(kept), sum(map(len, kept))
        self.seen = np.where(np.arange(len(kept) + 1) > 0, 1, 0)

    def _ids(self, words: list[str]) -> list[list[int]]:
        got = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return [e.ids for e in got]

    def _letters(self, words: list[str]) -> dict[str, list[int]]:
        """Ids of words made of letters alone: one run of the vocabulary's
        pattern each, so they are encoded together and end where a token
        closes a run."""
        out = {}
        for i in range(0, len(words), 1000):
            part = words[i:i + 1000]
            text = " ".join(part)
            tokenizer = self.plain if text.islower() and _latin(text) else self.tokenizer
            ids = tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids
            cuts = (np.flatnonzero(self.closes[ids]) + 1).tolist()
            if len(cuts) != len(part):  # some letter is no letter to the vocabulary
                out.update(zip(part, self._ids(part)))
                continue
            start = 0
            for w, stop in zip(part, cuts):
                out[w] = ids[start:stop]
                start = stop
        return out

    def _learn(self):
        """Enter the ids of the words noted as new, in the order of their codes."""
        words, self.codes.new = self.codes.new, []
        if not words:
            return
        self.chars += sum(map(len, words))
        old, ends, flat = len(self.ends) - 1, self.ends, self.flat
        cores, wanted, odd = [], {}, []
        for w in words:
            core = w if w.isalpha() else w[:-1] if w[-1] in TAIL and w[:-1].isalpha() else ""
            cores.append(core)
            if not core:
                odd.append(w)
            elif core not in wanted:
                code = self.codes.get(core, old + 1)  # with a mark behind it: known without one?
                wanted[core] = flat[ends[code - 1]:ends[code]].tolist() if code <= old else None
        wanted.update(self._letters([c for c, ids in wanted.items() if ids is None]))
        whole = dict(zip(odd, self._ids(odd)))
        got = [whole[w] if not c else wanted[c] if len(c) == len(w) else wanted[c] + self.tails[w[-1]]
               for w, c in zip(words, cores)]
        ends = self.ends[-1] + np.cumsum([len(x) for x in got])
        if ends[-1] > len(self.flat):
            self.flat = np.resize(self.flat, max(int(ends[-1]), len(self.flat) * 3 // 2, 1 << 16))
        self.flat[self.ends[-1]:ends[-1]] = [i for x in got for i in x]
        self.ends = np.concatenate([self.ends, ends])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Per text its ids; each array ends with room for one more id."""
        self.forget(MEMO_WORDS, MEMO_CHARS)
        get, coded = self.codes.__getitem__, []
        for t in texts:
            ws = _lower(t).replace("\n", " ").split(" ")
            coded.append(np.fromiter(map(get, ws), np.int64, len(ws)))
        self._learn()
        seen = np.bincount(np.concatenate(coded), minlength=len(self.codes)) if coded else self.seen.copy()
        seen[:len(self.seen)] += self.seen
        self.seen = seen
        out = []
        for c in coded:
            c = c[c > 0]
            ends = self.ends[c]
            sizes = ends - self.ends[c - 1]
            stop = np.cumsum(sizes)
            total = int(stop[-1]) if len(stop) else 0
            ids = np.empty(total + 1, "<u4")
            ids[:total] = self.flat[np.repeat(ends - stop, sizes) + np.arange(total)]
            out.append(ids)
        return out


def _lower(text: str) -> str:
    """Lower case where the vocabulary's own lower-casing surely does the
    same (Latin letters, no special token's string); fewer distinct words."""
    return text.lower() if _latin(text) and "<|" not in text else text


def _latin(text: str) -> bool:
    if not text.isascii():
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return False
    return True


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One per worker process and vocabulary; its table is bounded."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def difference(sizes: np.ndarray, k: int) -> list[list[int]]:
    """Item numbers per window after multiway differencing into ``k`` windows."""
    n = len(sizes)
    heap = []
    # The largest item's imbalance is its size, and stays so while it gathers
    # the next ones in windows of their own.  As long as the items are no
    # smaller than the imbalance of what is gathered, k at a time become one
    # partition, without a merge for each.
    order, at, turn, most = np.argsort(-sizes, kind="stable"), 0, n, 0
    while at + k <= n and sizes[order[at + k - 1]] >= most:
        block = order[at:at + k]
        gap = int(sizes[block[0]] - sizes[block[-1]])
        heap.append((-gap, turn, sizes[block], block))
        at, turn, most = at + k, turn + 1, max(most, gap)
    for i in order[at:]:
        heap.append((-int(sizes[i]), int(i), sizes[i:i + 1], np.array([i])))  # windows in use, fullest first
    heapq.heapify(heap)
    first, second = np.full(n + len(heap) * k, -1), np.full(n + len(heap) * k, -1)  # joined window contents
    used = n
    while len(heap) > 1:
        _, _, a, an = heapq.heappop(heap)
        _, _, b, bn = heapq.heappop(heap)
        # b's windows from the emptiest on go onto a's empty windows and then,
        # when those are used up, onto a's emptiest: m of them are joined
        m = max(0, len(a) + len(b) - k)
        total, node = a.copy(), an.copy()
        if m:
            onto, lay = slice(k - len(b), None), slice(len(b) - m, None)
            total[onto] += b[lay][::-1]
            new = np.arange(used, used + m)
            first[new], second[new] = an[onto], bn[lay][::-1]
            node[onto] = new
            used += m
        total = np.concatenate([total, b[:len(b) - m]])
        node = np.concatenate([node, bn[:len(b) - m]])
        order = np.argsort(-total, kind="stable")
        total, node = total[order], node[order]
        least = int(total[-1]) if len(total) == k else 0
        heapq.heappush(heap, (least - int(total[0]), turn, total, node))
        turn += 1
    windows = []
    for root in heap[0][3] if heap else ():
        todo, items = [int(root)], []
        while todo:
            x = todo.pop()
            if x < n:
                items.append(x)
            else:
                todo += [int(first[x]), int(second[x])]
        windows.append(items)
    return windows


def fill_windows(sizes: list[int], capacity: int = CAPACITY,
                 piece: int = PIECE) -> list[list[tuple[int, int, int]]]:
    """Windows of (item, start, length) that hold every item's tokens once."""
    cuts = [(i, start, min(piece, int(size) - start)) for i, size in enumerate(sizes)
            for start in range(0, int(size), piece)]
    if not cuts:
        return []
    lengths = np.array([c[2] for c in cuts], np.int64)
    k = -(-int(lengths.sum()) // capacity)
    while True:
        windows = difference(lengths, k)
        if max(int(lengths[w].sum()) for w in windows) <= capacity:
            break
        k += 1
    out = []
    for w in windows:
        pieces = []
        for i, start, length in sorted(cuts[c] for c in w):
            if pieces and pieces[-1][0] == i and sum(pieces[-1][1:]) == start:
                pieces[-1] = (i, pieces[-1][1], pieces[-1][2] + length)
            else:
                pieces.append((i, start, length))
        out.append(pieces)
    return out


class _Packer:
    """Sequences of one task, numbered from ``first``.  A document is its id,
    its number of tokens, and ids from the position ``at`` on."""

    def __init__(self, first: int, capacity: int):
        self.sequence, self.capacity = first, capacity
        self.group, self.held = [], 0

    def add(self, doc_id, tokens: int, at: int, ids: np.ndarray):
        self.group.append((doc_id, tokens, at, ids))
        self.held += len(ids)

    def row(self, doc, start: int, length: int, offset: int) -> tuple:
        doc_id, tokens, at, ids = doc
        return (doc_id, at + start, length, zlib.crc32(ids[start:start + length].tobytes()), tokens,
                self.sequence, offset)

    def alone(self, doc_id, tokens: int, at: int, ids: np.ndarray) -> tuple:
        """A full window."""
        out = self.row((doc_id, tokens, at, ids), 0, len(ids), 0)
        self.sequence += 1
        return out

    def close(self) -> list[tuple]:
        rows = []
        for window in fill_windows([len(d[3]) for d in self.group], self.capacity):
            offset = 0
            for i, start, length in window:
                rows.append(self.row(self.group[i], start, length, offset))
                offset += length
            self.sequence += 1
        self.group, self.held = [], 0
        return rows


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID,
         group_tokens: int = GROUP_TOKENS, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """One row per piece: ``doc_id``, ``start`` (its document's ids before
    it), ``length``, ``ids_crc32`` (of its ids as little-endian unsigned
    32-bit), ``doc_tokens`` (with the end token), ``sequence_id`` and
    ``offset`` within the sequence.  A sequence id is made of the pass, the
    partition and a running number, so a task that runs again gives the same."""
    small_batches(docs.sparkSession)
    with_rest = ARROW.append(pa.field("rest", pa.binary()))

    def run(batches):
        from pyspark import TaskContext
        words = encoder(tokenizer_path)
        packer = _Packer(TaskContext.get().partitionId() << 33, capacity)
        for b in slices(batches):
            rows = []
            for doc_id, ids in zip(b.column(0).to_pylist(), words.encode(b.column(1).to_pylist())):
                ids[-1] = end_id
                full = len(ids) // capacity * capacity
                rows += [packer.alone(doc_id, len(ids), start, ids[start:start + capacity])
                         for start in range(0, full, capacity)]
                if full < len(ids):
                    packer.add(doc_id, len(ids), full, ids[full:])
                if packer.held >= group_tokens:
                    rows += packer.close()
            if rows:
                yield _batch([(*r, None) for r in rows], with_rest)
        words.forget(IDLE_WORDS)
        hand_back()
        if packer.group:
            yield _batch([(doc_id, at, len(ids), None, tokens, None, None, ids.tobytes())
                          for doc_id, tokens, at, ids in packer.group], with_rest)

    def run_rests(batches):
        from pyspark import TaskContext
        packer = _Packer((1 << 62) + (TaskContext.get().partitionId() << 33), capacity)
        for b in batches:
            for doc_id, tokens, at, rest in zip(*(c.to_pylist() for c in b.columns)):
                packer.add(doc_id, tokens, at, np.frombuffer(rest, "<u4"))
                if packer.held >= group_tokens:
                    yield _batch(packer.close(), ARROW)
        if packer.group:
            yield _batch(packer.close(), ARROW)

    first = cut_lineage(id_and_text(docs, id_col, text_col).mapInArrow(run, SCHEMA + ", rest binary"), "packed")
    rests = first.where("rest is not null")
    left = rests.agg(F.sum("length")).first()[0] or 0
    tasks = max(1, left // (REST_GROUPS * group_tokens))
    again = rests.select("doc_id", "doc_tokens", "start", "rest").repartition(tasks).mapInArrow(run_rests, SCHEMA)
    return first.where("rest is null").drop("rest").unionByName(again)
