"""Benchmark decontamination with a word-level FM-index per training shard.

A task gathers documents into shards.  Words are numbered by the benchmark's
vocabulary; a word outside it can be in no occurrence, so a shard's index
holds the runs of known words that are long enough for a window, parted by
a number of its own.  The shard's suffix array gives the Burrows-Wheeler transform, which a
wavelet tree (one bit plane a level, with rank counts) answers rank queries
on.  All test windows are searched backwards at once; found suffix-array
intervals are located by walking to the next sampled suffix position.
Occurrences become word spans of their documents and are merged.
Documents stay whole within a task, so nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duelframe.llm.common import ALNUM, LOWER, SpanHash, core, ddl, join_on, merge_spans, row_key, slices, word_spans

WINDOW = 13
SHARD_WORDS = 1 << 19          # a shard ends at so many indexed words, documents, or bytes of text
SHARD_DOCS, SHARD_BYTES = 1 << 14, 1 << 25
BLOCK_WORDS = 1 << 20          # benchmark words sent to the tasks at once; more go in further blocks
SAMPLE = 16                    # every 16th text position keeps its suffix-array entry


# -- FM-index ---------------------------------------------------------------

def suffix_array(seq: np.ndarray) -> np.ndarray:
    """Suffix array of small non-negative numbers by prefix doubling."""
    n = len(seq)
    _, rank = np.unique(seq, return_inverse=True)
    rank = rank.astype(np.int64)
    h = 1
    while True:
        second = np.zeros(n, np.int64)
        second[:max(n - h, 0)] = rank[h:] + 1
        key = rank * (n + 1) + second
        sa = np.argsort(key, kind="stable")
        ks = key[sa]
        new = np.concatenate(([0], np.cumsum(ks[1:] != ks[:-1])))
        rank = np.empty(n, np.int64)
        rank[sa] = new
        if n == 0 or new[-1] == n - 1:
            return sa
        h *= 2


class Bits:
    """A bit vector with rank counts every 64 bits."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros(len(bits) // 64 + 1, np.uint64)
        self.words.view(np.uint8)[:len(packed)] = packed
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)))

    def rank1(self, i: np.ndarray) -> np.ndarray:
        """Ones among the first ``i`` bits."""
        w, b = i >> 6, (i & 63).astype(np.uint64)
        part = self.words[w] & ((np.uint64(1) << b) - np.uint64(1))
        return self.before[w] + np.bitwise_count(part)


class Wavelet:
    """Wavelet tree over numbers below ``2**levels``, a stable bit plane for each level."""

    def __init__(self, seq: np.ndarray, levels: int):
        self.levels, self.planes, self.zeros = levels, [], []
        for k in range(levels - 1, -1, -1):
            bit = (seq >> k & 1).astype(np.uint8)
            self.planes.append(Bits(bit))
            self.zeros.append(int(len(seq) - bit.sum()))
            seq = np.concatenate((seq[bit == 0], seq[bit == 1]))

    def rank(self, sym: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often ``sym`` is among the first ``i`` numbers (both arrays)."""
        lo, hi = np.zeros_like(i), i
        for level, (plane, zeros) in enumerate(zip(self.planes, self.zeros)):
            one = (sym >> (self.levels - 1 - level) & 1).astype(bool)
            a, b = plane.rank1(lo), plane.rank1(hi)
            lo, hi = np.where(one, zeros + a, lo - a), np.where(one, zeros + b, hi - b)
        return hi - lo

    def access(self, i: np.ndarray) -> np.ndarray:
        """The numbers at positions ``i``."""
        out = np.zeros(len(i), np.int64)
        for plane, zeros in zip(self.planes, self.zeros):
            one = plane.rank1(i + 1) - plane.rank1(i)
            r = plane.rank1(i)
            out = out * 2 + one
            i = np.where(one == 1, zeros + r, i - r)
        return out


class FMIndex:
    """Count and locate number sequences in a text of numbers from 1 (which parts its pieces) to ``top``."""

    def __init__(self, text: np.ndarray, top: int):
        text = np.append(text, 0)                      # the only 0, so backward steps are one to one
        sa = suffix_array(text)
        bwt = text[sa - 1]
        self.tree = Wavelet(bwt, max(1, int(top).bit_length()))
        counts = np.bincount(text, minlength=top + 2)
        self.first = np.concatenate(([0], np.cumsum(counts)))
        marked = sa % SAMPLE == 0
        self.marks, self.kept, self.n = Bits(marked.astype(np.uint8)), sa[marked], len(text)

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix-array intervals [lo, hi) of the rows of ``patterns`` (equal lengths), last word first."""
        lo = np.zeros(len(patterns), np.int64)
        hi = np.full(len(patterns), self.n, np.int64)
        live = np.arange(len(patterns))
        for j in range(patterns.shape[1] - 1, -1, -1):
            sym = patterns[live, j]
            lo[live] = self.first[sym] + self.tree.rank(sym, lo[live])
            hi[live] = self.first[sym] + self.tree.rank(sym, hi[live])
            live = live[lo[live] < hi[live]]
            if len(live) == 0:
                break
        hi = np.maximum(lo, hi)
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix-array rows: step backwards to a sampled position."""
        rows, steps = rows.copy(), np.zeros(len(rows), np.int64)
        open_ = np.arange(len(rows))
        while len(open_):
            r = rows[open_]
            kept = self.marks.rank1(r + 1) > self.marks.rank1(r)
            open_ = open_[~kept]
            if len(open_) == 0:
                break
            sym = self.tree.access(rows[open_])
            rows[open_] = self.first[sym] + self.tree.rank(sym, rows[open_])
            steps[open_] += 1
        return self.kept[self.marks.rank1(rows)] + steps


# -- the benchmark's windows --------------------------------------------------

def words_of(text: str | None) -> list[bytes]:
    raw = np.frombuffer((text or "").encode(), np.uint8)
    low = LOWER[raw]
    s, e = word_spans(low, np.array([0, len(low)]), ALNUM)
    b = low.tobytes()
    return [b[i:j] for i, j in zip(s.tolist(), e.tolist())]


def _nulls_last(name: str | None) -> tuple[bool, str]:
    return name is None, name or ""


@dataclass
class TestSet:
    """Vocabulary (sorted hashes, ids from 2) and distinct windows by length, with the items that hold them."""

    hashes: np.ndarray
    ids: np.ndarray
    windows: dict[int, np.ndarray]
    holders: dict[int, list[np.ndarray]]
    names: list[str | None]
    shortest: int

    @staticmethod
    def build(items: list[tuple[str | None, str | None]], window: int) -> "TestSet":
        vocab: dict[bytes, int] = {}
        found: dict[int, dict[tuple, set[int]]] = {}
        names = sorted({i for i, _ in items}, key=_nulls_last)
        number = {x: k for k, x in enumerate(names)}
        for item, text in items:
            seq = [vocab.setdefault(w, len(vocab) + 2) for w in words_of(text)]
            n = min(window, len(seq))
            for k in range(len(seq) - n + 1 if seq else 0):
                found.setdefault(n, {}).setdefault(tuple(seq[k:k + n]), set()).add(number[item])
        joined = np.frombuffer(b"".join(vocab), np.uint8)
        ends = np.cumsum([len(w) for w in vocab]) if vocab else np.zeros(0, np.int64)
        starts = np.concatenate(([0], ends[:-1])) if vocab else np.zeros(0, np.int64)
        h = SpanHash(joined).of(starts, ends)
        o = np.argsort(h)
        return TestSet(h[o], np.arange(2, len(vocab) + 2)[o],
                       {n: np.array(list(d), np.int64) for n, d in found.items()},
                       {n: [np.array(sorted(x)) for x in d.values()] for n, d in found.items()},
                       names, min(found, default=0))

    def numbers(self, h: np.ndarray) -> np.ndarray:
        """Vocabulary id of each word hash, 0 where unknown."""
        if len(self.hashes) == 0:
            return np.zeros(len(h), np.int64)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return np.where(self.hashes[at] == h, self.ids[at], 0)


# -- a shard ------------------------------------------------------------------

class Shard:
    """Documents of one index: their word counts and the runs of known words."""

    def __init__(self, tests: TestSet):
        self.tests, self.rows, self.n_words = tests, [], []
        self.text, self.place, self.size, self.docs, self.bytes = [], [], 0, 0, 0

    @property
    def full(self) -> bool:
        return self.size >= SHARD_WORDS or self.docs >= SHARD_DOCS or self.bytes >= SHARD_BYTES

    def add(self, kept: pa.RecordBatch, data: np.ndarray, off: np.ndarray) -> None:
        """Take documents in; ``kept`` has the columns that are returned with them."""
        low = LOWER[data]
        s, e = word_spans(low, off, ALNUM)
        first = np.searchsorted(s, off)                       # first word of each document
        self.rows.append(kept)
        self.bytes += len(data)
        self.n_words.append(np.diff(first))
        num = self.tests.numbers(SpanHash(low).of(s, e))
        m = len(num)
        doc_edge = np.zeros(m + 1, bool)
        doc_edge[first] = True
        known = num > 0
        begin, end = known.copy(), known.copy()
        begin[1:] &= ~known[:-1] | doc_edge[1:-1]
        end[:-1] &= ~known[1:] | doc_edge[1:-1]
        b, f = np.flatnonzero(begin), np.flatnonzero(end) + 1
        long = f - b >= max(self.tests.shortest, 1)
        b, f = b[long], f[long]
        doc = np.searchsorted(first, b, "right") - 1
        lens = f - b + 1                                        # with a separator after each run
        total = int(lens.sum())
        if total:
            at = np.concatenate(([0], np.cumsum(lens)[:-1]))
            pos = np.arange(total) - np.repeat(at, lens) + np.repeat(b, lens)
            last = at + lens - 1
            seq = num[np.minimum(pos, m - 1)]
            seq[last] = 1
            self.text.append(seq)
            self.place.append(np.stack((np.full(len(b), 0) + at + self.size, doc + self.docs, b - first[doc])))
        self.size += total
        self.docs += len(off) - 1

    def spans(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(document, first word, end word, window length, window) of every occurrence of a window, from the index."""
        none = np.zeros(0, np.int64)
        if not self.size:
            return none, none, none, none, none
        index = FMIndex(np.concatenate(self.text), len(self.tests.hashes) + 1)
        run_at, run_doc, run_word = np.concatenate(self.place, axis=1)
        out = []
        for n, patterns in self.tests.windows.items():
            lo, hi = index.search(patterns)
            hit = np.flatnonzero(hi > lo)
            if len(hit) == 0:
                continue
            times = (hi - lo)[hit]
            which = np.repeat(hit, times)
            rows = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + np.repeat(lo[hit], times)
            pos = index.locate(rows)
            run = np.searchsorted(run_at, pos, "right") - 1
            word = run_word[run] + pos - run_at[run]
            out.append(np.stack([run_doc[run], word, word + n, np.full(len(which), n), which]))
        return tuple(np.concatenate(out, axis=1)) if out else (none, none, none, none, none)

    def result(self) -> pa.RecordBatch:
        """One row per document: merged word spans and the items found.

        A window's items are looked up once a document, however often it occurs there."""
        doc, start, end, length, window = self.spans()
        n_words = np.concatenate(self.n_words)
        starts, ends, names = [[] for _ in n_words], [[] for _ in n_words], [[] for _ in n_words]
        o = np.argsort(doc, kind="stable")
        doc, start, end, length, window = doc[o], start[o], end[o], length[o], window[o]
        cut = np.flatnonzero(np.diff(doc)) + 1
        for k in np.split(np.arange(len(doc)), cut) if len(doc) else []:
            d = doc[k[0]]
            s, e = merge_spans(start[k], end[k])
            starts[d], ends[d] = s.tolist(), e.tolist()
            seen = np.unique(np.stack([length[k], window[k]]), axis=1).T.tolist()
            names[d] = [self.tests.names[i] for i in np.unique(np.concatenate([self.tests.holders[n][w] for n, w in seen]))]
        kept = pa.Table.from_batches(self.rows).combine_chunks().to_batches()[0]
        longs = pa.list_(pa.int64())
        return pa.RecordBatch.from_arrays(
            [*kept.columns, pa.array(n_words, pa.int64()), pa.array(starts, longs), pa.array(ends, longs),
             pa.array(names, pa.list_(pa.string()))], [*kept.schema.names, "n_words", "span_starts", "span_ends", "items"])


def _scan(docs: DataFrame, items: list[tuple[str | None, str | None]], text_col: str, kept: list[str], window: int) -> DataFrame:
    tests = docs.sparkSession.sparkContext.broadcast(TestSet.build(items, window))

    def run(batches: Iterator[pa.RecordBatch]):
        shard = Shard(tests.value)
        for part, data, off in slices(batches, text_col):
            shard.add(part.select(kept), data, off)
            if shard.full:
                yield shard.result()
                shard = Shard(tests.value)
        if shard.docs:
            yield shard.result()

    return docs.mapInArrow(run, ddl(docs, kept) + ", n_words long, span_starts array<long>, span_ends array<long>, items array<string>")


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text", window: int = WINDOW,
                  block_words: int = BLOCK_WORDS, carry: tuple[str, ...] = ()) -> DataFrame:
    """Per document: id, the ``carry`` columns, n_words, merged word spans (span_starts, span_ends) and sorted items found.

    A test window is ``window`` consecutive words of an item, or the whole of
    a shorter one; words are runs of ASCII letters, digits and non-ASCII
    characters, A-Z lower-cased.  A null or empty text has no words, no spans
    and no items; an item without words is never found; an empty benchmark
    finds nothing; items with equal ids count as one; items whose id is null
    are searched too and count together as one item, a null at the end of
    ``items`` (a digest of ids leaves it out); repeated document rows are each
    returned; other columns are ignored.

    The benchmark is split by its measured size into blocks that fit a task's
    memory; each block is one pass over the documents, and the passes' spans
    are merged per document row.
    """
    kept = list(dict.fromkeys((id_col, *carry)))
    src, bench = core(docs, *dict.fromkeys((*kept, text_col))), core(benchmark, item_col, item_text)
    bench = bench.withColumn("_n", F.ceil(F.coalesce(F.length(item_text), F.lit(0)) / 4) + 1)
    total = bench.agg(F.sum("_n")).first()[0] or 0
    n_blocks = max(1, -(-int(total) // block_words))

    def items(k: int) -> list[tuple[str | None, str | None]]:
        own = bench if n_blocks == 1 else bench.where(F.pmod(F.xxhash64(item_col), F.lit(n_blocks)) == k)
        return [tuple(r) for r in own.select(F.col(item_col).cast("string"), item_text).collect()]

    if n_blocks == 1:
        return _scan(src, items(0), text_col, kept, window)
    # further blocks: rows with spans meet by their document row's key
    keyed = src.withColumn("_row", F.struct(F.col(id_col).alias("id"), row_key(F.col(text_col)).alias("t")))
    parts = None
    for k in range(n_blocks):
        one = _scan(keyed.select("_row", text_col), items(k), text_col, ["_row"], window).where(F.size("items") > 0)
        one = one.dropDuplicates(["_row"])
        parts = one if parts is None else parts.unionByName(one)

    def unite(pdf: pd.DataFrame) -> pd.DataFrame:
        s, e = merge_spans(np.concatenate(pdf.span_starts.tolist()), np.concatenate(pdf.span_ends.tolist()))
        return pd.DataFrame({"_row": [pdf["_row"].iloc[0]], "span_starts": [s], "span_ends": [e],
                             "items": [sorted(set().union(*map(set, pdf["items"])), key=_nulls_last)]})

    kind = keyed.schema["_row"].dataType.simpleString()
    merged = parts.groupBy("_row").applyInPandas(
        unite, f"_row {kind}, span_starts array<long>, span_ends array<long>, items array<string>")
    every = _scan(keyed, [], text_col, [*kept, "_row"], window).select(*kept, "_row", "n_words")
    out = join_on(every, merged, ["_row"], "left")
    none, no_item = F.array().cast("array<long>"), F.array().cast("array<string>")
    return out.select(*kept, "n_words", F.coalesce("span_starts", none).alias("span_starts"),
                      F.coalesce("span_ends", none).alias("span_ends"), F.coalesce("items", no_item).alias("items"))


def digest(found: DataFrame) -> DataFrame:
    """``contamination``'s rows with n_hit, n_items, items_sha256 and contaminated in place of spans and items."""
    hit = F.aggregate(F.zip_with("span_ends", "span_starts", lambda e, s: e - s), F.lit(0).cast("long"), lambda a, x: a + x)
    out = found.withColumn("n_hit", hit)
    return out.select(
        *[c for c in found.columns if c not in ("n_words", "span_starts", "span_ends", "items")], "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"))
