"""Repeated-substring removal with per-shard suffix arrays.

Every string of ``length`` bytes is assigned to an anchor, the leftmost gram
in it with the smallest hash.  Equal strings have equal anchors at equal
offsets, so strings starting at neighbouring places with one anchor make a
segment, and only segments with the same anchor gram can hold equal strings.

1. Each document's segments are written as (anchor hash, segment hash, place).
2. A segment that occurs twice is repeated from its first start to its last.
   Anchors whose segments all agree are settled by that alone.
3. The distinct segments of the other anchors are fetched and dealt to
   shards by anchor; an anchor with more bytes than a shard is split over
   several.  A shard sets pieces aside that can match no other, sorts
   the others' suffixes by Larsson-Sadakane refinement and takes common prefixes of neighbours by Kasai's method; a start whose
   common prefix reaches ``length`` is repeated.
4. Shards of a split anchor are merged: the sorted digests of their distinct
   strings are cut by ranges and each shard's run is searched by bisection
   in the others' runs.
5. Repeated starts are carried back to all places of their segments, merged
   to spans, and cut out of the texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duelframe.llm.common import SpanHash, core, join_on, merge_spans, mix, save, slices

LENGTH = 400
GRAM = 32
STEP = 64                      # offsets of a piece
SHARD_BYTES = 1 << 20


# -- segments -----------------------------------------------------------------

def segments(data: np.ndarray, off: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(text number, first start, number of starts, anchor hash, segment hash) of every segment."""
    none = tuple(np.zeros(0, np.uint64 if k > 2 else np.int64) for k in range(5))
    if len(data) < length:
        return none
    h = SpanHash(data)
    g = h.grams(gram)
    w = length - gram + 1
    key = (g >> np.uint64(32) << np.uint64(32)) | np.arange(len(g), dtype=np.uint64)
    pad = -len(key) % w                                        # sliding minimum: block prefix and suffix minima
    blocks = np.concatenate((key, np.full(pad, np.iinfo(np.uint64).max))).reshape(-1, w)
    pre = np.minimum.accumulate(blocks, axis=1).ravel()
    suf = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(key) - w + 1
    anchor = (np.minimum(suf[:n], pre[w - 1:w - 1 + n]) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    starts = np.maximum(np.diff(off) - length + 1, 0)          # per text
    valid = np.flatnonzero(starts)
    if len(valid) == 0:
        return none
    at = np.concatenate([np.arange(a, a + c) for a, c in zip(off[valid].tolist(), starts[valid].tolist())])
    doc = np.repeat(valid, starts[valid])
    a = anchor[at]
    new = np.ones(len(at), bool)
    new[1:] = (a[1:] != a[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(at)))
    s = at[first]
    return doc[first], s - off[doc[first]], count, g[a[first]], h.of(s, s + count + length - 1)


def places(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """(id, key, anchor, seg, start, n) of every segment of the documents (id, key, text)."""
    def run(batches: Iterator[pa.RecordBatch]):
        for part, data, off in slices(batches):
            doc, start, n, anchor, seg = segments(data, off, length, gram)
            take = pa.array(doc)
            yield pa.RecordBatch.from_arrays(
                [part.column("id").take(take), part.column("key").take(take), pa.array(anchor.view(np.int64)),
                 pa.array(seg.view(np.int64)), pa.array(start.astype(np.int64)), pa.array(n.astype(np.int32))],
                ["id", "key", "anchor", "seg", "start", "n"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"id {kind}, key long, anchor long, seg long, start long, n int")


# -- a shard ---------------------------------------------------------------------

def sort_suffixes(text: np.ndarray, depth: int) -> np.ndarray:
    """Ranks of all suffixes by their first ``depth`` (or more) numbers, by Larsson-Sadakane refinement.

    Suffixes are first sorted by 6 numbers (below 2**10) at once.  Then, with
    doubled depth each round, only groups that still hold several suffixes
    are sorted, by the rank of the suffix that lies the sorted depth further.
    Suffixes that stay equal share a rank.
    """
    n = len(text)
    padded = np.concatenate((text.astype(np.int64), np.zeros(6, np.int64)))
    key = np.zeros(n, np.int64)
    for k in range(6):
        key = key << 10 | padded[k:n + k]
    sa = np.argsort(key)
    ks = key[sa]
    head = np.concatenate(([True], ks[1:] != ks[:-1]))
    number = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    rank = np.empty(n + 1, np.int64)
    rank[sa], rank[n] = number, -1
    single = head & np.append(head[1:], True)
    open_ = sa[~single]                                        # still in groups of several, in sorted order
    h = 6
    while len(open_) and h < depth:
        pair = rank[open_] * (n + 1) + rank[np.minimum(open_ + h, n)] + 1
        o = np.argsort(pair)
        open_, pair = open_[o], pair[o]
        group = pair // (n + 1)
        fresh = np.concatenate(([True], group[1:] != group[:-1]))
        head = np.concatenate(([True], pair[1:] != pair[:-1]))
        at = np.arange(len(open_))
        base = np.maximum.accumulate(np.where(fresh, at, 0))
        rank[open_] = group + np.maximum.accumulate(np.where(head, at, 0)) - base
        open_ = open_[~(head & np.append(head[1:], True))]
        h *= 2
    return rank[:n]


def common_prefixes(text: np.ndarray, sa: np.ndarray, first: np.ndarray, size: np.ndarray, most: int) -> np.ndarray:
    """Common prefix (at most ``most``) of each suffix with the one before it in ``sa``, by text position.

    Kasai's method: along a segment the value falls by at most one a place, if ``sa`` is the full order.
    All segments advance side by side, each with a value of its own; a number
    0 ends a segment and equals nothing.
    """
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    padded = np.concatenate((text.astype(np.int64), np.zeros(most + 1, np.int64)))
    out = np.zeros(n, np.int64)
    value = np.zeros(len(first), np.int64)
    for t in range(int(size.max()) if len(size) else 0):
        own = np.flatnonzero(size > t)
        i = first[own] + t
        j = before[i]
        v = np.where(j >= 0, np.maximum(value[own] - 1, 0), 0)
        go = np.flatnonzero(j >= 0)
        while len(go):
            a, b = padded[i[go] + v[go]], padded[j[go] + v[go]]
            go = go[(a == b) & (a != 0) & (v[go] < most)]
            v[go] += 1
        out[i] = value[own] = v
    return out


def suffix_starts(contents: list[bytes], length: int) -> list[np.ndarray]:
    """For each text, which of its ``len - length + 1`` starts begin a string that also starts elsewhere in them."""
    size = np.array([len(c) for c in contents], np.int64)
    first = np.concatenate(([0], np.cumsum(size[:-1] + 1)))
    text = np.zeros(int((size + 1).sum()), np.int64)
    for c, at in zip(contents, first.tolist()):
        text[at:at + len(c)] = np.frombuffer(c, np.uint8).astype(np.int64) + 1
    # sorted to the end, not to ``length``: the prefix that Kasai's method carries on holds only in the full order
    rank = sort_suffixes(text, len(text))
    sa = np.argsort(rank)
    # a string with fewer bytes before its text's end never reaches ``length``, so neighbours suffice
    lcp = common_prefixes(text, sa, first, size, length)
    same = lcp[sa] >= length
    hit = np.zeros(len(text), bool)
    hit[sa[same]] = True
    hit[sa[np.flatnonzero(same) - 1]] = True
    return [hit[a:a + k - length + 1] for a, k in zip(first.tolist(), size.tolist())]


def shard_starts(contents: list[bytes], counts: list[int], anchors: list[int], length: int, gram: int) -> list[np.ndarray]:
    """For each segment of a shard which of its starts begin a string that another segment holds.

    Equal strings lie at equal offsets from equal anchors, so a segment is
    cut into pieces of STEP offsets.  All strings of a piece share its
    middle bytes; a piece whose middle no other segment has at these offsets
    is settled.  The runs of the other pieces are sorted, equal runs once.
    """
    step = max(1, min(STEP, length // 4))
    size = np.array([len(c) for c in contents], np.int64)
    begin = np.concatenate(([0], np.cumsum(size)))
    data = np.frombuffer(b"".join(contents), np.uint8)
    n, anchor = np.array(counts, np.int64), np.array(anchors, np.int64)
    h = SpanHash(data)
    # the anchor's place: the first gram of the segment with its hash
    g = h.grams(gram)
    owner = np.repeat(np.arange(len(size)), size)[:len(g)]
    at = np.flatnonzero(g.view(np.int64) == anchor[owner])
    who, index = np.unique(owner[at], return_index=True)
    offset = np.zeros(len(size), np.int64)
    offset[who] = at[index] - begin[who]
    # pieces: starts t in [lo, hi) have offsets offset - t within [k * step, (k + 1) * step)
    low, high = (offset - n + 1) // step, offset // step
    seg = np.repeat(np.arange(len(n)), high - low + 1)
    k = np.arange(len(seg)) - np.repeat(np.cumsum(high - low + 1) - (high - low + 1), high - low + 1) + low[seg]
    lo, hi = np.maximum(offset[seg] - (k + 1) * step + 1, 0), np.minimum(offset[seg] - k * step + 1, n[seg])
    mid = begin[seg] + offset[seg] - k * step
    key = mix(h.of(mid, mid + length - step + 1) + mix(anchor[seg].view(np.uint64)) * np.uint64(step) + k.astype(np.uint64))
    _, inverse, times = np.unique(key, return_inverse=True, return_counts=True)
    keep = times[inverse] > 1
    out = [np.zeros(c, bool) for c in counts]
    # runs of kept pieces (pieces of a segment are in order of falling start)
    seg, lo, hi = seg[keep][::-1], lo[keep][::-1], hi[keep][::-1]
    if len(seg) == 0:
        return out
    new = np.concatenate(([True], (seg[1:] != seg[:-1]) | (lo[1:] != hi[:-1])))
    at = np.flatnonzero(new)
    seg, lo, hi = seg[at], lo[at], hi[np.append(at[1:], len(hi)) - 1]
    texts: dict[bytes, list[int]] = {}
    for r, (s, a, b) in enumerate(zip(seg.tolist(), lo.tolist(), hi.tolist())):
        texts.setdefault(contents[s][a:b + length - 1], []).append(r)
    for (text, members), hit in zip(texts.items(), suffix_starts(list(texts), length)):
        for r in members:
            out[seg[r]][lo[r]:hi[r]] = True if len(members) > 1 else hit
    return out


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    d = np.diff(np.concatenate(([0], mask.astype(np.int8), [0])))
    return np.flatnonzero(d == 1), np.flatnonzero(d == -1)


_RANGE_COLS = "anchor long, seg long, lo int, hi int"


def _solve(pdf: pd.DataFrame, length: int, gram: int) -> pd.DataFrame:
    """Repeated start ranges of one shard's segments."""
    pdf = pdf.drop_duplicates(["anchor", "seg"])
    marks = shard_starts(pdf["content"].tolist(), pdf["n"].tolist(), pdf["anchor"].tolist(), length, gram)
    out = [(a, s, lo, hi) for a, s, m in zip(pdf["anchor"], pdf["seg"], marks) for lo, hi in zip(*runs(m))]
    return pd.DataFrame(out, columns=["anchor", "seg", "lo", "hi"])


_STRING = np.dtype([("digest", "S16"), ("seg", "<i8"), ("at", "<i4")])


def _sorted_strings(pdf: pd.DataFrame, length: int) -> pd.DataFrame:
    """One part of a split anchor: its strings' digests, sorted and cut into as many ranges as the anchor has parts."""
    pdf = pdf.drop_duplicates(["anchor", "seg"])
    rows = np.empty(int(pdf["n"].sum()), _STRING)
    i = 0
    for s, n, c in zip(pdf["seg"], pdf["n"], pdf["content"]):
        rows["digest"][i:i + n] = [hashlib.blake2b(c[t:t + length], digest_size=16).digest() for t in range(n)]
        rows["seg"][i:i + n], rows["at"][i:i + n] = s, np.arange(n)
        i += n
    rows = rows[np.argsort(rows["digest"], kind="stable")]
    n_ranges = int(pdf["parts"].iloc[0])
    top = rows.view(np.uint8).reshape(len(rows), -1)[:, :4].astype(np.uint64) @ np.array([1 << 24, 1 << 16, 1 << 8, 1], np.uint64)
    cut = np.searchsorted(top, (np.arange(1, n_ranges, dtype=np.uint64) << np.uint64(32)) // np.uint64(n_ranges))
    return pd.DataFrame({"anchor": int(pdf["anchor"].iloc[0]), "part": int(pdf["part"].iloc[0]), "range": np.arange(n_ranges),
                         "strings": [x.tobytes() for x in np.split(rows, cut)]})


def _merge_strings(pdf: pd.DataFrame) -> pd.DataFrame:
    """One digest range of a split anchor: search each part's sorted run in the others' runs."""
    parts = [np.frombuffer(x, _STRING) for x in pdf["strings"]]
    found = []
    for k, own in enumerate(parts):
        hit = np.zeros(len(own), bool)
        for j, other in enumerate(parts):
            if j != k and len(other):
                at = np.minimum(np.searchsorted(other["digest"], own["digest"]), len(other) - 1)
                hit |= other["digest"][at] == own["digest"]
        found.append(own[hit])
    rows = np.sort(np.concatenate(found), order=["seg", "at"])
    first = np.concatenate(([True], (rows["seg"][1:] != rows["seg"][:-1]) | (rows["at"][1:] != rows["at"][:-1] + 1)))[:len(rows)]
    lo = np.flatnonzero(first)
    hi = np.append(lo[1:], len(rows)) - 1
    return pd.DataFrame({"anchor": int(pdf["anchor"].iloc[0]), "seg": rows["seg"][lo], "lo": rows["at"][lo], "hi": rows["at"][hi] + 1 if len(lo) else []})


# -- the whole -------------------------------------------------------------------------

def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(id, key, starts, ends) of the byte spans covered by repeated strings, for documents (id, key, text)."""
    occ = save(places(docs, length, gram), "sub-places")
    segs = occ.groupBy("anchor", "seg").agg(F.count("*").alias("times"), F.min("n").alias("n"),
                                            F.min(F.struct("id", "key", "start")).alias("rep"))
    segs = save(segs, "sub-segments")
    kinds = segs.groupBy("anchor").agg(F.count("*").alias("variants"), F.sum(F.col("n") + F.lit(length)).alias("bytes"),
                                       F.min("times").alias("least"))
    open_ = save(kinds.where("variants > 1 and least = 1"), "sub-anchors")
    total = open_.agg(F.sum("bytes")).first()[0] or 0
    n_shards = max(1, -(-int(total) // shard_bytes))
    # fetch the distinct segments of the open anchors from one of their places
    dealt = segs.join(open_, "anchor").withColumn(
        "parts", F.ceil(F.col("bytes") / F.lit(float(shard_bytes))).cast("int"))
    dealt = dealt.select(
        F.col("rep.id").alias("id"), F.col("rep.key").alias("key"), F.struct(
            "anchor", "seg", "n", F.col("rep.start").alias("start"),
            F.when(F.col("parts") > 1, F.col("anchor")).otherwise(F.pmod(F.hash("anchor"), F.lit(n_shards)).cast("long")).alias("shard"),
            F.when(F.col("parts") > 1, F.pmod(F.hash("seg"), F.col("parts"))).otherwise(-1).alias("part"), "parts").alias("want"))
    wanted = dealt.groupBy("id", "key").agg(F.collect_list("want").alias("want"))
    held = join_on(docs, wanted, ["id", "key"])

    def fetch(batches: Iterator[pa.RecordBatch]):
        for part, data, off in slices(batches):
            raw = data.tobytes()
            rows = [(w["shard"], w["part"], w["parts"], w["anchor"], w["seg"], w["n"], raw[off[i] + w["start"]:off[i] + w["start"] + w["n"] + length - 1])
                    for i, want in enumerate(part.column("want").to_pylist()) for w in want]
            cols = list(zip(*rows)) or [()] * 7
            kinds_ = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds_)],
                                             ["shard", "part", "parts", "anchor", "seg", "n", "content"])

    content = held.select("text", "want").mapInArrow(
        fetch, "shard long, part int, parts int, anchor long, seg long, n int, content binary")
    solved = content.groupBy("shard", "part").applyInPandas(lambda pdf: _solve(pdf, length, gram), _RANGE_COLS)
    ranges = solved
    if open_.where(F.col("bytes") > shard_bytes).limit(1).count():
        split = content.where("part >= 0")
        strings = split.groupBy("shard", "part").applyInPandas(
            lambda pdf: _sorted_strings(pdf, length), "anchor long, part int, range int, strings binary")
        ranges = ranges.unionByName(strings.groupBy("anchor", "range").applyInPandas(_merge_strings, _RANGE_COLS))
    # to all places of the segments
    twice = segs.where("times > 1").select("anchor", "seg", F.lit(0).alias("lo"), F.col("n").alias("hi"))
    known = save(ranges, "sub-ranges").unionByName(twice)
    spans = occ.join(known, ["anchor", "seg"]).select(
        "id", "key", (F.col("start") + F.col("lo")).alias("s"), (F.col("start") + F.col("hi") + F.lit(length - 1)).alias("e"))
    # equal rows share id and key, and each of them found the same spans
    return spans.distinct().groupBy("id", "key").agg(F.collect_list(F.struct("s", "e")).alias("spans"))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM,
                shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Per row: id, n_bytes, merged span_starts and span_ends, and ``kept`` (remaining bytes).

    Texts are UTF-8 bytes; a byte goes if a string of ``length`` bytes that
    covers it also starts anywhere else in the table, the same text included.
    A null, empty or shorter text has no spans; repeated rows are documents
    of their own, so each repeats the other; null ids are allowed; other
    columns are ignored; an empty table gives no rows.
    """
    src = core(docs, id_col, text_col)
    rows = src.select(F.col(id_col).alias("id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("key"),
                      F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    spans = save(repeated_spans(rows, length, gram, shard_bytes), "sub-spans")
    both = join_on(rows, spans, ["id", "key"], "left").select("id", "text", "spans")

    def cut(batches: Iterator[pa.RecordBatch]):
        for part, data, off in slices(batches):
            raw = data.tobytes()
            starts, ends, kept = [], [], []
            column = part.column("spans")
            for i in range(part.num_rows):
                own = raw[off[i]:off[i + 1]]
                if column[i].is_valid:
                    v = column[i].values
                    s, e = merge_spans(np.asarray(v.field(0)), np.asarray(v.field(1)))
                    edges = [0, *np.stack((s, e), axis=1).ravel().tolist(), len(own)]
                    own = b"".join(own[a:b] for a, b in zip(edges[::2], edges[1::2]))
                else:
                    s = e = np.zeros(0, np.int64)
                starts.append(s)
                ends.append(e)
                kept.append(own)
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array(np.diff(off)), pa.array(starts, longs), pa.array(ends, longs), pa.array(kept, pa.binary())],
                [id_col, "n_bytes", "span_starts", "span_ends", "kept"])

    kind = src.schema[id_col].dataType.simpleString()
    return both.mapInArrow(cut, f"`{id_col}` {kind}, n_bytes long, span_starts array<long>, span_ends array<long>, kept binary")
