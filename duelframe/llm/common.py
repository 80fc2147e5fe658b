"""Helpers shared by the operators: saved tables, byte views of text, word spans, hashes."""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duelframe.session import checkpoint_dir

SLICE_BYTES = 1 << 20          # text handled at once inside a task (one longer text is handled alone)
_P = 0x9E3779B97F4A7C15 | 1    # odd multiplier of the polynomial hash, so it has an inverse mod 2**64
_PINV = pow(_P, -1, 1 << 64)


# -- tables -----------------------------------------------------------------

def save(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back (cuts the lineage)."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fit_in_task(sample: DataFrame, fit: Callable[[list[tuple]], Any]) -> Any:
    """``fit`` applied to the rows of a bounded sample, in order of the first
    column, inside one task; only the fitted model comes to the driver."""
    def run(batches):
        rows = [r for b in batches for r in zip(*(c.to_pylist() for c in b.columns))]
        rows.sort(key=lambda r: (r[0] is None, r[0]))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit(rows))], pa.binary())], ["model"])

    got = sample.repartition(1).mapInArrow(run, "model binary").collect()
    return pickle.loads(got[0]["model"]) if got else fit([])


def fold_remainder(id_col: str, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod`` (null id: null)."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % F.lit(mod)


def core(df: DataFrame, *cols: str) -> DataFrame:
    """Only the named columns; other columns of the input never reach the operator."""
    return df.select(*[F.col(f"`{c}`") for c in cols])


def ddl(df: DataFrame, cols: list[str]) -> str:
    """Schema text of the named columns."""
    return ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in cols)


def row_key(text: Column) -> Column:
    """With the id, names a row by its content, so that results can be joined back to repeated rows."""
    return F.md5(F.coalesce(text, F.lit("")).cast("binary"))


def join_on(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` in which nulls are equal; the right side's key columns are dropped."""
    named = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    on = [F.col(f"`{k}`").eqNullSafe(F.col(f"`__r_{k}`")) for k in keys]
    out = left.join(named, on, how)
    return out if how in ("left_semi", "left_anti") else out.drop(*[f"__r_{k}" for k in keys])


# -- byte views -------------------------------------------------------------

def utf8_view(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes (uint8) and int64 offsets of a string array; a null counts as empty."""
    n = len(arr)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if arr.null_count:
        arr = arr.fill_null("")
    kind = np.int64 if pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type) else np.int32
    off = np.frombuffer(arr.buffers()[1], dtype=kind)[arr.offset:arr.offset + n + 1].astype(np.int64)
    raw = arr.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[off[0]:off[-1]] if raw is not None else np.zeros(0, np.uint8)
    return data, off - off[0]


def slices(batches: Iterator[pa.RecordBatch], text_col: str = "text",
           max_bytes: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut Arrow batches so that a piece holds at most ``max_bytes`` of text (one row at least)."""
    for batch in batches:
        data, off = utf8_view(batch.column(text_col))
        i, n = 0, batch.num_rows
        while i < n:
            j = max(i + 1, int(np.searchsorted(off, off[i] + max_bytes, "right")) - 1)
            yield batch.slice(i, j - i), data[off[i]:off[j]], off[i:j + 1] - off[i]
            i = j


# -- words ------------------------------------------------------------------

def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """Lookup table: True for bytes outside every given closed range."""
    t = np.ones(256, bool)
    for a, b in ranges:
        t[a:b + 1] = False
    return t


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32             # A-Z only
#: bytes of words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` after lower-casing A-Z
ALNUM = byte_class((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
NONSPACE = byte_class((0x20, 0x20), (0x09, 0x0D))


def word_spans(data: np.ndarray, off: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of word bytes; a text's border ends a run."""
    if len(data) == 0:
        z = np.zeros(0, np.int64)
        return z, z
    w = is_word[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[off] = True
    first, last = w.copy(), w.copy()
    first[1:] &= ~w[:-1] | edge[1:-1]
    last[:-1] &= ~w[1:] | edge[1:-1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


# -- hashes -----------------------------------------------------------------

_POW = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POW[0]) < n + 1:
        for k, base in enumerate((_P, _PINV)):
            full = np.full(n + 1, base, np.uint64)
            full[0] = 1
            _POW[k] = np.cumprod(full)
    return _POW[0], _POW[1]


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes (splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class SpanHash:
    """64-bit hashes of any spans of one byte array, from prefix sums of a polynomial mod 2**64."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        pw, self.inv = _powers(n)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * pw[:n], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.inv[starts] + (ends - starts).astype(np.uint64))

    def grams(self, k: int) -> np.ndarray:
        """Hash of every window of ``k`` bytes."""
        n = len(self.sums) - 1 - k + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mix((self.sums[k:] - self.sums[:n]) * self.inv[:n] + np.uint64(k))


def merge_spans(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of half-open spans (touching ones join), sorted."""
    if len(starts) == 0:
        return starts, ends
    o = np.argsort(starts, kind="stable")
    s, e = starts[o], np.maximum.accumulate(ends[o])
    new = np.ones(len(s), bool)
    new[1:] = s[1:] > e[:-1]
    k = np.flatnonzero(new)
    return s[k], e[np.append(k[1:] - 1, len(s) - 1)]
