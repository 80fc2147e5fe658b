"""Quality scores by nearest-neighbour voting among latent-semantic vectors.

A text's terms are its byte trigrams, counted in hashed buckets, and for each
short gap the share of words that repeat the word so many places before.
They are weighed by log frequency and by inverse document frequency over all
documents, and projected on the leading singular vectors of a labelled sample.  The labelled vectors
are broadcast; each block of documents is multiplied with all of them (exact
cosines), and the nearest vote for their label with their similarity.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duelframe.llm.common import NONSPACE, SpanHash, core, fit_in_task, slices, word_spans
from duelframe.llm.toxicity import labelled_sample

BUCKETS = 4096
GAPS = 8                       # repeats of a word 1 to 8 places after it are terms too
GAP_SCALE, GAP_WEIGHT = 200.0, 6.0
TERMS = BUCKETS + GAPS
DIMENSIONS = 48
NEIGHBOURS = 15
SAMPLE = 2000                  # labelled documents of each label used at most, by smallest hash of the id
BLOCK = 512                    # documents multiplied at once


def trigram_counts(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """(texts, BUCKETS) counts of hashed byte trigrams; none span two texts."""
    n = len(off) - 1
    if len(data) < 3:
        return np.zeros((n, BUCKETS), np.float32)
    b = data.astype(np.uint32)
    code = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
    bucket = ((code * np.uint32(2654435761)) >> np.uint32(20)).astype(np.int64)
    doc = np.repeat(np.arange(n), np.diff(off))
    inside = doc[2:] == doc[:-2]
    return np.bincount((doc[:-2] * BUCKETS + bucket)[inside], minlength=n * BUCKETS).reshape(n, BUCKETS).astype(np.float32)


def repeat_shares(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """(texts, GAPS): share of a text's words that equal the word 1, 2, ... places before, scaled."""
    s, e = word_spans(data, off, NONSPACE)
    n = len(off) - 1
    first = np.searchsorted(s, off)
    words = np.diff(first)
    out = np.zeros((n, GAPS), np.float32)
    h = SpanHash(data).of(s, e)
    doc = np.repeat(np.arange(n), words)
    for k in range(1, GAPS + 1):
        same = (h[k:] == h[:-k]) & (doc[k:] == doc[:-k])
        out[:, k - 1] = np.bincount(doc[k:][same], minlength=n) * (GAP_SCALE / np.maximum(words, 1))
    return out


def _blocks(data: np.ndarray, off: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    for a in range(0, len(off) - 1, BLOCK):
        b = min(a + BLOCK, len(off) - 1)
        own = data[off[a]:off[b]], off[a:b + 1] - off[a]
        yield a, b, np.concatenate((trigram_counts(*own), repeat_shares(*own)), axis=1)


def document_frequencies(docs: DataFrame, text_col: str = "text") -> tuple[np.ndarray, int]:
    """How many of all documents hold each term, and their number; tasks add up before the shuffle."""
    def run(batches):
        df, n = np.zeros(TERMS, np.int64), 0
        for part, data, off in slices(batches, text_col):
            for _, _, c in _blocks(data, off):
                df += (c > 0).sum(axis=0)
            n += part.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, TERMS)), pa.array(np.concatenate(([n], df)))], ["bucket", "n"])

    rows = core(docs, text_col).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    full = np.zeros(TERMS + 1, np.int64)
    for r in rows:
        full[r["bucket"]] = r["n"]
    return full[:-1], int(full[-1])


@dataclass
class Voters:
    """Inverse document frequencies, projection, and the labelled vectors with their vote weights."""

    idf: np.ndarray
    basis: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    weights: np.ndarray

    def embed(self, counts: np.ndarray) -> np.ndarray:
        """Unit vectors in the latent space; texts without trigrams give zero."""
        x = _weigh(counts, self.idf) @ self.basis
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)

    def vote(self, x: np.ndarray, k: int = NEIGHBOURS) -> np.ndarray:
        """Share of label 1 among the k nearest, each weighed by its positive cosine; equal cosines go in the
        order of the labelled rows.  A zero vector, near to none, gets the weighed share among all."""
        if len(self.vectors) == 0:
            return np.full(len(x), 0.5)
        sim = x @ self.vectors.T
        k = min(k, sim.shape[1])
        last = -np.partition(-sim, k - 1, axis=1)[:, k - 1:k]
        above = sim > last
        level = sim == last
        take = above | (level & (np.cumsum(level, axis=1) <= k - above.sum(axis=1, keepdims=True)))
        near = np.flatnonzero(take.ravel()).reshape(len(sim), k) - np.arange(len(sim))[:, None] * sim.shape[1]
        w = np.maximum(np.take_along_axis(sim, near, axis=1), 1e-6) ** 4 * self.weights[near]
        share = (w * self.labels[near]).sum(axis=1) / w.sum(axis=1)
        return np.where((x == 0).all(axis=1), (self.weights * self.labels).sum() / self.weights.sum(), share)


def _weigh(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(counts) * idf
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def train(rows: list[tuple[str | None, int]], totals: dict[int, int], df: np.ndarray, n_docs: int, seed: int = 42) -> Voters:
    """Fit the projection on the labelled texts; votes are weighed back to the labels' true shares."""
    idf = np.log((1 + n_docs) / (1 + df)).astype(np.float32)
    idf[BUCKETS:] = GAP_WEIGHT
    labels = np.array([y for _, y in rows], np.float32)
    parts = [c for _, data, off in slices(iter([pa.RecordBatch.from_arrays([pa.array([t for t, _ in rows], pa.string())], ["text"])] if rows else []))
             for _, _, c in _blocks(data, off)]
    a = _weigh(np.concatenate(parts), idf) if parts else np.zeros((0, TERMS), np.float32)
    k = min(DIMENSIONS, max(1, len(a)))
    q = np.random.default_rng(seed).normal(size=(TERMS, k + 8)).astype(np.float32)
    for _ in range(4):                                          # subspace iteration on a.T @ a
        q, _ = np.linalg.qr(a.T @ (a @ q))
    _, _, vt = np.linalg.svd(a @ q, full_matrices=False)
    basis = (q @ vt[:k].T).astype(np.float32)
    own = {y: max(1, int((labels == y).sum())) for y in (0, 1)}
    weights = np.array([totals.get(int(y), 1) / own[int(y)] for y in labels], np.float32)
    voters = Voters(idf, basis, np.zeros((0, k), np.float32), labels, weights)
    voters.vectors = voters.embed(np.concatenate(parts)) if parts else voters.vectors
    return voters


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", learn: Column | None = None, id_col: str = "doc_id",
        text_col: str = "text", sample: int = SAMPLE) -> Voters:
    """Labelled vectors from at most ``sample`` documents of each label; frequencies from all documents."""
    allowed = F.lit(True) if learn is None else learn
    rows = labelled_sample(docs, labels, label_col, allowed, id_col, text_col, {1: sample, 0: sample})
    counts = labels.where(allowed & F.col(label_col).isNotNull()).groupBy(F.col(label_col).cast("int").alias("y")).count().collect()
    totals = {r["y"]: r["count"] for r in counts if r["y"] in (0, 1)}
    df, n = document_frequencies(docs, text_col)
    return fit_in_task(rows, lambda r: train([(x[1], x[2]) for x in r], totals, df, n))


def score(docs: DataFrame, voters: Voters, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, score in [0, 1] (share of votes for label 1) and predicted 0/1.

    Null, empty and very short texts have the zero vector, which is near to
    none: their score is label 1's share among all labelled documents.  Equal
    cosines go by the order of the labelled rows (their ids).  Without
    labelled rows every score is 1/2.  Repeated rows and null ids are each
    scored; other columns are ignored; an empty table gives no rows.
    """
    src = core(docs, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(voters)

    def run(batches):
        model = shared.value
        for part, data, off in slices(batches, text_col):
            p = np.zeros(part.num_rows)
            for a, b, c in _blocks(data, off):
                p[a:b] = model.vote(model.embed(c))
            p = np.clip(p, 0, 1)
            yield pa.RecordBatch.from_arrays([part.column(id_col), pa.array(p), pa.array((p >= 0.5).astype(np.int32))],
                                             [id_col, "score", "predicted"])

    return src.mapInArrow(run, f"`{id_col}` {src.schema[id_col].dataType.simpleString()}, score double, predicted int")
