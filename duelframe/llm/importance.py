"""Importance resampling of documents towards a target distribution.

Words come from an untrained pre-tokeniser of the ``tokenizers`` library: a
Regex Split over the ASCII-lowered text, which returns every word with its
byte offsets.  Windows of consecutive words are pairs of offsets in the words
joined by one space; the CRC of a window picks its histogram bucket.  The raw
and the target histogram give each bucket a gain (a scaled, floored log
ratio), a document's weight is the sum of the gains of its windows, and
Gumbel noise from its id turns "the highest scores" into a draw without
replacement in proportion to the weights.

Texts are read once: a document's buckets with their counts are written as a
narrow table, from which the histograms are added up (within a task first)
and, with the gains at hand, the weights.  Only histograms, whose width is a
parameter, come to the driver.  Ranks come from a range partitioning by
score: a row's place in its partition plus the rows of the partitions before.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import PreTokenizedString, Regex
from tokenizers.pre_tokenizers import Split

from duelframe.llm.common import core, ddl, save, slices

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
NGRAMS = (1, 1)
BUCKETS = 10_000
SCALE = 1000
LEAST_WORDS = 20
SHARE = (10, 100)
SEED = "2024"


def window_buckets(text: str, splitter: Split, ngrams: tuple[int, int], buckets: int) -> tuple[int, np.ndarray]:
    """Number of words of an ASCII-lowered text and the bucket of every window of them, repeats included."""
    pre = PreTokenizedString(text)
    splitter.pre_tokenize(pre)
    offsets = [o for _, o, _ in pre.get_splits(offset_referential="original", offset_type="byte")]
    raw = text.encode()
    joined = b" ".join([raw[s:e] for s, e in offsets])
    size = np.array([e - s for s, e in offsets], np.int64)
    end = np.cumsum(size + 1) - 1
    start = end - size
    crcs = [zlib.crc32(joined[s:e]) for n in range(ngrams[0], ngrams[1] + 1)
            for s, e in zip(start[:max(0, len(start) - n + 1)].tolist(), end[n - 1:].tolist())]
    return len(offsets), np.array(crcs, np.int64) % buckets


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             ngrams: tuple[int, int] = NGRAMS, buckets: int = BUCKETS) -> DataFrame:
    """(id, n_words, n_features, bucket, times): the distinct buckets of every text and how often each occurs."""
    src = core(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = Split(Regex(SEPARATORS), "removed")
        for piece, _, _ in slices(batches, text_col):
            n_words, n_features, held = [], [], []
            for text in piece.column(text_col).to_pylist():
                n, found = window_buckets((text or "").encode().lower().decode(), splitter, ngrams, buckets)
                n_words.append(n)
                n_features.append(len(found))
                held.append(np.unique(found, return_counts=True))
            off = pa.array(np.cumsum([0, *(len(b) for b, _ in held)]), pa.int32())
            flat = [pa.array(np.concatenate([h[k] for h in held]).astype(np.int32)) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays(
                [piece.column(id_col), pa.array(n_words, pa.int64()), pa.array(n_features, pa.int64()),
                 *[pa.ListArray.from_arrays(off, x) for x in flat]],
                [id_col, "n_words", "n_features", "bucket", "times"])

    return src.mapInArrow(run, f"{ddl(src, [id_col])}, n_words long, n_features long, bucket array<int>, times array<int>")


def histogram(feats: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Occurrences in every bucket over all rows; tasks add up their rows first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for b in batches:
            bucket, times = (b.column(c).flatten().to_numpy() for c in ("bucket", "times"))
            total += np.bincount(bucket, times, buckets).astype(np.int64)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at])], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for row in feats.select("bucket", "times").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row["bucket"]] = row["n"]
    return out


def gains(raw: np.ndarray, target: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """Floored scaled log ratio of the smoothed target share to the smoothed raw share, by bucket."""
    n, all_raw, all_target = len(raw), int(raw.sum()), int(target.sum())
    return np.array([math.floor(scale * math.log((float(t) + 1) * (float(all_raw) + n) / ((float(s) + 1) * (float(all_target) + n))))
                     for s, t in zip(raw.tolist(), target.tolist())], np.int64)


def weigh(feats: DataFrame, gain: np.ndarray, id_col: str = "doc_id") -> DataFrame:
    """(id, n_words, n_features, weight): the sum of the gains over a document's windows (none: 0)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bucket, times = b.column("bucket"), b.column("times")
            sums = np.concatenate([[0], np.cumsum(gain[bucket.flatten().to_numpy()] * times.flatten().to_numpy())])
            end = np.cumsum(bucket.value_lengths().to_numpy())
            start = end - bucket.value_lengths().to_numpy()
            yield pa.RecordBatch.from_arrays(
                [b.column(id_col), b.column("n_words"), b.column("n_features"), pa.array(sums[end] - sums[start], pa.int64())],
                [id_col, "n_words", "n_features", "weight"])

    return feats.mapInArrow(run, f"{ddl(feats, [id_col])}, n_words long, n_features long, weight long")


def noise(id_col: str, seed: str = SEED, scale: int = SCALE) -> Column:
    """Floored scaled Gumbel noise from the first 8 hex digits of the SHA-256 of seed and id (a null id is written as nothing)."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-float(scale)) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def rank_rows(rows: DataFrame, order: list[Column]) -> DataFrame:
    """All rows with their ``rank`` (1, 2, ...) by ``order``.

    The rows are dealt to ranges of the order and sorted inside them; counts
    by range, one number each, come to the driver.  Equal rows are told apart
    by the place where they were read, so no range has to hold all of them.
    """
    keys = [*order, F.col("__place").asc()]
    placed = rows.withColumn("__place", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = save(placed.drop("__place").withColumn("__seq", F.monotonically_increasing_id()), "ranges")
    placed = placed.withColumn("__part", F.shiftright("__seq", 33))
    before, offsets = 0, []
    for row in sorted(placed.groupBy("__part").count().collect()):
        offsets.append((row["__part"], before))
        before += row["count"]
    known = rows.sparkSession.createDataFrame(offsets, "__part long, __before long")
    inside = F.col("__seq").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.join(known, "__part").withColumn("rank", F.col("__before") + inside + 1).drop("__part", "__before", "__seq")


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text",
             ngrams: tuple[int, int] = NGRAMS, buckets: int = BUCKETS, least_words: int = LEAST_WORDS,
             share: tuple[int, int] = SHARE, seed: str = SEED) -> DataFrame:
    """Per document: id, n_words, n_features, weight, score and rank.

    Of the N documents with at least ``least_words`` words the
    floor(share * N) highest scores are drawn, ranked by score and then by
    id; ``rank`` is null for all others.  A null or empty text has no
    features, weight 0 and only its noise as score.  Null ids share the noise
    of an empty id and come last among equal scores; repeated rows are drawn
    one by one.  An empty table gives no rows, an empty target's histogram is
    its smoothing alone; other columns are ignored.
    """
    feats = save(features(docs, id_col, text_col, ngrams, buckets), "importance-features")
    wanted = features(target.select(F.lit(0).alias("id"), F.col(f"`{target_text}`").alias("text")), "id", "text", ngrams, buckets)
    gain = gains(histogram(feats, buckets), histogram(wanted, buckets))
    scored = save(weigh(feats, gain, id_col).withColumn("score", F.col("weight") + noise(id_col, seed)), "importance-scores")
    able = F.col("n_words") >= F.lit(least_words)
    most = share[0] * scored.where(able).count() // share[1]
    drawn = rank_rows(scored.where(able), [F.col("score").desc(), F.col(f"`{id_col}`").asc_nulls_last()])
    drawn = drawn.withColumn("rank", F.when(F.col("rank") <= F.lit(most), F.col("rank")))
    return drawn.unionByName(scored.where(~able).withColumn("rank", F.lit(None).cast("long")))
