"""SimHash near-duplicates by multi-index hashing.

A fingerprint is cut into a high and a low segment of 32 bits.  Two
fingerprints at distance 2 or less either differ in at most one bit of the
high segment or not at all in the low one (else they would differ in 2 + 1
bits), so looking up the Hamming ball of radius 1 of the high segment and the
low segment itself finds every pair; complete distances are then verified.

A table bucket of more than ``BUCKET`` fingerprints is not compared pair by
pair: its members, and those that look into it, are re-keyed by the ball of
radius 1 of the whole fingerprint.  Two fingerprints share such a key exactly
if they are at distance 2 or less, and at most 65 fingerprints share one, so
candidates stay in proportion to the fingerprints whatever their skew.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duelframe.llm.common import core, save, slices
from duelframe.llm.components import connected_components

SEED = 42
BITS = 64
SEGMENT = 32
BUCKET = 64


def fingerprint(text: bytes, shingle: int = 3, seed: int = SEED) -> int:
    """Signed 64-bit SimHash of a text: majority of the XXH64 bits of its word shingles.

    Words are separated by ASCII white space, A-Z lower-cased; fewer words
    than ``shingle`` make one shingle, no words give 0.
    """
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    k = min(shingle, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = len(words) - k + 1
    counts = np.zeros(BITS, np.int64)
    digest = xxhash.xxh64_intdigest
    lo, hi = starts[:n].tolist(), ends[k - 1:].tolist()
    for i in range(0, n, 1 << 15):
        h = np.array([digest(joined[a:b], seed) for a, b in zip(lo[i:i + (1 << 15)], hi[i:i + (1 << 15)])], dtype="<u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * counts > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(id, fp LONG) per row; a null, empty or blank text has fingerprint 0."""
    src = core(docs, id_col, text_col)

    def run(batches):
        for part, data, off in slices(batches, text_col):
            raw = data.tobytes()
            fp = [fingerprint(raw[off[i]:off[i + 1]], shingle) for i in range(part.num_rows)]
            yield pa.RecordBatch.from_arrays([part.column(id_col), pa.array(fp, pa.int64())], [id_col, "fp"])

    return src.mapInArrow(run, f"`{id_col}` {src.schema[id_col].dataType.simpleString()}, fp long")


def _flips(col, width: int):
    """The values that differ from ``col`` in one of its ``width`` low bits."""
    return F.transform(F.sequence(F.lit(0), F.lit(width - 1)),
                       lambda b: col.bitwiseXOR(F.call_function("shiftleft", F.expr("1L"), b)))


def links(fps: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Pairs (a, b), a < b, of the distinct fingerprints ``fp`` that differ in 1 or 2 bits.

    Within a re-keyed bucket each member links to the bucket's smallest only
    (all of them are within 2 bits of each other through its key), so the
    table has the components of all links, not always every link.
    """
    high = F.shiftrightunsigned("fp", SEGMENT)
    low = F.col("fp").bitwiseAND(F.lit((1 << SEGMENT) - 1))
    table = fps.select("fp", F.explode(F.array(
        F.struct(F.lit(0).alias("seg"), high.alias("key")), F.struct(F.lit(1).alias("seg"), low.alias("key")))).alias("s")
    ).select("s.seg", "s.key", "fp")
    ups = F.filter(_flips(high, SEGMENT), lambda x: x > high)  # of a pair, one side looks the other up
    looks = fps.select(F.lit(0).alias("seg"), F.explode(ups).alias("key"), "fp")
    full = table.groupBy("seg", "key").agg(F.count("*").alias("n")).where(F.col("n") > bucket).select("seg", "key")
    full = save(full, "simhash-full")
    open_ = table.join(full, ["seg", "key"], "left_anti")
    # inside a bucket, and from the ball into a bucket
    same = open_.groupBy("seg", "key").agg(F.sort_array(F.collect_list("fp")).alias("f")).where(F.size("f") > 1)
    same = same.select("f", F.posexplode("f").alias("i", "a")).select(
        "a", F.explode(F.slice(F.col("f"), F.col("i") + 2, F.lit(bucket))).alias("b"))
    over = looks.alias("l").join(open_.alias("t"), ["seg", "key"]).select(
        F.col("l.fp").alias("a"), F.col("t.fp").alias("b"))
    near = same.union(over).where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= 2)
    # full buckets: key by the ball of the whole fingerprint
    crowd = table.union(looks).join(full, ["seg", "key"], "left_semi").select("fp").distinct()
    keyed = crowd.select("fp", F.explode(F.concat(F.array("fp"), _flips(F.col("fp"), BITS))).alias("key"))
    star = keyed.groupBy("key").agg(F.min("fp").alias("a"), F.collect_set("fp").alias("f"))
    star = star.select("a", F.explode("f").alias("b")).where("a < b")
    return near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).union(star).distinct()


def one_bit_links(fps: DataFrame) -> DataFrame:
    """Pairs (a, b) of fingerprints one bit apart: the ball of each looked up in the table of all."""
    ball = fps.select(F.col("fp").alias("a"), F.explode(_flips(F.col("fp"), BITS)).alias("b"))
    return ball.where("a < b").join(fps.select(F.col("fp").alias("b")), "b").select("a", "b")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    max_bits: int = 2, bucket: int = BUCKET) -> DataFrame:
    """(id, fingerprint, component_id) per row of ``docs``.

    Fingerprints link at ``max_bits`` (0 to 2) or fewer differing bits;
    component_id is the smallest id reachable.  Null, empty and blank texts
    have fingerprint zero and link like any other.  A null id takes part and
    gets its component's smallest other id (null if there is none).  Repeated
    rows are each returned; an empty table gives no rows; other columns of
    ``docs`` are ignored.  Equal fingerprints are merged before the lookup, so
    groups of copies cost one entry.
    """
    if not 0 <= max_bits <= 2:
        raise ValueError("the segment lookup covers distances 0 to 2")
    fps = save(fingerprints(docs, id_col, text_col, shingle), "simhash-fp")
    groups = save(fps.groupBy("fp").agg(F.min(id_col).alias("rep")), "simhash-groups")
    if max_bits:
        pairs = links(groups.select("fp"), bucket) if max_bits == 2 else one_bit_links(groups.select("fp"))
        labels = save(connected_components(pairs), "simhash-labels").withColumnRenamed("node", "fp")
        named = groups.join(labels, "fp", "left").select("fp", "rep", F.coalesce("label", "fp").alias("label"))
        least = named.groupBy("label").agg(F.min("rep").alias("component_id"))
        named = named.join(least, "label").select("fp", "component_id")
    else:
        named = groups.select("fp", F.col("rep").alias("component_id"))
    out = fps.join(named, "fp")
    return out.select(id_col, F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
