"""Exact quantiles and modes without gathering all distinct values in one task.

``percentile_approx`` (bounded sketches, merged) brackets each wanted rank;
a second pass counts the rows below and inside every bracket.  A bracket of
one value is the answer; one of at most ``READ`` rows is read off in a third
pass; a wider one is sketched again between its ends, and one that misses its
rank is drawn wider.  So no task ever holds more than ``READ`` rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

ACCURACY = 1_000          # entries a sketch: what every task sends for every column
READ = 100_000


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], accuracy: int = ACCURACY,
                    read: int = READ, if_null: bool = False) -> dict[str, list[float | None]]:
    """Interpolated quantiles (position ``p * (n - 1)``) of every column;
    NULLs are ignored, a column without values gives None.  ``if_null``:
    only of the columns that hold a NULL, found by the same first pass."""
    if not cols:
        return {}
    data = df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    edges = _edges(probs, 2.0 / accuracy)
    row = data.agg(F.count(F.lit(1)).alias("n"), *[x for i in range(len(cols)) for x in (
        F.count(f"c{i}").alias(f"n{i}"), F.percentile_approx(f"c{i}", edges, accuracy).alias(f"q{i}"))]).first()
    chosen = [i for i in range(len(cols)) if not if_null or row[f"n{i}"] < row["n"]]
    open_ranks: dict[tuple[int, int], tuple[float, float]] = {}         # (column, rank) -> bracket
    for i in chosen:
        for j, p in enumerate(probs if row[f"n{i}"] else ()):
            at = p * (row[f"n{i}"] - 1)
            for k in {math.floor(at), math.ceil(at)}:
                open_ranks[i, k] = _bracket(row[f"q{i}"], j)
    found = _find(data, open_ranks, accuracy, read) if open_ranks else {}
    out: dict[str, list[float | None]] = {}
    for i in chosen:
        n = row[f"n{i}"]
        out[cols[i]] = [_between(found, i, p * (n - 1)) if n else None for p in probs]
    return out


def _between(found: dict[tuple[int, int], float], i: int, at: float) -> float:
    a, b = found[i, math.floor(at)], found[i, math.ceil(at)]
    return a if a == b else a + (b - a) * (at - math.floor(at))


def _bracket(sketch: Sequence[float], j: int) -> tuple[float, float]:
    """The ends round probability ``j``; NaN sorts above all numbers."""
    lo, hi = sketch[2 * j], sketch[2 * j + 1]
    return (-math.inf, math.inf) if math.isnan(lo) else (lo, math.inf if math.isnan(hi) else hi)


def _edges(probs: Sequence[float], eps: float):
    return F.array(*[F.lit(float(min(max(p + s * eps, 0.0), 1.0))) for p in probs for s in (-1, 1)])


def _find(data: DataFrame, open_ranks: dict[tuple[int, int], tuple[float, float]], accuracy: int,
          read: int) -> dict[tuple[int, int], float]:
    """The value at each 0-based rank of its column, from a first bracket."""
    found: dict[tuple[int, int], float] = {}
    while open_ranks:
        spans = sorted({(i, lo, hi) for (i, _), (lo, hi) in open_ranks.items()})
        counts = data.agg(*[x for m, (i, lo, hi) in enumerate(spans) for x in (
            F.count_if(F.col(f"c{i}") < lo).alias(f"b{m}"), F.count_if(F.col(f"c{i}").between(lo, hi)).alias(f"w{m}"))]).first()
        size = {s: (counts[f"b{m}"], counts[f"w{m}"]) for m, s in enumerate(spans)}
        near: list[tuple[int, float, float, int, int]] = []
        again: dict[tuple[int, int], tuple[float, float]] = {}
        narrow: dict[tuple[int, float, float], list[int]] = {}
        for (i, k), (lo, hi) in open_ranks.items():
            below, within = size[i, lo, hi]
            if k < below:
                again[i, k] = (-math.inf, math.nextafter(lo, -math.inf))
            elif k >= below + within and hi == math.inf:
                found[i, k] = math.nan
            elif k >= below + within:
                again[i, k] = (math.nextafter(hi, math.inf), math.inf)
            elif lo == hi:
                found[i, k] = lo
            elif within <= read:
                near.append((i, lo, hi, k - below, k))
            else:
                narrow.setdefault((i, lo, hi), []).append(k)
        if near:
            found |= _ranks(data, near)
        if narrow:
            again |= _narrower(data, narrow, size, accuracy)
        open_ranks = again
    return found


def _narrower(data: DataFrame, narrow: dict[tuple[int, float, float], list[int]],
              size: dict[tuple[int, float, float], tuple[int, int]], accuracy: int) -> dict[tuple[int, int], tuple[float, float]]:
    """Brackets of the same ranks from sketches of what lies inside the old ones."""
    spans = list(narrow.items())
    row = data.agg(*[F.percentile_approx(
        F.when(F.col(f"c{i}").between(lo, hi), F.col(f"c{i}")),
        _edges([(k - size[i, lo, hi][0]) / size[i, lo, hi][1] for k in ks], 2.0 / accuracy), accuracy).alias(f"q{m}")
        for m, ((i, lo, hi), ks) in enumerate(spans)]).first()
    out = {}
    for m, ((i, lo, hi), ks) in enumerate(spans):
        for j, k in enumerate(ks):
            new = _bracket(row[f"q{m}"], j)
            if new == (lo, hi):             # heavy values at both ends: their middle parts them
                mid = 0.0 if lo < 0 < hi else lo / 2 + hi / 2
                new = (lo, mid) if lo < mid < hi else (lo, lo)
            out[i, k] = new
    return out


def _ranks(data: DataFrame, near: list[tuple[int, float, float, int, int]]) -> dict[tuple[int, int], float]:
    """Values at ranks counted from the low end of brackets of a bounded size."""
    by_col: dict[int, set[tuple[float, float]]] = {}
    for i, lo, hi, _, _ in near:
        by_col.setdefault(i, set()).add((lo, hi))

    def inside(i: int, spans):
        hit = F.lit(False)
        for lo, hi in spans:
            hit = hit | F.col(f"c{i}").between(lo, hi)
        return F.when(hit, F.struct(F.lit(i).alias("i"), F.col(f"c{i}").alias("v")))

    kept = data.select(F.explode(F.filter(F.array(*[inside(i, s) for i, s in by_col.items()]), lambda x: x.isNotNull())).alias("x"))
    counts = kept.groupBy("x.i", "x.v").agg(F.count(F.lit(1)).alias("n"))
    ranks = data.sparkSession.createDataFrame(near, "i int, lo double, hi double, at long, k long")
    met = counts.join(F.broadcast(ranks), "i").where("v between lo and hi")        # ranks: two rows a quantile
    upto = F.sum("n").over(W.partitionBy("i", "k").orderBy("v"))
    rows = met.withColumn("upto", upto).where("at >= upto - n and at < upto").collect()
    return {(r["i"], r["k"]): r["v"] for r in rows}


def mode(df: DataFrame, col: str):
    """Most frequent non-NULL value, ties to the smallest; None without values.
    Counts combine map-side and each task keeps its best row."""
    top = (df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("v")).agg(F.count(F.lit(1)).alias("n"))
             .orderBy(F.col("n").desc(), "v").limit(1).collect())
    return top[0]["v"] if top else None
