"""Column profiling in as few passes as possible.

Each profile is ONE aggregation over the table (all columns together, partial
aggregation map-side), followed by an ``inline`` of a one-row array to turn
the wide result into a long (column, statistic...) table.  Exact quantiles
come from ``operators.quantiles`` (bracketed, then counted).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duelframe.operators.quantiles import exact_quantiles


def _long(wide: DataFrame, cols: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Turn a one-row wide aggregate (``{i}__{field}``) into one row per column."""
    structs = [F.struct(F.lit(c).alias("COLUMN"), F.lit(i).alias("POS"),
                        *[F.col(f"{i}__{f}").alias(f) for f in fields]) for i, c in enumerate(cols)]
    return wide.select(F.inline(F.array(*structs)))


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """count / mean / sample std / min / exact 25-50-75 % / max per column."""
    q = exact_quantiles(df, cols, [0.25, 0.5, 0.75])
    wide = df.agg(*[x for i, c in enumerate(cols) for x in (
        F.count(c).alias(f"{i}__COUNT"), F.avg(c).cast("double").alias(f"{i}__MEAN"),
        F.stddev_samp(c).alias(f"{i}__STD"), F.min(c).cast("double").alias(f"{i}__MIN"),
        F.max(c).cast("double").alias(f"{i}__MAX"))])
    wide = wide.select("*", *[F.lit(q[c][k]).cast("double").alias(f"{i}__{name}")
                              for i, c in enumerate(cols) for k, name in enumerate(("Q25", "Q50", "Q75"))])
    return _long(wide, cols, ["COUNT", "MEAN", "STD", "MIN", "Q25", "Q50", "Q75", "MAX"])


def distinct_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct non-NULL values per column (``nunique``): one grouped count a
    column, each reading only that column, instead of every row expanded
    once per column."""
    parts = [df.select(F.col(c).alias("v")).where("v is not null").distinct().agg(
        F.lit(c).alias("COLUMN"), F.lit(i).alias("POS"), F.count(F.lit(1)).alias("N_DISTINCT")) for i, c in enumerate(cols)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """(VALUE, COUNT) for the non-NULL values of one column."""
    return (df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("VALUE"))
              .agg(F.count(F.lit(1)).alias("COUNT")))


def null_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """NULL count and missing percentage per column."""
    cols = list(cols or df.columns)
    wide = df.agg(F.count(F.lit(1)).alias("__n"),
                  *[F.count_if(F.col(c).isNull()).alias(f"{i}__NULLS") for i, c in enumerate(cols)])
    wide = wide.select(*[x for i in range(len(cols)) for x in (
        F.col(f"{i}__NULLS"),
        (F.col(f"{i}__NULLS") * F.lit(100.0) / F.col("__n")).alias(f"{i}__MISSING_PCT"))])
    return _long(wide, cols, ["NULLS", "MISSING_PCT"])


def columns_with_missing(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Columns whose missing share is above 0, largest first."""
    return null_profile(df, cols).where(F.col("NULLS") > 0).orderBy(F.col("MISSING_PCT").desc(), "POS")


def correlation_long(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of every ordered pair (pairwise-complete rows), as
    (A, B, CORR).  Columns without NULLs share one pass over a vector (a
    Gramian); pairs with a NULL column are computed pair by pair."""
    nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(cols)]).first()
    if not any(nulls):
        vec = VectorAssembler(inputCols=list(cols), outputCol="v").transform(df).select("v")
        m = Correlation.corr(vec, "v").first()[0].toArray()
        rows = [(a, b, None if math.isnan(m[i, j]) else float(m[i, j])) for i, a in enumerate(cols) for j, b in enumerate(cols)]
        return df.sparkSession.createDataFrame(rows, "A string, B string, CORR double")
    pairs = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    wide = df.agg(*[F.corr(cols[i], cols[j]).alias(f"c_{i}_{j}") for i, j in pairs])
    structs = []
    for i, j in pairs:
        structs.append(F.struct(F.lit(cols[i]).alias("A"), F.lit(cols[j]).alias("B"),
                                F.col(f"c_{i}_{j}").alias("CORR")))
        if i != j:
            structs.append(F.struct(F.lit(cols[j]).alias("A"), F.lit(cols[i]).alias("B"),
                                    F.col(f"c_{i}_{j}").alias("CORR")))
    return wide.select(F.inline(F.array(*structs)))


def target_correlation_top(df: DataFrame, cols: Sequence[str], target: Column, k: int = 10) -> DataFrame:
    """|corr(column, target)| for each column, top k (ties by name)."""
    t = df.withColumn("__target", target.cast("double"))
    wide = t.agg(*[F.corr(c, "__target").alias(f"{i}__CORR") for i, c in enumerate(cols)])
    out = _long(wide, cols, ["CORR"]).withColumn("ABS_CORR", F.abs("CORR"))
    return out.orderBy(F.col("ABS_CORR").desc_nulls_last(), "COLUMN").limit(k).drop("POS")


def histogram(df: DataFrame, col: str, bins: int) -> DataFrame:
    """Fixed-width histogram over [min, max]; the last bin is closed.

    Two passes: a scalar min/max (two control values), then one grouped
    count of bucket ids (partial aggregation, ``bins`` groups)."""
    mm = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi")).first()
    lo, hi = mm["lo"], mm["hi"]
    if lo is None:
        return df.sparkSession.createDataFrame([], "BIN int, LOWER double, UPPER double, COUNT bigint")
    lo, hi = float(lo), float(hi)
    width = (hi - lo) / bins if hi > lo else 1.0
    x = F.col(col).cast("double")
    idx = F.least(F.floor((x - F.lit(lo)) / F.lit(hi - lo if hi > lo else 1.0) * F.lit(bins)),
                  F.lit(bins - 1)).cast("int")
    counts = df.where(F.col(col).isNotNull()).groupBy(idx.alias("BIN")).agg(F.count(F.lit(1)).alias("COUNT"))
    return counts.select("BIN", (F.lit(lo) + F.col("BIN") * F.lit(width)).alias("LOWER"),
                         (F.lit(lo) + (F.col("BIN") + 1) * F.lit(width)).alias("UPPER"), "COUNT")


def kde_grid(df: DataFrame, col: str, grid: int = 200, cut: float = 3.0) -> DataFrame:
    """Gaussian kernel density on an even grid (Scott bandwidth
    ``std * n^(-1/5)``, grid from min - cut*h to max + cut*h).

    The grid is a fixed number of points, so the density is ``grid`` sum
    aggregates in ONE pass over the rows: no join of grid x rows."""
    s = df.agg(F.count(col).alias("n"), F.stddev_samp(col).alias("sd"),
               F.min(col).alias("lo"), F.max(col).alias("hi")).first()
    n, sd = s["n"], s["sd"]
    if not n or sd is None or sd == 0:
        return df.sparkSession.createDataFrame([], "POINT int, X double, DENSITY double")
    h = float(sd) * n ** (-0.2)
    lo, hi = float(s["lo"]) - cut * h, float(s["hi"]) + cut * h
    xs = [lo + (hi - lo) * i / (grid - 1) for i in range(grid)]
    x = F.col(col).cast("double")
    norm = 1.0 / (n * h * math.sqrt(2 * math.pi))
    sums = df.where(F.col(col).isNotNull()).agg(
        *[F.sum(F.exp(F.lit(-0.5) * F.pow((F.lit(g) - x) / F.lit(h), 2))).alias(f"d{i}") for i, g in enumerate(xs)])
    structs = [F.struct(F.lit(i).alias("POINT"), F.lit(g).alias("X"), (F.col(f"d{i}") * F.lit(norm)).alias("DENSITY"))
               for i, g in enumerate(xs)]
    return sums.select(F.inline(F.array(*structs)))


def box_stats(df: DataFrame, col: str, whisker: float = 1.5) -> DataFrame:
    """Quartiles, IQR fences and the number of points outside them."""
    q1, med, q3 = exact_quantiles(df, [col], [0.25, 0.5, 0.75])[col]
    iqr = q3 - q1
    lo, hi = q1 - whisker * iqr, q3 + whisker * iqr
    c = F.col(col)
    return df.agg(
        F.lit(q1).alias("Q1"), F.lit(med).alias("MEDIAN"), F.lit(q3).alias("Q3"), F.lit(iqr).alias("IQR"),
        F.lit(lo).alias("LOWER_FENCE"), F.lit(hi).alias("UPPER_FENCE"),
        F.count_if(c < F.lit(lo)).alias("N_LOW"), F.count_if(c > F.lit(hi)).alias("N_HIGH"))


def top_variance(df: DataFrame, cols: Sequence[str], k: int = 5) -> DataFrame:
    """Columns with the largest sample variance (ties: column order)."""
    wide = df.agg(*[F.var_samp(c).alias(f"{i}__VARIANCE") for i, c in enumerate(cols)])
    return _long(wide, cols, ["VARIANCE"]).orderBy(F.col("VARIANCE").desc_nulls_last(), "POS").limit(k)


def zscore_outliers(df: DataFrame, col: str, z: float = 4.0) -> DataFrame:
    """Rows whose |x - mean| / std (sample) exceeds ``z``."""
    s = df.agg(F.avg(col).alias("m"), F.stddev_samp(col).alias("s")).first()
    if s["s"] is None or s["s"] == 0:
        return df.limit(0)
    return df.where(F.abs(F.col(col) - F.lit(s["m"])) / F.lit(s["s"]) > F.lit(z))
