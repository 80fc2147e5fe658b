"""Standardisation with the population standard deviation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duelframe.operators.quantiles import exact_quantiles


@dataclass(frozen=True)
class Standardizer:
    """Fitted means and population stds (2 numbers per column)."""
    cols: tuple[str, ...]
    means: tuple[float, ...]
    stds: tuple[float, ...]

    def transform(self, df: DataFrame, suffix: str = "") -> DataFrame:
        """``(x - mean) / std``; a constant column (std 0) becomes 0."""
        out = {}
        for c, m, s in zip(self.cols, self.means, self.stds):
            z = (F.col(c) - F.lit(m)) / F.lit(s) if s else F.lit(0.0)
            out[c + suffix] = z
        return df.withColumns(out)


def fit_standardizer(df: DataFrame, cols: Sequence[str]) -> Standardizer:
    """One aggregation pass: mean and population std of every column."""
    row = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)],
                 *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(cols)]).first()
    return Standardizer(tuple(cols), tuple(float(row[f"m{i}"] or 0.0) for i in range(len(cols))),
                        tuple(float(row[f"s{i}"] or 0.0) for i in range(len(cols))))


def standardize(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return fit_standardizer(df, cols).transform(df)


def median_fill(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """NULLs of the given columns -> exact column median."""
    nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(cols)]).first()
    need = [c for i, c in enumerate(cols) if nulls[f"n{i}"]]
    fills = {c: q[0] for c, q in exact_quantiles(df, need, [0.5]).items() if q[0] is not None}
    return df.fillna(fills) if fills else df
