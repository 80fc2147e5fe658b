"""Least-squares models from sums of products: every fold and penalty of a grid after one pass.

One aggregation yields, for each fold, the matrix of products of (1, features,
target), shifted by the columns' means so that no digits cancel.  The sums of
a training part are the total less the left-out fold's, so standardising,
ridge (a linear system), lasso and elastic net (coordinate descent) and the
left-out fold's R2 (a quadratic form) need no further pass over the rows.
The driver holds one matrix a fold; its width is the number of features.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def columns(batch: pa.RecordBatch, cols: Sequence[str]) -> np.ndarray:
    """The named columns as a matrix of doubles."""
    return np.column_stack([batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in cols]) if cols else np.zeros((batch.num_rows, 0))


def summed(parts: DataFrame) -> dict[int, np.ndarray]:
    """Element-wise sums of the arrays ``a`` by key ``k``: one row a key comes to the driver."""
    rows = parts.groupBy("k").agg(Summarizer.sum(array_to_vector("a")).alias("s")).collect()
    return {r["k"]: r["s"].toArray() for r in rows}


@dataclass
class LinearModel:
    """A fitted linear rule on raw columns; ``weights`` are those of the standardised ones."""
    features: list[str]
    coefficients: np.ndarray
    intercept: float
    weights: np.ndarray

    def predict(self) -> Column:
        terms = F.array(*[F.col(f"`{c}`").cast("double") * F.lit(float(v)) for c, v in zip(self.features, self.coefficients)])
        return F.lit(float(self.intercept)) + F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn("prediction", self.predict())

    def importances(self) -> list[float]:
        return np.abs(self.weights).tolist()


@dataclass
class Products:
    """Sums of products of z = (1, x - shift, y - shift) by fold."""
    features: list[str]
    shift: np.ndarray
    by_fold: dict[int, np.ndarray]

    def total(self, without: int | None = None) -> np.ndarray:
        return sum(a for f, a in self.by_fold.items() if f != without)


def products(df: DataFrame, features: Sequence[str], label: str = "label", fold: str | None = None) -> Products:
    """The sums of products of every fold (one fold 0 without a fold column)."""
    names = [*features, label]
    mean = df.agg(*[F.avg(F.col(f"`{c}`").cast("double")).alias(f"m{i}") for i, c in enumerate(names)]).first()
    shift = np.array([mean[f"m{i}"] or 0.0 for i in range(len(names))])
    size = len(names) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for b in batches:
            z = np.column_stack([np.ones(b.num_rows), columns(b, names) - shift])
            folds = b.column("__fold").to_numpy(zero_copy_only=False)
            for f in np.unique(folds).tolist():
                part = z[folds == f]
                found[f] = found.get(f, 0.0) + part.T @ part
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array([a.ravel() for a in found.values()], pa.list_(pa.float64()))],
                                             ["k", "a"])

    number = F.lit(0) if fold is None else F.col(fold)
    rows = df.select(*[F.col(f"`{c}`") for c in names], number.cast("long").alias("__fold"))
    sums = summed(rows.mapInArrow(run, "k long, a array<double>"))
    return Products(list(features), shift, {f: a.reshape(size, size) for f, a in sums.items()})


def _standardised(a: np.ndarray) -> tuple[float, np.ndarray, np.ndarray, np.ndarray, np.ndarray, float]:
    """(rows, means, population stds, correlation sums, target sums, target mean) of a matrix of products."""
    n = a[0, 0]
    mean = a[0, 1:] / n
    c = a[1:, 1:] - n * np.outer(mean, mean)
    std = np.sqrt(np.maximum(np.diag(c)[:-1], 0) / n)
    std[std <= 1e-12 * (1 + np.abs(mean[:-1]))] = 0.0
    use = np.where(std > 0, std, 1.0)
    g = c[:-1, :-1] / np.outer(use, use)
    g[std == 0, :] = g[:, std == 0] = 0.0
    r = np.where(std > 0, c[:-1, -1] / use, 0.0)
    return n, mean[:-1], use, g, r, mean[-1]


def ridge(g: np.ndarray, r: np.ndarray, n: float, alpha: float) -> np.ndarray:
    """Minimises |y - Xw|^2 + alpha |w|^2."""
    return np.linalg.solve(g + alpha * np.eye(len(g)), r)


def elastic_net(g: np.ndarray, r: np.ndarray, n: float, alpha: float, l1: float = 1.0, rounds: int = 10_000, tol: float = 1e-12) -> np.ndarray:
    """Minimises |y - Xw|^2 / 2n + alpha l1 |w|_1 + alpha (1 - l1) |w|^2 / 2 by coordinate descent on the sums."""
    w, gw = np.zeros(len(g)), np.zeros(len(g))
    soft, hard = n * alpha * l1, n * alpha * (1 - l1)
    size = np.diag(g)
    for _ in range(rounds):
        moved = 0.0
        for j in np.flatnonzero(size > 0):
            rho = r[j] - gw[j] + size[j] * w[j]
            new = np.sign(rho) * max(abs(rho) - soft, 0.0) / (size[j] + hard)
            if new != w[j]:
                gw += g[:, j] * (new - w[j])
                moved = max(moved, abs(new - w[j]))
                w[j] = new
        if moved <= tol * max(1.0, np.abs(w).max()):
            break
    return w


#: solvers by configured name; a grid point holds their keyword arguments
SOLVERS = {"ridge": ridge, "lasso": elastic_net, "elastic_net": elastic_net}


def solve(p: Products, name: str, without: int | None = None, **point: float) -> LinearModel:
    """The model of one grid point on all rows but those of the fold ``without``."""
    n, mean, std, g, r, target = _standardised(p.total(without))
    w = SOLVERS[name](g, r, n, **point)
    coef = w / std
    at = p.shift[:-1] + mean
    return LinearModel(p.features, coef, float(target + p.shift[-1] - coef @ at), w)


def r2(p: Products, model: LinearModel, fold: int) -> float:
    """R2 of a model on the rows of a fold, from their sums."""
    a = p.by_fold[fold]
    offset = model.intercept + model.coefficients @ p.shift[:-1] - p.shift[-1]
    u = np.concatenate([[-offset], -model.coefficients, [1.0]])
    total = a[-1, -1] - a[0, -1] ** 2 / a[0, 0]
    return float(1 - u @ a @ u / total)


def grid_search(train: DataFrame, features: Sequence[str], name: str, grid: Sequence[dict[str, float]], label: str = "label",
                fold: str = "FOLD", known: Products | None = None) -> tuple[LinearModel, list[float], list[float]]:
    """(best model on all rows, mean R2, std of R2 by grid point) over the folds; ties go to the first point."""
    p = products(train, features, label, fold) if known is None else known
    scores = np.array([[r2(p, solve(p, name, f, **point), f) for f in sorted(p.by_fold)] for point in grid])
    best = int(scores.mean(axis=1).argmax())
    return solve(p, name, None, **grid[best]), scores.mean(axis=1).tolist(), scores.std(axis=1).tolist()
