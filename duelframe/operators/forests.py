"""Grids of tree ensembles from one fit a fold and remaining axis.

Some axes of a grid are nested: a tree of depth 10 is the top of the same tree
grown to depth 30, 50 boosting rounds are the first half of 100, and a forest
of 100 trees is taken as the first 100 of 200.  Each fold is fitted once at the
largest depth and size; the saved nodes, which hold a prediction at every
level, then give the decision of every smaller depth and size in one pass over
the left-out rows.  For trees and boosting this equals separate fits; a smaller
forest differs from a separate fit only in its random draws.

The nodes of one ensemble are broadcast, as Spark ML does to score with it.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duelframe.operators.gram import columns, summed
from duelframe.session import checkpoint_dir


@dataclass
class Trees:
    """The nodes of an ensemble, tree after tree; children are node numbers, -1 at a leaf."""
    roots: np.ndarray
    weights: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray          # share of class 1, or the predicted number

    def staged(self, x: np.ndarray, depths: Sequence[int], sizes: Sequence[int]) -> np.ndarray:
        """Weighted sums of the first ``size`` trees cut at ``depth``: size x depth x row."""
        out = np.zeros((len(sizes), len(depths), len(x)))
        for t, (root, weight) in enumerate(zip(self.roots.tolist(), self.weights.tolist())):
            if t >= max(sizes):
                break
            at, rows, level = np.full(len(x), root), np.arange(len(x)), 0
            for d, depth in sorted((d, i) for i, d in enumerate(depths)):
                while level < d and len(rows):
                    node = at[rows]
                    inner = self.left[node] >= 0
                    if not inner.all():                        # rows that reached a leaf stay there
                        rows, node = rows[inner], node[inner]
                    go = x[rows, self.feature[node]] <= self.threshold[node]
                    at[rows] = np.where(go, self.left[node], self.right[node])
                    level += 1
                for s, size in enumerate(sizes):
                    if t < size:
                        out[s, depth] += weight * self.value[at]
        return out


def trees_of(model, shares: bool) -> Trees:
    """The nodes of a fitted Spark ML tree or ensemble; ``shares``: class shares instead of predictions."""
    from pyspark.sql import SparkSession
    spark = SparkSession.active()
    path = f"{checkpoint_dir(spark).rstrip('/')}/trees-{uuid.uuid4().hex}"
    model.write().save(path)
    data = spark.read.parquet(f"{path}/data")
    node = "nodeData." if "nodeData" in data.columns else ""
    tree = F.col("treeID") if node else F.lit(0)
    stats = F.col(f"{node}impurityStats")
    value = stats[1] / F.aggregate(stats, F.lit(0.0), lambda a, v: a + v) if shares else F.col(f"{node}prediction")
    nodes = data.select(tree.alias("tree"), F.col(f"{node}id").alias("id"), F.col(f"{node}leftChild").alias("left"),
                        F.col(f"{node}rightChild").alias("right"), F.col(f"{node}split.featureIndex").alias("feature"),
                        F.coalesce(F.get(f"{node}split.leftCategoriesOrThreshold", F.lit(0)), F.lit(0.0)).alias("threshold"),
                        value.alias("value")).toPandas().sort_values(["tree", "id"])
    number = nodes["tree"].to_numpy()
    first = np.flatnonzero(np.append(True, number[1:] != number[:-1]))
    offset = np.repeat(first, np.diff(np.append(first, len(number))))
    left, right = nodes["left"].to_numpy(), nodes["right"].to_numpy()
    weights = np.array(getattr(model, "treeWeights", [1.0]), float)
    return Trees(first, weights, nodes["feature"].to_numpy(), nodes["threshold"].to_numpy(),
                 np.where(left >= 0, left + offset, -1), np.where(right >= 0, right + offset, -1), nodes["value"].to_numpy())


def staged_scores(rows: DataFrame, features: Sequence[str], trees: Trees, depths: Sequence[int], sizes: Sequence[int],
                  kind: str, label: str = "label") -> np.ndarray:
    """Accuracy ("share": mean share above 1/2; "margin": sum above 0) or R2 ("mean", "sum") of every size and depth, in one pass."""
    shared = rows.sparkSession.sparkContext.broadcast(trees)
    names, shape = list(features), (len(sizes), len(depths))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((*shape, 4))
        for b in batches:
            x, y = columns(b, names), b.column("__y").to_numpy(zero_copy_only=False)
            f = shared.value.staged(x, depths, sizes)
            if kind in ("share", "mean"):
                f = f / np.array(sizes, float)[:, None, None]
            if kind in ("share", "margin"):
                miss = ((f > (0.5 if kind == "share" else 0.0)) != (y > 0)).sum(axis=2)
            else:
                miss = ((f - y) ** 2).sum(axis=2)
            total += np.stack(np.broadcast_arrays(len(y), y.sum(), (y * y).sum(), miss), axis=-1)
        yield pa.RecordBatch.from_arrays([pa.array([0], pa.int64()), pa.array([total.ravel()], pa.list_(pa.float64()))], ["k", "a"])

    asked = rows.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in names], F.col(label).cast("double").alias("__y"))
    n, s, q, miss = np.moveaxis(summed(asked.mapInArrow(run, "k long, a array<double>"))[0].reshape(*shape, 4), -1, 0)
    return 1 - miss / n if kind in ("share", "margin") else 1 - miss / (q - s * s / n)
