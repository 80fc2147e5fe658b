"""Anomaly detection: isolation forest, local outlier factor, one-class models, consensus.

Isolation forest: every tree id draws its own hash sample of at most 256
rows (a row joins tree t when its key hash salted by t falls below the
sampling rate; an ``explode`` of tree ids bounded by n_trees, then a
per-tree cap by ``row_number`` over a bounded hash order).  Trees are grown
in ``groupBy(tree).applyInPandas``: each group holds at most ``max_samples``
rows, so no task ever sees more.  The grown forest is a few thousand nodes
(bounded by n_trees * 2 * max_samples; max_samples = 256 is the algorithm's
own definition of a tree) and is broadcast to score all rows
with ``mapInPandas`` (Arrow batches).  The contamination threshold is a
percentile of the scores.

One-class support vectors: the nu objective in random-feature space, solved by
Newton steps on aggregated derivatives (`newton`).

Kernel density (kernel form): random Fourier features approximate the RBF
kernel; the mean embedding of all rows is ONE aggregation; a row's score is
its kernel similarity to that mean.  Rows in the lowest ``nu`` share are
anomalies.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from duelframe.operators import gram, newton
from duelframe.operators.neighbours import local_outlier_factor
from duelframe.operators.quantiles import exact_quantiles
from duelframe.session import materialise

_SCALE = float(2 ** 63)


def _c(n: int) -> float:
    """Average path length of an unsuccessful BST search over n points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1) + 0.5772156649015329) - 2.0 * (n - 1) / n


def _grow(pdf: pd.DataFrame, cols: Sequence[str], max_depth: int, seed: int) -> pd.DataFrame:
    """Grow one isolation tree; nodes as rows (id, feature, split, left, right, size)."""
    tree = int(pdf["TREE"].iloc[0])
    rng = np.random.default_rng(seed * 100003 + tree)
    X = pdf[list(cols)].to_numpy(dtype=float)
    nodes = []

    def build(idx, depth):
        nid = len(nodes)
        nodes.append([tree, nid, -1, 0.0, -1, -1, len(idx)])
        if depth >= max_depth or len(idx) <= 1:
            return nid
        sub = X[idx]
        spread = sub.max(axis=0) - sub.min(axis=0)
        cand = np.flatnonzero(spread > 0)
        if cand.size == 0:
            return nid
        f = int(rng.choice(cand))
        lo, hi = sub[:, f].min(), sub[:, f].max()
        s = float(rng.uniform(lo, hi))
        left = idx[sub[:, f] < s]
        right = idx[sub[:, f] >= s]
        nodes[nid][2], nodes[nid][3] = f, s
        nodes[nid][4] = build(left, depth + 1)
        nodes[nid][5] = build(right, depth + 1)
        return nid

    build(np.arange(len(X)), 0)
    return pd.DataFrame(nodes, columns=["TREE", "NODE", "FEATURE", "SPLIT", "LEFT", "RIGHT", "SIZE"])


def isolation_forest(df: DataFrame, cols: Sequence[str], keys: Sequence[str], n_trees: int = 100,
                     max_samples: int = 256, contamination: float = 0.1, seed: int = 42) -> DataFrame:
    """keys + ANOMALY_SCORE (higher = more anomalous, 2^(-E[h]/c(psi))),
    DECISION (threshold - score, negative for anomalies) and IS_ANOMALY."""
    spark = df.sparkSession
    n = df.count()
    psi = min(max_samples, n)
    rate = min(1.0, 2.0 * psi / max(n, 1))

    def draw(tree):
        return F.abs(F.xxhash64(*[F.col(k) for k in keys], tree, F.lit(seed)).cast("double")) / F.lit(_SCALE)

    # a row's trees are picked first, so a row is copied only for those
    own = F.filter(F.transform(F.sequence(F.lit(0), F.lit(n_trees - 1)), lambda t: F.struct(t.alias("TREE"), draw(t).alias("__h"))),
                   lambda x: x["__h"] < F.lit(rate))
    cand = df.withColumn("__own", own).where(F.size("__own") > 0).select(*keys, *cols, F.inline("__own"))
    cand = cand.withColumn("__r", F.row_number().over(W.partitionBy("TREE").orderBy("__h", *keys))) \
               .where(F.col("__r") <= psi).drop("__h", "__r")
    max_depth = int(math.ceil(math.log2(max(psi, 2))))
    schema = "TREE int, NODE int, FEATURE int, SPLIT double, LEFT int, RIGHT int, SIZE int"
    forest = cand.groupBy("TREE").applyInPandas(lambda p: _grow(p, cols, max_depth, seed), schema)
    nodes = forest.orderBy("TREE", "NODE").toPandas()  # bounded: n_trees * (2 * psi - 1) rows
    bc = spark.sparkContext.broadcast(nodes)
    cpsi = _c(psi)
    key_cols = list(keys)

    def score(it):
        nd = bc.value
        per_tree = [g.sort_values("NODE").to_numpy() for _, g in nd.groupby("TREE")]
        c_of = np.vectorize(_c)
        for pdf in it:
            X = pdf[list(cols)].to_numpy(dtype=float)
            rows = np.arange(len(X))
            depth = np.zeros(len(X))
            for t in per_tree:  # all rows descend one tree together (vectorised)
                node = np.zeros(len(X), dtype=int)
                d = np.zeros(len(X))
                for _ in range(max_depth + 1):
                    feat = t[node, 2].astype(int)
                    internal = feat >= 0
                    if not internal.any():
                        break
                    xv = X[rows, np.where(internal, feat, 0)]
                    nxt = np.where(xv < t[node, 3], t[node, 4], t[node, 5]).astype(int)
                    node = np.where(internal, nxt, node)
                    d += internal
                depth += d + c_of(t[node, 6].astype(int))
            s = np.power(2.0, -(depth / len(per_tree)) / cpsi) if cpsi > 0 else np.zeros(len(X))
            out = pdf[key_cols].copy()
            out["ANOMALY_SCORE"] = s
            yield out

    key_schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.select(*keys).schema.fields)
    scored = df.select(*keys, *cols).mapInPandas(score, f"{key_schema}, ANOMALY_SCORE double")
    thr = exact_quantiles(scored, ["ANOMALY_SCORE"], [1.0 - contamination])["ANOMALY_SCORE"][0]
    return scored.withColumns({"DECISION": F.lit(float(thr)) - F.col("ANOMALY_SCORE"),
                               "IS_ANOMALY": (F.col("ANOMALY_SCORE") > F.lit(float(thr))).cast("int")})


def rff_one_class(df: DataFrame, cols: Sequence[str], keys: Sequence[str], nu: float = 0.1,
                  n_features: int = 200, gamma: float | None = None, seed: int = 42) -> DataFrame:
    """keys + SCORE (kernel similarity to the data's mean embedding; low =
    anomalous), DECISION (score - threshold) and IS_ANOMALY (lowest nu share).

    gamma defaults to 1 / (d * var) as scikit-learn's 'scale'."""
    d = len(cols)
    if gamma is None:
        var = df.agg(F.avg(sum((F.col(c) * F.col(c) for c in cols), F.lit(0.0)) / F.lit(d)).alias("m2"),
                     *[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)]).first()
        mean_sq = sum(var[f"m{i}"] ** 2 for i in range(d)) / d
        v = var["m2"] - mean_sq
        gamma = 1.0 / (d * v) if v > 0 else 1.0
    rng = np.random.default_rng(seed)
    Wm = rng.normal(0.0, math.sqrt(2.0 * gamma), size=(n_features, d))
    b = rng.uniform(0.0, 2 * math.pi, size=n_features)
    scale = math.sqrt(2.0 / n_features)
    names = list(cols)

    def features(pdf: pd.DataFrame) -> np.ndarray:
        return scale * np.cos(pdf[names].to_numpy(dtype=float) @ Wm.T + b)

    def sums(it):                                       # one row a task: its count and sum of features
        n, total = 0, np.zeros(n_features)
        for pdf in it:
            n, total = n + len(pdf), total + features(pdf).sum(axis=0)
        yield pd.DataFrame({"n": [n], "z": [total.tolist()]})

    part = df.select(*cols).mapInPandas(sums, "n long, z array<double>").select("n", F.posexplode("z").alias("j", "z"))
    rows = part.groupBy("j").agg(F.sum("z").alias("z"), F.sum("n").alias("n")).collect()
    mu = np.zeros(n_features)
    for r in rows:
        mu[r["j"]] = r["z"] / max(r["n"], 1)

    def score(it):
        for pdf in it:
            yield pdf[list(keys)].assign(SCORE=features(pdf) @ mu)

    key_schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.select(*keys).schema.fields)
    scored = df.select(*keys, *cols).mapInPandas(score, f"{key_schema}, SCORE double")
    thr = exact_quantiles(scored, ["SCORE"], [nu])["SCORE"][0]
    return scored.withColumns({"DECISION": F.col("SCORE") - F.lit(float(thr)),
                               "IS_ANOMALY": (F.col("SCORE") < F.lit(float(thr))).cast("int")})


def one_class_svm(df: DataFrame, cols: Sequence[str], keys: Sequence[str], nu: float = 0.1) -> DataFrame:
    """keys + SCORE (w . features), DECISION (score - rho) and IS_ANOMALY
    (decision below 0) of the one-class support vector machine with an RBF
    kernel in random-feature space; about the share ``nu`` is anomalous.

    gamma is one over the number of columns, which are standardised."""
    rows = materialise(df.select(*keys, *cols).withColumn("__one", F.lit(1.0)), "one_class")
    sums = gram.products(rows, cols, "__one")
    problem = newton.one_class_problem(sums, nu, int(sums.total()[0, 0]))
    model = newton.minimise(rows, cols, [problem], "__one")[0]
    found = model.transform(rows, keys, "decision")
    return found.select(*keys, (F.col("decision") - F.lit(model.intercept)).alias("SCORE"), F.col("decision").alias("DECISION"),
                        (F.col("decision") < 0).cast("int").alias("IS_ANOMALY"))


def zscore_detector(df: DataFrame, cols: Sequence[str], keys: Sequence[str], contamination: float = 0.1) -> DataFrame:
    """Distance-from-centre detector on standardised columns (sum of squared
    z-scores); the top ``contamination`` share are anomalies."""
    stats = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)],
                   *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(cols)]).first()
    terms = [((F.col(c) - F.lit(stats[f"m{i}"])) / F.lit(stats[f"s{i}"] or 1.0)) ** 2 for i, c in enumerate(cols)]
    scored = df.select(*keys, sum(terms, F.lit(0.0)).alias("SCORE"))
    thr = exact_quantiles(scored, ["SCORE"], [1.0 - contamination])["SCORE"][0]
    return scored.withColumns({"DECISION": F.lit(float(thr)) - F.col("SCORE"),
                               "IS_ANOMALY": (F.col("SCORE") > F.lit(float(thr))).cast("int")})


def local_outliers(df: DataFrame, cols: Sequence[str], keys: Sequence[str], k: int = 20, contamination: float = 0.1) -> DataFrame:
    """keys + K_DISTANCE, DENSITY, SCORE (local outlier factor, high =
    anomalous), DECISION (threshold - score) and IS_ANOMALY (factors above
    the 1 - ``contamination`` quantile; rows without a factor are none)."""
    scored = materialise(local_outlier_factor(df, cols, keys, k).withColumnRenamed("OUTLIER_FACTOR", "SCORE"), "lof")
    thr = exact_quantiles(scored, ["SCORE"], [1.0 - contamination])["SCORE"][0]
    bound = F.lit(thr).cast("double")
    return scored.withColumns({"DECISION": bound - F.col("SCORE"),
                               "IS_ANOMALY": F.coalesce((F.col("SCORE") > bound).cast("int"), F.lit(0))})


def compare_detectors(labels: dict[str, DataFrame]) -> DataFrame:
    """Per detector: rows, anomalies and anomaly percentage."""
    out = None
    for name, lab in labels.items():
        part = lab.agg(F.count(F.lit(1)).alias("ROWS"), F.sum("IS_ANOMALY").alias("ANOMALIES")) \
                  .withColumn("DETECTOR", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out.withColumn("ANOMALY_PCT", F.col("ANOMALIES") * F.lit(100.0) / F.col("ROWS"))


def consensus(labels: dict[str, DataFrame], keys: Sequence[str], min_votes: int = 2) -> DataFrame:
    """keys + VOTES (number of detectors flagging the row) + IS_CONSENSUS."""
    out = None
    for name, lab in labels.items():
        part = lab.select(*keys, F.col("IS_ANOMALY").alias(f"__{name}"))
        out = part if out is None else out.join(part, list(keys), "full")
    votes = sum((F.coalesce(F.col(f"__{n}"), F.lit(0)) for n in labels), F.lit(0))
    return out.select(*keys, votes.alias("VOTES"), (votes >= min_votes).cast("int").alias("IS_CONSENSUS"))
