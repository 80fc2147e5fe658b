"""Segmentation: K-means family, density clustering, metrics, interpretation.

Fits use Spark ML estimators (iterative, each iteration a distributed
aggregation).  Metrics are computed from per-cluster sufficient statistics
(count, coordinate sums, sum of squared norms): k rows, collected as
control values, then one pass over the points.  No pair of points is ever
materialised.

Silhouette: the Euclidean form needs every pairwise distance.  Blocks of
points meet pairwise (upper triangle) and a pair of blocks leaves one sum of
distances a point and label, so no pair of points becomes a row; the work still
grows with the square of the points.  The squared-Euclidean form (the one
Spark ML's ``ClusteringEvaluator`` defines) decomposes into per-cluster sums,
mean_{y in C} |x - y|^2 = |x|^2 - 2 x.mu_C + mean_C |y|^2, and takes one pass;
it is a different number and has its own name.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml.clustering import BisectingKMeans, KMeans
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from duelframe.functions.columns import round_even
from duelframe.operators import neighbours as nb
from duelframe.operators.gram import summed
from duelframe.session import materialise


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="error").transform(df)


LARGE_BLOCK = 16384  # most points of a block that a silhouette compares, about
CELLS = 1 << 21    # distances that a task holds at once
N_INIT = 10        # fixed value: the configured number of restarts
AT_ONCE = 8        # fits submitted at the same time


def kmeans_best_of(df: DataFrame, k: int, seed: int = 42, n_init: int = N_INIT, features: str = "features",
                   max_iter: int = 300, tol: float = 1e-4):
    """Fit K-means ``n_init`` times (seeds seed..seed+n_init-1) and keep the
    lowest cost (ties: the first seed).  The fits are independent jobs,
    submitted side by side."""
    def fit(i: int):
        m = KMeans(k=k, seed=seed + i, featuresCol=features, maxIter=max_iter, tol=tol).fit(df)
        return m.summary.trainingCost, i, m

    with ThreadPoolExecutor(AT_ONCE) as pool:
        found = list(pool.map(inheritable_thread_target(df.sparkSession)(fit), range(n_init)))
    return min(found, key=lambda t: t[:2])[2]


SEED_POINTS = 4096  # most points, drawn by a hash, that first centres are chosen from


def _first_centres(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """k-means++: each next centre is a point drawn in proportion to its squared distance from the chosen ones."""
    out = [x[rng.integers(len(x))]]
    near = ((x - out[0]) ** 2).sum(axis=1)
    for _ in range(1, k):
        p = near / near.sum() if near.sum() > 0 else np.full(len(x), 1 / len(x))
        out.append(x[rng.choice(len(x), p=p)])
        near = np.minimum(near, ((x - out[-1]) ** 2).sum(axis=1))
    return np.array(out)


def kmeans_grid(df: DataFrame, cols: Sequence[str], ks: Sequence[int], seed: int = 42, n_init: int = N_INIT,
                max_iter: int = 300, tol: float = 1e-4) -> dict[int, tuple[float, np.ndarray]]:
    """k -> (cost, centres) of the best of ``n_init`` K-means fits for every k.

    All restarts of all k run side by side: a pass over the rows assigns them
    to the centres of every fit that still moves and yields counts and sums by
    centre.  First centres come from a bounded, hash-drawn set of points; ties
    in cost go to the first restart.  ``df`` is read again in every pass."""
    cols = list(cols)
    x = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    drawn = np.array([list(r) for r in x.orderBy(F.xxhash64(*cols), *cols).limit(SEED_POINTS).collect()], float)
    fits = [(k, i) for k in ks for i in range(n_init)]
    centres = {f: _first_centres(drawn, k, np.random.default_rng([seed + i, k])) for f, (k, i) in enumerate(fits)}
    open_, settled, cost = set(centres), set(), {}
    for step in range(max_iter + 1):
        todo = {f: centres[f] for f in sorted(open_)}

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = {f: np.zeros(len(c) * (len(cols) + 1) + 1) for f, c in todo.items()}
            for b in batches:
                v = np.column_stack([b.column(c).to_numpy(zero_copy_only=False) for c in cols])
                for i in range(0, len(v), 4096):
                    part = v[i:i + 4096]
                    norm = (part * part).sum(axis=1)
                    for f, c in todo.items():
                        d = norm[:, None] - 2 * part @ c.T + (c * c).sum(axis=1)
                        at = d.argmin(axis=1)
                        own = np.zeros((len(c), len(cols) + 1))
                        np.add.at(own, at, np.column_stack([np.ones(len(part)), part]))
                        total[f] += np.append(own.ravel(), np.maximum(d[np.arange(len(part)), at], 0).sum())
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.list_(pa.float64()))], ["k", "a"])

        for f, a in summed(x.mapInArrow(run, "k long, a array<double>")).items():
            cost[f] = float(a[-1])
            own = a[:-1].reshape(len(centres[f]), -1)
            new = np.where(own[:, :1] > 0, own[:, 1:] / np.maximum(own[:, :1], 1), centres[f])
            if f in settled or step == max_iter:
                open_.discard(f)                            # this pass took the cost of the last centres
                continue
            if np.sqrt(((new - centres[f]) ** 2).sum(axis=1).max()) <= tol:
                settled.add(f)
            centres[f] = new
        if not open_:
            break
    best = {k: min((cost[f], i, f) for f, (q, i) in enumerate(fits) if q == k)[2] for k in ks}
    return {k: (cost[f], centres[f]) for k, f in best.items()}


def total_sum_of_squares(df: DataFrame, cols: Sequence[str]) -> float:
    """Within-cluster sum of squares for k = 1 (one pass)."""
    row = df.agg(F.count(F.lit(1)).alias("n"),
                 *[F.sum(c).alias(f"s{i}") for i, c in enumerate(cols)],
                 *[F.sum(F.col(c) * F.col(c)).alias(f"q{i}") for i, c in enumerate(cols)]).first()
    n = row["n"]
    return float(sum(row[f"q{i}"] - row[f"s{i}"] ** 2 / n for i in range(len(cols))))


def elbow_choice(costs: DataFrame) -> DataFrame:
    """Successive drops, second differences (the last drop unused) and the
    suggested k = argmax(second difference) + 2 (ties: lowest k; 3 when there
    is no second difference).  Windows over the k-row cost table."""
    w = W.orderBy("K")
    every = W.orderBy("K").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    c = costs.withColumn("DROP", F.lag("COST").over(w) - F.col("COST"))
    c = c.withColumn("CURVATURE", F.lag("DROP").over(w) - F.col("DROP"))
    c = c.withColumn("CURVATURE", F.when(F.col("K") < F.max("K").over(every), F.col("CURVATURE")))
    order = F.when(F.col("CURVATURE").isNotNull(), F.struct(F.col("CURVATURE"), -F.col("K")))
    best = F.max_by(F.col("K") - 1, order).over(every)
    return c.withColumn("SUGGESTED_K", F.coalesce(best, F.lit(3)).cast("int"))


def relabel_by_first_key(labels: DataFrame, keys: Sequence[str], label: str = "label") -> DataFrame:
    """Renumber clusters 0..k-1 in order of their smallest key (stable ids
    across runs); -1 stays -1."""
    first = labels.where(F.col(label) != -1).groupBy(label).agg(F.min(F.struct(*keys)).alias("__first"))
    first = first.withColumn("__new", F.row_number().over(W.orderBy("__first")) - 1)
    m = first.select(F.col(label).alias("__old"), "__new")
    out = labels.join(F.broadcast(m), F.col(label) == F.col("__old"), "left")
    return out.withColumn(label, F.coalesce(F.col("__new"), F.lit(-1))).drop("__old", "__new")


def kmeans_labels(df: DataFrame, cols: Sequence[str], k: int, keys: Sequence[str] = ("TEAM_ID", "SEASON"),
                  seed: int = 42, n_init: int = N_INIT) -> tuple[DataFrame, np.ndarray]:
    """(keys, label) of the best K-means fit, and its centres."""
    centres = kmeans_grid(df, cols, [k], seed, n_init)[k][1]
    return nearest_centres(df, cols, centres, keys), centres


def nearest_centres(df: DataFrame, cols: Sequence[str], centres: np.ndarray, keys: Sequence[str] = ("TEAM_ID", "SEASON")) -> DataFrame:
    """(keys, label) by the nearest centre (ties: the first), numbered by the clusters' first keys."""
    far = [_sq_dist(_vec(cols), c) for c in centres]
    place = F.array_position(F.array(*far), F.array_min(F.array(*far))) - 1
    return relabel_by_first_key(materialise(df.select(*keys, place.cast("int").alias("label")), "kmeans"), keys)


def bisecting_labels(df: DataFrame, cols: Sequence[str], k: int, keys: Sequence[str] = ("TEAM_ID", "SEASON"),
                     seed: int = 42, shift: float = 10.0) -> DataFrame:
    """Hierarchical (divisive) clustering standing in for Ward agglomeration.
    Features are shifted by a constant first: on zero-mean data Spark's
    bisecting split can leave one side empty."""
    shifted = df.withColumns({c: F.col(c) + F.lit(shift) for c in cols})
    data = assemble(shifted, cols)
    model = BisectingKMeans(k=k, seed=seed, featuresCol="features").fit(data)
    lab = model.transform(data).select(*keys, F.col("prediction").alias("label"))
    return relabel_by_first_key(lab, keys)


# ------------------------------------------------------------------ Ward
SUMMARIES = 2000   # most clustering features that are agglomerated
FAN_IN = 8         # tables of features that one task merges


def _absorb(kept: list[np.ndarray], new: list[np.ndarray], limit: float, most: int) -> list[np.ndarray] | None:
    """Clustering features with ``new`` ones merged in: each joins the nearest kept one if the radius of
    both together stays within ``limit``, else it is kept itself.  None beyond ``most`` kept ones."""
    n, s, q = new
    while len(n):
        if len(kept[0]):
            c = kept[1] / kept[0][:, None]
            at = nb.distances(s / n[:, None], c).argmin(axis=1)
            m, t, u = kept[0][at] + n, kept[1][at] + s, kept[2][at] + q
            joins = u / m - ((t / m[:, None]) ** 2).sum(axis=1) <= limit
            for k, part in enumerate((n, s, q)):
                np.add.at(kept[k], at[joins], part[joins])
            n, s, q = n[~joins], s[~joins], q[~joins]
        if len(n):                                          # the first that is far from all is kept
            kept = [np.concatenate([x, y[:1]]) for x, y in zip(kept, (n, s, q))]
            if len(kept[0]) > most:
                return None
            n, s, q = n[1:], s[1:], q[1:]
    return kept


def condense(n: np.ndarray, s: np.ndarray, q: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """At most ``most`` clustering features (count, sum, sum of squared norms) for the given ones.

    Equal centres are added up, which loses nothing; if too many are left,
    near ones are merged under a threshold that grows until few enough are."""
    centre, at = np.unique(s / n[:, None], axis=0, return_inverse=True)
    at = at.ravel()
    out = [np.bincount(at, n, len(centre)), np.zeros_like(centre), np.bincount(at, q, len(centre))]
    np.add.at(out[1], at, s)
    limit = 0.0
    while len(out[0]) > most:
        # what it takes to merge the features of a part of them with their nearest ones
        c = out[1] / out[0][:, None]
        some = np.arange(0, len(c), max(1, len(c) // 100))
        d = nb.distances(c[some], c) ** 2
        d[np.arange(len(some)), some] = np.inf
        limit = max(limit * 2, float(np.quantile(d.min(axis=1), 0.25)) / 4)
        kept: list[np.ndarray] | None = [x[:0] for x in out]
        for i in range(0, len(out[0]), nb.SLICE):
            kept = _absorb(kept, [x[i:i + nb.SLICE] for x in out], limit, most)
            if kept is None:
                break
        if kept is not None:
            out = kept
    return out[0], out[1], out[2]


def ward_merges(n: np.ndarray, centre: np.ndarray) -> list[tuple[float, int, int]]:
    """(cost, a, b) of Ward's agglomeration of weighted points by nearest-neighbour chains, cheapest first.

    ``a`` and ``b`` are points that stand for their groups; a merge costs
    n_a n_b / (n_a + n_b) times the squared distance of the centres."""
    n, c = n.astype(float).copy(), centre.astype(float).copy()
    alive = np.ones(len(n), bool)
    chain: list[int] = []
    out = []
    while alive.sum() > 1:
        if not chain:
            chain.append(int(np.flatnonzero(alive)[0]))
        a = chain[-1]
        cost = n * n[a] / (n + n[a]) * ((c - c[a]) ** 2).sum(axis=1)
        cost[~alive] = np.inf
        cost[a] = np.inf
        b = int(cost.argmin())
        if len(chain) > 1 and cost[chain[-2]] <= cost[b]:
            b = chain[-2]                                   # neighbours of each other
            out.append((float(cost[b]), min(a, b), max(a, b)))
            keep, drop = min(a, b), max(a, b)
            c[keep] = (n[a] * c[a] + n[b] * c[b]) / (n[a] + n[b])
            n[keep] = n[a] + n[b]
            alive[drop] = False
            del chain[-2:]
        else:
            chain.append(b)
    return sorted(out, key=lambda m: m[0])


def ward_cut(merges: list[tuple[float, int, int]], points: int, k: int) -> np.ndarray:
    """Group number of every point after the cheapest merges that leave ``k`` groups."""
    root = list(range(points))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for _, a, b in merges[:max(0, points - k)]:
        ra, rb = find(a), find(b)
        root[max(ra, rb)] = min(ra, rb)
    return np.unique([find(i) for i in range(points)], return_inverse=True)[1]


def ward_labels(df: DataFrame, cols: Sequence[str], k: int, keys: Sequence[str] = ("TEAM_ID", "SEASON"),
                most: int = SUMMARIES, fan_in: int = FAN_IN) -> DataFrame:
    """Ward agglomeration to ``k`` groups over clustering features (keys, label).

    Every task condenses its points to at most ``most`` features, ``fan_in``
    tables of them are merged and condensed at a time until one is left, and
    those are agglomerated in one task; a point goes with the nearest of the
    final features.  With at most ``most`` distinct points every point is a
    feature of its own and the result is Ward's."""
    cols = list(cols)
    schema = "part long, n double, s array<double>, q double"

    def batch(part: int, n, s, q) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(n), part)), pa.array(n), pa.array(s.tolist(), pa.list_(pa.float64())), pa.array(q)],
                                          ["part", "n", "s", "q"])

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        held = None
        for b in batches:
            x = np.column_stack([b.column(c).to_numpy(zero_copy_only=False).astype(float) for c in cols])
            new = (np.ones(len(x)), x, (x * x).sum(axis=1))
            held = condense(*(new if held is None else [np.concatenate(p) for p in zip(held, new)]), most)
        if held is not None and len(held[0]):
            yield batch(TaskContext.get().partitionId(), *held)

    def merge(key, table):
        n, q = (table.column(c).to_numpy() for c in ("n", "q"))
        s = np.array(table.column("s").to_pylist(), float)
        return pa.Table.from_batches([batch(key[0].as_py(), *condense(n, s, q, most))])

    found = materialise(df.select(*cols).mapInArrow(collect, schema), "features")
    parts = (found.agg(F.max("part")).first()[0] or 0) + 1
    while True:
        # round by round, so that no task merges more than fan_in tables
        found = materialise(found.withColumn("part", F.floor(F.col("part") / fan_in)).groupBy("part").applyInArrow(merge, schema), "features")
        parts = -(-parts // fan_in)
        if parts == 1:
            break

    def agglomerate(key, table):
        n = table.column("n").to_numpy()
        centre = np.array(table.column("s").to_pylist(), float) / n[:, None]
        label = ward_cut(ward_merges(n, centre), len(n), k)
        return pa.table({"centre": pa.array(centre.tolist(), pa.list_(pa.float64())), "label": pa.array(label.astype(np.int32))})

    groups = found.groupBy("part").applyInArrow(agglomerate, "centre array<double>, label int").collect()    # at most ``most`` rows
    centres, label = np.array([g["centre"] for g in groups], float), np.array([g["label"] for g in groups], np.int32)

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.column_stack([b.column(c).to_numpy(zero_copy_only=False).astype(float) for c in cols])
            at = [nb.distances(x[i:i + nb.SLICE], centres).argmin(axis=1) for i in range(0, len(x), nb.SLICE)]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keys], pa.array(label[np.concatenate(at)] if at else label[:0])],
                                             [*keys, "label"])

    key_schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.select(*keys).schema.fields)
    # a named key may also be a feature
    named = df.select(*keys, *[c for c in cols if c not in keys]).mapInArrow(nearest, f"{key_schema}, label int")
    return relabel_by_first_key(materialise(named, "ward"), keys)


@dataclass
class PCAResult:
    scores: DataFrame          # keys + PC_1..PC_m
    variance: DataFrame        # PC, VARIANCE_SHARE, CUMULATIVE
    loadings: DataFrame        # PC, FEATURE, LOADING
    n_components: int


def pca(df: DataFrame, cols: Sequence[str], k: int, keys: Sequence[str] = ("TEAM_ID", "SEASON")) -> PCAResult:
    """PCA on (already standardised) columns.  Spark's PCAModel.transform
    does not centre, so the input is centred first; each component's sign
    is fixed so its largest-|loading| entry is positive."""
    spark = df.sparkSession
    means = df.agg(*[F.avg(c).alias(c) for c in cols]).first()
    centred = df.withColumns({c: F.col(c) - F.lit(float(means[c] or 0.0)) for c in cols})
    data = assemble(centred, cols)
    k = min(k, len(cols))
    model = PCA(k=k, inputCol="features", outputCol="pcs").fit(data)
    comps = model.pc.toArray()                        # d x k
    signs = np.sign(comps[np.abs(comps).argmax(axis=0), range(k)])
    signs[signs == 0] = 1.0
    ratio = model.explainedVariance.toArray()
    arr = vector_to_array("pcs")
    scores = model.transform(data).select(*keys, *[(arr[i] * F.lit(float(signs[i]))).alias(f"PC_{i + 1}")
                                                   for i in range(k)])
    var_rows = [(i + 1, float(ratio[i])) for i in range(k)]
    variance = running_share(spark.createDataFrame(var_rows, "PC int, VARIANCE_SHARE double"))
    load_rows = [(j + 1, cols[i], float(comps[i, j] * signs[j])) for j in range(k) for i in range(len(cols))]
    loadings = spark.createDataFrame(load_rows, "PC int, FEATURE string, COMPONENT double")
    return PCAResult(scores, variance, loadings, k)


def running_share(variance: DataFrame) -> DataFrame:
    """Running sum of the variance shares in component order (one row a component)."""
    return variance.withColumn(
        "CUMULATIVE", F.sum("VARIANCE_SHARE").over(W.orderBy("PC").rowsBetween(W.unboundedPreceding, 0)))


def best_valid(evaluation: DataFrame, name: str = "ALGORITHM", default: str = "kmeans") -> DataFrame:
    """Add BEST_<name>: the highest silhouette among rows with at least two
    clusters and a score (ties: lowest ORDINAL), else ``default``."""
    every = W.orderBy("ORDINAL").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    valid = F.when((F.col("N_CLUSTERS") >= 2) & F.col("SILHOUETTE").isNotNull(), F.struct("SILHOUETTE", -F.col("ORDINAL")))
    return evaluation.withColumn(f"BEST_{name}", F.coalesce(F.max_by(name, valid).over(every), F.lit(default)))


def components_for_share(variance: DataFrame, share: float = 0.95) -> int:
    """Smallest number of components whose cumulative share exceeds ``share``."""
    r = variance.where(F.col("CUMULATIVE") >= share).agg(F.min("PC").alias("m")).first()["m"]
    return int(r) if r is not None else variance.count()


# ---------------------------------------------------------------- metrics
def _cluster_stats(points: DataFrame, cols: Sequence[str], label: str) -> list:
    rows = points.groupBy(label).agg(
        F.count(F.lit(1)).alias("__n"), *[F.sum(c).alias(f"__s{i}") for i, c in enumerate(cols)],
        F.sum(F.aggregate(_vec(cols), F.lit(0.0), lambda acc, x: acc + x * x)).alias("__q")).collect()      # one row a cluster
    return rows


def _vec(cols: Sequence[str]) -> Column:
    return F.array(*[F.col(c).cast("double") for c in cols])


def _dot(v: Column, consts: Sequence[float]) -> Column:
    """v . c with c a literal vector: one higher-order expression, so the
    generated code stays small however wide the vectors are."""
    lit = F.array(*[F.lit(float(x)) for x in consts])
    return F.aggregate(F.zip_with(v, lit, lambda a, b: a * b), F.lit(0.0), lambda acc, x: acc + x)


def _sq_dist(v: Column, consts: Sequence[float]) -> Column:
    lit = F.array(*[F.lit(float(x)) for x in consts])
    return F.aggregate(F.zip_with(v, lit, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda acc, x: acc + x)


def silhouette_sq(points: DataFrame, cols: Sequence[str], label: str = "label") -> float | None:
    """Mean squared-Euclidean silhouette (every label, -1 included, is a
    cluster; a point alone in its cluster scores 0).  One pass."""
    stats = _cluster_stats(points, cols, label)
    if len(stats) < 2:
        return None
    p = points.select(F.col(label), _vec(cols).alias("__v"))
    p = p.withColumn("__x2", F.aggregate(F.col("__v"), F.lit(0.0), lambda acc, x: acc + x * x))
    mean_d = {}
    for r in stats:
        n = r["__n"]
        mu = [r[f"__s{i}"] / n for i in range(len(cols))]
        mean_d[r[label]] = (n, F.col("__x2") - F.lit(2.0) * _dot(F.col("__v"), mu) + F.lit(float(r["__q"] / n)))
    p = p.withColumns({f"__m{i}": md for i, (v, (n, md)) in enumerate(mean_d.items())})
    keys = list(mean_d)
    lab = F.col(label)
    a = None
    for i, v in enumerate(keys):
        n = mean_d[v][0]
        own = F.when(F.lit(n) > 1, F.col(f"__m{i}") * F.lit(float(n)) / F.lit(float(n - 1)))
        a = F.when(lab == F.lit(v), own) if a is None else a.when(lab == F.lit(v), own)
    b = F.least(*[F.when(lab != F.lit(v), F.col(f"__m{i}")) for i, v in enumerate(keys)])
    p = p.withColumns({"__a": a, "__b": b})
    s = F.when(F.col("__a").isNull(), F.lit(0.0)).otherwise(
        (F.col("__b") - F.col("__a")) / F.greatest(F.col("__a"), F.col("__b")))
    return p.agg(F.avg(s).alias("s")).first()["s"]


def silhouette(points: DataFrame, cols: Sequence[str], label: str = "label", block: int | None = None) -> float | None:
    """Mean Euclidean silhouette (every label, -1 included, is a cluster; a
    point alone in its cluster scores 0).  None with fewer than two clusters."""
    return silhouettes(points, cols, [label], block)[label]


def silhouettes(points: DataFrame, cols: Sequence[str], labels: Sequence[str], block: int | None = None) -> dict[str, float | None]:
    """The mean Euclidean silhouette of every labelling, from one pass over the pairs of points.

    Blocks of points are dealt by a hash and compared pairwise in numpy; a pair
    of blocks yields, for each of its points, the sums of distances to the
    points of every combination of labels, which are added up to labels."""
    given = points.select(F.monotonically_increasing_id().alias("N"), *[F.col(c).cast("double").alias(f"l{i}") for i, c in enumerate(labels)],
                          _vec(cols).alias("x"))
    given = materialise(given, "silhouette")
    tuples = [f"l{i}" for i in range(len(labels))]
    known = given.groupBy(*tuples).count().collect()                       # one row a combination of labels
    if not known:
        return dict.fromkeys(labels)
    width = len(known)
    codes = given.sparkSession.createDataFrame([(float(k), *[r[c] for c in tuples]) for k, r in enumerate(known)],
                                               "w double, " + ", ".join(f"k{i} double" for i in range(len(labels))))
    same = [F.col(c).eqNullSafe(F.col(f"k{i}")) for i, c in enumerate(tuples)]
    rows = materialise(given.join(F.broadcast(codes), same).select("N", "w", "x"), "silhouette")
    n = sum(r["count"] for r in known)
    # large blocks cross the network seldom, and several blocks keep the cores of a small table busy
    count = max(-(-n // LARGE_BLOCK), min(16, -(-n // nb.BLOCK))) if block is None else max(1, -(-n // block))
    blocks = materialise(rows.groupBy(F.pmod(F.xxhash64("N"), F.lit(count)).alias("block")).agg(
        F.collect_list(F.struct("N", "w", "x")).alias("rows")), "blocks")
    first = blocks.select(F.col("block").alias("qb"))
    pairs = first.select("qb", F.explode(F.sequence("qb", F.lit(count - 1))).alias("pb"))

    def member(w: np.ndarray) -> np.ndarray:
        out = np.zeros((len(w), width))
        out[np.arange(len(w)), w.astype(int)] = 1.0
        return out

    def compare(qb, pb, q, p):
        total, back = np.zeros((len(q[0]), width)), np.zeros((len(p[0]), width))
        mine, theirs = member(q[1]), member(p[1])
        step = max(1, CELLS // max(1, len(p[0])))
        for i in range(0, len(q[0]), step):
            d = nb.close_distances(q[2][i:i + step], p[2])
            total[i:i + step] = d @ theirs
            if qb != pb:
                back += d.T @ mine[i:i + step]
        ids, sums = (q[0], total) if qb == pb else (np.concatenate([q[0], p[0]]), np.concatenate([total, back]))
        return ids, pa.FixedSizeListArray.from_arrays(sums.ravel(), width).cast(pa.list_(pa.float64()))

    found = nb.visit(pairs, blocks, blocks, compare, "n long, a array<double>", min(4096, count * (count + 1) // 2))
    by_point = found.groupBy("n").agg(vector_to_array(Summarizer.sum(array_to_vector("a"))).alias("a"))
    scored = by_point.join(rows.select(F.col("N").alias("n"), "w"), "n")
    aggs = []
    for i, c in enumerate(tuples):
        values = sorted({r[c] for r in known}, key=lambda v: (v is None, v or 0.0))
        size = [sum(r["count"] for r in known if r[c] == v) for v in values]
        place = [values.index(r[c]) for r in known]
        totals = F.array(*[sum((F.col("a")[k] for k in range(width) if place[k] == j), F.lit(0.0)) for j in range(len(values))])
        own = F.get(F.array(*[F.lit(j) for j in place]), F.col("w").cast("int"))
        counts = F.array(*[F.lit(float(s)) for s in size])
        labelled = F.get(F.array(*[F.lit(v is not None) for v in values]), own)
        a = F.when(labelled & (F.get(counts, own) > 1), F.get(totals, own) / (F.get(counts, own) - 1))
        others = F.filter(F.zip_with(totals, counts, lambda t, m: t / m), lambda x, j: j != own)
        b = F.when(labelled & (F.size(others) > 0), F.array_min(others))
        scored = scored.withColumns({f"a{i}": a, f"b{i}": b})
        most = F.greatest(f"a{i}", f"b{i}")
        s = F.when(F.col(f"a{i}").isNull() | (most == 0), F.lit(0.0)).otherwise((F.col(f"b{i}") - F.col(f"a{i}")) / most)
        aggs += [F.count(f"b{i}").alias(f"others{i}"), F.avg(s).alias(f"s{i}")]
    out = scored.agg(*aggs).first()
    return {c: out[f"s{i}"] if out[f"others{i}"] else None for i, c in enumerate(labels)}


def calinski_harabasz(points: DataFrame, cols: Sequence[str], label: str = "label") -> float | None:
    stats = _cluster_stats(points, cols, label)
    k = len(stats)
    n = sum(r["__n"] for r in stats)
    if k < 2 or n <= k:
        return None
    d = len(cols)
    tot = np.array([sum(r[f"__s{i}"] for r in stats) for i in range(d)]) / n
    between = sum(r["__n"] * float(np.sum((np.array([r[f"__s{i}"] for i in range(d)]) / r["__n"] - tot) ** 2))
                  for r in stats)
    within = sum(r["__q"] - float(np.sum(np.array([r[f"__s{i}"] for i in range(d)]) ** 2)) / r["__n"] for r in stats)
    return float(between * (n - k) / (within * (k - 1))) if within > 0 else 1.0


def davies_bouldin(points: DataFrame, cols: Sequence[str], label: str = "label") -> float | None:
    """Mean over clusters of max_j (s_i + s_j) / |mu_i - mu_j|, s = mean
    Euclidean distance to the own centroid (one pass with k centroids)."""
    stats = _cluster_stats(points, cols, label)
    k = len(stats)
    if k < 2:
        return None
    d = len(cols)
    mus = {r[label]: np.array([r[f"__s{i}"] for i in range(d)]) / r["__n"] for r in stats}
    lab = F.col(label)
    v = F.col("__v")
    dist = None
    for key, mu in mus.items():
        e = F.sqrt(_sq_dist(v, mu))
        dist = F.when(lab == F.lit(key), e) if dist is None else dist.when(lab == F.lit(key), e)
    p = points.select(F.col(label), _vec(cols).alias("__v"))
    s = {r[label]: r["s"] for r in p.groupBy(label).agg(F.avg(dist).alias("s")).collect()}
    keys = list(mus)
    worst = []
    for i in keys:
        vals = []
        for j in keys:
            if i == j:
                continue
            m = float(np.linalg.norm(mus[i] - mus[j]))
            vals.append((s[i] + s[j]) / m if m > 0 else float("inf"))
        worst.append(max(vals))
    return float(np.mean(worst))


def evaluate(points: DataFrame, cols: Sequence[str], label: str = "label", known: dict[str, float | None] | None = None) -> dict:
    """Silhouette (Euclidean and squared), Calinski-Harabasz, Davies-Bouldin,
    cluster and noise counts; metrics only with >= 2 non-noise clusters.
    ``known`` has Euclidean silhouettes by label that are at hand."""
    c = points.agg(F.count_distinct(F.when(F.col(label) != -1, F.col(label))).alias("k"),
                   F.count_if(F.col(label) == -1).alias("noise")).first()
    out = {"N_CLUSTERS": int(c["k"]), "N_NOISE": int(c["noise"]),
           "SILHOUETTE": None, "SILHOUETTE_SQUARED": None, "CALINSKI_HARABASZ": None, "DAVIES_BOULDIN": None}
    if c["k"] >= 2:
        out["SILHOUETTE"] = known[label] if known is not None else silhouette(points, cols, label)
        out["SILHOUETTE_SQUARED"] = silhouette_sq(points, cols, label)
        out["CALINSKI_HARABASZ"] = calinski_harabasz(points, cols, label)
        out["DAVIES_BOULDIN"] = davies_bouldin(points, cols, label)
    return out


# ---------------------------------------------------------- interpretation
def cluster_profile(features: DataFrame, labels: DataFrame, cols: Sequence[str],
                    keys: Sequence[str] = ("TEAM_ID", "SEASON"), label: str = "label", top: int = 5) -> DataFrame:
    """Per (cluster, feature): cluster mean, overall mean, |difference|,
    percent difference and the rank of |difference| within the cluster
    (noise -1 skipped).  Wide cluster means come from one grouped pass."""
    j = features.join(labels.select(*keys, label), list(keys))
    overall = features.agg(*[F.avg(c).alias(c) for c in cols]).first()
    per = j.where(F.col(label) != -1).groupBy(label).agg(
        F.count(F.lit(1)).alias("SIZE"), *[F.avg(c).alias(c) for c in cols])
    structs = [F.struct(F.lit(c).alias("FEATURE"), F.lit(i).alias("POS"), F.col(c).alias("CLUSTER_MEAN"),
                        F.lit(float(overall[c])).alias("OVERALL_MEAN")) for i, c in enumerate(cols)]
    long = per.select(F.col(label).alias("CLUSTER"), "SIZE", F.inline(F.array(*structs)))
    long = long.withColumns({
        "ABS_DIFF": F.abs(F.col("CLUSTER_MEAN") - F.col("OVERALL_MEAN")),
        "DIFF_PCT": F.try_divide(F.col("CLUSTER_MEAN") - F.col("OVERALL_MEAN"), F.col("OVERALL_MEAN")) * 100,
    })
    w = W.partitionBy("CLUSTER").orderBy(F.col("ABS_DIFF").desc(), "POS")
    return long.withColumn("RANK", F.row_number().over(w))


def describe_clusters(profile: DataFrame, top: int = 3) -> DataFrame:
    """One line per cluster: where its ``top`` most different features stand.

    A feature more than 20 (10) percent off the overall mean is told as far
    (or just) above or below it; clusters without one are told as average."""
    pct = F.col("DIFF_PCT")
    # fixed values: the bounds of the buckets, 20 and 10 percent
    stand = (F.when(pct > 20, "far above").when(pct > 10, "above")
              .when(pct < -20, "far below").when(pct < -10, "below"))
    told = profile.where(F.col("RANK") <= top).withColumn(
        "__t", F.when(stand.isNotNull(), F.concat("FEATURE", F.lit(" "), stand, F.lit(" average"))))
    per = told.groupBy("CLUSTER", "SIZE").agg(F.array_sort(F.collect_list(
        F.when(F.col("__t").isNotNull(), F.struct("RANK", "__t")))).alias("__l"))
    line = F.array_join(F.transform("__l", lambda x: x["__t"]), "; ")
    return per.select("CLUSTER", "SIZE", F.when(F.size("__l") == 0, "close to average").otherwise(line).alias("DESCRIPTION"))


# fixed values: words in the names of distinctive features that decide the advice
ATTACK_WORDS, DEFENCE_WORDS = ("offensive", "points"), ("defensive",)


def strategies(profile: DataFrame, top: int = 5, attack: Sequence[str] = ATTACK_WORDS,
               defence: Sequence[str] = DEFENCE_WORDS) -> DataFrame:
    """Advice per cluster by the names of its ``top`` most different features:
    one that names attack wants a better defence, else one that names defence
    wants more variety in attack, else the cluster's own strengths are sought.
    Two general lines (CLUSTER NULL) follow; case does not matter."""
    name = F.lower("FEATURE")

    def named(words: Sequence[str]) -> Column:
        hit = F.lit(False)
        for word in words:
            hit = hit | F.contains(name, F.lit(word))
        return F.bool_or(hit)

    per = profile.where(F.col("RANK") <= top).groupBy("CLUSTER").agg(named(attack).alias("a"), named(defence).alias("d"))
    kind = F.when(F.col("a"), "defend better").when(F.col("d"), "vary the attack").otherwise("own strengths")
    text = (F.when(F.col("a"), "keep the scoring, work on the defence")
             .when(F.col("d"), "add ways to score, keep the defence")
             .otherwise("look for an edge in what sets it apart"))
    lines = per.select("CLUSTER", kind.alias("KIND"), F.format_string("Cluster %d: %s", "CLUSTER", text).alias("ADVICE"))
    general = profile.limit(1).select(F.inline(F.array(*[F.struct(F.lit(None).cast("int").alias("CLUSTER"), F.lit(k).alias("KIND"), F.lit(t).alias("ADVICE"))
                                                         for k, t in (("scouting", "Scout players by the profile that a cluster wants"),
                                                                      ("matchups", "Prepare a plan for each cluster of opponents"))])))
    return lines.unionByName(general)


def insights(profile: DataFrame) -> DataFrame:
    """Insight and recommendation per cluster, from its highest and lowest
    percent difference, and a last line (CLUSTER -1) on the cluster sizes.

    The recommendation follows from the signs: something lags while something
    leads, nothing lags, or nothing leads.  Ties go to the earlier feature;
    features without a percent difference (overall mean 0) are left out."""
    known = profile.where(F.col("DIFF_PCT").isNotNull())
    up, down = F.struct("DIFF_PCT", -F.col("POS")), F.struct(F.col("DIFF_PCT"), "POS")
    ends = known.groupBy("CLUSTER", "SIZE").agg(
        F.max_by("FEATURE", up).alias("HIGH"), F.max("DIFF_PCT").alias("HIGH_PCT"),
        F.min_by("FEATURE", down).alias("LOW"), F.min("DIFF_PCT").alias("LOW_PCT"))
    whole = {c: round_even(c, 0).cast("bigint") for c in ("HIGH_PCT", "LOW_PCT")}
    insight = F.format_string("Cluster %d, %d members: %s stands highest at %d percent, %s lowest at %d percent of difference",
                              "CLUSTER", "SIZE", "HIGH", whole["HIGH_PCT"], "LOW", whole["LOW_PCT"])
    advice = (F.when(F.col("LOW_PCT") >= 0, F.concat(F.lit("Nothing lags; build on "), "HIGH"))
               .when(F.col("HIGH_PCT") <= 0, F.concat(F.lit("Nothing leads; start with "), "LOW"))
               .otherwise(F.concat(F.lit("Work on "), "LOW", F.lit(" and keep "), "HIGH")))
    per = ends.select("CLUSTER", insight.alias("INSIGHT"), advice.alias("RECOMMENDATION"))
    sizes = ends.agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("SIZE", (-F.col("CLUSTER")).alias("NEGATED"))).alias("big"),
                     F.min(F.struct("SIZE", "CLUSTER")).alias("small")).where("n > 1")
    big, small = F.col("big"), F.col("small")
    last = sizes.select(F.lit(-1).alias("CLUSTER"), F.format_string(
        "Sizes run from %d (cluster %d) to %d (cluster %d)", small["SIZE"], small["CLUSTER"], big["SIZE"],
        -big["NEGATED"]).alias("INSIGHT"), F.lit("Read small clusters with care").alias("RECOMMENDATION"))
    return per.unionByName(last)
