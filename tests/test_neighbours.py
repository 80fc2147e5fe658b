"""Neighbour joins, density clusters, agglomeration and components against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from duelframe.operators import cluster, density, neighbours
from duelframe.operators.components import components
from duelframe.operators.ordering import row_numbers


def frame(spark, x, keys=None, label=None, parts=5):
    cols = [f"c{j}" for j in range(x.shape[1])]
    keys = list(range(len(x))) if keys is None else keys
    rows = [(int(k), *map(float, v), None if label is None else float(label[i])) for i, (k, v) in enumerate(zip(keys, x))]
    return spark.createDataFrame(rows, "k long, " + ", ".join(f"{c} double" for c in cols) + ", label double").repartition(parts), cols


def brute_near(q, p, k, skip_self=False):
    """Per query the (distance, index) of its k nearest points, ties by index."""
    out = []
    for i, v in enumerate(q):
        d = [(float(math.sqrt(sum((a - b) ** 2 for a, b in zip(v, w)))), j) for j, w in enumerate(p) if not (skip_self and i == j)]
        out.append(sorted(d)[:k])
    return out


def grid_points(rng, n, dim):
    """Points with many equal distances and many copies."""
    x = rng.integers(0, 4, (n, dim)).astype(float)
    x[: n // 3] = x[0]
    return x


@pytest.mark.parametrize("block,pivots,kind", [(16, 8, "grid"), (10, 3, "clouds"), (1000, 4, "grid"), (7, 64, "clouds")])
def test_k_nearest_matches_brute_force(spark, block, pivots, kind):
    rng = np.random.default_rng(block)
    x = grid_points(rng, 150, 2) if kind == "grid" else np.concatenate([rng.normal(c, 1, (50, 3)) for c in (0, 8, 40)])
    df, cols = frame(spark, x)
    rows = neighbours.numbered(df, cols, ["k"])
    got = neighbours.k_nearest(rows, rows, 6, F.col("N") * 2, block, pivots).collect()
    want = brute_near(x, x, 6)
    assert len(got) == len(x)
    for r in got:
        assert [(round(t["d"], 9), t["n"], t["w"]) for t in r["near"]] == [(round(d, 9), j + 1, 2 * j + 2) for d, j in want[r["q"] - 1]]


def test_few_points_are_all_near(spark):
    df, cols = frame(spark, np.array([[0.0], [1.0], [3.0]]))
    rows = neighbours.numbered(df, cols, ["k"])
    assert {r["q"]: [t["n"] for t in r["near"]] for r in neighbours.k_nearest(rows, rows, 9, block=1).collect()} == {1: [1, 2, 3], 2: [2, 1, 3], 3: [3, 2, 1]}
    assert neighbours.k_nearest(rows.where("false"), rows.where("false"), 3).collect() == []
    assert neighbours.k_nearest(rows, rows.where("false"), 3).collect() == []


def test_bounds_rule_out_far_blocks(spark):
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(100 * c, 1, (40, 2)) for c in range(8)])
    df, cols = frame(spark, x)
    rows = neighbours.numbered(df, cols, ["k"])
    blocks = neighbours.deal(rows, neighbours.draw_pivots(rows, 16), None, 16)
    asked = blocks.table.select("block", F.transform("rows", lambda r: F.struct(r["N"].alias("N"), F.lit(10.0).alias("w"), r["x"].alias("x"))).alias("rows"))
    n = blocks.table.count()
    assert blocks.size.sum() == len(x) and n >= 16
    assert neighbours.pairs_within(asked, blocks).count() < n * n / 3


def brute_lof(x, k):
    k = min(k, len(x) - 1)
    near = brute_near(x, x, k, skip_self=True)
    kd = [n[-1][0] for n in near]
    den = [1 / (np.mean([max(d, kd[j]) for d, j in n]) + 1e-10) for n in near]
    return kd, den, [np.mean([den[j] for _, j in n]) / den[i] for i, n in enumerate(near)]


@pytest.mark.parametrize("kind,k,block", [("clouds", 5, 16), ("copies", 4, 8), ("few", 20, 2048)])
def test_outlier_factors_match_brute_force(spark, kind, k, block):
    rng = np.random.default_rng(4)
    x = {"clouds": np.concatenate([rng.normal(0, 1, (60, 3)), rng.normal(6, 3, (40, 3))]),
         "copies": np.repeat(rng.normal(0, 1, (25, 2)), [7, 3, 1, 2, 5] * 5, axis=0), "few": rng.normal(0, 1, (9, 2))}[kind]
    df, cols = frame(spark, x)
    got = {r["k"]: r for r in neighbours.local_outlier_factor(df, cols, ["k"], k, block).collect()}
    kd, den, lof = brute_lof(x, k)
    for i in range(len(x)):
        assert got[i]["K_DISTANCE"] == pytest.approx(kd[i], rel=1e-9, abs=1e-12)
        assert got[i]["DENSITY"] == pytest.approx(den[i], rel=1e-6)
        assert got[i]["OUTLIER_FACTOR"] == pytest.approx(lof[i], rel=1e-6)


def test_outlier_factor_edges(spark):
    one = spark.createDataFrame([(1, 2.0), (2, None), (3, float("nan"))], "k long, a double")
    got = neighbours.local_outlier_factor(one, ["a"], ["k"], 3).collect()
    assert {r["k"]: r["OUTLIER_FACTOR"] for r in got} == {1: None, 2: None, 3: None}
    two = one.unionByName(spark.createDataFrame([(4, 3.0)], one.schema))
    got = {r["k"]: r["OUTLIER_FACTOR"] for r in neighbours.local_outlier_factor(two, ["a"], ["k"], 3).collect()}
    assert got == {1: 1.0, 2: None, 3: None, 4: 1.0}


def brute_dbscan(x, eps, least):
    d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(axis=2)) <= eps
    core = d.sum(axis=1) >= least
    label = np.full(len(x), -1)
    nxt = 0
    for i in range(len(x)):
        if core[i] and label[i] < 0:
            todo = [i]
            label[i] = nxt
            while todo:
                j = todo.pop()
                for m in np.flatnonzero(d[j] & core & (label < 0)):
                    label[m] = nxt
                    todo.append(m)
            nxt += 1
    for i in np.flatnonzero(~core):
        around = label[d[i] & core]
        if len(around):
            label[i] = around.min()
    return label, core.astype(int)


@pytest.mark.parametrize("kind,eps,block", [("rings", 0.6, 24), ("copies", 0.5, 8), ("grid", 1.0, 16), ("clouds", 0.5, 2048)])
def test_dbscan_matches_brute_force(spark, kind, eps, block):
    rng = np.random.default_rng(8)
    t = rng.uniform(0, 2 * math.pi, 160)
    x = {"rings": np.column_stack([np.cos(t), np.sin(t)]) * np.repeat([1, 4], 80)[:, None] + rng.normal(0, 0.1, (160, 2)),
         "copies": np.repeat(rng.uniform(0, 6, (30, 2)), [6, 1, 2, 1, 4] * 6, axis=0),
         "grid": grid_points(rng, 120, 3) * 1.0, "clouds": np.concatenate([rng.normal(c, 0.4, (40, 2)) for c in (0, 3, 20)])}[kind]
    order = rng.permutation(len(x))
    df, cols = frame(spark, x[order], keys=range(len(x)))
    got = {r["k"]: (r["label"], r["IS_CORE"]) for r in density.dbscan(df, cols, ["k"], eps, 5, block).collect()}
    label, core = brute_dbscan(x[order], eps, 5)
    assert got == {i: (int(label[i]), int(core[i])) for i in range(len(x))}


def test_dbscan_edges(spark):
    rows = spark.createDataFrame([(1, 0.0), (2, None), (3, 0.1), (4, 9.0)], "k long, a double")
    got = {r["k"]: (r["label"], r["IS_CORE"]) for r in density.dbscan(rows, ["a"], ["k"], 0.5, 2).collect()}
    assert got == {1: (0, 1), 2: (-1, 0), 3: (0, 1), 4: (-1, 0)}
    assert density.dbscan(rows.where("false"), ["a"], ["k"]).collect() == []


def test_forest_connects_what_the_matrix_connects():
    rng = np.random.default_rng(1)
    for _ in range(100):
        near = rng.random((rng.integers(0, 12), rng.integers(0, 12))) < rng.choice([0.05, 0.2, 0.9])
        r, c = density.forest(near)
        assert near[r, c].all() and len(r) <= max(0, sum(near.shape) - 1)

        def groups(edges):
            parent = list(range(sum(near.shape)))

            def find(i):
                while parent[i] != i:
                    i = parent[i]
                return i
            for a, b in edges:
                parent[find(a)] = find(b + near.shape[0])
            return [frozenset(j for j in range(len(parent)) if find(j) == find(i)) for i in range(len(parent))]
        assert groups(zip(*np.nonzero(near))) == groups(zip(r, c))


@pytest.mark.parametrize("weights", ["uniform", "distance"])
def test_knn_models_match_brute_force(spark, weights):
    rng = np.random.default_rng(6)
    x, q = grid_points(rng, 90, 2), np.concatenate([grid_points(rng, 40, 2), rng.normal(0, 3, (20, 2))])
    y = rng.integers(0, 3, len(x))
    train, cols = frame(spark, x, keys=rng.permutation(len(x)), label=y)
    by_key = sorted(train.collect(), key=lambda r: r["k"])
    px, py = np.array([[r[c] for c in cols] for r in by_key]), [r["label"] for r in by_key]
    query, _ = frame(spark, q)
    cls = {r["k"]: r for r in neighbours.knn_classify(train, query, cols, ["k"], "label", 5, weights, 16).collect()}
    reg = {r["k"]: r for r in neighbours.knn_regress(train, query, cols, ["k"], "label", 5, weights, 16).collect()}
    for i, near in enumerate(brute_near(q, px, 5)):
        exact = any(d == 0 for d, _ in near)
        w = [1.0 if weights == "uniform" else float(d == 0) if exact else 1 / d for d, _ in near]
        votes = {}
        for (d, j), v in zip(near, w):
            votes[py[j]] = votes.get(py[j], 0) + v
        top = max(votes.values())
        assert votes[cls[i]["prediction"]] == pytest.approx(top) and cls[i]["probability"] == pytest.approx(top / sum(w))
        if weights == "uniform":
            assert cls[i]["prediction"] == min(c for c, v in votes.items() if v == top)
        assert reg[i]["prediction"] == pytest.approx(sum(v * py[j] for (_, j), v in zip(near, w)) / sum(w))


# -- order and components -----------------------------------------------------------

def test_row_numbers(spark):
    rows = spark.createDataFrame([(i % 7, i) for i in range(500)] + [(3, 3)] * 200, "a long, b long").repartition(9)
    got = row_numbers(rows, [F.col("a").desc(), F.col("b").asc()], "n", 0).orderBy("n").collect()
    assert [r["n"] for r in got] == list(range(700))
    assert [(r["a"], r["b"]) for r in got] == sorted(((r["a"], r["b"]) for r in got), key=lambda t: (-t[0], t[1]))
    assert row_numbers(rows.where("false"), [F.col("a")]).collect() == []


@pytest.mark.parametrize("kind", ["path", "random", "star"])
def test_components_match_union_find(spark, kind):
    rng = np.random.default_rng(3)
    edges = {"path": [(i, i + 1) for i in range(60)] + [(200, 201)], "star": [(99, i) for i in range(40)] + [(98, i + 40) for i in range(20)],
             "random": [tuple(map(int, e)) for e in rng.integers(0, 200, (130, 2))] + [(5, 5), (7, None), (None, 7)]}[kind]
    parent = {}

    def find(i):
        parent.setdefault(i, i)
        while parent[i] != i:
            i = parent[i]
        return i
    for a, b in edges:
        if a is not None and b is not None and a != b:
            ra, rb = find(a), find(b)
            parent[max(ra, rb)] = min(ra, rb)
    want = {i: find(i) for i in list(parent)}
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long").repartition(4)).collect()}
    assert got == want


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
    assert components(spark.createDataFrame([(1, 1)], "a long, b long")).collect() == []


# -- silhouette and Ward -----------------------------------------------------------

@pytest.mark.parametrize("block", [13, 4096])
def test_silhouette_matches_brute_force(spark, block):
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(0, 1, (30, 2)), rng.normal(3, 1, (20, 2)), [[9.0, 9.0]], np.zeros((4, 2))])
    label = np.array([0] * 30 + [1] * 20 + [-1] + [5] * 4)
    d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(axis=2))
    scores = []
    for i in range(len(x)):
        own = label == label[i]
        if own.sum() == 1:
            scores.append(0.0)
            continue
        a = d[i][own].sum() / (own.sum() - 1)
        b = min(d[i][label == c].mean() for c in set(label.tolist()) - {label[i]})
        scores.append((b - a) / max(a, b))
    df, cols = frame(spark, x, label=label)
    assert cluster.silhouette(df, cols, "label", block) == pytest.approx(np.mean(scores), abs=1e-12)
    assert cluster.silhouette(df.where("label = 0"), cols, "label", block) is None


def naive_ward(n, x, k):
    groups = [([i], n[i], x[i] * n[i]) for i in range(len(x))]
    while len(groups) > k:
        best = None
        for a in range(len(groups)):
            for b in range(a + 1, len(groups)):
                (_, na, sa), (_, nb_, sb) = groups[a], groups[b]
                cost = na * nb_ / (na + nb_) * ((sa / na - sb / nb_) ** 2).sum()
                if best is None or cost < best[0]:
                    best = (cost, a, b)
        _, a, b = best
        groups[a] = (groups[a][0] + groups[b][0], groups[a][1] + groups[b][1], groups[a][2] + groups[b][2])
        del groups[b]
    return {frozenset(g[0]) for g in groups}


def test_ward_merges_equal_the_naive_ones():
    rng = np.random.default_rng(7)
    for _ in range(10):
        n, x = rng.integers(1, 5, 30).astype(float), rng.normal(0, 1, (30, 3))
        merges = cluster.ward_merges(n, x)
        assert len(merges) == 29
        for k in (1, 2, 4, 9, 30):
            label = cluster.ward_cut(merges, 30, k)
            assert {frozenset(np.flatnonzero(label == c).tolist()) for c in set(label.tolist())} == naive_ward(n, x, k)


def test_ward_labels_equal_the_naive_ones(spark):
    rng = np.random.default_rng(9)
    x = np.concatenate([rng.normal(0, 1, (40, 2)), np.repeat(rng.normal(4, 1, (5, 2)), 4, axis=0)])
    df, cols = frame(spark, x, parts=11)
    got = {r["k"]: r["label"] for r in cluster.ward_labels(df, cols, 4, ["k"], fan_in=3).collect()}
    groups = {frozenset(i for i in got if got[i] == c) for c in set(got.values())}
    assert groups == naive_ward(np.ones(len(x)), x, 4)
    assert [got[i] for i in sorted(got)][0] == 0


def test_ward_over_condensed_features(spark):
    """Far groups stay whole when the points outnumber the features."""
    rng = np.random.default_rng(10)
    x = np.concatenate([rng.normal(c, 1, (300, 2)) for c in (0, 40, 80)])
    df, cols = frame(spark, x)
    got = {r["k"]: r["label"] for r in cluster.ward_labels(df, cols, 3, ["k"], most=40).collect()}
    assert [got[i] for i in range(900)] == [i // 300 for i in range(900)]


def test_condense_keeps_sums():
    rng = np.random.default_rng(2)
    x = rng.normal(0, 1, (500, 3))
    x[:100] = x[0]
    n, s, q = cluster.condense(np.ones(500), x, (x * x).sum(axis=1), 50)
    assert len(n) <= 50 and n.sum() == 500
    assert np.allclose(s.sum(axis=0), x.sum(axis=0)) and q.sum() == pytest.approx((x * x).sum())
    assert len(cluster.condense(np.ones(500), x, (x * x).sum(axis=1), 500)[0]) == 401
