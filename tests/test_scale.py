"""Work of model and neighbour queries is spread over the cores, and its faster forms give the plain ones' results."""

import types

import numpy as np
import pytest
from pyspark.sql import functions as F

from duelframe.operators import bagging, cluster, cluster_features, gram, neighbours, newton
from duelframe.plans import base
from duelframe.session import materialise_spread


def test_small_tables_of_fits_lie_in_as_many_files_as_cores(spark):
    df = spark.range(1000).coalesce(1)
    got = materialise_spread(df, "spread")
    assert len(got.inputFiles()) >= spark.sparkContext.defaultParallelism
    assert sorted(r["id"] for r in got.collect()) == list(range(1000))


def test_tables_of_other_columns_have_other_names(spark, monkeypatch):
    names = []
    monkeypatch.setattr(base, "materialise", lambda df, tag: names.append(tag) or df)
    monkeypatch.setattr(base.clean, "clean_games", lambda df: df)
    monkeypatch.setattr(base, "Contest", lambda *_: types.SimpleNamespace(games=spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")))
    for columns in (None, ["a"], ["a", "b"]):
        assert base.Stages(spark, "nowhere", columns).games_cleaned.columns == (columns or ["a", "b", "c"])
    assert len(set(names)) == 3


def test_cluster_columns_do_not_deal_games_by_cluster(spark):
    games = spark.createDataFrame([(i, i % 3, float(i)) for i in range(60)], "GAME_ID long, HOME_TEAM_ID int, x double")
    labels = spark.createDataFrame([(t, 2000, t % 2) for t in range(3)], "TEAM_ID int, SEASON int, label int")
    features = spark.createDataFrame([(t, 2000, float(t)) for t in range(3)], "TEAM_ID int, SEASON int, f double")
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = cluster_features.enhance_regression(games, labels, features)
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert out.count() == 60 and plan.count("rightHint=(strategy=broadcast)") >= 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


@pytest.mark.parametrize("nodes", [1, 50, 70_000])
def test_rows_by_node_and_code(nodes):
    rng = np.random.default_rng(nodes)
    at, code = rng.integers(0, nodes, 5000), rng.integers(0, bagging.BINS, 5000).astype(np.uint8)
    assert np.array_equal(bagging._order(at, code, nodes), np.argsort(at * bagging.BINS + code, kind="stable"))


def test_distances_by_product():
    rng = np.random.default_rng(1)
    p = rng.normal(1e4, 1, (300, 16))
    q = np.concatenate([p[:40], p[40:80] + 1e-7, rng.normal(1e4, 1, (50, 16))])
    want = neighbours.distances(q, p)
    got = neighbours.close_distances(q, p)
    assert np.array_equal(got[want == 0], want[want == 0]) and np.allclose(got, want, rtol=1e-8, atol=0)


@pytest.mark.parametrize("scale", [1.0, 1e-3, 1e160])
def test_nearest_of_a_block_are_the_plain_ones(scale):
    rng = np.random.default_rng(2)
    p = rng.integers(0, 4, (400, 3)) * scale
    q = rng.integers(0, 4, (90, 3)) * scale
    k = 5
    ids, d, n, _ = neighbours._k_nearest(k)(0, 0, (np.arange(90), np.full(90, np.inf), q), (np.arange(400), np.zeros(400), p))
    far = neighbours.distances(q, p)
    for i in range(90):
        o = np.lexsort((np.arange(400), far[i]))[:k]
        assert n[ids == i].tolist() == o.tolist() and d[ids == i].tolist() == far[i][o].tolist()


def test_silhouettes_of_several_labellings(spark):
    rng = np.random.default_rng(3)
    x, a = rng.normal(0, 1, (60, 2)), [None if i % 9 == 0 else i % 3 for i in range(60)]
    x[:20] = x[0]
    rows = [(float(u), float(v), a[i], i % 2, 7) for i, (u, v) in enumerate(x)]
    df = spark.createDataFrame(rows, "u double, v double, a int, b int, one int")
    got = cluster.silhouettes(df, ["u", "v"], ["a", "b", "one"], 16)
    d = neighbours.distances(x, x)

    def plain(labels):
        out = []
        for i, own in enumerate(labels):
            mean = {v: d[i, [j for j, w in enumerate(labels) if w == v and j != i]].mean() for v in set(labels)}
            other = min(m for v, m in mean.items() if v != own)
            out.append(0.0 if own is None or max(mean[own], other) == 0 else (other - mean[own]) / max(mean[own], other))
        return np.mean(out)

    assert got["one"] is None
    assert got["a"] == pytest.approx(plain(a), abs=1e-12) and got["b"] == pytest.approx(plain([i % 2 for i in range(60)]), abs=1e-12)
    assert got["b"] == pytest.approx(cluster.silhouette(df, ["u", "v"], "b"), abs=1e-12)
    assert cluster.silhouettes(df.where(F.lit(False)), ["u", "v"], ["a"]) == {"a": None}


def test_codes_are_dealt_by_the_batch(spark):
    df = spark.range(900).select(F.col("id").alias("a"), (F.col("id") % 7).alias("b"), F.col("id").cast("double").alias("label"), (F.col("id") % 3).alias("FOLD")).repartition(3)
    edges = [np.arange(0.0, 900, 50), np.arange(0.5, 6)]
    table = bagging.coded(df, ["a", "b"], edges)
    assert table.count() <= 3
    _, fold, y, codes = bagging._matrix(table.toArrow(), 2)
    assert sorted(y.tolist()) == list(range(900)) and np.array_equal(fold, y % 3)
    assert np.array_equal(codes, bagging.encode(np.column_stack([y, y % 7]), edges))


@pytest.mark.parametrize("whole", [True, False])
def test_columns_of_few_codes_share_a_pass(monkeypatch, whole):
    rng = np.random.default_rng(5)
    codes = np.column_stack([rng.integers(0, 60, (400, 2)), rng.integers(0, 2, (400, 12)), np.zeros(400)]).astype(np.uint8)
    y = rng.integers(-3, 9, 400) if whole else rng.normal(0, 1, 400)
    bundles = bagging.bundled(codes)
    assert len(bundles) <= 4 and sorted(j for cols, _, _ in bundles for j in cols) == list(range(15))
    for w in (np.ones(400), rng.integers(0, 3, 400).astype(float)):
        assert (bagging._Sums(w, w * y).unit is not None) == whole
        grown = []
        for dense in (1000, 4, 0):                              # bundles, sums by cell, sums of sorted rows
            monkeypatch.setattr(bagging, "DENSE", dense)
            grown.append(bagging.grow(codes, y, w, 15, 1.0, 6, np.random.default_rng(0)))
        for other in grown[1:]:
            assert all(np.allclose(grown[0][k], other[k]) for k in other)


def test_boosted_numbers_have_their_model_from_the_same_job(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(0, 1, (300, 2))
    df = spark.createDataFrame([(*map(float, r), float(r[0] * 3 + r[1]), i % 3) for i, r in enumerate(x)], "a double, b double, label double, FOLD int")
    scores, model = bagging.boost_numbers(df, ["a", "b"], [3, 8], [0.1, 0.5], 2, [0, 1, 2])
    assert set(scores) == {(3, 0.1), (3, 0.5), (8, 0.1), (8, 0.5)} and all(len(s) == 3 for s in scores.values())
    alone = bagging.fit_boosted(df, ["a", "b"], 3, 0.5, 2)
    a, b = ([r["prediction"] for r in m.transform(df, ["label"]).orderBy("label").collect()] for m in (model(3, 0.5), alone))
    assert np.allclose(a, b)


def test_blocks_are_sent_once_a_tile_not_once_a_pair(spark):
    pairs = spark.createDataFrame([(q, p) for q in range(20) for p in range(20)], "qb long, pb long")
    rows = "array<struct<N: bigint, w: double, x: array<double>>>"
    blocks = spark.createDataFrame([(b, [(b, 0.0, [float(b)])]) for b in range(20)], f"block long, rows {rows}")
    sent = neighbours._sent(pairs, blocks, blocks, 2, 4)
    assert sent.count() == 20 * 4 + 20 * 2 and sent.select("tile").distinct().count() == 8
    assert sent.where("wanted IS NOT NULL").agg(F.sum(F.size("wanted"))).first()[0] == 400


def test_nearest_of_several_blocks_are_the_plain_ones(spark, monkeypatch):
    rng = np.random.default_rng(7)
    p, q = rng.integers(0, 9, (600, 3)).astype(float), rng.integers(0, 9, (80, 3)).astype(float)
    far = neighbours.distances(q, p)
    want = {i: np.lexsort((np.arange(600), far[i]))[:4].tolist() for i in range(80)}
    split = [(np.arange(i, i + 100), np.zeros(100), p[i:i + 100]) for i in range(0, 600, 100)]
    ids, d, n, _ = neighbours._nearest_of_blocks(4)((np.arange(80), np.full(80, np.inf), q), split)
    assert {i: n[ids == i].tolist() for i in range(80)} == want and np.array_equal(d, far[ids, n])
    monkeypatch.setattr(neighbours, "TILE", 500)
    points, asked = (spark.createDataFrame([(i, list(map(float, v))) for i, v in enumerate(t)], "N long, x array<double>") for t in (p, q))
    got = neighbours.k_nearest(asked, points, 4, block=40).collect()
    assert {r["q"]: [t["n"] for t in r["near"]] for r in got} == want


def test_early_hessians_of_fewer_rows_lead_to_the_same_model(spark, monkeypatch):
    rng = np.random.default_rng(8)
    x = rng.normal(0, 1, (400, 3))
    df = spark.createDataFrame([(*map(float, r), float(r @ [1, -2, 0.5] + e)) for r, e in zip(x, rng.normal(0, 0.3, 400))], "a double, b double, c double, label double")
    cols = ["a", "b", "c"]
    problem = newton.Problem(newton.feature_map(gram.products(df, cols)), 1.0, "tube", scale=2.0)
    want, rows = newton.minimise(df, cols, [problem])[0], []
    plain = newton._derivatives
    monkeypatch.setattr(newton, "_derivatives", lambda *a: rows.append(list(a[-1].values())[0]) or plain(*a))
    monkeypatch.setattr(newton, "CURVED", 100)
    got = newton.minimise(df, cols, [problem])[0]
    assert 4 in rows and rows[-1] == 1
    assert np.allclose(got.weights, want.weights, atol=1e-6) and got.objective == pytest.approx(want.objective, rel=1e-9)
