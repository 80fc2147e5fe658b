"""Properties of the fitted and seeded operators: closed forms, planted cases, repeatability."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from duelframe.operators import anomaly, clean, cluster, cluster_features, history, metrics, models, profile, quantiles, rules, split
from duelframe.sources import io

KEYS = ["TEAM_ID", "SEASON"]


def table(spark, x, extra=()):
    cols = [f"x{j}" for j in range(x.shape[1])]
    rows = [(i, 2000, *map(float, r), *(float(e[i]) for e in extra)) for i, r in enumerate(x)]
    names = [*KEYS, *cols, *[f"e{k}" for k in range(len(extra))]]
    return spark.createDataFrame(rows, names), cols


@pytest.fixture(scope="module")
def linear(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 4))
    y = x @ [2.0, -1.0, 0.0, 0.5] + 3 + rng.normal(size=400) * 0.3
    df, cols = table(spark, x, [y])
    df = split.fold_ids(df.withColumnRenamed("e0", "label").withColumnRenamed("TEAM_ID", "GAME_ID"), ["GAME_ID"], 5, 42)
    return df, cols, x, y


def scaled(x):
    return (x - x.mean(axis=0)) / x.std(axis=0, ddof=1)


def test_ridge_closed_form(linear):
    df, cols, x, y = linear
    est, grid = models.regressor("ridge", float(y.std()), len(y))
    best, avg, _ = models.cross_validate(df, cols, est, grid, models.r2_eval())
    alpha = (0.1, 1.0, 10.0)[int(np.argmax(avg))]
    z = scaled(x)
    w = np.linalg.solve(z.T @ z + alpha * np.eye(4), z.T @ (y - y.mean()))
    assert np.allclose(best.stages[-1].coefficients.toArray(), w, rtol=1e-2, atol=1e-3)


def test_lasso_and_elastic_net_optimality(linear):
    """Subgradient conditions of the fitted coefficients."""
    df, cols, x, y = linear
    z, n = scaled(x), len(y)
    for name, l1, l2 in (("lasso", 0.1, 0.0), ("elastic_net", None, None)):
        est, grid = models.regressor(name, float(y.std()), n)
        best, _, _ = models.cross_validate(df, cols, est, grid, models.r2_eval())
        m = best.stages[-1]
        reg, mixing = m.getRegParam(), m.getElasticNetParam()
        w = m.coefficients.toArray()
        # Spark scales the label by its deviation: penalties act on that scale
        sd = y.std(ddof=1)
        g = z.T @ (y - y.mean() - z @ w) / n / sd
        l1_eff, l2_eff = reg * mixing / sd, reg * (1 - mixing) / sd
        active = np.abs(w) > 1e-6
        assert np.allclose(g[active], l1_eff * np.sign(w[active]) + l2_eff * w[active] / sd, atol=0.05)
        assert (np.abs(g[~active]) <= l1_eff + 0.05).all()


def test_naive_bayes_closed_form(spark):
    rng = np.random.default_rng(4)
    x = np.concatenate((rng.normal(0, 1, (150, 2)), rng.normal(2, 1.5, (100, 2))))
    y = np.repeat([0.0, 1.0], [150, 100])
    df, cols = table(spark, x, [y])
    df = split.fold_ids(df.withColumnRenamed("e0", "label"), ["TEAM_ID"], 5, 42, label="label")
    est, grid = models.classifier("naive_bayes", 250)
    best, _, _ = models.cross_validate(df, cols, est, grid, models.accuracy_eval())
    z = scaled(x)
    score = [np.log(np.mean(y == c)) - 0.5 * (np.log(2 * np.pi * z[y == c].var(axis=0)) + (z - z[y == c].mean(axis=0)) ** 2
                                              / z[y == c].var(axis=0)).sum(axis=1) for c in (0, 1)]
    got = {r["TEAM_ID"]: r["prediction"] for r in best.transform(df).collect()}
    agree = np.mean([got[i] == float(score[1][i] > score[0][i]) for i in range(250)])
    assert agree > 0.99


def test_kmeans_cost_falls_and_finds_blobs(spark):
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(c, 0.2, (40, 3)) for c in (-5, 0, 5)])
    df, cols = table(spark, x)
    vec = cluster.assemble(df, cols)
    costs = [cluster.total_sum_of_squares(df, cols)] + [cluster.kmeans_best_of(vec, k, n_init=4).summary.trainingCost for k in (2, 3, 4)]
    assert all(a > b for a, b in zip(costs, costs[1:]))
    for labels in (cluster.kmeans_labels(df, cols, 3)[0], cluster.bisecting_labels(df, cols, 3)):
        got = {r["TEAM_ID"]: r["label"] for r in labels.collect()}
        assert [got[i] for i in range(120)] == [i // 40 for i in range(120)]
    again = {r["TEAM_ID"]: r["label"] for r in cluster.kmeans_labels(df.repartition(5), cols, 3)[0].collect()}
    assert again == {i: i // 40 for i in range(120)}


def test_pca_matches_eigenvectors(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(200, 4)) @ rng.normal(size=(4, 4))
    df, cols = table(spark, x)
    p = cluster.pca(df, cols, 4)
    values, vectors = np.linalg.eigh(np.cov(x.T))
    share = values[::-1] / values.sum()
    assert np.allclose([r["VARIANCE_SHARE"] for r in p.variance.orderBy("PC").collect()], share)
    assert np.isclose(p.variance.agg(F.max("CUMULATIVE")).first()[0], 1.0)
    load = {(r["PC"], r["FEATURE"]): r["COMPONENT"] for r in p.loadings.collect()}
    for k in range(4):
        v = vectors[:, 3 - k]
        v = v * np.sign(v[np.abs(v).argmax()])
        assert np.allclose([load[(k + 1, c)] for c in cols], v, atol=1e-6)


def test_planted_outliers(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(300, 5))
    x[:6] += 12
    df, cols = table(spark, x)
    for found in (anomaly.isolation_forest(df, cols, KEYS, contamination=0.05),
                  anomaly.rff_one_class(df, cols, KEYS, 0.05), anomaly.zscore_detector(df, cols, KEYS, 0.05)):
        rows = found.collect()
        flagged = {r["TEAM_ID"] for r in rows if r["IS_ANOMALY"]}
        assert len(rows) == 300 and set(range(6)) <= flagged and len(flagged) <= 16
    a = anomaly.isolation_forest(df, cols, KEYS).select("TEAM_ID", "ANOMALY_SCORE").collect()
    b = anomaly.isolation_forest(df.repartition(6), cols, KEYS).select("TEAM_ID", "ANOMALY_SCORE").collect()
    assert {r[0]: round(r[1], 9) for r in a} == {r[0]: round(r[1], 9) for r in b}


def test_exact_quantiles_and_mode(spark):
    rng = random.Random(8)
    values = [rng.choice([None, rng.gauss(0, 1), float(rng.randint(0, 5))]) for _ in range(3000)]
    df = spark.createDataFrame([(v, None, float(i % 2)) for i, v in enumerate(values)], "a double, b double, c double").repartition(5)
    known = [v for v in values if v is not None]
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    for accuracy in (10_000, 50):                     # rough sketches are bracketed too
        q = quantiles.exact_quantiles(df, ["a", "b", "c"], probs, accuracy)
        assert np.allclose(q["a"], np.quantile(known, probs)) and q["b"] == [None] * 7 and q["c"][3] == 0.5
    assert quantiles.mode(spark.createDataFrame([("b",), ("a",), ("a",), ("b",), (None,)], "s string"), "s") == "a"
    assert quantiles.mode(spark.createDataFrame([], "s string"), "s") is None


@pytest.mark.parametrize("read", [1, 7, 1000])
def test_quantiles_of_brackets_wider_than_may_be_read(spark, read):
    rng = np.random.default_rng(5)
    n = 4000
    cols = {
        "smooth": rng.normal(size=n), "two": rng.integers(0, 2, n) * 3.0, "heavy": np.where(rng.random(n) < 0.7, -1.5, rng.normal(size=n)),
        "near": 1.0 + rng.integers(0, 3, n) * 2.0 ** -52, "ends": np.where(rng.random(n) < 0.4, -np.inf, np.inf)}
    df = spark.createDataFrame(list(zip(*[c.tolist() for c in cols.values()])), ", ".join(f"{c} double" for c in cols))
    probs = [0.0, 0.25, 0.4, 0.5, 0.9, 1.0]
    got = quantiles.exact_quantiles(df, list(cols), probs, accuracy=20, read=read)
    for c, v in cols.items():
        s = np.sort(v)
        for p, q in zip(probs, got[c]):
            lo, hi = s[int(np.floor(p * (n - 1)))], s[int(np.ceil(p * (n - 1)))]
            at = p * (n - 1) - np.floor(p * (n - 1))
            assert q == (lo if lo == hi else lo + (hi - lo) * at), (c, p)


def test_quantiles_with_nan_and_only_where_null(spark):
    df = spark.createDataFrame([(1.0, None, 3.0), (2.0, 4.0, float("nan")), (3.0, 6.0, float("nan"))], "a double, b double, c double")
    assert quantiles.exact_quantiles(df, ["a", "b"], [0.5], if_null=True) == {"b": [5.0]}
    got = quantiles.exact_quantiles(df, ["c"], [0.0, 1.0])["c"]
    assert got[0] == 3.0 and np.isnan(got[1])
    empty = df.where("a > 9")
    assert quantiles.exact_quantiles(empty, ["a", "b"], [0.5]) == {"a": [None], "b": [None]}


@pytest.mark.parametrize("buckets", [1, 4, 1024])
def test_auc_of_crowded_null_and_nan_scores(spark, buckets):
    rng = np.random.default_rng(3)
    rows = [(int(rng.random() < 0.4), s) for s in (0.5 + rng.integers(0, 300, 900) * 1e-9).tolist() + [None, float("nan")] * 20]
    got = metrics.roc_auc(spark.createDataFrame(rows, "label int, probability double"), buckets=buckets).first()["ROC_AUC"]
    place = [(-1.0 if s is None else np.inf if np.isnan(s) else s) for _, s in rows]
    pos = np.array([p for (y, _), p in zip(rows, place) if y == 1])
    neg = np.array([p for (y, _), p in zip(rows, place) if y != 1])
    want = ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))
    assert abs(got - want) < 1e-12


def test_running_windows_against_loops(spark):
    rng = random.Random(9)
    import datetime as dt
    rows = []
    for i in range(400):
        h, v = rng.sample(range(1, 5), 2)
        rows.append((i, dt.date(2000, 1, 1 + rng.randint(0, 20)), 2000, h, v, float(rng.randint(80, 120)), float(rng.randint(80, 120)), rng.random() < .5))
    g = spark.createDataFrame(rows, "GAME_ID long, GAME_DATE_EST date, SEASON int, HOME_TEAM_ID int, VISITOR_TEAM_ID int, "
                                    "PTS_home double, PTS_away double, HOME_TEAM_WINS boolean").repartition(4)
    sides = sorted([(t, d, i, int(w) if home else 1 - int(w), p) for i, d, _, h, v, ph, pa, w in rows
                    for t, home, p in ((h, True, ph), (v, False, pa))])
    form = {(r["GAME_ID"], r["TEAM_ID"]): r for r in history.recent_form(g, 5).collect()}
    prior = {(r["GAME_ID"], r["TEAM_ID"]): r for r in history.season_to_date(g).collect()}
    for t in range(1, 5):
        own = [s for s in sides if s[0] == t]
        for k, (_, _, i, _, _) in enumerate(own):
            last, every = own[max(0, k - 5):k], own[:k]
            r, p = form[(i, t)], prior[(i, t)]
            assert r["FORM_GAMES"] == len(last) and p["PRIOR_GAMES"] == k
            if last:
                assert r["FORM_WIN_PCT"] == pytest.approx(np.mean([s[3] for s in last]))
                assert r["FORM_PTS_FOR"] == pytest.approx(np.mean([s[4] for s in last]))
                assert p["PRIOR_PTS_MEAN"] == pytest.approx(np.mean([s[4] for s in every]))
            else:
                assert r["FORM_WIN_PCT"] is None and p["PRIOR_WIN_PCT"] is None
    met = {r["GAME_ID"]: r for r in history.head_to_head(g).collect()}
    order = sorted(rows, key=lambda r: (r[1], r[0]))
    for k, (i, _, _, h, v, _, _, _) in enumerate(order):
        before = [r for r in order[:k] if {r[3], r[4]} == {h, v}]
        wins = sum(r[7] if r[3] == h else not r[7] for r in before)
        assert (met[i]["H2H_GAMES"], met[i]["H2H_HOME_WINS"]) == (len(before), wins)


@pytest.mark.parametrize("n", [2000, 12_000, 60_000])
def test_sample_split_and_folds_are_independent(spark, n):
    df = spark.range(n).withColumnRenamed("id", "GAME_ID")
    kept = split.sample_n(df, min(n, 10_000), ["GAME_ID"])
    train, test = split.split_frac(kept, ["GAME_ID"], 0.2, 42)
    share = test.count() / min(n, 10_000)
    assert abs(share - 0.2) < 0.02 and train.count() + test.count() == min(n, 10_000)
    folds = [r["count"] for r in split.fold_ids(train, ["GAME_ID"], 5, 42).groupBy("FOLD").count().collect()]
    m = sum(folds) / 5
    assert len(folds) == 5 and all(abs(f - m) < 4.5 * math.sqrt(m * 0.8) for f in folds)


def test_correlation_with_and_without_nulls(spark):
    rng = np.random.default_rng(10)
    x = rng.normal(size=(200, 3))
    x[:, 1] += x[:, 0]
    df, cols = table(spark, x)
    got = {(r["A"], r["B"]): r["CORR"] for r in profile.correlation_long(df, cols).collect()}
    holes = {(r["A"], r["B"]): r["CORR"] for r in profile.correlation_long(df.withColumn("x2", F.when(F.col("x2") > 0, F.col("x2"))), cols).collect()}
    c = np.corrcoef(x.T)
    assert all(got[(a, b)] == pytest.approx(c[i, j]) for i, a in enumerate(cols) for j, b in enumerate(cols))
    assert holes[("x0", "x1")] == pytest.approx(c[0, 1])
    keep = x[:, 2] > 0
    assert holes[("x0", "x2")] == pytest.approx(np.corrcoef(x[keep, 0], x[keep, 2])[0, 1])


def test_mode_fill_of_strings(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", None), (None, 3.0), ("a", 4.0)], "s string, x double")
    out = sorted((r["s"], r["x"]) for r in clean.impute_median_mode(df).collect())
    assert out == [("a", 3.0), ("a", 3.0), ("a", 4.0), ("b", 1.0)]


def test_centroid_distances(spark):
    f = spark.createDataFrame([(1, 2000, 0.0, 0.0), (1, 2001, 3.0, 4.0), (2, 2000, 1.0, 1.0)], "TEAM_ID int, SEASON int, a double, b double")
    lab = spark.createDataFrame([(1, 2000, 0), (1, 2001, 1), (2, 2000, 0)], "TEAM_ID int, SEASON int, label int")
    got = {r["TEAM_ID"]: r for r in cluster_features.centroid_distances(f, lab, ["a", "b"]).collect()}
    assert got[1]["CLUSTER_DIST_1"] == 0 and got[1]["CLUSTER_DIST_0"] == pytest.approx(math.hypot(2.5, 3.5))


def test_names_fall_back_to_the_given_map(spark):
    rows = io.names_or_default(spark, None, {7: "seven", 3: "three"}).collect()
    assert [(r["TEAM_ID"], r["TEAM_NAME"]) for r in rows] == [(3, "three"), (7, "seven")]


def test_association_rules_hold(spark):
    from duelframe.plans.base import Stages
    g = Stages(spark, "/root/testdata/sf0.001").games_validated
    rows = rules.game_fact_rules(g).collect()
    assert rows and all(r["confidence" if "confidence" in r.__fields__ else "CONFIDENCE"] >= 0.5 for r in rows)


def test_result_store_keeps_versions(spark, tmp_path):
    import time
    for k in range(2):
        models.save_results(spark.createDataFrame([(k,)], "v int"), str(tmp_path), "report")
        time.sleep(0.01)
    assert models.latest_results(spark, str(tmp_path), "report").first()["v"] == 1


def test_game_facts_take_bounded_medians(spark, monkeypatch):
    def gathered(*_):
        raise AssertionError("a median over all distinct values in one task")
    monkeypatch.setattr(rules.F, "median", gathered)
    g = spark.createDataFrame([(i, bool(i % 2), float(90 + i), float(100 - i), 40.0, 39.0, 20.0, 21.0, i % 7) for i in range(8)],
                              "GAME_ID long, HOME_TEAM_WINS boolean, PTS_home double, PTS_away double, REB_home double, REB_away double, "
                              "AST_home double, AST_away double, DAY_OF_WEEK int")
    got = {r["GAME_ID"]: r["items"] for r in rules.game_facts(g).collect()}
    assert all(("home_pts_high" in got[i]) == (i > 3) and ("away_pts_high" in got[i]) == (i < 4) for i in range(8))
