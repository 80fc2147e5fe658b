"""Least squares from sums and Newton fits against closed forms and optimality conditions."""

import numpy as np
import pytest

from duelframe.operators import gram, newton


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(0, 1, (400, 4)) * [1, 10, 0.1, 1] + [0, 1000, -3, 0]
    x[:, 3] = 7.0                                                    # a constant column
    z = (x[:, :3] - x[:, :3].mean(axis=0)) / x[:, :3].std(axis=0)
    y = 100 + 3 * z[:, 0] - 2 * z[:, 1] + rng.normal(0, 1, 400)
    c = (z[:, 0] - 0.5 * z[:, 2] + rng.normal(0, 0.7, 400) > 0).astype(float)
    fold = rng.integers(0, 5, 400)
    cols = ["a", "b", "c", "d"]
    rows = [(i, *map(float, x[i]), float(y[i]), float(c[i]), int(fold[i])) for i in range(400)]
    df = spark.createDataFrame(rows, "k long, a double, b double, c double, d double, y double, cls double, FOLD int").repartition(6).cache()
    return df, cols, x, y, c, fold


def scaled(x):
    s = x.std(axis=0)
    return np.where(s > 1e-9, (x - x.mean(axis=0)) / np.where(s > 1e-9, s, 1), 0.0)


@pytest.mark.parametrize("alpha", [0.1, 10.0, 1000.0])
def test_ridge_equals_the_closed_form(table, alpha):
    df, cols, x, y, _, fold = table
    p = gram.products(df, cols, "y", "FOLD")
    for without in (None, 2):
        use = np.ones(400, bool) if without is None else fold != without
        z = scaled(x[use])
        w = np.linalg.solve(z.T @ z + alpha * np.eye(4), z.T @ (y[use] - y[use].mean()))
        m = gram.solve(p, "ridge", without, alpha=alpha)
        assert np.allclose(m.weights, w, atol=1e-9)
        if without is not None:
            pred = m.intercept + x[~use] @ m.coefficients
            want = 1 - ((y[~use] - pred) ** 2).sum() / ((y[~use] - y[~use].mean()) ** 2).sum()
            assert gram.r2(p, m, without) == pytest.approx(want, abs=1e-10)


@pytest.mark.parametrize("name,point", [("lasso", {"alpha": 0.5}), ("elastic_net", {"alpha": 0.3, "l1": 0.4}), ("lasso", {"alpha": 50.0})])
def test_lasso_and_elastic_net_are_optimal(table, name, point):
    df, cols, x, y, _, _ = table
    m = gram.solve(gram.products(df, cols, "y"), name, **point)
    z, l1 = scaled(x), point.get("l1", 1.0)
    grad = -z.T @ (y - y.mean() - z @ m.weights) / 400 + point["alpha"] * (1 - l1) * m.weights
    for g, w in zip(grad, m.weights):
        assert abs(g + point["alpha"] * l1 * np.sign(w)) < 1e-8 if w else abs(g) <= point["alpha"] * l1 + 1e-8


def test_grid_search_and_predictions(table):
    df, cols, x, y, _, _ = table
    grid = [{"alpha": a} for a in (0.1, 1.0, 10_000.0)]
    best, mean, std = gram.grid_search(df, cols, "ridge", grid, "y")
    assert mean[2] < max(mean[:2]) and len(std) == 3 and all(s >= 0 for s in std)
    rows = best.transform(df).select("k", "prediction").orderBy("k").collect()
    assert np.allclose([r["prediction"] for r in rows], best.intercept + x @ best.coefficients)


def _gradient(model, z, t, cost, loss, width, penal_b, eps=0.1):
    w = np.append(model.weights, model.intercept)
    z1 = np.column_stack([z, np.ones(len(z))])
    _, d, _ = newton._loss(loss, eps)(z1 @ w, t, width)
    own = np.append(np.ones(z.shape[1]), 1.0 if penal_b else 0.0)
    lin = np.append(np.zeros(z.shape[1]), 1.0 if loss == "one_class" else 0.0)
    return cost * z1.T @ d + own * w + lin


def test_logistic_fits_of_all_folds_are_optimal(table):
    df, cols, x, _, c, fold = table
    p = gram.products(df, cols, "cls", "FOLD")
    problems = [newton.Problem(newton.feature_map(p, f), cost, "logistic", f, keep_intercept=True) for f in (None, 0, 3) for cost in (0.1, 10.0)]
    for q, m in zip(problems, newton.minimise(df, cols, problems, "cls", "FOLD")):
        use = np.ones(400, bool) if q.fold is None else fold != q.fold
        z, t = scaled(x[use]), 2 * c[use] - 1
        assert np.allclose(q.map(x[use])[:, :3], z[:, :3])
        assert np.abs(_gradient(m, z, t, q.cost, "logistic", 1.0, True)).max() < 1e-4
        f = z @ m.weights + m.intercept
        value = (m.weights @ m.weights + m.intercept ** 2) / 2 + q.cost * np.logaddexp(0, -t * f).sum()
        assert value == pytest.approx(m.objective, rel=1e-9)


@pytest.mark.parametrize("kernel", ["linear", "rbf"])
def test_support_vectors_are_optimal(table, kernel):
    df, cols, x, _, c, _ = table
    p = gram.products(df, cols, "cls")
    q = newton.Problem(newton.feature_map(p, None, kernel, waves=60), 1.0, "hinge")
    m = newton.minimise(df, cols, [q], "cls")[0]
    z, t = q.map(x), 2 * c - 1
    assert np.abs(_gradient(m, z, t, 1.0, "hinge", newton.WIDTHS[-1], False)).max() < 1e-3

    def hinge(w, b):
        return w @ w / 2 + np.maximum(0, 1 - t * (z @ w + b)).sum()
    rng = np.random.default_rng(0)
    at = hinge(m.weights, m.intercept)
    assert at <= m.objective + 1e-9
    for size in (0.3, 0.1):
        assert all(hinge(m.weights + rng.normal(0, size, len(m.weights)), m.intercept + rng.normal(0, size)) > at - 1e-3 * at for _ in range(50))
    got = {r["k"]: r for r in m.transform(df, ["k"], "class").collect()}
    assert np.allclose([got[i]["decision"] for i in range(400)], z @ m.weights + m.intercept)
    assert np.mean([got[i]["prediction"] == c[i] for i in range(400)]) > 0.75


def test_kernel_separates_what_a_line_cannot(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(0, 1, (300, 2))
    c = ((x ** 2).sum(axis=1) > 1.4).astype(int)
    df = spark.createDataFrame([(*map(float, v), int(k)) for v, k in zip(x, c)], "a double, b double, label int").repartition(3).cache()
    p = gram.products(df, ["a", "b"])
    line, waves = newton.minimise(df, ["a", "b"], [newton.Problem(newton.feature_map(p, None, k), 10.0, "hinge") for k in ("linear", "rbf")])
    assert ((waves.decide(x) > 0) == c).mean() > 0.95 > ((line.decide(x) > 0) == c).mean()


def test_tube_regression_is_optimal(table):
    df, cols, x, y, _, _ = table
    p = gram.products(df, cols, "y")
    q = newton.Problem(newton.feature_map(p), 1.0, "tube", eps=0.5, scale=4.0, start=np.array([0, 0, 0, 0, float(y.mean())]))
    m = newton.minimise(df, cols, [q], "y")[0]
    z = scaled(x)
    assert np.abs(_gradient(m, z, y, 1.0, "tube", 4 * newton.WIDTHS[-1], False, 0.5)).max() < 1e-3
    assert np.allclose(m.weights[:3], [3, -2, 0], atol=0.3)
    rows = m.transform(df, ["k"], "number").orderBy("k").collect()
    assert np.allclose([r["prediction"] for r in rows], z @ m.weights + m.intercept)


def test_fold_scores_and_platt(table):
    df, cols, x, _, c, fold = table
    p = gram.products(df, cols, "cls", "FOLD")
    models = newton.minimise(df, cols, [newton.Problem(newton.feature_map(p, f), 1.0, "hinge", f) for f in range(5)], "cls", "FOLD")
    scores = newton.fold_scores(df, models, list(range(5)), "cls")
    held = np.zeros(400)
    for f, m in enumerate(models):
        held[fold == f] = m.decide(x[fold == f])
        assert scores[f] == pytest.approx(((held[fold == f] > 0) == (c[fold == f] > 0)).mean())
    a, b = newton.platt(df, models, list(range(5)), "cls")
    pos, neg = (c > 0).sum(), (c <= 0).sum()
    t = np.where(c > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    e = 1 / (1 + np.exp(-(a * held + b))) - t
    assert abs(e @ held) < 1e-6 and abs(e.sum()) < 1e-6 and a > 0


def test_r2_of_fold_scores(table):
    df, cols, x, y, _, fold = table
    p = gram.products(df, cols, "y", "FOLD")
    m = newton.minimise(df, cols, [newton.Problem(newton.feature_map(p, 1), 1.0, "tube", 1, scale=4.0, start=np.array([0, 0, 0, 0, 100.0]))], "y", "FOLD")
    got = newton.fold_scores(df, m, [1], "y", kind="number")[0]
    e, t = m[0].decide(x[fold == 1]) - y[fold == 1], y[fold == 1]
    assert got == pytest.approx(1 - (e @ e) / ((t - t.mean()) ** 2).sum())


def test_one_class_leaves_out_its_share(spark):
    rng = np.random.default_rng(8)
    x = np.concatenate([rng.normal(0, 1, (380, 2)), rng.normal(6, 1, (20, 2))])
    df = spark.createDataFrame([(i, *map(float, v), 1.0) for i, v in enumerate(x)], "k long, a double, b double, one double").repartition(3).cache()
    q = newton.one_class_problem(gram.products(df, ["a", "b"], "one"), 0.1, 400)
    m = newton.minimise(df, ["a", "b"], [q], "one")[0]
    z = q.map(x)
    f = z @ m.weights + m.intercept
    assert abs((f < 0).mean() - 0.1) <= 1 / 400 ** 0.5
    assert np.abs(_gradient(m, z, np.ones(400), q.cost, "one_class", q.scale * newton.WIDTHS[-1], False)).max() < 1e-4

    def objective(w, b):                                              # w.w / 2 - rho + sum max(0, rho - w.z) / (nu n)
        return w @ w / 2 + b + q.cost * np.maximum(0, -(z @ w + b)).sum()
    mean = z.mean(axis=0)                                             # the kernel density score and its own quantile
    best = min(objective(c * mean, -np.quantile(z @ (c * mean), 0.1)) for c in (0.25, 0.5, 1.0, 2.0))
    assert objective(m.weights, m.intercept) < best
