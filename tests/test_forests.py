"""Trees, forests and boosting: grown trees against a plain search, nested axes against separate fits."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier
from pyspark.sql import functions as F

from duelframe.operators import bagging, forests, models
from duelframe.operators.split import fold_ids


def naive_tree(codes, y, w, least, depth):
    """(predictions of the rows, number of nodes) of the tree that takes the best split of all columns at every node."""
    use = w > 0
    pred, count = np.zeros(len(y)), [0]

    def build(rows, level):
        count[0] += 1
        r = rows[use[rows]]
        mean = (w[r] * y[r]).sum() / w[r].sum()
        pred[rows] = mean
        best = None
        if level < depth and ((y[r] - mean) ** 2 * w[r]).sum() > 1e-9 * (y[r] ** 2 * w[r]).sum():
            for f in range(codes.shape[1]):
                for c in np.unique(codes[r, f])[:-1]:
                    a, b = r[codes[r, f] <= c], r[codes[r, f] > c]
                    if min(w[a].sum(), w[b].sum()) < least:
                        continue
                    gain = (w[a] * y[a]).sum() ** 2 / w[a].sum() + (w[b] * y[b]).sum() ** 2 / w[b].sum() - (w[r] * y[r]).sum() ** 2 / w[r].sum()
                    if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                        best = (gain, f, c)
        if best:
            _, f, c = best
            build(rows[codes[rows, f] <= c], level + 1)
            build(rows[codes[rows, f] > c], level + 1)

    build(np.arange(len(y)), 0)
    return pred, count[0]


@pytest.mark.parametrize("seed", range(6))
def test_grown_trees_equal_a_plain_search(seed):
    rng = np.random.default_rng(seed)
    codes = rng.integers(0, rng.choice([3, 20, 64]), (80, 4)).astype(np.uint8)
    y = rng.integers(0, 2, 80).astype(float) if seed % 2 else rng.normal(0, 1, 80)
    w = rng.integers(0, 3, 80).astype(float)
    least, depth = float(rng.choice([1, 3])), int(rng.choice([2, 30]))
    tree = bagging.grow(codes, y, w, 4, least, depth, np.random.default_rng(0))
    one = forests.Trees(np.array([0]), np.ones(1), tree["feature"], tree["code"].astype(float), tree["left"], tree["right"], tree["value"])
    want, nodes = naive_tree(codes, y, w, least, depth)
    assert len(tree["value"]) == nodes
    assert np.allclose(one.staged(codes, [depth], [1])[0, 0], want)


def test_bootstrap_weights_are_poisson():
    w = np.concatenate([bagging.weights_of(np.arange(5000) * 977, t) for t in range(4)])
    assert abs(w.mean() - 1) < 0.03 and abs(w.var() - 1) < 0.05 and abs((w == 0).mean() - np.exp(-1)) < 0.02
    assert (bagging.weights_of(np.arange(100), 1) != bagging.weights_of(np.arange(100), 2)).any()


@pytest.fixture(scope="module")
def rings(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(0, 1, (500, 3))
    y = (x[:, 0] ** 2 + x[:, 1] ** 2) * 3 + rng.normal(0, 0.3, 500)
    rows = [(i, *map(float, x[i]), float(y[i]), float(y[i] > 4)) for i in range(500)]
    df = spark.createDataFrame(rows, "GAME_ID long, a double, b double, c double, y double, cls double").repartition(4)
    return fold_ids(df, ["GAME_ID"], 3, 42).cache(), ["a", "b", "c"]


def test_cut_trees_equal_shallow_fits(spark, rings):
    df, cols = rings
    vec = VectorAssembler(inputCols=cols, outputCol="features").transform(df)
    for kind, est, label in (("share", DecisionTreeClassifier, "cls"), ("mean", DecisionTreeRegressor, "y")):
        deep = forests.trees_of(est(labelCol=label, maxDepth=8, seed=1).fit(vec), kind == "share")
        got = forests.staged_scores(df, cols, deep, [2, 4, 8], [1], kind, label)[0]
        for depth, score in zip((2, 4, 8), got):
            own = forests.trees_of(est(labelCol=label, maxDepth=depth, seed=1).fit(vec), kind == "share")
            assert score == pytest.approx(forests.staged_scores(df, cols, own, [depth], [1], kind, label)[0, 0])


def test_first_rounds_equal_shorter_boosting(spark, rings):
    df, cols = rings
    vec = VectorAssembler(inputCols=cols, outputCol="features").transform(df)
    long = forests.trees_of(GBTRegressor(labelCol="y", maxIter=6, seed=1).fit(vec), False)
    short = GBTRegressor(labelCol="y", maxIter=3, seed=1).fit(vec).transform(vec).select("y", "prediction").toPandas()
    want = 1 - ((short["y"] - short["prediction"]) ** 2).sum() / ((short["y"] - short["y"].mean()) ** 2).sum()
    assert forests.staged_scores(df, cols, long, [5], [3, 6], "sum", "y")[0, 0] == pytest.approx(want)


def test_forests_learn_and_nested_axes_agree(spark, rings):
    df, cols = rings
    train = df.withColumnRenamed("y", "label")
    wide = bagging.search(train, cols, True, [10, 20], [2, 30], [1], [0, 1, 2])
    alone = bagging.search(train, cols, True, [10], [2], [1], [0, 1, 2])
    assert np.allclose(wide[10, 2, 1], alone[10, 2, 1])
    assert np.mean(wide[20, 30, 1]) > max(0.75, np.mean(wide[20, 2, 1]) + 0.05)
    again = bagging.search(train.repartition(7), cols, True, [10], [2], [1], [0, 1, 2])
    assert np.allclose(again[10, 2, 1], alone[10, 2, 1])
    model = bagging.fit(train, cols, True, 20, 30, 1)
    rows = model.transform(train, ["label"]).collect()
    y, f = np.array([r["label"] for r in rows]), np.array([r["prediction"] for r in rows])
    assert 1 - ((y - f) ** 2).sum() / ((y - y.mean()) ** 2).sum() > 0.95
    assert model.importances()[2] < min(model.importances()[:2]) and sum(model.importances()) == pytest.approx(1)


def test_equal_rows_are_each_scored(spark, rings):
    df, cols = rings
    train = df.drop("GAME_ID").withColumnRenamed("y", "label")
    twice = train.unionByName(train)
    got = bagging.search(twice, cols, True, [10], [3], [1], [0, 1, 2])[10, 3, 1]
    assert all(0.3 < s < 1 for s in got)


def test_boosting_matches_its_definition(spark, rings):
    df, cols = rings
    train = df.withColumnRenamed("y", "label")
    found = bagging.search_boosted(train, cols, [5, 20], [0.1, 0.5], 3, [0, 1, 2])
    assert np.allclose(found[5, 0.1], bagging.search_boosted(train, cols, [5], [0.1], 3, [0, 1, 2])[5, 0.1])
    assert np.mean(found[20, 0.5]) > np.mean(found[5, 0.1])
    model = bagging.fit_boosted(train, cols, 20, 0.5, 3)
    rows = model.transform(train, ["label", *cols]).collect()
    edges = bagging.edges_of(train, cols)
    codes, y = bagging.encode(np.array([[r[c] for c in cols] for r in rows]), edges), np.array([r["label"] for r in rows])
    f = np.full(len(y), y.mean())
    for _ in range(20):
        f += 0.5 * naive_tree(codes, y - f, np.ones(len(y)), 1.0, 3)[0]
    assert np.allclose([r["prediction"] for r in rows], f, atol=1e-6)


@pytest.mark.parametrize("name", ["ridge", "svr", "random_forest", "gradient_boosting"])
def test_saved_models_score_alike(spark, rings, tmp_path, name):
    df, cols = rings
    train = df.withColumnRenamed("y", "label").drop("cls")
    model, mean, std = models.search_regressor(train, cols, name, quick=True, folds=3)
    assert len(mean) == len(std) == 1
    models.save_versioned(model, str(tmp_path), name)
    loaded = models.load_latest(spark, str(tmp_path), name)
    a, b = ({r["GAME_ID"]: r["prediction"] for r in models.predicted(m, train, ["GAME_ID"]).collect()} for m in (model, loaded))
    assert a == b and len(a) == 500


@pytest.mark.parametrize("name", ["svm", "decision_tree", "random_forest", "gradient_boosting"])
def test_classifiers_separate_rings(spark, rings, name):
    df, cols = rings
    train = df.withColumnRenamed("cls", "label").drop("y")
    model, mean, _ = models.search_classifier(train, cols, name, quick=True, folds=3)
    rows = models.scored_classification(model, train, ["GAME_ID"]).collect()
    assert mean[0] > 0.75 and np.mean([r["label"] == r["prediction"] for r in rows]) > 0.8
    assert all(0 <= r["probability"] <= 1 for r in rows)


def test_boosted_classes_equal_spark_ml(spark, rings):
    df, cols = rings
    # few values, many zeros and one constant beside the drawn columns; shallow, so that no two splits gain the same
    train = (df.withColumnRenamed("cls", "label").drop("y").withColumn("few", (F.col("GAME_ID") * 7 % 5).cast("double"))
             .withColumn("half", F.when(F.col("GAME_ID") % 2 == 0, F.col("a") + F.col("c")).otherwise(0.0)).withColumn("one", F.lit(1.0)))
    cols = [*cols, "few", "half", "one"]
    found, model = bagging.boost_classes(train, cols, [4, 12], 0.1, 2, [0, 1, 2])
    vec = VectorAssembler(inputCols=cols, outputCol="features").transform(train).cache()
    for f in (0, 1, 2):
        for rounds in (4, 12):
            own = GBTClassifier(maxIter=rounds, maxDepth=2, seed=42).fit(vec.where(F.col("FOLD") != f)).transform(vec.where(F.col("FOLD") == f))
            assert found[rounds][f] == pytest.approx(own.agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0])
    want = GBTClassifier(maxIter=4, maxDepth=2, seed=42).fit(vec).transform(vec).select("GAME_ID", "prediction", vector_to_array("probability")[1].alias("p"))
    want = {r["GAME_ID"]: r for r in want.collect()}
    for r in model(4).transform(train, ["GAME_ID"]).collect():
        assert r["prediction"] == want[r["GAME_ID"]]["prediction"] and r["probability"] == pytest.approx(want[r["GAME_ID"]]["p"])


def test_boosted_classifier_is_no_chain_of_jobs(spark, rings, tmp_path):
    df, cols = rings
    train = df.withColumnRenamed("cls", "label").drop("y")
    sc = spark.sparkContext
    sc.setJobGroup("boosting", "boosting")
    model, mean, std = models.search_classifier(train, cols, "gradient_boosting", folds=3)
    jobs = sc.statusTracker().getJobIdsForGroup("boosting")
    sc.setJobGroup("tests", "tests")
    assert 0 < len(jobs) < 40 and len(mean) == len(std) == 2
    models.save_versioned(model, str(tmp_path), "boosted")
    loaded = models.load_latest(spark, str(tmp_path), "boosted")
    a, b = ({r["GAME_ID"]: r["probability"] for r in models.scored_classification(m, train, ["GAME_ID"]).collect()} for m in (model, loaded))
    assert a == b and len(a) == 500
