"""Supervised models: configured grids, cross-validation, scoring, importances, the versioned store.

Folds come from a key-hash fold column, so they are repeatable and
independent of partitioning.  A grid is searched with as few passes as its
family allows: least squares from one aggregation (`gram`), logistic
regression and support vectors of all folds side by side (`newton`), nested
axes of trees from one fit a fold (`forests`); Spark ML grows the trees and fits
naive Bayes.  Test metrics are the exact metric operators of
``duelframe.operators.metrics``.  Models are saved under version folders,
Spark ML pipelines by their own writer and plain ones as a table.
"""

from __future__ import annotations

import itertools
import time
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier, GBTClassifier, LinearSVC, LogisticRegression, NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duelframe.operators import bagging, forests, gram, metrics, newton
from duelframe.session import materialise

def _pipeline(features: Sequence[str], est, scale: bool = True) -> Pipeline:
    stages = [VectorAssembler(inputCols=list(features), outputCol="raw", handleInvalid="error")]
    if scale:
        stages.append(StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True))
    else:
        stages[0].setOutputCol("features")
    return Pipeline(stages=stages + [est])


# Spark ML's trees: node memory for whole levels at once
_TREES = {"featuresCol": "features", "labelCol": "label", "seed": 42, "maxMemoryInMB": 256}

#: fixed values: the configured grids, penalties on scikit-learn's scale
CLASSIFIER_GRIDS: dict[str, dict[str, list]] = {
    "logistic_regression": {"C": [0.1, 1.0, 10.0]},
    "random_forest": {"numTrees": [100, 200], "maxDepth": [10, 20, 30], "minInstancesPerNode": [1, 3]},
    "decision_tree": {"maxDepth": [5, 10, 15], "minInstancesPerNode": [1, 3, 5]},
    "svm": {"C": [0.1, 1.0, 10.0], "kernel": ["rbf", "linear"]},
    "naive_bayes": {},
    "gradient_boosting": {"maxIter": [20, 50]},
}
REGRESSOR_GRIDS: dict[str, dict[str, list]] = {
    "ridge": {"alpha": [0.1, 1.0, 10.0]},
    "lasso": {"alpha": [0.1, 1.0, 10.0]},
    "elastic_net": {"alpha": [0.1, 1.0], "l1": [0.2, 0.5, 0.8]},
    "random_forest": {"numTrees": [50, 100], "maxDepth": [3, 5, 30]},
    "gradient_boosting": {"maxIter": [50, 100], "stepSize": [0.01, 0.1]},
    "svr": {"C": [0.1, 1.0, 10.0, 100.0], "kernel": ["rbf", "linear"]},
}


def grid_points(axes: dict[str, list], quick: bool = False) -> list[dict]:
    """All combinations in order, the last axis fastest; ``quick`` keeps the
    first value of each axis (the quick-test job only)."""
    return [dict(zip(axes, values)) for values in itertools.product(*[v[:1] if quick else v for v in axes.values()])]


BOOST_DEPTH = 5            # fixed value: depth of a boosted tree
BOOST_STEP = 0.1           # fixed value: learning rate of the boosted classifier, Spark ML's own
PART_BYTES = 16 << 20      # of feature vectors in a partition that a fit reads


def side_by_side(spark, calls: Sequence, parts: int = 1) -> list:
    """Results of independent jobs of ``parts`` tasks, as many at once as the cores take."""
    at_once = max(1, min(len(calls), spark.sparkContext.defaultParallelism // parts))
    with ThreadPoolExecutor(at_once) as pool:
        return list(pool.map(lambda call: inheritable_thread_target(spark)(call)(), calls))


# -- searches: (model, mean metric by grid point, std by grid point) ----------------

def _chosen(scores: np.ndarray) -> tuple[int, list[float], list[float]]:
    """Best grid point (ties: the first), means and stds over the folds."""
    mean = scores.mean(axis=1)
    return int(mean.argmax()), mean.tolist(), scores.std(axis=1).tolist()


def _search_margin(train: DataFrame, features: Sequence[str], loss: str, points: list[dict], folds: list[int], kind: str):
    """Logistic regression, support vector classifier or regressor: all folds and grid points side by side."""
    p = gram.products(train, features, "label", "FOLD")
    total = p.total()
    target = p.shift[-1] + total[0, -1] / total[0, 0]
    spread = float(np.sqrt(max(total[-1, -1] / total[0, 0] - (total[0, -1] / total[0, 0]) ** 2, 1e-12)))
    maps = {(f, k): newton.feature_map(p, f, k) for f in (*folds, None) for k in {x.get("kernel", "linear") for x in points}}

    def problem(point: dict, f: int | None) -> newton.Problem:
        m = maps[f, point.get("kernel", "linear")]
        start = np.append(np.zeros(m.width), target) if loss == "tube" else None
        return newton.Problem(m, point["C"], loss, f, keep_intercept=loss == "logistic", scale=spread if loss == "tube" else 1.0, start=start)

    problems = [problem(x, f) for x in points for f in (*folds, None)]
    models = newton.minimise(train, features, problems, "label", "FOLD")
    held = [m for q, m in zip(problems, models) if q.fold is not None]
    scores = np.array(newton.fold_scores(train, held, folds * len(points), kind=kind)).reshape(len(points), len(folds))
    best, mean, std = _chosen(scores)
    model = models[best * (len(folds) + 1) + len(folds)]
    if loss == "hinge":
        model.platt = newton.platt(train, held[best * len(folds):(best + 1) * len(folds)], folds)
    return model, mean, std


def _estimator(name: str, regression: bool, point: dict):
    kinds = {("random_forest", True): RandomForestRegressor, ("gradient_boosting", True): GBTRegressor, ("random_forest", False): RandomForestClassifier,
             ("gradient_boosting", False): GBTClassifier, ("decision_tree", False): DecisionTreeClassifier}
    return kinds[name, regression](**_TREES, **point)


def _search_trees(train: DataFrame, features: Sequence[str], name: str, regression: bool, points: list[dict], folds: list[int]):
    """Depth and size are nested: one fit a fold and value of the other axis, then one model at the best point."""
    if bagging.fits_in_a_task(train.count(), len(features)):
        if name == "random_forest":
            return _search_bagged(train, features, regression, points, folds)
        if name == "gradient_boosting" and regression:
            found, model = bagging.boost_numbers(train, features, sorted({x["maxIter"] for x in points}), sorted({x["stepSize"] for x in points}), BOOST_DEPTH, folds)
            best, mean, std = _chosen(np.array([found[x["maxIter"], x["stepSize"]] for x in points]))
            return model(points[best]["maxIter"], points[best]["stepSize"]), mean, std
        if name == "gradient_boosting":
            found, model = bagging.boost_classes(train, features, [x["maxIter"] for x in points], BOOST_STEP, BOOST_DEPTH, folds)
            best, mean, std = _chosen(np.array([found[x["maxIter"]] for x in points]))
            return model(points[best]["maxIter"]), mean, std
    size = {"random_forest": "numTrees", "gradient_boosting": "maxIter"}.get(name)
    sizes = sorted({x[size] for x in points}) if size else [1]
    depths = sorted({x.get("maxDepth", 5) for x in points})
    rest = [dict(r) for r in dict.fromkeys(tuple((k, v) for k, v in x.items() if k not in (size, "maxDepth")) for x in points)]
    kind = {("random_forest", True): "mean", ("gradient_boosting", True): "sum", ("gradient_boosting", False): "margin"}.get((name, regression), "share")
    assembler = VectorAssembler(inputCols=list(features), outputCol="features")
    # a fit is a chain of short jobs, so its rows lie in no more partitions than their size asks for
    parts = max(1, -(-train.count() * (len(features) + 2) * 8 // PART_BYTES))
    vectors = materialise(assembler.transform(train).select("features", "label", "FOLD").coalesce(parts), "vectors")
    full = {"maxDepth": max(depths), **({size: max(sizes)} if size else {})}

    def one(other: dict, f: int):
        fitted = _estimator(name, regression, {**full, **other}).fit(vectors.where(F.col("FOLD") != f))
        return forests.staged_scores(train.where(F.col("FOLD") == f), features, forests.trees_of(fitted, kind == "share"), depths, sizes, kind)

    found = side_by_side(train.sparkSession, [lambda o=o, f=f: one(o, f) for o in rest for f in folds], parts)
    at = {(i, f): s for (i, f), s in zip(itertools.product(range(len(rest)), folds), found)}
    scores = np.array([[at[rest.index({k: v for k, v in x.items() if k not in (size, "maxDepth")}), f][
        sizes.index(x[size]) if size else 0, depths.index(x.get("maxDepth", 5))] for f in folds] for x in points])
    best, mean, std = _chosen(scores)
    last = _estimator(name, regression, {"maxDepth": 5, **points[best]}).fit(vectors)
    return PipelineModel(stages=[assembler, last]), mean, std


def _search_bagged(train: DataFrame, features: Sequence[str], regression: bool, points: list[dict], folds: list[int]):
    """Forests whose training rows a task can hold: all folds, sizes and depths from one growth."""
    def axis(name: str, default: float) -> list:
        return sorted({x.get(name, default) for x in points})

    found = bagging.search(train, features, regression, axis("numTrees", 20), axis("maxDepth", 5), axis("minInstancesPerNode", 1), folds)
    at = [(x["numTrees"], x["maxDepth"], x.get("minInstancesPerNode", 1)) for x in points]
    best, mean, std = _chosen(np.array([found[a] for a in at]))
    return bagging.fit(train, features, regression, *at[best]), mean, std


def search_classifier(train: DataFrame, features: Sequence[str], name: str, quick: bool = False, folds: int = 5):
    """Grid search of a configured classifier by accuracy over the FOLD column."""
    points, every = grid_points(CLASSIFIER_GRIDS[name], quick), list(range(folds))
    if name in ("logistic_regression", "svm"):
        return _search_margin(train, features, "logistic" if name == "logistic_regression" else "hinge", points, every, "class")
    if name == "naive_bayes":
        est, _ = classifier(name, 0)
        return cross_validate(train, features, est, [], accuracy_eval())
    return _search_trees(train, features, name, False, points, every)


def search_regressor(train: DataFrame, features: Sequence[str], name: str, quick: bool = False, folds: int = 5, known: gram.Products | None = None):
    """Grid search of a configured regressor by R2 over the FOLD column; ``known`` are the train part's sums of products, if at hand."""
    points = grid_points(REGRESSOR_GRIDS[name], quick)
    if name in gram.SOLVERS:
        return gram.grid_search(train, features, name, points, known=known)
    if name == "svr":
        return _search_margin(train, features, "tube", points, list(range(folds)), "number")
    return _search_trees(train, features, name, True, points, list(range(folds)))


# -- the same models as plain Spark ML estimators -------------------------------------

def classifier(name: str, n_train: int, quick: bool = False):
    """(estimator, param grid) for a configured classifier.

    The grid values are fixed values of the configuration.  Penalties follow
    scikit-learn's scale: C -> regParam = 1 / (C * n).  ``quick`` keeps the
    first value of each grid axis (the quick-test job only).
    """
    if name == "logistic_regression":
        est = LogisticRegression(featuresCol="features", labelCol="label", maxIter=1000)
        grid = [("regParam", [1.0 / (c * n_train) for c in (0.1, 1.0, 10.0)])]
    elif name == "random_forest":
        est = RandomForestClassifier(featuresCol="features", labelCol="label", seed=42)
        grid = [("numTrees", [100, 200]), ("maxDepth", [10, 20, 30]), ("minInstancesPerNode", [1, 3])]
    elif name == "decision_tree":
        est = DecisionTreeClassifier(featuresCol="features", labelCol="label", seed=42)
        grid = [("maxDepth", [5, 10, 15]), ("minInstancesPerNode", [1, 3, 5])]
    elif name == "svm_linear":
        est = LinearSVC(featuresCol="features", labelCol="label", maxIter=100)
        grid = [("regParam", [1.0 / (c * n_train) for c in (0.1, 1.0, 10.0)])]
    elif name == "naive_bayes":
        est = NaiveBayes(featuresCol="features", labelCol="label", modelType="gaussian")
        grid = []
    elif name == "gradient_boosting":
        est = GBTClassifier(featuresCol="features", labelCol="label", seed=42)
        grid = [("maxIter", [20, 50])]
    else:
        raise KeyError(name)
    if quick:
        grid = [(p, v[:1]) for p, v in grid]
    return est, grid


def regressor(name: str, label_std: float, n_train: int, quick: bool = False):
    """(estimator, grid) with scikit-learn's penalty scales: ridge alpha ->
    regParam = alpha * std_pop(y) / n (normal solver, no standardisation),
    lasso alpha -> regParam = alpha, elastic net -> l1 = a*r, l2 = a*(1-r)*std."""
    if name == "ridge":
        est = LinearRegression(featuresCol="features", labelCol="label", elasticNetParam=0.0,
                               standardization=False, solver="normal")
        grid = [("regParam", [a * label_std / n_train for a in (0.1, 1.0, 10.0)])]
    elif name == "lasso":
        est = LinearRegression(featuresCol="features", labelCol="label", elasticNetParam=1.0,
                               standardization=False, maxIter=1000)
        grid = [("regParam", [0.1, 1.0, 10.0])]
    elif name == "elastic_net":
        est = LinearRegression(featuresCol="features", labelCol="label", standardization=False, maxIter=1000)
        combos = [(a, r) for a in (0.1, 1.0) for r in (0.2, 0.5, 0.8)]
        grid = [("__pairs", [(a * r + a * (1 - r) * label_std, (a * r) / (a * r + a * (1 - r) * label_std))
                             for a, r in combos])]
    elif name == "random_forest":
        est = RandomForestRegressor(featuresCol="features", labelCol="label", seed=42)
        grid = [("numTrees", [50, 100]), ("maxDepth", [3, 5, 30])]
    elif name == "gradient_boosting":
        est = GBTRegressor(featuresCol="features", labelCol="label", seed=42)
        grid = [("maxIter", [50, 100]), ("stepSize", [0.01, 0.1])]
    else:
        raise KeyError(name)
    if quick:
        grid = [(p, v[:1]) for p, v in grid]
    return est, grid


def _grid(est, grid):
    b = ParamGridBuilder()
    pairs = [g for g in grid if g[0] == "__pairs"]
    for p, vals in grid:
        if p != "__pairs":
            b = b.addGrid(est.getParam(p), vals)
    maps = b.build()
    if pairs:
        out = []
        for m in maps:
            for reg, enet in pairs[0][1]:
                mm = dict(m)
                mm[est.getParam("regParam")] = reg
                mm[est.getParam("elasticNetParam")] = enet
                out.append(mm)
        maps = out
    return maps


def cross_validate(train: DataFrame, features: Sequence[str], est, grid, evaluator, fold_col: str = "FOLD",
                   parallelism: int | None = None, scale: bool = True, folds: int = 5):
    """Spark ML's grid search with k-fold CV over the precomputed fold column, at
    most half the cores' number of fits at once; returns (best PipelineModel,
    mean metric per grid point, std per grid point)."""
    if parallelism is None:
        parallelism = max(1, train.sparkSession.sparkContext.defaultParallelism // 2)
    pipe = _pipeline(features, est, scale)
    maps = _grid(est, grid) or [{}]
    cv = CrossValidator(estimator=pipe, estimatorParamMaps=maps, evaluator=evaluator, foldCol=fold_col,
                        numFolds=folds, parallelism=parallelism, seed=42)
    model = cv.fit(train)
    return model.bestModel, list(model.avgMetrics), list(model.stdMetrics or [0.0] * len(maps))


def scored_classification(model, test: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, label, prediction and probability of class 1."""
    if isinstance(model, newton.Margin):
        p = model.transform(test, [*keys, "label"], "class")
        return p.select(*keys, F.col("label").cast("int").alias("label"), "prediction", "probability")
    if isinstance(model, bagging.Forest):
        p = model.transform(test, [*keys, "label"])
        return p.select(*keys, F.col("label").cast("int").alias("label"), "prediction", "probability")
    p = model.transform(test)
    return p.select(*keys, F.col("label").cast("int").alias("label"), F.col("prediction").cast("int").alias("prediction"),
                    vector_to_array("probability")[1].alias("probability"))


def predicted(model, rows: DataFrame, keep: Sequence[str]) -> DataFrame:
    """``keep`` and the predicted number."""
    if isinstance(model, newton.Margin):
        return model.transform(rows, list(keep), "number").drop("decision")
    if isinstance(model, bagging.Forest):
        return model.transform(rows, list(keep))
    return model.transform(rows).select(*keep, "prediction")


def classification_test_metrics(scored: DataFrame) -> dict:
    s = metrics.classification_scores(scored).first().asDict()
    s["ROC_AUC"] = metrics.roc_auc(scored).first()["ROC_AUC"]
    return s


def importances(model, features: Sequence[str], k: int = 10) -> list[tuple[str, float]]:
    """Feature importances (trees) or |weights| of the standardised columns (linear), top k; none for others."""
    if isinstance(model, (gram.LinearModel, newton.Margin, bagging.Forest)):
        vals = model.importances() or []
    else:
        last = model.stages[-1]
        vals = last.featureImportances.toArray() if hasattr(last, "featureImportances") else []
    pairs = sorted(zip(features, [float(v) for v in vals]), key=lambda t: (-t[1], features.index(t[0])))
    return pairs[:k]


_PLAIN = "kind string, features array<string>, vectors map<string, array<double>>, numbers map<string, double>"


def _plain(model) -> tuple:
    """A linear or margin model as one row."""
    if isinstance(model, bagging.Forest):
        t = model.trees
        arrays = {c: np.asarray(getattr(t, c), float).tolist() for c in ("roots", "weights", "feature", "threshold", "left", "right", "value")}
        return ("forest", model.features, {**arrays, "gains": model.gains.tolist()}, {"regression": float(model.regression), "base": model.base, "margin": float(model.margin)})
    if isinstance(model, gram.LinearModel):
        return ("linear", model.features, {"coefficients": model.coefficients.tolist(), "weights": model.weights.tolist()}, {"intercept": model.intercept})
    m = model.map
    waves = {} if m.omega is None else {"omega": m.omega.ravel().tolist(), "phase": m.phase.tolist()}
    numbers = {"intercept": model.intercept, "objective": model.objective, "gradient": model.gradient}
    if model.platt is not None:
        numbers |= {"slope": model.platt[0], "offset": model.platt[1]}
    return ("margin", model.features, {"mean": m.mean.tolist(), "std": m.std.tolist(), "weights": model.weights.tolist(), **waves}, numbers)


def _from_plain(row):
    v, n = {k: np.array(x) for k, x in row["vectors"].items()}, row["numbers"]
    if row["kind"] == "forest":
        whole = {c: v[c].astype(int) for c in ("roots", "feature", "left", "right")}
        return bagging.Forest(list(row["features"]), forests.Trees(weights=v["weights"], threshold=v["threshold"], value=v["value"], **whole),
                              bool(n["regression"]), v["gains"], n["base"], bool(n.get("margin", 0.0)))
    if row["kind"] == "linear":
        return gram.LinearModel(list(row["features"]), v["coefficients"], n["intercept"], v["weights"])
    omega = v["omega"].reshape(len(v["phase"]), -1) if "phase" in v else None
    return newton.Margin(list(row["features"]), newton.FeatureMap(v["mean"], v["std"], omega, v.get("phase")), v["weights"], n["intercept"],
                         n["objective"], n["gradient"], (n["slope"], n["offset"]) if "slope" in n else None)


def save_versioned(model, root: str, name: str) -> str:
    """Write the model under ``root/name/version=<ms>``; return the path."""
    path = f"{root.rstrip('/')}/{name}/version={int(time.time() * 1000)}"
    if isinstance(model, PipelineModel):
        model.write().overwrite().save(path)
    else:
        from pyspark.sql import SparkSession
        SparkSession.active().createDataFrame([_plain(model)], _PLAIN).coalesce(1).write.parquet(f"{path}/plain")
    return path


def _versions(spark, root: str, name: str) -> list[str]:
    """Version folders of ``name``, oldest first (listed through Hadoop's file system)."""
    base = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{name}".rstrip("/"))
    fs = base.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(st.getPath().getName() for st in fs.listStatus(base) if st.isDirectory())


def load_latest(spark, root: str, name: str):
    """Load the newest saved version of ``name``."""
    path = f"{root.rstrip('/')}/{name}/{_versions(spark, root, name)[-1]}"
    if _versions(spark, path, "") == ["plain"]:
        return _from_plain(spark.read.parquet(f"{path}/plain").first())
    return PipelineModel.load(path)


def save_results(df: DataFrame, root: str, name: str) -> str:
    """Write a result table as the next version of ``name``; return the path."""
    path = f"{root.rstrip('/')}/{name}/version={int(time.time() * 1000)}"
    df.write.parquet(path)
    return path


def latest_results(spark, root: str, name: str) -> DataFrame:
    """The newest version of a result table."""
    return spark.read.parquet(f"{root.rstrip('/')}/{name}/{_versions(spark, root, name)[-1]}")


def accuracy_eval():
    return MulticlassClassificationEvaluator(labelCol="label", metricName="accuracy")


def r2_eval():
    return RegressionEvaluator(labelCol="label", metricName="r2")
