"""Supervised learning queries.

The model inputs are the segment-enhanced sets, with K-means segments (k from
the elbow).  Every model is fitted, tested and scored on all rows of its set,
over the configured grids; the quick grids belong to the quick-test job only.

Several queries report on the same fits.  Within a session they are made once
for a state of the folder (names, sizes and times of its files), so changed
inputs are fitted anew; ``forget`` drops them.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duelframe.operators import cluster_features as cf
from duelframe.operators import contest, gram, metrics, models, split
from duelframe.plans.base import Stages, round_doubles, sql_with
from duelframe.plans.q_unsupervised import kmeans_segments
from duelframe.plans.registry import query
from duelframe.session import checkpoint_dir, materialise, materialise_spread
from duelframe.sources import io

# fixed values: the configured models, in the order that settles ties
CLASSIFIERS = ["logistic_regression", "random_forest", "decision_tree", "svm", "naive_bayes"]
REGRESSORS = ["ridge", "lasso", "elastic_net", "random_forest", "gradient_boosting"]

CLS_RESULT = ("MODEL string, ORDINAL int, CV_ACCURACY double, CV_STD double, ACCURACY double, PRECISION double, "
              "RECALL double, F1 double, ROC_AUC double")
REG_RESULT = ("TARGET string, MODEL string, ORDINAL int, CV_R2 double, CV_STD double, R2 double, MAE double, "
              "MSE double, RMSE double")


def _parts(data: DataFrame, label: str | None, tag: str) -> tuple[DataFrame, DataFrame, list[str]]:
    """(train with FOLD, test, feature names), written once: the fits read them many times."""
    feats = [c for c in data.columns if c not in ("GAME_ID", "label")]
    data = materialise_spread(split.fold_ids(data, ["GAME_ID"], 5, 42, label=label), tag)
    train, test = split.split_frac(data, ["GAME_ID"], 0.2, 42, label=label)
    return train, test.drop("FOLD"), feats


def classification_set(game_features: DataFrame, team_features: DataFrame, segments: DataFrame | None) -> DataFrame:
    """GAME_ID, features and label; segment features too when labels are given."""
    data = game_features.select("GAME_ID", *contest.TEAM_IDS, *contest.CLASSIFICATION_FEATURES, "HOME_TEAM_WINS").dropna()
    if segments is not None:
        data = cf.enhance_classification(data, segments, team_features)
    return data.withColumn("label", F.col("HOME_TEAM_WINS").cast("double")).drop("HOME_TEAM_WINS")


def regression_set(game_features: DataFrame, team_features: DataFrame, segments: DataFrame | None, target: str) -> DataFrame:
    """GAME_ID, features and the target as label; the other targets are left out."""
    targets = list(contest.REGRESSION_TARGETS.values())
    data = game_features.select("GAME_ID", *contest.TEAM_IDS, *contest.REGRESSION_FEATURES, *targets).dropna()
    if segments is not None:
        data = cf.enhance_regression(data, segments, team_features)
    return data.withColumn("label", F.col(target).cast("double")).drop(*targets)


def fit_classifiers(parts, names: Sequence[str] = CLASSIFIERS, quick: bool = False) -> tuple[list, dict]:
    """Result rows and fitted models: grid search by 5-fold accuracy, exact metrics on the test part."""
    train, test, feats = parts
    rows, fitted = [], {}
    for i, name in enumerate(names):
        best, avg, std = models.search_classifier(train, feats, name, quick)
        j = max(range(len(avg)), key=lambda t: avg[t])
        m = models.classification_test_metrics(materialise(models.scored_classification(best, test, ["GAME_ID"]), "scored"))
        rows.append((name, i, float(avg[j]), float(std[j]), m["ACCURACY"], m["PRECISION"], m["RECALL"], m["F1"], m["ROC_AUC"]))
        fitted[name] = best
    return rows, fitted


def fit_regressors(parts, target: str, names: Sequence[str] = REGRESSORS, quick: bool = False) -> tuple[list, dict]:
    """Result rows and fitted models: grid search by 5-fold R2, exact metrics on the test part."""
    train, test, feats = parts
    known = gram.products(train, feats, "label", "FOLD") if set(names) & set(gram.SOLVERS) else None
    rows, fitted = [], {}
    for i, name in enumerate(names):
        best, avg, std = models.search_regressor(train, feats, name, quick, known=known)
        j = max(range(len(avg)), key=lambda t: avg[t])
        m = metrics.regression_scores(models.predicted(best, test, ["label"])).first()
        rows.append((target, name, i, float(avg[j]), float(std[j]), m["R2"], m["MAE"], m["MSE"], m["RMSE"]))
        fitted[name] = best
    return rows, fitted


_KEPT: dict[tuple, object] = {}


def forget() -> None:
    """Drop the fits that queries of this session share."""
    _KEPT.clear()


def _once(fn):
    """Keeps a function's result by session, folder, state of the folder's files and arguments."""
    @wraps(fn)
    def kept(spark: SparkSession, sf_dir: str, *args, **named):
        key = (spark.sparkContext.applicationId, sf_dir, io.folder_state(spark, sf_dir), fn.__name__, args, tuple(sorted(named.items())))
        if key not in _KEPT:
            _KEPT[key] = fn(spark, sf_dir, *args, **named)
        return _KEPT[key]
    return kept


@_once
def _sets(spark: SparkSession, sf_dir: str):
    st = Stages(spark, sf_dir)
    game_features = materialise(st.game_features, "game_features")
    return game_features, st.team_features, kmeans_segments(st)


@_once
def _classification_parts(spark: SparkSession, sf_dir: str, with_segments: bool = True):
    games, teams, segments = _sets(spark, sf_dir)
    return _parts(classification_set(games, teams, segments if with_segments else None), "label", "classification")


@_once
def _regression_parts(spark: SparkSession, sf_dir: str, target: str):
    return _parts(regression_set(*_sets(spark, sf_dir), target), None, "regression")


@_once
def _classifier(spark: SparkSession, sf_dir: str, name: str, with_segments: bool = True):
    """Result row and model of one classifier; its ordinal is its configured place."""
    rows, fitted = fit_classifiers(_classification_parts(spark, sf_dir, with_segments), [name])
    place = CLASSIFIERS.index(name) if name in CLASSIFIERS else len(CLASSIFIERS)
    return (rows[0][0], place, *rows[0][2:]), fitted[name]


def _classifiers(spark: SparkSession, sf_dir: str):
    found = {name: _classifier(spark, sf_dir, name) for name in CLASSIFIERS}
    return [row for row, _ in found.values()], {name: model for name, (_, model) in found.items()}


@_once
def _regressors(spark: SparkSession, sf_dir: str, target: str):
    return fit_regressors(_regression_parts(spark, sf_dir, target), target)


@query("random_forest_classifier", "L2 L8 L9")
def random_forest_classifier(spark, sf_dir):
    """The random forest over its configured grid: CV accuracy and exact test metrics."""
    return round_doubles(spark.createDataFrame([_classifier(spark, sf_dir, "random_forest")[0]], CLS_RESULT), 4)


@query("classifier_comparison", "L0 L1 L2 L3 L4 L5 L8 L9 M2 M4 X6 V1 V2")
def classifier_comparison(spark, sf_dir):
    """Home-win classifiers (logistic, forest, tree, SVM, Gaussian NB) on the
    set enhanced with K-means segments: configured grids, 5-fold CV accuracy
    (mean, std) and exact test accuracy/precision/recall/F1/AUC."""
    return round_doubles(spark.createDataFrame(_classifiers(spark, sf_dir)[0], CLS_RESULT), 4)


@query("best_classifier_importance", "L10 L11 T6 T7 A25")
def best_classifier_importance(spark, sf_dir):
    """Best of the five classifiers by test accuracy (ties: declared order),
    the majority baseline and lift, and its ten most important features
    (none for naive Bayes, which has no importances)."""
    rows, fitted = _classifiers(spark, sf_dir)
    _, test, feats = _classification_parts(spark, sf_dir)
    best = max(rows, key=lambda r: (r[4], -r[1]))
    base = test.agg(F.avg("label")).first()[0]
    baseline = max(base, 1 - base)
    top = models.importances(fitted[best[0]], feats, 10) or [(None, None)]
    out = [(best[0], best[4], baseline, (best[4] - baseline) / baseline * 100, r + 1, f, v) for r, (f, v) in enumerate(top)]
    return round_doubles(spark.createDataFrame(
        out, "BEST_MODEL string, ACCURACY double, BASELINE double, LIFT_PCT double, RANK int, FEATURE string, "
             "IMPORTANCE double"), 4)


@query("segment_gain", "L12")
def segment_gain(spark, sf_dir):
    """Test accuracy of the grid-searched logistic regression with and
    without segment features: gain in points and percent, and the verdict."""
    with_, without = (_classifier(spark, sf_dir, "logistic_regression", flag)[0][4] for flag in (True, False))
    df = spark.createDataFrame([("logistic_regression", with_, without)], "MODEL string, WITH double, WITHOUT double")
    gain = F.col("WITH") - F.col("WITHOUT")
    return round_doubles(df.select("*", gain.alias("GAIN"), F.try_divide(gain * 100, F.col("WITHOUT")).alias("GAIN_PCT"),
                                   metrics.improvement(None).alias("VERDICT")), 4)


@query("home_points_regressors", "R0 R1 R2 R3 R4 R5 R7 R8")
def home_points_regressors(spark, sf_dir):
    """The five regressors for home points over their configured grids."""
    return round_doubles(spark.createDataFrame(_regressors(spark, sf_dir, "PTS_home")[0], REG_RESULT), 4)


@query("away_points_regressors", "R8 R2")
def away_points_regressors(spark, sf_dir):
    """The five regressors for away points over their configured grids."""
    return round_doubles(spark.createDataFrame(_regressors(spark, sf_dir, "PTS_away")[0], REG_RESULT), 4)


@query("differential_regressors", "R8 R2")
def differential_regressors(spark, sf_dir):
    """The five regressors for the point differential over their configured grids."""
    return round_doubles(spark.createDataFrame(_regressors(spark, sf_dir, "POINT_DIFFERENTIAL")[0], REG_RESULT), 4)


@query("regressor_comparison", "R0 R1 R2 R3 R4 R5 R7 R8 V5 M3")
def regressor_comparison(spark, sf_dir):
    """Ridge, lasso, elastic net, forest and boosting for home points, away
    points and the differential: 80/20 split of all rows, configured grids,
    5-fold CV R2, exact test R2/MAE/MSE/RMSE, best model per target by test R2."""
    rows = [r for t in contest.REGRESSION_TARGETS.values() for r in _regressors(spark, sf_dir, t)[0]]
    df = spark.createDataFrame(rows, REG_RESULT)
    best = df.groupBy("TARGET").agg(F.max_by("MODEL", F.struct("R2", -F.col("ORDINAL"))).alias("BEST_MODEL"))
    return round_doubles(df.join(best, "TARGET"), 4)


def cluster_share(fitted: dict, feats: list[str]) -> tuple[list[tuple[str, float]], float]:
    """Forest importances, largest first, and the share of segment features in them."""
    imp = models.importances(fitted["random_forest"], feats, len(feats))
    return imp, sum(v for f, v in imp if "CLUSTER" in f) / (sum(v for _, v in imp) or 1.0)


@query("regression_cluster_importance", "R9 T6")
def regression_cluster_importance(spark, sf_dir):
    """Forest importances for home points: top ten features and the share of
    segment-derived (CLUSTER) features in the total importance."""
    imp, share = cluster_share(_regressors(spark, sf_dir, "PTS_home")[1], _regression_parts(spark, sf_dir, "PTS_home")[2])
    out = [(r + 1, f, v, share) for r, (f, v) in enumerate(imp[:10])]
    return round_doubles(spark.createDataFrame(out, "RANK int, FEATURE string, IMPORTANCE double, CLUSTER_SHARE double"), 4)


def consolidated(rows: list, shares: dict[str, float], spark: SparkSession) -> DataFrame:
    """One row a target: best model by test R2, its metrics, the mean R2 of all models, the segment features' share."""
    df = spark.createDataFrame(rows, REG_RESULT)
    share = spark.createDataFrame(list(shares.items()), "TARGET string, CLUSTER_SHARE double")
    best = F.max_by(F.struct("MODEL", "CV_R2", "R2", "MAE", "RMSE"), F.struct("R2", -F.col("ORDINAL"))).alias("b")
    out = df.groupBy("TARGET").agg(best, F.avg("R2").alias("MEAN_R2"), F.count(F.lit(1)).alias("MODELS")).join(share, "TARGET")
    return out.select("TARGET", F.col("b.MODEL").alias("BEST_MODEL"), "b.CV_R2", "b.R2", "b.MAE", "b.RMSE", "MEAN_R2", "MODELS", "CLUSTER_SHARE")


@query("regression_report", "R10 S4 S5")
def regression_report(spark, sf_dir):
    """Consolidated report over the three targets: written as the next
    version in the result store, read back as the latest one."""
    rows, shares = [], {}
    for t in contest.REGRESSION_TARGETS.values():
        r, fitted = _regressors(spark, sf_dir, t)
        rows += r
        shares[t] = cluster_share(fitted, _regression_parts(spark, sf_dir, t)[2])[1]
    root = f"{checkpoint_dir(spark)}/results"
    models.save_results(round_doubles(consolidated(rows, shares, spark), 4), root, "regression_report")
    return models.latest_results(spark, root, "regression_report")


@query("svr_regressor", "R6 R7")
def svr_regressor(spark, sf_dir):
    """Support vector regression for home points over its grid of costs and
    kernels (linear, RBF by random Fourier features), on the standardised set."""
    rows, _ = fit_regressors(_regression_parts(spark, sf_dir, "PTS_home"), "PTS_home", ["svr"])
    return round_doubles(spark.createDataFrame(rows, REG_RESULT), 4)


@query("home_win_as_number", "R11")
def home_win_as_number(spark, sf_dir):
    """The five regressors for the home-win outcome taken as a number."""
    rows, _ = fit_regressors(_classification_parts(spark, sf_dir), "home_advantage")
    return round_doubles(spark.createDataFrame(rows, REG_RESULT), 4)


@query("saved_model_scoring", "S5 S6 R12")
def saved_model_scoring(spark, sf_dir):
    """Fit ridge for home points, save it under a version folder in the
    shared checkpoint location, load the latest version and score every game
    of the regression set."""
    parts = _regression_parts(spark, sf_dir, "PTS_home")
    _, fitted = fit_regressors(parts, "PTS_home", ["ridge"])
    root = f"{checkpoint_dir(spark)}/models"
    models.save_versioned(fitted["ridge"], root, "local_strength")
    loaded = models.load_latest(spark, root, "local_strength")
    everything = parts[0].drop("FOLD").unionByName(parts[1])
    return round_doubles(models.predicted(loaded, everything, ["GAME_ID", "HOME_TEAM_ID", "label"]), 4)


_PAIR_STATS = [(f"{stat}_{tag}", f"{alias}.{side}_{mean}") for stat, mean in contest.SIDE_STATS
               for tag, alias, side in (("home", "h", "HOME"), ("away", "a", "AWAY"))]


def _games_to_come(st: Stages) -> DataFrame:
    """The pairs of the latest season, dated like the last game."""
    last = st.games_validated.agg(F.max("GAME_DATE_EST").alias("d")).first()["d"]
    return contest.season_pairs(st.team_features, last.year, last.month)


@query("team_pair_features", "R12 X6", sql=sql_with(
    "WITH last AS (SELECT max(GAME_DATE_EST) AS d FROM gv) "
    "SELECT h.SEASON, h.TEAM_ID AS HOME_TEAM_ID, a.TEAM_ID AS VISITOR_TEAM_ID, CAST(year(d) AS INT) AS YEAR, CAST(month(d) AS INT) AS MONTH, "
    + ", ".join(f"round_even({source}, 6) AS {name}" for name, source in _PAIR_STATS)
    + " FROM tf h JOIN tf a ON a.SEASON = h.SEASON AND a.TEAM_ID <> h.TEAM_ID, last WHERE h.SEASON = (SELECT max(SEASON) FROM tf) AND "
    + " AND ".join(f"{source} IS NOT NULL" for _, source in _PAIR_STATS), upto="tf"))
def team_pair_features(spark, sf_dir):
    """Every ordered pair of sides of the latest season with the regression
    features of a game to come, from both sides' season means."""
    return round_doubles(_games_to_come(Stages(spark, sf_dir, ["GAME_DATE_EST", *contest.SIDE_COLUMNS])))


def pair_inputs(pairs: DataFrame, teams: DataFrame, segments: DataFrame | None, features: Sequence[str]) -> DataFrame:
    """``pairs`` with the features that the models were fitted on; the one-hot
    column of a segment (or of none, -1) that no home side of ``pairs`` is in is 0."""
    data = pairs if segments is None else cf.enhance_regression(pairs, segments, teams)
    absent = [c for c in features if c.startswith("CLUSTER_") and c not in data.columns]
    return data.withColumns({c: F.lit(0) for c in absent})


def scored_pairs(spark: SparkSession, pairs: DataFrame, data: DataFrame, root: str) -> DataFrame:
    """``pairs`` with a column PRED_<target> from the latest saved model of each target on ``data``."""
    out = pairs.select("SEASON", *contest.TEAM_IDS)
    for name in contest.REGRESSION_TARGETS:
        found = models.predicted(models.load_latest(spark, root, name), data, contest.TEAM_IDS)
        out = out.join(found.withColumnRenamed("prediction", f"PRED_{name}"), contest.TEAM_IDS)
    return out


@query("team_pair_scoring", "R12 S6 S5")
def team_pair_scoring(spark, sf_dir):
    """Ridge models of the three targets, saved and loaded again, score every
    ordered pair of sides of the latest season."""
    games, teams, segments = _sets(spark, sf_dir)
    root = f"{checkpoint_dir(spark)}/models/pairs-{uuid.uuid4().hex}"
    for name, target in contest.REGRESSION_TARGETS.items():
        parts = _regression_parts(spark, sf_dir, target)
        _, fitted = fit_regressors(parts, target, ["ridge"])
        models.save_versioned(fitted["ridge"], root, name)
    last = games.agg(F.max("GAME_DATE_EST").alias("d")).first()["d"]
    pairs = materialise(contest.season_pairs(teams, last.year, last.month), "pairs")
    return round_doubles(scored_pairs(spark, pairs, pair_inputs(pairs, teams, segments, parts[2]), root), 4)


@query("gbt_classifier", "L6")
def gbt_classifier(spark, sf_dir):
    """Gradient-boosted trees for the home win (registered in the model
    factory though not configured): CV accuracy and exact test metrics."""
    return round_doubles(spark.createDataFrame([_classifier(spark, sf_dir, "gradient_boosting")[0]], CLS_RESULT), 4)


@query("association_rules", "Z5")
def association_rules(spark, sf_dir):
    """Association rules over discretised game facts (FP-growth: support
    0.01, confidence 0.5, lift >= 1, at most 3 items)."""
    from duelframe.operators import rules
    return round_doubles(rules.game_fact_rules(Stages(spark, sf_dir).games_validated), 6)
