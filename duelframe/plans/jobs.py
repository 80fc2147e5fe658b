"""Named job compositions: plain functions that chain the operators and write
each deliverable as a table under ``out`` (a shared folder).

A step reads the tables that earlier steps saved, so nothing is computed
twice in a job and a lost executor costs one step.  ``run(name, ...)`` runs a
job; any scheduler can call it, or its steps one by one.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import cached_property, partial

from pyspark.sql import DataFrame, SparkSession

from duelframe.operators import anomaly, cluster, contest, models, quality
from duelframe.plans import q_supervised as sup
from duelframe.plans import q_unsupervised as uns
from duelframe.plans.base import TF_FEATURES, Stages
from duelframe.sources import io


class Saved:
    """The engineering tables and segment labels of a job folder."""

    def __init__(self, spark: SparkSession, out: str):
        self.spark, self.out = spark, out.rstrip("/")

    def save(self, df: DataFrame, name: str) -> DataFrame:
        io.write_parquet(df, f"{self.out}/{name}")
        return self.read(name)

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.out}/{name}")

    @cached_property
    def team_features(self) -> DataFrame:
        return self.read("team_features_base")

    @cached_property
    def game_features(self) -> DataFrame:
        return self.read("game_level_features")


def engineering(spark: SparkSession, sf_dir: str, out: str) -> None:
    """Clean, impute and join the inputs; team and game features, model inputs, the quality report."""
    st, to = Stages(spark, sf_dir), Saved(spark, out)
    games = to.save(st.games_validated, "games_validated")
    teams = to.save(st.teams_cleaned, "teams_cleaned")
    tf = to.save(contest.team_features_base(games, teams), "team_features_base")
    gl = to.save(contest.game_level_features(games, tf), "game_level_features")
    to.save(contest.games_teams_details(games, teams, st.details_cleaned), "games_teams_details")
    cls, reg = contest.model_inputs(gl)
    to.save(cls, "model_input_classification")
    to.save(reg, "model_input_regression")
    io.write_report(quality.validate(games, tf, gl), f"{to.out}/validation_report")


def clustering(spark: SparkSession, sf_dir: str, out: str, k: int | None = None) -> None:
    """Four segmentations with their metrics; profile and sentences of the K-means segments."""
    st = Saved(spark, out)
    data, labels, _ = uns.segmentations(st, k)
    rows = []
    for i, (name, lab) in enumerate(labels.items()):
        lab = st.save(lab, f"clustering_labels_{name}")
        m = cluster.evaluate(data.join(lab, ["TEAM_ID", "SEASON"]), TF_FEATURES)
        rows.append((name, i, m["N_CLUSTERS"], m["N_NOISE"], m["SILHOUETTE"], m["CALINSKI_HARABASZ"], m["DAVIES_BOULDIN"]))
    table = spark.createDataFrame(rows, "ALGORITHM string, ORDINAL int, N_CLUSTERS int, N_NOISE int, SILHOUETTE double, "
                                        "CALINSKI_HARABASZ double, DAVIES_BOULDIN double")
    st.save(cluster.best_valid(table), "clustering_evaluation")
    profile = st.save(cluster.cluster_profile(st.team_features, st.read("clustering_labels_kmeans"), TF_FEATURES), "clustering_profile")
    st.save(cluster.insights(profile).join(cluster.describe_clusters(profile).drop("SIZE"), "CLUSTER", "left"), "clustering_insights")


def dimensionality(spark: SparkSession, sf_dir: str, out: str) -> None:
    """Principal components: scores joined to the features, variance shares, loadings."""
    st = Saved(spark, out)
    p = cluster.pca(uns.clustering_table(st), TF_FEATURES, 10)
    st.save(st.team_features.join(p.scores, ["TEAM_ID", "SEASON"]), "pca_team_features")
    st.save(p.variance, "pca_variance")
    st.save(p.loadings, "pca_loadings")


def anomalies(spark: SparkSession, sf_dir: str, out: str) -> None:
    """Each detector's scores and labels, their comparison and the 2-of-3 consensus."""
    st = Saved(spark, out)
    found = {name: st.save(d, f"anomalies_{name}") for name, d in uns._detectors(st).items()}
    st.save(anomaly.compare_detectors(found), "anomaly_comparison")
    st.save(anomaly.consensus(found, ["TEAM_ID", "SEASON"]), "anomaly_consensus")


def _segments(st: Saved, with_clusters: bool) -> tuple[DataFrame | None, str]:
    return (st.read("clustering_labels_kmeans"), "with_clusters") if with_clusters else (None, "without_clusters")


def classification(spark: SparkSession, sf_dir: str, out: str, with_clusters: bool = True, quick: bool = False,
                   names: Sequence[str] = sup.CLASSIFIERS) -> None:
    """Grid-searched classifiers, the best one's importances, its saved model."""
    st = Saved(spark, out)
    segments, tag = _segments(st, with_clusters)
    parts = sup._parts(sup.classification_set(st.game_features, st.team_features, segments), "label", "classification")
    rows, fitted = sup.fit_classifiers(parts, names, quick)
    st.save(spark.createDataFrame(rows, sup.CLS_RESULT), f"classification_results_{tag}")
    best = max(rows, key=lambda r: (r[4], -r[1]))[0]
    top = models.importances(fitted[best], parts[2], 10)
    st.save(spark.createDataFrame([(best, f, v) for f, v in top], "MODEL string, FEATURE string, IMPORTANCE double"),
            f"classification_importance_{tag}")
    models.save_versioned(fitted[best], f"{st.out}/models", f"classifier_{tag}")


def regression(spark: SparkSession, sf_dir: str, out: str, with_clusters: bool = True, quick: bool = False,
               names: Sequence[str] = sup.REGRESSORS) -> None:
    """Grid-searched regressors of the three targets, their saved best models and the consolidated report."""
    st = Saved(spark, out)
    segments, tag = _segments(st, with_clusters)
    rows, shares = [], {}
    for name, target in contest.REGRESSION_TARGETS.items():
        parts = sup._parts(sup.regression_set(st.game_features, st.team_features, segments, target), None, "regression")
        r, fitted = sup.fit_regressors(parts, target, names, quick)
        rows += r
        shares[target] = sup.cluster_share(fitted, parts[2])[1]
        models.save_versioned(fitted[max(r, key=lambda x: (x[5], -x[2]))[1]], f"{st.out}/models", f"{name}_{tag}")
    st.save(spark.createDataFrame(rows, sup.REG_RESULT), f"regression_results_{tag}")
    io.write_report(sup.consolidated(rows, shares, spark), f"{st.out}/regression_report_{tag}")


def compare_clusters(spark: SparkSession, sf_dir: str, out: str) -> None:
    """Accuracy of each classifier with and without segment features, and the verdict."""
    from pyspark.sql import functions as F

    from duelframe.operators import metrics
    st = Saved(spark, out)
    a, b = (st.read(f"classification_results_{t}").select("MODEL", F.col("ACCURACY").alias(c))
            for t, c in (("with_clusters", "WITH"), ("without_clusters", "WITHOUT")))
    both = a.join(b, "MODEL")
    gain = F.col("WITH") - F.col("WITHOUT")
    st.save(both.select("*", gain.alias("GAIN"), F.try_divide(gain * 100, F.col("WITHOUT")).alias("GAIN_PCT"),
                        metrics.improvement(None).alias("VERDICT")), "segment_gain")


Step = Callable[..., None]
_plain_cls, _plain_reg = partial(classification, with_clusters=False), partial(regression, with_clusters=False)

# fixed values: the names of the reference's jobs and what each is made of
JOBS: dict[str, list[Step]] = {
    "__default__": [engineering, clustering, regression, classification],
    "de": [engineering], "data_only": [engineering],
    "clustering": [engineering, clustering], "quick_test": [engineering, clustering],
    "dimensionality": [engineering, dimensionality], "clustering_dimensionality": [engineering, clustering, dimensionality],
    "anomaly": [engineering, anomalies], "anomaly_only": [engineering, anomalies],
    "clf": [engineering, _plain_cls], "reg": [engineering, _plain_reg],
    "supervised_only": [engineering, _plain_cls, _plain_reg], "full_original": [engineering, _plain_cls, _plain_reg],
    "unsupervised_only": [engineering, clustering, dimensionality, anomalies],
    "integrated_basic": [engineering, clustering, _plain_cls, _plain_reg],
    "classification_with_clusters": [engineering, clustering, classification],
    "clustering_classification": [engineering, clustering, classification, _plain_cls, compare_clusters],
    "regression_with_clusters": [engineering, clustering, regression],
    "clustering_regression": [engineering, clustering, regression, _plain_reg],
    "full_with_clusters": [engineering, clustering, dimensionality, anomalies, regression, classification],
}


def run(name: str, spark: SparkSession, sf_dir: str, out: str, **options) -> None:
    """Run the steps of a job; ``quick`` (first value of each grid) goes to the model steps only."""
    for step in JOBS[name]:
        target = step.func if isinstance(step, partial) else step
        step(spark, sf_dir, out, **(options if target in (classification, regression) else {}))
