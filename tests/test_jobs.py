"""Jobs at the smallest size: every step writes its tables, and reads those before it."""

import os

import pytest

from duelframe.plans import jobs

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("job"))
    for step in (jobs.engineering, jobs.clustering, jobs.dimensionality, jobs.anomalies):
        step(spark, SF, out, **({"k": 3} if step is jobs.clustering else {}))
    return out


@pytest.mark.parametrize("name,rows", [
    ("games_validated", 1408), ("team_features_base", 68), ("game_level_features", 1408), ("games_teams_details", 1408),
    ("clustering_labels_kmeans", 68), ("clustering_labels_agglo", 68), ("clustering_labels_pca_kmeans", 68),
    ("clustering_labels_dbscan", 68), ("clustering_evaluation", 4), ("pca_team_features", 68), ("pca_variance", 10), ("anomaly_comparison", 3), ("anomaly_consensus", 68)])
def test_unsupervised_steps(spark, folder, name, rows):
    assert spark.read.parquet(f"{folder}/{name}").count() == rows


@pytest.mark.parametrize("with_clusters", [True, False])
def test_classification_step(spark, folder, with_clusters):
    tag = "with_clusters" if with_clusters else "without_clusters"
    jobs.classification(spark, SF, folder, with_clusters=with_clusters, quick=True, names=["logistic_regression", "naive_bayes"])
    rows = spark.read.parquet(f"{folder}/classification_results_{tag}").collect()
    assert len(rows) == 2 and all(v is not None for row in rows for v in row)
    assert os.path.isdir(f"{folder}/models/classifier_{tag}")


def test_regression_step(spark, folder):
    jobs.regression(spark, SF, folder, quick=True, names=["ridge", "random_forest"])
    rows = spark.read.parquet(f"{folder}/regression_results_with_clusters").collect()
    assert len(rows) == 6 and all(v is not None for row in rows for v in row)
    report = spark.read.json(f"{folder}/regression_report_with_clusters").collect()
    assert len(report) == 3 and all(x["CLUSTER_SHARE"] > 0 for x in report)


def test_gain_of_segments(spark, folder):
    jobs.compare_clusters(spark, SF, folder)
    rows = spark.read.parquet(f"{folder}/segment_gain").collect()
    assert len(rows) == 2 and {r["VERDICT"] for r in rows} <= {"significant improvement", "slight improvement", "no improvement"}


def test_twenty_jobs_of_known_steps():
    assert len(jobs.JOBS) == 20
    assert all(steps[0] is jobs.engineering for steps in jobs.JOBS.values())


def test_a_whole_job(spark, tmp_path):
    jobs.run("data_only", spark, SF, str(tmp_path))
    assert spark.read.json(f"{tmp_path}/validation_report").count() == 12
