"""Hand-written edge cases (FIXTURES.md section 4) for the operators."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from duelframe.operators import clean, cluster, contest, history, metrics, profile, scaling, split


def _games(spark, rows):
    cols = "GAME_ID long, GAME_DATE_EST date, SEASON int, HOME_TEAM_ID int, VISITOR_TEAM_ID int, PTS_home double, " \
           "PTS_away double, FG_PCT_home double, FG_PCT_away double, FT_PCT_home double, FT_PCT_away double, " \
           "FG3_PCT_home double, FG3_PCT_away double, REB_home double, REB_away double, AST_home double, " \
           "AST_away double, HOME_TEAM_WINS int"
    return spark.createDataFrame(rows, cols)


def _g(gid, day, season, h, v, ph, pa):
    return (gid, day, season, h, v, ph, pa, .4, .4, .7, .7, .3, .3, 40., 40., 20., 20., int(ph > pa))


def test_single_game_group_and_one_sided_team(spark):
    d = dt.date(2000, 11, 1)
    g = clean.clean_games(_games(spark, [
        _g(1, d, 2000, 1, 2, 100., 90.), _g(2, d, 2000, 2, 1, 95., 99.),
        _g(3, d, 2001, 9, 1, 90., 80.)]))  # team 9 only plays at home in 2001
    tf = contest.team_features_base(g)
    rows = {(r.TEAM_ID, r.SEASON): r for r in tf.collect()}
    assert rows[(1, 2000)].HOME_PTS_STD is None and rows[(1, 2000)].HOME_GAMES_COUNT == 1
    assert (9, 2001) not in rows
    gl = contest.game_level_features(g, tf).where("GAME_ID = 3").first()
    assert gl.HOME_HIST_HOME_PTS_MEAN is None


def test_null_key_forms_no_group(spark):
    d = dt.date(2000, 11, 1)
    g = clean.clean_games(_games(spark, [_g(1, d, 2000, None, 2, 100., 90.), _g(2, d, 2000, 1, 2, 90., 80.)]))
    home = contest.side_performance(g, "HOME", "HOME_TEAM_ID")
    assert home.where(F.col("TEAM_ID").isNull()).count() == 0


def test_median_even_count_and_mode_tie(spark):
    df = spark.createDataFrame([(1.0, "b"), (2.0, "a"), (4.0, "a"), (8.0, "b"), (None, None)], "x double, s string")
    out = clean.impute_median_mode(df).collect()
    assert out[-1].x == 3.0 and out[-1].s == "a"


def test_null_city_and_weekday(spark):
    t = spark.createDataFrame([(1, "x", None, 1950)], "TEAM_ID int, NICKNAME string, CITY string, YEARFOUNDED int")
    assert clean.clean_teams(t).first().FULL_NAME == "Unknown x"
    g = clean.clean_games(_games(spark, [_g(1, dt.date(2020, 12, 21), 2020, 1, 2, 1., 0.)]))
    assert g.first().DAY_OF_WEEK == 0


def test_duplicate_player_lines_counted_once_and_null_stat(spark):
    d = spark.createDataFrame([(1, 5, 7, "p", 10.0, 1.0, 1.0), (1, 5, 8, "p", 10.0, 1.0, 1.0),
                               (1, 5, 9, "q", None, 2.0, 0.0)],
                              "GAME_ID long, TEAM_ID int, PLAYER_ID long, PLAYER_NAME string, PTS double, "
                              "REB double, AST double")
    box = contest.team_box_totals(clean.clean_details(d)).first()
    assert box.DETAIL_PTS == 10.0 and box.PLAYER_COUNT == 2


def test_constant_column_standardises_to_zero_and_rounding(spark):
    df = spark.createDataFrame([(5.0, float(i)) for i in range(5)], "c double, x double")
    out = scaling.standardize(df, ["c", "x"]).collect()
    assert all(r.c == 0.0 for r in out)
    assert abs(sum(r.x for r in out)) < 1e-12
    from duelframe.functions.columns import round_even
    assert spark.range(1).select(round_even(F.lit(2.5), 0)).first()[0] == 2.0


def test_metrics_no_positive_prediction_and_auc_tie(spark):
    p = spark.createDataFrame([(1, 0, 0.5), (1, 0, 0.5), (0, 0, 0.5)], "label int, prediction int, probability double")
    s = metrics.classification_scores(p).first()
    assert (s.PRECISION, s.RECALL, s.F1) == (0.0, 0.0, 0.0)
    t = spark.createDataFrame([(1, 1, 0.7), (0, 1, 0.7)], "label int, prediction int, probability double")
    assert metrics.roc_auc(t).first().ROC_AUC == 0.5


def test_auc_matches_spark_evaluator(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    rows = [(i % 3 == 0, (i * 37 % 101) / 101.0) for i in range(300)]
    df = spark.createDataFrame([(int(a), 0, b) for a, b in rows], "label int, prediction int, probability double")
    ours = metrics.roc_auc(df).first().ROC_AUC
    ref = BinaryClassificationEvaluator(rawPredictionCol="probability", labelCol="label").evaluate(
        df.withColumn("label", F.col("label").cast("double")))
    assert abs(ours - ref) < 1e-9


def test_score_tie_goes_to_first_declared(spark):
    s = spark.createDataFrame([("a", 0, 0.9), ("b", 1, 0.9)], "MODEL string, ORDINAL int, ACC double")
    assert metrics.best_by(s, "MODEL", "ACC").first().BEST_MODEL == "a"


def test_elbow_choice(spark):
    costs = spark.createDataFrame([(1, 100.), (2, 40.), (3, 30.), (4, 25.), (5, 22.)], "K int, COST double")
    assert cluster.elbow_choice(costs).first().SUGGESTED_K == 2


def test_silhouette_matches_spark_evaluator(spark):
    from pyspark.ml.evaluation import ClusteringEvaluator
    rows = [(float(i % 7), float((i * 3) % 5), i % 3) for i in range(60)]
    df = spark.createDataFrame(rows, "a double, b double, label int")
    ours = cluster.silhouette_sq(df, ["a", "b"])
    v = cluster.assemble(df, ["a", "b"]).withColumn("prediction", F.col("label").cast("double"))
    ref = ClusteringEvaluator(distanceMeasure="squaredEuclidean").evaluate(v)
    assert abs(ours - ref) < 1e-9


def test_splits_disjoint_and_repeatable(spark):
    df = spark.range(2000).withColumn("label", (F.col("id") % 3 == 0).cast("int"))
    tr, te = split.split_frac(df, ["id"], 0.2, 42, label="label")
    a = {r.id for r in te.collect()}
    b = {r.id for r in split.split_frac(df.repartition(7), ["id"], 0.2, 42, label="label")[1].collect()}
    assert a == b and tr.count() + te.count() == 2000 and tr.join(te, "id").count() == 0
    assert 300 < len(a) < 500
    assert split.sample_n(df, 100, ["id"]).count() == 100


def test_recent_form_excludes_current_game(spark):
    rows = [_g(i, dt.date(2000, 1, i), 2000, 1, 2, 100. + i, 90.) for i in range(1, 8)]
    f = history.recent_form(clean.clean_games(_games(spark, rows)), n=5)
    r = f.where("TEAM_ID = 1 AND GAME_ID = 7").first()
    assert r.FORM_GAMES == 5 and r.FORM_PTS_FOR == pytest.approx((102 + 103 + 104 + 105 + 106) / 5)
    assert f.where("TEAM_ID = 1 AND GAME_ID = 1").first().FORM_GAMES == 0


def test_histogram_last_bin_closed(spark):
    df = spark.createDataFrame([(float(x),) for x in (0, 1, 2, 3, 4)], "x double")
    h = {r.BIN: r.COUNT for r in profile.histogram(df, "x", 2).collect()}
    assert h == {0: 2, 1: 3}


def test_cluster_description_buckets(spark):
    prof = spark.createDataFrame([(0, 10, "A", 0, 121.0, 100.0, 21.0, 21.0, 1),
                                  (1, 5, "A", 0, 111.0, 100.0, 11.0, 11.0, 1),
                                  (2, 3, "A", 0, 105.0, 100.0, 5.0, 5.0, 1)],
                                 "CLUSTER int, SIZE long, FEATURE string, POS int, CLUSTER_MEAN double, "
                                 "OVERALL_MEAN double, ABS_DIFF double, DIFF_PCT double, RANK int")
    d = {r.CLUSTER: r.DESCRIPTION for r in cluster.describe_clusters(prof).collect()}
    assert d[0] == "A far above average" and d[1] == "A above average"
    assert d[2] == "close to average"
    told = {r.CLUSTER: r for r in cluster.insights(prof).collect()}
    assert told[0].RECOMMENDATION == "Nothing lags; build on A" and "(cluster 2) to 10 (cluster 0)" in told[-1].INSIGHT
