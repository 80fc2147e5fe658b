"""Metric queries over rule-based baseline predictions.

The prediction tables come from fixed formulas over the game features (no
fit), so every metric has an exact SQL twin:

classification rules (probability of a home win, predicted 1 when >= 0.5)
  win_share_diff   1 / (1 + exp(-4 * WIN_PCT_DIFF))
  points_diff_hist 1 / (1 + exp(-0.2 * PTS_DIFF_HIST))
  home_always      0.6
regression rules, per target
  season_mean      the side's season mean (PTS_home <- HOME_HIST_HOME_PTS_MEAN,
                   PTS_away <- AWAY_HIST_AWAY_PTS_MEAN, diff <- PTS_DIFF_HIST)
  blend            mean of own scoring and the opponent's points allowed
"""

from __future__ import annotations

from pyspark.sql import functions as F

from duelframe.functions.columns import round_even
from duelframe.operators import contest, metrics
from duelframe.plans.base import Stages, round_doubles, sql_with
from duelframe.plans.registry import query

# fixed values: baseline rules (name, ordinal, probability expression as SQL)
CLS_RULES = [
    ("win_share_diff", 0, "1 / (1 + exp(-4 * WIN_PCT_DIFF))"),
    ("points_diff_hist", 1, "1 / (1 + exp(-0.2 * PTS_DIFF_HIST))"),
    ("home_always", 2, "0.6"),
]
REG_RULES = [
    ("local_strength", "PTS_home", "season_mean", "HOME_HIST_HOME_PTS_MEAN"),
    ("local_strength", "PTS_home", "blend",
     "(HOME_HIST_HOME_PTS_MEAN + AWAY_HIST_AWAY_PTS_MEAN - AWAY_HIST_AWAY_PT_DIFF_MEAN) / 2"),
    ("away_weakness", "PTS_away", "season_mean", "AWAY_HIST_AWAY_PTS_MEAN"),
    ("away_weakness", "PTS_away", "blend",
     "(AWAY_HIST_AWAY_PTS_MEAN + HOME_HIST_HOME_PTS_MEAN - HOME_HIST_HOME_PT_DIFF_MEAN) / 2"),
    ("point_differential", "POINT_DIFFERENTIAL", "season_mean", "PTS_DIFF_HIST"),
    ("point_differential", "POINT_DIFFERENTIAL", "blend",
     "(HOME_HIST_HOME_PT_DIFF_MEAN - AWAY_HIST_AWAY_PT_DIFF_MEAN) / 2"),
]

CLS_PRED_SQL = " UNION ALL ".join(
    f"SELECT GAME_ID, HOME_TEAM_ID, '{n}' AS MODEL, {o} AS ORDINAL, CAST(HOME_TEAM_WINS AS INT) AS label, "
    f"CAST({e} AS DOUBLE) AS probability, CAST(({e}) >= 0.5 AS INT) AS prediction "
    f"FROM gl WHERE WIN_PCT_DIFF IS NOT NULL AND PTS_DIFF_HIST IS NOT NULL" for n, o, e in CLS_RULES)
REG_PRED_SQL = " UNION ALL ".join(
    f"SELECT GAME_ID, HOME_TEAM_ID, '{t}' AS TARGET, '{m}' AS MODEL, CAST({y} AS DOUBLE) AS label, "
    f"CAST({e} AS DOUBLE) AS prediction FROM gl WHERE ({e}) IS NOT NULL AND {y} IS NOT NULL"
    for t, y, m, e in REG_RULES)


RULE_COLUMNS = ["GAME_ID", *contest.SIDE_COLUMNS]       # the games' columns that the rules and their features read


def cls_predictions(st: Stages):
    g = st.game_features.where(F.col("WIN_PCT_DIFF").isNotNull() & F.col("PTS_DIFF_HIST").isNotNull())
    rules = []                                          # all rules in one projection: the features are read once
    for name, ordinal, expr in CLS_RULES:
        p = F.expr(expr).cast("double")
        rules.append(F.struct(F.lit(name).alias("MODEL"), F.lit(ordinal).alias("ORDINAL"),
                              F.col("HOME_TEAM_WINS").cast("int").alias("label"), p.alias("probability"),
                              (p >= 0.5).cast("int").alias("prediction")))
    return g.select("GAME_ID", "HOME_TEAM_ID", F.inline(F.array(*rules)))


def reg_predictions(st: Stages):
    rules = [F.struct(F.lit(target).alias("TARGET"), F.lit(model).alias("MODEL"), F.col(y).cast("double").alias("label"),
                      F.expr(expr).cast("double").alias("prediction")) for target, y, model, expr in REG_RULES]
    return st.game_features.select("GAME_ID", "HOME_TEAM_ID", F.inline(F.array(*rules))).where(
        "label is not null and prediction is not null")


def _sw(body, extra=()):
    return sql_with(body, upto="gl", extra=[("cp", CLS_PRED_SQL), ("rp", REG_PRED_SQL), *extra])


_SCORES_SQL = """
SELECT MODEL, ORDINAL, round_even(coalesce((tp + tn) / nullif(tp + fp + fn + tn, 0), 0), 6) AS ACCURACY,
       round_even(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS PRECISION,
       round_even(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS RECALL,
       round_even(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS F1
FROM (SELECT MODEL, ORDINAL, CAST(count_if(label = 1 AND prediction = 1) AS DOUBLE) AS tp,
             CAST(count_if(label <> 1 AND prediction = 1) AS DOUBLE) AS fp,
             CAST(count_if(label = 1 AND prediction <> 1) AS DOUBLE) AS fn,
             CAST(count_if(label <> 1 AND prediction <> 1) AS DOUBLE) AS tn FROM cp GROUP BY MODEL, ORDINAL)
"""


@query("classification_scores", "V1 L9", sql=_sw(_SCORES_SQL))
def classification_scores(spark, sf_dir):
    """Accuracy, precision, recall, F1 of each baseline home-win rule."""
    st = Stages(spark, sf_dir, RULE_COLUMNS)
    return round_doubles(metrics.classification_scores(cls_predictions(st), group=["MODEL", "ORDINAL"]))


_AUC_SQL = """
SELECT MODEL, round_even(sum(pos * (neg_before + 0.5 * neg)) / (sum(pos) * sum(neg)), 6) AS ROC_AUC
FROM (SELECT MODEL, v, pos, neg, coalesce(sum(neg) OVER (PARTITION BY MODEL ORDER BY v
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_before
      FROM (SELECT MODEL, probability AS v, count_if(label = 1) AS pos, count_if(label <> 1) AS neg
            FROM cp GROUP BY MODEL, probability))
GROUP BY MODEL
"""


@query("classification_auc", "V2", sql=_sw(_AUC_SQL))
def classification_auc(spark, sf_dir):
    """ROC AUC (ties half) of each baseline rule's probability."""
    st = Stages(spark, sf_dir, RULE_COLUMNS)
    return round_doubles(metrics.roc_auc(cls_predictions(st), group=["MODEL"]))


_REPORT_SQL = """
WITH c AS (SELECT CAST(count_if(label = 1 AND prediction = 1) AS DOUBLE) AS tp, CAST(count_if(label <> 1 AND prediction = 1) AS DOUBLE) AS fp,
                  CAST(count_if(label = 1 AND prediction <> 1) AS DOUBLE) AS fn, CAST(count_if(label <> 1 AND prediction <> 1) AS DOUBLE) AS tn
           FROM cp WHERE MODEL = 'win_share_diff'),
per AS (SELECT '0' AS CLASS, coalesce(tn / nullif(tn + fn, 0), 0) AS PRECISION, coalesce(tn / nullif(tn + fp, 0), 0) AS RECALL,
               coalesce(2 * tn / nullif(2 * tn + fn + fp, 0), 0) AS F1, tn + fp AS SUPPORT FROM c
        UNION ALL
        SELECT '1', coalesce(tp / nullif(tp + fp, 0), 0), coalesce(tp / nullif(tp + fn, 0), 0),
               coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), tp + fn FROM c),
allrows AS (SELECT * FROM per
        UNION ALL SELECT 'macro avg', avg(PRECISION), avg(RECALL), avg(F1), sum(SUPPORT) FROM per
        UNION ALL SELECT 'weighted avg', sum(PRECISION * SUPPORT) / sum(SUPPORT), sum(RECALL * SUPPORT) / sum(SUPPORT),
                         sum(F1 * SUPPORT) / sum(SUPPORT), sum(SUPPORT) FROM per)
SELECT CLASS, round_even(PRECISION, 6) AS PRECISION, round_even(RECALL, 6) AS RECALL, round_even(F1, 6) AS F1,
       round_even(SUPPORT, 6) AS SUPPORT FROM allrows
"""


@query("classification_report", "V3", sql=_sw(_REPORT_SQL))
def classification_report(spark, sf_dir):
    """Per-class precision/recall/F1/support and macro/weighted rows of the
    win-share rule."""
    p = cls_predictions(Stages(spark, sf_dir, RULE_COLUMNS)).where(F.col("MODEL") == "win_share_diff")
    return round_doubles(metrics.classification_report(p))


@query("confusion_matrix", "V4", sql=_sw("""
SELECT label AS LABEL, count_if(prediction = 0) AS PRED_0, count_if(prediction = 1) AS PRED_1
FROM cp WHERE MODEL = 'win_share_diff' GROUP BY label"""))
def confusion_matrix(spark, sf_dir):
    """Confusion matrix (true class x predicted class) of the win-share rule."""
    p = cls_predictions(Stages(spark, sf_dir, RULE_COLUMNS)).where(F.col("MODEL") == "win_share_diff")
    return metrics.confusion_matrix(p)


_BEST_SQL = """
WITH s AS ({scores}),
     b AS (SELECT greatest(avg(CAST(HOME_TEAM_WINS AS DOUBLE)), 1 - avg(CAST(HOME_TEAM_WINS AS DOUBLE))) AS BASELINE
           FROM gl WHERE WIN_PCT_DIFF IS NOT NULL AND PTS_DIFF_HIST IS NOT NULL),
     best AS (SELECT MODEL, ACCURACY FROM s ORDER BY ACCURACY DESC, ORDINAL LIMIT 1)
SELECT best.MODEL AS BEST_MODEL, best.ACCURACY AS BEST_ACCURACY, round_even(b.BASELINE, 6) AS BASELINE,
       round_even((best.ACCURACY - b.BASELINE) / b.BASELINE * 100, 4) AS LIFT_PCT
FROM best, b
""".format(scores=_SCORES_SQL.strip())


@query("best_classifier_lift", "T7 L10 A25", sql=_sw(_BEST_SQL))
def best_classifier_lift(spark, sf_dir):
    """Best rule by accuracy (ties: first declared), majority-class baseline
    and relative lift in percent."""
    st = Stages(spark, sf_dir, RULE_COLUMNS)
    preds = cls_predictions(st)
    scores = round_doubles(metrics.classification_scores(preds, group=["MODEL", "ORDINAL"]))
    best = metrics.best_by(scores, "MODEL", "ACCURACY")
    # the baseline is one control value: carried as a literal, no join
    baseline = metrics.majority_baseline(preds.where(F.col("MODEL") == "home_always")).first()["BASELINE"]
    out = best.withColumn("BASELINE", F.lit(float(baseline)))
    return out.select("BEST_MODEL", "BEST_ACCURACY", round_even("BASELINE", 6).alias("BASELINE"),
                      round_even((F.col("BEST_ACCURACY") - F.col("BASELINE")) / F.col("BASELINE") * 100, 4)
                      .alias("LIFT_PCT"))


@query("rule_comparison", "L12", sql=_sw("""
WITH s AS ({scores})
SELECT a.ACCURACY AS "WITH", b.ACCURACY AS WITHOUT, round_even(a.ACCURACY - b.ACCURACY, 6) AS GAIN,
       round_even((a.ACCURACY - b.ACCURACY) / b.ACCURACY * 100, 4) AS GAIN_PCT,
       CASE WHEN a.ACCURACY - b.ACCURACY > 0.01 THEN 'significant improvement'
            WHEN a.ACCURACY - b.ACCURACY > 0 THEN 'slight improvement' ELSE 'no improvement' END AS VERDICT
FROM s a JOIN s b ON a.MODEL = 'win_share_diff' AND b.MODEL = 'home_always'""".format(scores=_SCORES_SQL.strip())))
def rule_comparison(spark, sf_dir):
    """Accuracy gain of the win-share rule over the always-home rule, in
    points and percent, with the improvement verdict."""
    st = Stages(spark, sf_dir, RULE_COLUMNS)
    s = round_doubles(metrics.classification_scores(cls_predictions(st), group=["MODEL", "ORDINAL"]))
    j = s.agg(F.max(F.when(F.col("MODEL") == "win_share_diff", F.col("ACCURACY"))).alias("WITH"),
              F.max(F.when(F.col("MODEL") == "home_always", F.col("ACCURACY"))).alias("WITHOUT"))
    return j.select("WITH", "WITHOUT", round_even(F.col("WITH") - F.col("WITHOUT"), 6).alias("GAIN"),
                    round_even((F.col("WITH") - F.col("WITHOUT")) / F.col("WITHOUT") * 100, 4).alias("GAIN_PCT"),
                    metrics.improvement(None).alias("VERDICT"))


_REG_SQL = """
SELECT TARGET, MODEL, round_even(1 - sse / (syy - sy * sy / n), 6) AS R2, round_even(sae / n, 6) AS MAE,
       round_even(sse / n, 6) AS MSE, round_even(sqrt(sse / n), 6) AS RMSE
FROM (SELECT TARGET, MODEL, count(*) AS n, sum((label - prediction) * (label - prediction)) AS sse,
             sum(abs(label - prediction)) AS sae, sum(label) AS sy, sum(label * label) AS syy
      FROM rp GROUP BY TARGET, MODEL)
"""


@query("regression_scores", "V5 R8", sql=_sw(_REG_SQL))
def regression_scores(spark, sf_dir):
    """R2, MAE, MSE, RMSE of each baseline rule for the three targets."""
    return round_doubles(metrics.regression_scores(reg_predictions(Stages(spark, sf_dir, RULE_COLUMNS)),
                                                   group=["TARGET", "MODEL"]))


@query("r2_models_by_target", "A24", sql=_sw("""
SELECT MODEL,
       first(R2) FILTER (WHERE TARGET = 'away_weakness') AS away_weakness,
       first(R2) FILTER (WHERE TARGET = 'local_strength') AS local_strength,
       first(R2) FILTER (WHERE TARGET = 'point_differential') AS point_differential
FROM ({reg}) GROUP BY MODEL""".format(reg=_REG_SQL.strip())))
def r2_models_by_target(spark, sf_dir):
    """R2 pivoted: one row per model, one column per target."""
    s = round_doubles(metrics.regression_scores(reg_predictions(Stages(spark, sf_dir, RULE_COLUMNS)), group=["TARGET", "MODEL"]))
    return s.groupBy("MODEL").pivot("TARGET", ["away_weakness", "local_strength", "point_differential"]).agg(
        F.first("R2"))


@query("prediction_ranking_by_team", "A23 F3 P22", sql=_sw("""
SELECT HOME_TEAM_ID AS TEAM_ID, round_even(avg(prediction), 2) AS PRED_MEAN, count(*) AS GAMES,
       round_even(stddev_samp(prediction), 2) AS PRED_STD
FROM rp WHERE TARGET = 'local_strength' AND MODEL = 'season_mean'
GROUP BY HOME_TEAM_ID HAVING count(*) >= 5"""))
def prediction_ranking_by_team(spark, sf_dir):
    """Per home side: mean, count and std of its predicted home points
    (sides with at least five games), rounded to 2 digits."""
    p = reg_predictions(Stages(spark, sf_dir, RULE_COLUMNS)).where(
        (F.col("TARGET") == "local_strength") & (F.col("MODEL") == "season_mean"))
    r = p.groupBy(F.col("HOME_TEAM_ID").alias("TEAM_ID")).agg(
        round_even(F.avg("prediction"), 2).alias("PRED_MEAN"), F.count(F.lit(1)).alias("GAMES"),
        round_even(F.stddev_samp("prediction"), 2).alias("PRED_STD"))
    return r.where(F.col("GAMES") >= 5)
