"""Games to come: pairs of a season, scored by saved models; advice by feature names."""

import itertools

import pytest
from pyspark.sql import functions as F

from duelframe.operators import cluster, contest, models
from duelframe.plans import q_supervised as sup
from duelframe.plans.base import TF_FEATURES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def teams(spark):
    rows = [(t, s, *[t + 0.01 * s + 0.1 * i for i in range(len(TF_FEATURES))]) for t in (1, 2, 3) for s in (2000, 2001)]
    df = spark.createDataFrame(rows, ["TEAM_ID", "SEASON", *TF_FEATURES])
    return df.withColumn("AWAY_REB_MEAN", F.when((F.col("TEAM_ID") == 3) & (F.col("SEASON") == 2001), None).otherwise(F.col("AWAY_REB_MEAN")))


@pytest.mark.parametrize("season", [None, 2000])
def test_pairs_carry_both_sides_means(spark, teams, season):
    got = {(r.HOME_TEAM_ID, r.VISITOR_TEAM_ID): r for r in contest.season_pairs(teams, 2002, 3, season).collect()}
    known = {r.TEAM_ID: r for r in teams.where(F.col("SEASON") == (season or 2001)).collect()}
    want = [(h, a) for h, a in itertools.permutations(known, 2) if known[a].AWAY_REB_MEAN is not None]
    assert sorted(got) == sorted(want) and len(want) == (6 if season else 4)
    for (h, a), r in got.items():
        assert (r.FG_PCT_home, r.REB_home) == (known[h].HOME_FG_PCT, known[h].HOME_REB_MEAN)
        assert (r.FG3_PCT_away, r.AST_away) == (known[a].AWAY_FG3_PCT, known[a].AWAY_AST_MEAN)
        assert (r.YEAR, r.MONTH, r.SEASON) == (2002, 3, season or 2001)


def test_no_teams_no_pairs(spark, teams):
    assert contest.season_pairs(teams.limit(0), 2002, 3).count() == 0


def test_saved_models_score_every_pair(spark):
    got = sup.team_pair_scoring(spark, SF)
    games, features, segments = sup._sets(spark, SF)
    last = games.agg(F.max("GAME_DATE_EST")).first()[0]
    pairs = contest.season_pairs(features, last.year, last.month)
    sides = features.where(F.col("SEASON") == features.agg(F.max("SEASON")).first()[0]).count()
    assert got.count() == pairs.count() == sides * (sides - 1)
    parts = sup._regression_parts(spark, SF, "PTS_away")
    _, fitted = sup.fit_regressors(parts, "PTS_away", ["ridge"])
    data = sup.pair_inputs(pairs, features, segments, parts[2])
    want = {(r[0], r[1]): r[2] for r in models.predicted(fitted["ridge"], data, contest.TEAM_IDS).collect()}
    # by hand: the rule's own numbers
    rule = fitted["ridge"]
    by_hand = {(r.HOME_TEAM_ID, r.VISITOR_TEAM_ID): rule.intercept + sum(float(r[c]) * v for c, v in zip(rule.features, rule.coefficients))
               for r in data.collect()}
    assert all(abs(by_hand[k] - v) < 1e-6 for k, v in want.items())
    for r in got.collect():
        assert abs(r.PRED_away_weakness - want[r.HOME_TEAM_ID, r.VISITOR_TEAM_ID]) < 1e-3


def test_advice_follows_feature_names(spark):
    rows = [(0, 10, "Offensive_Rating", 1), (0, 10, "DEFENSIVE_REB", 2), (1, 4, "defensive_steals", 1), (1, 4, "pace", 2),
            (2, 3, "pace", 1), (2, 3, "points_mean", 6)]
    prof = spark.createDataFrame(rows, "CLUSTER int, SIZE long, FEATURE string, RANK int")
    got = {r.CLUSTER: r.KIND for r in cluster.strategies(prof).where("CLUSTER is not null").collect()}
    assert got == {0: "defend better", 1: "vary the attack", 2: "own strengths"}
    assert cluster.strategies(prof).where("CLUSTER is null").count() == 2
    assert cluster.strategies(prof.limit(0)).count() == 0
