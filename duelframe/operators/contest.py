"""Two-sided aggregation and role-playing joins.

A contest row has a home side and an away side.  Per-entity features are
built by grouping once by (home entity, season) and once by (away entity,
season); both are partial (map-side) aggregations, so the shuffle carries one
row per (entity, season, map task), never raw rows.  The results have one row
per entity-season: tiny next to the fact table, and joined back to facts with
the planner's choice (AQE broadcasts them when the run-time size is small).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duelframe.functions.columns import drop_existing, existing, prefix_columns

# fixed values: the statistics kept per side and their output names
SIDE_STATS = [("FG_PCT", "FG_PCT"), ("FT_PCT", "FT_PCT"), ("FG3_PCT", "FG3_PCT"),
              ("REB", "REB_MEAN"), ("AST", "AST_MEAN")]
KEY_COLS = ["TEAM_ID", "SEASON"]
# what side_performance reads of a game
SIDE_COLUMNS = ["SEASON", "HOME_TEAM_ID", "VISITOR_TEAM_ID", "HOME_TEAM_WINS", "POINT_DIFFERENTIAL",
                *[f"{c}_{side}" for c in ("PTS", *(src for src, _ in SIDE_STATS)) for side in ("home", "away")]]


def exact_mean(col: str) -> Column:
    """Mean whose sum is taken over 12-digit decimals, so it does not depend
    on the order in which tasks add up; NULL without values."""
    total = F.sum(F.col(col).cast("decimal(28,12)")).cast("double")
    return total / F.nullif(F.count(col), F.lit(0))


def side_performance(games: DataFrame, side: str, entity_col: str, season_col: str = "SEASON",
                     outcome_col: str = "HOME_TEAM_WINS", diff_col: str = "POINT_DIFFERENTIAL",
                     suffix: str | None = None) -> DataFrame:
    """Per (entity, season) performance of one side ('HOME' or 'AWAY').

    PTS mean / sample std / count, the five rate means, win share and mean
    differential.  For the away side the win share is ``1 - mean(outcome)``
    and the differential ``-mean(diff)``.  NULL entity keys form no group.
    """
    sfx = suffix or ("home" if side == "HOME" else "away")
    win = F.avg(F.col(outcome_col).cast("double"))
    dif = F.avg(diff_col)
    if side != "HOME":
        win = F.lit(1.0) - win
        dif = -dif
    aggs = [
        F.avg(f"PTS_{sfx}").alias(f"{side}_PTS_MEAN"),
        F.stddev_samp(f"PTS_{sfx}").alias(f"{side}_PTS_STD"),
        F.count(f"PTS_{sfx}").alias(f"{side}_GAMES_COUNT"),
        *[exact_mean(f"{src}_{sfx}").alias(f"{side}_{dst}") for src, dst in SIDE_STATS],
        win.alias(f"{side}_WIN_PCT"),
        dif.alias(f"{side}_PT_DIFF_MEAN"),
    ]
    return (games.where(F.col(entity_col).isNotNull())
                 .groupBy(F.col(entity_col).alias("TEAM_ID"), F.col(season_col).alias("SEASON"))
                 .agg(*aggs))


def team_features_base(games: DataFrame, teams: DataFrame | None = None,
                       home_col: str = "HOME_TEAM_ID", away_col: str = "VISITOR_TEAM_ID") -> DataFrame:
    """Home and away performance joined (inner: one-sided team-seasons drop),
    home-advantage differences, team name/city by left lookup."""
    home = side_performance(games, "HOME", home_col)
    away = side_performance(games, "AWAY", away_col)
    tf = home.join(away, KEY_COLS).withColumns({
        "HOME_ADVANTAGE_PTS": F.col("HOME_PTS_MEAN") - F.col("AWAY_PTS_MEAN"),
        "HOME_ADVANTAGE_WIN": F.col("HOME_WIN_PCT") - F.col("AWAY_WIN_PCT"),
        "HOME_ADVANTAGE_REB": F.col("HOME_REB_MEAN") - F.col("AWAY_REB_MEAN"),
    })
    if teams is not None:
        tf = tf.join(teams.select("TEAM_ID", "NICKNAME", "CITY"), "TEAM_ID", "left")
    return tf


def game_level_features(games: DataFrame, team_features: DataFrame,
                        home_col: str = "HOME_TEAM_ID", away_col: str = "VISITOR_TEAM_ID") -> DataFrame:
    """Each game with the season features of both sides (role-playing left
    joins, right sides renamed first) plus PTS_DIFF_HIST and WIN_PCT_DIFF.

    The features have one row a side and season and are broadcast: a shuffle
    of the games by so few keys would put a side's whole season into one task."""
    keep = ["TEAM_ID", "SEASON", "NICKNAME", "CITY"]
    feats = team_features.drop(*[c for c in ("NICKNAME", "CITY") if c in team_features.columns])
    home = prefix_columns(feats, "HOME_HIST_", keep).withColumnsRenamed(
        {"TEAM_ID": "__h_team", "SEASON": "__h_season"})
    away = prefix_columns(feats, "AWAY_HIST_", keep).withColumnsRenamed(
        {"TEAM_ID": "__a_team", "SEASON": "__a_season"})
    g = (games
         .join(F.broadcast(home), (F.col(home_col) == F.col("__h_team")) & (F.col("SEASON") == F.col("__h_season")), "left")
         .join(F.broadcast(away), (F.col(away_col) == F.col("__a_team")) & (F.col("SEASON") == F.col("__a_season")), "left")
         .drop("__h_team", "__h_season", "__a_team", "__a_season"))
    return g.withColumns({
        "PTS_DIFF_HIST": F.col("HOME_HIST_HOME_PTS_MEAN") - F.col("AWAY_HIST_AWAY_PTS_MEAN"),
        "WIN_PCT_DIFF": F.col("HOME_HIST_HOME_WIN_PCT") - F.col("AWAY_HIST_AWAY_WIN_PCT"),
    })


def team_box_totals(details: DataFrame) -> DataFrame:
    """Distinct (game, team, player name, PTS, REB, AST) lines summed per
    (game, team); PLAYER_COUNT counts non-NULL names.  Pre-aggregates the
    big player table before it meets the games."""
    d = details.select("GAME_ID", "TEAM_ID", "PLAYER_NAME", "PTS", "REB", "AST").distinct()
    return d.groupBy("GAME_ID", "TEAM_ID").agg(
        F.sum("PTS").alias("DETAIL_PTS"), F.sum("REB").alias("DETAIL_REB"),
        F.sum("AST").alias("DETAIL_AST"), F.count("PLAYER_NAME").alias("PLAYER_COUNT"))


def games_teams_details(games: DataFrame, teams: DataFrame, details: DataFrame | None,
                        home_col: str = "HOME_TEAM_ID", away_col: str = "VISITOR_TEAM_ID") -> DataFrame:
    """Games with both team names (inner joins: unknown teams drop) and, when
    player lines are given, per-side box totals (left joins on game + team)."""
    g = drop_existing(games, ["TEAM_ID_home", "TEAM_ID_away", "GAME_STATUS_TEXT"])
    t = teams.select("TEAM_ID", "NICKNAME", "CITY")
    g = (g.join(t.withColumnsRenamed({"TEAM_ID": "__ht", "NICKNAME": "HOME_TEAM_NAME", "CITY": "HOME_TEAM_CITY"}),
                F.col(home_col) == F.col("__ht"))
          .join(t.withColumnsRenamed({"TEAM_ID": "__at", "NICKNAME": "AWAY_TEAM_NAME", "CITY": "AWAY_TEAM_CITY"}),
                F.col(away_col) == F.col("__at"))
          .drop("__ht", "__at"))
    if details is None:
        return g
    # the teams' totals of a game in one row (a handful of teams), joined once for both sides
    totals = ("DETAIL_PTS", "DETAIL_REB", "DETAIL_AST", "PLAYER_COUNT")
    box = team_box_totals(details).groupBy(F.col("GAME_ID").alias("__g")).agg(
        F.collect_list(F.struct("TEAM_ID", *totals)).alias("__box"))
    g = g.join(box, F.col("GAME_ID") == F.col("__g"), "left")

    def of_team(key: str) -> Column:
        return F.get(F.filter("__box", lambda x: x["TEAM_ID"] == F.col(key)), F.lit(0))

    for tag, key in (("HOME", home_col), ("AWAY", away_col)):
        g = g.withColumns({f"{c}_{tag}": of_team(key)[c] for c in totals})
    return g.drop("__g", "__box")


# fixed values: default feature lists of the reference configuration
CLASSIFICATION_FEATURES = [
    "PTS_home", "PTS_away", "FG_PCT_home", "FG_PCT_away", "FT_PCT_home", "FT_PCT_away",
    "FG3_PCT_home", "FG3_PCT_away", "REB_home", "REB_away", "AST_home", "AST_away",
    "HOME_HIST_HOME_WIN_PCT", "AWAY_HIST_AWAY_WIN_PCT", "WIN_PCT_DIFF",
]
REGRESSION_FEATURES = [
    "FG_PCT_home", "FT_PCT_home", "FG3_PCT_home", "AST_home", "REB_home",
    "FG_PCT_away", "FT_PCT_away", "FG3_PCT_away", "AST_away", "REB_away", "YEAR", "MONTH",
]
REGRESSION_TARGETS = {"local_strength": "PTS_home", "away_weakness": "PTS_away",
                      "point_differential": "POINT_DIFFERENTIAL"}
TEAM_IDS = ["HOME_TEAM_ID", "VISITOR_TEAM_ID"]


def model_inputs(game_features: DataFrame,
                 classification_features: Sequence[str] = CLASSIFICATION_FEATURES,
                 regression_features: Sequence[str] = REGRESSION_FEATURES,
                 classification_target: str = "HOME_TEAM_WINS",
                 regression_targets: dict[str, str] | None = None,
                 ids: Sequence[str] = TEAM_IDS) -> tuple[DataFrame, DataFrame]:
    """(classification set, regression set): ids + existing features +
    target(s), rows with any NULL dropped."""
    targets = list((regression_targets or REGRESSION_TARGETS).values())
    cls_cols = list(ids) + existing(game_features, classification_features) + [classification_target]
    reg_cols = list(ids) + existing(game_features, regression_features) + targets
    cls = game_features.select(*cls_cols).dropna()
    reg = game_features.select(*reg_cols).dropna()
    return cls, reg


def season_pairs(team_features: DataFrame, year: int, month: int, season: int | None = None) -> DataFrame:
    """Every ordered pair of different sides of one season (the latest unless
    given) as a game to come, with the columns of the regression features.

    A statistic of the home side is its mean over its home games of the
    season, one of the visitor its mean over its away games; YEAR and MONTH
    are the given ones.  Pairs with a NULL feature are left out.  The result
    has one row a pair of sides, whatever the number of games."""
    if season is None:
        season = team_features.agg(F.max("SEASON")).first()[0]
    sides = team_features.where(F.col("SEASON") == season)

    def one(side: str, key: str, tag: str) -> DataFrame:
        return sides.select("SEASON", F.col("TEAM_ID").alias(key),
                            *[F.col(f"{side}_{mean}").alias(f"{stat}_{tag}") for stat, mean in SIDE_STATS])

    pairs = one("HOME", TEAM_IDS[0], "home").join(one("AWAY", TEAM_IDS[1], "away"), "SEASON")
    pairs = pairs.where(F.col(TEAM_IDS[0]) != F.col(TEAM_IDS[1]))
    stamped = pairs.withColumns({"YEAR": F.lit(year).cast("int"), "MONTH": F.lit(month).cast("int")})
    return stamped.select("SEASON", *TEAM_IDS, *REGRESSION_FEATURES).dropna()
