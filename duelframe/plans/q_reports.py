"""Dashboard / notebook reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from duelframe.functions.columns import round_even
from duelframe.operators import contest, reports
from duelframe.plans.base import Stages, round_doubles, sql_round, sql_with
from duelframe.plans.registry import query


def _names(st: Stages):
    return st.teams_cleaned.select("TEAM_ID", F.col("NICKNAME").alias("TEAM_NAME"))


@query("weakest_away_teams", "A6 T4 J8 P22 S7", sql=sql_with("""
SELECT m.TEAM_ID, m.AWAY_WIN_PCT, m.AWAY_PTS_MEAN, m.HOME_WIN_PCT, m.HOME_PTS_MEAN,
       round_even(m.HOME_WIN_PCT - m.AWAY_WIN_PCT, 6) AS WIN_PCT_DIFF,
       round_even(m.HOME_PTS_MEAN - m.AWAY_PTS_MEAN, 6) AS PTS_DIFF, t.NICKNAME AS TEAM_NAME
FROM (SELECT TEAM_ID, round_even(avg(AWAY_WIN_PCT), 3) AS AWAY_WIN_PCT, round_even(avg(AWAY_PTS_MEAN), 3) AS AWAY_PTS_MEAN,
             round_even(avg(HOME_WIN_PCT), 3) AS HOME_WIN_PCT, round_even(avg(HOME_PTS_MEAN), 3) AS HOME_PTS_MEAN
      FROM tf GROUP BY TEAM_ID) m LEFT JOIN tc t ON t.TEAM_ID = m.TEAM_ID
ORDER BY m.AWAY_WIN_PCT, m.TEAM_ID LIMIT 10
""", upto="tf"))
def weakest_away_teams(spark, sf_dir):
    """Ten sides with the lowest all-season away win share, with names and
    home-minus-away differences (the flagship query)."""
    st = Stages(spark, sf_dir, contest.SIDE_COLUMNS)
    return round_doubles(reports.weakest_away(st.team_features, _names(st), k=10))


def _side_top(entity, pts, prefix):
    return f"""
SELECT {entity} AS TEAM_ID, round_even(avg({pts}), 6) AS {prefix}_PTS_MEAN, round_even(stddev_samp({pts}), 6) AS {prefix}_PTS_STD,
       count({pts}) AS {prefix}_GAMES
FROM gv WHERE {entity} IS NOT NULL GROUP BY {entity} ORDER BY {prefix}_PTS_MEAN DESC, TEAM_ID LIMIT 10"""


@query("top10_home_points", "A5 T1", sql=sql_with(_side_top("HOME_TEAM_ID", "PTS_home", "HOME"), upto="gv"))
def top10_home_points(spark, sf_dir):
    """Ten sides with the highest mean home points (mean, std, count)."""
    g = Stages(spark, sf_dir).games_validated
    s = round_doubles(reports.side_points_summary(g, "HOME_TEAM_ID", "PTS_home", "HOME"))
    return reports.top_k(s, "HOME_PTS_MEAN", 10, tie="TEAM_ID")


@query("top10_away_points", "A5 T1", sql=sql_with(_side_top("VISITOR_TEAM_ID", "PTS_away", "AWAY"), upto="gv"))
def top10_away_points(spark, sf_dir):
    """Ten sides with the highest mean away points."""
    g = Stages(spark, sf_dir).games_validated
    s = round_doubles(reports.side_points_summary(g, "VISITOR_TEAM_ID", "PTS_away", "AWAY"))
    return reports.top_k(s, "AWAY_PTS_MEAN", 10, tie="TEAM_ID")


@query("top10_home_win_pct", "A5 T1 P22 P23", sql=sql_with("""
SELECT HOME_TEAM_ID AS TEAM_ID, round_even(avg(CAST(HOME_TEAM_WINS AS DOUBLE)) * 100, 2) AS HOME_WIN_PCT
FROM gv GROUP BY HOME_TEAM_ID ORDER BY HOME_WIN_PCT DESC, TEAM_ID LIMIT 10""", upto="gv"))
def top10_home_win_pct(spark, sf_dir):
    """Ten sides with the best home-win percentage, rounded to 2 digits."""
    g = Stages(spark, sf_dir).games_validated.withColumnRenamed("HOME_TEAM_ID", "TEAM_ID")
    s = reports.share_by(g, "TEAM_ID", "HOME_TEAM_WINS", "HOME_WIN_PCT")
    s = s.withColumn("HOME_WIN_PCT", round_even("HOME_WIN_PCT", 2))
    return reports.top_k(s, "HOME_WIN_PCT", 10, tie="TEAM_ID")


_GAME_COLS = "GAME_ID, GAME_DATE_EST, HOME_TEAM_ID, VISITOR_TEAM_ID, round_even(PTS_home, 6) AS PTS_home, " \
             "round_even(PTS_away, 6) AS PTS_away, round_even(POINT_DIFFERENTIAL, 6) AS DIFF"


def _game_view(st):
    return round_doubles(st.games_validated.select(
        "GAME_ID", "GAME_DATE_EST", "HOME_TEAM_ID", "VISITOR_TEAM_ID", "PTS_home", "PTS_away",
        F.col("POINT_DIFFERENTIAL").alias("DIFF")))


@query("biggest_home_wins", "T2 P4", sql=sql_with(
    f"SELECT {_GAME_COLS} FROM gv ORDER BY POINT_DIFFERENTIAL DESC, GAME_ID LIMIT 10", upto="gv"))
def biggest_home_wins(spark, sf_dir):
    """Ten games with the largest home-minus-away difference."""
    return reports.top_k(_game_view(Stages(spark, sf_dir)), "DIFF", 10, tie="GAME_ID")


@query("closest_games", "T3 P4", sql=sql_with(
    f"SELECT {_GAME_COLS} FROM gv ORDER BY abs(POINT_DIFFERENTIAL), GAME_ID LIMIT 10", upto="gv"))
def closest_games(spark, sf_dir):
    """Ten games with the smallest absolute difference."""
    return reports.closest(_game_view(Stages(spark, sf_dir)), "DIFF", 10)


@query("quick_team_ranking", "T5 P12 P22", sql=sql_with("""
SELECT m.TEAM_ID, round_even(m.METRIC_MEAN, 3) AS METRIC_MEAN, 'HOME_FG_PCT' AS METRIC, t.NICKNAME AS TEAM_NAME
FROM (SELECT TEAM_ID, avg(HOME_FG_PCT) AS METRIC_MEAN FROM tf GROUP BY TEAM_ID) m LEFT JOIN tc t ON t.TEAM_ID = m.TEAM_ID
ORDER BY round_even(m.METRIC_MEAN, 3) DESC, m.TEAM_ID LIMIT 10""", upto="tf"))
def quick_team_ranking(spark, sf_dir):
    """Rank sides on the first feature whose name holds WIN or PCT (chosen
    from the schema), rounded to 3 digits, top ten, with names."""
    st = Stages(spark, sf_dir, contest.SIDE_COLUMNS)
    feats = st.team_features
    r = reports.quick_ranking(feats.withColumn("__x", F.lit(0)).drop("__x"))
    r = r.withColumn("METRIC_MEAN", round_even("METRIC_MEAN", 3))
    r = r.orderBy(F.col("METRIC_MEAN").desc(), "TEAM_ID").limit(10)
    return r.join(_names(st), "TEAM_ID", "left")


@query("team_overview", "A6 J8", sql=sql_with("""
SELECT TEAM_ID, round_even(avg(HOME_WIN_PCT), 6) AS HOME_WIN_PCT, round_even(avg(AWAY_WIN_PCT), 6) AS AWAY_WIN_PCT,
       round_even(avg(HOME_PTS_MEAN), 6) AS HOME_PTS_MEAN, round_even(avg(AWAY_PTS_MEAN), 6) AS AWAY_PTS_MEAN,
       round_even(avg(HOME_WIN_PCT) - avg(AWAY_WIN_PCT), 6) AS WIN_PCT_DIFF,
       round_even(avg(HOME_PTS_MEAN) - avg(AWAY_PTS_MEAN), 6) AS PTS_DIFF
FROM tf GROUP BY TEAM_ID""", upto="tf"))
def team_overview(spark, sf_dir):
    """All-season means of home/away win share and points per side, with
    home-minus-away differences."""
    return round_doubles(reports.entity_overview(Stages(spark, sf_dir, contest.SIDE_COLUMNS).team_features))


def _first_team(st):
    return st.team_features.agg(F.min("TEAM_ID").alias("t")).first()["t"]


@query("team_season_filter", "F2", sql=sql_with("""
WITH one AS (SELECT * FROM tf WHERE TEAM_ID = (SELECT min(TEAM_ID) FROM tf))
SELECT 'all' AS SCOPE, TEAM_ID, SEASON, HOME_GAMES_COUNT, AWAY_GAMES_COUNT FROM one
UNION ALL SELECT 'latest' AS SCOPE, TEAM_ID, SEASON, HOME_GAMES_COUNT, AWAY_GAMES_COUNT FROM one
WHERE SEASON = (SELECT max(SEASON) FROM one)""", upto="tf"))
def team_season_filter(spark, sf_dir):
    """One side's games by season under the dashboard's two filters: all
    seasons, and one season (its latest)."""
    f = Stages(spark, sf_dir, contest.SIDE_COLUMNS).team_features.select("TEAM_ID", "SEASON", "HOME_GAMES_COUNT", "AWAY_GAMES_COUNT")
    first = f.agg(F.min("TEAM_ID").alias("t"), F.min_by("SEASON", F.struct("TEAM_ID", -F.col("SEASON"))).alias("s")).first()
    parts = [reports.filter_entity(f, first["t"], season).withColumn("SCOPE", F.lit(scope))
             for scope, season in (("all", "all"), ("latest", first["s"]))]
    return parts[0].unionByName(parts[1])


_TVL_COLS = ["HOME_WIN_PCT", "AWAY_WIN_PCT", "HOME_PTS_MEAN", "AWAY_PTS_MEAN"]


@query("team_vs_league", "A7 F2", sql=sql_with(
    "SELECT 'TEAM' AS SCOPE, " + ", ".join(f"round_even(avg({c}), 6) AS {c}" for c in _TVL_COLS)
    + " FROM tf WHERE TEAM_ID = (SELECT min(TEAM_ID) FROM tf) UNION ALL SELECT 'LEAGUE' AS SCOPE, "
    + ", ".join(f"round_even(avg({c}), 6) AS {c}" for c in _TVL_COLS) + " FROM tf", upto="tf"))
def team_vs_league(spark, sf_dir):
    """One side's means (the lowest id present) next to the league means,
    as two rows."""
    st = Stages(spark, sf_dir, contest.SIDE_COLUMNS)
    return round_doubles(reports.entity_vs_league(st.team_features, _first_team(st), _TVL_COLS))


@query("latest_season_per_team", "W3", sql=sql_with("""
SELECT TEAM_ID, SEASON, round_even(HOME_WIN_PCT, 6) AS HOME_WIN_PCT, round_even(AWAY_WIN_PCT, 6) AS AWAY_WIN_PCT,
       round_even(HOME_PTS_MEAN, 6) AS HOME_PTS_MEAN, round_even(AWAY_PTS_MEAN, 6) AS AWAY_PTS_MEAN,
       round_even(HOME_ADVANTAGE_PTS, 6) AS HOME_ADVANTAGE_PTS, round_even(HOME_PT_DIFF_MEAN, 6) AS HOME_PT_DIFF_MEAN
FROM tf QUALIFY row_number() OVER (PARTITION BY TEAM_ID ORDER BY SEASON DESC) = 1""", upto="tf"))
def latest_season_per_team(spark, sf_dir):
    """Each side's latest season row (dashboard metric tiles)."""
    f = Stages(spark, sf_dir, contest.SIDE_COLUMNS).team_features.select(
        "TEAM_ID", "SEASON", "HOME_WIN_PCT", "AWAY_WIN_PCT", "HOME_PTS_MEAN", "AWAY_PTS_MEAN",
        "HOME_ADVANTAGE_PTS", "HOME_PT_DIFF_MEAN")
    return round_doubles(reports.latest_per_entity(f))


@query("team_trend", "W4 F2", sql=sql_with("""
SELECT TEAM_ID, SEASON, round_even(HOME_WIN_PCT, 6) AS HOME_WIN_PCT, round_even(AWAY_WIN_PCT, 6) AS AWAY_WIN_PCT,
       round_even(HOME_PTS_MEAN, 6) AS HOME_PTS_MEAN, round_even(AWAY_PTS_MEAN, 6) AS AWAY_PTS_MEAN
FROM tf WHERE TEAM_ID = (SELECT min(TEAM_ID) FROM tf) ORDER BY SEASON""", upto="tf"))
def team_trend(spark, sf_dir):
    """One side's (lowest id present) win shares and points by season."""
    st = Stages(spark, sf_dir, contest.SIDE_COLUMNS)
    return round_doubles(reports.entity_trend(st.team_features, _first_team(st), _TVL_COLS))


@query("game_kpis", "A8", sql=sql_with("""
SELECT count(*) AS GAMES, round_even(avg(CAST(HOME_TEAM_WINS AS DOUBLE)) * 100, 6) AS HOME_WIN_PCT,
       round_even(avg(PTS_home), 6) AS AVG_PTS_HOME, round_even(avg(PTS_away), 6) AS AVG_PTS_AWAY FROM gl""", upto="gl"))
def game_kpis(spark, sf_dir):
    """Game count, home-win %, mean home and away points."""
    return round_doubles(reports.game_kpis(Stages(spark, sf_dir).game_features))


@query("dashboard_kpis", "A9", sql=sql_with("""
SELECT 'team_features' AS "TABLE", count(*) AS ROWS, any_value(len(json_keys(to_json(tf)))) AS COLUMNS, count(DISTINCT TEAM_ID) AS TEAMS,
       count(DISTINCT SEASON) AS SEASONS FROM tf
UNION ALL SELECT 'game_features', count(*), any_value(len(json_keys(to_json(gl)))), count(DISTINCT HOME_TEAM_ID), count(DISTINCT SEASON) FROM gl
UNION ALL SELECT 'teams', count(*), any_value(len(json_keys(to_json(tc)))), count(DISTINCT TEAM_ID), CAST(NULL AS BIGINT) FROM tc""", upto="gl"))
def dashboard_kpis(spark, sf_dir):
    """Per table: rows, columns, distinct teams and seasons (status page)."""
    st = Stages(spark, sf_dir)
    parts = [
        ("team_features", st.team_features, "TEAM_ID", "SEASON"),
        ("game_features", st.game_features, "HOME_TEAM_ID", "SEASON"),
        ("teams", st.teams_cleaned, "TEAM_ID", None),
    ]
    out = None
    for name, df, team, season in parts:
        row = df.agg(F.count(F.lit(1)).alias("ROWS"), F.count_distinct(team).alias("TEAMS"),
                     (F.count_distinct(season) if season else F.lit(None).cast("bigint")).alias("SEASONS"))
        row = row.select(F.lit(name).alias("TABLE"), "ROWS", F.lit(len(df.columns)).alias("COLUMNS"), "TEAMS", "SEASONS")
        out = row if out is None else out.unionByName(row)
    return out


@query("fixture_win_probability", "P19 W3 J8", sql=sql_with("""
WITH first_row AS (SELECT * FROM tf QUALIFY row_number() OVER (PARTITION BY TEAM_ID ORDER BY SEASON) = 1),
     pairs AS (SELECT DISTINCT HOME_TEAM_ID, VISITOR_TEAM_ID FROM gv)
SELECT p.HOME_TEAM_ID, p.VISITOR_TEAM_ID,
       round_even((h.HOME_WIN_PCT + (1 - v.AWAY_WIN_PCT)) / 2, 6) AS HOME_WIN_PROB,
       CASE WHEN (h.HOME_WIN_PCT + (1 - v.AWAY_WIN_PCT)) / 2 > 0.6 THEN 'strong home favourite'
            WHEN (h.HOME_WIN_PCT + (1 - v.AWAY_WIN_PCT)) / 2 > 0.5 THEN 'slight home favourite'
            ELSE 'possible away upset' END AS VERDICT
FROM pairs p JOIN first_row h ON h.TEAM_ID = p.HOME_TEAM_ID JOIN first_row v ON v.TEAM_ID = p.VISITOR_TEAM_ID""",
    upto="tf"))
def fixture_win_probability(spark, sf_dir):
    """Home-win blend and verdict for every (home, visitor) pairing that
    occurs in the games, from each side's first season row.  Pairs come from
    the fixtures (equi-joins), never from an all-pairs product."""
    st = Stages(spark, sf_dir, contest.SIDE_COLUMNS)
    first = reports.latest_per_entity(st.team_features.select("TEAM_ID", "SEASON", "HOME_WIN_PCT", "AWAY_WIN_PCT"),
                                      earliest=True)
    pairs = st.games_validated.select("HOME_TEAM_ID", "VISITOR_TEAM_ID").distinct()
    h = first.select(F.col("TEAM_ID").alias("HOME_TEAM_ID"), "HOME_WIN_PCT")
    v = first.select(F.col("TEAM_ID").alias("VISITOR_TEAM_ID"), F.col("AWAY_WIN_PCT").alias("AWAY_WIN_PCT_V"))
    j = pairs.join(h, "HOME_TEAM_ID").join(v, "VISITOR_TEAM_ID")
    p = (F.col("HOME_WIN_PCT") + (F.lit(1.0) - F.col("AWAY_WIN_PCT_V"))) / F.lit(2.0)
    out = j.select("HOME_TEAM_ID", "VISITOR_TEAM_ID", p.alias("HOME_WIN_PROB"))
    out = out.withColumn("VERDICT", F.when(F.col("HOME_WIN_PROB") > 0.6, "strong home favourite")
                         .when(F.col("HOME_WIN_PROB") > 0.5, "slight home favourite")
                         .otherwise("possible away upset"))
    return round_doubles(out)


@query("best_home_worst_away", "Z8 A5", sql=sql_with("""
WITH h AS (SELECT HOME_TEAM_ID AS TEAM_ID, avg(CAST(HOME_TEAM_WINS AS DOUBLE)) AS HOME_WIN_PCT,
                  avg(PTS_home) AS HOME_PTS_FOR, avg(PTS_away) AS HOME_PTS_AGAINST FROM gv GROUP BY 1),
     a AS (SELECT VISITOR_TEAM_ID AS TEAM_ID, 1 - avg(CAST(HOME_TEAM_WINS AS DOUBLE)) AS AWAY_WIN_PCT,
                  avg(PTS_away) AS AWAY_PTS_FOR, avg(PTS_home) AS AWAY_PTS_AGAINST FROM gv GROUP BY 1)
SELECT h.TEAM_ID, round_even(HOME_WIN_PCT, 6) AS HOME_WIN_PCT, round_even(HOME_PTS_FOR, 6) AS HOME_PTS_FOR,
       round_even(HOME_PTS_AGAINST, 6) AS HOME_PTS_AGAINST, round_even(AWAY_WIN_PCT, 6) AS AWAY_WIN_PCT,
       round_even(AWAY_PTS_FOR, 6) AS AWAY_PTS_FOR, round_even(AWAY_PTS_AGAINST, 6) AS AWAY_PTS_AGAINST
FROM h JOIN a ON h.TEAM_ID = a.TEAM_ID""", upto="gv"))
def best_home_worst_away(spark, sf_dir):
    """Per side over all games: home and away win share, points for and
    against on each side (best-home / worst-away report)."""
    from duelframe.operators import history
    return round_doubles(history.home_away_record(Stages(spark, sf_dir, contest.SIDE_COLUMNS).games_validated))


@query("min_games_team_seasons", "F3 Z3", sql=sql_with("""
SELECT HOME_TEAM_ID AS TEAM_ID, SEASON, count(*) AS GAMES FROM gv
WHERE SEASON IN (1992, 1993, 1994, 1995, 1996, 1997, 1998)
GROUP BY HOME_TEAM_ID, SEASON HAVING count(*) >= 5""", upto="gv"))
def min_games_team_seasons(spark, sf_dir):
    """Team-seasons (home side) of whitelisted seasons with at least five games."""
    from duelframe.operators import history
    return history.min_games(Stages(spark, sf_dir).games_validated, "HOME_TEAM_ID", 5,
                             seasons=[1992, 1993, 1994, 1995, 1996, 1997, 1998])
