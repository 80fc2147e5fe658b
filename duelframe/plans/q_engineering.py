"""Data-engineering queries (cleaning, imputation, features, joins)."""

from __future__ import annotations

from pyspark.sql import functions as F

from duelframe.functions.columns import drop_existing
from duelframe.operators import clean, contest, profile
from duelframe.plans.base import (
    DERIVED_DOUBLES, GAME_DOUBLES, TF_FEATURES, Stages, round_doubles, sql_round, sql_with,
)
from duelframe.plans.registry import query

_GV_ROUND = sql_round(GAME_DOUBLES + DERIVED_DOUBLES)


@query("games_cleaned", "P1 P2 P3 P4", sql=sql_with(
    f"SELECT * REPLACE ({_GV_ROUND}) FROM gc", upto="gc"))
def games_cleaned(spark, sf_dir):
    """Games with parsed date, YEAR/MONTH/DAY_OF_WEEK (Monday=0), int season,
    boolean outcome, differential, total and margin."""
    return round_doubles(Stages(spark, sf_dir).games_cleaned)


@query("games_validated", "C1 C2 C3 P13", sql=sql_with(
    f"SELECT * REPLACE ({_GV_ROUND}) FROM gv", upto="gv"))
def games_validated(spark, sf_dir):
    """Cleaned games with numeric NULLs filled by the exact column median and
    string NULLs by the mode, in the columns that hold NULLs."""
    return round_doubles(Stages(spark, sf_dir).games_validated)


@query("teams_cleaned", "P5 P6 C5", sql=sql_with("SELECT * FROM tc", upto="tc"))
def teams_cleaned(spark, sf_dir):
    """Teams with upper-case columns, CITY 'Unknown', YEARFOUNDED median and
    null-propagating FULL_NAME."""
    return Stages(spark, sf_dir).teams_cleaned


@query("details_cleaned", "C4 P5", sql=sql_with("SELECT * FROM dc", upto="dc"))
def details_cleaned(spark, sf_dir):
    """Player lines with numeric NULLs set to 0 and upper-case names."""
    return Stages(spark, sf_dir).details_cleaned


@query("team_features_base", "A1 A2 J1 P15 J2 P8", sql=sql_with(
    f"SELECT * REPLACE ({sql_round([c for c in TF_FEATURES if 'COUNT' not in c])}) FROM tf", upto="tf"))
def team_features_base(spark, sf_dir):
    """Per (team, season): home and away performance (inner join), home
    advantage differences, name and city."""
    return round_doubles(Stages(spark, sf_dir, contest.SIDE_COLUMNS).team_features)


_GL_DOUBLES = (GAME_DOUBLES + DERIVED_DOUBLES
               + [f"{s}_HIST_{c}" for s in ("HOME", "AWAY") for c in TF_FEATURES if "COUNT" not in c]
               + ["PTS_DIFF_HIST", "WIN_PCT_DIFF"])


@query("game_level_features", "J3 P7 P16 P9", sql=sql_with(
    f"SELECT * REPLACE ({sql_round(_GL_DOUBLES)}) FROM gl", upto="gl"))
def game_level_features(spark, sf_dir):
    """Each game with both sides' season features (role-playing left joins)
    and the comparative columns."""
    return round_doubles(Stages(spark, sf_dir).game_features)


_GTD_SQL = """
SELECT g.* REPLACE ({r}), ht.NICKNAME AS HOME_TEAM_NAME, ht.CITY AS HOME_TEAM_CITY,
       vt.NICKNAME AS AWAY_TEAM_NAME, vt.CITY AS AWAY_TEAM_CITY,
       bh.DETAIL_PTS AS DETAIL_PTS_HOME, bh.DETAIL_REB AS DETAIL_REB_HOME, bh.DETAIL_AST AS DETAIL_AST_HOME,
       bh.PLAYER_COUNT AS PLAYER_COUNT_HOME,
       ba.DETAIL_PTS AS DETAIL_PTS_AWAY, ba.DETAIL_REB AS DETAIL_REB_AWAY, ba.DETAIL_AST AS DETAIL_AST_AWAY,
       ba.PLAYER_COUNT AS PLAYER_COUNT_AWAY
FROM gv g JOIN tc ht ON g.HOME_TEAM_ID = ht.TEAM_ID JOIN tc vt ON g.VISITOR_TEAM_ID = vt.TEAM_ID
LEFT JOIN box bh ON bh.GAME_ID = g.GAME_ID AND bh.TEAM_ID = g.HOME_TEAM_ID
LEFT JOIN box ba ON ba.GAME_ID = g.GAME_ID AND ba.TEAM_ID = g.VISITOR_TEAM_ID
""".format(r=_GV_ROUND)

_BOX_SQL = ("SELECT GAME_ID, TEAM_ID, sum(PTS) AS DETAIL_PTS, sum(REB) AS DETAIL_REB, sum(AST) AS DETAIL_AST, "
            "count(PLAYER_NAME) AS PLAYER_COUNT FROM (SELECT DISTINCT GAME_ID, TEAM_ID, PLAYER_NAME, PTS, REB, AST "
            "FROM dc) GROUP BY GAME_ID, TEAM_ID")


@query("games_teams_details", "J4 A3 U1 J5 P10", sql=sql_with(_GTD_SQL, upto="dc", extra=[("box", _BOX_SQL)]))
def games_teams_details(spark, sf_dir):
    """Games with both team names (inner joins) and per-side box totals from
    distinct player lines (left joins on game + team)."""
    st = Stages(spark, sf_dir)
    return round_doubles(contest.games_teams_details(st.games_validated, st.teams_cleaned, st.details_cleaned))


@query("team_box_totals", "A3 U1", sql=sql_with("SELECT * FROM box", upto="dc", extra=[("box", _BOX_SQL)]))
def team_box_totals(spark, sf_dir):
    """Distinct player lines summed per (game, team) with player counts."""
    return contest.team_box_totals(Stages(spark, sf_dir).details_cleaned)


_CLS_COLS = ["HOME_TEAM_ID", "VISITOR_TEAM_ID"] + contest.CLASSIFICATION_FEATURES + ["HOME_TEAM_WINS"]
_REG_COLS = (["HOME_TEAM_ID", "VISITOR_TEAM_ID"] + contest.REGRESSION_FEATURES
             + list(contest.REGRESSION_TARGETS.values()))


def _sql_dropna(cols, rounded):
    sel = ", ".join(f"round_even({c}, 6) AS {c}" if c in rounded else c for c in cols)
    cond = " AND ".join(f"{c} IS NOT NULL" for c in cols)
    return f"SELECT {sel} FROM gl WHERE {cond}"


@query("model_input_classification", "P11 F1", sql=sql_with(_sql_dropna(_CLS_COLS, set(_GL_DOUBLES))))
def model_input_classification(spark, sf_dir):
    """Ids + configured classification features + outcome, NULL rows dropped."""
    cls, _ = contest.model_inputs(Stages(spark, sf_dir).game_features)
    return round_doubles(cls)


@query("model_input_regression", "P11 F1", sql=sql_with(_sql_dropna(_REG_COLS, set(_GL_DOUBLES))))
def model_input_regression(spark, sf_dir):
    """Ids + configured regression features + three targets, NULL rows dropped."""
    _, reg = contest.model_inputs(Stages(spark, sf_dir).game_features)
    return round_doubles(reg)


_PG_SQL = """
SELECT d.*, g.* EXCLUDE (GAME_ID) REPLACE ({r}),
       CASE WHEN d.TEAM_ID = g.HOME_TEAM_ID THEN 'HOME' ELSE 'AWAY' END AS TEAM_TYPE,
       t.NICKNAME, t.YEARFOUNDED, t.FULL_NAME
FROM dc d LEFT JOIN gv g ON d.GAME_ID = g.GAME_ID LEFT JOIN tc t ON t.TEAM_ID = d.TEAM_ID
""".format(r=_GV_ROUND)


@query("players_games_teams", "J6 J7 P14 P9", sql=sql_with(_PG_SQL, upto="dc"))
def players_games_teams(spark, sf_dir):
    """Fact-fact left join player lines x games on GAME_ID, TEAM_TYPE
    HOME/AWAY label, left join team attributes with '_team' suffix on
    collisions, redundant columns (ABBREVIATION, CITY) dropped."""
    st = Stages(spark, sf_dir)
    from duelframe.operators import joins
    pg = joins.players_with_games(st.details_cleaned, st.games_validated)
    out = joins.left_join_suffixed(pg, st.teams_cleaned, "TEAM_ID", "_team")
    return round_doubles(drop_existing(out, ["ABBREVIATION", "CITY"]))


@query("team_type_counts", "A18 A12 P14", sql=sql_with("""
SELECT CASE WHEN d.TEAM_ID = g.HOME_TEAM_ID THEN 'HOME' ELSE 'AWAY' END AS VALUE, count(*) AS COUNT
FROM dc d LEFT JOIN gv g ON d.GAME_ID = g.GAME_ID GROUP BY 1""", upto="dc"))
def team_type_counts(spark, sf_dir):
    """Player lines per TEAM_TYPE (countplot data)."""
    st = Stages(spark, sf_dir)
    from duelframe.operators import joins
    return profile.value_counts(joins.players_with_games(st.details_cleaned, st.games_validated), "TEAM_TYPE")


@query("redundant_id_mismatches", "F4", sql=sql_with("""
SELECT count_if(coalesce(HOME_TEAM_ID <> VISITOR_TEAM_ID, true)) AS MISMATCHES,
       count_if(coalesce(YEAR <> SEASON, true)) AS YEAR_MISMATCHES FROM gv""", upto="gv"))
def redundant_id_mismatches(spark, sf_dir):
    """Mismatch counts between two id columns (pandas != semantics: NULL
    counts as a mismatch), here home vs visitor and calendar year vs season."""
    from duelframe.operators import quality
    g = Stages(spark, sf_dir).games_validated
    return g.agg(quality.mismatch_count("HOME_TEAM_ID", "VISITOR_TEAM_ID").alias("MISMATCHES"),
                 quality.mismatch_count("YEAR", "SEASON").alias("YEAR_MISMATCHES"))


# fixed values: the reference configuration's required game columns and drop / rename lists
REQUIRED_GAME_COLS = ["GAME_ID", "SEASON", "GAME_DATE_EST", "HOME_TEAM_ID", "VISITOR_TEAM_ID", "PTS_home",
                      "PTS_away", "HOME_TEAM_WINS"]
GAMES_DROP = ["TEAM_ID_home", "TEAM_ID_away", "GAME_STATUS_TEXT"]
FINAL_DROP = ["ABBREVIATION", "CITY"]


@query("required_columns_contract", "Z7 P9 P10", sql=sql_with("""
SELECT GAME_ID, SEASON, GAME_DATE_EST, HOME_TEAM_ID, VISITOR_TEAM_ID AS AWAY_TEAM_ID,
       round_even(PTS_home, 6) AS PTS_home, round_even(PTS_away, 6) AS PTS_away, HOME_TEAM_WINS
FROM gv""", upto="gv"))
def required_columns_contract(spark, sf_dir):
    """Games checked against the required-column contract (raises when one
    is missing), redundant columns dropped where present, visitor id
    renamed to AWAY_TEAM_ID."""
    g = Stages(spark, sf_dir).games_validated
    missing = [c for c in REQUIRED_GAME_COLS if c not in g.columns]
    if missing:
        raise KeyError(f"required game columns missing: {missing}")
    out = drop_existing(g.select(*REQUIRED_GAME_COLS), GAMES_DROP + FINAL_DROP)
    return round_doubles(out.withColumnRenamed("VISITOR_TEAM_ID", "AWAY_TEAM_ID"))


@query("games_head", "T8", sql=sql_with(
    f"SELECT * REPLACE ({_GV_ROUND}) FROM gv ORDER BY GAME_ID LIMIT 5", upto="gv"))
def games_head(spark, sf_dir):
    """The first five games by id (head sample)."""
    return round_doubles(Stages(spark, sf_dir).games_validated.orderBy("GAME_ID").limit(5))
