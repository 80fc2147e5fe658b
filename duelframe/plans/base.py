"""Shared stages of the named queries (Spark side) and their SQL twins.

Spark side: ``Stages`` builds the engineering DAG lazily for one folder
(validated games -> team features -> game features ...).  SQL side: the same
stages as DuckDB CTE text, composed with ``sql_with``.
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duelframe.functions.columns import round_even
from duelframe.operators import clean, contest
from duelframe.session import materialise
from duelframe.sources.adapter import Contest, DETAILS_SQL, GAMES_SQL, TEAMS_SQL

ROUND = 6


def round_doubles(df: DataFrame, digits: int = ROUND) -> DataFrame:
    """Round every DOUBLE column half-even (stable value hashes)."""
    return df.withColumns({f.name: round_even(F.col(f"`{f.name}`"), digits) for f in df.schema.fields
                           if isinstance(f.dataType, (T.DoubleType, T.FloatType))})


def sql_round(cols, digits: int = ROUND) -> str:
    """DuckDB select-list fragment rounding ``cols`` half-even."""
    return ", ".join(f"round_even({c}, {digits}) AS {c}" for c in cols)


class Stages:
    """The engineering stages of one folder.  ``columns``: the game columns
    that the query reads (None: all); no others are written or imputed."""

    def __init__(self, spark: SparkSession, sf_dir: str, columns: Sequence[str] | None = None):
        self.spark = spark
        self.c = Contest(spark, sf_dir)
        self.columns = columns

    @cached_property
    def games_cleaned(self) -> DataFrame:
        # fan-out point: the median pass, both side aggregations and the
        # game-level joins all read it, so it is written once to the shared
        # folder; readers prune its columns and plans stay shallow
        games = clean.clean_games(self.c.games)
        if not self.columns:
            return materialise(games, "games_cleaned")
        own = list(dict.fromkeys(self.columns))
        # the name tells tables of other columns apart
        return materialise(games.select(*own), f"games_cleaned-{zlib.crc32(','.join(own).encode()):08x}")

    @cached_property
    def games_validated(self) -> DataFrame:
        return clean.impute_median_mode(self.games_cleaned)

    @cached_property
    def teams_cleaned(self) -> DataFrame:
        return clean.clean_teams(self.c.teams)

    @cached_property
    def details_cleaned(self) -> DataFrame:
        return clean.clean_details(self.c.details_of(self.games_cleaned))

    @cached_property
    def team_features(self) -> DataFrame:
        # one row a team and season, read by many joins: written once
        return materialise(contest.team_features_base(self.games_validated, self.teams_cleaned), "team_features")

    @cached_property
    def game_features(self) -> DataFrame:
        return contest.game_level_features(self.games_validated, self.team_features)


GAME_DOUBLES = ["PTS_home", "PTS_away", "FG_PCT_home", "FG_PCT_away", "FT_PCT_home", "FT_PCT_away",
                "FG3_PCT_home", "FG3_PCT_away", "REB_home", "REB_away", "AST_home", "AST_away"]
DERIVED_DOUBLES = ["POINT_DIFFERENTIAL", "TOTAL_POINTS", "MARGIN_OF_VICTORY"]

GC_SQL = """
SELECT * REPLACE (HOME_TEAM_WINS = 1 AS HOME_TEAM_WINS),
       CAST(year(GAME_DATE_EST) AS INT) AS YEAR, CAST(month(GAME_DATE_EST) AS INT) AS MONTH,
       CAST(isodow(GAME_DATE_EST) - 1 AS INT) AS DAY_OF_WEEK,
       PTS_home - PTS_away AS POINT_DIFFERENTIAL, PTS_home + PTS_away AS TOTAL_POINTS,
       abs(PTS_home - PTS_away) AS MARGIN_OF_VICTORY
FROM games
"""

GV_SQL = ("SELECT * REPLACE ("
          + ", ".join(f"coalesce({c}, (SELECT median({c}) FROM gc)) AS {c}"
                      for c in GAME_DOUBLES + DERIVED_DOUBLES)
          + ") FROM gc")

TC_SQL = """
SELECT TEAM_ID, NICKNAME, coalesce(CITY, 'Unknown') AS CITY,
       coalesce(YEARFOUNDED, (SELECT median(YEARFOUNDED) FROM teams)) AS YEARFOUNDED,
       coalesce(CITY, 'Unknown') || ' ' || NICKNAME AS FULL_NAME
FROM teams
"""

def _exact_avg(col: str) -> str:
    """Mean of a rate whose sum does not depend on the order of rows."""
    return f"CAST(sum(CAST({col} AS DECIMAL(28, 12))) AS DOUBLE) / count({col})"


_RATES = [("FG_PCT", "FG_PCT"), ("FT_PCT", "FT_PCT"), ("FG3_PCT", "FG3_PCT"),
          ("REB", "REB_MEAN"), ("AST", "AST_MEAN")]


def _side_sql(side: str, key: str, sfx: str) -> str:
    win = "avg(CAST(HOME_TEAM_WINS AS DOUBLE))"
    dif = "avg(POINT_DIFFERENTIAL)"
    if side != "HOME":
        win, dif = f"1 - {win}", f"-{dif}"
    rates = ", ".join(f"{_exact_avg(f'{s}_{sfx}')} AS {side}_{d}" for s, d in _RATES)
    return (f"SELECT {key} AS TEAM_ID, SEASON, avg(PTS_{sfx}) AS {side}_PTS_MEAN, "
            f"stddev_samp(PTS_{sfx}) AS {side}_PTS_STD, count(PTS_{sfx}) AS {side}_GAMES_COUNT, "
            f"{rates}, {win} AS {side}_WIN_PCT, {dif} AS {side}_PT_DIFF_MEAN "
            f"FROM gv WHERE {key} IS NOT NULL GROUP BY {key}, SEASON")


HOME_SQL = _side_sql("HOME", "HOME_TEAM_ID", "home")
AWAY_SQL = _side_sql("AWAY", "VISITOR_TEAM_ID", "away")

TF_SQL = """
SELECT h.*, a.* EXCLUDE (TEAM_ID, SEASON),
       h.HOME_PTS_MEAN - a.AWAY_PTS_MEAN AS HOME_ADVANTAGE_PTS,
       h.HOME_WIN_PCT - a.AWAY_WIN_PCT AS HOME_ADVANTAGE_WIN,
       h.HOME_REB_MEAN - a.AWAY_REB_MEAN AS HOME_ADVANTAGE_REB,
       t.NICKNAME, t.CITY
FROM home_perf h JOIN away_perf a ON h.TEAM_ID = a.TEAM_ID AND h.SEASON = a.SEASON
LEFT JOIN tc t ON t.TEAM_ID = h.TEAM_ID
"""

TF_FEATURES = ["HOME_PTS_MEAN", "HOME_PTS_STD", "HOME_GAMES_COUNT", "HOME_FG_PCT", "HOME_FT_PCT",
               "HOME_FG3_PCT", "HOME_REB_MEAN", "HOME_AST_MEAN", "HOME_WIN_PCT", "HOME_PT_DIFF_MEAN",
               "AWAY_PTS_MEAN", "AWAY_PTS_STD", "AWAY_GAMES_COUNT", "AWAY_FG_PCT", "AWAY_FT_PCT",
               "AWAY_FG3_PCT", "AWAY_REB_MEAN", "AWAY_AST_MEAN", "AWAY_WIN_PCT", "AWAY_PT_DIFF_MEAN",
               "HOME_ADVANTAGE_PTS", "HOME_ADVANTAGE_WIN", "HOME_ADVANTAGE_REB"]


def _gl_sql() -> str:
    hist = [c for c in TF_FEATURES]
    h = ", ".join(f"h.{c} AS HOME_HIST_{c}" for c in hist)
    a = ", ".join(f"a.{c} AS AWAY_HIST_{c}" for c in hist)
    return (f"SELECT g.*, {h}, {a}, "
            "h.HOME_PTS_MEAN - a.AWAY_PTS_MEAN AS PTS_DIFF_HIST, "
            "h.HOME_WIN_PCT - a.AWAY_WIN_PCT AS WIN_PCT_DIFF "
            "FROM gv g LEFT JOIN tf h ON g.HOME_TEAM_ID = h.TEAM_ID AND g.SEASON = h.SEASON "
            "LEFT JOIN tf a ON g.VISITOR_TEAM_ID = a.TEAM_ID AND g.SEASON = a.SEASON")


GL_SQL = _gl_sql()

DC_SQL = """
SELECT GAME_ID, TEAM_ID, PLAYER_ID, PLAYER_NAME, coalesce(PTS, 0) AS PTS, coalesce(REB, 0) AS REB,
       coalesce(AST, 0) AS AST
FROM details
"""

# named stages in dependency order
STAGE_SQL = {
    "games": GAMES_SQL, "details": DETAILS_SQL, "teams": TEAMS_SQL,
    "gc": GC_SQL, "gv": GV_SQL, "tc": TC_SQL, "dc": DC_SQL,
    "home_perf": HOME_SQL, "away_perf": AWAY_SQL, "tf": TF_SQL, "gl": GL_SQL,
}


def sql_with(body: str, upto: str = "gl", extra: list[tuple[str, str]] | None = None) -> str:
    """``WITH`` every stage up to ``upto`` (inclusive) + extra CTEs, then body."""
    names = list(STAGE_SQL)
    ctes = [(n, STAGE_SQL[n]) for n in names[: names.index(upto) + 1]]
    ctes += extra or []
    head = "WITH " + ",\n".join(f"{n} AS ({s.strip()})" for n, s in ctes)
    body = body.strip()
    if body[:5].upper() == "WITH ":
        return head + ",\n" + body[5:]
    return head + "\n" + body
