"""Window queries: recent form, season-to-date history, head-to-head."""

from __future__ import annotations

from duelframe.operators import history
from duelframe.plans.base import Stages, round_doubles, sql_with
from duelframe.plans.registry import query

_SIDES_SQL = """
SELECT GAME_ID, GAME_DATE_EST, SEASON, HOME_TEAM_ID AS TEAM_ID, 1 AS IS_HOME, PTS_home AS PTS_FOR,
       PTS_away AS PTS_AGAINST, CAST(HOME_TEAM_WINS AS INT) AS WIN FROM gv WHERE HOME_TEAM_ID IS NOT NULL
UNION ALL
SELECT GAME_ID, GAME_DATE_EST, SEASON, VISITOR_TEAM_ID, 0, PTS_away, PTS_home, 1 - CAST(HOME_TEAM_WINS AS INT)
FROM gv WHERE VISITOR_TEAM_ID IS NOT NULL
"""


@query("recent_form", "Z1", sql=sql_with("""
SELECT GAME_ID, TEAM_ID, SEASON, IS_HOME,
       round_even(avg(WIN) OVER w, 6) AS FORM_WIN_PCT, round_even(avg(PTS_FOR) OVER w, 6) AS FORM_PTS_FOR,
       round_even(avg(PTS_AGAINST) OVER w, 6) AS FORM_PTS_AGAINST, count(WIN) OVER w AS FORM_GAMES
FROM sides
WINDOW w AS (PARTITION BY TEAM_ID, SEASON ORDER BY GAME_DATE_EST, GAME_ID ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)
""", upto="gv", extra=[("sides", _SIDES_SQL)]))
def recent_form(spark, sf_dir):
    """Each side's win share and points over its previous five games of the
    season, for every game it plays."""
    return round_doubles(history.recent_form(Stages(spark, sf_dir, history.GAME_COLUMNS).games_validated, n=5))


_STD_SQL = """
SELECT GAME_ID, TEAM_ID, SEASON, IS_HOME, avg(WIN) OVER w AS PRIOR_WIN_PCT, avg(PTS_FOR) OVER w AS PRIOR_PTS_MEAN,
       count(WIN) OVER w AS PRIOR_GAMES
FROM sides
WINDOW w AS (PARTITION BY TEAM_ID, SEASON ORDER BY GAME_DATE_EST, GAME_ID ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
"""


@query("leak_free_game_features", "Z6", sql=sql_with("""
SELECT g.GAME_ID, g.SEASON, g.HOME_TEAM_ID, g.VISITOR_TEAM_ID, g.HOME_TEAM_WINS,
       round_even(h.PRIOR_WIN_PCT, 6) AS HOME_PRIOR_WIN_PCT, round_even(h.PRIOR_PTS_MEAN, 6) AS HOME_PRIOR_PTS_MEAN,
       h.PRIOR_GAMES AS HOME_PRIOR_GAMES,
       round_even(a.PRIOR_WIN_PCT, 6) AS AWAY_PRIOR_WIN_PCT, round_even(a.PRIOR_PTS_MEAN, 6) AS AWAY_PRIOR_PTS_MEAN,
       a.PRIOR_GAMES AS AWAY_PRIOR_GAMES,
       round_even(h.PRIOR_WIN_PCT - a.PRIOR_WIN_PCT, 6) AS PRIOR_WIN_PCT_DIFF,
       round_even(h.PRIOR_PTS_MEAN - a.PRIOR_PTS_MEAN, 6) AS PRIOR_PTS_DIFF
FROM gv g LEFT JOIN std h ON h.GAME_ID = g.GAME_ID AND h.IS_HOME = 1
LEFT JOIN std a ON a.GAME_ID = g.GAME_ID AND a.IS_HOME = 0
""", upto="gv", extra=[("sides", _SIDES_SQL), ("std", _STD_SQL)]))
def leak_free_game_features(spark, sf_dir):
    """Each game with both sides' season-to-date win share and points from
    earlier games only (the honest feature set)."""
    return round_doubles(history.leak_free_game_features(Stages(spark, sf_dir, history.GAME_COLUMNS).games_validated))


@query("head_to_head", "Z2", sql=sql_with("""
SELECT GAME_ID, HOME_TEAM_ID, VISITOR_TEAM_ID, H2H_GAMES,
       CAST(CASE WHEN HOME_TEAM_ID = lo THEN low_wins ELSE H2H_GAMES - low_wins END AS BIGINT) AS H2H_HOME_WINS
FROM (SELECT *, count(*) OVER w AS H2H_GAMES, coalesce(sum(low_won) OVER w, 0) AS low_wins
      FROM (SELECT GAME_ID, GAME_DATE_EST, HOME_TEAM_ID, VISITOR_TEAM_ID, least(HOME_TEAM_ID, VISITOR_TEAM_ID) AS lo,
                   greatest(HOME_TEAM_ID, VISITOR_TEAM_ID) AS hi,
                   CASE WHEN HOME_TEAM_ID = least(HOME_TEAM_ID, VISITOR_TEAM_ID) THEN CAST(HOME_TEAM_WINS AS INT)
                        ELSE 1 - CAST(HOME_TEAM_WINS AS INT) END AS low_won FROM gv)
      WINDOW w AS (PARTITION BY lo, hi ORDER BY GAME_DATE_EST, GAME_ID ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
""", upto="gv"))
def head_to_head(spark, sf_dir):
    """Per game: earlier meetings of the two sides and the home side's wins
    in them."""
    return history.head_to_head(Stages(spark, sf_dir, history.MEETING_COLUMNS).games_validated)
