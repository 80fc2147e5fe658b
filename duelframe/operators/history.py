"""Ordered operators over contests: form, head-to-head, history.

A contest row is unpivoted into two side rows (one per participant).  Running
values are taken in two levels: inside a bucket (one date of one side and
season, or of one pair of sides), and over the buckets' totals, which are one
row a date.  So no window holds more than one date's rows or one season's
dates, however many contests a side has.  Order is (date, game id): unique
per side, so results are deterministic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


# what the history operators read of a game
GAME_COLUMNS = ["GAME_ID", "GAME_DATE_EST", "SEASON", "HOME_TEAM_ID", "VISITOR_TEAM_ID", "PTS_home", "PTS_away", "HOME_TEAM_WINS"]
MEETING_COLUMNS = ["GAME_ID", "GAME_DATE_EST", "HOME_TEAM_ID", "VISITOR_TEAM_ID", "HOME_TEAM_WINS"]


def side_rows(games: DataFrame, home_col: str = "HOME_TEAM_ID", away_col: str = "VISITOR_TEAM_ID",
              date_col: str = "GAME_DATE_EST", outcome_col: str = "HOME_TEAM_WINS") -> DataFrame:
    """One row per (game, participant): TEAM_ID, OPPONENT_ID, IS_HOME,
    PTS_FOR, PTS_AGAINST, WIN (0/1)."""
    win = F.col(outcome_col).cast("int")
    base = ["GAME_ID", date_col, "SEASON"]
    home = games.select(*base, F.col(home_col).alias("TEAM_ID"), F.col(away_col).alias("OPPONENT_ID"),
                        F.lit(1).alias("IS_HOME"), F.col("PTS_home").alias("PTS_FOR"),
                        F.col("PTS_away").alias("PTS_AGAINST"), win.alias("WIN"))
    away = games.select(*base, F.col(away_col).alias("TEAM_ID"), F.col(home_col).alias("OPPONENT_ID"),
                        F.lit(0).alias("IS_HOME"), F.col("PTS_away").alias("PTS_FOR"),
                        F.col("PTS_home").alias("PTS_AGAINST"), (F.lit(1) - win).alias("WIN"))
    return home.unionByName(away).where(F.col("TEAM_ID").isNotNull())


def recent_form(games: DataFrame, n: int = 5, date_col: str = "GAME_DATE_EST") -> DataFrame:
    """Per (game, side): win share, points for/against over the side's
    previous ``n`` games of the season (the game itself excluded) and how
    many games that window held.

    The last ``n`` games before a date are carried from the dates before it;
    within the date the earlier games are added."""
    s = side_rows(games, date_col=date_col)
    day = ["TEAM_ID", "SEASON", date_col]
    entry = F.struct("GAME_ID", "WIN", "PTS_FOR", "PTS_AGAINST")
    back = W.partitionBy(*day).orderBy(F.col("GAME_ID").desc())
    tails = (s.withColumn("__r", F.row_number().over(back)).where(F.col("__r") <= n)
              .groupBy(*day).agg(F.array_sort(F.collect_list(entry)).alias("__t")))
    dates = W.partitionBy("TEAM_ID", "SEASON").orderBy(date_col).rowsBetween(-n, -1)
    carried = tails.select(*day, F.flatten(F.collect_list("__t").over(dates)).alias("__c"))
    here = W.partitionBy(*day).orderBy("GAME_ID").rowsBetween(-n, -1)
    rows = s.withColumn("__own", F.collect_list(entry).over(here)).join(carried, day)
    rows = rows.withColumn("__p", F.concat("__c", "__own"))
    rows = rows.withColumn("__p", F.when(F.size("__p") > n, F.slice("__p", -n, n)).otherwise(F.col("__p")))

    def mean(field: str):
        known = F.filter(F.transform("__p", lambda x: x[field].cast("double")), lambda x: x.isNotNull())
        return F.try_divide(F.aggregate(known, F.lit(0.0), lambda a, x: a + x), F.size(known))

    return rows.select("GAME_ID", "TEAM_ID", "SEASON", "IS_HOME", mean("WIN").alias("FORM_WIN_PCT"),
                       mean("PTS_FOR").alias("FORM_PTS_FOR"), mean("PTS_AGAINST").alias("FORM_PTS_AGAINST"),
                       F.size(F.filter("__p", lambda x: x["WIN"].isNotNull())).cast("long").alias("FORM_GAMES"))


def running_before(rows: DataFrame, keys: Sequence[str], date_col: str, order: str, sums: dict[str, Column]) -> DataFrame:
    """``rows`` with, for each named expression, its sum over the earlier rows
    of the same keys: totals of earlier dates plus earlier rows of the date."""
    day = [*keys, date_col]
    rows = rows.withColumns({f"__v_{k}": v for k, v in sums.items()})
    totals = rows.groupBy(*day).agg(*[F.sum(f"__v_{k}").alias(f"__d_{k}") for k in sums])
    dates = W.partitionBy(*keys).orderBy(date_col).rowsBetween(W.unboundedPreceding, -1)
    before = totals.select(*day, *[F.coalesce(F.sum(f"__d_{k}").over(dates), F.lit(0)).alias(f"__b_{k}") for k in sums])
    here = W.partitionBy(*day).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    out = rows.withColumns({f"__h_{k}": F.coalesce(F.sum(f"__v_{k}").over(here), F.lit(0)) for k in sums}).join(before, day)
    return out.withColumns({k: F.col(f"__b_{k}") + F.col(f"__h_{k}") for k in sums}).drop(
        *[f"__{x}_{k}" for x in "vbh" for k in sums])


def season_to_date(games: DataFrame, date_col: str = "GAME_DATE_EST") -> DataFrame:
    """Leak-free history: per (game, side) the side's win share and mean
    points over its EARLIER games of the same season."""
    s = side_rows(games, date_col=date_col)
    r = running_before(s, ["TEAM_ID", "SEASON"], date_col, "GAME_ID", {
        "__wins": F.col("WIN"), "__games": F.col("WIN").isNotNull().cast("long"),
        "__pts": F.col("PTS_FOR"), "__scored": F.col("PTS_FOR").isNotNull().cast("long")})
    return r.select("GAME_ID", "TEAM_ID", "SEASON", "IS_HOME",
                    F.try_divide(F.col("__wins").cast("double"), F.col("__games")).alias("PRIOR_WIN_PCT"),
                    F.try_divide("__pts", "__scored").alias("PRIOR_PTS_MEAN"),
                    F.col("__games").alias("PRIOR_GAMES"))


def leak_free_game_features(games: DataFrame, date_col: str = "GAME_DATE_EST") -> DataFrame:
    """Each game with both sides' season-to-date history (no same-game or
    later information), plus the home-minus-away differences."""
    h = season_to_date(games, date_col)
    cols = ("PRIOR_WIN_PCT", "PRIOR_PTS_MEAN", "PRIOR_GAMES")
    # both sides of a game in one row, joined once
    both = h.groupBy("GAME_ID").agg(*[F.max(F.when(F.col("IS_HOME") == flag, F.col(c))).alias(f"{side}_{c}")
                                      for side, flag in (("HOME", 1), ("AWAY", 0)) for c in cols])
    g = games.select("GAME_ID", "SEASON", "HOME_TEAM_ID", "VISITOR_TEAM_ID", "HOME_TEAM_WINS")
    out = g.join(both, "GAME_ID", "left")
    return out.withColumns({
        "PRIOR_WIN_PCT_DIFF": F.col("HOME_PRIOR_WIN_PCT") - F.col("AWAY_PRIOR_WIN_PCT"),
        "PRIOR_PTS_DIFF": F.col("HOME_PRIOR_PTS_MEAN") - F.col("AWAY_PRIOR_PTS_MEAN"),
    })


def head_to_head(games: DataFrame, home_col: str = "HOME_TEAM_ID", away_col: str = "VISITOR_TEAM_ID",
                 date_col: str = "GAME_DATE_EST", outcome_col: str = "HOME_TEAM_WINS") -> DataFrame:
    """Per game: earlier meetings of the same two sides (either venue) and
    how many of them the current home side won."""
    lo, hi = F.least(home_col, away_col), F.greatest(home_col, away_col)
    g = games.select("GAME_ID", date_col, home_col, away_col, outcome_col,
                     lo.alias("__lo"), hi.alias("__hi"))
    # winner of each meeting, seen from the pair's low id
    low_won = F.when(F.col(home_col) == F.col("__lo"), F.col(outcome_col).cast("int")) \
               .otherwise(F.lit(1) - F.col(outcome_col).cast("int"))
    g = g.withColumn("__low_won", low_won)
    g = running_before(g, ["__lo", "__hi"], date_col, "GAME_ID", {"H2H_GAMES": F.lit(1).cast("long"), "__low_wins": F.col("__low_won")})
    home_wins = F.when(F.col(home_col) == F.col("__lo"), F.col("__low_wins")) \
                 .otherwise(F.col("H2H_GAMES") - F.col("__low_wins"))
    return g.select("GAME_ID", home_col, away_col, "H2H_GAMES", home_wins.cast("bigint").alias("H2H_HOME_WINS"))


def home_away_record(games: DataFrame, home_col: str = "HOME_TEAM_ID",
                     away_col: str = "VISITOR_TEAM_ID") -> DataFrame:
    """Per side: home/away win share and points for and against."""
    win = F.col("HOME_TEAM_WINS").cast("double")
    h = games.groupBy(F.col(home_col).alias("TEAM_ID")).agg(
        F.avg(win).alias("HOME_WIN_PCT"), F.avg("PTS_home").alias("HOME_PTS_FOR"),
        F.avg("PTS_away").alias("HOME_PTS_AGAINST"))
    a = games.groupBy(F.col(away_col).alias("TEAM_ID")).agg(
        (F.lit(1.0) - F.avg(win)).alias("AWAY_WIN_PCT"), F.avg("PTS_away").alias("AWAY_PTS_FOR"),
        F.avg("PTS_home").alias("AWAY_PTS_AGAINST"))
    return h.join(a, "TEAM_ID")


def min_games(games: DataFrame, entity_col: str, min_count: int = 5,
              seasons: Sequence[int] | None = None) -> DataFrame:
    """(entity, season) groups with at least ``min_count`` games, optionally
    restricted to a season whitelist (pushed to the scan as an IN filter)."""
    g = games if seasons is None else games.where(F.col("SEASON").isin(list(seasons)))
    return (g.groupBy(F.col(entity_col).alias("TEAM_ID"), "SEASON")
             .agg(F.count(F.lit(1)).alias("GAMES")).where(F.col("GAMES") >= min_count))
