"""Joins: fact-fact and suffixed lookups; broadcasts are left to the planner."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def players_with_games(details: DataFrame, games: DataFrame, home_col: str = "HOME_TEAM_ID") -> DataFrame:
    """Player lines left-joined to their game on GAME_ID (sort-merge join of
    two fact tables; AQE splits skewed game partitions) and TEAM_TYPE = HOME
    when the player's team is the home side, AWAY otherwise (NULL -> AWAY)."""
    j = details.join(games, "GAME_ID", "left")
    return j.withColumn("TEAM_TYPE", F.when(F.col("TEAM_ID") == F.col(home_col), "HOME").otherwise("AWAY"))


def left_join_suffixed(left: DataFrame, right: DataFrame, key: str, suffix: str = "_team") -> DataFrame:
    """Left join on ``key``; right columns whose names collide get ``suffix``."""
    clash = {c for c in right.columns if c != key and c.upper() in {x.upper() for x in left.columns}}
    r = right.withColumnsRenamed({c: c + suffix for c in clash})
    return left.join(r, key, "left")
