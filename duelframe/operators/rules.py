"""Association rules over discretised contest facts (Spark ML FP-growth)."""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duelframe.operators.quantiles import exact_quantiles


def game_facts(games: DataFrame) -> DataFrame:
    """One basket per game: outcome, high/low scoring on each side (above
    the column median), rebound and assist edges, weekend flag."""
    med = {c: q[0] for c, q in exact_quantiles(games, ["PTS_home", "PTS_away"], [0.5]).items()}
    items = [
        F.when(F.col("HOME_TEAM_WINS"), F.lit("home_win")).otherwise(F.lit("away_win")),
        F.when(F.col("PTS_home") > F.lit(med["PTS_home"]), F.lit("home_pts_high")).otherwise(F.lit("home_pts_low")),
        F.when(F.col("PTS_away") > F.lit(med["PTS_away"]), F.lit("away_pts_high")).otherwise(F.lit("away_pts_low")),
        F.when(F.col("REB_home") > F.col("REB_away"), F.lit("home_reb_edge")),
        F.when(F.col("AST_home") > F.col("AST_away"), F.lit("home_ast_edge")),
        F.when(F.col("DAY_OF_WEEK") >= 5, F.lit("weekend")),
    ]
    return games.select("GAME_ID", F.filter(F.array(*items), lambda x: x.isNotNull()).alias("items"))


def game_fact_rules(games: DataFrame, min_support: float = 0.01, min_confidence: float = 0.5,
                    min_lift: float = 1.0, max_length: int = 3) -> DataFrame:
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(game_facts(games))
    r = model.associationRules
    r = r.where((F.col("lift") >= min_lift) & (F.size("antecedent") + F.size("consequent") <= max_length))
    return r.select(F.array_join(F.array_sort("antecedent"), ",").alias("ANTECEDENT"),
                    F.array_join(F.array_sort("consequent"), ",").alias("CONSEQUENT"),
                    F.col("confidence").alias("CONFIDENCE"), F.col("lift").alias("LIFT"),
                    F.col("support").alias("SUPPORT"))
