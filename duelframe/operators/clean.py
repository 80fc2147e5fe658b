"""Cleaning and imputation (one pass per table for the statistics)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duelframe.functions.columns import (
    concat_null, numeric_columns, string_columns, upper_columns, weekday_monday0,
)
from duelframe.operators.quantiles import exact_quantiles, mode


def clean_games(games: DataFrame, date_col: str = "GAME_DATE_EST", season_col: str = "SEASON",
                outcome_col: str = "HOME_TEAM_WINS", home_pts: str = "PTS_home",
                away_pts: str = "PTS_away") -> DataFrame:
    """Parse the date, add YEAR/MONTH/DAY_OF_WEEK (Monday=0), cast season to
    int and outcome to boolean, add POINT_DIFFERENTIAL, TOTAL_POINTS and
    MARGIN_OF_VICTORY.  NULL scores give NULL derived columns."""
    diff = F.col(home_pts) - F.col(away_pts)
    return games.withColumns({
        date_col: F.to_date(date_col),
        "YEAR": F.year(date_col),
        "MONTH": F.month(date_col),
        "DAY_OF_WEEK": weekday_monday0(date_col),
        season_col: F.col(season_col).cast("int"),
        outcome_col: (F.col(outcome_col) == 1),
        "POINT_DIFFERENTIAL": diff,
        "TOTAL_POINTS": F.col(home_pts) + F.col(away_pts),
        "MARGIN_OF_VICTORY": F.abs(diff),
    })


def clean_teams(teams: DataFrame, city_col: str = "CITY", founded_col: str = "YEARFOUNDED",
                nickname_col: str = "NICKNAME") -> DataFrame:
    """Upper-case names, CITY -> 'Unknown', YEARFOUNDED -> its median,
    FULL_NAME = CITY + ' ' + NICKNAME (NULL if a part is NULL)."""
    t = upper_columns(teams)
    fills = {city_col: "Unknown"}
    if founded_col in t.columns:
        med = exact_quantiles(t, [founded_col], [0.5])[founded_col][0]
        if med is not None:
            fills[founded_col] = med
    t = t.fillna(fills)
    return t.withColumn("FULL_NAME", concat_null(F.col(city_col), F.lit(" "), F.col(nickname_col)))


def clean_details(details: DataFrame) -> DataFrame:
    """Player lines: numeric NULLs -> 0, column names upper-cased."""
    return upper_columns(details.fillna(0, subset=numeric_columns(details)))


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """One row: NULL count per column (single pass)."""
    cols = list(cols or df.columns)
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])


def impute_median_mode(df: DataFrame) -> DataFrame:
    """Fill NULLs of numeric columns with their exact median and of string
    columns with their mode (smallest value on ties), only in columns that
    hold a NULL.  Booleans are not numeric and stay as they are.

    The medians' first pass (sketches) counts the NULLs of the numeric
    columns too; only columns that hold one are followed further.
    """
    fills = {c: q[0] for c, q in exact_quantiles(df, numeric_columns(df), [0.5], if_null=True).items()}
    strs = string_columns(df)
    if strs:
        counts = null_counts(df, strs).first()
        fills |= {c: mode(df, c) for c in strs if counts[c] > 0}
    fills = {c: v for c, v in fills.items() if v is not None}
    return df.fillna(fills) if fills else df
