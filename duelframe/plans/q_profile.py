"""Profiling, EDA tables and quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from duelframe.functions.columns import round_even
from duelframe.operators import contest, profile, quality, reports
from duelframe.plans.base import DERIVED_DOUBLES, GAME_DOUBLES, TF_FEATURES, Stages, round_doubles, sql_with
from duelframe.plans.registry import query

# numeric columns of the validated games, in schema order
GV_NUMERIC = (["GAME_ID", "SEASON", "HOME_TEAM_ID", "VISITOR_TEAM_ID"] + GAME_DOUBLES
              + ["YEAR", "MONTH", "DAY_OF_WEEK"] + DERIVED_DOUBLES)
GC_ALL = (["GAME_ID", "GAME_DATE_EST", "SEASON", "HOME_TEAM_ID", "VISITOR_TEAM_ID"] + GAME_DOUBLES
          + ["HOME_TEAM_WINS", "YEAR", "MONTH", "DAY_OF_WEEK"] + DERIVED_DOUBLES)


def _union(parts):
    return "\nUNION ALL\n".join(parts)


_DESCRIBE_SQL = _union([
    f"SELECT '{c}' AS COLUMN, {i} AS POS, count({c}) AS COUNT, round_even(avg({c}), 6) AS MEAN, "
    f"round_even(stddev_samp({c}), 6) AS STD, round_even(CAST(min({c}) AS DOUBLE), 6) AS MIN, "
    f"round_even(CAST(quantile_cont({c}, 0.25) AS DOUBLE), 6) AS Q25, "
    f"round_even(CAST(quantile_cont({c}, 0.5) AS DOUBLE), 6) AS Q50, "
    f"round_even(CAST(quantile_cont({c}, 0.75) AS DOUBLE), 6) AS Q75, "
    f"round_even(CAST(max({c}) AS DOUBLE), 6) AS MAX FROM gv"
    for i, c in enumerate(GV_NUMERIC)])


@query("describe_games", "A10", sql=sql_with(_DESCRIBE_SQL, upto="gv"))
def describe_games(spark, sf_dir):
    """count/mean/std/min/exact quartiles/max of every numeric games column."""
    return round_doubles(profile.describe(Stages(spark, sf_dir).games_validated, GV_NUMERIC))


@query("distinct_counts_games", "A11 U2", sql=sql_with(_union([
    f"SELECT '{c}' AS COLUMN, {i} AS POS, count(DISTINCT {c}) AS N_DISTINCT FROM gc"
    for i, c in enumerate(GC_ALL)]), upto="gc"))
def distinct_counts_games(spark, sf_dir):
    """Distinct non-NULL values of every games column (``nunique``)."""
    return profile.distinct_counts(Stages(spark, sf_dir).games_cleaned, GC_ALL)


_NULL_SQL = _union([
    f"SELECT '{c}' AS COLUMN, {i} AS POS, count_if({c} IS NULL) AS NULLS, "
    f"round_even(count_if({c} IS NULL) * 100.0 / count(*), 6) AS MISSING_PCT FROM gc"
    for i, c in enumerate(GC_ALL)])


@query("null_profile_games", "A13 C1", sql=sql_with(_NULL_SQL, upto="gc"))
def null_profile_games(spark, sf_dir):
    """NULL count and missing % of every column of the cleaned games."""
    return round_doubles(profile.null_profile(Stages(spark, sf_dir).games_cleaned, GC_ALL))


@query("columns_with_missing", "F6", sql=sql_with(
    f"SELECT * FROM ({_NULL_SQL}) WHERE NULLS > 0", upto="gc"))
def columns_with_missing(spark, sf_dir):
    """Columns with a missing share above 0, sorted by share."""
    return round_doubles(profile.columns_with_missing(Stages(spark, sf_dir).games_cleaned, GC_ALL))


_CORR_COLS = GAME_DOUBLES + DERIVED_DOUBLES + ["SEASON"]


def _corr_sql():
    parts = []
    for i, a in enumerate(_CORR_COLS):
        for j, b in enumerate(_CORR_COLS):
            parts.append(f"SELECT '{a}' AS A, '{b}' AS B, round_even(corr({a}, {b}), 4) AS CORR FROM gv")
    return _union(parts)


@query("correlation_matrix_games", "A14", sql=sql_with(_corr_sql(), upto="gv"))
def correlation_matrix_games(spark, sf_dir):
    """Pearson correlation of every pair of numeric games columns (long form)."""
    out = profile.correlation_long(Stages(spark, sf_dir, _CORR_COLS).games_validated, _CORR_COLS)
    return out.withColumn("CORR", round_even("CORR", 4))


_TC_COLS = GAME_DOUBLES + ["YEAR", "MONTH", "DAY_OF_WEEK", "SEASON"]


@query("target_correlation_top10", "A15", sql=sql_with(
    "SELECT \"COLUMN\", CORR, ABS_CORR FROM (" + _union([
        f"SELECT '{c}' AS COLUMN, round_even(corr({c}, CAST(HOME_TEAM_WINS AS INT)), 4) AS CORR, "
        f"round_even(abs(corr({c}, CAST(HOME_TEAM_WINS AS INT))), 4) AS ABS_CORR FROM gv"
        for c in _TC_COLS]) + ") ORDER BY ABS_CORR DESC, \"COLUMN\" LIMIT 10", upto="gv"))
def target_correlation_top10(spark, sf_dir):
    """Ten columns most correlated (absolute) with the home-win outcome."""
    out = profile.target_correlation_top(Stages(spark, sf_dir).games_validated, _TC_COLS,
                                         F.col("HOME_TEAM_WINS").cast("int"))
    return out.withColumns({"CORR": round_even("CORR", 4), "ABS_CORR": round_even("ABS_CORR", 4)})


def _hist_sql(col, bins):
    return f"""
SELECT BIN, round_even(lo + BIN * w, 6) AS LOWER, round_even(lo + (BIN + 1) * w, 6) AS UPPER, count(*) AS COUNT
FROM (SELECT CAST(least(floor(({col} - lo) / (hi - lo) * {bins}), {bins - 1}) AS INT) AS BIN, lo, w
      FROM gv, (SELECT min({col}) AS lo, max({col}) AS hi, (max({col}) - min({col})) / {bins} AS w FROM gv) m
      WHERE {col} IS NOT NULL)
GROUP BY BIN, lo, w"""


@query("histogram_point_differential", "A16", sql=sql_with(_hist_sql("POINT_DIFFERENTIAL", 50), upto="gv"))
def histogram_point_differential(spark, sf_dir):
    """50-bin fixed-width histogram of the point differential."""
    return round_doubles(profile.histogram(Stages(spark, sf_dir, ["POINT_DIFFERENTIAL"]).games_validated, "POINT_DIFFERENTIAL", 50))


@query("histogram_pts_home", "A16", sql=sql_with(_hist_sql("PTS_home", 30), upto="gv"))
def histogram_pts_home(spark, sf_dir):
    """30-bin fixed-width histogram of home points."""
    return round_doubles(profile.histogram(Stages(spark, sf_dir, ["PTS_home"]).games_validated, "PTS_home", 30))


_KDE_SQL = """
SELECT POINT, round_even(X, 6) AS X, round_even(sum(exp(-0.5 * pow((X - v) / h, 2))) / (n * h * sqrt(2 * pi())), 6) AS DENSITY
FROM (SELECT g.i AS POINT, s.lo - 3 * s.h + (s.hi - s.lo + 6 * s.h) * g.i / 199 AS X, s.h, s.n
      FROM range(200) g(i), (SELECT count(PTS_home) AS n, stddev_samp(PTS_home) * pow(count(PTS_home), -0.2) AS h,
                              min(PTS_home) AS lo, max(PTS_home) AS hi FROM gv) s) grid,
     (SELECT PTS_home AS v FROM gv WHERE PTS_home IS NOT NULL) d
GROUP BY POINT, X, h, n
"""


@query("kde_pts_home", "A17", sql=sql_with(_KDE_SQL, upto="gv"))
def kde_pts_home(spark, sf_dir):
    """Gaussian kernel density of home points on a 200-point grid."""
    return round_doubles(profile.kde_grid(Stages(spark, sf_dir, ["PTS_home"]).games_validated, "PTS_home"))


@query("box_stats_point_differential", "A19 Z4", sql=sql_with("""
SELECT q1 AS Q1, med AS MEDIAN, q3 AS Q3, q3 - q1 AS IQR, q1 - 1.5 * (q3 - q1) AS LOWER_FENCE,
       q3 + 1.5 * (q3 - q1) AS UPPER_FENCE,
       (SELECT count_if(POINT_DIFFERENTIAL < q1 - 1.5 * (q3 - q1)) FROM gv) AS N_LOW,
       (SELECT count_if(POINT_DIFFERENTIAL > q3 + 1.5 * (q3 - q1)) FROM gv) AS N_HIGH
FROM (SELECT quantile_cont(POINT_DIFFERENTIAL, 0.25) AS q1, quantile_cont(POINT_DIFFERENTIAL, 0.5) AS med,
             quantile_cont(POINT_DIFFERENTIAL, 0.75) AS q3 FROM gv)""", upto="gv"))
def box_stats_point_differential(spark, sf_dir):
    """Quartiles, 1.5 IQR fences and outlier counts of the differential."""
    return round_doubles(profile.box_stats(Stages(spark, sf_dir, ["POINT_DIFFERENTIAL"]).games_validated, "POINT_DIFFERENTIAL"))


@query("zscore_outliers_total_points", "Z4", sql=sql_with("""
SELECT GAME_ID, round_even(TOTAL_POINTS, 6) AS TOTAL_POINTS FROM gv
WHERE abs(TOTAL_POINTS - (SELECT avg(TOTAL_POINTS) FROM gv)) / (SELECT stddev_samp(TOTAL_POINTS) FROM gv) > 4.0
""", upto="gv"))
def zscore_outliers_total_points(spark, sf_dir):
    """Games whose total points lie more than 4 sample std (configured z) from the mean."""
    out = profile.zscore_outliers(Stages(spark, sf_dir).games_validated, "TOTAL_POINTS", 4.0)
    return round_doubles(out.select("GAME_ID", "TOTAL_POINTS"))


@query("season_counts", "A18 A12", sql=sql_with(
    "SELECT SEASON AS VALUE, count(*) AS COUNT FROM gv GROUP BY SEASON", upto="gv"))
def season_counts(spark, sf_dir):
    """Games per season (countplot data)."""
    return profile.value_counts(Stages(spark, sf_dir, ["SEASON"]).games_validated, "SEASON")


@query("home_win_share_by_season", "A4 P23", sql=sql_with(
    "SELECT SEASON, round_even(avg(CAST(HOME_TEAM_WINS AS DOUBLE)) * 100, 6) AS HOME_WIN_PCT FROM gv GROUP BY SEASON",
    upto="gv"))
def home_win_share_by_season(spark, sf_dir):
    """Home-win percentage per season."""
    return round_doubles(reports.share_by(Stages(spark, sf_dir, ["SEASON", "HOME_TEAM_WINS"]).games_validated, "SEASON", "HOME_TEAM_WINS",
                                          "HOME_WIN_PCT"))


_TV_COLS = [c for c in TF_FEATURES]


@query("top_variance_team_features", "A20", sql=sql_with(
    "SELECT * FROM (" + _union([
        f"SELECT '{c}' AS COLUMN, {i} AS POS, round_even(var_samp({c}), 6) AS VARIANCE FROM tf"
        for i, c in enumerate(_TV_COLS)]) + ") ORDER BY VARIANCE DESC, POS LIMIT 5", upto="tf"))
def top_variance_team_features(spark, sf_dir):
    """The five team-season features with the largest sample variance."""
    return round_doubles(profile.top_variance(Stages(spark, sf_dir, contest.SIDE_COLUMNS).team_features, _TV_COLS))


def _nulls_sql(table, cols):
    return "(SELECT " + " + ".join(f"count_if({c} IS NULL)" for c in cols) + f" FROM {table})"


def validation_sql():
    from duelframe.plans.base import GL_SQL  # noqa: F401
    gv_cols = GC_ALL
    tf_cols = ["TEAM_ID", "SEASON"] + TF_FEATURES + ["NICKNAME", "CITY"]
    gl_cols = gv_cols + [f"{s}_HIST_{c}" for s in ("HOME", "AWAY") for c in TF_FEATURES] + ["PTS_DIFF_HIST", "WIN_PCT_DIFF"]
    ng, nt, nf = _nulls_sql("gv", gv_cols), _nulls_sql("tf", tf_cols), _nulls_sql("gl", gl_cols)
    rows = [
        ("no_missing_games", f"CAST({ng} = 0 AS BIGINT)"),
        ("no_missing_team_features", f"CAST({nt} = 0 AS BIGINT)"),
        ("no_missing_game_features", f"CAST({nf} = 0 AS BIGINT)"),
        ("games_not_empty", "CAST((SELECT count(*) FROM gv) > 0 AS BIGINT)"),
        ("team_features_not_empty", "CAST((SELECT count(*) FROM tf) > 0 AS BIGINT)"),
        ("game_features_not_empty", "CAST((SELECT count(*) FROM gl) > 0 AS BIGINT)"),
        ("correct_dtypes", "(SELECT CAST(typeof(GAME_DATE_EST) = 'DATE' AND typeof(SEASON) = 'INTEGER' AND "
                           "typeof(HOME_TEAM_WINS) = 'BOOLEAN' AS BIGINT) FROM gv LIMIT 1)"),
        ("essential_columns_exist", "(SELECT CAST(count(*) > 0 AS BIGINT) FROM (SELECT HOME_TEAM_ID, VISITOR_TEAM_ID, "
                                    "POINT_DIFFERENTIAL FROM gl LIMIT 1))"),
        ("summary.total_games", "(SELECT count(*) FROM gv)"),
        ("summary.total_teams", "(SELECT count(DISTINCT TEAM_ID) FROM tf)"),
        ("summary.total_features", f"CAST({len(gl_cols)} AS BIGINT)"),
        ("summary.validation_passed", f"CAST({ng} = 0 AND {nt} = 0 AND {nf} = 0 AND "
                                      "(SELECT count(*) FROM gv) > 0 AND (SELECT count(*) FROM tf) > 0 AS BIGINT)"),
    ]
    return _union([f"SELECT '{k}' AS \"CHECK\", {v} AS VALUE" for k, v in rows])


@query("validation_report", "Q0", sql=sql_with(validation_sql(), upto="gl"))
def validation_report(spark, sf_dir):
    """Eight 0/1 quality checks and the summary over the engineering outputs."""
    st = Stages(spark, sf_dir)
    return quality.validate(st.games_validated, st.team_features, st.game_features)
