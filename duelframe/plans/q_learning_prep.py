"""Model-input preparation: scaling, segment features, splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from duelframe.operators import cluster_features as cf
from duelframe.operators import contest, scaling, split
from duelframe.plans.base import TF_FEATURES, Stages, round_doubles, sql_with
from duelframe.plans.registry import query

_FILL = ", ".join(f"coalesce({c}, (SELECT median({c}) FROM tf)) AS {c}" for c in TF_FEATURES)
_STD = ", ".join(
    f"round_even(CASE WHEN (SELECT stddev_pop({c}) FROM filled) = 0 THEN 0.0 ELSE "
    f"({c} - (SELECT avg({c}) FROM filled)) / (SELECT stddev_pop({c}) FROM filled) END, 6) AS {c}"
    for c in TF_FEATURES)


def standardized_team_features(st: Stages):
    tf = scaling.median_fill(st.team_features, TF_FEATURES)
    return scaling.standardize(tf, TF_FEATURES).select("TEAM_ID", "SEASON", *TF_FEATURES)


@query("clustering_input", "K1 X1 C2 P11", sql=sql_with(
    f"SELECT TEAM_ID, SEASON, {_STD} FROM filled", upto="tf",
    extra=[("filled", f"SELECT TEAM_ID, SEASON, {_FILL} FROM tf")]))
def clustering_input(spark, sf_dir):
    """The 23 team-season features, NULLs filled by the median, standardised
    with the population std (constant column -> 0); keys kept."""
    return round_doubles(standardized_team_features(Stages(spark, sf_dir, contest.SIDE_COLUMNS)))


# Segments for the oracle-checked feature queries: team-seasons whose home
# win share is above the league mean (1) or not (0), a two-segment labelling
# computed from the data.  The K-means jobs feed the same operators with
# model labels.
SEGMENT_SQL = ("SELECT TEAM_ID, SEASON, CASE WHEN HOME_WIN_PCT > (SELECT avg(HOME_WIN_PCT) FROM tf) THEN 1 ELSE 0 END "
               "AS label FROM tf")


def edge_segments(st: Stages):
    mean = st.team_features.agg(F.avg("HOME_WIN_PCT")).first()[0]
    return st.team_features.select("TEAM_ID", "SEASON",
                                   F.when(F.col("HOME_WIN_PCT") > F.lit(mean), 1).otherwise(0).alias("label"))


@query("team_segment_map", "J11", sql=sql_with(
    "SELECT TEAM_ID, arg_max(label, SEASON) AS CLUSTER FROM seg GROUP BY TEAM_ID", upto="tf",
    extra=[("seg", SEGMENT_SQL)]))
def team_segment_map(spark, sf_dir):
    """Team -> segment of its latest season (last season wins)."""
    return cf.team_cluster_map(edge_segments(Stages(spark, sf_dir, contest.SIDE_COLUMNS)))


_NUM_TF = ["HOME_PTS_MEAN", "HOME_PTS_STD", "HOME_GAMES_COUNT", "HOME_FG_PCT", "HOME_FT_PCT", "HOME_FG3_PCT",
           "HOME_REB_MEAN", "HOME_AST_MEAN", "HOME_WIN_PCT", "HOME_PT_DIFF_MEAN", "AWAY_PTS_MEAN", "AWAY_PTS_STD",
           "AWAY_GAMES_COUNT", "AWAY_FG_PCT", "AWAY_FT_PCT", "AWAY_FG3_PCT", "AWAY_REB_MEAN", "AWAY_AST_MEAN",
           "AWAY_WIN_PCT", "AWAY_PT_DIFF_MEAN", "HOME_ADVANTAGE_PTS", "HOME_ADVANTAGE_WIN", "HOME_ADVANTAGE_REB"]

_LONG_SQL = ("SELECT TEAM_ID, SEASON, label, FEATURE, CAST(VALUE AS DOUBLE) AS VALUE, POS FROM ("
             + " UNION ALL ".join(f"SELECT t.TEAM_ID, t.SEASON, s.label, '{c}' AS FEATURE, t.{c} AS VALUE, {i} AS POS "
                                  f"FROM tf t JOIN seg s ON s.TEAM_ID = t.TEAM_ID AND s.SEASON = t.SEASON"
                                  for i, c in enumerate(_NUM_TF)) + ")")
_TOPVAR_SQL = ("SELECT FEATURE FROM (SELECT FEATURE, POS, var_samp(VALUE) AS v FROM long GROUP BY FEATURE, POS) "
               "ORDER BY v DESC NULLS LAST, POS LIMIT 5")
_STATS_LONG_SQL = ("SELECT label AS CLUSTER, FEATURE, avg(VALUE) AS MEAN, stddev_samp(VALUE) AS STD, "
                   "median(VALUE) AS MEDIAN FROM long WHERE label <> -1 AND FEATURE IN (SELECT FEATURE FROM topvar) "
                   "GROUP BY label, FEATURE")


@query("segment_cluster_statistics", "A21 A20", sql=sql_with(
    "SELECT CLUSTER, FEATURE, round_even(MEAN, 6) AS MEAN, round_even(STD, 6) AS STD, "
    "round_even(MEDIAN, 6) AS MEDIAN FROM stats_long", upto="tf",
    extra=[("seg", SEGMENT_SQL), ("long", _LONG_SQL), ("topvar", _TOPVAR_SQL), ("stats_long", _STATS_LONG_SQL)]))
def segment_cluster_statistics(spark, sf_dir):
    """Per segment: mean, sample std and median of the five team-season
    features with the largest variance (long form: one row per segment and
    feature)."""
    st = Stages(spark, sf_dir)
    wide = cf.cluster_statistics(st.team_features, edge_segments(st))
    feats = sorted({c.rsplit("_", 1)[0] for c in wide.columns if c != "CLUSTER"})
    structs = [F.struct(F.lit(f).alias("FEATURE"), F.col(f"{f}_MEAN").alias("MEAN"),
                        F.col(f"{f}_STD").alias("STD"), F.col(f"{f}_MEDIAN").cast("double").alias("MEDIAN"))
               for f in feats]
    return round_doubles(wide.select("CLUSTER", F.inline(F.array(*structs))))


def _stats_rows(keys: str, cluster: str, prefix: str, table: str) -> str:
    """Long rows of the cluster statistics of one side; unmatched clusters give 0."""
    return "\nUNION ALL\n".join(
        f"SELECT {keys}, '{prefix}' || t.FEATURE || '_{stat}' AS FEATURE, CAST(coalesce(s.{stat}, 0) AS DOUBLE) AS VALUE "
        f"FROM {table} p CROSS JOIN topvar t LEFT JOIN stats_long s ON s.CLUSTER = p.{cluster} AND s.FEATURE = t.FEATURE"
        for stat in ("MEAN", "STD", "MEDIAN"))


_SEGMENT_CTES = [("seg", SEGMENT_SQL), ("long", _LONG_SQL), ("topvar", _TOPVAR_SQL), ("stats_long", _STATS_LONG_SQL),
                 ("tmap", "SELECT TEAM_ID, arg_max(label, SEASON) AS CLUSTER FROM seg GROUP BY TEAM_ID")]
_CLS_NOT_NULL = " AND ".join(f"{c} IS NOT NULL" for c in [*contest.TEAM_IDS, *contest.CLASSIFICATION_FEATURES, "HOME_TEAM_WINS"])
_REG_NOT_NULL = " AND ".join(f"{c} IS NOT NULL" for c in [*contest.TEAM_IDS, *contest.REGRESSION_FEATURES,
                                                          *contest.REGRESSION_TARGETS.values()])


def _added_long(df, keys, added):
    """The added columns of a set as (keys, FEATURE, VALUE), one row a key and column."""
    entries = F.array(*[F.struct(F.lit(c).alias("FEATURE"), F.col(c).cast("double").alias("VALUE")) for c in added])
    return df.select(*keys, *added).distinct().select(*keys, F.inline(entries))


@query("segment_pair_features", "X2 X3 P17 J8 J9 C6 U3", sql=sql_with(f"""
SELECT HOME_TEAM_ID, VISITOR_TEAM_ID, FEATURE, round_even(VALUE, 6) AS VALUE FROM (
  SELECT HOME_TEAM_ID, VISITOR_TEAM_ID, 'HOME_CLUSTER_' || v.c AS FEATURE, CAST(hc = v.c AS DOUBLE) AS VALUE
  FROM pairs, (SELECT DISTINCT hc AS c FROM pairs) v
  UNION ALL SELECT HOME_TEAM_ID, VISITOR_TEAM_ID, 'AWAY_CLUSTER_' || v.c, CAST(ac = v.c AS DOUBLE)
  FROM pairs, (SELECT DISTINCT ac AS c FROM pairs) v
  UNION ALL SELECT HOME_TEAM_ID, VISITOR_TEAM_ID, 'SAME_CLUSTER', CAST(hc = ac AS DOUBLE) FROM pairs
  UNION ALL SELECT HOME_TEAM_ID, VISITOR_TEAM_ID, 'CLUSTER_DIFF', CAST(hc - ac AS DOUBLE) FROM pairs
  UNION ALL {_stats_rows('p.HOME_TEAM_ID, p.VISITOR_TEAM_ID', 'hc', 'HOME_CLUSTER_STATS_', 'pairs')}
  UNION ALL {_stats_rows('p.HOME_TEAM_ID, p.VISITOR_TEAM_ID', 'ac', 'AWAY_CLUSTER_STATS_', 'pairs')})
""", upto="gl", extra=[*_SEGMENT_CTES, ("pairs", f"""
SELECT DISTINCT HOME_TEAM_ID, VISITOR_TEAM_ID, coalesce(h.CLUSTER, -1) AS hc, coalesce(a.CLUSTER, -1) AS ac
FROM gl LEFT JOIN tmap h ON h.TEAM_ID = HOME_TEAM_ID LEFT JOIN tmap a ON a.TEAM_ID = VISITOR_TEAM_ID WHERE {_CLS_NOT_NULL}""")]))
def segment_pair_features(spark, sf_dir):
    """The segment features that the classification set gains, for every pair
    of sides: one-hots, SAME_CLUSTER, CLUSTER_DIFF and both sides' segment
    statistics, NULLs -> 0 (long form)."""
    st = Stages(spark, sf_dir)
    cls, _ = contest.model_inputs(st.game_features)
    out = cf.enhance_classification(cls, edge_segments(st), st.team_features)
    return round_doubles(_added_long(out, contest.TEAM_IDS, [c for c in out.columns if c not in cls.columns]))


@query("segment_team_features", "X4 X5 J8 J9 C6 U3", sql=sql_with(f"""
SELECT HOME_TEAM_ID, FEATURE, round_even(VALUE, 6) AS VALUE FROM (
  SELECT HOME_TEAM_ID, 'CLUSTER_' || v.c AS FEATURE, CAST(hc = v.c AS DOUBLE) AS VALUE FROM sides, (SELECT DISTINCT hc AS c FROM sides) v
  UNION ALL {_stats_rows('p.HOME_TEAM_ID', 'hc', 'CLUSTER_STATS_', 'sides')}
  UNION ALL SELECT HOME_TEAM_ID, 'IN_CLUSTER_' || v.c, CAST(hc = v.c AS DOUBLE)
  FROM sides, (SELECT DISTINCT CLUSTER AS c FROM tmap WHERE CLUSTER <> -1) v
  UNION ALL SELECT HOME_TEAM_ID, 'CLUSTER_DIST_' || v.c, sqrt(power(w.HOME_WIN_PCT - m.HOME_WIN_PCT, 2) + power(w.AWAY_WIN_PCT - m.AWAY_WIN_PCT, 2))
  FROM sides JOIN latest w ON w.TEAM_ID = HOME_TEAM_ID, (SELECT DISTINCT CLUSTER AS c FROM tmap WHERE CLUSTER <> -1) v
  JOIN means m ON m.label = v.c)
""", upto="gl", extra=[*_SEGMENT_CTES, ("sides", f"""
SELECT DISTINCT HOME_TEAM_ID, coalesce(h.CLUSTER, -1) AS hc FROM gl LEFT JOIN tmap h ON h.TEAM_ID = HOME_TEAM_ID WHERE {_REG_NOT_NULL}"""),
    ("latest", "SELECT TEAM_ID, arg_max(HOME_WIN_PCT, SEASON) AS HOME_WIN_PCT, arg_max(AWAY_WIN_PCT, SEASON) AS AWAY_WIN_PCT FROM tf GROUP BY TEAM_ID"),
    ("means", "SELECT s.label, avg(t.HOME_WIN_PCT) AS HOME_WIN_PCT, avg(t.AWAY_WIN_PCT) AS AWAY_WIN_PCT FROM tf t "
              "JOIN seg s ON s.TEAM_ID = t.TEAM_ID AND s.SEASON = t.SEASON GROUP BY s.label")]))
def segment_team_features(spark, sf_dir):
    """The segment features that the regression set gains, for every home
    side: one-hots, statistics, IN_CLUSTER flags, and distances from the
    side's latest win shares to each segment's mean (long form)."""
    st = Stages(spark, sf_dir)
    _, reg = contest.model_inputs(st.game_features)
    labels = edge_segments(st)
    distance = cf.centroid_distances(st.team_features, labels, ["HOME_WIN_PCT", "AWAY_WIN_PCT"])
    out = cf.enhance_regression(reg, labels, st.team_features, real_distance=distance)
    return round_doubles(_added_long(out, ["HOME_TEAM_ID"], [c for c in out.columns if c not in reg.columns]))


@query("segment_enhanced_classification", "X2 X3 P17 J8 J9 C6 U3")
def segment_enhanced_classification(spark, sf_dir):
    """Classification set plus segment one-hots for both sides, SAME_CLUSTER,
    CLUSTER_DIFF and both sides' segment statistics; NULLs -> 0."""
    st = Stages(spark, sf_dir)
    cls, _ = contest.model_inputs(st.game_features)
    return round_doubles(cf.enhance_classification(cls, edge_segments(st), st.team_features))


@query("segment_enhanced_regression", "X4 X5 J8 J9 C6 U3")
def segment_enhanced_regression(spark, sf_dir):
    """Regression set plus the home side's segment one-hots, statistics,
    IN_CLUSTER flags and (parity) CLUSTER_DIST columns; NULLs -> 0."""
    st = Stages(spark, sf_dir)
    _, reg = contest.model_inputs(st.game_features)
    return round_doubles(cf.enhance_regression(reg, edge_segments(st), st.team_features))


_SAMPLE_COLS = ["GAME_ID", *contest.TEAM_IDS, *contest.REGRESSION_FEATURES, *contest.REGRESSION_TARGETS.values()]
_ROUNDED = [c for c in _SAMPLE_COLS if c not in ("GAME_ID", *contest.TEAM_IDS, "YEAR", "MONTH")]


@query("regression_sample_10000", "M1", sql=sql_with(
    "SELECT " + ", ".join(f"round_even({c}, 6) AS {c}" if c in _ROUNDED else c for c in _SAMPLE_COLS)
    + f" FROM gl WHERE {_REG_NOT_NULL} ORDER BY {split.unit_hash_sql(['GAME_ID'], 42, 'sample')}, GAME_ID LIMIT 10000"))
def regression_sample_10000(spark, sf_dir):
    """Exactly min(10000, n) regression rows chosen by key hash (seed 42)."""
    reg = Stages(spark, sf_dir).game_features.select(*_SAMPLE_COLS).dropna()
    return round_doubles(split.sample_n(reg, 10000, ["GAME_ID"], 42))


_BY_CLASS = ["GAME_ID", "CAST(HOME_TEAM_WINS AS INT)"]


@query("stratified_split_sizes", "M2 M4", sql=sql_with(f"""
SELECT CAST(HOME_TEAM_WINS AS INT) AS label,
       CASE WHEN {split.unit_hash_sql(_BY_CLASS, 42, 'split')} < 0.2 THEN 'test'
            ELSE 'train_fold_' || CAST(floor({split.unit_hash_sql(_BY_CLASS, 42, 'fold')} * 5) AS INT) END AS PART, count(*) AS count
FROM gl GROUP BY ALL"""))
def stratified_split_sizes(spark, sf_dir):
    """Train/test sizes and fold sizes per class of a class-salted hash split
    (test share 0.2, 5 folds) of the classification set."""
    st = Stages(spark, sf_dir)
    data = st.game_features.select("GAME_ID", F.col("HOME_TEAM_WINS").cast("int").alias("label"))
    train, test = split.split_frac(data, ["GAME_ID"], 0.2, 42, label="label")
    tr = split.fold_ids(train, ["GAME_ID"], 5, 42, label="label")
    a = tr.groupBy("label", F.concat(F.lit("train_fold_"), F.col("FOLD").cast("string")).alias("PART")).count()
    b = test.groupBy("label", F.lit("test").alias("PART")).count()
    return a.unionByName(b)


@query("random_split_sizes", "M3", sql=sql_with(f"""
SELECT CASE WHEN {split.unit_hash_sql(['GAME_ID'], 42, 'split')} < 0.2 THEN 'test' ELSE 'train' END AS PART, count(*) AS N
FROM gl GROUP BY ALL"""))
def random_split_sizes(spark, sf_dir):
    """Train/test sizes of the plain 80/20 key-hash split of the regression set."""
    data = Stages(spark, sf_dir).game_features.select("GAME_ID")
    train, test = split.split_frac(data, ["GAME_ID"], 0.2, 42)
    return train.agg(F.count(F.lit(1)).alias("N")).withColumn("PART", F.lit("train")).unionByName(
        test.agg(F.count(F.lit(1)).alias("N")).withColumn("PART", F.lit("test")))


@query("classification_target", "L0 F1", sql=sql_with(f"""
SELECT CAST(HOME_TEAM_WINS AS INT) AS label, count(*) AS N, {len(contest.TEAM_IDS) + len(contest.CLASSIFICATION_FEATURES)} AS FEATURES
FROM gl WHERE {_CLS_NOT_NULL} GROUP BY ALL"""))
def classification_target(spark, sf_dir):
    """Rows per class of the prepared classification set and its number of
    features, after the required-column check and the target's separation."""
    cls, _ = contest.model_inputs(Stages(spark, sf_dir).game_features)
    missing = [c for c in (*contest.TEAM_IDS, *contest.CLASSIFICATION_FEATURES, "HOME_TEAM_WINS") if c not in cls.columns]
    if missing:
        raise KeyError(f"required columns missing: {missing}")
    features = [c for c in cls.columns if c != "HOME_TEAM_WINS"]
    return cls.groupBy(F.col("HOME_TEAM_WINS").cast("int").alias("label")).agg(
        F.count(F.lit(1)).alias("N"), F.any_value(F.lit(len(features))).alias("FEATURES"))
