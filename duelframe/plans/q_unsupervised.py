"""Clustering, metrics, PCA and interpretation queries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from duelframe.functions.columns import round_even
from duelframe.operators import cluster, contest, density
from duelframe.plans.base import TF_FEATURES, Stages, round_doubles, sql_with
from duelframe.plans.q_learning_prep import SEGMENT_SQL, edge_segments, standardized_team_features
from duelframe.plans.registry import query
from duelframe.session import materialise, materialise_spread

EMB_DIM = 64  # fixed value: width of the driver's embedding vectors


def embedding_points(spark, sf_dir):
    """Embeddings as (vec_id, label, e0..e63) doubles."""
    e = Stages(spark, sf_dir).c.table("embeddings")
    return e.select("vec_id", "label", *[F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(EMB_DIM)])


def _emb_metrics_sql(label: str = "label") -> str:
    return _EMB_METRICS.replace("@LABEL@", label)


_EMB_METRICS = """
WITH emb AS (SELECT vec_id, CAST(@LABEL@ AS INT) AS label, embedding FROM embeddings),
     pts AS (SELECT vec_id, label, CAST(unnest(embedding) AS DOUBLE) AS x, generate_subscripts(embedding, 1) AS j
             FROM emb),
     px AS (SELECT vec_id, label, sum(x * x) AS x2 FROM pts GROUP BY vec_id, label),
     cent AS (SELECT label, j, avg(x) AS mu FROM pts GROUP BY label, j),
     cl AS (SELECT label, count(*) AS n, avg(x2) AS msq FROM px GROUP BY label),
     dots AS (SELECT p.vec_id, c.label AS other, sum(p.x * c.mu) AS dot FROM pts p JOIN cent c ON p.j = c.j
              GROUP BY p.vec_id, c.label),
     md AS (SELECT d.vec_id, px.label AS own, d.other, px.x2 - 2 * d.dot + cl.msq AS m, cl.n
            FROM dots d JOIN px ON px.vec_id = d.vec_id JOIN cl ON cl.label = d.other),
     sil AS (SELECT vec_id, max(CASE WHEN own = other AND n > 1 THEN m * n / (n - 1) END) AS a,
                    min(CASE WHEN own <> other THEN m END) AS b FROM md GROUP BY vec_id),
     ev AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM emb),
     pair AS (SELECT a.vec_id, a.label AS own, b.label AS other, sum(list_distance(a.x, b.x)) AS s, count(*) AS n FROM ev a, ev b GROUP BY ALL),
     eucl AS (SELECT vec_id, max(CASE WHEN own = other AND n > 1 THEN s / (n - 1) END) AS a,
                     min(CASE WHEN own <> other THEN s / n END) AS b FROM pair GROUP BY vec_id),
     gmu AS (SELECT j, avg(x) AS g FROM pts GROUP BY j),
     between_ss AS (SELECT sum(cl.n * s) AS bss FROM (SELECT label, sum((mu - g) * (mu - g)) AS s FROM cent JOIN gmu USING (j)
                    GROUP BY label) t JOIN cl USING (label)),
     within_ss AS (SELECT sum(power(p.x - c.mu, 2)) AS wss FROM pts p JOIN cent c ON c.label = p.label AND c.j = p.j),
     spread AS (SELECT label, avg(d) AS s FROM (SELECT p.vec_id, p.label, sqrt(sum(power(p.x - c.mu, 2))) AS d
                FROM pts p JOIN cent c ON c.label = p.label AND c.j = p.j GROUP BY p.vec_id, p.label) GROUP BY label),
     cdist AS (SELECT a.label AS l1, b.label AS l2, sqrt(sum(power(a.mu - b.mu, 2))) AS m
               FROM cent a JOIN cent b ON a.j = b.j AND a.label <> b.label GROUP BY a.label, b.label),
     db AS (SELECT avg(w) AS dbi FROM (SELECT l1, max((s1.s + s2.s) / m) AS w FROM cdist
            JOIN spread s1 ON s1.label = l1 JOIN spread s2 ON s2.label = l2 GROUP BY l1))
SELECT CAST((SELECT count(*) FROM cl WHERE label <> -1) AS INT) AS N_CLUSTERS,
       CAST((SELECT count(*) FROM emb WHERE label = -1) AS INT) AS N_NOISE,
       round_even((SELECT avg(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END) FROM eucl), 4) AS SILHOUETTE,
       round_even((SELECT avg(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END) FROM sil), 4) AS SILHOUETTE_SQUARED,
       round_even((SELECT bss FROM between_ss) * ((SELECT count(*) FROM emb) - (SELECT count(*) FROM cl))
                  / ((SELECT wss FROM within_ss) * ((SELECT count(*) FROM cl) - 1)), 4) AS CALINSKI_HARABASZ,
       round_even((SELECT dbi FROM db), 4) AS DAVIES_BOULDIN
"""


@query("cluster_metrics_embeddings", "E1 E2 E3 A26 F5", sql=_emb_metrics_sql())
def cluster_metrics_embeddings(spark, sf_dir):
    """Silhouette (Euclidean over all pairs, and squared), Calinski-Harabasz and
    Davies-Bouldin of the labelled embedding vectors, with cluster and noise counts."""
    m = cluster.evaluate(materialise_spread(embedding_points(spark, sf_dir), "embeddings"), [f"e{i}" for i in range(EMB_DIM)], "label")
    scores = ("SILHOUETTE", "SILHOUETTE_SQUARED", "CALINSKI_HARABASZ", "DAVIES_BOULDIN")
    row = [(m["N_CLUSTERS"], m["N_NOISE"], *(None if m[k] is None else float(m[k]) for k in scores))]
    return round_doubles(spark.createDataFrame(row, "N_CLUSTERS int, N_NOISE int, " + ", ".join(f"{c} double" for c in scores)), 4)


# fixed values: labellings of the embeddings that the selection is checked on
LABELLINGS = [("given", "label"), ("halves", "label % 2"), ("one", "0"), ("thirds", "label % 3")]


@query("labelling_selection", "K8 F7 T7 A26", sql=f"""
WITH e AS ({" UNION ALL ".join(f"SELECT '{name}' AS LABELLING, {i} AS ORDINAL, * FROM ({_emb_metrics_sql(expr)})" for i, (name, expr) in enumerate(LABELLINGS))})
SELECT LABELLING, ORDINAL, N_CLUSTERS, CASE WHEN N_CLUSTERS >= 2 THEN SILHOUETTE END AS SILHOUETTE,
       coalesce((SELECT LABELLING FROM e WHERE N_CLUSTERS >= 2 AND SILHOUETTE IS NOT NULL ORDER BY SILHOUETTE DESC, ORDINAL LIMIT 1), 'given')
       AS BEST_LABELLING FROM e""")
def labelling_selection(spark, sf_dir):
    """Four labellings of the embeddings compared by silhouette; those with
    fewer than two clusters are no candidates; best one named in every row."""
    cols = [f"e{j}" for j in range(EMB_DIM)]
    pts = embedding_points(spark, sf_dir)
    pts = materialise_spread(pts.select("vec_id", *cols, *[F.expr(expr).cast("int").alias(name) for name, expr in LABELLINGS]), "labelled")
    # distances are by far the largest part: one pass over the pairs serves all labellings
    known = cluster.silhouettes(pts, cols, [name for name, _ in LABELLINGS])
    rows = []
    for i, (name, _) in enumerate(LABELLINGS):
        m = cluster.evaluate(pts, cols, name, known)
        rows.append((name, i, m["N_CLUSTERS"], m["SILHOUETTE"]))
    t = spark.createDataFrame(rows, "LABELLING string, ORDINAL int, N_CLUSTERS int, SILHOUETTE double")
    return cluster.best_valid(round_doubles(t, 4), "LABELLING", "given")


_BINNED_COSTS = " UNION ALL ".join(
    f"SELECT {k} AS K, CAST(sum(s) AS DOUBLE) AS COST FROM (SELECT sum(x * x) - sum(x) * sum(x) / count(*) AS s "
    f"FROM (SELECT POINT_DIFFERENTIAL AS x FROM gv) GROUP BY least(floor((x + 200) / 400 * {k}), {k - 1}))" for k in range(1, 11))


@query("elbow_of_binned_costs", "W1 K2", sql=sql_with("""
WITH d AS (SELECT *, lag(COST) OVER (ORDER BY K) - COST AS DROP FROM costs),
     c AS (SELECT *, CASE WHEN K < 10 THEN lag(DROP) OVER (ORDER BY K) - DROP END AS CURVATURE FROM d)
SELECT K, round_even(COST, 3) AS COST, round_even(DROP, 3) AS DROP, round_even(CURVATURE, 3) AS CURVATURE,
       CAST(coalesce((SELECT K - 1 FROM c WHERE CURVATURE IS NOT NULL ORDER BY CURVATURE DESC, K LIMIT 1), 3) AS INT) AS SUGGESTED_K
FROM c""", upto="gv", extra=[("costs", _BINNED_COSTS)]))
def elbow_of_binned_costs(spark, sf_dir):
    """Elbow over a cost curve without a fit: within-bin sums of squares of the
    point differential for 1 to 10 equal bins of [-200, 200]; drops, second
    differences and the suggested k."""
    x = Stages(spark, sf_dir, contest.SIDE_COLUMNS).games_validated.select(F.col("POINT_DIFFERENTIAL").alias("x"))
    bins = F.array(*[F.struct(F.lit(k).alias("K"), F.least(F.floor((F.col("x") + 200) / 400 * k), F.lit(k - 1)).alias("b"))
                     for k in range(1, 11)])
    per = x.select("x", F.inline(bins)).groupBy("K", "b").agg(
        (F.sum(F.col("x") * F.col("x")) - F.sum("x") * F.sum("x") / F.count(F.lit(1))).alias("s"))
    return round_doubles(cluster.elbow_choice(per.groupBy("K").agg(F.sum("s").alias("COST"))), 3)


@query("variance_shares", "W2 A20", sql=sql_with(
    "SELECT PC, FEATURE, round_even(v / sum(v) OVER (), 6) AS VARIANCE_SHARE, "
    "round_even(sum(v) OVER (ORDER BY PC) / sum(v) OVER (), 6) AS CUMULATIVE FROM ("
    "SELECT CAST(row_number() OVER (ORDER BY v DESC, i) AS INT) AS PC, FEATURE, v FROM ("
    + " UNION ALL ".join(f"SELECT '{c}' AS FEATURE, {i} AS i, var_samp({c}) AS v FROM tf" for i, c in enumerate(TF_FEATURES)) + "))",
    upto="tf"))
def variance_shares(spark, sf_dir):
    """Team-season features by their share of the total variance, with the
    running sum that principal components use too."""
    from duelframe.operators import profile
    top = profile.top_variance(Stages(spark, sf_dir, contest.SIDE_COLUMNS).team_features, TF_FEATURES, len(TF_FEATURES))
    place = F.row_number().over(W.orderBy(F.col("VARIANCE").desc(), "POS"))          # one row a feature
    total = F.sum("VARIANCE").over(W.partitionBy(F.lit(0)))
    shares = top.select(place.alias("PC"), F.col("COLUMN").alias("FEATURE"), (F.col("VARIANCE") / total).alias("VARIANCE_SHARE"))
    return round_doubles(cluster.running_share(shares))


@query("kmeans_k_selection", "K2 K3 W1")
def kmeans_k_selection(spark, sf_dir):
    """Elbow (cost for k = 1..10, drops, second differences, suggested k)
    and Euclidean silhouette for k = 2..10 on the team-season clustering
    input."""
    st = Stages(spark, sf_dir, contest.SIDE_COLUMNS)
    data = clustering_table(st)
    cols = TF_FEATURES
    costs, sils = [(1, cluster.total_sum_of_squares(data, cols))], {}
    for k, (cost, centres) in cluster.kmeans_grid(data, cols, range(2, 11)).items():
        costs.append((k, cost))
        lab = cluster.nearest_centres(data, cols, centres)
        sils[k] = cluster.silhouette(data.join(lab, ["TEAM_ID", "SEASON"]), cols)
    rows = [(k, c, sils.get(k)) for k, c in costs]
    t = spark.createDataFrame(rows, "K int, COST double, SILHOUETTE double")
    out = cluster.elbow_choice(t)
    every = W.orderBy("K").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    out = out.withColumn("BEST_K_SILHOUETTE", F.max_by("K", F.struct("SILHOUETTE", -F.col("K"))).over(every))
    return round_doubles(out)


def elbow_fits(st, data) -> tuple[int, dict]:
    """The elbow's k for k = 1..10 (k = 1 in closed form), and the fits for k = 2..10."""
    fits = cluster.kmeans_grid(data, TF_FEATURES, range(2, 11))
    costs = [(1, cluster.total_sum_of_squares(data, TF_FEATURES)), *((k, cost) for k, (cost, _) in fits.items())]
    return int(cluster.elbow_choice(st.spark.createDataFrame(costs, "K int, COST double")).first()["SUGGESTED_K"]), fits


def clustering_table(st):
    """The standardised team-season features, written once for the many fits."""
    return materialise(standardized_team_features(st), "clustering_input")


def kmeans_segments(st, data=None, k: int | None = None):
    """(TEAM_ID, SEASON, label) by K-means, k from the elbow unless given."""
    data = clustering_table(st) if data is None else data
    if k is None:
        k, fits = elbow_fits(st, data)
        labels = cluster.nearest_centres(data, TF_FEATURES, fits[k][1])
    else:
        labels, _ = cluster.kmeans_labels(data, TF_FEATURES, k)
    return materialise(labels, "kmeans_segments")


def segmentations(st, k: int | None = None):
    """Labels of K-means, DBSCAN (eps 0.5, 5 rows), Ward agglomeration and PCA + K-means."""
    data = clustering_table(st)
    cols = TF_FEATURES
    k = elbow_fits(st, data)[0] if k is None else k
    km = kmeans_segments(st, data, k)
    db = density.dbscan(data, cols, ["TEAM_ID", "SEASON"], 0.5, 5).drop("IS_CORE")
    ward = cluster.ward_labels(data, cols, k)
    p = cluster.pca(data, cols, len(cols))
    m = cluster.components_for_share(p.variance, 0.95)
    pcs = [f"PC_{i + 1}" for i in range(m)]
    pk, _ = cluster.kmeans_labels(p.scores, pcs, k)
    return data, {"kmeans": km, "dbscan": db, "agglo": ward, "pca_kmeans": pk}, k


@query("segmentation_evaluation", "K4 K5 K6 K7 K8 F5 F7 T7 A26")
def segmentation_evaluation(spark, sf_dir):
    """K-means, DBSCAN, Ward agglomeration and PCA(95 %) + K-means (k from the
    elbow): cluster and noise counts, Euclidean silhouette, Calinski-Harabasz,
    Davies-Bouldin and the best algorithm by silhouette (ties: declared order)."""
    st = Stages(spark, sf_dir, contest.SIDE_COLUMNS)
    data, labs, k = segmentations(st)
    rows = []
    for i, (name, lab) in enumerate(labs.items()):
        pts = materialise(data.join(lab, ["TEAM_ID", "SEASON"]), "segmented")
        m = cluster.evaluate(pts, TF_FEATURES)
        rows.append((name, i, k, m["N_CLUSTERS"], m["N_NOISE"], m["SILHOUETTE"], m["CALINSKI_HARABASZ"],
                     m["DAVIES_BOULDIN"]))
    t = spark.createDataFrame(rows, "ALGORITHM string, ORDINAL int, K int, N_CLUSTERS int, N_NOISE int, "
                                    "SILHOUETTE double, CALINSKI_HARABASZ double, DAVIES_BOULDIN double")
    return round_doubles(cluster.best_valid(t))


@query("ward_team_segments", "K6 J10")
def ward_team_segments(spark, sf_dir):
    """Team-season features with their segment by Ward agglomeration (four segments)."""
    st = Stages(spark, sf_dir, contest.SIDE_COLUMNS)
    return round_doubles(st.team_features.join(cluster.ward_labels(clustering_table(st), TF_FEATURES, 4), ["TEAM_ID", "SEASON"]))


@query("kmeans_team_segments", "K4 J10")
def kmeans_team_segments(spark, sf_dir):
    """Team-season features with their K-means segment (k from the elbow)."""
    st = Stages(spark, sf_dir, contest.SIDE_COLUMNS)
    return round_doubles(st.team_features.join(kmeans_segments(st), ["TEAM_ID", "SEASON"]))


@query("pca_team_features", "D1 D2 D4 W2")
def pca_team_features(spark, sf_dir):
    """PCA (10 components) of the standardised team-season features:
    per component the variance share, running share, and the five largest
    loadings (component x sqrt(eigenvalue))."""
    st = Stages(spark, sf_dir, contest.SIDE_COLUMNS)
    data = clustering_table(st)
    p = cluster.pca(data, TF_FEATURES, 10)
    pcs = [f"PC_{i + 1}" for i in range(p.n_components)]
    eig = p.scores.agg(*[F.var_samp(c).alias(c) for c in pcs]).first()
    sqrt_eig = F.sqrt(F.coalesce(*[F.when(F.col("PC") == i + 1, F.lit(float(eig[c]))) for i, c in enumerate(pcs)]))
    load = p.loadings.withColumn("LOADING", F.col("COMPONENT") * sqrt_eig)
    w = W.partitionBy("PC").orderBy(F.abs("LOADING").desc(), "FEATURE")
    top = load.withColumn("RANK", F.row_number().over(w)).where(F.col("RANK") <= 5)
    return round_doubles(top.join(p.variance, "PC").select("PC", "RANK", "FEATURE", "LOADING", "VARIANCE_SHARE",
                                                           "CUMULATIVE"))


@query("pca_scores_joined", "D4 J10")
def pca_scores_joined(spark, sf_dir):
    """Team-season features with the first ten principal-component scores
    and the total explained variance."""
    st = Stages(spark, sf_dir, contest.SIDE_COLUMNS)
    data = clustering_table(st)
    p = cluster.pca(data, TF_FEATURES, 10)
    total = p.variance.agg(F.sum("VARIANCE_SHARE")).first()[0]
    return round_doubles(st.team_features.join(p.scores, ["TEAM_ID", "SEASON"])
                         .withColumn("PCA_TOTAL_VARIANCE", F.lit(float(total))))


@query("method_comparison", "D3")
def method_comparison(spark, sf_dir):
    """Linear reductions side by side: principal components for 80, 90 and 95
    percent of the variance and the configured ten, each with its measured
    share and an advice that follows from it.  Single-machine embeddings have
    no distributed form and are not offered."""
    st = Stages(spark, sf_dir, contest.SIDE_COLUMNS)
    variance = cluster.pca(standardized_team_features(st), TF_FEATURES, len(TF_FEATURES)).variance
    first = [F.min(F.when(F.col("CUMULATIVE") >= share, F.col("PC"))).alias(f"c{i}") for i, share in enumerate((0.8, 0.9, 0.95))]
    wanted = variance.agg(*first).select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("METHOD"), size.cast("int").alias("COMPONENTS")) for name, size in (
            ("PCA, 80 % of variance", F.col("c0")), ("PCA, 90 % of variance", F.col("c1")),
            ("PCA, 95 % of variance", F.col("c2")), ("PCA, 10 components", F.lit(10)))])))
    out = wanted.join(variance, F.col("COMPONENTS") == F.col("PC"), "left")
    advice = (F.when(F.col("CUMULATIVE") >= 0.95, "keeps nearly all variance: use as model features")
               .when(F.col("CUMULATIVE") >= 0.85, "keeps most variance: use for segmentation").otherwise("use for overviews only"))
    return round_doubles(out.select("METHOD", "COMPONENTS", F.col("CUMULATIVE").alias("EXPLAINED_VARIANCE"), advice.alias("ADVICE")))


_PROFILE_SQL = """
WITH seg AS ({seg}),
     overall AS (SELECT {overall} FROM tf),
     per AS (SELECT s.label AS CLUSTER, count(*) AS SIZE, {per} FROM tf t JOIN seg s ON s.TEAM_ID = t.TEAM_ID AND s.SEASON = t.SEASON
             WHERE s.label <> -1 GROUP BY s.label),
     long AS ({long}),
     ranked AS (SELECT *, abs(CLUSTER_MEAN - OVERALL_MEAN) AS ABS_DIFF,
                       (CLUSTER_MEAN - OVERALL_MEAN) / OVERALL_MEAN * 100 AS DIFF_PCT FROM long)
SELECT CLUSTER, SIZE, FEATURE, POS, round_even(CLUSTER_MEAN, 6) AS CLUSTER_MEAN, round_even(OVERALL_MEAN, 6) AS OVERALL_MEAN,
       round_even(ABS_DIFF, 6) AS ABS_DIFF, round_even(DIFF_PCT, 6) AS DIFF_PCT,
       row_number() OVER (PARTITION BY CLUSTER ORDER BY ABS_DIFF DESC, POS) AS RANK
FROM ranked
""".format(seg=SEGMENT_SQL,
           overall=", ".join(f"avg({c}) AS {c}" for c in TF_FEATURES),
           per=", ".join(f"avg(t.{c}) AS {c}" for c in TF_FEATURES),
           long=" UNION ALL ".join(f"SELECT per.CLUSTER, per.SIZE, '{c}' AS FEATURE, {i} AS POS, per.{c} AS CLUSTER_MEAN, "
                                   f"overall.{c} AS OVERALL_MEAN FROM per, overall" for i, c in enumerate(TF_FEATURES)))


@query("segment_profile", "A22 K9", sql=sql_with(_PROFILE_SQL, upto="tf"))
def segment_profile(spark, sf_dir):
    """Per segment and feature: segment mean, overall mean, |difference|,
    percent difference and rank of the difference within the segment."""
    st = Stages(spark, sf_dir, contest.SIDE_COLUMNS)
    prof = cluster.cluster_profile(st.team_features, edge_segments(st), TF_FEATURES)
    return round_doubles(prof.withColumn("RANK", F.col("RANK").cast("bigint")))


_DESCRIPTIONS_SQL = """
WITH {stages},
     pr AS (SELECT *, row_number() OVER (PARTITION BY CLUSTER ORDER BY ABS_DIFF DESC, POS) AS RANK FROM ranked),
     told AS (
       SELECT CLUSTER, RANK, FEATURE || CASE WHEN DIFF_PCT > 20 THEN ' far above' WHEN DIFF_PCT > 10 THEN ' above'
                                             WHEN DIFF_PCT < -20 THEN ' far below' WHEN DIFF_PCT < -10 THEN ' below' END || ' average' AS t
       FROM pr WHERE RANK <= 3),
     d AS (SELECT CLUSTER, coalesce(string_agg(t, '; ' ORDER BY RANK), 'close to average') AS DESCRIPTION FROM told GROUP BY CLUSTER),
     ends AS (
       SELECT CLUSTER, SIZE, first(FEATURE ORDER BY DIFF_PCT DESC, POS) AS HIGH, max(DIFF_PCT) AS HIGH_PCT,
              first(FEATURE ORDER BY DIFF_PCT, POS) AS LOW, min(DIFF_PCT) AS LOW_PCT
       FROM pr WHERE DIFF_PCT IS NOT NULL GROUP BY CLUSTER, SIZE),
     sizes AS (SELECT count(*) AS n, arg_max(CLUSTER, SIZE * 1000000 - CLUSTER) AS bc, max(SIZE) AS bs,
                      arg_min(CLUSTER, SIZE * 1000000 + CLUSTER) AS sc, min(SIZE) AS ss FROM ends)
SELECT ends.CLUSTER, 'Cluster ' || ends.CLUSTER || ', ' || SIZE || ' members: ' || HIGH || ' stands highest at '
       || CAST(round_even(HIGH_PCT, 0) AS BIGINT) || ' percent, ' || LOW || ' lowest at ' || CAST(round_even(LOW_PCT, 0) AS BIGINT)
       || ' percent of difference' AS INSIGHT,
       CASE WHEN LOW_PCT >= 0 THEN 'Nothing lags; build on ' || HIGH WHEN HIGH_PCT <= 0 THEN 'Nothing leads; start with ' || LOW
            ELSE 'Work on ' || LOW || ' and keep ' || HIGH END AS RECOMMENDATION, DESCRIPTION
FROM ends LEFT JOIN d ON d.CLUSTER = ends.CLUSTER
UNION ALL
SELECT -1, 'Sizes run from ' || ss || ' (cluster ' || sc || ') to ' || bs || ' (cluster ' || bc || ')', 'Read small clusters with care', NULL
FROM sizes WHERE n > 1
""".format(stages=_PROFILE_SQL.strip()[5:_PROFILE_SQL.strip().rindex("SELECT CLUSTER, SIZE, FEATURE")].rstrip())


@query("segment_descriptions", "P20 P21 K9", sql=sql_with(_DESCRIPTIONS_SQL, upto="tf"))
def segment_descriptions(spark, sf_dir):
    """Description, insight and recommendation sentences per segment plus
    a line on the segment sizes."""
    st = Stages(spark, sf_dir, contest.SIDE_COLUMNS)
    prof = cluster.cluster_profile(st.team_features, edge_segments(st), TF_FEATURES)
    return cluster.insights(prof).join(cluster.describe_clusters(prof).drop("SIZE"), "CLUSTER", "left")


_STRATEGY_SQL = """
WITH {stages},
     pr AS (SELECT *, row_number() OVER (PARTITION BY CLUSTER ORDER BY ABS_DIFF DESC, POS) AS RANK FROM ranked),
     named AS (SELECT CLUSTER, bool_or(contains(lower(FEATURE), 'pts') OR contains(lower(FEATURE), 'pct')) AS a,
                      bool_or(contains(lower(FEATURE), 'reb')) AS d FROM pr WHERE RANK <= 5 GROUP BY CLUSTER)
SELECT CLUSTER, CASE WHEN a THEN 'defend better' WHEN d THEN 'vary the attack' ELSE 'own strengths' END AS KIND,
       'Cluster ' || CLUSTER || ': ' || CASE WHEN a THEN 'keep the scoring, work on the defence'
            WHEN d THEN 'add ways to score, keep the defence' ELSE 'look for an edge in what sets it apart' END AS ADVICE FROM named
UNION ALL SELECT NULL, 'scouting', 'Scout players by the profile that a cluster wants'
UNION ALL SELECT NULL, 'matchups', 'Prepare a plan for each cluster of opponents'
""".format(stages=_PROFILE_SQL.strip()[5:_PROFILE_SQL.strip().rindex("SELECT CLUSTER, SIZE, FEATURE")].rstrip())


@query("segment_strategies", "P21 K9", sql=sql_with(_STRATEGY_SQL, upto="tf"))
def segment_strategies(spark, sf_dir):
    """Advice per segment by the names of its five most different features
    (points and shares stand for attack, rebounds for defence in this schema)."""
    st = Stages(spark, sf_dir, contest.SIDE_COLUMNS)
    prof = cluster.cluster_profile(st.team_features, edge_segments(st), TF_FEATURES)
    return cluster.strategies(prof, attack=("pts", "pct"), defence=("reb",))


# ------------------------------------------------------------ anomalies
def _detectors(st):
    from duelframe.operators import anomaly
    data = clustering_table(st)
    keys = ["TEAM_ID", "SEASON"]
    return {
        "isolation_forest": anomaly.isolation_forest(data, TF_FEATURES, keys, 100, 256, 0.1, 42),
        "one_class_svm": anomaly.one_class_svm(data, TF_FEATURES, keys, 0.1),
        "local_outlier_factor": anomaly.local_outliers(data, TF_FEATURES, keys, 20, 0.1),
    }


@query("isolation_forest_team_seasons", "N1")
def isolation_forest_team_seasons(spark, sf_dir):
    """Isolation forest (100 trees, 256 samples, contamination 0.1) on the
    standardised team-season features: score, decision and label."""
    from duelframe.operators import anomaly
    data = standardized_team_features(Stages(spark, sf_dir, contest.SIDE_COLUMNS))
    return round_doubles(anomaly.isolation_forest(data, TF_FEATURES, ["TEAM_ID", "SEASON"]))


@query("one_class_team_seasons", "N3")
def one_class_team_seasons(spark, sf_dir):
    """One-class support vector machine (RBF kernel by random Fourier
    features, nu 0.1) on the standardised team-season features."""
    from duelframe.operators import anomaly
    data = standardized_team_features(Stages(spark, sf_dir, contest.SIDE_COLUMNS))
    return round_doubles(anomaly.one_class_svm(data, TF_FEATURES, ["TEAM_ID", "SEASON"], 0.1))


@query("kernel_density_team_seasons", "N3")
def kernel_density_team_seasons(spark, sf_dir):
    """Kernel density of the standardised team-seasons (random Fourier
    features of the RBF kernel); the lowest tenth is anomalous."""
    from duelframe.operators import anomaly
    data = standardized_team_features(Stages(spark, sf_dir, contest.SIDE_COLUMNS))
    return round_doubles(anomaly.rff_one_class(data, TF_FEATURES, ["TEAM_ID", "SEASON"], 0.1))


@query("anomaly_comparison", "N4 N5")
def anomaly_comparison(spark, sf_dir):
    """Rows flagged per detector (count and %) and the number of team-seasons
    flagged by at least two of the three detectors."""
    from duelframe.operators import anomaly
    det = _detectors(Stages(spark, sf_dir, contest.SIDE_COLUMNS))
    comp = anomaly.compare_detectors(det)
    cons = anomaly.consensus(det, ["TEAM_ID", "SEASON"]).agg(
        F.count(F.lit(1)).alias("ROWS"), F.sum("IS_CONSENSUS").alias("ANOMALIES")).withColumn(
        "DETECTOR", F.lit("consensus_2_of_3")).withColumn("ANOMALY_PCT", F.col("ANOMALIES") * F.lit(100.0) / F.col("ROWS"))
    return round_doubles(comp.unionByName(cons))


@query("anomaly_features", "N6 P18 J10")
def anomaly_features(spark, sf_dir):
    """Team-season features with the isolation-forest score, label and
    confidence 1 - 1/(1 + exp(-|decision|))."""
    from duelframe.functions.columns import anomaly_confidence
    from duelframe.operators import anomaly
    st = Stages(spark, sf_dir, contest.SIDE_COLUMNS)
    data = standardized_team_features(st)
    s = anomaly.isolation_forest(data, TF_FEATURES, ["TEAM_ID", "SEASON"])
    out = st.team_features.join(s, ["TEAM_ID", "SEASON"]).withColumn("ANOMALY_CONFIDENCE",
                                                                    anomaly_confidence("DECISION"))
    return round_doubles(out)


# Detectors without a fit: distance from the mean over three groups of features.
DETECTOR_GROUPS = {
    "home": [c for c in TF_FEATURES if c.startswith("HOME_") and "ADVANTAGE" not in c],
    "away": [c for c in TF_FEATURES if c.startswith("AWAY_")],
    "advantage": [c for c in TF_FEATURES if "ADVANTAGE" in c],
}
_FILLED = ("filled", "SELECT TEAM_ID, SEASON, " + ", ".join(
    f"coalesce({c}, (SELECT median({c}) FROM tf)) AS {c}" for c in TF_FEATURES) + " FROM tf")
_DETECTOR_CTES = [_FILLED] + [(f"sc_{name}", "SELECT TEAM_ID, SEASON, " + " + ".join(
    f"power(({c} - (SELECT avg({c}) FROM filled)) / (SELECT stddev_pop({c}) FROM filled), 2)" for c in cols) + " AS SCORE FROM filled")
    for name, cols in DETECTOR_GROUPS.items()] + [
    (f"det_{name}", f"SELECT *, (SELECT quantile_cont(SCORE, 0.9) FROM sc_{name}) - SCORE AS DECISION, "
                    f"CAST(SCORE > (SELECT quantile_cont(SCORE, 0.9) FROM sc_{name}) AS INT) AS IS_ANOMALY FROM sc_{name}")
    for name in DETECTOR_GROUPS]


def _group_detectors(st):
    from duelframe.operators import anomaly
    from duelframe.operators.scaling import median_fill
    data = median_fill(st.team_features, TF_FEATURES)
    return {name: anomaly.zscore_detector(data, cols, ["TEAM_ID", "SEASON"], 0.1) for name, cols in DETECTOR_GROUPS.items()}


@query("detector_comparison_by_group", "N4", sql=sql_with(" UNION ALL ".join(
    f"SELECT count(*) AS ROWS, CAST(sum(IS_ANOMALY) AS BIGINT) AS ANOMALIES, '{name}' AS DETECTOR, "
    f"round_even(sum(IS_ANOMALY) * 100.0 / count(*), 6) AS ANOMALY_PCT FROM det_{name}" for name in DETECTOR_GROUPS),
    upto="tf", extra=_DETECTOR_CTES))
def detector_comparison_by_group(spark, sf_dir):
    """Rows flagged (count and %) by the distance detectors of home, away and
    advantage features."""
    from duelframe.operators import anomaly
    return round_doubles(anomaly.compare_detectors(_group_detectors(Stages(spark, sf_dir, contest.SIDE_COLUMNS))))


@query("detector_consensus_by_group", "N5 N6 P18 J10", sql=sql_with("""
SELECT h.TEAM_ID, h.SEASON, h.IS_ANOMALY + a.IS_ANOMALY + d.IS_ANOMALY AS VOTES,
       CAST(h.IS_ANOMALY + a.IS_ANOMALY + d.IS_ANOMALY >= 2 AS INT) AS IS_CONSENSUS, round_even(h.SCORE, 6) AS HOME_SCORE,
       round_even(1 - 1 / (1 + exp(-abs(h.DECISION))), 6) AS HOME_CONFIDENCE
FROM det_home h JOIN det_away a ON h.TEAM_ID = a.TEAM_ID AND h.SEASON = a.SEASON
JOIN det_advantage d ON h.TEAM_ID = d.TEAM_ID AND h.SEASON = d.SEASON""", upto="tf", extra=_DETECTOR_CTES))
def detector_consensus_by_group(spark, sf_dir):
    """Votes and 2-of-3 consensus of the distance detectors, with the home
    detector's score and confidence joined as features by key."""
    from duelframe.functions.columns import anomaly_confidence
    from duelframe.operators import anomaly
    keys = ["TEAM_ID", "SEASON"]
    det = _group_detectors(Stages(spark, sf_dir, contest.SIDE_COLUMNS))
    home = det["home"].select(*keys, F.col("SCORE").alias("HOME_SCORE"), anomaly_confidence("DECISION").alias("HOME_CONFIDENCE"))
    return round_doubles(anomaly.consensus(det, keys).join(home, keys))
