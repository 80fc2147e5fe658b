"""Segment labels turned into contest features (one-hots, stats, flags).

Labels live in a (TEAM_ID, SEASON, label) table; rows are matched by key,
never by position.  The per-cluster tables have one row per cluster and the
maps one row per team, a handful beside the games: they are broadcast, as a
shuffle by so few keys would put a cluster's games into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def team_cluster_map(labels: DataFrame, entity: str = "TEAM_ID", season: str = "SEASON",
                     label: str = "label") -> DataFrame:
    """Entity -> label of its latest season (last season wins)."""
    return labels.groupBy(entity).agg(F.max_by(label, season).alias("CLUSTER"))


def label_values(df: DataFrame, col: str) -> list[int]:
    """Distinct label values, sorted: each becomes a one-hot column."""
    return sorted(int(r[0]) for r in df.select(col).distinct().collect() if r[0] is not None)


def one_hot(df: DataFrame, col: str, prefix: str, values: Sequence[int]) -> DataFrame:
    return df.withColumns({f"{prefix}_{v}": (F.col(col) == F.lit(v)).cast("int") for v in values})


def top_variance_columns(features: DataFrame, exclude: Sequence[str] = ("TEAM_ID", "SEASON"), k: int = 5) -> list[str]:
    from duelframe.functions.columns import numeric_columns
    cols = numeric_columns(features, exclude)
    if len(cols) <= k:
        return cols
    row = features.agg(*[F.var_samp(c).alias(f"v{i}") for i, c in enumerate(cols)]).first()
    order = sorted(range(len(cols)), key=lambda i: (-(row[f"v{i}"] if row[f"v{i}"] is not None else float("-inf")), i))
    return [cols[i] for i in order[:k]]


def cluster_statistics(features: DataFrame, labels: DataFrame, cols: Sequence[str] | None = None,
                       keys: Sequence[str] = ("TEAM_ID", "SEASON"), label: str = "label") -> DataFrame:
    """Per cluster (noise -1 excluded): mean, sample std and exact median of
    the five highest-variance features, one wide row per cluster."""
    j = features.join(labels.select(*keys, label), list(keys))
    cols = list(cols) if cols is not None else top_variance_columns(j.drop(label), tuple(keys))
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"{c}_MEAN"), F.stddev_samp(c).alias(f"{c}_STD"), F.median(c).alias(f"{c}_MEDIAN")]
    return j.where(F.col(label) != -1).groupBy(F.col(label).alias("CLUSTER")).agg(*aggs)


def centroid_distances(features: DataFrame, labels: DataFrame, cols: Sequence[str],
                       entity: str = "TEAM_ID", season: str = "SEASON", label: str = "label") -> DataFrame:
    """(entity, CLUSTER_DIST_k ...): Euclidean distance from the entity's latest
    season to each cluster's mean in ``cols`` (noise -1 has no mean)."""
    j = features.join(labels.select(entity, season, label), [entity, season]).where(F.col(label) != -1)
    means = j.groupBy(label).agg(*[F.avg(c).alias(f"__m{i}") for i, c in enumerate(cols)])
    latest = features.groupBy(entity).agg(F.max_by(F.struct(*cols), season).alias("__x"))
    # one row a cluster, turned into one row of literals: the columns are known by their labels
    out = {}
    for r in means.collect():
        out[f"CLUSTER_DIST_{r[label]}"] = F.sqrt(sum((F.pow(F.col("__x")[c] - F.lit(float(r[f"__m{i}"])), 2)
                                                      for i, c in enumerate(cols)), F.lit(0.0)))
    return latest.select(entity, *[v.alias(k) for k, v in sorted(out.items())])


def _attach(df: DataFrame, mapping: DataFrame, key: str, out: str) -> DataFrame:
    m = mapping.select(F.col("TEAM_ID").alias("__k"), F.col("CLUSTER").alias(out))
    return (df.join(F.broadcast(m), F.col(key) == F.col("__k"), "left").drop("__k")
              .withColumn(out, F.coalesce(F.col(out), F.lit(-1))))


def _prefixed_stats(stats: DataFrame, prefix: str, key: str) -> DataFrame:
    return F.broadcast(stats.select(F.col("CLUSTER").alias(key),
                                    *[F.col(c).alias(prefix + c) for c in stats.columns if c != "CLUSTER"]))


def enhance_classification(X: DataFrame, labels: DataFrame, features: DataFrame,
                           home_col: str = "HOME_TEAM_ID", away_col: str = "VISITOR_TEAM_ID") -> DataFrame:
    """Add HOME_CLUSTER_k / AWAY_CLUSTER_k one-hots, SAME_CLUSTER,
    CLUSTER_DIFF and both sides' cluster statistics; NULLs -> 0."""
    mapping = team_cluster_map(labels)
    x = _attach(_attach(X, mapping, home_col, "HOME_TEAM_CLUSTER"), mapping, away_col, "AWAY_TEAM_CLUSTER")
    hv = label_values(x, "HOME_TEAM_CLUSTER")
    av = label_values(x, "AWAY_TEAM_CLUSTER")
    x = one_hot(one_hot(x, "HOME_TEAM_CLUSTER", "HOME_CLUSTER", hv), "AWAY_TEAM_CLUSTER", "AWAY_CLUSTER", av)
    x = x.withColumns({
        "SAME_CLUSTER": (F.col("HOME_TEAM_CLUSTER") == F.col("AWAY_TEAM_CLUSTER")).cast("int"),
        "CLUSTER_DIFF": F.col("HOME_TEAM_CLUSTER") - F.col("AWAY_TEAM_CLUSTER"),
    })
    stats = cluster_statistics(features, labels)
    x = x.join(_prefixed_stats(stats, "HOME_CLUSTER_STATS_", "__hc"), F.col("HOME_TEAM_CLUSTER") == F.col("__hc"), "left")
    x = x.join(_prefixed_stats(stats, "AWAY_CLUSTER_STATS_", "__ac"), F.col("AWAY_TEAM_CLUSTER") == F.col("__ac"), "left")
    x = x.drop("__hc", "__ac", "HOME_TEAM_CLUSTER", "AWAY_TEAM_CLUSTER")
    return x.fillna(0)


def enhance_regression(data: DataFrame, labels: DataFrame, features: DataFrame,
                       team_col: str = "HOME_TEAM_ID", real_distance: DataFrame | None = None) -> DataFrame:
    """Add CLUSTER_k one-hots and cluster statistics keyed on one side's
    team, plus IN_CLUSTER_k (member flag) and CLUSTER_DIST_k.  In parity mode
    the distance is 0 for members (as the reference); pass
    ``real_distance`` (TEAM_ID, CLUSTER_DIST_k...) for true centroid
    distances.  NULLs -> 0."""
    mapping = team_cluster_map(labels)
    x = _attach(data, mapping, team_col, "TEAM_CLUSTER")
    vals = label_values(x, "TEAM_CLUSTER")
    x = one_hot(x, "TEAM_CLUSTER", "CLUSTER", vals)
    stats = cluster_statistics(features, labels)
    x = x.join(_prefixed_stats(stats, "CLUSTER_STATS_", "__c"), F.col("TEAM_CLUSTER") == F.col("__c"), "left").drop("__c")
    member_vals = [v for v in label_values(mapping, "CLUSTER") if v != -1]
    flags = {}
    for v in member_vals:
        member = F.col("TEAM_CLUSTER") == F.lit(v)
        flags[f"IN_CLUSTER_{v}"] = F.when(member, F.lit(1.0)).otherwise(F.lit(0.0))
        flags[f"CLUSTER_DIST_{v}"] = F.lit(0.0)
    x = x.withColumns(flags)
    if real_distance is not None:
        x = x.drop(*[f"CLUSTER_DIST_{v}" for v in member_vals]).join(
            F.broadcast(real_distance.withColumnRenamed("TEAM_ID", "__t")), F.col(team_col) == F.col("__t"), "left").drop("__t")
    return x.drop("TEAM_CLUSTER").fillna(0)
