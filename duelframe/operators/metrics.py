"""Exact evaluation metrics over prediction tables.

Input: one row per scored example with ``label``, ``prediction`` and (for
AUC) ``probability``.  Everything is a grouped or global aggregate; the AUC
needs cumulative counts over sorted scores, computed with a two-level prefix
sum (per score bucket, then over the bucket totals), so no single task ever
sorts all scores.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from duelframe.functions.columns import safe_ratio
from duelframe.session import materialise


def binary_counts(pred: DataFrame, label: str = "label", prediction: str = "prediction",
                  group: Sequence[str] = ()) -> DataFrame:
    y, p = F.col(label) == 1, F.col(prediction) == 1
    return pred.groupBy(*group).agg(
        F.count_if(y & p).alias("TP"), F.count_if(~y & p).alias("FP"),
        F.count_if(y & ~p).alias("FN"), F.count_if(~y & ~p).alias("TN"))


def classification_scores(pred: DataFrame, label: str = "label", prediction: str = "prediction",
                          group: Sequence[str] = ()) -> DataFrame:
    """Accuracy, precision, recall and F1 of the positive class (0 when a
    denominator is 0)."""
    c = binary_counts(pred, label, prediction, group)
    tp, fp, fn, tn = (F.col(x).cast("double") for x in ("TP", "FP", "FN", "TN"))
    prec = safe_ratio(tp, tp + fp)
    rec = safe_ratio(tp, tp + fn)
    return c.select(*group, safe_ratio(tp + tn, tp + fp + fn + tn).alias("ACCURACY"),
                    prec.alias("PRECISION"), rec.alias("RECALL"),
                    safe_ratio(F.lit(2.0) * tp, F.lit(2.0) * tp + fp + fn).alias("F1"))


def roc_auc(pred: DataFrame, label: str = "label", score: str = "probability",
            group: Sequence[str] = (), buckets: int = 1024) -> DataFrame:
    """Area under the ROC curve, ties counted half (Mann-Whitney form).

    AUC = sum over distinct scores v of pos(v) * (neg(< v) + neg(v)/2) / (P*N).
    Counts per distinct score are written once; a sketch of the scores cuts
    them into buckets of about equal size, however crowded they are, and the
    cumulative negative count uses a window per (group, bucket) plus a small
    one over the bucket totals.  The result does not depend on the buckets;
    NULL scores count as lowest, NaN as highest."""
    g = list(group)
    per_v = materialise(pred.groupBy(*g, F.col(score).cast("double").alias("__v")).agg(
        F.count_if(F.col(label) == 1).alias("__pos"), F.count_if(F.col(label) != 1).alias("__neg")), "scores")
    cuts = per_v.agg(F.percentile_approx("__v", [i / buckets for i in range(1, buckets)], 10 * buckets)).first()[0] or []
    splits = [-math.inf, *sorted({c for c in cuts if math.isfinite(c)}), math.inf]
    if len(splits) > 2:
        per_v = Bucketizer(splits=splits, inputCol="__s", outputCol="__b", handleInvalid="keep").transform(
            per_v.withColumn("__s", F.coalesce("__v", F.lit(-math.inf)))).drop("__s")
    else:
        per_v = per_v.withColumn("__b", F.lit(0.0))
    inner = W.partitionBy(*g, "__b").orderBy("__v").rowsBetween(W.unboundedPreceding, -1)
    per_v = per_v.withColumn("__neg_before_in_b", F.coalesce(F.sum("__neg").over(inner), F.lit(0)))
    totals = per_v.groupBy(*g, "__b").agg(F.sum("__neg").alias("__bneg"))
    outer = W.partitionBy(*g).orderBy("__b").rowsBetween(W.unboundedPreceding, -1)
    totals = totals.withColumn("__neg_before_b", F.coalesce(F.sum("__bneg").over(outer), F.lit(0))).drop("__bneg")
    j = per_v.join(totals, g + ["__b"])
    contrib = F.col("__pos") * (F.col("__neg_before_b") + F.col("__neg_before_in_b") + F.col("__neg") * F.lit(0.5))
    out = j.groupBy(*g).agg(F.sum(contrib).alias("__num"), F.sum("__pos").alias("__P"), F.sum("__neg").alias("__N"))
    return out.select(*g, F.try_divide(F.col("__num"), F.col("__P") * F.col("__N")).alias("ROC_AUC"))


def classification_report(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Per-class precision/recall/F1/support plus macro and weighted rows."""
    c = binary_counts(pred, label, prediction)
    tp, fp, fn, tn = (F.col(x).cast("double") for x in ("TP", "FP", "FN", "TN"))

    def row(name, t, f_p, f_n, support):
        pr, rc = safe_ratio(t, t + f_p), safe_ratio(t, t + f_n)
        return F.struct(F.lit(name).alias("CLASS"), pr.alias("PRECISION"), rc.alias("RECALL"),
                        safe_ratio(F.lit(2.0) * t, F.lit(2.0) * t + f_p + f_n).alias("F1"),
                        support.alias("SUPPORT"))
    per = c.select(F.inline(F.array(row("0", tn, fn, fp, tn + fp), row("1", tp, fp, fn, tp + fn))))
    tot = per.agg(F.lit("macro avg").alias("CLASS"), F.avg("PRECISION").alias("PRECISION"),
                  F.avg("RECALL").alias("RECALL"), F.avg("F1").alias("F1"), F.sum("SUPPORT").alias("SUPPORT"))
    wtd = per.agg(F.lit("weighted avg").alias("CLASS"),
                  safe_ratio(F.sum(F.col("PRECISION") * F.col("SUPPORT")), F.sum("SUPPORT")).alias("PRECISION"),
                  safe_ratio(F.sum(F.col("RECALL") * F.col("SUPPORT")), F.sum("SUPPORT")).alias("RECALL"),
                  safe_ratio(F.sum(F.col("F1") * F.col("SUPPORT")), F.sum("SUPPORT")).alias("F1"),
                  F.sum("SUPPORT").alias("SUPPORT"))
    return per.unionByName(tot).unionByName(wtd)


def confusion_matrix(pred: DataFrame, label: str = "label", prediction: str = "prediction",
                     classes: Sequence[int] = (0, 1)) -> DataFrame:
    """Rows = true class, columns PRED_<c> = counts (pivot with fixed values)."""
    return (pred.groupBy(F.col(label).cast("int").alias("LABEL"))
                .pivot(prediction, list(classes)).count()
                .withColumnsRenamed({str(c): f"PRED_{c}" for c in classes})
                .fillna(0))


def regression_scores(pred: DataFrame, label: str = "label", prediction: str = "prediction",
                      group: Sequence[str] = ()) -> DataFrame:
    """R2, MAE, MSE, RMSE in one pass (R2 from sums of y and y^2)."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    e = y - p
    a = pred.groupBy(*group).agg(
        F.count(F.lit(1)).alias("__n"), F.sum(e * e).alias("__sse"), F.sum(F.abs(e)).alias("__sae"),
        F.sum(y).alias("__sy"), F.sum(y * y).alias("__syy"))
    sst = F.col("__syy") - F.col("__sy") * F.col("__sy") / F.col("__n")
    mse = F.col("__sse") / F.col("__n")
    return a.select(*group, (F.lit(1.0) - F.try_divide(F.col("__sse"), sst)).alias("R2"),
                    (F.col("__sae") / F.col("__n")).alias("MAE"), mse.alias("MSE"), F.sqrt(mse).alias("RMSE"))


def majority_baseline(pred: DataFrame, label: str = "label", group: Sequence[str] = ()) -> DataFrame:
    """Share of the majority class: greatest(mean(y), 1 - mean(y))."""
    m = F.avg(F.col(label).cast("double"))
    return pred.groupBy(*group).agg(F.greatest(m, F.lit(1.0) - m).alias("BASELINE"))


def best_by(scores: DataFrame, name: str, metric: str, order: str = "ORDINAL",
            higher: bool = True) -> DataFrame:
    """Row with the best ``metric``; ties go to the lowest ``order`` (the
    first declared)."""
    key = F.struct((F.col(metric) if higher else -F.col(metric)).alias("m"), (-F.col(order)).alias("o"))
    return scores.agg(F.max_by(name, key).alias(f"BEST_{name}"), F.max_by(metric, key).alias(f"BEST_{metric}"))


def improvement(before: float | DataFrame, after_col: str = "WITH", before_col: str = "WITHOUT") -> F.Column:
    """Verdict of a score change: >0.01 significant, >0 slight, else none."""
    gain = F.col(after_col) - F.col(before_col)
    return F.when(gain > 0.01, "significant improvement").when(gain > 0, "slight improvement") \
            .otherwise("no improvement")
