"""DBSCAN on the blocks of the neighbour joins.

Three passes over the pairs of blocks whose bounds reach within ``eps``:
neighbours are counted (equal vectors are one point with a weight), core points
within ``eps`` of each other are linked, and a border point takes the smallest
cluster of the core points around it.  A pair of blocks emits no more links
than a spanning forest of its core points needs, so a dense region makes no
quadratic table; components are found over those links.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duelframe.operators import neighbours as nb
from duelframe.operators.components import components
from duelframe.operators.ordering import row_numbers
from duelframe.session import materialise


def forest(near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of links that connect whatever the matrix connects, at most rows + columns - 1 of them.

    Rounds: every row's group takes a link out of it, if there is one; the
    groups merge, until no link leaves a group.
    """
    rows, cols = near.shape
    group = np.arange(rows + cols)
    out: list[tuple[int, int]] = []
    while True:
        leaving = near & (group[:rows, None] != group[None, rows:])
        at = np.flatnonzero(leaving.any(axis=1))
        if not len(at):
            break
        for r, c in zip(at.tolist(), leaving[at].argmax(axis=1).tolist()):
            a, b = group[r], group[rows + c]
            if a != b:
                group[group == max(a, b)] = min(a, b)
                out.append((r, c))
    links = np.array(out, np.int64).reshape(-1, 2)
    return links[:, 0], links[:, 1]


def _within(eps: float):
    def slices(q, p):
        for i in range(0, len(q[0]), nb.SLICE):
            yield slice(i, i + nb.SLICE), nb.distances(q[2][i:i + nb.SLICE], p[2]) <= eps
    return slices


def dbscan(df: DataFrame, cols: Sequence[str], keys: Sequence[str], eps: float = 0.5, min_samples: int = 5,
           block: int = nb.BLOCK) -> DataFrame:
    """keys + label and IS_CORE of every row.

    A row is a core point if ``min_samples`` rows, itself included, are within
    ``eps`` of it.  Core points within ``eps`` of each other share a cluster;
    clusters are numbered from 0 by their first core row in the order of the
    keys, a border row takes the smallest number around it, the rest is -1
    (noise).  Rows with a null or non-finite component are noise.
    """
    rows = nb.numbered(df, cols, keys)
    points = materialise(rows.groupBy("x").agg(F.min("N").alias("N"), F.count("*").alias("copies")), "points")
    blocks = nb.deal(points, nb.draw_pivots(points, block), F.col("copies"), block)
    none = df.select(*keys).withColumns({"label": F.lit(-1), "IS_CORE": F.lit(0)})
    if not blocks.size.sum():
        return none
    asked = blocks.table.select("block", F.transform("rows", lambda r: F.struct(r["N"].alias("N"), F.lit(float(eps)).alias("w"), r["x"].alias("x"))).alias("rows"))
    pairs = materialise(nb.pairs_within(asked, blocks), "pairs")
    within = _within(eps)

    def count(qb, pb, q, p):
        return q[0], np.concatenate([near @ p[1] for _, near in within(q, p)])

    found = nb.visit(pairs, blocks.table, blocks.table, count, "point long, around double")
    core = materialise(found.groupBy("point").agg(F.sum("around").alias("around")).where(F.col("around") >= min_samples).select("point"), "core")

    # core points are marked by weight 1 in the blocks, others by 0
    def marked(value: DataFrame, name: str, default: float) -> DataFrame:
        flat = blocks.table.select("block", F.inline("rows")).join(value, F.col("N") == F.col("point"), "left")
        w = F.coalesce(F.col(name).cast("double"), F.lit(default)).alias("w")
        return materialise(flat.groupBy("block").agg(F.collect_list(F.struct("N", w, "x")).alias("rows")), "marked")

    def link(qb, pb, q, p):
        qc, pc = q[1] > 0, p[1] > 0
        a, b = q[0][qc], p[0][pc]
        near = np.concatenate([m for _, m in within([x[qc] for x in q], [x[pc] for x in p])] or [np.zeros((0, len(b)), bool)])
        r, c = forest(near)
        return a[r], b[c]

    core_blocks = marked(core.withColumn("is", F.lit(1.0)), "is", 0.0)
    links = nb.visit(pairs.where("qb <= pb"), core_blocks, core_blocks, link, "a long, b long")
    linked = components(links)
    alone = core.select(F.col("point").alias("node")).join(linked, "node", "left_anti").withColumn("component", F.col("node"))
    member = materialise(linked.unionByName(alone), "members")
    firsts = row_numbers(member.select("component").distinct(), [F.col("component")], "label", 0)
    labelled = materialise(member.join(firsts, "component").select(F.col("node").alias("point"), "label"), "labels")

    def border(qb, pb, q, p):
        pc, qo = p[1] >= 0, q[1] < 0
        own = [x[qo] for x in q]
        best = [np.where(near, p[1][pc][None, :], np.inf).min(axis=1, initial=np.inf)
                for _, near in within(own, [x[pc] for x in p])]
        best = np.concatenate(best or [np.zeros(0)])
        hit = np.isfinite(best)
        return own[0][hit], best[hit].astype(np.int64)

    known = marked(labelled, "label", -1.0)
    edge = nb.visit(pairs, known, known, border, "point long, label long").groupBy("point").agg(F.min("label").alias("label"))
    both = labelled.withColumn("IS_CORE", F.lit(1)).unionByName(edge.withColumn("IS_CORE", F.lit(0)))
    vectors = points.join(both, F.col("N") == F.col("point")).select("x", F.col("label").cast("int").alias("label"), "IS_CORE")
    found = nb.all_rows(df.select(*keys), rows.join(vectors, "x").select(*keys, "label", "IS_CORE"), keys)
    return found.withColumns({"label": F.coalesce("label", F.lit(-1)), "IS_CORE": F.coalesce("IS_CORE", F.lit(0))})
