"""Random forests and boosted trees grown in tasks, for training sets that fit in one.

Every group of trees of every fold is one group of rows: it gets the rows'
columns as quantile codes (one byte each), draws its trees' bootstrap weights
from row and tree numbers, grows the trees level by level on sorted codes, and
scores the rows that its fold leaves out.  Depths and sizes are nested axes: a
cut tree and the first trees of a forest are read off the same growth, and the
scores of the groups are added up by row.  Boosting has one group of rows a fold
and learning rate, whose rounds follow each other in one task instead of in
thousands of jobs; for classes the rows of the final model are one more group.
Only the final model's nodes come to the driver, as Spark ML's do.

`fits_in_a_task` bounds the rows of a group; beyond it the models are Spark
ML's, which grows trees by histograms over the distributed rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duelframe.operators.forests import Trees
from duelframe.operators.gram import columns, summed
from duelframe.session import materialise

BINS = 64                  # codes of a column
DENSE = 4                  # most cells a row for sums by cell
CLASS_BINS = 32            # codes of a column in boosted classes: Spark ML's number
TOGETHER = 10              # trees of a group of rows
SLICE = 1 << 14            # rows whose scores are added up at once
MOST_BYTES = 64 << 20      # codes, label and numbers of the rows that one task may hold
_POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(12)])


def fits_in_a_task(rows: int, features: int) -> bool:
    return rows * (features + 24) <= MOST_BYTES


def edges_of(df: DataFrame, features: Sequence[str], bins: int = BINS) -> list[np.ndarray]:
    """Split points of every column: its distinct quantiles."""
    at = F.array(*[F.lit(k / bins) for k in range(1, bins)])
    row = df.agg(*[F.percentile_approx(F.col(f"`{c}`").cast("double"), at, 10_000).alias(f"q{i}") for i, c in enumerate(features)]).first()
    return [np.unique(np.array(row[f"q{i}"] or [], float)) for i in range(len(features))]


def encode(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """Codes of the values: how many split points lie below."""
    return np.column_stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)]).astype(np.uint8)


def weights_of(rows: np.ndarray, tree: int, seed: int = 42) -> np.ndarray:
    """Bootstrap weights, Poisson with mean 1, from the numbers of row and tree."""
    with np.errstate(over="ignore"):
        h = rows.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(tree * 1_000_003 + seed)
        for shift, odd in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 1)):
            h = (h ^ (h >> np.uint64(shift))) * np.uint64(odd)
    return np.searchsorted(_POISSON, (h >> np.uint64(11)).astype(float) / 2.0 ** 53, "right").astype(float)


def _order(at: np.ndarray, code: np.ndarray, nodes: int) -> np.ndarray:
    """Rows by node and code, equal ones as they come: two passes of numpy's radix sort, which takes short integers."""
    o = np.argsort(code, kind="stable")
    if nodes <= 1 << 16:
        return o[np.argsort(at[o].astype(np.uint16), kind="stable")]
    low = o[np.argsort((at[o] & 0xFFFF).astype(np.uint16), kind="stable")]
    return low[np.argsort((at[low] >> 16).astype(np.uint16), kind="stable")]


def bundled(codes: np.ndarray) -> list[tuple[list[int], list[int], np.ndarray]]:
    """(columns, numbers of their codes, joint code) of bundles that have at most 256 joint codes,
    so that columns of few codes share one pass over the rows."""
    bins = codes.max(axis=0).astype(int) + 1 if len(codes) else np.ones(codes.shape[1], int)
    out: list[tuple[list[int], list[int], np.ndarray]] = []
    room: list[int] = []
    for j in np.argsort(-bins, kind="stable").tolist():
        n = int(bins[j])
        fits = next((i for i, free in enumerate(room) if free >= n), None)
        if fits is None:
            out.append(([j], [n], np.ascontiguousarray(codes[:, j])))
            room.append(256 // n)
        else:
            cols, sizes, joint = out[fits]
            out[fits] = [*cols, j], [*sizes, n], joint * np.uint8(n) + codes[:, j]
            room[fits] //= n
    return out


class _Sums:
    """Totals of weights and of weighted labels by cell.  Whole numbers are packed into one, so that
    their totals stay exact and take one pass; rows that all weigh 1 are counted."""

    def __init__(self, w: np.ndarray, wy: np.ndarray):
        self.unit = None
        if len(w) and not (w % 1).any() and not (wy % 1).any():
            unit = 2.0 ** math.ceil(math.log2(w.sum() + 1))
            if (np.abs(wy).sum() + 1) * unit < 2.0 ** 53:
                self.unit = unit
        self.values = [wy * self.unit + w] if self.unit else [None if (w == 1).all() else w, wy]

    def of(self, rows: np.ndarray) -> list:
        return [v if v is None or len(rows) == len(v) else v[rows] for v in self.values]

    def at(self, values: list, key: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray]:
        return self._apart([np.bincount(key, v, cells) for v in values])

    def runs(self, values: list, order: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self._apart([np.diff(np.append(start, len(order))) if v is None else np.add.reduceat(v[order], start) for v in values])

    def _apart(self, found: list) -> tuple[np.ndarray, np.ndarray]:
        if self.unit is None:
            return found[0].astype(float), found[1]
        sums = np.floor(found[0] / self.unit)
        return found[0] - sums * self.unit, sums


def grow(codes: np.ndarray, y: np.ndarray, w: np.ndarray, chosen: int, least: float, max_depth: int, rng: np.random.Generator,
         pure: float = 1e-9, bundles: list | None = None) -> dict[str, np.ndarray]:
    """One tree, all nodes of a level at once: feature, code (left if not above), left, right, value, gain by node.

    Every node looks at ``chosen`` columns drawn for it and takes the split that
    lowers the weighted squared error most (for labels 0 and 1 the Gini
    impurity); both sides weigh at least ``least``.  A node is pure if its error
    is at most ``pure`` of its sum of squares.  ``codes`` are read by column;
    ``bundles`` are those of ``codes``, if at hand."""
    n, p = codes.shape
    every = chosen >= p
    if every and bundles is None:
        bundles = bundled(codes)
    bins = codes.max(axis=0, initial=0).astype(np.int64) + 1
    feature, code, left, right, value, gain = ([] for _ in range(6))
    rows = np.flatnonzero(w > 0)
    if len(rows) < n and every:                                  # without draws the rows stay in their order
        kept = rows
        codes, y, w, bundles = codes[kept], y[kept], w[kept], [(c, k, joint[kept]) for c, k, joint in bundles]
        n, rows = len(kept), np.arange(len(kept))
    flat, wy = codes.ravel(order="F"), w * y
    squares, sums = wy * y, _Sums(w, wy)
    binary = np.array_equal(squares, wy)
    at, first, nodes = np.zeros(len(rows), np.int64), 0, 1
    for depth in range(max_depth + 1):
        values = sums.of(rows) if every else [None if v is None else v[rows] for v in sums.values]
        sw, sy = sums.at(values, at, nodes)
        s2 = sy if binary else np.bincount(at, squares if every and len(rows) == n else squares[rows], nodes)
        error = s2 - sy * sy / np.maximum(sw, 1e-300)
        value.append(sy / np.maximum(sw, 1e-300))
        best_gain, best_f, best_c = np.zeros(nodes), np.full(nodes, -1), np.zeros(nodes, np.int64)
        # rows of nodes that are pure or too light to split are done
        able = (error > pure * np.maximum(s2, 1e-300)) & (sw >= 2 * least) & (depth < max_depth)
        if not able.all():
            live = able[at]
            rows, at, values = rows[live], at[live], [None if v is None else v[live] for v in values]
        if len(rows):
            # the nodes that may split, by their place among them
            alive = np.flatnonzero(able)
            place, n_live = at if len(alive) == nodes else (np.cumsum(able) - 1)[at], len(alive)
            if every and max(math.prod(sizes) for _, sizes, _ in bundles) * n_live <= DENSE * len(rows):
                drawn, cells = None, _cells_of_bundles(bundles, rows, place, n_live, sums, values)
            else:
                drawn = (np.broadcast_to(np.arange(p), (n_live, p)) if every
                         else np.argpartition(rng.random((nodes, p))[alive], chosen - 1, axis=1)[:, :chosen])
                cells = _cells_of_nodes(flat, n, bins, drawn, rows, place, n_live, sums, values)
            for j, (cw, cy, node, own) in cells:
                start = np.flatnonzero(np.append(True, node[1:] != node[:-1]))
                span = np.diff(np.append(start, len(node)))
                lw, ly = np.cumsum(cw), np.cumsum(cy)
                lw -= np.repeat(np.append(0.0, lw)[start], span)
                ly -= np.repeat(np.append(0.0, ly)[start], span)
                real = alive[node]
                rest = sw[real] - lw
                ok = (lw >= least) & (rest >= least)
                ok[start[1:] - 1] = ok[-1] = False                   # the last code of a node splits nothing off
                ok = np.flatnonzero(ok)
                if not len(ok):
                    continue
                of, lw, ly, rest = real[ok], lw[ok], ly[ok], rest[ok]
                tw, ty = sw[of], sy[of]
                g = ly ** 2 / lw + (ty - ly) ** 2 / rest - ty ** 2 / tw
                # the first of the largest gains of every node; nodes and codes rise together
                start = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
                most = np.repeat(np.maximum.reduceat(g, start), np.diff(np.append(start, len(of))))
                top = np.flatnonzero(g == most)
                top = top[np.append(True, of[top][1:] != of[top][:-1])]
                top = top[g[top] > best_gain[of[top]] + 1e-12 * np.abs(sy[of[top]])]
                of = of[top]
                best_gain[of], best_c[of] = g[top], own[ok[top]]
                best_f[of] = j if drawn is None else drawn[node[ok[top]], j]
        split = best_f >= 0
        child = np.cumsum(split) - 1
        below = first + nodes
        feature.append(best_f)
        code.append(best_c)
        left.append(np.where(split, below + 2 * child, -1))
        right.append(np.where(split, below + 2 * child + 1, -1))
        gain.append(best_gain)
        if len(at) and not split.all():
            keep = split[at]
            rows, at = rows[keep], at[keep]
        at = 2 * child[at] + (flat[(best_f * n)[at] + rows] > best_c[at])
        first, nodes = below, int(2 * split.sum())
        if not nodes:
            break
        if not every:
            o = _by_node(at, nodes)
            rows, at = rows[o], at[o]
    return {k: np.concatenate(v) for k, v in (("feature", feature), ("code", code), ("left", left), ("right", right), ("value", value), ("gain", gain))}


def _by_node(at: np.ndarray, nodes: int) -> np.ndarray:
    """Rows by node, those of one as they come."""
    if nodes <= 1 << 16:
        return np.argsort(at.astype(np.uint16), kind="stable")
    low = np.argsort((at & 0xFFFF).astype(np.uint16), kind="stable")
    return low[np.argsort((at[low] >> 16).astype(np.uint16), kind="stable")]


def _cells_of_bundles(bundles, rows, place, nodes, sums, values) -> list:
    """(column, (weights, sums, place, code) of its occupied cells) of all columns, from one pass a bundle."""
    found = {}
    for cols, sizes, joint in bundles:
        size = math.prod(sizes)
        key = place * size
        key += joint if len(rows) == len(joint) else joint[rows]
        cw, cy = (v.reshape(nodes, *sizes) for v in sums.at(values, key, nodes * size))
        for i, j in enumerate(cols):
            others = tuple(a + 1 for a in range(len(cols)) if a != i)
            jw, jy = cw.sum(axis=others).ravel(), cy.sum(axis=others).ravel()
            at = np.flatnonzero(jw)
            found[j] = jw[at], jy[at], at // sizes[i], at % sizes[i]
    return sorted(found.items())


def _cells_of_nodes(flat, n, bins, drawn, rows, place, nodes, sums, values) -> Iterator:
    """(number of the draw, (weights, sums, place, code) of the occupied cells) of the columns drawn for every node;
    ``flat`` has the codes of the ``n`` rows by column."""
    ordered = bool((place[1:] >= place[:-1]).all())
    count, names = np.bincount(place, minlength=nodes), np.arange(nodes)

    def by_row(of_node):
        return np.repeat(of_node, count) if ordered else of_node[place]

    for j in range(drawn.shape[1]):
        size = bins[drawn[:, j]]
        first = np.cumsum(size) - size
        total = int(first[-1] + size[-1])
        at = by_row(drawn[:, j] * n)
        at += rows
        own = flat[at]
        if total <= DENSE * len(rows):
            # sums by cell
            key = by_row(first)
            key += own
            cw, cy = sums.at(values, key, total)
            at = np.flatnonzero(cw)
            node = np.repeat(names, size)[at]
            yield j, (cw[at], cy[at], node, at - first[node])
        else:
            # many cells, few rows: sums of the rows in order of node and code
            o = _order(place, own, nodes)
            node, own = place[o], own[o]
            start = np.flatnonzero(np.append(True, (own[1:] != own[:-1]) | (node[1:] != node[:-1])))
            yield j, (*sums.runs(values, o, start), node[start], own[start].astype(np.int64))


_CHUNK = "row binary, fold binary, y binary, codes binary"


def _chunk(b: pa.RecordBatch, names: Sequence[str], edges: list[np.ndarray]) -> dict[str, list]:
    """A batch as one row: its numbers, folds, labels and, column after column, codes."""
    numbers = [b.column(c).to_numpy(zero_copy_only=False).astype(kind).tobytes() for c, kind in (("__row", np.int64), ("__fold", np.int64), ("__y", float))]
    return {k: [v] for k, v in zip(("row", "fold", "y", "codes"), (*numbers, encode(columns(b, names), edges).T.tobytes()))}


def _asked(df: DataFrame, names: Sequence[str], label: str, fold: str) -> DataFrame:
    return df.select(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).alias("__row"), F.col(fold).cast("long").alias("__fold"),
                     F.col(label).cast("double").alias("__y"), *[F.col(f"`{c}`").cast("double").alias(c) for c in names])


def coded(df: DataFrame, features: Sequence[str], edges: list[np.ndarray], label: str = "label", fold: str = "FOLD") -> DataFrame:
    """Saved table of the rows' codes, a batch of rows in each of its rows, so that copies of it are small."""
    names = list(features)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_pydict(_chunk(b, names, edges))

    return materialise(_asked(df, names, label, fold).mapInArrow(run, _CHUNK), "coded")


def _matrix(table: pa.Table, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, fold, y, codes by column) of a group, in the order of the rows, so that results do not depend on the shuffle."""
    row, fold, y = (np.frombuffer(b"".join(table.column(c).to_pylist()), kind) for c, kind in (("row", np.int64), ("fold", np.int64), ("y", float)))
    codes = np.concatenate([np.frombuffer(c, np.uint8).reshape(width, -1) for c in table.column("codes").to_pylist()], axis=1)
    o = np.lexsort((y, row))
    return row[o], fold[o], y[o], codes[:, o].T


def _number_chosen(regression: bool, features: int) -> int:
    """Columns a node looks at: a third of them, or their square root (fixed rules of Spark ML's forests)."""
    return max(1, -(-features // 3) if regression else math.ceil(math.sqrt(features)))


def search(train: DataFrame, features: Sequence[str], regression: bool, sizes: Sequence[int], depths: Sequence[int], leasts: Sequence[float],
           folds: Sequence[int], seed: int = 42) -> dict[tuple[int, int, float], list[float]]:
    """Accuracy or R2 by fold of every (size, depth, least weight of a node)."""
    edges = edges_of(train, features)
    table = coded(train, features, edges)
    groups = -(-max(sizes) // TOGETHER)
    width, chosen, n_folds = len(features), _number_chosen(regression, len(features)), list(folds)
    depths, leasts = list(depths), list(leasts)
    ends = [min(groups, -(-s // TOGETHER)) for s in sizes]
    if any(s % TOGETHER for s in sizes):
        raise ValueError(f"numbers of trees are multiples of {TOGETHER}")

    def score(key, rows):
        fold, group = n_folds[key[0].as_py() // groups], key[0].as_py() % groups
        row, own, y, codes = _matrix(rows, width)
        held = own == fold
        asked = np.ascontiguousarray(codes[held])
        total = np.zeros((len(leasts), len(depths), len(asked)))
        for t in range(group * TOGETHER, (group + 1) * TOGETHER):
            w = np.where(held, 0.0, weights_of(row, t, seed))
            for v, least in enumerate(leasts):
                tree = grow(codes, y, w, chosen, least, max(depths), np.random.default_rng([seed, t, v]))
                one = Trees(np.array([0]), np.ones(1), tree["feature"], tree["code"].astype(float), tree["left"], tree["right"], tree["value"])
                total[v] += one.staged(asked, depths, [1])[0]
        # the rows of a fold have the same order in all of its groups
        cuts = range(0, len(asked), SLICE)
        return pa.table({"fold": pa.array([fold] * len(cuts), pa.int64()), "slice": pa.array(list(cuts), pa.int64()), "grp": pa.array([group] * len(cuts), pa.int64()),
                         "y": pa.array([y[held][i:i + SLICE].tobytes() for i in cuts], pa.binary()),
                         "a": pa.array([total[..., i:i + SLICE].tobytes() for i in cuts], pa.binary())})

    def tally(key, rows):
        rows = rows.sort_by("grp")
        y = np.frombuffer(rows.column("y")[0].as_py(), float)
        sums = np.cumsum([np.frombuffer(a, float).reshape(len(leasts), len(depths), -1) for a in rows.column("a").to_pylist()], axis=0)
        found = [float(len(y)), float(y.sum()), float((y * y).sum())]
        for size, end in zip(sizes, ends):
            f = sums[end - 1] / size
            found += (((f - y) ** 2) if regression else ((f > 0.5) != (y > 0))).sum(axis=-1, dtype=float).ravel().tolist()
        return pa.table({"k": pa.array([key[0].as_py()], pa.int64()), "a": pa.array([found], pa.list_(pa.float64()))})

    dealt = table.withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(len(n_folds) * groups - 1))))
    many = max(1, len(n_folds) * groups)
    parts = dealt.repartitionByRange(many, "g").groupBy("g").applyInArrow(score, "fold long, slice long, grp long, y binary, a binary")
    found = summed(parts.groupBy("fold", "slice").applyInArrow(tally, "k long, a array<double>"))
    out = {}
    for i, size in enumerate(sizes):
        for v, least in enumerate(leasts):
            for d, depth in enumerate(depths):
                at = 3 + (i * len(leasts) + v) * len(depths) + d
                out[size, depth, least] = [1 - found[f][at] / (found[f][2] - found[f][1] ** 2 / found[f][0] if regression else found[f][0]) for f in n_folds]
    return out


def _boosted(codes: np.ndarray, y: np.ndarray, held: np.ndarray, step: float, rounds: int, depth: int, marks: Sequence[int] = ()):
    """(first prediction, trees, predictions of the held rows after the marked rounds): squared error, the mean first."""
    own = ~held
    base = float(y[own].sum() / own.sum()) if own.any() else 0.0
    train, codes = np.asfortranarray(codes[own]), np.ascontiguousarray(codes)
    ones, bundles = np.ones(len(train)), bundled(train)
    f = np.full(len(y), base)
    out, seen = [], []
    for r in range(1, rounds + 1):
        tree = grow(train, (y - f)[own], ones, codes.shape[1], 1.0, depth, np.random.default_rng(0), bundles=bundles)
        one = Trees(np.array([0]), np.array([step]), tree["feature"], tree["code"].astype(float), tree["left"], tree["right"], tree["value"])
        f += one.staged(codes, [depth], [1])[0, 0]
        out.append(tree)
        if r in marks:
            seen.append(f[held].copy())
    return base, out, seen


def boost_numbers(train: DataFrame, features: Sequence[str], rounds: Sequence[int], steps: Sequence[float], depth: int, folds: Sequence[int],
                  label: str = "label", fold: str = "FOLD") -> tuple[dict[tuple[int, float], list[float]], Callable[[int, float], Forest]]:
    """R2 by fold of every (number of rounds, learning rate), and the model of such a pair on all rows.

    The sets without a fold and the set of all rows are grown side by side, a task each; fewer rounds are the first of more."""
    edges = edges_of(train, features)
    first = len(folds) * len(steps)
    table = coded(train, features, edges, label, fold) if first else None
    whole = coded(train.withColumn("__none", F.lit(-1)), features, edges, label, "__none")      # its rows have an order of their own
    width, marks = len(features), sorted(rounds)
    points = [(f, s) for f in (*folds, None) for s in steps]

    def score(key, rows):
        g = key[0].as_py()
        f, step = points[g]
        _, own, y, codes = _matrix(rows, width)
        held = np.zeros(len(y), bool) if f is None else own == f
        base, trees, seen = _boosted(codes, y, held, step, max(marks), depth, marks)
        if f is None:
            return _listed([(t, base, x) for t, x in enumerate(trees)]).add_column(0, "g", pa.array([g] * len(trees), pa.int64()))
        # a fold's row has its misses by mark and the sums of its labels as values
        t, blank = y[held], {c: np.zeros(0) for c in _PARTS}
        sums = [float(((s - t) ** 2).sum()) for s in seen] + [float(len(t)), float(t.sum()), float((t * t).sum())]
        return _listed([(-1, base, {**blank, "value": np.array(sums)})]).add_column(0, "g", pa.array([g], pa.int64()))

    dealt = [t.withColumn("g", F.explode(F.sequence(F.lit(a), F.lit(b - 1)))) for t, a, b in ((table, 0, first), (whole, first, len(points))) if a < b]
    found = reduce(DataFrame.unionByName, dealt).repartitionByRange(len(points), "g").groupBy("g").applyInArrow(score, f"g long, {_TREE}").collect()
    scores = {}
    for r in found:
        if r["tree"] < 0:
            *miss, n, s, q = r["value"]
            scores[points[r["g"]]] = [1 - m / (q - s ** 2 / n) for m in miss]

    def model(size: int, step: float) -> Forest:
        own = points.index((None, step))
        return _assembled([r for r in found if r["g"] == own and r["tree"] < size], features, edges, True, step)

    return {(m, s): [scores[f, s][i] for f in folds] for i, m in enumerate(marks) for s in steps}, model


def search_boosted(train: DataFrame, features: Sequence[str], rounds: Sequence[int], steps: Sequence[float], depth: int,
                   folds: Sequence[int]) -> dict[tuple[int, float], list[float]]:
    """R2 by fold of every (number of rounds, learning rate)."""
    return boost_numbers(train, features, rounds, steps, depth, folds)[0]


def split_points(values: np.ndarray, bins: int) -> np.ndarray:
    """Spark ML's split points of a column, from all of its values: the middles between
    neighbouring values, or those nearest to equal counts where these are more than the bins."""
    value, count = np.unique(values, return_counts=True)
    middle = (value[:-1] + value[1:]) / 2
    splits = min(bins, len(values)) - 1
    if len(middle) <= splits:
        return middle
    stride = len(values) / (splits + 1)
    out, target = [], stride
    seen = np.cumsum(count).tolist()
    for before, now, at in zip(seen[:-1], seen[1:], middle.tolist()):
        if abs(before - target) < abs(now - target):
            out.append(at)
            target += stride
    return np.array(out)


def _splits_by_set(train: DataFrame, features: Sequence[str], sets: Sequence[int | None], fold: str) -> list[list[np.ndarray]]:
    """Split points by set of training rows (all but a fold, or all) and column; one group of rows a column."""
    names, sets = list(features), list(sets)

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, own = columns(b, names), b.column("__fold").to_numpy().astype(np.int64).tobytes()
            if np.isnan(x).any():
                raise ValueError("a feature is null or not a number")
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(names))), pa.array([own] * len(names), pa.binary()),
                                              pa.array([x[:, j].tobytes() for j in range(len(names))], pa.binary())], ["c", "fold", "x"])

    def points(key, rows):
        own = np.frombuffer(b"".join(rows.column("fold").to_pylist()), np.int64)
        x = np.frombuffer(b"".join(rows.column("x").to_pylist()), np.float64)
        found = [split_points(x if f is None else x[own != f], CLASS_BINS).tolist() for f in sets]
        return pa.table({"c": [key[0].as_py()], "points": pa.array([found], pa.list_(pa.list_(pa.float64())))})

    asked = train.select(F.col(fold).cast("long").alias("__fold"), *[F.col(f"`{c}`").cast("double").alias(c) for c in names])
    rows = asked.mapInArrow(across, "c long, fold binary, x binary").groupBy("c").applyInArrow(points, "c long, points array<array<double>>").collect()
    found = {r["c"]: r["points"] for r in rows}
    return [[np.array(found[j][i], float) for j in range(len(names))] for i in range(len(sets))]


def _chance(f: np.ndarray) -> np.ndarray:
    """Probability of class 1 from half its log odds."""
    return 1 / (1 + np.exp(np.clip(-2 * f, -700, 700)))


def _boosted_classes(codes: np.ndarray, y: np.ndarray, held: np.ndarray, step: float, rounds: int, depth: int, marks: Sequence[int]):
    """(trees, margins of the held rows after the marked rounds): logistic loss as Spark ML's, a first tree
    of the labels -1 and 1, then trees of the loss's falling gradient, weighed by ``step``."""
    sign, own = 2 * y - 1, ~held
    train, codes = np.asfortranarray(codes[own]), np.ascontiguousarray(codes)
    ones, bundles = np.ones(len(train)), bundled(train)
    f = np.zeros(len(y))
    out, seen = [], []
    for r in range(1, rounds + 1):
        target = sign if r == 1 else 4 * sign / (1 + np.exp(np.clip(2 * sign * f, -700, 700)))
        tree = grow(train, target[own], ones, codes.shape[1], 1.0, depth, np.random.default_rng(0), pure=1e-15, bundles=bundles)
        one = Trees(np.array([0]), np.array([1.0 if r == 1 else step]), tree["feature"], tree["code"].astype(float), tree["left"], tree["right"], tree["value"])
        f += one.staged(codes, [depth], [1])[0, 0]
        out.append(tree)
        if r in marks:
            seen.append(f[held].copy())
    return out, seen


def boost_classes(train: DataFrame, features: Sequence[str], rounds: Sequence[int], step: float, depth: int, folds: Sequence[int],
                  label: str = "label", fold: str = "FOLD") -> tuple[dict[int, list[float]], Callable[[int], Forest]]:
    """Accuracy by fold of every number of rounds, and the model of a number of rounds on all rows.

    The sets without a fold and the set of all rows are grown side by side, a task each;
    fewer rounds are the first of more.  Every set has split points of its own."""
    names, sets, marks = list(features), [*folds, None], sorted(rounds)
    edges, width = _splits_by_set(train, names, sets, fold), len(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for g, e in enumerate(edges if b.num_rows else []):
                yield pa.RecordBatch.from_pydict({"g": [g], **_chunk(b, names, e)})

    def score(key, rows):
        g = key[0].as_py()
        _, own, y, codes = _matrix(rows, width)
        held = np.zeros(len(y), bool) if sets[g] is None else own == sets[g]
        trees, seen = _boosted_classes(codes, y, held, step, max(marks), depth, marks)
        if sets[g] is None:
            return _listed([(t, 0.0, x) for t, x in enumerate(trees)]).add_column(0, "g", pa.array([g] * len(trees), pa.int64()))
        # a fold's row has its misses by mark as values, its number of rows as base
        miss = np.array([float(((s > 0) != (y[held] > 0)).sum()) for s in seen])
        blank = {c: np.zeros(0) for c in _PARTS}
        return _listed([(-1, float(held.sum()), {**blank, "value": miss})]).add_column(0, "g", pa.array([g], pa.int64()))

    table = materialise(_asked(train, names, label, fold).mapInArrow(run, f"g long, {_CHUNK}"), "coded")
    found = table.repartitionByRange(len(sets), "g").groupBy("g").applyInArrow(score, f"g long, {_TREE}").collect()
    by_set = {r["g"]: r for r in found if r["tree"] < 0}
    grown = [r for r in found if r["tree"] >= 0]
    scores = {m: [1 - by_set[g]["value"][i] / by_set[g]["base"] if by_set[g]["base"] else math.nan for g in range(len(sets) - 1)]
              for i, m in enumerate(marks)}

    def model(size: int) -> Forest:
        return _assembled([r for r in grown if r["tree"] < size], names, edges[-1], False, np.array([1.0] + [step] * (size - 1)), margin=True)

    return scores, model


class Forest:
    """Grown trees on raw columns: a first value and the trees' weighted sum; for classes
    the share of class 1 or, if ``margin``, half its log odds."""

    def __init__(self, features: list[str], trees: Trees, regression: bool, gains: np.ndarray, base: float = 0.0, margin: bool = False):
        self.features, self.trees, self.regression, self.gains, self.base, self.margin = features, trees, regression, gains, base, margin

    def importances(self) -> list[float]:
        return self.gains.tolist()

    def transform(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        """``keep`` and the prediction (for classes 0 or 1, and the probability of 1)."""
        shared, features, regression, base = df.sparkSession.sparkContext.broadcast(self.trees), self.features, self.regression, self.base
        margin = self.margin
        kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema.fields)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            trees = shared.value
            for b in batches:
                f = base + trees.staged(columns(b, features), [1 << 10], [len(trees.roots)])[0, 0]
                if margin:
                    f = _chance(f)
                more = [pa.array(f)] if regression else [pa.array((f > 0.5).astype(np.int32)), pa.array(np.clip(f, 0, 1))]
                yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keep], *more], [*keep, "prediction", *([] if regression else ["probability"])])

        return df.select(*dict.fromkeys([*keep, *features])).mapInArrow(run, f"{kept}, prediction " + ("double" if regression else "int, probability double"))


_PARTS = ("feature", "code", "left", "right", "value", "gain")
_TREE = "tree long, base double, " + ", ".join(f"{c} array<double>" for c in _PARTS)


def _listed(trees: list[tuple[int, float, dict]]) -> pa.Table:
    return pa.table({"tree": pa.array([t for t, _, _ in trees], pa.int64()), "base": pa.array([b for _, b, _ in trees], pa.float64()),
                     **{c: pa.array([x[c].astype(float).tolist() for _, _, x in trees], pa.list_(pa.float64())) for c in _PARTS}})


def _assembled(found: list, features: Sequence[str], edges: list[np.ndarray], regression: bool, weight: float | np.ndarray, margin: bool = False) -> Forest:
    """The model of the trees' rows; ``weight``: of every tree, or one of each."""
    found = sorted(found, key=lambda r: r["tree"])
    feature, code, left, right, value, gain = (np.concatenate([np.array(r[c]) for r in found]) for c in _PARTS)
    size_of = np.array([len(r["feature"]) for r in found])
    first = np.cumsum(size_of) - size_of
    offset, at, width = np.repeat(first, size_of), feature.astype(int), len(features)
    threshold = np.array([edges[f][int(c)] if f >= 0 else 0.0 for f, c in zip(at.tolist(), code.tolist())])
    gains = np.zeros(width)
    for a, n in zip(first.tolist(), size_of.tolist()):                # every tree's gains sum to 1, then the model's
        inner = at[a:a + n] >= 0
        g = np.bincount(at[a:a + n][inner], gain[a:a + n][inner], width)
        gains += g / g.sum() if g.sum() else 0.0
    gains = gains / gains.sum() if gains.sum() else gains
    shifted = [np.where(x >= 0, x + offset, -1).astype(int) for x in (left, right)]
    weights = np.broadcast_to(np.asarray(weight, float), len(first)).copy()
    return Forest(list(features), Trees(first, weights, at, threshold, *shifted, value), regression, gains, found[0]["base"], margin)


def fit_boosted(train: DataFrame, features: Sequence[str], rounds: int, step: float, depth: int, label: str = "label") -> Forest:
    """Boosted trees on all rows."""
    return boost_numbers(train.withColumn("__none", F.lit(-1)), features, [rounds], [step], depth, [], label, "__none")[1](rounds, step)


def fit(train: DataFrame, features: Sequence[str], regression: bool, size: int, depth: int, least: float, label: str = "label",
        seed: int = 42) -> Forest:
    """A forest of ``size`` trees on all rows."""
    edges = edges_of(train, features)
    table = coded(train.withColumn("__none", F.lit(-1)), features, edges, label, "__none")
    groups, width, chosen = -(-size // TOGETHER), len(features), _number_chosen(regression, len(features))

    def trees(key, rows):
        row, _, y, codes = _matrix(rows, width)
        return _listed([(t, 0.0, grow(codes, y, weights_of(row, t, seed), chosen, least, depth, np.random.default_rng([seed, t, 0])))
                        for t in range(key[0].as_py() * TOGETHER, min(size, (key[0].as_py() + 1) * TOGETHER))])

    dealt = table.withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    found = dealt.repartitionByRange(groups, "g").groupBy("g").applyInArrow(trees, _TREE).collect()
    return _assembled(found, features, edges, regression, 1.0 / size)
