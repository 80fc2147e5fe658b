"""Margin models fitted by Newton steps on derivatives that Spark aggregates: logistic regression, support vectors, Platt's sigmoid.

All models of a grid, its folds included, are fitted side by side: a pass over
the rows yields each model's loss, gradient and Hessian (sums, combined within
a task first), the driver takes the Newton steps, and a model that would climb
halves its step.  The hinge and the tube of support vectors are smoothed over a
width that shrinks by stages, so every step has a Hessian; the kernel form uses
random Fourier features of the standardised columns, whose number is a
parameter.  What comes to the driver is of the size of the models, not of the data.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duelframe.operators.gram import Products, columns, summed
from duelframe.session import materialise

WAVES = 200                    # random Fourier features of a kernel model
WIDTHS = (2.0, 0.5, 0.1, 0.02) # stages of the smoothing width, as shares of a problem's scale
PASSES = 60                    # most passes over the rows
CURVED = 200_000               # rows that suffice for the Hessian of a width but the last, which only finds a start
LOOSE = 1e-6                   # share of the objective that a step may still gain when a width but the last is left


# -- losses: value, first and second derivative in the decision f -------------------

def _logistic(f: np.ndarray, y: np.ndarray, width: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    m = y * f
    p = 1 / (1 + np.exp(np.clip(m, -700, 700)))
    return np.logaddexp(0, -m), -y * p, p * (1 - p)


def _ramp(t: np.ndarray, width: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """max(0, t), rounded between -width and width."""
    inner = np.abs(t) < width
    value = np.where(inner, (t + width) ** 2 / (4 * width), np.maximum(t, 0.0))
    slope = np.where(inner, (t + width) / (2 * width), (t > 0).astype(float))
    return value, slope, inner / (2 * width)


def _hinge(f, y, width):
    v, s, c = _ramp(1 - y * f, width)
    return v, -y * s, c


def _beyond(f, y, width):
    """How far a decision is below 0 (one class)."""
    v, s, c = _ramp(-f, width)
    return v, -s, c


def _tube(eps: float):
    def loss(f, y, width):
        (v, s, c), (u, t, d) = _ramp(f - y - eps, width), _ramp(y - f - eps, width)
        return v + u, s - t, c + d
    return loss


def _loss(name: str, eps: float):
    return {"logistic": _logistic, "hinge": _hinge, "one_class": _beyond, "tube": _tube(eps)}[name]


# -- models --------------------------------------------------------------------------

@dataclass(frozen=True)
class FeatureMap:
    """Standardised columns, or random Fourier features of them."""
    mean: np.ndarray
    std: np.ndarray
    omega: np.ndarray | None = None
    phase: np.ndarray | None = None

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.mean) / self.std
        return z if self.omega is None else math.sqrt(2 / len(self.phase)) * np.cos(z @ self.omega.T + self.phase)

    @property
    def width(self) -> int:
        return len(self.mean) if self.omega is None else len(self.phase)


def feature_map(p: Products, without: int | None = None, kernel: str = "linear", gamma: float | None = None, waves: int = WAVES, seed: int = 42) -> FeatureMap:
    """The map standardised by all rows but those of a fold; gamma is one over the number of columns unless given."""
    a = p.total(without)
    n = a[0, 0]
    mean = a[0, 1:-1] / n
    std = np.sqrt(np.maximum(np.diag(a)[1:-1] / n - mean ** 2, 0))
    std = np.where(std > 1e-12 * (1 + np.abs(mean)), std, 1.0)
    mean = mean + p.shift[:-1]
    if kernel == "linear":
        return FeatureMap(mean, std)
    rng = np.random.default_rng(seed)
    omega = rng.normal(0, math.sqrt(2 * (gamma or 1 / max(1, len(mean)))), (waves, len(mean)))
    return FeatureMap(mean, std, omega, rng.uniform(0, 2 * math.pi, waves))


@dataclass
class Problem:
    """One model to fit: min |w|^2 / 2 + cost * (sum of losses), on all rows but those of a fold."""
    map: FeatureMap
    cost: float
    loss: str = "logistic"                  # labels 1 and 0 (logistic, hinge), numbers (tube), none (one_class)
    fold: int | None = None
    eps: float = 0.1                        # half the width of the tube
    scale: float = 1.0                      # size of the decisions, in which the smoothing widths are given
    keep_intercept: bool = False            # whether the intercept is penalised too
    start: np.ndarray | None = None


def one_class_problem(p: Products, nu: float, rows: int, gamma: float | None = None, waves: int = WAVES, seed: int = 42) -> Problem:
    """The one-class support vector machine: min |w|^2 / 2 - rho + (sum of rho - w . map(x) where above 0) / (nu rows);
    the decision is w . map(x) - rho, and about the share ``nu`` of the rows is below 0."""
    return Problem(feature_map(p, None, "rbf", gamma, waves, seed), 1 / (nu * rows), "one_class", scale=0.05)


@dataclass
class Margin:
    """A fitted decision function: f(x) = w . map(x) + b."""
    features: list[str]
    map: FeatureMap
    weights: np.ndarray
    intercept: float
    objective: float
    gradient: float                         # largest part of the gradient at the end
    platt: tuple[float, float] | None = field(default=None)

    def decide(self, x: np.ndarray) -> np.ndarray:
        return self.map(x) @ self.weights + self.intercept

    def importances(self) -> list[float] | None:
        """Absolute weights of the standardised columns (none for a kernel)."""
        return np.abs(self.weights).tolist() if self.map.omega is None else None

    def transform(self, df: DataFrame, keep: Sequence[str], kind: str) -> DataFrame:
        """``keep`` and the model's ``decision``; ``prediction`` by ``kind``: "class" (decision above 0, with its
        ``probability``), "number" or "decision" (none)."""
        extra = {"class": ", prediction int, probability double", "number": ", prediction double", "decision": ""}[kind]
        kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema.fields)
        names = list(dict.fromkeys([*keep, *self.features]))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                f = self.decide(columns(b, self.features))
                out = [*[b.column(c) for c in keep], pa.array(f)]
                if kind == "class":
                    s, t = self.platt or (1.0, 0.0)
                    out += [pa.array((f > 0).astype(np.int32)), pa.array(1 / (1 + np.exp(-np.clip(s * f + t, -700, 700))))]
                elif kind == "number":
                    out += [pa.array(f)]
                yield pa.RecordBatch.from_arrays(out, [*keep, "decision", *(["prediction"] if kind != "decision" else []),
                                                       *(["probability"] if kind == "class" else [])])

        return df.select(*names).mapInArrow(run, f"{kept}, decision double{extra}")


def _signs(name: str, y: np.ndarray) -> np.ndarray:
    return 2.0 * (y > 0) - 1.0 if name in ("logistic", "hinge") else y


def _derivatives(rows: DataFrame, features: Sequence[str], label: str, problems: list[Problem], at: dict[int, np.ndarray],
                 width: dict[int, float], every: dict[int, int]) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """(loss, gradient, Hessian) of every model in ``at``, penalties included; the Hessian from every so many rows."""
    names, todo = list(features), [(k, problems[k], at[k], width[k], every[k]) for k in at]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {k: np.zeros(1 + len(w) + len(w) ** 2) for k, _, w, _, _ in todo}
        for b in batches:
            x, y = columns(b, names), b.column(label).to_numpy(zero_copy_only=False).astype(float)
            folds = b.column("__fold").to_numpy(zero_copy_only=False)
            mapped: dict[tuple, tuple] = {}                   # models of one fold share the features of its rows
            for k, p, w, h, nth in todo:
                if (at_hand := mapped.get((id(p.map), p.fold))) is None:
                    use = slice(None) if p.fold is None else folds != p.fold
                    own = x[use]
                    at_hand = mapped[id(p.map), p.fold] = np.column_stack([p.map(own), np.ones(len(own))]), y[use]
                z, t = at_hand[0], _signs(p.loss, at_hand[1])
                v, d, c = _loss(p.loss, p.eps)(z @ w, t, h)
                some, c = z[::nth], nth * c[::nth]
                curved = c > 0
                root = (some if curved.all() else some[curved]) * np.sqrt(c[curved])[:, None]
                hess = root.T @ root
                total[k] += p.cost * np.concatenate([[v.sum()], z.T @ d, hess.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.list_(pa.float64()))], ["k", "a"])

    out = {}
    for k, a in summed(rows.mapInArrow(run, "k long, a array<double>")).items():
        w, p, n = at[k], problems[k], len(at[k])
        own = np.ones(n)
        own[-1] = 1.0 if p.keep_intercept else 0.0
        linear = np.zeros(n)
        linear[-1] = 1.0 if p.loss == "one_class" else 0.0    # the offset's part of the one-class objective
        out[k] = (a[0] + (own * w * w).sum() / 2 + linear @ w, a[1:n + 1] + own * w + linear, a[n + 1:].reshape(n, n) + np.diag(own))
    return out


def minimise(df: DataFrame, features: Sequence[str], problems: list[Problem], label: str = "label", fold: str | None = None,
             widths: Sequence[float] = WIDTHS, passes: int = PASSES, tol: float = 1e-12) -> list[Margin]:
    """Fit all problems side by side; the rows are read once a pass.

    ``df`` is read again in every pass, so it should be a saved table."""
    number = F.lit(-1) if fold is None else F.col(fold)
    rows = df.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in features], F.col(label).cast("double").alias(label),
                     number.cast("long").alias("__fold"))
    stages = {k: (tuple(w * p.scale for w in widths) if p.loss != "logistic" else (1.0,)) for k, p in enumerate(problems)}
    stage = dict.fromkeys(stages, 0)
    best = {k: np.zeros(p.map.width + 1) if p.start is None else p.start.copy() for k, p in enumerate(problems)}
    tried, held, move, step = dict(best), {}, {}, {}
    open_ = set(best)
    # all rows count in every loss and gradient, and in the Hessians of the last width
    nth = max(1, rows.count() // CURVED)
    for _ in range(passes):
        if not open_:
            break
        got = _derivatives(rows, features, label, problems, {k: tried[k] for k in sorted(open_)}, {k: stages[k][stage[k]] for k in open_},
                           {k: 1 if stage[k] + 1 == len(stages[k]) else nth for k in open_})
        for k, (value, gradient, hessian) in got.items():
            if k in move and value > held[k][0] + 1e-4 * step[k] * (held[k][1] @ move[k]) + 1e-12 * abs(held[k][0]):
                step[k] /= 2
                # steps that rounding alone turns down are not halved for long
                if step[k] > (1e-4 if -(held[k][1] @ move[k]) > 1e-8 * max(1.0, abs(held[k][0])) else 0.2):
                    tried[k] = best[k] + step[k] * move[k]
                    continue
                tried[k] = best[k]                           # no way down is left at this width
                value, gradient, hessian = held[k]
                finished = True
            else:
                finished = False
            best[k], held[k] = tried[k], (value, gradient, hessian)
            ease = 1e-10 * (1 + np.trace(hessian) / len(gradient))
            down = -np.linalg.solve(hessian + ease * np.eye(len(gradient)), gradient)
            last = stage[k] + 1 == len(stages[k])
            if finished or -(gradient @ down) <= (tol if last else LOOSE) * max(1.0, abs(value)):
                move.pop(k, None)
                if not last:
                    stage[k] += 1                            # the next width starts where this one ended
                    continue
                open_.discard(k)
                continue
            move[k], step[k] = down, 1.0
            tried[k] = best[k] + down
    return [Margin(list(features), p.map, best[k][:-1], float(best[k][-1]), float(held[k][0]), float(np.abs(held[k][1]).max()))
            for k, p in enumerate(problems)]


def fold_scores(df: DataFrame, models: list[Margin], folds: list[int], label: str = "label", fold: str = "FOLD", kind: str = "class") -> list[float]:
    """Each model's accuracy ("class") or R2 ("number") on the rows of its fold, in one pass."""
    features = models[0].features

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(models), 4))
        for b in batches:
            x, y = columns(b, features), b.column("__y").to_numpy(zero_copy_only=False)
            own = b.column("__fold").to_numpy(zero_copy_only=False)
            for k, (m, f) in enumerate(zip(models, folds)):
                at = own == f
                d, t = m.decide(x[at]), y[at]
                miss = ((d > 0) != (t > 0)).sum() if kind == "class" else ((t - d) ** 2).sum()
                total[k] += [len(t), t.sum(), (t * t).sum(), miss]
        yield pa.RecordBatch.from_arrays([pa.array([0], pa.int64()), pa.array([total.ravel()], pa.list_(pa.float64()))], ["k", "a"])

    rows = df.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in features], F.col(label).cast("double").alias("__y"), F.col(fold).cast("long").alias("__fold"))
    n, s, q, miss = summed(rows.mapInArrow(run, "k long, a array<double>"))[0].reshape(-1, 4).T
    return (1 - miss / n if kind == "class" else 1 - miss / (q - s * s / n)).tolist()


def platt(df: DataFrame, models: list[Margin], folds: list[int], label: str = "label", fold: str = "FOLD", passes: int = PASSES) -> tuple[float, float]:
    """Slope and offset of the sigmoid that turns held-out decisions into probabilities.

    Each row's decision comes from the model that did not see its fold; the
    targets are smoothed towards the class sizes as Platt proposes, and the
    cross-entropy is minimised by Newton steps in the two parameters."""
    features = models[0].features
    by_fold = dict(zip(folds, models))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, own = columns(b, features), b.column("__fold").to_numpy(zero_copy_only=False)
            d = np.zeros(len(x))
            for f, m in by_fold.items():
                d[own == f] = m.decide(x[own == f])
            yield pa.RecordBatch.from_arrays([pa.array(d), b.column("__y")], ["d", "y"])

    rows = df.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in features], F.col(label).cast("double").alias("__y"), F.col(fold).cast("long").alias("__fold"))
    held = materialise(rows.mapInArrow(run, "d double, y double"), "margins")
    count = held.agg(F.count_if(F.col("y") > 0).alias("pos"), F.count_if(F.col("y") <= 0).alias("neg"), F.avg(F.abs("d")).alias("size")).first()
    high, low = (count["pos"] + 1) / (count["pos"] + 2), 1 / (count["neg"] + 2)
    t = F.when(F.col("y") > 0, high).otherwise(low)
    at = np.array([1.0 / (count["size"] or 1.0), math.log((count["pos"] + 1) / (count["neg"] + 1))])
    last, move, step = None, None, 1.0
    for _ in range(passes):
        z = F.lit(float(at[0])) * F.col("d") + F.lit(float(at[1]))
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(-z))
        softplus = F.greatest(z, F.lit(0.0)) + F.log1p(F.exp(-F.abs(z)))
        e, c = p - t, p * (F.lit(1.0) - p)
        s = held.agg(F.sum(softplus - t * z), F.sum(e * F.col("d")), F.sum(e), F.sum(c * F.col("d") * F.col("d")), F.sum(c * F.col("d")), F.sum(c)).first()
        g, h = np.array([s[1], s[2]]), np.array([[s[3], s[4]], [s[4], s[5]]])
        if last is not None and s[0] > last[0] + 1e-12 * abs(last[0]) and step > 1e-6:
            step /= 2
            at = last[1] + step * move
            continue
        if np.abs(g).max() <= 1e-9 * (count["pos"] + count["neg"]) ** 0.5:
            break
        last, step = (s[0], at), 1.0
        move = -np.linalg.solve(h + 1e-12 * np.eye(2), g)
        at = at + move
    return float(at[0]), float(at[1])
