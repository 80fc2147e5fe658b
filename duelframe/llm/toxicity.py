"""Toxicity scores from a linear-chain conditional random field.

Document labels are turned into token labels: a word of a toxic document is
a toxic token if the word, or one of its first or last characters, occurs in
toxic documents significantly more often than in others.  The field (two
states, hashed word and affix features, first-order transitions) is trained
on windows of labelled tokens.  Scoring runs forward-backward over every
whole text; a document's score is a logistic function, fitted on the same
labelled documents, of its highest marginal and its expected number of toxic
tokens, and its spans are the runs of tokens whose marginal is at least 1/2.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duelframe.llm.common import ALNUM, LOWER, SpanHash, core, ddl, fit_in_task, mix, slices, word_spans

AFFIXES = (3, 4, 5, 6)         # bytes of a word's first and last characters used as features
WIDTH = 1 << 18                # hashed feature weights
SAMPLE_TOXIC, SAMPLE_CLEAN = 1500, 3000   # labelled documents used at most, by smallest hash of the id
WINDOW = 24                    # tokens of a training window
WINDOWS = 6000                 # training windows of each kind at most
ROUNDS = 60
EVIDENCE = 16.0                # log-likelihood ratio that makes a feature significant


# -- tokens -------------------------------------------------------------------

def word_features(data: np.ndarray, s: np.ndarray, e: np.ndarray, h: SpanHash) -> np.ndarray:
    """Feature hashes of words (rows): the word, then its prefixes and suffixes; 0 where a word is too short."""
    n = e - s
    cols = [h.of(s, e)]
    for k in AFFIXES:
        ok = n > k
        for tag, a, b in ((1, s, s + k), (2, e - k, e)):
            f = np.zeros(len(s), np.uint64)
            f[ok] = mix(h.of(a[ok], b[ok]) + np.uint64(tag))
            cols.append(f)
    return np.stack(cols, axis=1)


def tokens(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, ...]:
    """Word starts and ends, first word of each text, vocabulary of features and each word's row in it."""
    low = LOWER[data]
    s, e = word_spans(low, off, ALNUM)
    h = SpanHash(low)
    _, first, inverse = np.unique(h.of(s, e), return_index=True, return_inverse=True)
    return s, e, np.searchsorted(s, off), word_features(low, s[first], e[first], h), inverse


# -- the field ------------------------------------------------------------------

@dataclass
class Field:
    """Weights of the toxic state's features, bias, transitions and the document score."""

    weights: np.ndarray
    bias: float
    trans: np.ndarray          # [from, to]
    doc: np.ndarray            # intercept, highest marginal's log odds, log of expected count

    def emissions(self, features: np.ndarray) -> np.ndarray:
        """Score of the toxic state for feature rows (the other state's is 0)."""
        out = np.full(len(features), self.bias)
        for f in features.T:
            out += np.where(f != 0, self.weights[f & np.uint64(WIDTH - 1)], 0.0)
        return out


def forward_backward(em: np.ndarray, trans: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Marginals of state 1, log partition and pair marginals' sums of padded sequences.

    ``em`` is (sequences, steps).  Sums are kept scaled by step, so long
    sequences neither under- nor overflow.
    """
    n, steps = em.shape
    top = np.maximum(em, 0)
    p0, p1 = np.exp(-top), np.exp(em - top)
    t = np.exp(trans)
    a = np.empty((steps, n, 2))
    scale = np.empty((steps, n))
    for j in range(steps):
        if j:
            x0 = a[j - 1, :, 0] * t[0, 0] + a[j - 1, :, 1] * t[1, 0]
            x1 = a[j - 1, :, 0] * t[0, 1] + a[j - 1, :, 1] * t[1, 1]
        else:
            x0 = x1 = 1.0
        a[j, :, 0], a[j, :, 1] = x0 * p0[:, j], x1 * p1[:, j]
        scale[j] = a[j].sum(axis=1)
        a[j] /= scale[j][:, None]
    live = np.arange(steps)[:, None] < length[None, :]
    logz = np.where(live, np.log(scale) + top.T, 0).sum(axis=0)
    b = np.ones((n, 2))
    marg = np.empty((steps, n))
    pairs = np.zeros((2, 2))
    for j in range(steps - 1, -1, -1):
        g = a[j] * b
        g /= g.sum(axis=1, keepdims=True)
        marg[j] = g[:, 1]
        if j:
            y = np.stack((p0[:, j] * b[:, 0], p1[:, j] * b[:, 1]), axis=1) / scale[j][:, None]
            on = live[j]
            w = a[j - 1][on].T @ y[on] * t
            pairs += w
            nxt = np.stack((t[0, 0] * y[:, 0] + t[0, 1] * y[:, 1], t[1, 0] * y[:, 0] + t[1, 1] * y[:, 1]), axis=1)
            b = np.where(on[:, None], nxt, 1.0)
    return marg.T, logz, pairs


def marginals(em: np.ndarray, trans: np.ndarray, first: np.ndarray, step: int = 256) -> np.ndarray:
    """Marginals of state 1 for consecutive texts' tokens (``first``: each text's first token).

    The messages of both directions are products of 2x2 matrices along the
    text.  They are taken in blocks of ``step`` tokens: the product over each
    block, the messages at block borders, then all blocks side by side.  This
    is exact and needs ``step`` vector operations however long a text is.
    """
    total = len(em)
    if total == 0:
        return np.zeros(0)
    n_blocks = -(-np.diff(first) // step)
    doc_of = np.repeat(np.arange(len(n_blocks)), n_blocks)
    number = np.arange(len(doc_of)) - np.repeat(np.cumsum(n_blocks) - n_blocks, n_blocks)
    at = first[:-1][doc_of] + number * step
    size = np.minimum(first[1:][doc_of] - at, step)
    width = int(size.max())
    idx = np.minimum(at[:, None] + np.arange(width), total - 1)
    live = np.arange(width)[None, :] < size[:, None]
    top = np.maximum(em, 0)
    p = np.stack((np.exp(-top), np.exp(em - top)), axis=1)
    t = np.exp(trans)
    begin = number == 0
    m = len(at)
    # alpha within blocks from either state before the block; rows: entry state
    alpha = np.empty((width, m, 2, 2), np.float64)
    cur = np.broadcast_to(np.eye(2), (m, 2, 2)).copy()
    for j in range(width):
        on = live[:, j]
        pj = p[idx[:, j]]
        # the first token of a text has no transition: the entry state is dropped
        nxt = cur @ t if j or not begin.any() else np.where(begin[:, None, None], 0.5, cur @ t)
        nxt = nxt * pj[:, None, :]
        nxt /= nxt.sum(axis=(1, 2), keepdims=True)
        cur = np.where(on[:, None, None], nxt, cur)
        alpha[j] = cur
    beta = np.empty((width, m, 2, 2), np.float64)              # columns: state after the block
    cur = np.broadcast_to(np.eye(2), (m, 2, 2)).copy()
    started = np.zeros(m, bool)
    for j in range(width - 1, -1, -1):
        on = live[:, j]
        beta[j] = cur                                          # from token j's state to the block's last state
        pj = p[idx[:, j]]
        nxt = (t * pj[:, None, :]) @ cur
        nxt /= nxt.sum(axis=(1, 2), keepdims=True)
        cur = np.where(on[:, None, None], nxt, cur)
        started |= on
    # messages at the blocks' borders, one step a block number, all texts at once
    block0 = np.cumsum(n_blocks) - n_blocks
    into = np.full((m, 2), 0.5)                                # state distribution before the block
    out = np.ones((m, 2))                                      # likelihood of what follows, by the block's last state
    deepest = int(n_blocks.max()) if len(n_blocks) else 0
    order = np.argsort(-n_blocks, kind="stable")
    counts = np.searchsorted(-n_blocks[order], -np.arange(1, deepest + 1), "right")
    for k in range(1, deepest):
        b = block0[order[:counts[k]]] + k
        v = np.einsum("mi,mij->mj", into[b - 1], alpha[-1][b - 1])
        into[b] = v / v.sum(axis=1, keepdims=True)
    for k in range(deepest - 1, 0, -1):
        b = block0[order[:counts[k]]] + k
        # beta over the whole block from the state before it
        full = t[None] * p[idx[b, 0]][:, None, :]
        v = np.einsum("mij,mjk,mk->mi", full, beta[0][b], out[b])
        out[b - 1] = v / v.sum(axis=1, keepdims=True)
    f = np.einsum("mi,jmik->jmk", into, alpha)
    g = np.einsum("jmik,mk->jmi", beta, out)
    both = f * g
    res = np.empty(total)
    res[idx.T[live.T]] = (both[..., 1] / both.sum(axis=2))[live.T]
    return res


# -- training ---------------------------------------------------------------------

def _evidence(feat: np.ndarray, doc: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Feature hashes that speak significantly for toxic documents (by log-likelihood ratio)."""
    ids, inv = np.unique(feat, return_inverse=True)
    pair = np.unique(inv.astype(np.int64) * (len(toxic) + 1) + doc)
    f, d = pair // (len(toxic) + 1), pair % (len(toxic) + 1)
    k1 = np.bincount(f, weights=toxic[d], minlength=len(ids))
    k0 = np.bincount(f, minlength=len(ids)) - k1
    n1, n0 = max(1.0, toxic.sum()), max(1.0, (1 - toxic).sum())

    def ll(k, n, p):
        p = np.clip(p, 1e-9, 1 - 1e-9)
        return k * np.log(p) + (n - k) * np.log(1 - p)

    both = (k1 + k0) / (n1 + n0)
    g = ll(k1, n1, k1 / n1) + ll(k0, n0, k0 / n0) - ll(k1, n1, both) - ll(k0, n0, both)
    strong = (g >= EVIDENCE / 2) & (k1 / n1 > 4 * k0 / n0) & (ids != 0)
    return ids[strong]


def train(texts: list[str | None], labels: list[int], seed: int = 42) -> Field:
    """Fit the field and the document score on labelled texts (no texts: a field that scores all alike)."""
    toxic = np.array(labels, float)
    rng = np.random.default_rng(seed)
    feats, rows, docs, firsts = [], [], [], [0]
    base, n = 0, 0
    for part, data, off in slices(iter([pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])] if texts else [])):
        _, _, first, f, inv = tokens(data, off)
        feats.append(f)
        rows.append((inv + base).astype(np.int32))
        docs.append((np.repeat(np.arange(part.num_rows), np.diff(first)) + n).astype(np.int32))
        firsts.extend((first[1:] + firsts[-1]).tolist())
        base, n = base + len(f), n + part.num_rows
    field = Field(np.zeros(WIDTH), 0.0, np.zeros((2, 2)), np.array([_prior(toxic), 0.0, 0.0]))
    if not feats or toxic.min() == toxic.max() or not sum(map(len, rows)):
        return field
    feats, rows, docs, first = np.concatenate(feats), np.concatenate(rows), np.concatenate(docs), np.array(firsts)
    words = np.unique(feats[:, 0], return_index=True, return_inverse=True)   # the same word in different slices
    feats, rows = feats[words[1]], words[2].astype(np.int32)[rows]
    del words
    pair = np.unique(rows.astype(np.int64) * n + docs)
    r, d = pair // n, pair % n
    # token labels: a toxic document's words that hold a strong feature
    word_toxic = np.zeros(len(feats), bool)
    for k in range(feats.shape[1]):
        word_toxic |= np.isin(feats[:, k], _evidence(feats[r, k], d, toxic))
    y = word_toxic[rows] & (toxic[docs] == 1)
    # windows of tokens: around toxic tokens, and from clean documents (those with look-alikes first)
    starts = np.arange(0, len(rows), WINDOW)
    has = np.add.reduceat(y, starts) > 0
    alike = np.add.reduceat(word_toxic[rows] & (toxic[docs] == 0), starts) > 0
    clean = np.add.reduceat((toxic[docs] == 0), starts) == np.minimum(WINDOW, len(rows) - starts)
    pos, neg = np.flatnonzero(has), np.flatnonzero(clean & ~has)
    neg = np.concatenate((rng.permutation(neg[alike[neg]])[:WINDOWS // 2], rng.permutation(neg[~alike[neg]])[:WINDOWS]))
    pick = np.concatenate((rng.permutation(pos)[:WINDOWS], neg))
    if len(pos):
        _fit_field(field, feats, rows, y, docs, starts[pick])
    # document score from marginals of the whole texts
    em = field.emissions(feats)[rows]
    x = np.concatenate([_summary(marginals(em[first[a]:first[b]], field.trans, first[a:b + 1] - first[a]), first[a:b + 1] - first[a])
                        for a, b in _ranges(first, 1 << 18)])
    field.doc = _logistic(x, toxic)
    return field


def _ranges(first: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    a = 0
    while a < len(first) - 1:
        b = max(a + 1, int(np.searchsorted(first, first[a] + most, "right")) - 1)
        yield a, b
        a = b


def _prior(y: np.ndarray) -> float:
    p = (y.sum() + 0.5) / (len(y) + 1) if len(y) else 0.5
    return float(np.log(p / (1 - p)))


def _fit_field(field: Field, feats, rows, y, docs, starts, rate: float = 0.3, decay: float = 1e-4) -> None:
    """Adam steps on the mean log-likelihood of the windows (cut at document borders)."""
    size = np.minimum(WINDOW, len(rows) - starts)
    idx = np.minimum(starts[:, None] + np.arange(WINDOW), len(rows) - 1)
    size = np.minimum(size, (docs[idx] == docs[starts][:, None]).cumprod(axis=1).sum(axis=1))
    live = np.arange(WINDOW)[None, :] < size[:, None]
    used, local = np.unique(rows[idx], return_inverse=True)
    local = local.reshape(idx.shape)
    f = feats[used]
    cols, on = (f & np.uint64(WIDTH - 1)).astype(np.int64), f != 0
    gold = y[idx] & live
    gold_pairs = np.zeros((2, 2))
    a, b = gold[:, :-1][live[:, 1:]].astype(int), gold[:, 1:][live[:, 1:]].astype(int)
    np.add.at(gold_pairs, (a, b), 1)
    n = len(starts)
    theta = [field.weights, np.zeros(1), np.zeros(4)]
    first, second = [np.zeros_like(t) for t in theta], [np.zeros_like(t) for t in theta]
    for step in range(1, ROUNDS + 1):
        em_word = (theta[0][cols] * on).sum(axis=1) + theta[1][0]
        marg, _, pairs = forward_backward(em_word[local], theta[2].reshape(2, 2), size)
        diff = np.where(live, gold - marg, 0.0)
        per_word = np.bincount(local.ravel(), weights=diff.ravel(), minlength=len(used))
        g_w = np.bincount(cols[on], weights=np.broadcast_to(per_word[:, None], cols.shape)[on], minlength=WIDTH)
        grads = [g_w / n - decay * theta[0], np.array([diff.sum() / n]), ((gold_pairs - pairs) / n).ravel()]
        for k, g in enumerate(grads):
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            theta[k] += rate * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-8)
    field.weights, field.bias, field.trans = theta[0], float(theta[1][0]), theta[2].reshape(2, 2)


def _summary(m: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Highest marginal's log odds and log of the expected count for each text; no words count as marginal 0."""
    n = len(first) - 1
    high, total = np.zeros(n), np.zeros(n)
    full = np.flatnonzero(np.diff(first))
    if len(full):
        high[full] = np.maximum.reduceat(m, first[full])
        total[full] = np.add.reduceat(np.where(m >= 0.1, m, 0.0), first[full])
    high = np.clip(high, 1e-4, 1 - 1e-4)
    return np.stack((np.log(high / (1 - high)), np.log1p(total)), axis=1)


def _logistic(x: np.ndarray, y: np.ndarray, l2: float = 1e-2) -> np.ndarray:
    """Newton steps for intercept and slopes."""
    a = np.concatenate((np.ones((len(x), 1)), x), axis=1)
    w = np.zeros(a.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        h = (a * (p * (1 - p))[:, None]).T @ a + l2 * np.eye(len(w))
        w += np.linalg.solve(h, a.T @ (y - p) - l2 * w)
    return w


# -- Spark ----------------------------------------------------------------------------

def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, learn: Column, id_col: str = "doc_id", text_col: str = "text",
                    most: dict[int, int] | None = None) -> DataFrame:
    """At most ``most[label]`` labelled (id, text, label) rows of each label, by smallest hash of the id.

    The ids are picked from the label table first, so only their documents are
    read out; ids with several labels use the smallest.
    """
    most = most or {1: SAMPLE_TOXIC, 0: SAMPLE_CLEAN}
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & learn)
    known = known.groupBy(F.col(id_col).alias("id")).agg(F.min(label_col).cast("int").alias("label"))
    ids = None
    for value, n in most.items():
        one = known.where(F.col("label") == value).orderBy(F.xxhash64("id"), "id").limit(n)
        ids = one if ids is None else ids.unionByName(one)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(ids), "id")  # bounded by ``most``
    return texts.groupBy("id", "label").agg(F.min("text").alias("text")).select("id", "text", "label")


def score(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """Per row: id, score in [0, 1], predicted 0/1, the offending spans (byte offsets) of the text, and the ``carry`` columns.

    A null or empty text, or one without words, has no spans and the score
    of a text without toxic tokens.  Repeated rows and null ids are each
    scored, ties need no rule (a score of 0.5 predicts 1); other columns are
    ignored; an empty table gives no rows.
    """
    src = core(docs, *dict.fromkeys((id_col, text_col, *carry)))
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches: Iterator[pa.RecordBatch]):
        model = shared.value
        for part, data, off in slices(batches, text_col):
            s, e, first, feats, inv = tokens(data, off)
            m = marginals(model.emissions(feats)[inv], model.trans, first)
            x = _summary(m, first)
            p = 1 / (1 + np.exp(-np.clip(model.doc[0] + x @ model.doc[1:], -30, 30)))
            bad = m >= 0.5
            doc = np.repeat(np.arange(part.num_rows), np.diff(first))
            begin, end = bad.copy(), bad.copy()
            begin[1:] &= ~bad[:-1] | (doc[1:] != doc[:-1])
            end[:-1] &= ~bad[1:] | (doc[1:] != doc[:-1])
            owner = doc[begin]
            cut = np.searchsorted(owner, np.arange(part.num_rows + 1)).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(cut), pa.array(v - off[owner], pa.int64())) for v in (s[begin], e[end])]
            own = [pa.array(p), pa.array((p >= 0.5).astype(np.int32)), *lists]
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), *own], [*kept, *added])

    kept = list(dict.fromkeys((id_col, *carry)))
    added = ["score", "predicted", "span_starts", "span_ends"]
    return src.mapInArrow(run, f"{ddl(src, kept)}, score double, predicted int, span_starts array<long>, span_ends array<long>")


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", learn: Column | None = None, id_col: str = "doc_id",
        text_col: str = "text", most: dict[int, int] | None = None) -> Field:
    """Train on a bounded, hash-picked sample of the labelled documents that ``learn`` (on the label table) allows."""
    rows = labelled_sample(docs, labels, label_col, F.lit(True) if learn is None else learn, id_col, text_col, most)
    return fit_in_task(rows, lambda r: train([x[1] for x in r], [x[2] for x in r]))
