"""Near-duplicate embeddings by NN-descent.

Equal vectors are merged first.  A neighbour graph starts from the leaves of
random-hyperplane trees and is refined by neighbours-of-neighbours joins:
the members of each vector's forward and reverse lists are compared with
each other, and whoever improves a list enters it, until little changes.
The lists steer the search only: of all pairs that a leaf or a round compares,
those at the threshold are kept as a spanning forest, whatever the lists hold,
and make components.  A list that is full of such pairs is saturated: the
fixed length may hide links to others.  The search is then run again with
lists that pass over the vector's own component, until no list is full.
Within a component links are counted rather than listed.  Members
within half the threshold's angle of the component's pivot are all linked to
each other by the triangle inequality; only pairs with a member beyond it
are computed, block by block.  Recall is audited by exact scans of drawn
vectors against all rows, until a stated number of them has links or all are
drawn; links that a scan finds are kept.  While recall is short, further trees
are added, and after the last pass every vector is scanned.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from duelframe.llm.common import core, join_on, save
from duelframe.llm.components import connected_components

THRESHOLD = 0.95
LIST = 10                      # neighbours kept a vector
LEAF = 128                     # vectors of a tree's leaf, about
TREES = 6                      # at least; more where leaves are many, see ``enough_trees``
ROUNDS = 3
SETTLED = 0.01                 # share of list entries that a last round may change
BLOCK = 512
AUDIT, RECALL, PASSES = 256, 0.95, 3   # vectors with links that an audit needs, wanted share of their links, passes before the full scan
FIRST_DRAW, MOST_DRAW = 1024, 4096     # vectors that one scan holds against all rows


def matrix(column: pa.Array) -> np.ndarray:
    """Unit rows in double precision from a list column whose lists have one length."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    x = x.reshape(len(column), -1) if len(column) else x.reshape(0, 1)
    # by powers of two, which change no digit: squares neither overflow nor vanish
    x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, initial=0.0, keepdims=True))[1])
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def by_length(column: pa.Array) -> Iterator[np.ndarray]:
    """Row numbers of each list length."""
    size = np.asarray(column.value_lengths())
    for n in np.unique(size):
        yield np.flatnonzero(size == n)


def valid_nodes(vectors: DataFrame, id_col: str, vec_col: str) -> tuple[DataFrame, DataFrame]:
    """(rows (id, node), nodes (node, emb, rep, mult, dim)); rows without a usable vector have node null."""
    e = F.col(vec_col)
    number = F.transform(e, lambda x: x.cast("double"))
    usable = F.forall(number, lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False))) & F.exists(number, lambda x: x != 0)
    ok = F.col(id_col).isNotNull() & F.coalesce(usable, F.lit(False))
    rows = vectors.select(F.col(id_col).alias("id"), F.when(ok, F.xxhash64(number)).alias("node"), e.alias("emb"))
    nodes = rows.where("node is not null").groupBy("node").agg(
        F.first("emb").alias("emb"), F.min("id").alias("rep"), F.count_distinct("id").alias("mult"))
    return rows.select("id", "node"), nodes.withColumn("dim", F.size("emb"))


def forest(hit: np.ndarray, joined: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of ``hit`` that connect whatever ``hit`` connects, where the ``joined`` members are connected already."""
    seen = joined.copy()
    todo = np.flatnonzero(joined).tolist()
    some = hit.any(axis=1)
    left, right = [], []
    for root in [None, *np.flatnonzero(some & ~joined).tolist()]:
        if root is not None:
            if seen[root]:
                continue
            seen[root] = True
            todo = [root]
        while todo:
            i = todo.pop()
            if some[i]:
                new = np.flatnonzero(hit[i] & ~seen)
                if len(new):
                    seen[new] = True
                    left.append(np.full(len(new), i))
                    right.append(new)
                    todo += new.tolist()
    none = np.zeros(0, np.int64)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


def plane_bits(n: int, leaf: int) -> int:
    return min(40, max(0, math.ceil(math.log2(max(1, n) / leaf))))


def enough_trees(n: int, leaf: int, threshold: float, least: int = TREES) -> int:
    """Trees of which one leaf at least holds a pair at the threshold, with chance ``RECALL``."""
    together = (1 - math.acos(threshold) / math.pi) ** plane_bits(n, leaf)
    return least if together >= 1 else max(least, math.ceil(math.log(1 - RECALL) / math.log1p(-together)))


def first_lists(nodes: DataFrame, n: int, k: int, trees: range, leaf: int, threshold: float) -> DataFrame:
    """(u, v, sim, link): each vector's nearest of other components within its leaf of each tree, and the leaf's links."""
    bits = plane_bits(n, leaf)

    def codes(batches: Iterator[pa.RecordBatch]):
        for part in batches:
            emb = part.column("emb")
            out = np.zeros((part.num_rows, len(trees)), np.int64)
            for rows in by_length(emb):
                x = matrix(emb.take(pa.array(rows)))
                for j, t in enumerate(trees):
                    plane = np.random.default_rng((t, x.shape[1])).normal(size=(x.shape[1], bits))
                    out[rows, j] = (x @ plane > 0) @ (1 << np.arange(bits, dtype=np.int64))
            flat = pa.ListArray.from_arrays(pa.array(np.arange(part.num_rows + 1, dtype=np.int32) * len(trees)), pa.array(out.ravel()))
            yield pa.RecordBatch.from_arrays([part.column("node"), part.column("label"), part.column("dim"), emb, flat], ["node", "label", "dim", "emb", "codes"])

    kind = nodes.schema["emb"].dataType.simpleString()
    coded = nodes.select("node", "label", "dim", "emb").mapInArrow(codes, f"node long, label long, dim int, emb {kind}, codes array<long>")
    coded = coded.select("node", "label", "dim", "emb", F.posexplode("codes").alias("tree", "leaf"))
    # a leaf that many vectors share is dealt to chunks; lists meet again in the descent
    sizes = coded.groupBy("tree", "dim", "leaf").agg(F.ceil(F.count("*") / F.lit(2.0 * leaf)).cast("int").alias("chunks"))
    dealt = coded.join(sizes, ["tree", "dim", "leaf"]).withColumn("chunk", F.pmod(F.hash("node", "tree"), F.col("chunks")))

    def nearest(table: pa.Table) -> pa.Table:
        ids, label = table.column("node").to_numpy(), table.column("label").to_numpy()
        sim = matrix(table.column("emb"))
        sim = sim @ sim.T
        sim[label[:, None] == label[None, :]] = -2
        m = min(k, len(ids) - 1)
        near = np.argpartition(-sim, max(m - 1, 0), axis=1)[:, :m] if m else np.zeros((len(ids), 0), int)
        i, j = forest(sim >= threshold, np.zeros(len(ids), bool))
        u, v = np.concatenate((np.repeat(np.arange(len(ids)), m), i)), np.concatenate((near.ravel(), j))
        link = np.arange(len(u)) >= len(ids) * m
        other = sim[u, v] > -2
        u, v, link = u[other], v[other], link[other]
        return pa.table({"u": ids[u], "v": ids[v], "sim": sim[u, v], "link": link})

    return dealt.select("tree", "dim", "leaf", "chunk", "node", "label", "emb").groupBy("tree", "dim", "leaf", "chunk").applyInArrow(
        nearest, "u long, v long, sim double, link boolean")


def best(edges: DataFrame, k: int) -> DataFrame:
    """The ``k`` most similar of each ``u`` (cut in each task before the shuffle)."""
    w = Window.partitionBy("u").orderBy(F.col("sim").desc(), "v")
    return edges.withColumn("place", F.row_number().over(w)).where(F.col("place") <= k).drop("place")


def relist(found: DataFrame, k: int) -> DataFrame:
    """(u, v, sim, link, new, listed): the ``k`` most similar of each ``u`` are listed, links stay beyond them."""
    pairs = found.repartition("u").groupBy("u", "v").agg(
        F.max("sim").alias("sim"), F.max("link").alias("link"), F.min("new").alias("new"))
    w = Window.partitionBy("u").orderBy(F.col("sim").desc(), "v")
    return pairs.withColumn("listed", F.row_number().over(w) <= k).where("listed or link")


def descend(graph: DataFrame, nodes: DataFrame, k: int, threshold: float) -> DataFrame:
    """One round: compare the members of every list with a new entry, keep the best and all links; rows as of ``relist``."""
    listed = graph.where("listed").select("u", "v", "sim", "new")
    back = best(listed.select(F.col("v").alias("u"), F.col("u").alias("v"), "sim", "new"), k)
    lists = listed.union(back).groupBy("u", "v").agg(F.max("sim").alias("sim"), F.max("new").alias("new"))
    worst = listed.groupBy("u").agg(F.when(F.count("*") >= k, F.min("sim")).otherwise(-2.0).alias("worst"))
    members = nodes.select(F.col("node").alias("v"), "label", "emb").join(worst.withColumnRenamed("u", "v"), "v")
    joined = (F.col("sim") >= threshold).alias("joined")     # linked to u, so to each other
    full = lists.join(members, "v").groupBy("u").agg(
        F.max("new").alias("new"), F.collect_list(F.struct("v", "worst", "emb", "label", joined)).alias("m")).where("new = 1").select("m")

    def compare(batches: Iterator[pa.RecordBatch]):
        for big in batches:
            for at in range(0, big.num_rows, 256):
                part = big.slice(at, 256)
                column = part.column("m")
                size = np.asarray(column.value_lengths())
                flat = column.flatten()
                ids, worst_, label = (flat.field(c).to_numpy() for c in (0, 1, 3))
                joined_ = flat.field(4).to_numpy(zero_copy_only=False)
                x = matrix(flat.field(2)) if len({len_ for len_ in np.asarray(flat.field(2).value_lengths())}) <= 1 else None
                starts = np.concatenate(([0], np.cumsum(size)))
                us, vs, sims, links = [], [], [], []
                for a, b in zip(starts[:-1], starts[1:]):
                    own = x[a:b] if x is not None else matrix(flat.field(2).slice(a, b - a))
                    s = own @ own.T
                    s[label[a:b, None] == label[None, a:b]] = -2
                    for link, (i, j) in enumerate((np.nonzero(s > worst_[a:b, None]),
                                                   forest(s >= threshold, joined_[a:b]))):
                        us.append(ids[a:b][i])
                        vs.append(ids[a:b][j])
                        sims.append(s[i, j])
                        links.append(np.full(len(i), link == 1))
                if us:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(z)) for z in (us, vs, sims, links)], ["u", "v", "sim", "link"])

    found = full.mapInArrow(compare, "u long, v long, sim double, link boolean")
    known = graph.select("u", "v", "sim", "link", F.lit(0).alias("new"))
    return relist(known.unionByName(found.withColumn("new", F.lit(1))), k)


def neighbour_graph(nodes: DataFrame, n: int, k: int = LIST, trees: range = range(TREES), leaf: int = LEAF,
                    rounds: int = ROUNDS, threshold: float = THRESHOLD) -> DataFrame:
    """(u, v, sim, listed): up to ``k`` listed neighbours a vector, all of other labels, and links beyond them."""
    graph = save(relist(first_lists(nodes, n, k, trees, leaf, threshold).withColumn("new", F.lit(1)), k), "nn-graph")
    for _ in range(rounds):
        graph = save(descend(graph, nodes, k, threshold), "nn-graph")
        if (graph.agg(F.sum("new")).first()[0] or 0) <= SETTLED * n * k:
            break
    return graph.drop("new", "link")


def saturated(graph: DataFrame, k: int, threshold: float) -> bool:
    """Whether some list is full of links."""
    links = graph.where(F.col("listed") & (F.col("sim") >= threshold)).groupBy("u").count()
    return not links.where(F.col("count") >= k).isEmpty()


def scan(labelled: DataFrame, drawn: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Exact links of the ``drawn`` vectors with all: (node, true, found) with those inside a component, and (a, b) labels that links join."""
    table = drawn.select("node", "label", "emb").toArrow().combine_chunks()
    held: dict[int, tuple] = {}
    emb = table.column("emb").combine_chunks() if table.num_rows else pa.array([], pa.list_(pa.float64()))
    for rows in by_length(emb):
        take = pa.array(rows)
        held[len(emb[int(rows[0])])] = (matrix(emb.take(take)), table.column("node").to_numpy()[rows], table.column("label").to_numpy()[rows])
    shared = labelled.sparkSession.sparkContext.broadcast(held)

    def compare(batches: Iterator[pa.RecordBatch]):
        true, found, joins = {}, {}, set()
        for big in batches:
            for at in range(0, big.num_rows, 1024):
                part = big.slice(at, 1024)
                emb, ids, label = part.column("emb"), part.column("node").to_numpy(), part.column("label").to_numpy()
                for rows in by_length(emb):
                    x = matrix(emb.take(pa.array(rows)))
                    if x.shape[1] not in shared.value:
                        continue
                    q, q_id, q_label = shared.value[x.shape[1]]
                    hit = (x @ q.T >= threshold) & (ids[rows][:, None] != q_id[None, :])
                    own = label[rows][:, None] == q_label[None, :]
                    all_, inside = hit.sum(axis=0), (hit & own).sum(axis=0)
                    for z in np.flatnonzero(all_).tolist():
                        node = int(q_id[z])
                        true[node], found[node] = true.get(node, 0) + int(all_[z]), found.get(node, 0) + int(inside[z])
                    i, j = np.nonzero(hit & ~own)
                    if len(i):
                        joins |= set(map(tuple, np.unique(np.stack((label[rows][i], q_label[j]), 1), axis=0).tolist()))
        yield pa.RecordBatch.from_arrays([
            pa.array([*true, *(a for a, _ in joins)], pa.int64()), pa.array([*true.values(), *(0 for _ in joins)], pa.int64()),
            pa.array([*found.values(), *(0 for _ in joins)], pa.int64()), pa.array([*(None for _ in true), *(b for _, b in joins)], pa.int64())],
            ["node", "true", "found", "other"])

    got = save(labelled.select("node", "label", "emb").mapInArrow(compare, "node long, true long, found long, other long"), "nn-scan")
    counts = got.where("other is null").groupBy("node").agg(F.sum("true").alias("true"), F.sum("found").alias("found"))
    return counts, got.where("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b")).distinct()


def audit(labelled: DataFrame, n: int, threshold: float, wanted: int | None) -> tuple[float, DataFrame]:
    """(recall, joins): the share of true links that lie within a component, averaged
    over drawn vectors that have any, and the labels (a, b) that the scans found linked.

    Vectors are drawn until ``wanted`` of them have links or, if there are not
    so many or it is None, until all are drawn; then the joins are complete and
    recall is 1.
    """
    space = 1 << 40
    place = F.pmod(F.xxhash64("node", F.lit(1)), F.lit(space))
    linked, total, joins, low, size = 0, 0.0, None, 0, FIRST_DRAW if wanted else MOST_DRAW
    while low < space and (wanted is None or linked < wanted):
        high = min(space, low + math.ceil(space * size / max(1, n)))
        counts, found = scan(labelled, labelled.where((place >= low) & (place < high)), threshold)
        row = counts.agg(F.count("*"), F.sum(F.col("found") / F.col("true"))).first()
        linked, total = linked + row[0], total + (row[1] or 0.0)
        joins = found if joins is None else joins.unionByName(found)
        low, size = high, min(2 * size, MOST_DRAW)
    return 1.0 if low >= space else total / linked, joins


def count_links(nodes: DataFrame, labels: DataFrame, threshold: float, block: int = BLOCK) -> DataFrame:
    """(node, links): how many other vectors of its component each node links to, equal vectors counted apart."""
    angle = math.acos(threshold)
    near = math.cos(angle / 2) + 1e-9
    pivots = nodes.select(F.col("node").alias("label"), F.col("emb").alias("pivot"))
    members = nodes.join(labels, "node").join(pivots, "label").select("node", "label", "mult", "emb", "pivot")

    def place(batches: Iterator[pa.RecordBatch]):
        for part in batches:
            inner = np.zeros(part.num_rows, bool)
            emb, pivot = part.column("emb"), part.column("pivot")
            for rows in by_length(emb):
                take = pa.array(rows)
                inner[rows] = (matrix(emb.take(take)) * matrix(pivot.take(take))).sum(axis=1) >= near
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("node", "label", "mult", "emb")), pa.array(inner)],
                                             ["node", "label", "mult", "emb", "inner"])

    kind = nodes.schema["emb"].dataType.simpleString()
    placed = save(members.mapInArrow(place, f"node long, label long, mult long, emb {kind}, inner boolean"), "nn-members")
    sums = save(placed.groupBy("label").agg(
        F.sum(F.when(F.col("inner"), F.col("mult")).otherwise(0)).alias("inside"),
        F.ceil(F.count_if("inner") / F.lit(float(block))).cast("int").alias("inner_blocks"),
        F.ceil(F.count_if(~F.col("inner")) / F.lit(float(block))).cast("int").alias("outer_blocks")), "nn-sums")
    sure = placed.join(sums, "label").select(
        "node", F.when(F.col("inner"), F.col("inside") - F.col("mult")).otherwise(0).alias("links"))
    # pairs with an outer member: outer blocks are numbered from 0, inner ones follow
    open_ = placed.join(sums.where("outer_blocks > 0"), "label")
    own = F.when(F.col("inner"), F.col("outer_blocks") + F.pmod(F.hash("node"), F.greatest("inner_blocks", F.lit(1)))).otherwise(
        F.pmod(F.hash("node"), F.col("outer_blocks")))
    last = F.when(F.col("inner"), F.col("outer_blocks")).otherwise(F.col("outer_blocks") + F.col("inner_blocks")) - 1
    open_ = open_.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), last)))
    open_ = open_.select("label", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "own", "node", "mult", "emb")

    def pairs(table: pa.Table) -> pa.Table:
        ids, mult, mine = (table.column(c).to_numpy() for c in ("node", "mult", "own"))
        x, left = matrix(table.column("emb")), mine == table.column("a").to_numpy()
        one_block = bool((mine == mine[0]).all()) and table.column("a")[0] == table.column("b")[0]
        right = left if one_block else ~left
        hit = x[left] @ x[right].T >= threshold
        if one_block:
            np.fill_diagonal(hit, False)
            return pa.table({"node": ids, "links": (hit @ mult).astype(np.int64)})
        return pa.table({"node": np.concatenate((ids[left], ids[right])),
                         "links": np.concatenate((hit @ mult[right], hit.T @ mult[left])).astype(np.int64)})

    computed = open_.groupBy("label", "a", "b").applyInArrow(pairs, "node long, links long")
    return sure.unionByName(computed).groupBy("node").agg(F.sum("links").alias("links"))


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = THRESHOLD,
                    k: int = LIST, trees: int = TREES, leaf: int = LEAF, rounds: int = ROUNDS, block: int = BLOCK) -> DataFrame:
    """Per row: id, n_links, component_id, kept.

    Vectors link at cosine ``threshold`` or more.  A vector that is null,
    empty, zero, or holds null or non-finite components links with nothing,
    nor do vectors of different lengths with each other; a row with a null id
    links with nothing and has component null and kept false.  Equal vectors
    with different ids link; rows that repeat an id and its vector are one
    vector and are each returned.  Other columns are ignored; an empty table
    gives no rows.
    """
    src = core(vectors, id_col, vec_col)
    rows, nodes = valid_nodes(src, id_col, vec_col)
    rows, nodes = save(rows, "nn-rows"), save(nodes, "nn-nodes")
    n = nodes.count()
    trees = enough_trees(n, leaf, threshold, trees)
    labelled, labels, step, audits = nodes.withColumn("label", F.col("node")), None, 0, 0

    def join_components(edges: DataFrame) -> None:
        nonlocal labels, labelled
        if labels is not None:
            edges = edges.unionByName(labels.select(F.col("node").alias("a"), F.col("label").alias("b")))
        labels = save(connected_components(edges), "nn-labels")
        labelled = nodes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))

    while True:
        graph = neighbour_graph(labelled, n, k, range(step * trees, (step + 1) * trees), leaf, rounds, threshold)
        step += 1
        join_components(graph.where(F.col("sim") >= threshold).select(F.col("u").alias("a"), F.col("v").alias("b")))
        if saturated(graph, k, threshold):          # the next lists pass over the components found
            continue
        audits += 1
        recall, joins = audit(labelled, n, threshold, AUDIT)
        if recall < RECALL and audits == PASSES:    # the graph does not reach the bound: scan every vector
            recall, joins = audit(labelled, n, threshold, None)
        if not joins.isEmpty():
            join_components(joins)
        if recall >= RECALL:
            break
    links = count_links(nodes, labels, threshold, block)
    named = nodes.select("node", "rep", "mult").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = named.groupBy("label").agg(F.min("rep").alias("component_id"))
    named = named.join(least, "label").join(links, "node", "left").select(
        "node", "component_id", (F.coalesce("links", F.lit(0)) + F.col("mult") - 1).alias("n_links"))
    out = rows.join(named, "node", "left")
    component = F.coalesce("component_id", "id")
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.cast("long").alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))
