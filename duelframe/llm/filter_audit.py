"""Interaction audit of document filters over sorted posting lists.

Every filter keeps, by part, the sorted list of the ids that fail it.  What a
filter removes after others is the difference of its list and the union of
theirs, so the audit of all orders needs the sizes of a few list operations
(each filter after every set of the others), not a pass over the documents
for each order.  Unions and differences are k-way merges in which every list
gallops to the bound of the next block of ids.

Ids are row numbers given when the verdicts are written, so repeated and null
document ids count row by row.  The lists are cut into ranges of ids, each of
one part: a range holds at most ``RANGE`` ids a list whatever the size of the
part, the sizes of the ranges add up, and ids of one range come from one file,
so the lists are collected before they cross the network.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duelframe.llm.common import core, save

WORD = r"[^\x20\x09-\x0D]+"
RANGE = 1 << 14                # ids of a range
BLOCK = 1 << 12                # ids that a merge takes of a list at once
GOOD, TOXIC = "good", "toxic"


def conditions(text: Column) -> dict[str, Column]:
    """The failure conditions that a text decides by itself, by letter (null: empty text)."""
    t = F.coalesce(text, F.lit(""))
    words = F.regexp_extract_all(t, F.lit(WORD), F.lit(0))
    return {
        "A": F.size(words) < 200,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        "C": 100 * F.regexp_count(t, F.lit("[A-Z]")) > 3 * F.length(t),
        "D": t.rlike(r"[#$%&*|]"),
    }


# -- galloping merges --------------------------------------------------------------

def gallop(ids: np.ndarray, start: int, bound: int) -> int:
    """First place from ``start`` whose id is not below ``bound``: doubling steps, then bisection."""
    step, low = 1, start
    while low + step <= len(ids) and ids[low + step - 1] < bound:
        low += step
        step *= 2
    return low + int(np.searchsorted(ids[low:low + step], bound))


def aligned(lists: list[np.ndarray], block: int = BLOCK) -> Iterator[list[np.ndarray]]:
    """Cut sorted lists at common bounds: each piece holds the ids of one interval, at most ``block`` a list."""
    at = [0] * len(lists)
    while any(i < len(x) for i, x in zip(at, lists)):
        ahead = [x[i + block] for i, x in zip(at, lists) if i + block < len(x)]
        upto = [gallop(x, i, min(ahead)) if ahead else len(x) for i, x in zip(at, lists)]
        yield [x[i:j] for i, j, x in zip(at, upto, lists)]
        at = upto


def union(lists: list[np.ndarray]) -> np.ndarray:
    """Sorted ids that are in any of the sorted lists."""
    return np.concatenate([np.unique(np.concatenate(part)) for part in aligned(lists)] or [np.zeros(0, np.int64)])


def difference(ids: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Sorted ids of the first sorted list that are not in the second."""
    kept = [a[~np.isin(a, b, assume_unique=True)] for a, b in aligned([ids, other])]
    return np.concatenate(kept or [np.zeros(0, np.int64)])


def sizes_of(lists: list[np.ndarray], good: np.ndarray, toxic: np.ndarray) -> list[tuple[int, ...]]:
    """(filter, bits of the filters before, removed, redundant, together, good_lost, toxic_lost) of every filter after every set of others."""
    n = len(lists)
    failed = {bits: union([lists[f] for f in range(n) if bits >> f & 1]) for bits in range(1 << n)}
    out = []
    for f, ids in enumerate(lists):
        for bits in range(1 << n):
            if bits >> f & 1:
                continue
            gone = difference(ids, failed[bits])
            out.append((f, bits, len(gone), len(ids) - len(gone), len(failed[bits | 1 << f]),
                        len(gone) - len(difference(gone, good)), len(gone) - len(difference(gone, toxic))))
    return out


# -- the audit -----------------------------------------------------------------------

def verdicts(docs: DataFrame, failing: Mapping[str, Column], id_col: str = "doc_id", text_col: str = "text",
             part_col: str = "lang") -> DataFrame:
    """Saved table (row, id, part, digest and one boolean a filter); ``row`` numbers the rows."""
    src = core(docs, id_col, text_col, part_col)
    return save(src.select(
        F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").alias("id"),
        F.coalesce(F.col(f"`{part_col}`"), F.lit("")).alias("part"),
        F.unhex(F.sha2(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), 256)).alias("digest"),
        *[c.alias(f"fails_{name}") for name, c in failing.items()]), "audit-verdicts")


def postings(marked: DataFrame, labels: DataFrame, failing: list[str], repeats: str | None,
             label_id: str = "doc_id", id_range: int = RANGE) -> DataFrame:
    """Saved posting lists: one row by part and range of ids, one sorted list of row numbers a filter and label.

    ``repeats`` names the filter that a row fails if its text is that of a
    smaller id; it looks at the whole table, so its postings come from a join
    on the digests that occur more than once.
    """
    marks = {name: F.col(f"fails_{name}") for name in failing}
    hits = marked.select("part", "row", F.array(*[F.when(c, F.lit(name)) for name, c in marks.items()]).alias("k"))
    facts = hits.select("part", "row", F.explode(F.array_compact("k")).alias("kind"))
    if repeats is not None:
        first = marked.groupBy("digest").agg(F.min("id").alias("least"), F.count("*").alias("n")).where("n > 1").drop("n")
        again = marked.select("part", "row", "id", "digest").join(first, "digest").where("id > least")
        facts = facts.unionByName(again.select("part", "row", F.lit(repeats).alias("kind")))
    known = labels.groupBy(F.col(f"`{label_id}`").alias("id")).agg(
        F.max(F.col("quality") == 1).alias(GOOD), F.max(F.col("toxic") == 1).alias(TOXIC)).where(f"{GOOD} or {TOXIC}")
    named = marked.select("part", "row", "id").join(known, "id")
    for name in (GOOD, TOXIC):
        facts = facts.unionByName(named.where(name).select("part", "row", F.lit(name).alias("kind")))
    kinds = [*failing, *([repeats] if repeats is not None else []), GOOD, TOXIC]
    lists = [F.sort_array(F.collect_list(F.when(F.col("kind") == k, F.col("row")))).alias(f"ids_{k}") for k in kinds]
    ranges = facts.withColumn("range", F.floor(F.col("row") / F.lit(id_range)))
    return save(ranges.groupBy("part", "range").agg(*lists), "audit-postings")


def sizes(lists: DataFrame, filters: list[str]) -> DataFrame:
    """Sizes of every filter's list after every set of other filters, by part: the ranges' sizes added up."""
    cols = ["f", "before", "removed", "redundant", "together", "good_lost", "toxic_lost"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                ids = [b.column(f"ids_{name}")[k].values.to_numpy(zero_copy_only=False) for name in [*filters, GOOD, TOXIC]]
                got = np.array(sizes_of(ids[:-2], *ids[-2:]), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b.column("part")[k].as_py()] * len(got), pa.string()), *[pa.array(c) for c in got.T]], ["part", *cols])

    parts = lists.mapInArrow(run, "part string, " + ", ".join(f"{c} long" for c in cols))
    return save(parts.groupBy("part", "f", "before").agg(*[F.sum(c).alias(c) for c in cols[2:]]), "audit-sizes")


def audit(docs: DataFrame, labels: DataFrame, failing: Mapping[str, Column] | None = None, repeats: str | None = "E",
          id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang", id_range: int = RANGE) -> DataFrame:
    """One row by part, order of the filters and step: part, filter_order, step, kept, removed, redundant,
    unique_fails, good_lost, toxic_lost and shapley (all counts of documents within the part).

    ``failing`` maps each filter's letter to its failure condition over the
    columns of ``docs`` (by default those of `conditions`); ``repeats`` names
    one more filter, which a row fails if a smaller id has the same text.  A
    null text is empty, a null part the empty string.  Every row counts, also
    rows with equal ids; a null id has no smaller and is no smaller one, and
    has no labels.  Several labels of one id count if any is 1.  A part
    whose documents all pass has its rows, with zeros; an empty table gives
    no rows.  Other columns are ignored.
    """
    failing = conditions(F.col(f"`{text_col}`")) if failing is None else failing
    filters = [*failing, *([repeats] if repeats is not None else [])]
    marked = verdicts(docs, failing, id_col, text_col, part_col)
    found = sizes(postings(marked, labels, list(failing), repeats, id_range=id_range), filters)
    n, every = len(filters), (1 << len(filters)) - 1

    # how many orders put a set of k filters before a filter: k! (n - 1 - k)!
    orders_with = F.element_at(F.array(*[F.lit(factorial(k) * factorial(n - 1 - k)) for k in range(n)]),
                               (F.bit_count("before") + 1).cast("int"))
    alone = F.col("before") == F.lit(every) - F.pow(F.lit(2), "f")
    by_filter = found.groupBy("part", "f").agg(F.sum(F.when(alone, F.col("removed")).otherwise(0)).alias("unique_fails"),
                                               F.sum(F.col("removed") * orders_with).alias("shapley"))

    steps = []
    for order in permutations(range(n)):
        for k, f in enumerate(order):
            steps.append((len(steps), "".join(filters[g] for g in order), k + 1, f, sum(1 << g for g in order[:k])))
    plan = docs.sparkSession.createDataFrame(steps, "k int, filter_order string, step int, f long, before long")
    totals = marked.groupBy("part").agg(F.count("*").alias("total"))
    rows = totals.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(len(steps) - 1)))).join(plan, "k")
    rows = rows.join(found, ["part", "f", "before"], "left").join(by_filter, ["part", "f"], "left")

    def count(name: str) -> Column:
        return F.coalesce(name, F.lit(0)).cast("long")

    return rows.select("part", "filter_order", "step", (F.col("total") - count("together")).alias("kept"),
                       *[count(c).alias(c) for c in ("removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")])
