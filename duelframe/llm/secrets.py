"""Secret scans with multipart credential linking, in DataFrame operations only.

Base spans (assigned secrets, access keys, long hex runs) are reported as
they are.  Weak parts (login identifiers, opaque strings, endpoints) are
reported only when complementary parts lie within the same scope: an
identifier next to a secret, an opaque string next to an identifier or an
endpoint, an endpoint next to both an identifier and a secret.  Parts are
linked by an interval join: each part is keyed by the scope-sized bucket of
its border and each weak part looks into the buckets its scope touches.  As
matches of a kind do not overlap, a bucket holds a bounded number of parts,
however long the text is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duelframe.llm.common import join_on, row_key, save

# The base patterns of the contract; a match counts if its
# checked group has the least length.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"       # AKIA[A-Z0-9]+ of 20 or more characters
HEX = r"[0-9a-f]{24,}"              # [0-9a-f]+ of 24 or more characters
# Weak parts of multipart credentials.
IDENT = r"""(?i)(user_?name|user|login|client_?id|account_?id|access_?key_?id)["']?\x20*[:=]\x20*["']?([A-Za-z0-9._@-]{3,})"""
OPAQUE = r"[A-Za-z0-9+/]{20,}={0,2}"
ENDPOINT = r"(https?|ftp|jdbc:[a-z]+|postgres|postgresql|mysql|mongodb|redis|amqp)://[A-Za-z0-9._~:/?#@!$&()*+,;=%-]+"

#: kind: (pattern, checked group, least length of it, further test of the match, role)
KINDS = {
    "assign": (ASSIGN, 2, 6, None, "secret"),
    "access": (ACCESS, 0, 20, None, "identifier"),
    "hex": (HEX, 0, 24, None, "secret"),
    "ident": (IDENT, 0, 1, None, "identifier"),
    "opaque": (OPAQUE, 0, 20, r"[0-9]", "secret"),
    "endpoint": (ENDPOINT, 0, 1, None, "endpoint"),
}
BASE = ("assign", "access", "hex")
SCOPE = 200
MARK = "[SECRET]"


def _matches(text: Column, kind: str) -> Column:
    """Array of (length of the text before it, match length, counts) for each match, in order."""
    pattern, group, least, also, _ = KINDS[kind]
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    checked = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    between = F.split(text, pattern, -1)

    def one(m, i):
        ok = F.length(F.get(checked, i)) >= least
        if also:
            ok = ok & m.rlike(also)
        return F.struct(F.length(F.get(between, i)).alias("gap"), F.length(m).alias("len"), ok.alias("ok"))

    return F.when(text.rlike(pattern), F.transform(whole, one))


def matches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Distinct (id, key, kind, start, end) of all counted matches, base and weak; code points, end exclusive."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = [F.struct(F.lit(k).alias("kind"), _matches(text, k).alias("m")) for k in KINDS]
    long = (docs.select(F.col(id_col).alias("id"), row_key(text).alias("key"), F.explode(F.array(*found)).alias("f"))
            .where(F.col("f.m").isNotNull())
            .select("id", "key", "f.kind", F.posexplode("f.m").alias("i", "m"))
            .select("id", "key", "kind", "i", "m.gap", "m.len", "m.ok"))
    long = long.dropDuplicates(["id", "key", "kind", "i"])          # repeated rows
    upto = Window.partitionBy("id", "key", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.col("len")).over(upto)
    spans = long.withColumn("end", end).withColumn("start", F.col("end") - F.col("len"))
    return spans.where("ok").select("id", "key", "kind", "start", "end")


def linked(spans: DataFrame, scope: int = SCOPE) -> DataFrame:
    """The weak spans whose complementary parts co-occur within ``scope`` characters, not overlapping."""
    role = F.create_map(*[F.lit(x) for k, v in KINDS.items() for x in (k, v[4])])
    weak = spans.where(~F.col("kind").isin(*BASE))
    # a part is met by its start when it lies after, by its end when it lies before
    parts = spans.select("id", "key", F.element_at(role, F.col("kind")).alias("role"), F.explode(F.array(
        F.struct(F.lit(True).alias("after"), F.col("start").alias("at")),
        F.struct(F.lit(False).alias("after"), F.col("end").alias("at")))).alias("p"))
    parts = parts.select("id", "key", "role", "p.after", "p.at", F.floor(F.col("p.at") / scope).alias("bucket")).distinct()
    looks = weak.select("id", "key", "kind", "start", "end", F.explode(F.array(
        F.struct(F.lit(True).alias("after"), F.col("end").alias("lo"), (F.col("end") + scope).alias("hi")),
        F.struct(F.lit(False).alias("after"), (F.col("start") - scope).alias("lo"), F.col("start").alias("hi")))).alias("w"))
    looks = looks.select("id", "key", "kind", "start", "end", "w.*").withColumn(
        "bucket", F.explode(F.sequence(F.floor(F.col("lo") / scope), F.floor(F.col("hi") / scope))))
    met = join_on(looks, parts, ["id", "key", "after", "bucket"]).where("at >= lo and at <= hi")
    near = met.groupBy("id", "key", "kind", "start", "end").agg(
        *[F.bool_or(F.col("role") == r).alias(r) for r in ("secret", "identifier", "endpoint")])
    complete = (F.when(F.col("kind") == "ident", F.col("secret"))
                .when(F.col("kind") == "opaque", F.col("identifier") | F.col("endpoint"))
                .otherwise(F.col("identifier") & F.col("secret")))
    return near.where(complete).select("id", "key", "kind", "start", "end")


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """(id, key, kind, start, end) of every reported span; ``key`` is ``row_key`` of the text."""
    spans = save(matches(docs, id_col, text_col), "secret-spans")
    return spans.where(F.col("kind").isin(*BASE)).unionByName(linked(spans, scope))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """Per row of ``docs``: id, n_assign, n_access, n_hex and the sorted arrays ``base`` and ``spans``.

    Array entries are (start, rank of the kind, kind, end).  A null or empty
    text has none; repeated rows are each returned with the same result, as
    are null ids; other columns are ignored; an empty table gives no rows.
    """
    found = find(docs, id_col, text_col, scope)
    rank = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    entry = F.struct("start", rank.alias("rank"), "kind", "end")
    base = F.col("kind").isin(*BASE)
    per_row = found.groupBy("id", "key").agg(
        *[F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in BASE],
        F.array_sort(F.collect_list(F.when(base, entry))).alias("base"), F.array_sort(F.collect_list(entry)).alias("spans"))
    rows = docs.select(F.col(id_col).alias("id"), row_key(F.col(text_col)).alias("key"))
    out = join_on(rows, per_row, ["id", "key"], "left")
    return out.select(F.col("id").alias(id_col), *[F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in BASE],
                      "base", "spans")


def listed(spans: Column) -> Column:
    """kind:start:end of each entry, comma-joined; no spans give the empty text."""
    return F.coalesce(F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","), F.lit(""))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mark: str = MARK, scope: int = SCOPE,
           flag: str = "redacted") -> DataFrame:
    """``docs`` with every reported span's text replaced by ``mark`` (overlapping spans by one), and whether a text changed."""
    found = find(docs, id_col, text_col, scope)
    order = Window.partitionBy("id", "key").orderBy("start", "end")
    last = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    piece = F.sum(F.when(last >= F.col("start"), 0).otherwise(1)).over(order)
    runs = found.withColumn("piece", piece).groupBy("id", "key", "piece").agg(F.min("start").alias("s"), F.max("end").alias("e"))
    runs = runs.groupBy("id", "key").agg(F.array_sort(F.collect_list(F.struct("s", "e"))).alias("__runs"))
    keyed = docs.withColumn("key__", row_key(F.col(text_col))).withColumn("id__", F.col(id_col))
    runs = runs.withColumnsRenamed({"id": "id__", "key": "key__"})
    out = join_on(keyed, runs, ["id__", "key__"], "left")
    text, cuts = F.col(text_col), F.col("__runs")
    before = F.transform(cuts, lambda r, i: F.concat(
        F.substring(text, F.when(i > 0, F.get(cuts, i - 1)["e"]).otherwise(0).cast("int") + 1,
                    (r["s"] - F.when(i > 0, F.get(cuts, i - 1)["e"]).otherwise(0)).cast("int")), F.lit(mark)))
    clean = F.concat(F.array_join(before, ""), F.substring(text, F.element_at(cuts, -1)["e"].cast("int") + 1, F.length(text)))
    return out.withColumn(text_col, F.when(cuts.isNull(), text).otherwise(clean)).withColumn(flag, cuts.isNotNull()).select(*docs.columns, flag)
