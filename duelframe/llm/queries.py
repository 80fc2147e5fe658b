"""The operators' registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duelframe.llm import (decontaminate, filter_audit, importance, language, licences, mixing, neighbours, pieces, quality, secrets,
                           simhash, substrings, toxicity)
from duelframe.llm.common import fold_remainder
from duelframe.llm.licence_texts import LICENCES, SPELLINGS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


@register
def op1_simhash_near_duplicates(spark, sf_dir):
    """SimHash fingerprints and near-duplicate components of all documents."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@register
def op2_benchmark_decontamination(spark, sf_dir):
    """Benchmark windows found in all documents by the shards' FM-indexes."""
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontaminate.digest(found)


ORACLES["op2_benchmark_decontamination"] = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n,
         array_to_string(list_slice(w, k, k + least(13, len(w)) - 1), ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS k FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, n, k, array_to_string(list_slice(w, k, k + n - 1), ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, sizes WHERE len(w) >= n)),
m AS (SELECT doc_id, k, dw.n, item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.win = bw.win),
hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(k, k + n)) AS p FROM m) GROUP BY doc_id),
it AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS s
  FROM (SELECT DISTINCT doc_id, item_id FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(s, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)
"""


@register
def op4_source_mixing(spark, sf_dir):
    """Words taken of every document so that each source meets its target."""
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


_MIX_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id AS id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (
  SELECT source, source_size, 3.0::DOUBLE * source_size AS cap,
         CAST((row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3 + 1 AS DOUBLE) AS w FROM s),
l AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / (sum(w) OVER () - coalesce(sum(w) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
  FROM w WINDOW o AS (ORDER BY cap / w, source IS NULL, encode(source))),
g AS (
  SELECT source, source_size, least((SELECT arg_min(level, cap / w) FROM l WHERE level * w <= cap) * w, cap) AS target FROM l),
goal AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole,
         target - CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END * source_size AS rest FROM g),
cl AS (
  SELECT source, CAST(floor(log2(size)) AS INT) AS class, CAST(sum(size) AS BIGINT) AS words FROM d WHERE size > 0 GROUP BY ALL),
cc AS (
  SELECT cl.*, rest, power(2.0::DOUBLE, class) AS step,
    (rest - coalesce(sum(words) OVER (PARTITION BY cl.source ORDER BY class DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(words * power(2.0::DOUBLE, class)) OVER (PARTITION BY cl.source ORDER BY class DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS c
  FROM cl JOIN goal ON cl.source IS NOT DISTINCT FROM goal.source),
p AS (
  SELECT source, class, rest, least(1.0, step * arg_max(c, class) FILTER (WHERE c * step <= 1) OVER (PARTITION BY source)) AS p FROM cc),
u AS (
  SELECT id, d.source, size, p, rest,
         (CAST('0x' || substr(md5('42:' || coalesce(CAST(id AS VARCHAR), '') || ':1'), 1, 13) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS u
  FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source AND CAST(floor(log2(size)) AS INT) = class
  WHERE size > 0 AND p > 0 AND rest > 0),
q AS (SELECT *, CASE WHEN p >= 1 THEN 0.0::DOUBLE ELSE (u / (1 - u)) / (p / (1 - p)) END AS q FROM u),
-- passes of the fill: in the order of q, what fits the rest is taken; what does not fit waits for the next rest
fill AS (
  SELECT id, source, size, q, rest, FALSE AS taken FROM q
  UNION ALL
  SELECT id, source, size, q, rest - sum(CASE WHEN upto <= rest THEN size ELSE 0 END) OVER (PARTITION BY source), upto <= rest
  FROM (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY q, id ROWS UNBOUNDED PRECEDING) AS upto
        FROM fill WHERE NOT taken AND size <= rest)),
chosen AS (SELECT id, source FROM fill WHERE taken)
SELECT d.id AS doc_id, d.size, goal.source_size, goal.target,
       CAST(CASE WHEN d.size > 0 THEN (whole + CASE WHEN chosen.id IS NULL THEN 0 ELSE 1 END) * d.size ELSE 0 END AS BIGINT) AS taken
FROM d JOIN goal ON d.source IS NOT DISTINCT FROM goal.source
LEFT JOIN chosen ON chosen.id = d.id AND chosen.source IS NOT DISTINCT FROM d.source
"""


ORACLES["op4_source_mixing"] = _MIX_SQL


@register
def op9_secret_scan(spark, sf_dir):
    """Secrets and linked credential parts in all documents."""
    found = secrets.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex",
                        F.sha2(secrets.listed(F.col("base")), 256).alias("base_sha256"),
                        secrets.listed(F.col("spans")).alias("spans"))


def _secret_sql() -> str:
    """The scan in SQL: RE2 folds case beyond ASCII, so letters are spelt out in both cases."""
    def both(pattern: str) -> str:
        if not pattern.startswith("(?i)"):
            return pattern
        body, out, inside = pattern[4:], "", False
        for ch in body:
            inside = (inside or ch == "[") and ch != "]"
            out += f"[{ch.upper()}{ch.lower()}]" if ch.isalpha() and not inside and out[-1:] != "\\" else ch
        return out.replace("\\[Xx]", "\\x")

    parts = []
    for kind, (pattern, group, least, also, role) in secrets.KINDS.items():
        p = both(pattern).replace("'", "''")
        test = f" AND regexp_matches(m[i], '{also}')" if also else ""
        parts.append(f"""
SELECT doc_id, '{kind}' AS kind, '{role}' AS role, {list(secrets.KINDS).index(kind)} AS rank, "end" - length(m[i]) AS start, "end"
FROM (SELECT doc_id, m, g, i, sum(length(b[i]) + length(m[i])) OVER (PARTITION BY doc_id ORDER BY i) AS "end"
      FROM (SELECT doc_id, m, g, b, unnest(range(1, len(m) + 1)) AS i
            FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{p}') AS m, regexp_extract_all(coalesce(text, ''), '{p}', {group}) AS g,
                         string_split_regex(coalesce(text, ''), '{p}') AS b FROM documents)))
WHERE length(g[i]) >= {least}{test}""")
    base = "kind IN ('assign', 'access', 'hex')"
    apart = f"((p.start >= w.\"end\" AND p.start <= w.\"end\" + {secrets.SCOPE}) OR (p.\"end\" <= w.start AND p.\"end\" >= w.start - {secrets.SCOPE}))"
    item = "kind || ':' || CAST(start AS BIGINT) || ':' || CAST(\"end\" AS BIGINT)"
    return f"""
WITH s AS ({' UNION ALL '.join(parts)}),
near AS (
  SELECT w.doc_id, w.kind, w.rank, w.start, w."end", bool_or(p.role = 'secret') AS has_s,
         bool_or(p.role = 'identifier') AS has_i, bool_or(p.role = 'endpoint') AS has_e
  FROM s w JOIN s p ON w.doc_id = p.doc_id AND {apart} WHERE NOT w.{base} GROUP BY ALL),
r AS (
  SELECT doc_id, kind, rank, start, "end" FROM s WHERE {base}
  UNION ALL SELECT doc_id, kind, rank, start, "end" FROM near
  WHERE CASE kind WHEN 'ident' THEN has_s WHEN 'opaque' THEN has_i OR has_e ELSE has_i AND has_s END),
a AS (
  SELECT doc_id, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access,
         count(*) FILTER (WHERE kind = 'hex') AS n_hex, string_agg({item}, ',' ORDER BY start, rank) FILTER (WHERE {base}) AS b,
         string_agg({item}, ',' ORDER BY start, rank) AS spans FROM r GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(b, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents d LEFT JOIN a USING (doc_id)
"""


ORACLES["op9_secret_scan"] = _secret_sql()


@register
def op10_license_scan(spark, sf_dir):
    """Known licence texts and notices in all documents."""
    return licences.scan(table(spark, sf_dir, "documents"))


def _licence_sql() -> str:
    def quoted(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    def canonical(t: str) -> str:
        plain = (f"trim(regexp_replace(regexp_replace(lower({t}), {quoted(licences.COPYRIGHT_LINE)}, ' ', 'g'), "
                 f"{quoted(licences.OTHER)}, ' ', 'g'))")
        return f"array_to_string(list_transform(string_split({plain}, ' '), lambda w: coalesce(spelt[w], w)), ' ')"

    spelt = "MAP {" + ", ".join(f"{quoted(a)}: {quoted(b)}" for a, b in SPELLINGS.items()) + "}"
    known = ", ".join(f"({quoted(a)}, {quoted(b)})" for a, b in LICENCES)
    return f"""
WITH s AS (SELECT {spelt} AS spelt),
k AS (SELECT DISTINCT licence, sha256({canonical('text')}) AS digest FROM (VALUES {known}) v(licence, text), s),
u AS (
  SELECT doc_id, 'whole' AS unit, text AS t FROM documents
  UNION SELECT doc_id, 'paragraph', unnest(string_split_regex(text, '\\n[ \\t\\r]*\\n')) FROM documents
  UNION SELECT doc_id, 'line', unnest(string_split_regex(text, '\\r?\\n')) FROM documents),
m AS (
  SELECT doc_id, unit, licence, digest FROM (SELECT doc_id, unit, sha256({canonical('t')}) AS digest FROM u, s) JOIN k USING (digest)),
a AS (
  SELECT doc_id, min(licence) FILTER (WHERE unit = 'whole') AS whole_license,
         string_agg(DISTINCT licence, ',' ORDER BY licence) AS licenses, count(DISTINCT licence) AS n_licenses,
         count(DISTINCT digest) AS n_units FROM m GROUP BY doc_id)
SELECT d.doc_id, whole_license, coalesce(licenses, '') AS licenses, coalesce(n_licenses, 0) AS n_licenses,
       coalesce(n_units, 0) AS n_units
FROM documents d LEFT JOIN a USING (doc_id)
"""


ORACLES["op10_license_scan"] = _licence_sql()


@register
def op3_toxicity(spark, sf_dir):
    """Toxicity scores of all documents from a field trained on the rows that are not held out."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    field = toxicity.fit(docs, labels, learn=fold_remainder("doc_id", 5) != 0)
    scored = toxicity.score(docs, field)
    return scored.select("doc_id", F.coalesce(fold_remainder("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score", "predicted",
                         "span_starts", "span_ends")


@register
def op5_quality(spark, sf_dir):
    """Quality scores of all documents by votes of the labelled ones that are not held out."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    voters = quality.fit(docs, labels, learn=fold_remainder("doc_id", 3) != 1)
    scored = quality.score(docs, voters)
    return scored.select("doc_id", F.coalesce(fold_remainder("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "score", "predicted")


@register
def op6_language(spark, sf_dir):
    """Languages of all documents from filters filled with documents that are not held out."""
    docs = table(spark, sf_dir, "documents")
    filters = language.fit(docs, fold_remainder("doc_id", 4) != 2)
    named = language.predict(docs, filters)
    return named.select("doc_id", F.coalesce(fold_remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


@register
def op8_suffix_array_dedup(spark, sf_dir):
    """Bytes of all documents that lie in 400-byte strings occurring more than once."""
    cut = substrings.deduplicate(table(spark, sf_dir, "documents"))
    removed = F.aggregate(F.zip_with("span_ends", "span_starts", lambda e, s: e - s), F.lit(0).cast("long"), lambda a, x: a + x)
    return cut.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("span_starts").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"), F.octet_length("kept").cast("long").alias("n_kept"))


@register
def op7_embedding_near_duplicates(spark, sf_dir):
    """Near-duplicate vectors of all embeddings by NN-descent."""
    return neighbours.near_duplicates(table(spark, sf_dir, "embeddings"))


@register
def op11_importance_resampling(spark, sf_dir):
    """Weights of all documents towards the benchmark's words, and the tenth drawn by them."""
    drawn = importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


ORACLES["op11_importance_resampling"] = r"""
WITH crc AS (
  SELECT list(c ORDER BY i) AS t
  FROM (SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
        FROM range(256) r(i))),
d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM benchmark),
dw AS (SELECT doc_id, unnest(w) AS word FROM d),
bytes AS (
  SELECT word, list_transform(range(CAST(length(x) // 2 AS BIGINT)), lambda k: CAST('0x' || substr(x, 2 * k + 1, 2) AS BIGINT)) AS bs
  FROM (SELECT word, hex(encode(word)) AS x FROM (SELECT word FROM dw UNION SELECT word FROM b))),
bucket AS (
  SELECT word, xor(list_reduce(list_prepend(4294967295, bs), lambda c, v: xor(c >> 8, t[1 + xor(c & 255, v)])), 4294967295) % 10000 AS k
  FROM bytes, crc),
s AS (SELECT k, count(*) AS n FROM dw JOIN bucket USING (word) GROUP BY k),
t AS (SELECT k, count(*) AS n FROM b JOIN bucket USING (word) GROUP BY k),
gain AS (
  SELECT k, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM s)::DOUBLE + 10000)
         / ((s.n + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM t)::DOUBLE + 10000)))) AS g
  FROM s LEFT JOIN t USING (k)),
weighed AS (SELECT doc_id, CAST(sum(g) AS BIGINT) AS weight FROM dw JOIN bucket USING (word) JOIN gain USING (k) GROUP BY doc_id),
scored AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || CAST(d.doc_id AS VARCHAR)), 1, 8) AS BIGINT)
                                          + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score
  FROM d LEFT JOIN weighed USING (doc_id)),
placed AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN r <= 10 * n // 100 THEN r END AS rank
FROM scored LEFT JOIN placed USING (doc_id)
"""


@register
def op12_filter_audit(spark, sf_dir):
    """What five filters remove of all documents, alone and together, in every order."""
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLES["op12_filter_audit"] = r"""
WITH w AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
f AS (
  SELECT w.doc_id, part, unnest([
    {'c': 'A', 'fails': len(words) < 200}, {'c': 'B', 'fails': 100 * len(list_distinct(words)) < 50 * len(words)},
    {'c': 'C', 'fails': 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text)},
    {'c': 'D', 'fails': regexp_matches(text, '[#$%&*|]')}, {'c': 'E', 'fails': doc_id > min(doc_id) OVER (PARTITION BY text)}]) AS v
  FROM w),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
m AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic
  FROM (SELECT doc_id, part, string_agg(v.c, '' ORDER BY v.c) FILTER (WHERE v.fails) AS fails FROM f GROUP BY doc_id, part)
  LEFT JOIN l USING (doc_id) GROUP BY part, fails),
c AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
o AS (
  SELECT c1.c || c2.c || c3.c || c4.c || c5.c AS filter_order FROM c c1, c c2, c c3, c c4, c c5
  WHERE len(list_distinct([c1.c, c2.c, c3.c, c4.c, c5.c])) = 5),
s AS (
  SELECT filter_order, CAST(step AS INTEGER) AS step, substr(filter_order, step, 1) AS c, left(filter_order, step - 1) AS before
  FROM o, range(1, 6) r(step)),
r AS (
  SELECT part, filter_order, step, c,
    sum(n) FILTER (WHERE fails IS NULL OR translate(fails, before || c, '') = fails) AS kept,
    sum(n) FILTER (WHERE contains(fails, c) AND translate(fails, before, '') = fails) AS removed,
    sum(n) FILTER (WHERE contains(fails, c) AND translate(fails, before, '') <> fails) AS redundant,
    sum(n) FILTER (WHERE fails = c) AS unique_fails,
    sum(good) FILTER (WHERE contains(fails, c) AND translate(fails, before, '') = fails) AS good_lost,
    sum(toxic) FILTER (WHERE contains(fails, c) AND translate(fails, before, '') = fails) AS toxic_lost
  FROM m, s GROUP BY ALL)
SELECT part, filter_order, step, CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
       CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
       CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
       CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, c) AS BIGINT) AS shapley
FROM r
"""


@register
def op13_sentencepiece_round_trip(spark, sf_dir):
    """Token ids of all documents and the texts that decoding makes of them."""
    model = pieces.read_model(public_tokenizers.path("piece_bpe_32k.model"))
    back = pieces.decode(pieces.encode(table(spark, sf_dir, "documents"), model), model)
    return back.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))
