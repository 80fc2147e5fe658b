"""Licence scan by canonical digest lookup.

A unit of text (the whole document, a paragraph, a line) is brought to a
canonical form: lower case, copyright lines taken out, everything but
letters and digits turned to single spaces, equivalent spellings made one.
The SHA-256 of the form is joined to the digests of the known licence texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from duelframe.llm.common import join_on, row_key
from duelframe.llm.licence_texts import CUES, LICENCES, SPELLINGS

COPYRIGHT_LINE = r"(?m)^[ \t]*(copyright[ \t]*(\(c\)|©|[0-9]{4}|by )|\(c\)[ \t]*[0-9]{4}|©|all rights reserved)[^\n]*$"
OTHER = r"[^\p{L}\p{N}]+"
BROADCAST_ROWS = 10_000


def canonical(text: Column) -> Column:
    """Canonical form of a text; without letters or digits it is empty."""
    plain = F.trim(F.regexp_replace(F.regexp_replace(F.lower(text), COPYRIGHT_LINE, " "), OTHER, " "))
    usual = F.create_map(*[F.lit(x) for pair in SPELLINGS.items() for x in pair])
    return F.array_join(F.transform(F.split(plain, " "), lambda w: F.coalesce(F.try_element_at(usual, w), w)), " ")


def known_digests(spark: SparkSession, licences=LICENCES) -> DataFrame:
    """(licence, digest) of the known texts."""
    known = spark.createDataFrame(licences, "licence string, text string")
    return known.select("licence", F.sha2(canonical(F.col("text")), 256).alias("digest")).distinct()


def units(docs: DataFrame, id_col: str, text_col: str, cues: str = CUES) -> DataFrame:
    """(id, key, unit, digest) of each distinct unit that can be a licence."""
    text = F.col(text_col)
    cue = f"(?i){cues}"

    def pieces(kind: str, pattern: str) -> Column:
        cut = F.filter(F.split(text, pattern, -1), lambda t: t.rlike(cue))
        return F.transform(F.array_distinct(cut), lambda t: F.struct(F.lit(kind).alias("unit"), t.alias("t")))

    whole = F.array(F.struct(F.lit("whole").alias("unit"), text.alias("t")))
    parts = F.concat(whole, pieces("paragraph", r"\n[ \t\r]*\n"), pieces("line", r"\r?\n"))
    held = docs.where(text.rlike(cue)).select(F.col(id_col).alias("id"), row_key(text).alias("key"), F.explode(parts).alias("p"))
    return held.select("id", "key", "p.unit", F.sha2(canonical(F.col("p.t")), 256).alias("digest"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", licences=LICENCES, cues: str = CUES) -> DataFrame:
    """Per row of ``docs``: id, whole_license, licenses, n_licenses, n_units.

    whole_license is the licence that the entire text is (null if none),
    licenses the sorted licences of its units joined by commas, n_licenses
    their number and n_units the number of distinct units found.  A null,
    empty or unknown text has none; repeated rows are each returned; other
    columns are ignored; an empty table gives no rows.  Every known text must
    hold one of ``cues``: texts without them are not digested.
    """
    spark = docs.sparkSession
    known = known_digests(spark, licences)
    found = units(docs, id_col, text_col, cues)
    if len(licences) <= BROADCAST_ROWS:             # the known texts' number bounds the digests
        known = F.broadcast(known)
    met = found.join(known, "digest").groupBy("id", "key").agg(
        F.min(F.when(F.col("unit") == "whole", F.col("licence"))).alias("whole_license"),
        F.array_sort(F.collect_set("licence")).alias("names"), F.count_distinct("digest").alias("n_units"))
    rows = docs.select(F.col(id_col).alias("id"), row_key(F.col(text_col)).alias("key"))
    out = join_on(rows, met, ["id", "key"], "left")
    return out.select(F.col("id").alias(id_col), "whole_license", F.coalesce(F.array_join("names", ","), F.lit("")).alias("licenses"),
                      F.coalesce(F.size("names"), F.lit(0)).cast("long").alias("n_licenses"),
                      F.coalesce("n_units", F.lit(0)).cast("long").alias("n_units"))
