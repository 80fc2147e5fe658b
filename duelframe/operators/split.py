"""Repeatable sampling, splits and fold ids from row-key hashes.

A row's fate depends only on its key and the seed (``xxhash64``), never on
partitioning or task order, so retries and repartitioning give the same
split.  No global sort or single-partition window is needed: each row
decides locally.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def unit_hash(keys: Sequence[str], seed: int, role: str) -> Column:
    """A number in [0, 1) from the row key, the seed and the role.

    The role ("sample", "split", "fold") salts the hash, so which rows a
    sample takes says nothing about their side of the split or their fold.
    MD5 is used because every SQL engine has it; 13 hex digits fill a
    double's 52 bits exactly."""
    text = F.concat_ws("|", F.lit(role), F.lit(str(seed)), *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def unit_hash_sql(keys: Sequence[str], seed: int, role: str) -> str:
    """The same number in DuckDB's SQL."""
    text = " || '|' || ".join([f"'{role}|{seed}'", *[f"coalesce(CAST({k} AS VARCHAR), '')" for k in keys]])
    return f"CAST('0x' || substr(md5({text}), 1, 13) AS BIGINT) / 4503599627370496.0::DOUBLE"


def sample_n(df: DataFrame, n: int, keys: Sequence[str], seed: int = 42) -> DataFrame:
    """Exactly ``n`` rows (or all, if fewer), those with the smallest key hash.

    Planned as TakeOrderedAndProject: each task keeps its n best rows."""
    return df.orderBy(unit_hash(keys, seed, "sample"), *keys).limit(n)


def split_frac(df: DataFrame, keys: Sequence[str], test_frac: float = 0.2, seed: int = 42,
               label: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(train, test): a row is test when its key hash falls below
    ``test_frac``.  With ``label`` the hash is salted by the class, so each
    class is split at the same rate independently (stratified in
    expectation).  Train and test are disjoint and cover the input."""
    u = unit_hash(list(keys) + ([label] if label else []), seed, "split")
    return df.where(u >= test_frac), df.where(u < test_frac)


def fold_ids(df: DataFrame, keys: Sequence[str], k: int = 5, seed: int = 42, label: str | None = None,
             col: str = "FOLD") -> DataFrame:
    """Fold id in 0..k-1 from the key hash (salted by class if ``label``)."""
    ks = list(keys) + ([label] if label else [])
    return df.withColumn(col, F.floor(unit_hash(ks, seed, "fold") * F.lit(k)).cast("int"))
