"""Column helpers evaluated at plan time (schema only) and column expressions.

Nothing here touches data: the selectors read ``df.schema`` and the
expression builders return ``Column`` objects that stay inside whole-stage
codegen.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType,
                 T.FloatType, T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Numeric columns in schema order; booleans are not numeric (as pandas)."""
    ex = set(exclude)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NUMERIC_TYPES) and f.name not in ex]


def string_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    ex = set(exclude)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.StringType) and f.name not in ex]


def existing(df: DataFrame, cols: Sequence[str]) -> list[str]:
    """The subset of ``cols`` present in ``df``, in the given order."""
    have = set(df.columns)
    return [c for c in cols if c in have]


def select_existing(df: DataFrame, cols: Sequence[str], fallback_numeric: bool = True,
                    required: Sequence[str] = ()) -> list[str]:
    """Feature selection with the reference's fallback to all numeric columns.

    Raises if a required key column is missing.
    """
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise KeyError(f"required columns missing: {missing}")
    found = existing(df, cols)
    if not found and fallback_numeric:
        found = numeric_columns(df)
    return found


def columns_containing(df: DataFrame, needles: Sequence[str], upper: bool = True) -> list[str]:
    """Columns whose name holds any of ``needles`` (case-folded when ``upper``)."""
    out = []
    for c in df.columns:
        name = c.upper() if upper else c
        if any((n.upper() if upper else n) in name for n in needles):
            out.append(c)
    return out


def upper_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.upper() for c in df.columns])


def prefix_columns(df: DataFrame, prefix: str, keep: Iterable[str] = ()) -> DataFrame:
    keep = set(keep)
    return df.withColumnsRenamed({c: prefix + c for c in df.columns if c not in keep})


def drop_existing(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    return df.drop(*[c for c in cols if c in df.columns])


def weekday_monday0(c: Column | str) -> Column:
    """Day of week with Monday = 0 (``F.dayofweek`` would give Sunday = 1)."""
    return F.weekday(c)


def round_even(c: Column | str, digits: int) -> Column:
    """NumPy/pandas rounding of doubles: scale, round halves to even, scale
    back (2.5 -> 2).  The same three double operations as the SQL engine's
    ``round_even``, so equal inputs round alike."""
    scale = F.lit(float(10 ** digits))
    return F.rint((F.col(c) if isinstance(c, str) else c) * scale) / scale


def concat_null(*parts: Column | str) -> Column:
    """Null-propagating concatenation (``a + ' ' + b`` on object columns)."""
    return F.concat(*[F.col(p) if isinstance(p, str) else p for p in parts])


def anomaly_confidence(score: Column | str) -> Column:
    """``1 - 1/(1+exp(-|s|))``; falls from 0.5 towards 0 as |s| grows."""
    s = F.col(score) if isinstance(score, str) else score
    return F.lit(1.0) - F.lit(1.0) / (F.lit(1.0) + F.exp(-F.abs(s)))


def safe_ratio(num: Column, den: Column) -> Column:
    """num/den, 0 when the denominator is 0 or NULL (scikit-learn zero_division=0)."""
    return F.coalesce(F.try_divide(num, den), F.lit(0.0))
