"""Row filters and de-duplication."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numeric import coerce_double
from .lookup import last_per_key
from .ordering import ORD


def remove_negative_values(df: DataFrame, feature_names: Sequence[str]) -> DataFrame:
    """Keep rows where every listed value is ``>= 0``; NULL and NaN fail the test."""
    conds = [coerce_double(F.col(c), df.schema[c].dataType) >= 0 for c in feature_names]
    return df.where(reduce(lambda a, b: a & b, conds)) if conds else df


def remove_null_records(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows with a missing value (NULL, or NaN in a float column) in any listed column."""
    conds = []
    for c in columns:
        dt = df.schema[c].dataType
        cond = F.col(c).isNotNull()
        if isinstance(dt, (T.DoubleType, T.FloatType)):
            cond = cond & ~F.isnan(F.col(c))
        conds.append(cond)
    return df.where(reduce(lambda a, b: a & b, conds)) if conds else df


def remove_duplicates(df: DataFrame, order: str = ORD) -> DataFrame:
    """Full-row distinct keeping the first occurrence (its ``order`` value is kept).

    ``dropDuplicates`` keeps an arbitrary row, which is wrong when a keep-last
    step follows; ``min(order)`` per distinct row is exact and combines map-side.
    """
    if order not in df.columns:
        return df.distinct()
    data = [c for c in df.columns if c != order]
    return df.groupBy(*data).agg(F.min(order).alias(order)).select(*df.columns)


def keep_last_per_key(df: DataFrame, key: str | Sequence[str], order: str = ORD) -> DataFrame:
    """``drop_duplicates(subset=key, keep='last')``."""
    return last_per_key(df, key, order, keep_order=True)
