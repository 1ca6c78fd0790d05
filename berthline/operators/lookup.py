"""Keyed lookups: first/last row per key, overwrite-style left lookup, arrival lookup."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordering import ORD


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def first_per_key(df: DataFrame, key: str | Sequence[str], order: str = ORD,
                  keep_order: bool = False) -> DataFrame:
    """One row per key: the earliest in ``order`` (``drop_duplicates(keep='first')``).

    An aggregate with ``min_by`` so a hot key is combined map-side before the shuffle.
    """
    return _pick(df, key, order, F.min_by, keep_order)


def last_per_key(df: DataFrame, key: str | Sequence[str], order: str = ORD,
                 keep_order: bool = True) -> DataFrame:
    """One row per key: the latest in ``order`` (``drop_duplicates(keep='last')``)."""
    return _pick(df, key, order, F.max_by, keep_order)


def _pick(df, key, order, fn, keep_order):
    keys = _keys(key)
    payload = [c for c in df.columns if c not in keys and c != order]
    cols = payload + ([order] if keep_order else [])
    if not cols:
        return df.select(*keys).distinct()
    picked = df.groupBy(*keys).agg(fn(F.struct(*cols), F.col(order)).alias("_row"))
    out = picked.select(*keys, *[F.col("_row")[c].alias(c) for c in cols])
    return out.select(*[c for c in df.columns if c in out.columns])


def map_on_key(df1: DataFrame, df2: DataFrame, key_col: str, order: str = ORD,
               deduplicated: bool = False, how: str = "left") -> DataFrame:
    """Left lookup of every ``df2`` column onto ``df1`` by ``key_col``.

    ``df2`` is reduced to its first row per key; its columns **overwrite** same-named
    ``df1`` columns (NULL where the key is missing); ``df1`` keeps its row count.
    Under AQE the reduced side is broadcast at run time when its measured size is
    below the broadcast threshold, otherwise the join is a shuffle join with skew
    splitting.
    """
    if deduplicated:
        dim = df2.drop(order) if order in df2.columns else df2
    elif order in df2.columns:
        dim = first_per_key(df2, key_col, order)
    else:
        dim = df2.dropDuplicates([key_col])
    values = [c for c in dim.columns if c != key_col]
    left = df1.drop(*[c for c in values if c in df1.columns])
    out = left.join(dim, on=key_col, how=how)
    ordered = [c for c in df1.columns] + [c for c in values if c not in df1.columns]
    return out.select(*ordered)


def add_arrival_time(main_df: DataFrame, ref_df: DataFrame, code: str = "voyage_code",
                     value: str = "arrival_timestamp", new_col: str = "arrival_time",
                     order: str = ORD) -> DataFrame:
    """``new_col`` = ``value`` of the first ``ref_df`` row with the same ``code`` (NULL if none)."""
    ref = ref_df.select(code, value, *([order] if order in ref_df.columns else []))
    dim = first_per_key(ref, code, order) if order in ref.columns else ref.dropDuplicates([code])
    dim = dim.withColumnRenamed(value, "_arrival")
    out = main_df.drop(new_col).join(dim, on=code, how="left").withColumnRenamed("_arrival", new_col)
    cols = list(main_df.columns) if new_col in main_df.columns else [*main_df.columns, new_col]
    return out.select(*cols)
