"""Numeric coercion with pandas ``to_numeric(errors='coerce')`` meaning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def nan_to_null(c: Column) -> Column:
    """NaN -> NULL for doubles; Spark orders NaN above every number, pandas treats it as missing."""
    return F.nanvl(c, F.lit(None).cast("double"))


def coerce_double(c: Column, dtype: T.DataType | None = None) -> Column:
    """Text or number -> double; unparsable text and NaN -> NULL."""
    if dtype is not None and isinstance(dtype, T.NumericType):
        return nan_to_null(c.cast("double"))
    return nan_to_null(c.try_cast("double"))


def coerce_long(c: Column, dtype: T.DataType | None = None, strict: bool = False) -> Column:
    """Text or number -> bigint the way ``to_numeric`` + ``astype('Int64')`` does.

    ``'12'`` and ``'12.0'`` give 12; unparsable text gives NULL. A fractional
    value cannot become an integer: NULL by default, an error with ``strict``.
    """
    if dtype is not None and isinstance(dtype, T.IntegralType):
        return c.cast("bigint")
    d = coerce_double(c, dtype)
    integral = d == F.floor(d)
    whole = F.when(integral, d.cast("bigint"))
    if strict:
        whole = F.when(d.isNull() | integral, whole).otherwise(
            F.raise_error(F.concat(F.lit("cannot convert non-integral value to integer: "),
                                   c.cast("string"))))
    if dtype is not None and isinstance(dtype, T.NumericType):
        return whole
    # exact path first so that integers above 2**53 keep every digit
    return F.coalesce(c.try_cast("bigint"), whole)
