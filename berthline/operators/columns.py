"""Projections and scalar features (header rules, keys, voyage codes, coercion, flags)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import DATE_COLUMNS, DROP_COLUMNS, NULL_TEXT, WEEKEND_DAYS
from ..functions.numeric import coerce_double, coerce_long
from ..functions.text import key_part, normalise_header
from ..functions.time import coerce_timestamp, day_name


def dtype_of(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def standardize_column_names(df: DataFrame, keep: Iterable[str] = ("_ord",)) -> DataFrame:
    """Normalise every header; empty or colliding results are an error, not a silent merge.

    Internal columns named in ``keep`` (the row order) are left as they are.
    """
    keep = set(keep)
    names = [c if c in keep else normalise_header(c) for c in df.columns]
    if any(not n for n in names):
        raise ValueError(f"header normalises to an empty name: {df.columns}")
    if len(set(names)) != len(names):
        raise ValueError(f"headers collide after normalisation: {names}")
    return df.toDF(*names)


def remove_columns(df: DataFrame, columns: Iterable[str] = DROP_COLUMNS) -> DataFrame:
    """Drop the named columns; names not present are ignored."""
    return df.drop(*[c for c in columns if c in df.columns])


def select_present(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep the listed columns that exist, in list order (scored output projections)."""
    return df.select(*[c for c in columns if c in df.columns])


def create_key_feature(df: DataFrame) -> DataFrame:
    """``key = equipment_id + '_' + booking_number`` with the booking coerced to an integer.

    A no-op unless both columns exist. Null parts become ``nan`` / ``<NA>`` text, so
    rows with missing parts share one key instead of getting a NULL key.
    """
    if "equipment_id" not in df.columns or "booking_number" not in df.columns:
        return df
    df = df.withColumn("booking_number",
                       coerce_long(F.col("booking_number"), dtype_of(df, "booking_number")))
    return df.withColumn("key", F.concat(key_part(F.col("equipment_id")), F.lit("_"),
                                         key_part(F.col("booking_number"), integer=True)))


def _code_part(df: DataFrame, name: str, number: bool = False) -> Column:
    """A code column as text.

    With ``number`` (voyage numbers) an integral value renders as a plain integer
    whatever its type or text (``12``, ``12.0`` and ``'12.0'`` all give ``12``), so
    codes built from text and from integers agree; other values keep their text.
    """
    dt = dtype_of(df, name)
    c = F.col(name)
    if isinstance(dt, T.IntegralType):
        return key_part(c)
    if not number:
        return key_part(c)
    return F.coalesce(coerce_long(c, dt).cast("string"), c.cast("string"), F.lit(NULL_TEXT))


def create_voyage_code(df: DataFrame, vessel_col: str, voyage_col: str,
                       new_feature_name: str = "voyage_code", direction: str = "E") -> DataFrame:
    """``vessel_voyage_E``: the direction is fixed."""
    return df.withColumn(new_feature_name, F.concat(
        _code_part(df, vessel_col), F.lit("_"), _code_part(df, voyage_col, number=True),
        F.lit("_" + direction)))


def create_voyage_code_1(df: DataFrame, vessel_col: str, voyage_col: str, direction_col: str,
                         new_feature_name: str = "voyage_code") -> DataFrame:
    """``vessel_voyage_direction``; an integer voyage renders as ``<NA>`` when missing."""
    voy = (key_part(F.col(voyage_col), integer=True)
           if isinstance(dtype_of(df, voyage_col), T.IntegralType) else _code_part(df, voyage_col, number=True))
    return df.withColumn(new_feature_name, F.concat(
        _code_part(df, vessel_col), F.lit("_"), voy, F.lit("_"), _code_part(df, direction_col)))


def add_next_voyage(df: DataFrame, feature_name: str) -> DataFrame:
    """Coerce ``feature_name`` to a number in place and add ``next_voyage = value + 1`` (bigint).

    Voyage numbers are canonicalised to bigint so ``12`` and ``12.0`` give the same code.
    """
    dt = dtype_of(df, feature_name)
    v = coerce_double(F.col(feature_name), dt)
    df = df.withColumn(feature_name, v)
    return df.withColumn("next_voyage", coerce_long(F.col(feature_name) + 1, T.DoubleType()))


def standardize_datetime_columns(df: DataFrame, columns: Iterable[str] = DATE_COLUMNS) -> DataFrame:
    """Parse the listed columns to timestamps (unparsable -> NULL); absent columns are skipped."""
    schema = df.schema
    present = [c for c in columns if c in schema.names]
    if not present:
        return df
    return df.withColumns({c: coerce_timestamp(F.col(c), schema[c].dataType) for c in present})


def add_day_of_week(df: DataFrame, datetime_col: str, new_col: str = "avp_day_of_week") -> DataFrame:
    """Full day name of ``datetime_col`` into ``avp_day_of_week`` (the output name is fixed).

    Text is parsed strictly, as in the surveyed step: an unparsable value is an error.
    """
    ts = coerce_timestamp(F.col(datetime_col), dtype_of(df, datetime_col), strict=True)
    return df.withColumns({datetime_col: ts, new_col: day_name(ts)})


def create_binary_feature(df: DataFrame, feature_name: str, threshold: float,
                          new_feature_name: str) -> DataFrame:
    """``feature < threshold`` as 0/1; a missing value compares false and gives 0."""
    x = coerce_double(F.col(feature_name), dtype_of(df, feature_name))
    return df.withColumn(new_feature_name, F.coalesce(x < F.lit(threshold), F.lit(False)).cast("int"))


def fill_null_values(df: DataFrame, column: str, value) -> DataFrame:
    """Fill NULL in one column with a constant; a missing column is an error."""
    if column not in df.columns:
        raise KeyError(column)
    c = F.col(column)
    if isinstance(dtype_of(df, column), (T.DoubleType, T.FloatType)):
        c = F.nanvl(c, F.lit(None))
    return df.withColumn(column, F.coalesce(c, F.lit(value).cast(dtype_of(df, column))))


def add_time_parts(df: DataFrame, ts_col: str, prefix: str = "arrival") -> DataFrame:
    """Hour (0-23), weekday (Monday = 0) and weekend flag of a timestamp."""
    ts = F.col(ts_col)
    return df.withColumns({
        f"{prefix}_hour": F.hour(ts),
        f"{prefix}_weekday": F.weekday(ts),
        "is_weekend": F.weekday(ts).isin(*WEEKEND_DAYS),
    })


def bools_to_ints(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Every boolean column (or the listed ones) -> 0/1 integer; NULL stays NULL."""
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.BooleanType)
             and (columns is None or f.name in set(columns))]
    if not names:
        return df
    return df.withColumns({n: F.col(n).cast("int") for n in names})

