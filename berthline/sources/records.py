"""Record JSON: epoch-millisecond dates, doubles to 10 decimals, NULL fields kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.time import micros_since_epoch

def epoch_millis(c, dtype: T.DataType):
    """Milliseconds since the epoch; zone-less timestamps are taken as UTC wall clock."""
    if isinstance(dtype, T.TimestampType):
        return F.unix_millis(c)
    return F.floor(micros_since_epoch(c.cast("timestamp_ntz")) / F.lit(1000)).cast("bigint")


def to_records(df: DataFrame, digits: int = 10) -> DataFrame:
    """The value encoding of ``to_json(orient='records')``: dates as epoch ms, doubles rounded."""
    cols = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            cols[f.name] = epoch_millis(F.col(f.name), f.dataType)
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.col(f.name)  # JSON has no NaN or Infinity: missing
            finite = ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))
            cols[f.name] = F.round(F.when(finite, c), digits)
    return df.withColumns(cols) if cols else df


def write_records(df: DataFrame, path: str, mode: str = "overwrite", partition_by=None,
                  encode: bool = True) -> None:
    """JSON Lines, one object per row, NULL fields written as ``null``."""
    out = to_records(df) if encode else df
    w = out.write.mode(mode).option("ignoreNullFields", "false")
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    w.json(path)


def read_records(spark: SparkSession, path: str, schema: T.StructType | str,
                 json_array: bool = False) -> DataFrame:
    """Read record JSON; ``json_array`` for files holding one JSON array (unsplittable)."""
    return spark.read.schema(schema).option("multiLine", json_array).json(path)


def variant_reader(spark: SparkSession, multiline: bool = False):
    """A JSON reader whose rows are one VARIANT column ``record``: no schema is needed or inferred, so
    files and records may differ in columns and types. A malformed record is an error."""
    return (spark.read.format("json").option("singleVariantColumn", "record").option("multiLine", multiline)
            .option("mode", "FAILFAST"))


def shred(df: DataFrame, columns: T.StructType | str, record: str = "record") -> DataFrame:
    """Replace the VARIANT column by typed ``columns``: those that are asked for and nothing else.

    A list of records (a whole file or line may be one) is a row per record. A column that a record lacks, or
    whose value does not fit the type, is NULL; numbers given as text are numbers.
    """
    schema = columns if isinstance(columns, T.StructType) else T.StructType.fromDDL(columns)
    clash = {f.name for f in schema.fields} & (set(df.columns) - {record})
    if clash:
        raise ValueError(f"columns are there already: {sorted(clash)}")
    own = F.col(record)
    rows = F.coalesce(F.try_variant_get(own, "$", "array<variant>"), F.array(own))
    out = df.select(*[c for c in df.columns if c != record], F.explode(rows).alias(record)).where(F.col(record).isNotNull())

    def field(f: T.StructField):
        quote = '"' if "'" in f.name else "'"
        path = f"$[{quote}{f.name}{quote}]"
        return F.try_variant_get(F.col(record), path, f.dataType.simpleString()).alias(f.name)

    return out.select(*[c for c in out.columns if c != record], *map(field, schema.fields))
