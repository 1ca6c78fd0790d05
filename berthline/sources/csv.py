"""CSV uploads read the way the surveyed pipeline reads them, but as a distributed scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import NA_TOKENS
from ..operators.ordering import with_input_order
from .paths import literal, plain_name


def null_tokens(c: Column, tokens: Sequence[str] = NA_TOKENS) -> Column:
    """Text equal to one of the missing-value tokens -> NULL (the reader has only one ``nullValue``)."""
    return F.when(c.isin(*tokens), F.lit(None).cast("string")).otherwise(c)


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | None = None,
             multiline: bool = False, tokens: Sequence[str] = NA_TOKENS,
             input_order: bool = True, source_file: bool = False, by_header: bool = False) -> DataFrame:
    """Header CSV -> DataFrame with NA tokens nulled, typed by ``schema`` when given.

    Every field is read as text first, so a token like ``NA`` in a numeric column
    becomes NULL instead of failing the row; typed columns are then ``try_cast``.
    ``multiline`` is needed only for quoted newlines (it makes files unsplittable).
    ``input_order`` adds ``_ord`` (file, split, position) for order-sensitive steps.

    Several files must have the same header, in the same order (a different one is an error,
    never a silent exchange of columns). ``by_header`` reads every file by its own header and
    joins the columns by name; it costs one scan more, for the headers.
    """
    if by_header:
        groups = files_by_header(spark, [path] if isinstance(path, str) else list(path))
        parts = [read_csv(spark, list(map(literal, files)), schema, multiline, tokens, input_order, source_file) for files in groups]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p, allowMissingColumns=True)
        return out
    reader = (spark.read.option("header", True).option("quote", '"').option("escape", '"')
              .option("multiLine", multiline).option("mode", "PERMISSIVE").option("enforceSchema", False))
    paths = [path] if isinstance(path, str) else list(path)
    names = reader.csv(paths).columns
    text = T.StructType([T.StructField(n, T.StringType()) for n in names])
    df = reader.schema(text).csv(paths)
    if input_order:
        df = with_input_order(df)
    if source_file:
        df = df.withColumn("source_file", F.col("_metadata.file_path"))
    df = df.withColumns({n: null_tokens(F.col(n), tokens) for n in names})
    if schema is not None:
        df = df.withColumns({f.name: F.col(f.name).try_cast(f.dataType) for f in schema.fields
                             if f.name in names and not isinstance(f.dataType, T.StringType)})
    return df


def files_by_header(spark: SparkSession, paths: list[str]) -> list[list[str]]:
    """The names of the files below ``paths``, grouped by their first line (one row per file reaches
    the driver). Files without any line are left out."""
    lines = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("f"),
                                          F.col("_metadata.file_block_start").alias("b"),
                                          F.monotonically_increasing_id().alias("i")).where("b = 0")
    groups: dict[str, list[str]] = {}
    for r in lines.groupBy("f").agg(F.min_by("value", "i").alias("head")).orderBy("f").collect():
        groups.setdefault(r["head"], []).append(plain_name(r["f"]))
    return list(groups.values())


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).option("quote", '"').option("escape", '"').csv(path)
