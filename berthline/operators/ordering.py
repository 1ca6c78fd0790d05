"""Row order and global ranks computed without a single-task window.

pandas rows carry an order that Spark rows do not, so every order-dependent
operator takes an explicit ordering column (``_ord`` by convention). Global
ranks over a total order use range partitioning plus per-partition offsets
(the ``zipWithIndex`` scheme) instead of ``Window.orderBy`` with no partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, materialize

ORD = "_ord"
LOCAL_BITS = 33  # monotonically_increasing_id keeps the row number in its low 33 bits


def with_order(df: DataFrame, *cols: str | Column, name: str = ORD) -> DataFrame:
    """Declare the row order of a table: one column as is, several as a struct (ties broken
    left to right). A scalar order keeps ``min_by``/``max_by`` on hash aggregation."""
    exprs = [F.col(c) if isinstance(c, str) else c for c in cols]
    return df.withColumn(name, exprs[0] if len(exprs) == 1 else F.struct(*exprs))


def with_input_order(df: DataFrame, name: str = ORD) -> DataFrame:
    """Order rows as they appear in their files: (file, split start, position in split).

    ``monotonically_increasing_id`` alone does not follow file order across files,
    but inside one split it does; the struct gives the exact line order.
    """
    return df.withColumn(name, F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row")))


def ensure_order(df: DataFrame, name: str = ORD) -> DataFrame:
    """Keep an existing order column; else order by file position, else by in-memory position."""
    if name in df.columns:
        return df
    try:
        return with_input_order(df, name)
    except Exception:  # noqa: BLE001 - not a file scan: no _metadata column
        return df.withColumn(name, F.struct(F.monotonically_increasing_id().alias("row")))


def _partitions(df: DataFrame, partitions: int | None) -> int:
    if partitions:
        return partitions
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def global_index(df: DataFrame, order: Sequence[str], name: str = "_idx",
                 partitions: int | None = None) -> DataFrame:
    """Add a consecutive 0-based ``name`` following ``order`` (a total order is the caller's job).

    Range-partitions by ``order``, numbers rows inside each partition, then adds the
    row count of all earlier partitions. The per-partition count table has at most
    ``partitions`` rows, which bounds what is broadcast. The numbered table is
    checkpointed to the shared folder so both uses see the same partition layout.
    """
    ensure_checkpoint_dir(df.sparkSession)
    n = _partitions(df, partitions)
    cols = [F.col(c) for c in order]
    s = (df.repartitionByRange(n, *cols).sortWithinPartitions(*cols)
         .withColumn("_mid", F.monotonically_increasing_id())
         .checkpoint(eager=True))
    pid = F.shiftright(F.col("_mid"), LOCAL_BITS)
    counts = s.groupBy(pid.alias("_pid")).agg(F.count(F.lit(1)).alias("_n"))
    # at most `n` rows: one per non-empty partition
    offsets = counts.select(
        "_pid",
        F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_off"))
    out = s.withColumn("_pid", pid).join(F.broadcast(offsets), "_pid", "left")
    local = F.col("_mid").bitwiseAND(F.lit((1 << LOCAL_BITS) - 1))
    return out.withColumn(name, (F.col("_off") + local).cast("bigint")).drop("_pid", "_off", "_mid")


def previous_row(df: DataFrame, order: str | Sequence[str], cols: Sequence[str], prefix: str = "prev_",
                 partitions: int | None = None) -> DataFrame:
    """Attach the values of the row that precedes each row in the total ``order``.

    A distributed ``lag`` over a global order: the rows are range-partitioned and sorted, the lag
    runs inside each partition, and only the last row of each partition (at most
    ``partitions`` rows) crosses to the first row of the next one.
    """
    keys = [order] if isinstance(order, str) else list(order)
    spark = df.sparkSession
    s = (df.repartitionByRange(_partitions(df, partitions), *keys).sortWithinPartitions(*keys)
         .withColumn("_mid", F.monotonically_increasing_id()).withColumn("_pid", F.shiftright("_mid", LOCAL_BITS)))
    s = materialize(s, "ordered")
    w = Window.partitionBy("_pid").orderBy("_mid")
    values = F.struct(*[F.col(c) for c in cols])
    lagged = s.withColumn("_before", F.lag(values).over(w))
    ends = s.groupBy("_pid").agg(F.max_by(values, "_mid").alias("_v"), F.min("_mid").alias("_first")).orderBy("_pid").collect()
    kind = s.select(values.alias("v")).schema["v"].dataType.simpleString()
    over = spark.createDataFrame([(q["_first"], p["_v"]) for p, q in zip(ends, ends[1:])], f"_mid bigint, _over {kind}")
    out = lagged.join(F.broadcast(over), "_mid", "left")  # one row per partition at most
    before = F.coalesce("_before", "_over")
    return out.withColumns({prefix + c: before[c] for c in cols}).drop("_mid", "_pid", "_before", "_over")
