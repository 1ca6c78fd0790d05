"""Readers for the driver's parquet tables and the shipment view built from them.

Role mapping (driver tables -> shipment domain): a shipment is a ``lineitem``
row joined to its ``orders`` row; the consignee is ``o_custkey``, the arrival
time ``o_orderdate`` and the pickup time ``l_shipdate``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.time import hours_between

# Columns that make shipment order total: arrival time first, then every lineitem column.
SHIPMENT_TIEBREAK = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                     "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
                     "l_shipdate")


SPREAD = "spark.berthline.spread"  # rows of every table are dealt to so many partitions (bench on few files)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read a driver table; the setting ``spark.berthline.spread`` (unset by default) deals its
    rows to that many partitions, for benches whose tables are single unsplittable files."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    spread = spark.conf.get(SPREAD, None)
    return df.repartition(int(spread)) if spread else df


def shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem ⋈ orders with consignee, arrival, pickup and the arrival-to-pickup hours."""
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"], "inner").drop("o_orderkey")
    return j.select(*SHIPMENT_TIEBREAK,
                    F.col("o_custkey").alias("consignee"),
                    F.col("o_orderdate").alias("arrival_time"),
                    F.col("l_shipdate").alias("pickup_date"),
                    hours_between(F.col("o_orderdate"), F.col("l_shipdate")).alias("arrival_to_pickup_time"))


SHIPMENTS_SQL = """
  SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_quantity, l.l_extendedprice,
         l.l_discount, l.l_tax, l.l_returnflag, l.l_linestatus, l.l_shipdate,
         o.o_custkey AS consignee, o.o_orderdate AS arrival_time, l.l_shipdate AS pickup_date,
         date_diff('microsecond', o.o_orderdate, l.l_shipdate) / 3.6e9 AS arrival_to_pickup_time
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
"""

SHIPMENT_ORDER_SQL = "arrival_time, " + ", ".join(SHIPMENT_TIEBREAK)


def round_half_up(c, digits: int = 4):
    """``floor(x * 10^d + 0.5) / 10^d`` in double arithmetic.

    Spark's ``round`` rounds the exact binary value while DuckDB's rounds the
    scaled float, so exact halves (0.11625) can split; this formula is computed
    identically by both engines.
    """
    scale = float(10 ** digits)
    return F.floor(c * F.lit(scale) + F.lit(0.5)).cast("double") / F.lit(scale)


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    """Round every double column (order-insensitive value hashes need stable last digits)."""
    return df.withColumns({f.name: round_half_up(F.col(f.name), digits) for f in df.schema.fields
                           if f.dataType.typeName() == "double"})
