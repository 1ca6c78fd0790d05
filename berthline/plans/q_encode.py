"""Registered encoder queries (E1-E7, K10) over orders, customer and part."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.encode import (apply_one_hot_encoding, binary_encode, convert_objects_to_ints,
                                encode_consignee_features, target_encode)
from ..operators import stored
from ..operators.encode import fit_ordinal, fit_target
from ..session import scratch_path
from .registry import register
from .tables import rounded, table

_PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
_STATUSES = ("F", "O", "P")


@register("one_hot", """
SELECT o_orderkey, CAST(o_totalprice > 200000 AS INTEGER) AS is_big,
""" + ",\n".join(
    [f"CAST(coalesce(o_orderpriority = '{v}', false) AS INTEGER) AS \"o_orderpriority_{v}\"" for v in _PRIORITIES[1:]]
    + [f"CAST(coalesce(o_orderstatus = '{v}', false) AS INTEGER) AS \"o_orderstatus_{v}\"" for v in _STATUSES[1:]])
    + "\nFROM orders")
def q_one_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dummies for priority and status (first category dropped), booleans as 0/1."""
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", (F.col("o_totalprice") > 200000).alias("is_big"), "o_orderpriority", "o_orderstatus")
    return apply_one_hot_encoding(o, ["o_orderpriority", "o_orderstatus"])


@register("target_encode", """
WITH t AS (SELECT o_orderkey, o_orderpriority, 'C' || CAST(o_custkey AS VARCHAR) AS cust,
                  CAST(o_orderstatus = 'F' AS INTEGER) AS target FROM orders),
g AS (SELECT avg(target) AS gm FROM t),
a AS (SELECT o_orderpriority, (count(target) * avg(target) + 10 * (SELECT gm FROM g)) / (count(target) + 10) AS enc
      FROM t GROUP BY 1),
b AS (SELECT cust, (count(target) * avg(target) + 10 * (SELECT gm FROM g)) / (count(target) + 10) AS enc
      FROM t GROUP BY 1)
SELECT t.o_orderkey, round(a.enc, 4) AS o_orderpriority, round(b.enc, 4) AS cust, t.target
FROM t LEFT JOIN a USING (o_orderpriority) LEFT JOIN b USING (cust)
""")
def q_target_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderpriority", F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("cust"),
        (F.col("o_orderstatus") == "F").cast("int").alias("target"))
    return rounded(target_encode(o, ["o_orderpriority", "cust"], "target", alpha=10))


@register("binary_encode", """
WITH c AS (SELECT c_custkey, CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE c_mktsegment END AS seg FROM customer),
d AS (SELECT seg, CAST(row_number() OVER (ORDER BY seg) - 1 AS BIGINT) AS code
      FROM (SELECT DISTINCT seg FROM c WHERE seg IS NOT NULL))
SELECT c.c_custkey,
       CAST((d.code >> 2) & 1 AS VARCHAR) AS seg_bin0,
       CAST((d.code >> 1) & 1 AS VARCHAR) AS seg_bin1,
       CAST(d.code & 1 AS VARCHAR) AS seg_bin2
FROM c LEFT JOIN d USING (seg)
""")
def q_binary_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Market segment (5 values -> 3 bits), NULL segments give NULL bits."""
    c = table(spark, sf_dir, "customer").select(
        "c_custkey", F.when(F.col("c_custkey") % 17 == 0, F.lit(None)).otherwise(F.col("c_mktsegment")).alias("seg"))
    return binary_encode(c, ["seg"])


@register("ordinal_encode", """
WITH p AS (SELECT p_partkey, p_name, CASE WHEN p_partkey % 19 = 0 THEN NULL ELSE p_brand END AS p_brand,
                  p_type, p_size, p_retailprice FROM part)
SELECT p_partkey,
       CAST(dense_rank() OVER (ORDER BY p_name) - 1 AS INTEGER) AS p_name,
       CAST(CASE WHEN p_brand IS NULL THEN -1 ELSE dense_rank() OVER (ORDER BY p_brand NULLS LAST) - 1 END AS INTEGER)
         AS p_brand,
       CAST(dense_rank() OVER (ORDER BY p_type) - 1 AS INTEGER) AS p_type,
       p_size, round(p_retailprice, 4) AS p_retailprice
FROM p
""")
def q_ordinal_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select(
        "p_partkey", "p_name",
        F.when(F.col("p_partkey") % 19 == 0, F.lit(None)).otherwise(F.col("p_brand")).alias("p_brand"),
        "p_type", "p_size", "p_retailprice")
    encoded, _ = convert_objects_to_ints(p)
    return rounded(encoded)


@register("consignee_encode", """
WITH o AS (SELECT o_orderkey, o_custkey, CAST(o_orderstatus = 'F' AS INTEGER) AS target,
                  CASE WHEN o_orderdate < TIMESTAMP '1996-01-01' THEN 'train' ELSE 'test' END AS split
           FROM orders),
f AS (SELECT o_custkey, count(*) AS consignee_freq FROM o GROUP BY 1),
g AS (SELECT avg(target) AS gm FROM o WHERE split = 'train'),
s AS (SELECT o_custkey, (avg(target) * count(target) + (SELECT gm FROM g) * 5) / (count(target) + 5) AS enc
      FROM o WHERE split = 'train' GROUP BY 1)
SELECT o.o_orderkey, o.split, f.consignee_freq, f.consignee_freq < 3 AS is_rare_consignee,
       round(CASE WHEN o.split = 'test' THEN coalesce(s.enc, (SELECT gm FROM g)) ELSE s.enc END, 4)
         AS consignee_target_enc
FROM o JOIN f USING (o_custkey) LEFT JOIN s USING (o_custkey)
""")
def q_consignee_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", (F.col("o_orderstatus") == "F").cast("int").alias("target"),
        F.when(F.col("o_orderdate") < F.lit("1996-01-01").cast("timestamp_ntz"), "train")
         .otherwise("test").alias("split"))
    train, test = encode_consignee_features(o.where(F.col("split") == "train"),
                                            o.where(F.col("split") == "test"),
                                            target_col="target", name_col="o_custkey")
    cols = ["o_orderkey", "split", "consignee_freq", "is_rare_consignee", "consignee_target_enc"]
    return rounded(train.select(*cols).unionByName(test.select(*cols)))


@register("stored_encoders", """
WITH o AS (SELECT o_orderkey, o_custkey, o_orderpriority, CAST(o_orderstatus = 'F' AS INTEGER) AS target,
                  o_orderdate < TIMESTAMP '1996-01-01' AS train FROM orders),
d AS (SELECT o_custkey, row_number() OVER (ORDER BY o_custkey) - 1 AS code FROM (SELECT DISTINCT o_custkey FROM o WHERE train)),
p AS (SELECT o_orderpriority, row_number() OVER (ORDER BY o_orderpriority) - 1 AS code
      FROM (SELECT DISTINCT o_orderpriority FROM o WHERE train)),
g AS (SELECT avg(target) AS gm FROM o WHERE train),
c AS (SELECT o_custkey, (sum(target) + 10 * (SELECT gm FROM g)) / (count(target) + 10) AS enc FROM o WHERE train GROUP BY 1)
SELECT o.o_orderkey, CAST(coalesce(d.code, -1) AS INTEGER) AS cust_code, CAST(coalesce(p.code, -1) AS INTEGER) AS priority_code,
       round(coalesce(c.enc, (SELECT gm FROM g)), 4) AS cust_target
FROM o LEFT JOIN d USING (o_custkey) LEFT JOIN p USING (o_orderpriority) LEFT JOIN c USING (o_custkey)
""")
def q_stored_encoders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encoders fitted on the orders before 1996, stored as versioned tables, loaded and applied to all orders."""
    root = scratch_path(spark, "encoders")
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderpriority", (F.col("o_orderstatus") == "F").cast("int").alias("target"),
        (F.col("o_orderdate") < F.lit("1996-01-01").cast("timestamp_ntz")).alias("train"))
    train = o.where("train")
    stored.save(spark, fit_ordinal(train, ["o_custkey", "o_orderpriority"]), f"{root}/codes")
    stored.save(spark, fit_target(train, ["o_custkey"], "target"), f"{root}/target")
    codes, target = (stored.load(spark, f"{root}/{name}") for name in ("codes", "target"))
    coded = codes.codes(o).select("o_orderkey", F.col("o_custkey").cast("int").alias("cust_code"),
                                  F.col("o_orderpriority").alias("priority_code"))
    means = target.transform(o, unseen_global=True).select("o_orderkey", F.col("o_custkey").alias("cust_target"))
    return rounded(coded.join(means, "o_orderkey"))
