"""Registered row-level queries: filters, de-duplication, lookups, keys, parsing, fills, headers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import quality
from ..operators.columns import (add_next_voyage, create_binary_feature, create_key_feature,
                                 create_voyage_code, create_voyage_code_1, fill_null_values,
                                 remove_columns, standardize_column_names,
                                 standardize_datetime_columns)
from ..operators.lookup import add_arrival_time, map_on_key
from ..operators.ordering import with_order
from .registry import register
from .tables import SHIPMENTS_SQL, rounded, shipments, table

_LI_ORDER = ("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
             "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus")


@register("drop_negative", f"""
WITH s AS (SELECT l_orderkey, l_linenumber, l_partkey, arrival_to_pickup_time,
                  CASE WHEN l_discount = 0 THEN 'NaN'::DOUBLE ELSE l_quantity * l_discount - 1 END AS slack
           FROM ({SHIPMENTS_SQL}))
SELECT l_orderkey, l_linenumber, l_partkey, round(arrival_to_pickup_time, 4) AS arrival_to_pickup_time,
       round(slack, 4) AS slack
FROM s WHERE arrival_to_pickup_time >= 0 AND slack >= 0 AND NOT isnan(slack)
""")
def q_drop_negative(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = shipments(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", "l_partkey", "arrival_to_pickup_time",
        F.when(F.col("l_discount") == 0, F.lit(float("nan")))
         .otherwise(F.col("l_quantity") * F.col("l_discount") - 1).alias("slack"))
    return rounded(quality.remove_negative_values(s, ["arrival_to_pickup_time", "slack"]))


@register("drop_null", """
WITH c AS (SELECT c_custkey,
                  CASE WHEN c_acctbal < 0 THEN NULL WHEN c_acctbal < 100 THEN 'NaN'::DOUBLE
                       ELSE c_acctbal END AS acctbal,
                  nullif(c_mktsegment, 'BUILDING') AS segment
           FROM customer)
SELECT c_custkey, round(acctbal, 4) AS acctbal, segment FROM c
WHERE acctbal IS NOT NULL AND NOT isnan(acctbal) AND segment IS NOT NULL
""")
def q_drop_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(F.col("c_acctbal") < 0, F.lit(None)).when(F.col("c_acctbal") < 100, F.lit(float("nan")))
         .otherwise(F.col("c_acctbal")).alias("acctbal"),
        F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("segment"))
    return rounded(quality.remove_null_records(c, ["acctbal", "segment"]))


_ORD_SQL = ", ".join(_LI_ORDER)
_ORD_DESC_SQL = ", ".join(f"{c} DESC" for c in _LI_ORDER)


@register("distinct_then_last", f"""
WITH r AS (SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus,
                  row_number() OVER (PARTITION BY l_orderkey, l_linenumber, l_returnflag, l_linestatus
                                     ORDER BY {_ORD_SQL}) AS rn,
                  {", ".join(c for c in _LI_ORDER if c not in ("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus"))}
           FROM lineitem),
d AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_ORD_DESC_SQL}) AS rk
      FROM r WHERE rn = 1)
SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus FROM d WHERE rk = 1
""")
def q_distinct_then_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full-row distinct keeping the first copy, then the last row per (order, line)."""
    li = with_order(table(spark, sf_dir, "lineitem"), *_LI_ORDER)
    rows = li.select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", "_ord")
    d = quality.remove_duplicates(rows)
    return quality.keep_last_per_key(d, ["l_orderkey", "l_linenumber"]).drop("_ord")


@register("lookup_overwrite", """
WITH d2 AS (SELECT o_orderkey AS key, o_orderstatus AS status, o_custkey, o_orderdate, 0 AS src, o_orderkey AS ok
            FROM orders
            UNION ALL
            SELECT o_orderkey + 1, o_orderstatus, o_custkey, o_orderdate, 1, o_orderkey FROM orders),
f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY src, ok) AS rn FROM d2) WHERE rn = 1)
SELECT l.l_orderkey * 2 AS key, l.l_linenumber, f.status, l.l_quantity, f.o_custkey, f.o_orderdate
FROM lineitem l LEFT JOIN f ON l.l_orderkey * 2 = f.key
""")
def q_lookup_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineitem rows take status/customer/date from the first orders row of their key."""
    li = table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 2).alias("key"), "l_linenumber",
        F.col("l_linestatus").alias("status"), "l_quantity")
    o = table(spark, sf_dir, "orders")
    base = o.select(F.col("o_orderkey").alias("key"), F.col("o_orderstatus").alias("status"),
                    "o_custkey", "o_orderdate", F.struct(F.lit(0).alias("src"), "o_orderkey").alias("_ord"))
    shifted = o.select((F.col("o_orderkey") + 1).alias("key"), F.col("o_orderstatus").alias("status"),
                       "o_custkey", "o_orderdate", F.struct(F.lit(1).alias("src"), "o_orderkey").alias("_ord"))
    return map_on_key(li, base.unionByName(shifted), "key")


@register("next_voyage_lookup", """
WITH fst AS (SELECT o_orderstatus || '_' || CAST(year(o_orderdate) AS VARCHAR) || '_E' AS voyage_code,
                    arg_min(o_orderdate, o_orderkey) AS arrival_time
             FROM orders GROUP BY 1),
m AS (SELECT o_orderkey, o_orderstatus AS vessel_code,
             CASE WHEN o_orderkey % 13 = 0 THEN 'x' ELSE CAST(year(o_orderdate) - 1 AS VARCHAR) END AS voyage_txt,
             CASE WHEN o_orderpriority < '3' THEN 'E' ELSE 'W' END AS direction_seq
      FROM orders),
n AS (SELECT o_orderkey, vessel_code, direction_seq, try_cast(voyage_txt AS DOUBLE) AS voyage,
             CAST(try_cast(voyage_txt AS DOUBLE) + 1 AS BIGINT) AS next_voyage FROM m),
c AS (SELECT *, vessel_code || '_' || coalesce(CAST(next_voyage AS VARCHAR), '<NA>') || '_' || direction_seq
               AS voyage_code FROM n)
SELECT c.o_orderkey, c.voyage, c.next_voyage, c.voyage_code, fst.arrival_time
FROM c LEFT JOIN fst USING (voyage_code)
""")
def q_next_voyage_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrival of the *next* sailing: code ``vessel_(voyage+1)_direction`` looked up in a schedule."""
    o = table(spark, sf_dir, "orders")
    schedule = with_order(o.select(F.col("o_orderstatus").alias("vessel_code"),
                                   F.year("o_orderdate").cast("bigint").alias("voyage_number"),
                                   F.col("o_orderdate").alias("arrival_timestamp"), "o_orderkey"),
                          "o_orderkey").drop("o_orderkey")
    schedule = create_voyage_code(schedule, "vessel_code", "voyage_number")
    m = o.select("o_orderkey", F.col("o_orderstatus").alias("vessel_code"),
                 F.when(F.col("o_orderkey") % 13 == 0, F.lit("x"))
                  .otherwise((F.year("o_orderdate") - 1).cast("string")).alias("voyage"),
                 F.when(F.col("o_orderpriority") < "3", "E").otherwise("W").alias("direction_seq"))
    m = add_next_voyage(m, "voyage")
    m = create_voyage_code_1(m, "vessel_code", "next_voyage", "direction_seq")
    m = add_arrival_time(m, schedule)
    return m.select("o_orderkey", "voyage", "next_voyage", "voyage_code", "arrival_time")


@register("composite_key", """
WITH k AS (SELECT o_orderkey,
             CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE 'EQ' || CAST(o_custkey AS VARCHAR) END AS equipment_id,
             CASE WHEN o_orderkey % 89 = 0 THEN 'bk' || CAST(o_orderkey AS VARCHAR)
                  WHEN o_orderkey % 83 = 0 THEN CAST(o_orderkey AS VARCHAR) || '.0'
                  WHEN o_orderkey % 79 = 0 THEN NULL
                  WHEN o_orderkey % 73 = 0 THEN CAST(o_orderkey AS VARCHAR) || '.5'
                  ELSE CAST(o_orderkey AS VARCHAR) END AS booking_txt
           FROM orders),
n AS (SELECT o_orderkey, equipment_id,
             CASE WHEN try_cast(booking_txt AS DOUBLE) = floor(try_cast(booking_txt AS DOUBLE))
                  THEN CAST(try_cast(booking_txt AS DOUBLE) AS BIGINT) END AS booking_number
      FROM k)
SELECT o_orderkey, booking_number,
       coalesce(equipment_id, 'nan') || '_' || coalesce(CAST(booking_number AS VARCHAR), '<NA>') AS key
FROM n
""")
def q_composite_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    ok = F.col("o_orderkey")
    t = ok.cast("string")
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(ok % 97 == 0, F.lit(None)).otherwise(F.concat(F.lit("EQ"), F.col("o_custkey").cast("string")))
         .alias("equipment_id"),
        F.when(ok % 89 == 0, F.concat(F.lit("bk"), t)).when(ok % 83 == 0, F.concat(t, F.lit(".0")))
         .when(ok % 79 == 0, F.lit(None)).when(ok % 73 == 0, F.concat(t, F.lit(".5")))
         .otherwise(t).alias("booking_number"))
    return create_key_feature(o).select("o_orderkey", "booking_number", "key")


@register("parse_datetime", """
WITH r AS (SELECT event_id,
             CASE event_id % 4 WHEN 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
                               WHEN 1 THEN strftime(ts, '%m/%d/%Y %H:%M:%S')
                               WHEN 2 THEN strftime(ts, '%Y-%m-%d')
                               ELSE 'bad' || CAST(event_id AS VARCHAR) END AS event_date
           FROM events)
SELECT event_id,
       coalesce(try_strptime(event_date, '%Y-%m-%d %H:%M:%S'), try_strptime(event_date, '%m/%d/%Y %H:%M:%S'),
                try_strptime(event_date, '%Y-%m-%d')) AS event_date
FROM r
""")
def q_parse_datetime(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts, m = F.col("ts"), F.col("event_id") % 4
    e = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(m == 0, F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
         .when(m == 1, F.date_format(ts, "MM/dd/yyyy HH:mm:ss"))
         .when(m == 2, F.date_format(ts, "yyyy-MM-dd"))
         .otherwise(F.concat(F.lit("bad"), F.col("event_id").cast("string"))).alias("event_date"))
    return standardize_datetime_columns(e)


@register("threshold_flag", f"""
SELECT l_orderkey, l_linenumber, l_partkey, round(x, 4) AS arrival_to_pickup_time,
       CAST(coalesce(x < 24, false) AS INTEGER) AS one_day_pickup
FROM (SELECT *, CASE WHEN l_quantity > 45 THEN NULL ELSE arrival_to_pickup_time END AS x FROM ({SHIPMENTS_SQL}))
""")
def q_threshold_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = shipments(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.when(F.col("l_quantity") > 45, F.lit(None)).otherwise(F.col("arrival_to_pickup_time"))
         .alias("arrival_to_pickup_time"))
    return rounded(create_binary_feature(s, "arrival_to_pickup_time", 24, "one_day_pickup"))


@register("fill_constants", """
SELECT c_custkey, coalesce(nullif(c_mktsegment, 'BUILDING'), 'Unknown') AS c_mktsegment,
       coalesce(CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE c_name END, 'Unkown') AS c_name,
       round(coalesce(CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END, 0.0), 4) AS c_acctbal
FROM customer
""")
def q_fill_constants(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select(
        "c_custkey", F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("c_mktsegment"),
        F.when(F.col("c_custkey") % 10 == 0, F.lit(None)).otherwise(F.col("c_name")).alias("c_name"),
        F.when(F.col("c_acctbal") < 0, F.lit(None)).otherwise(F.col("c_acctbal")).alias("c_acctbal"))
    c = fill_null_values(c, "c_mktsegment", "Unknown")
    c = fill_null_values(c, "c_name", "Unkown")
    return rounded(fill_null_values(c, "c_acctbal", 0.0))


@register("header_normalise", """
SELECT c_custkey AS customer_key, c_name AS name_full, round(c_acctbal, 4) AS acct_bal,
       c_mktsegment AS mkt_segment
FROM customer
""")
def q_header_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment",
                                                  "c_nationkey")
    raw = raw.toDF(" Customer Key#", "Name/Full", "__acct bal__", "Mkt-Segment", "Check Digit")
    return rounded(remove_columns(standardize_column_names(raw)))
