"""Shipment-domain inputs derived from the driver's tables (for the cleaning job and streams).

* event log  <- ``lineitem`` ⋈ ``orders``: two container events per line item; the line
  number picks the event types; the event time is the order date plus a per-type
  offset (unload 1 h, AVP 2 h, pickup 2 h + quantity hours, HLP 5 h, load -24 h),
  except for returned items (flag ``R``) of line 5, whose raw ship date is used; the
  supplier picks the yard location.
* manifest   <- ``orders`` ⋈ ``customer``: one booking per order on the voyage before
  the order's week; the customer name is the consignee; priority/status/segment
  give the categorical columns.
* schedule   <- ``orders``: one sailing per (vessel, year-week) arriving at the first
  order date of that vessel-week.

All three are text tables, like the CSV uploads they stand for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ordering import with_order
from .tables import table

_TS = "yyyy-MM-dd HH:mm:ss"
# line number -> event types (fixed mapping of this derivation)
_EVENTS_BY_LINE = {1: ("AVP", "DFV"), 2: ("OGT", "AVP"), 3: ("DFV", "OGT"), 4: ("HLP", "DFV"), 5: ("LTV", "AVP"),
                   6: ("OGT", "AVP"), 7: ("HLP", "OGT")}


def _txt(c):
    return c.cast("string")


# event type -> hours after the order date (fixed offsets of this derivation)
_OFFSET_HOURS = {"DFV": 1, "AVP": 2, "OGT": 2, "HLP": 5, "LTV": -24}


def _voyage(ts):
    return F.year(ts) * 100 + F.weekofyear(ts)


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    li = li.join(o, li["l_orderkey"] == o["o_orderkey"], "left")
    ln = F.col("l_linenumber")
    types = F.array(F.lit("HLP"))
    for k, v in sorted(_EVENTS_BY_LINE.items(), reverse=True):
        types = F.when(ln == k, F.array(*map(F.lit, v))).otherwise(types)
    li = li.select("*", F.posexplode(types).alias("e_place", "e_type"))
    ev = F.col("e_type")
    hours = F.lit(0)
    for k, v in _OFFSET_HOURS.items():
        hours = F.when(ev == k, F.lit(v)).otherwise(hours)
    hours = hours + F.when(ev == "OGT", F.col("l_quantity").cast("int")).otherwise(F.lit(0))
    when = F.when((F.col("l_returnflag") == "R") & (ln == 5), F.col("l_shipdate")).otherwise(
        F.col("o_orderdate") + F.make_dt_interval(hours=hours))
    li = with_order(li, "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate",
                    "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "e_place")
    return li.select(
        F.concat(F.lit("EQ"), _txt(F.col("l_orderkey"))).alias("Equipment ID"),
        _txt(F.col("l_orderkey")).alias("Booking Number"),
        ev.alias("Event Type"),
        F.date_format(when, _TS).alias("Event Date"),
        F.concat(F.lit("STE"), _txt(F.col("l_suppkey") % 3)).alias("Inventory Location Code"),
        _txt(F.col("l_linenumber")).alias("Check Digit"),
        "_ord")


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    j = o.join(c, o["o_custkey"] == c["c_custkey"], "left")
    ok = F.col("o_orderkey")
    return with_order(j, "o_orderkey").select(
        F.concat(F.lit("EQ"), _txt(ok)).alias("Equipment ID"),
        _txt(ok).alias("Booking Number"),
        F.concat(F.lit("V"), _txt(F.col("o_custkey") % 5)).alias("Vessel Code"),
        _txt(_voyage(F.col("o_orderdate")) - 1).alias("Voyage"),
        F.when(F.col("o_orderpriority") < "4", "E").otherwise("W").alias("Direction Seq"),
        F.col("c_name").alias("Consignee Name"),
        F.col("o_orderpriority").alias("Shipper Name"),
        F.col("o_orderstatus").alias("Carrier Code"),
        F.date_format(F.col("o_orderdate") - F.expr("INTERVAL 10 DAYS"), _TS).alias("Sail Date"),
        F.when(ok % 11 == 0, "H1").alias("Hazard Type Code"),
        F.when(ok % 13 == 0, "D2").alias("Current Damage Code"),
        F.when(ok % 2 == 0, "9'6").alias("Equipment Type Height Code"),
        F.when(ok % 7 != 0, "GENERAL").alias("Commodity"),
        F.when(ok % 5 == 0, "ACTIVE").alias("Life Cycle Status Code"),
        F.when(ok % 3 == 0, "P1").when(ok % 3 == 1, "P2").alias("PDS Code"),
        F.when(ok % 17 != 0, "SHA").alias("Discharge Port Code"),
        F.when(F.col("o_totalprice") > 100000, "F").otherwise("E").alias("Empty Full Code"),
        F.col("c_mktsegment").alias("Trade Route"),
        F.when(ok % 4 == 0, "D40").when(ok % 4 == 1, "D20").otherwise("R40").alias("Plan Equip Type Code"),
        "_ord")


def schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    vy = o.groupBy(F.concat(F.lit("V"), _txt(F.col("o_custkey") % 5)).alias("Vessel Code"),
                   _voyage(F.col("o_orderdate")).alias("Voyage Number")) \
          .agg(F.min("o_orderdate").alias("_arrival"))
    s = with_order(vy, "Vessel Code", "Voyage Number")
    return s.select("Vessel Code", _txt(F.col("Voyage Number")).alias("Voyage Number"),
                    F.date_format("_arrival", _TS).alias("Arrival Timestamp"), "_ord")
