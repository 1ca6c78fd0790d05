"""Registered history queries (W0-W12, T6) over picked-up shipments."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import history, quality
from ..operators.columns import create_binary_feature
from .registry import register
from .tables import SHIPMENT_ORDER_SQL, SHIPMENT_TIEBREAK, SHIPMENTS_SQL, rounded, shipments



def _picked_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = shipments(spark, sf_dir).transform(
        lambda d: quality.remove_negative_values(d, ["arrival_to_pickup_time"]))
    return create_binary_feature(s, "arrival_to_pickup_time", 24, "one_day_pickup")


_PICKED_SQL = f"""
WITH s AS ({SHIPMENTS_SQL}),
f AS (SELECT *, CAST(coalesce(arrival_to_pickup_time < 24, false) AS INTEGER) AS one_day_pickup
      FROM s WHERE arrival_to_pickup_time >= 0)
"""
_W = f"PARTITION BY consignee ORDER BY {SHIPMENT_ORDER_SQL}"
_KEYS = "l_orderkey, l_linenumber, l_partkey, l_suppkey, consignee, arrival_time"
_KEYS_SPARK = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "consignee", "arrival_time"]

HISTORY_COLS = ["arrival_to_pickup_time", "one_day_pickup", "consignee_history_count",
                "low_history_flag", "lifetime_avg_pickup", "lifetime_std_pickup",
                "recent_5_avg_pickup", "recent_10_avg_pickup", "recent_5_24h_rate",
                "last_one_day_pickup", "arrival_hour", "arrival_weekday", "is_weekend"]


def _history(spark, sf_dir, **kw) -> DataFrame:
    return history.engineer_customer_pickup_features(
        _picked_up(spark, sf_dir), group="consignee", tiebreak=list(SHIPMENT_TIEBREAK), **kw)


_FLAGSHIP_SELECT = f"""
SELECT {_KEYS},
  round(arrival_to_pickup_time, 4) AS arrival_to_pickup_time, one_day_pickup,
  CAST(row_number() OVER w - 1 AS BIGINT) AS consignee_history_count,
  (row_number() OVER w - 1) < 5 AS low_history_flag,
  round(coalesce(avg(arrival_to_pickup_time) OVER p, -1), 4) AS lifetime_avg_pickup,
  round(coalesce(stddev_samp(arrival_to_pickup_time) OVER p, -1), 4) AS lifetime_std_pickup,
  round(coalesce(CASE WHEN count(arrival_to_pickup_time) OVER r5 = 5
                      THEN avg(arrival_to_pickup_time) OVER r5 END, -1), 4) AS recent_5_avg_pickup,
  round(coalesce(CASE WHEN count(arrival_to_pickup_time) OVER r10 = 10
                      THEN avg(arrival_to_pickup_time) OVER r10 END, -1), 4) AS recent_10_avg_pickup,
  round(coalesce(CASE WHEN count(one_day_pickup) OVER r5 = 5
                      THEN avg(one_day_pickup) OVER r5 END, -1), 4) AS recent_5_24h_rate,
  round(coalesce(CAST(lag(one_day_pickup) OVER w AS DOUBLE), -1), 4) AS last_one_day_pickup,
  CAST(hour(arrival_time) AS INTEGER) AS arrival_hour,
  CAST(isodow(arrival_time) - 1 AS INTEGER) AS arrival_weekday,
  isodow(arrival_time) IN (6, 7) AS is_weekend
FROM f
WINDOW w AS ({_W}),
       p AS ({_W} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
       r5 AS ({_W} ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING),
       r10 AS ({_W} ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING)
"""
_FLAGSHIP_SQL = _PICKED_SQL + _FLAGSHIP_SELECT


@register("history_features", _FLAGSHIP_SQL)
def q_history_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: leakage-free consignee history for every picked-up shipment."""
    out = _history(spark, sf_dir, median=False, decayed=False)
    return rounded(out.select(*_KEYS_SPARK, *HISTORY_COLS))


ALL_COLS = [*HISTORY_COLS, "lifetime_median_pickup", "weighted_avg_pickup"]


def _all_features_sql(picked: str) -> str:
    """Every feature, the decayed mean as a sum over earlier values (0.9 ** 500 is below 1e-22)."""
    return picked + f"""
, k AS (SELECT *, count(arrival_to_pickup_time) OVER ({_W} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS k FROM f),
d AS (SELECT r.l_orderkey, r.l_linenumber, r.l_partkey, r.l_suppkey, r.consignee, r.arrival_time, r.l_shipdate, r.l_quantity,
             r.l_extendedprice, r.l_discount, r.l_tax, r.l_returnflag, r.l_linestatus, r.arrival_to_pickup_time, r.one_day_pickup,
             sum(v.arrival_to_pickup_time * pow(0.9, r.k - 1 - v.k)) / nullif(sum(pow(0.9, r.k - 1 - v.k)), 0) AS decayed
      FROM k r LEFT JOIN k v ON v.consignee = r.consignee AND v.k < r.k AND v.k >= r.k - 500
      GROUP BY ALL)
""" + _FLAGSHIP_SELECT.replace("FROM f\n", "FROM d\n").replace("one_day_pickup,\n", """one_day_pickup,
  round(coalesce(median(arrival_to_pickup_time) OVER p, -1), 4) AS lifetime_median_pickup,
  round(coalesce(decayed, -1), 4) AS weighted_avg_pickup,
""", 1)


@register("history_features_split", _all_features_sql(_PICKED_SQL))
def q_history_features_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every feature through the skew-safe path: rows dealt by position to 24 ranges with exact carry-ins."""
    out = _history(spark, sf_dir, strategy="split", partitions=24)
    return rounded(out.select(*_KEYS_SPARK, *ALL_COLS))


@register("history_median", _PICKED_SQL + f"""
SELECT {_KEYS},
  round(coalesce(median(arrival_to_pickup_time) OVER p, -1), 4) AS lifetime_median_pickup
FROM f WINDOW p AS ({_W} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
""")
def q_history_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _history(spark, sf_dir, median=True, decayed=False)
    return rounded(out.select(*_KEYS_SPARK, "lifetime_median_pickup"))


@register("history_decayed", _PICKED_SQL + f"""
, l AS (SELECT {_KEYS}, list(arrival_to_pickup_time) OVER p AS xs FROM f
        WINDOW p AS ({_W} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT {_KEYS},
  round(coalesce(
    list_sum(list_transform(xs, lambda v, i: v * pow(0.9, len(xs) - i)))
    / nullif(list_sum(list_transform(xs, lambda v, i: pow(0.9, len(xs) - i))), 0), -1), 4)
    AS weighted_avg_pickup
FROM l
""")
def q_history_decayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _history(spark, sf_dir, median=False, decayed=True)
    return rounded(out.select(*_KEYS_SPARK, "weighted_avg_pickup"))


@register("history_carry_over", _PICKED_SQL + f"""
, fin AS (SELECT consignee, avg(arrival_to_pickup_time) AS a,
                 stddev_samp(arrival_to_pickup_time) AS sd, median(arrival_to_pickup_time) AS md
          FROM f GROUP BY consignee),
prev AS (SELECT consignee, lag(a) OVER o AS pa, lag(sd) OVER o AS psd, lag(md) OVER o AS pmd
         FROM fin WINDOW o AS (ORDER BY consignee)),
h AS (SELECT {_KEYS}, row_number() OVER w AS rn,
             avg(arrival_to_pickup_time) OVER p AS a, stddev_samp(arrival_to_pickup_time) OVER p AS sd,
             median(arrival_to_pickup_time) OVER p AS md
      FROM f WINDOW w AS ({_W}), p AS ({_W} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT h.l_orderkey, h.l_linenumber, h.l_partkey, h.l_suppkey, h.consignee, h.arrival_time,
  round(coalesce(CASE WHEN rn = 1 THEN pa ELSE a END, -1), 4) AS lifetime_avg_pickup,
  round(coalesce(CASE WHEN rn = 1 THEN psd ELSE sd END, -1), 4) AS lifetime_std_pickup,
  round(coalesce(CASE WHEN rn = 1 THEN pmd ELSE md END, -1), 4) AS lifetime_median_pickup
FROM h JOIN prev USING (consignee)
""")
def q_history_carry_over(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _history(spark, sf_dir, median=True, decayed=False, carry_over=True)
    return rounded(out.select(*_KEYS_SPARK, "lifetime_avg_pickup", "lifetime_std_pickup",
                              "lifetime_median_pickup"))


# One consignee holds a third of all shipments: every order of a customer whose key is a
# multiple of 3 is booked to consignee 0.
_HOT_PICKED_SQL = _PICKED_SQL.replace(
    "o.o_custkey AS consignee", "CASE WHEN o.o_custkey % 3 = 0 THEN 0 ELSE o.o_custkey END AS consignee")


def _hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _picked_up(spark, sf_dir).withColumn(
        "consignee", F.when(F.col("consignee") % 3 == 0, F.lit(0).cast("bigint")).otherwise(F.col("consignee")))


@register("history_hot_consignee", _all_features_sql(_HOT_PICKED_SQL))
def q_history_hot_consignee(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every feature when one consignee owns a third of the rows (it spans several ranges)."""
    out = history.engineer_customer_pickup_features(
        _hot(spark, sf_dir), group="consignee", tiebreak=list(SHIPMENT_TIEBREAK), strategy="split", partitions=12)
    return rounded(out.select(*_KEYS_SPARK, *ALL_COLS))


# A tenth of the customers are booked to consignee 0, and some of its pickup times are missing:
# thousands of earlier values count in one decayed mean.
_DECAYED_HOT_SQL = _PICKED_SQL.replace(
    "o.o_custkey AS consignee", "CASE WHEN o.o_custkey % 10 = 0 THEN 0 ELSE o.o_custkey END AS consignee") + f"""
, x AS (SELECT * REPLACE (CASE WHEN l_linenumber = 3 THEN NULL ELSE arrival_to_pickup_time END AS arrival_to_pickup_time)
        FROM f),
r AS (SELECT *, count(arrival_to_pickup_time) OVER ({_W} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS k FROM x),
d AS (SELECT r.l_orderkey, r.l_linenumber, r.l_partkey, r.l_suppkey, r.consignee, r.arrival_time, r.l_shipdate,
             sum(v.arrival_to_pickup_time * pow(0.9, r.k - 1 - v.k)) AS s, sum(pow(0.9, r.k - 1 - v.k)) AS w
      FROM r LEFT JOIN r v ON v.consignee = r.consignee AND v.k < r.k AND v.arrival_to_pickup_time IS NOT NULL
      GROUP BY ALL)
SELECT {_KEYS}, round(coalesce(s / nullif(w, 0), -1), 4) AS weighted_avg_pickup FROM d
"""


@register("history_decayed_hot", _DECAYED_HOT_SQL)
def q_history_decayed_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decayed mean over the whole history of a hot consignee with missing values, in chunks."""
    c, v = F.col("consignee"), F.col("arrival_to_pickup_time")
    base = _picked_up(spark, sf_dir).withColumn("consignee", F.when(c % 10 == 0, F.lit(0).cast("bigint")).otherwise(c)) \
        .withColumn("arrival_to_pickup_time", F.when(F.col("l_linenumber") != 3, v))
    out = history.engineer_customer_pickup_features(
        base, group="consignee", tiebreak=list(SHIPMENT_TIEBREAK), median=False, decayed=True,
        strategy="split", partitions=12)
    return rounded(out.select(*_KEYS_SPARK, "weighted_avg_pickup"))


# Pickup times are whole hours or days, so most values are ties.
_MEDIAN_HOT_SQL = _HOT_PICKED_SQL + f"""
SELECT {_KEYS},
  round(coalesce(median(arrival_to_pickup_time) OVER p, -1), 4) AS lifetime_median_pickup
FROM f WINDOW p AS ({_W} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
"""


@register("history_median_hot", _MEDIAN_HOT_SQL)
def q_history_median_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running median when one consignee owns a third of the rows."""
    out = history.engineer_customer_pickup_features(
        _hot(spark, sf_dir), group="consignee", tiebreak=list(SHIPMENT_TIEBREAK), median=True, decayed=False,
        strategy="split", partitions=12)
    return rounded(out.select(*_KEYS_SPARK, "lifetime_median_pickup"))


# Shipments whose order key is a multiple of 5 have no arrival time: they come last in their
# consignee's history, in the order of the tie-breakers.
_UNDATED_SQL = _PICKED_SQL + f"""
, u AS (SELECT * REPLACE (CASE WHEN l_orderkey % 5 = 0 THEN NULL ELSE arrival_time END AS arrival_time) FROM f)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, consignee, arrival_time,
  CAST(row_number() OVER w - 1 AS BIGINT) AS consignee_history_count,
  round(coalesce(avg(arrival_to_pickup_time) OVER p, -1), 4) AS lifetime_avg_pickup,
  round(coalesce(median(arrival_to_pickup_time) OVER p, -1), 4) AS lifetime_median_pickup,
  round(coalesce(CAST(lag(one_day_pickup) OVER w AS DOUBLE), -1), 4) AS last_one_day_pickup
FROM u WINDOW w AS ({_W.replace("arrival_time,", "arrival_time NULLS LAST,")}),
              p AS ({_W.replace("arrival_time,", "arrival_time NULLS LAST,")} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
"""


@register("history_undated", _UNDATED_SQL)
def q_history_undated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History when arrival times are missing: undated shipments come last."""
    base = _picked_up(spark, sf_dir).withColumn("arrival_time", F.when(F.col("l_orderkey") % 5 != 0, F.col("arrival_time")))
    out = history.engineer_customer_pickup_features(
        base, group="consignee", tiebreak=list(SHIPMENT_TIEBREAK), decayed=False, strategy="split", partitions=12)
    return rounded(out.select(*_KEYS_SPARK, "consignee_history_count", "lifetime_avg_pickup", "lifetime_median_pickup",
                              "last_one_day_pickup"))
