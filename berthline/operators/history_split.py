"""Skew-safe history features: the table is cut by position, not by consignee.

Rows are range-partitioned by (consignee, arrival time, tie-breakers), so every task gets about
the same number of consecutive rows whatever a consignee's share is, and rows of one
arrival time are split like any others. Within a partition all features are window functions per
(partition, consignee). Only a partition's *first* consignee can have earlier rows elsewhere; for
it each partition receives one carry-in row:

* row count, non-null count, mean and M2 (Chan's parallel combination),
* decayed sums ``S, W`` (``S = S * 0.9^k + S_chunk``),
* the last 10 values of the pickup time and last 5 one-day flags (for the
  rolling means and the previous flag).

These states are associative: a partition is summarised by an aggregate over its last consignee's
rows (one row of constant size per partition), and a prefix pass over the partitions combines
them, starting anew where a consignee starts. At most one row per partition is collected and broadcast.

The running median is :mod:`history_median`. Results equal the plain window version (to floating
rounding for combined means and deviations of consignees that span partitions).
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from ..constants import (DECAY, LOW_HISTORY_BELOW, RATE_WINDOW, RECENT_WINDOWS, SENTINEL,
                         WEEKEND_DAYS)
from ..functions.numeric import nan_to_null
from ..functions.time import coerce_timestamp
from ..session import materialize
from .history import decay_weight, keys_of, with_decayed_sum
from .history_median import running_median
from .ordering import LOCAL_BITS, ORD

TAIL = max(RECENT_WINDOWS)
RANGE_ROWS = 1 << 18  # rows of a range, about: a task sorts one range, in some hundred bytes a row


@dataclass
class State:
    """What a consignee's rows so far mean for its next row."""

    rows: int = 0
    k: int = 0
    mean: float = 0.0
    m2: float = 0.0
    s: float = 0.0
    w: float = 0.0
    tail: tuple = ()

    def then(self, b: "State") -> "State":
        """This state followed by another one (associative)."""
        k = self.k + b.k
        d = b.mean - self.mean
        fade = math.pow(DECAY, b.k)
        return State(self.rows + b.rows, k,
                     self.mean + d * b.k / k if b.k else self.mean,
                     self.m2 + b.m2 + d * d * self.k * b.k / k if self.k and b.k else self.m2 + b.m2,
                     self.s * fade + b.s, self.w * fade + b.w, (*self.tail, *b.tail)[-TAIL:])


@dataclass
class Edge:
    """A partition's first and last consignee, and the spans (consignees in several partitions) they belong to."""

    part: int
    rows: int
    first: Row
    last: Row
    first_span: int | None = None
    last_span: int | None = None


def edges(rows: DataFrame, keys: Sequence[str]) -> list[Edge]:
    """One record per non-empty partition, in order; neighbours that share a consignee share a span."""
    g = F.struct(*keys)
    found = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("n"), F.min_by(g, "_rid").alias("a"), F.max_by(g, "_rid").alias("b"))
    out = [Edge(r["_part"], r["n"], r["a"], r["b"]) for r in found.orderBy("_part").collect()]
    spans = 0
    for p, q in zip(out, out[1:]):
        if p.last == q.first:
            if p.first == p.last and p.first_span is not None:
                p.last_span = p.first_span
            else:
                p.last_span = spans
                spans += 1
            q.first_span = p.last_span
    return out


def _summaries(rows: DataFrame, ends: DataFrame, keys: Sequence[str]) -> dict[int, State]:
    """State of the last consignee's rows of every partition whose last consignee goes on."""
    g = F.struct(*keys)
    own = (rows.select("_part", "_rid", "_x", "_y", *keys).join(F.broadcast(ends), "_part")
           .where(F.col("last_span").isNotNull() & g.eqNullSafe(F.col("last"))))
    w = Window.partitionBy("_part").orderBy("_rid")
    own = own.select("_part", "_rid", "_x", "_y", "n", F.count("_x").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("r"),
                     F.count("_x").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("kk"))
    weight = F.when(F.col("_x").isNotNull(), F.pow(F.lit(DECAY), F.col("kk") - F.col("r")))
    at = F.col("_rid").bitwiseAND(F.lit((1 << LOCAL_BITS) - 1))
    found = own.groupBy("_part").agg(
        F.count(F.lit(1)).alias("rows"), F.count("_x").alias("k"), F.coalesce(F.avg("_x"), F.lit(0.0)).alias("mean"),
        (F.coalesce(F.var_pop("_x"), F.lit(0.0)) * F.count("_x")).alias("m2"),
        F.coalesce(F.sum(F.col("_x") * weight), F.lit(0.0)).alias("s"), F.coalesce(F.sum(weight), F.lit(0.0)).alias("w"),
        # the partition's last TAIL rows: a list of at most that many
        F.sort_array(F.collect_list(F.when(at >= F.col("n") - TAIL, F.struct("_rid", "_x", "_y")))).alias("tail"))
    return {r["_part"]: State(r["rows"], r["k"], r["mean"], r["m2"], r["s"], r["w"], tuple((t["_x"], t["_y"]) for t in r["tail"]))
            for r in found.collect()}


def carry_in(ends: Sequence[Edge], summary: dict[int, State]) -> dict[int, State]:
    """The state that the first consignee of a partition brings from the partitions before."""
    out: dict[int, State] = {}
    state = State()
    for e in ends:
        if e.first_span is not None:
            out[e.part] = state
        if e.last_span is not None:
            own = summary[e.part]
            state = state.then(own) if e.last_span == e.first_span else own
    return out


_CARRY = ("_part int, _c_rows bigint, _c_k bigint, _c_mean double, _c_m2 double, _c_s double, _c_w double, "
          "_c_tail array<struct<x:double,y:double>>")


def _tail_stats(tail: Column, take: Column, field: str) -> tuple[Column, Column, Column]:
    """(rows available, non-null count, sum) of the last ``take`` entries of a carried tail."""
    sl = F.when((take > 0) & (F.size(tail) >= take), F.slice(tail, -take, take))
    vals = F.transform(sl, lambda e: e[field])
    nn = F.filter(vals, lambda v: v.isNotNull())
    return (F.coalesce(F.size(sl), F.lit(0)),
            F.coalesce(F.size(nn), F.lit(0)),
            F.coalesce(F.aggregate(nn, F.lit(0.0), lambda a, v: a + v), F.lit(0.0)))


def engineer_customer_pickup_features_split(
        df: DataFrame, group: str | Sequence[str] = "consignee_name", time: str = "arrival_time",
        value: str = "arrival_to_pickup_time", flag: str = "one_day_pickup",
        tiebreak: Sequence[str] | None = None, median: bool = True, decayed: bool = True,
        partitions: int | None = None) -> DataFrame:
    """Same features as the plain window version, with rows dealt by position.

    ``partitions`` (``spark.sql.shuffle.partitions`` by default) is the number of ranges, of a table
    with more than ``RANGE_ROWS`` rows for each the number that holds so many: a task's rows don't
    grow with the table. ``df`` is computed three times (rows counted, range boundaries sampled,
    rows dealt): pass a table that is cheap to read.
    """
    keys = keys_of(group)
    if tiebreak is None:
        tiebreak = [ORD] if ORD in df.columns else []
    spark = df.sparkSession
    n = max(partitions or int(spark.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // RANGE_ROWS))
    df = df.withColumn(time, coerce_timestamp(F.col(time), df.schema[time].dataType))
    given = df.columns
    order = [*map(F.col, keys), F.col(time).asc_nulls_last(), *map(F.col, tiebreak)]
    rows = (df.withColumns({"_x": nan_to_null(F.col(value).cast("double")), "_y": F.col(flag).cast("double")})
            .repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_rid", F.monotonically_increasing_id())
            .withColumn("_part", F.shiftright("_rid", LOCAL_BITS).cast("int")))
    rows = materialize(rows, "history")
    ends = edges(rows, keys)
    kind = rows.select(F.struct(*keys).alias("g")).schema["g"].dataType.simpleString()
    known = spark.createDataFrame([(e.part, e.rows, e.first, e.last, e.first_span, e.last_span) for e in ends],
                                  f"_part int, n bigint, first {kind}, last {kind}, first_span int, last_span int")
    spanning = any(e.last_span is not None for e in ends)
    carried = carry_in(ends, _summaries(rows, known, keys)) if spanning else {}

    X, Y = F.col("_x"), F.col("_y")
    w = Window.partitionBy("_part", *keys).orderBy("_rid")
    prev = w.rowsBetween(Window.unboundedPreceding, -1)
    loc = {
        "_pos": (F.row_number().over(w) - 1).cast("bigint"),
        "_k": F.count(X).over(prev),
        "_mean": F.avg(X).over(prev),
        "_m2": F.coalesce(F.var_pop(X).over(prev), F.lit(0.0)) * F.count(X).over(prev),
        "_std": F.stddev_samp(X).over(prev),
        "_lag_y": F.lag(Y, 1).over(w),
        "_from": F.min("_rid").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
    }
    for k in RECENT_WINDOWS:
        fr = w.rowsBetween(-k, -1)
        loc[f"_cnt{k}"] = F.count(X).over(fr)
        loc[f"_sum{k}"] = F.coalesce(F.sum(X).over(fr), F.lit(0.0))
    fr = w.rowsBetween(-RATE_WINDOW, -1)
    loc["_ycnt"] = F.count(Y).over(fr)
    loc["_ysum"] = F.coalesce(F.sum(Y).over(fr), F.lit(0.0))
    local = rows
    if decayed:
        local = with_decayed_sum(local, ["_part", *keys], ["_rid"], X, "_dec")
    carry = spark.createDataFrame([(p, c.rows, c.k, c.mean, c.m2, c.s, c.w, list(c.tail)) for p, c in carried.items()], _CARRY)
    out = local.withColumns(loc).join(F.broadcast(carry), "_part", "left")  # one row per partition at most

    # the carry belongs to the partition's first consignee
    has = F.col("_c_rows").isNotNull() & (F.col("_from").bitwiseAND(F.lit((1 << LOCAL_BITS) - 1)) == 0)
    c = {name: F.when(has, F.col(f"_c_{name}")) for name in ("rows", "k", "mean", "m2", "s", "w", "tail")}
    ck, lk = F.coalesce(c["k"], F.lit(0)), F.col("_k")
    k_all = ck + lk
    d = F.col("_mean") - c["mean"]
    mean_all = F.when(ck == 0, F.col("_mean")).when(lk == 0, c["mean"]).otherwise(c["mean"] + d * lk / k_all)
    m2_all = F.when(lk == 0, c["m2"]).otherwise(c["m2"] + F.col("_m2") + d * d * ck * lk / k_all)
    std_all = F.when(ck == 0, F.col("_std")).when(k_all >= 2, F.sqrt(F.greatest(m2_all, F.lit(0.0)) / (k_all - 1)))
    feats: dict[str, Column] = {
        "consignee_history_count": F.coalesce(c["rows"], F.lit(0)) + F.col("_pos"),
        "lifetime_avg_pickup": mean_all,
        "lifetime_std_pickup": std_all,
    }
    if median:
        feats["lifetime_median_pickup"] = F.col("_median")

    def recent(size: int, field: str, count: str, total: str) -> Column:
        """Mean of the previous ``size`` values, some of them carried; NULL unless all are present."""
        own = F.least(F.col("_pos"), F.lit(size))
        available, found, added = _tail_stats(c["tail"], F.lit(size) - own.cast("int"), field)
        full = (own + available == size) & (F.col(count) + found == size)
        return F.when(full, (F.col(total) + added) / size)

    for k in RECENT_WINDOWS:
        feats[f"recent_{k}_avg_pickup"] = recent(k, "x", f"_cnt{k}", f"_sum{k}")
    if decayed:
        scale = F.pow(F.lit(DECAY), lk)
        s = F.coalesce(c["s"] * scale, F.lit(0.0)) + F.col("_dec")
        wt = F.coalesce(c["w"] * scale, F.lit(0.0)) + decay_weight(F.col("_dec_k"))
        feats["weighted_avg_pickup"] = F.when(wt > 0, s / wt)
    feats[f"recent_{RATE_WINDOW}_24h_rate"] = recent(RATE_WINDOW, "y", "_ycnt", "_ysum")
    feats["last_one_day_pickup"] = F.when(F.col("_pos") == 0, F.try_element_at(c["tail"], F.lit(-1))["y"]).otherwise(F.col("_lag_y"))
    if median:
        out = out.join(running_median(rows, known, ends, {p: s.k for p, s in carried.items()}, keys, n), "_rid", "left")
    out = out.withColumns(feats)
    names = list(feats)
    ts = F.col(time)
    out = out.withColumns({c: F.coalesce(F.col(c), F.lit(SENTINEL)) for c in names if c != "consignee_history_count"})
    out = (out.withColumn("low_history_flag", F.col("consignee_history_count") < LOW_HISTORY_BELOW)
              .withColumns({"arrival_hour": F.hour(ts), "arrival_weekday": F.weekday(ts),
                            "is_weekend": F.weekday(ts).isin(*WEEKEND_DAYS)}))
    return out.select(*given, *names, "low_history_flag", "arrival_hour", "arrival_weekday", "is_weekend")
