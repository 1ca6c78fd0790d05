"""Leakage-free per-consignee history features.

Rows of one consignee are ordered by arrival time (ties by the caller's
tie-breakers, then ``_ord``); every feature looks only at *earlier* rows:
count, low-history flag, running mean / sample std / median, mean of the last
5 and 10 values (only when all are present), decayed mean and the previous
one-day flag. Missing history is the sentinel -1.

All features are window functions over one ``partitionBy(group)`` spec, so
Spark computes them with one exchange and one sort. ``carry_over=True``
reproduces the surveyed code's global shift, where a consignee's first row
receives the previous consignee's final running statistics.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..constants import (DECAY, LOW_HISTORY_BELOW, RATE_WINDOW, RECENT_WINDOWS, SENTINEL,
                         WEEKEND_DAYS)
from ..functions.numeric import nan_to_null
from ..functions.time import coerce_timestamp
from .ordering import ORD, previous_row

CARRIED = ("lifetime_avg_pickup", "lifetime_std_pickup", "lifetime_median_pickup")


DECAY_BLOCK = 2048  # 0.9 ** -2048 is about 1e94: scaled values stay far inside the double range
DECAY_BLOCKS = 4    # 0.9 ** (4 * 2048) is below the smallest double: older weights are exactly 0


def keys_of(group: str | Sequence[str]) -> list[str]:
    return [group] if isinstance(group, str) else list(group)


def with_decayed_sum(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], x: Column, name: str,
                     decay: float = DECAY) -> DataFrame:
    """Add ``name``: the sum of all earlier non-null values of the partition, weighted with
    ``decay ** age`` (newest earlier value 1), and ``{name}_k``, their number.

    O(1) per row and no collected values: the k-th non-null value is scaled by
    ``decay ** -(k mod block)`` and added up within its block of ``DECAY_BLOCK`` values, and the
    totals of the blocks before come from range frames. Every value whose weight is not zero
    in double arithmetic counts. The weights add up to ``(1 - decay ** k) / (1 - decay)``.
    """
    blk, cum = f"{name}_blk", f"{name}_cum"
    w = Window.partitionBy(*keys).orderBy(*order)
    k = f"{name}_k"
    df = df.withColumn(k, F.count(x).over(w.rowsBetween(Window.unboundedPreceding, -1)))
    df = df.withColumn(blk, F.floor(F.col(k) / DECAY_BLOCK).cast("int"))
    q = F.col(k) - F.col(blk).cast("bigint") * DECAY_BLOCK
    term = x * F.pow(F.lit(decay), -q.cast("double"))
    inside = Window.partitionBy(*keys, blk).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumn(cum, F.sum(term).over(inside))
    blocks = Window.partitionBy(*keys).orderBy(blk)
    totals = {f"{name}_t{j}": F.sum(term).over(blocks.rangeBetween(-j, -j)) for j in range(1, DECAY_BLOCKS + 1)}
    df = df.withColumns(totals)
    total = F.coalesce(F.col(cum) * F.pow(F.lit(decay), (q - 1).cast("double")), F.lit(0.0))
    for j in range(1, DECAY_BLOCKS + 1):
        age = q + (j - 1) * DECAY_BLOCK  # of the block's last value
        total = total + F.coalesce(F.col(f"{name}_t{j}") * F.lit(decay ** (DECAY_BLOCK - 1))
                                   * F.pow(F.lit(decay), age.cast("double")), F.lit(0.0))
    return df.withColumn(name, total).drop(blk, cum, *totals)


def decay_weight(k: Column, decay: float = DECAY) -> Column:
    """Sum of the weights of ``k`` values."""
    return (1.0 - F.pow(F.lit(decay), k.cast("double"))) / (1.0 - decay)


def _full_window_mean(x: Column, frame, n: int) -> Column:
    """Mean of the ``n`` previous values, NULL unless all ``n`` are present."""
    return F.when(F.count(x).over(frame) == n, F.avg(x).over(frame))


def engineer_customer_pickup_features(
        df: DataFrame, group: str | Sequence[str] = "consignee_name", time: str = "arrival_time",
        value: str = "arrival_to_pickup_time", flag: str = "one_day_pickup",
        tiebreak: Sequence[str] | None = None, median: bool = True, decayed: bool = True,
        carry_over: bool = False, partitions: int | None = None, strategy: str = "window") -> DataFrame:
    """Add the history features to every row.

    ``group`` is the consignee, or several columns that name it (an upload and its consignee).
    Rows without a time come last in their consignee's history. The decayed mean covers every
    earlier value (see :func:`with_decayed_sum`).

    ``strategy="split"`` bounds the task size whatever a consignee's share of the rows: the table
    is dealt to ``partitions`` ranges of rows with exact carry-ins (see :mod:`history_split`);
    ``"window"`` is one window per consignee (one exchange, fastest when no consignee is huge).
    """
    keys = keys_of(group)
    if strategy == "split":
        from .history_split import engineer_customer_pickup_features_split
        out = engineer_customer_pickup_features_split(
            df, keys, time, value, flag, tiebreak, median=median, decayed=decayed, partitions=partitions)
        if carry_over:
            x = nan_to_null(F.col(value).cast("double"))
            out = _carry_over(out, df, keys, x, median, partitions)
            out = out.withColumns({c: F.coalesce(F.col(c), F.lit(SENTINEL)) for c in CARRIED
                                   if c in out.columns})
        return out
    if strategy != "window":
        raise ValueError(f"unknown strategy {strategy!r}")
    if tiebreak is None:
        tiebreak = [ORD] if ORD in df.columns else []
    df = df.withColumn(time, coerce_timestamp(F.col(time), df.schema[time].dataType))
    w = Window.partitionBy(*keys).orderBy(F.col(time).asc_nulls_last(), *tiebreak)
    prev = w.rowsBetween(Window.unboundedPreceding, -1)
    x = nan_to_null(F.col(value).cast("double"))
    y = F.col(flag).cast("double")

    feats: dict[str, Column] = {
        "consignee_history_count": (F.row_number().over(w) - 1).cast("bigint"),
        "lifetime_avg_pickup": F.avg(x).over(prev),
        "lifetime_std_pickup": F.stddev_samp(x).over(prev),
    }
    if median:
        feats["lifetime_median_pickup"] = F.percentile(x, F.lit(0.5)).over(prev)
    for n in RECENT_WINDOWS:
        feats[f"recent_{n}_avg_pickup"] = _full_window_mean(x, w.rowsBetween(-n, -1), n)
    if decayed:
        df = with_decayed_sum(df, keys, [F.col(time).asc_nulls_last(), *tiebreak], x, "_dec")
        feats["weighted_avg_pickup"] = F.when(F.col("_dec_k") > 0, F.col("_dec") / decay_weight(F.col("_dec_k")))
    feats[f"recent_{RATE_WINDOW}_24h_rate"] = _full_window_mean(y, w.rowsBetween(-RATE_WINDOW, -1),
                                                                RATE_WINDOW)
    feats["last_one_day_pickup"] = F.lag(y, 1).over(w)
    out = df.withColumns(feats).drop("_dec", "_dec_k")

    if carry_over:
        out = _carry_over(out, df, keys, x, median, partitions)

    ts = F.col(time)
    sentinel = {c: F.coalesce(F.col(c), F.lit(SENTINEL)) for c in feats
                if c != "consignee_history_count"}
    return (out.withColumns(sentinel)
               .withColumn("low_history_flag", F.col("consignee_history_count") < LOW_HISTORY_BELOW)
               .withColumns({"arrival_hour": F.hour(ts), "arrival_weekday": F.weekday(ts),
                             "is_weekend": F.weekday(ts).isin(*WEEKEND_DAYS)}))


def _carry_over(out: DataFrame, src: DataFrame, keys: Sequence[str], x: Column, median: bool,
                partitions: int | None) -> DataFrame:
    """First row of each consignee gets the previous consignee's final running statistics.

    Final statistics are one aggregate row per consignee (combined map-side); the
    previous consignee in sort order comes from a distributed lag (:func:`previous_row`), never a
    single-task global window. With several group columns the last one names the consignee, and
    nothing crosses from one value of the others to the next.
    """
    aggs = [F.avg(x).alias("lifetime_avg_pickup"), F.stddev_samp(x).alias("lifetime_std_pickup")]
    if median:
        aggs.append(F.percentile(x, F.lit(0.5)).alias("lifetime_median_pickup"))
    carried = [a for a in CARRIED if median or a != "lifetime_median_pickup"]
    finals = src.where(F.col(keys[-1]).isNotNull()).groupBy(*keys).agg(*aggs)
    prev = previous_row(finals, keys, [*keys[:-1], *carried], prefix="_carry_", partitions=partitions)
    same = F.lit(True)
    for k in keys[:-1]:
        same = same & F.col(f"_carry_{k}").eqNullSafe(F.col(k))
    prev = prev.select(*keys, *[F.when(same, F.col(f"_carry_{c}")).alias(f"_carry_{c}") for c in carried])
    first = F.col("consignee_history_count") == 0
    joined = out.join(prev, list(keys), "left")
    joined = joined.withColumns({c: F.when(first, F.col(f"_carry_{c}")).otherwise(F.col(c)) for c in carried})
    return joined.select(*out.columns)
