"""Exact running median of each consignee's earlier values, over rows dealt by position.

A partition follows the median of each of its consignees with two heaps of distinct values and
their counts, so that ties, the rule for whole hours, cost nothing. Only the partition's
first consignee can have ``N`` earlier values elsewhere. While its ``m`` values of the partition are
added, the median moves by at most ``m / 2`` ranks in the sorted earlier ones. So the partition needs
the earlier values of these ranks only, as (value, count) pairs, and the number of values below:

1. the values of consignees that span partitions are counted per (consignee, partition, value)
   and range-sorted by value; a range is a bucket, and a value is never in two;
2. counts per bucket, accumulated over partitions and then over buckets, tell which buckets
   hold a partition's ranks;
3. the pairs of these buckets from earlier partitions, added up per value, go to the partition.

A partition gets at most one row per distinct value. Consignees within one partition need none of it.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

SALTS = 16  # the buckets around a median go to many partitions: their values are dealt to so many tasks


class RunningMedian:
    """Two heaps of distinct values around the median; ``below`` smaller values are only counted."""

    def __init__(self, n: int = 0, below: int = 0, pairs: Sequence[tuple[float, int]] = ()) -> None:
        self.n, self.below = n, below
        self.low: list[float] = []   # negated
        self.high: list[float] = []
        self.count_low: dict[float, int] = {}
        self.count_high: dict[float, int] = {}
        self.units = 0               # values in the lower heap
        want = (n + 1) // 2 - below
        for v, c in sorted(pairs):
            take = min(c, want - self.units)
            if take > 0:
                self.count_low[v] = take
                self.low.append(-v)
                self.units += take
            if take < c:
                self.count_high[v] = c - max(take, 0)
                self.high.append(v)  # ascending, hence a heap
        heapq.heapify(self.low)

    def value(self) -> float | None:
        if not self.n:
            return None
        return -self.low[0] if self.n % 2 else -0.5 * self.low[0] + 0.5 * self.high[0]

    def add(self, v: float) -> None:
        if self.low and v <= -self.low[0]:
            if self.count_low.setdefault(v, 0) == 0:
                heapq.heappush(self.low, -v)
            self.count_low[v] += 1
            self.units += 1
        else:
            if self.count_high.setdefault(v, 0) == 0:
                heapq.heappush(self.high, v)
            self.count_high[v] += 1
        self.n += 1
        want = (self.n + 1) // 2 - self.below
        while self.units != want:
            down = self.units < want
            source, target = (self.high, self.low) if down else (self.low, self.high)
            counts, others = (self.count_high, self.count_low) if down else (self.count_low, self.count_high)
            v = source[0] if down else -source[0]
            counts[v] -= 1
            if not counts[v]:
                del counts[v]
                heapq.heappop(source)
            if v not in others:
                others[v] = 0
                heapq.heappush(target, -v if down else v)
            others[v] += 1
            self.units += 1 if down else -1


def _follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (partition, kind, position) -> the median before each own row."""
    part, group, n, below, pairs, heaps = None, None, 0, 0, [], None
    for b in batches:
        ids, out = [], []
        for p, kind, rid, g, x, count, under in zip(*(c.to_pylist() for c in b.columns)):
            if p != part:
                part, group, n, below, pairs, heaps = p, None, 0, 0, [], None
            if kind == 0:
                n, below = count, under
            elif kind == 1:
                pairs.append((x, count))
            else:
                if heaps is None:
                    heaps, pairs = RunningMedian(n, below, pairs), []
                elif g != group:
                    heaps = RunningMedian()
                group = g
                ids.append(rid)
                out.append(heaps.value())
                if x is not None:
                    heaps.add(x)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(out, pa.float64())], names=["_rid", "_median"])


def _earlier(rows: DataFrame, known: DataFrame, ends: Sequence, before: dict[int, int], keys: Sequence[str],
             partitions: int) -> tuple[DataFrame, DataFrame]:
    """For every partition with earlier values: ``_part, n, below`` and its pairs ``_part, x, count``."""
    spark = rows.sparkSession
    g = F.struct(*keys)
    span = (F.when(F.col("first_span").isNotNull() & g.eqNullSafe(F.col("first")), F.col("first_span"))
            .when(F.col("last_span").isNotNull() & g.eqNullSafe(F.col("last")), F.col("last_span")))
    values = (rows.where("_x is not null").select("_part", "_x", *keys).join(F.broadcast(known), "_part")
              .select("_part", F.col("_x").alias("x"), span.alias("span")).where("span is not null"))
    values = values.groupBy("span", "_part", "x").agg(F.count(F.lit(1)).alias("c"))
    values = materialize(values.repartitionByRange(partitions, "span", "x").withColumn("b", F.spark_partition_id()), "median")
    own = {(r["span"], r["_part"]): r["m"] for r in values.groupBy("span", "_part").agg(F.sum("c").alias("m")).collect()}
    targets = []
    for e in ends:
        if e.part in before and before[e.part]:
            n, m = before[e.part], own.get((e.first_span, e.part), 0)
            targets.append((e.first_span, e.part, n, max(1, (n - m) // 2 - 1), min(n, (n + m) // 2 + 2)))
    targets = F.broadcast(spark.createDataFrame(targets, "span int, to int, n bigint, lo bigint, hi bigint"))  # <= partitions rows
    counts = values.groupBy("span", "b", "_part").agg(F.sum("c").alias("c"))
    asked = counts.select("span", "b").distinct().join(targets, "span").select("span", "b", F.col("to").alias("_part"),
                                                                               F.lit(0).cast("bigint").alias("c"), F.lit(0).alias("kind"))
    over = Window.partitionBy("span", "b").orderBy("_part", "kind").rowsBetween(Window.unboundedPreceding, -1)
    reach = (counts.withColumn("kind", F.lit(1)).unionByName(asked).withColumn("p", F.sum("c").over(over))
             .where("kind = 0 and p > 0").select("span", "b", F.col("_part").alias("to"), "p"))
    reach = reach.withColumn("upto", F.sum("p").over(Window.partitionBy("span", "to").orderBy("b")))
    reach = reach.join(targets, ["span", "to"]).where("upto >= lo and upto - p < hi")
    reach = materialize(reach, "median")
    heads = reach.groupBy(F.col("to").alias("_part")).agg(F.max("n").alias("n"), F.min(F.col("upto") - F.col("p")).alias("below"))
    dealt = values.withColumn("salt", F.pmod(F.xxhash64("x", "_part"), F.lit(SALTS)).cast("int"))
    asked = reach.select("span", "b", "to", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    pairs = (dealt.join(asked, ["span", "b", "salt"]).where("_part < to")
             .groupBy(F.col("to").alias("_part"), "x").agg(F.sum("c").alias("count")))
    return heads, pairs


def running_median(rows: DataFrame, known: DataFrame, ends: Sequence, before: dict[int, int], keys: Sequence[str],
                   partitions: int) -> DataFrame:
    """``_rid, _median`` for ``rows(_part, _rid, _x, keys)``; ``known`` and ``ends`` are the partitions'
    edges, ``before`` the number of earlier values of each partition's first consignee, where there are any."""
    none = lambda t: F.lit(None).cast(t)
    mine = rows.select("_part", F.lit(2).alias("kind"), "_rid", F.xxhash64(*keys).alias("g"), F.col("_x").alias("x"),
                       none("bigint").alias("count"), none("bigint").alias("below"))
    if any(before.values()):
        heads, pairs = _earlier(rows, known, ends, before, keys, partitions)
        mine = mine.unionByName(heads.select("_part", F.lit(0).alias("kind"), none("bigint").alias("_rid"), none("bigint").alias("g"),
                                             none("double").alias("x"), F.col("n").alias("count"), "below"))
        mine = mine.unionByName(pairs.select("_part", F.lit(1).alias("kind"), none("bigint").alias("_rid"), none("bigint").alias("g"),
                                             "x", "count", none("bigint").alias("below")))
    return (mine.repartition(partitions, "_part").sortWithinPartitions("_part", "kind", "_rid")
            .mapInArrow(_follow, "_rid bigint, _median double"))
