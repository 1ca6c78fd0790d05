"""The skew-safe (chunked) history path equals the plain per-consignee window path."""

import pytest
from pyspark.sql import functions as F

from berthline.operators import history as H
from berthline.operators.ordering import with_order
from berthline.plans.q_history import _picked_up
from berthline.plans.tables import SHIPMENT_TIEBREAK

from .conftest import SF_SMALL

COLS = ["consignee_history_count", "lifetime_avg_pickup", "lifetime_std_pickup", "lifetime_median_pickup",
        "recent_5_avg_pickup", "recent_10_avg_pickup", "weighted_avg_pickup", "recent_5_24h_rate",
        "last_one_day_pickup", "low_history_flag", "arrival_hour", "is_weekend"]


def _compare(plain, split, key):
    a = {tuple(r[k] for k in key): r for r in plain.collect()}
    b = {tuple(r[k] for k in key): r for r in split.collect()}
    assert a.keys() == b.keys()
    for k, ra in a.items():
        rb = b[k]
        for c in COLS:
            va, vb = ra[c], rb[c]
            if isinstance(va, float):
                assert vb == pytest.approx(va, rel=1e-9, abs=1e-9), (k, c, va, vb)
            else:
                assert va == vb, (k, c, va, vb)


@pytest.mark.parametrize("partitions", [1, 7, 60])
def test_split_equals_window_on_shipments(spark, partitions):
    base = _picked_up(spark, SF_SMALL)
    kw = dict(group="consignee", tiebreak=list(SHIPMENT_TIEBREAK), median=True, decayed=True)
    plain = H.engineer_customer_pickup_features(base, **kw)
    split = H.engineer_customer_pickup_features(base, strategy="split", partitions=partitions, **kw)
    _compare(plain, split, list(SHIPMENT_TIEBREAK))


def _history_rows(spark, groups, cols="consignee_name string"):
    rows = []
    for g, n in groups:
        for i in range(n):
            v = None if i % 7 == 3 else float((i * 37) % 50)
            rows.append((*g, i, v, int(v is not None and v < 24)))
    df = spark.createDataFrame(rows, f"{cols}, t int, arrival_to_pickup_time double, one_day_pickup int")
    time = F.when(F.col("t") % 9 != 4, F.timestamp_seconds(F.col("t") * 3600).cast("timestamp_ntz"))
    return with_order(df.withColumn("arrival_time", time), "t")


def test_split_with_missing_values_and_carry_over(spark):
    df = _history_rows(spark, [(("a",), 40), (("b",), 3), (("c",), 25), ((None,), 12)])
    plain = H.engineer_customer_pickup_features(df.where("consignee_name is not null"), carry_over=True)
    split = H.engineer_customer_pickup_features(df.where("consignee_name is not null"), carry_over=True, strategy="split", partitions=11)
    _compare(plain, split, ["consignee_name", "t"])
    _compare(H.engineer_customer_pickup_features(df), H.engineer_customer_pickup_features(df, strategy="split", partitions=30),
             ["consignee_name", "t"])


@pytest.mark.parametrize("strategy", ["window", "split"])
def test_history_of_several_uploads_stays_apart(spark, strategy):
    groups = [(("u1", "a"), 30), (("u1", "b"), 4), (("u2", "a"), 9), (("u2", "c"), 40)]
    both = _history_rows(spark, groups, "upload string, consignee_name string")
    kw = dict(strategy=strategy, carry_over=True, partitions=9)
    together = H.engineer_customer_pickup_features(both, group=["upload", "consignee_name"], **kw)
    for u in ("u1", "u2"):
        alone = H.engineer_customer_pickup_features(both.where(F.col("upload") == u), **kw)
        _compare(alone, together.where(F.col("upload") == u), ["upload", "consignee_name", "t"])


@pytest.mark.parametrize("strategy", ["window", "split"])
def test_rows_without_a_time_come_last(spark, strategy):
    df = spark.createDataFrame([("a", None, 1.0, 1, 0), ("a", "2024-01-01 00:00:00", 5.0, 1, 1), ("a", "2024-01-02 00:00:00", 7.0, 1, 2)],
                               "consignee_name string, arrival_time string, arrival_to_pickup_time double, one_day_pickup int, _ord int")
    out = H.engineer_customer_pickup_features(df, strategy=strategy, partitions=2).orderBy("_ord").collect()
    assert [r["consignee_history_count"] for r in out] == [2, 0, 1]
    assert [r["lifetime_median_pickup"] for r in out] == [6.0, -1.0, 5.0]


def test_no_task_holds_a_hot_consignee_or_time(spark):
    """A third of the rows have one consignee, and most of these one arrival time."""
    from berthline.operators import history_split as S
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 500)).alias("consignee_name"),
        F.timestamp_seconds(F.when(F.col("id") % 6 == 0, 0).otherwise(F.col("id"))).cast("timestamp_ntz").alias("arrival_time"),
        (F.col("id") % 24).cast("double").alias("arrival_to_pickup_time"), (F.col("id") % 2).cast("int").alias("one_day_pickup"),
        F.col("id").alias("_ord"))
    seen = []
    keep = S.edges

    def edges(rows, keys):
        seen.append(keep(rows, keys))
        return seen[-1]

    S.edges = edges
    try:
        plain = H.engineer_customer_pickup_features(df)
        split = H.engineer_customer_pickup_features(df, strategy="split", partitions=20)
        _compare(plain, split, ["_ord"])
    finally:
        S.edges = keep
    assert len(seen[0]) == 20 and max(e.rows for e in seen[0]) < 3 * 30_000 / 20
    assert sum(e.first_span is not None for e in seen[0]) >= 5


def test_ranges_of_a_larger_table_are_more(spark, monkeypatch):
    """``partitions`` is for tables whose ranges hold at most RANGE_ROWS rows: a task's rows don't grow with the table."""
    from berthline.operators import history_split as S
    df = _history_rows(spark, [(("hot",), 3000), (("b",), 900), (("c",), 100)])
    seen, keep = [], S.edges
    monkeypatch.setattr(S, "RANGE_ROWS", 400)
    monkeypatch.setattr(S, "edges", lambda rows, keys: seen.append(keep(rows, keys)) or seen[-1])
    kw = dict(median=True, decayed=True)
    _compare(H.engineer_customer_pickup_features(df, **kw),
             H.engineer_customer_pickup_features(df, strategy="split", partitions=2, **kw), ["consignee_name", "t"])
    assert len(seen[0]) == 10 and max(e.rows for e in seen[0]) < 2 * 400
    H.engineer_customer_pickup_features(df.limit(300), strategy="split", partitions=2)
    assert len(seen[1]) <= 2


def test_a_partition_gets_one_row_per_earlier_value(spark):
    """40,000 rows of 24 whole hours: the earlier values that reach a partition are (value, count) pairs."""
    from berthline.operators import history_median as M
    from berthline.operators.history_split import edges
    from berthline.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    rows = (spark.range(40_000).select(F.lit("a").alias("g"), F.col("id").alias("t"), (F.col("id") * 7 % 24).cast("double").alias("_x"))
            .repartitionByRange(40, "t").sortWithinPartitions("t").withColumn("_rid", F.monotonically_increasing_id())
            .withColumn("_part", F.shiftright("_rid", 33).cast("int"))).checkpoint()
    ends = edges(rows, ["g"])
    known = spark.createDataFrame([(e.part, e.rows, e.first, e.last, e.first_span, e.last_span) for e in ends],
                                  "_part int, n bigint, first struct<g:string>, last struct<g:string>, first_span int, last_span int")
    before, n = {}, 0
    for e in ends:
        before[e.part] = n
        n += e.rows
    heads, pairs = M._earlier(rows, known, ends, before, ["g"], 8)
    most = pairs.groupBy("_part").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("x").alias("d")).collect()
    assert len(most) == 39 and all(r["n"] == r["d"] <= 24 for r in most)
    assert heads.count() == 39


def test_median_of_weighted_values():
    import random
    import statistics

    from berthline.operators.history_median import RunningMedian
    rng = random.Random(2)
    for _ in range(200):
        earlier = sorted(rng.choices(range(8), k=rng.randint(0, 60)))
        more = rng.choices(range(8), k=rng.randint(0, 25))
        n, m = len(earlier), len(more)
        lo, hi = max(1, (n - m) // 2 - 1), min(n, (n + m) // 2 + 2)
        slice_ = earlier[lo - 1:hi]
        got = RunningMedian(n, lo - 1 if n else 0, [(v, slice_.count(v)) for v in set(slice_)])
        for k, v in enumerate(more):
            assert got.value() == (statistics.median(earlier + more[:k]) if n + k else None)
            got.add(v)


@pytest.mark.parametrize("strategy", ["window", "split"])
def test_empty_table_and_one_row(spark, strategy):
    df = _history_rows(spark, [(("a",), 1)])
    one = H.engineer_customer_pickup_features(df, strategy=strategy, carry_over=True)
    assert [tuple(r[c] for c in ("consignee_history_count", "lifetime_median_pickup", "last_one_day_pickup")) for r in one.collect()] == [(0, -1.0, -1.0)]
    none = H.engineer_customer_pickup_features(df.limit(0), strategy=strategy, carry_over=True)
    assert none.count() == 0 and none.columns == one.columns
