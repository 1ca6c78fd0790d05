"""Operator tests on the literal edge rows of FIXTURES §3 (one set per semantic trap)."""

import datetime as dt
import math

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from berthline.operators import events as EV
from berthline.operators import history as H
from berthline.operators import lookup as L
from berthline.operators import quality as Q
from berthline.operators.columns import add_day_of_week, add_time_parts, create_binary_feature, fill_null_values
from berthline.operators.encode import apply_one_hot_encoding, binary_encode, convert_objects_to_ints
from berthline.operators.ordering import global_index, previous_row, with_order
from berthline.sources.records import to_records

D = dt.datetime


def test_non_negative_rejects_nan_and_null(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (-1.0,), (0.0,), (None,)], "x double")
    assert sorted(r.x for r in Q.remove_negative_values(df, ["x"]).collect()) == [0.0, 1.0]


def test_threshold_null_is_zero(spark):
    df = spark.createDataFrame([(1.0,), (None,), (24.0,)], "x double")
    assert [r.f for r in create_binary_feature(df, "x", 24, "f").collect()] == [1, 0, 0]


def test_first_non_null_in_row_order(spark):
    rows = [("k", "OGT", "STE1", None, 0), ("k", "OGT", "STE2", D(2024, 1, 2), 1),
            ("k", "OGT", "STE1", D(2024, 1, 1), 2), ("k", "OGT", "XX", D(2023, 1, 1), 3),
            ("m", "AVP", "STE1", D(2024, 5, 5), 4)]
    df = spark.createDataFrame(rows, "key string, event_type string, inventory_location_code string, "
                                     "event_date timestamp_ntz, o int")
    df = with_order(df, "o")
    out = {r.key: r.pickup_date for r in EV.add_pickup_date(df).collect()}
    assert out == {"k": D(2024, 1, 2), "m": None}


def test_count_and_latest_map_back_to_every_row(spark):
    rows = [("k", "HLP", D(2024, 1, 1), 0), ("k", "DFV", D(2024, 1, 3), 1), ("k", "DFV", D(2024, 1, 2), 2),
            ("m", "X", D(2024, 1, 1), 3)]
    df = with_order(spark.createDataFrame(rows, "key string, event_type string, event_date timestamp_ntz, o int"), "o")
    df = df.withColumn("arrival_time", F.lit(D(2024, 1, 1)).cast("timestamp_ntz"))
    out = EV.add_time_to_unload_feature(EV.count_hlp_occurrences(df)).collect()
    assert len(out) == 4
    by = {(r.key, r.o): r for r in out}
    assert by[("k", 2)].hlp_count == 1 and by[("m", 3)].hlp_count == 0
    assert by[("k", 0)].dfv_event_date == D(2024, 1, 3) and by[("k", 0)].time_to_unload == 48.0
    assert by[("m", 3)].dfv_event_date is None


def test_distinct_then_last(spark):
    df = with_order(spark.createDataFrame([("k", 1, 0), ("k", 2, 1), ("k", 1, 2)], "key string, v int, o int"), "o")
    d = df.drop("o")
    out = Q.keep_last_per_key(Q.remove_duplicates(d), "key").collect()
    assert [r.v for r in out] == [2]
    # without the distinct the last row would be 1
    assert [r.v for r in Q.keep_last_per_key(d, "key").collect()] == [1]


def test_map_on_key_overwrites_and_keeps_rows(spark):
    left = with_order(spark.createDataFrame([("a", "x", 0), ("b", "y", 1), ("a", "z", 2)],
                                            "key string, status string, o int"), "o").drop("o")
    right = with_order(spark.createDataFrame([("a", "A1", 5, 0), ("a", "A2", 6, 1)],
                                             "key string, status string, n int, o int"), "o").drop("o")
    out = L.map_on_key(left, right, "key").orderBy("_ord").collect()
    assert [(r.key, r.status, r.n) for r in out] == [("a", "A1", 5), ("b", None, None), ("a", "A1", 5)]
    assert L.map_on_key(left, right, "key").columns == ["key", "status", "_ord", "n"]


def _history_frame(spark):
    rows = [("a", 0, 10.0), ("a", 1, 20.0), ("a", 2, 60.0), ("b", 3, 1.0), ("b", 4, 2.0), ("b", 5, 6.0),
            ("c", 6, 5.0)]
    df = spark.createDataFrame(rows, "consignee_name string, t int, arrival_to_pickup_time double")
    df = df.withColumn("arrival_time", F.timestamp_seconds(F.col("t") * 3600).cast("timestamp_ntz"))
    df = create_binary_feature(df, "arrival_to_pickup_time", 24, "one_day_pickup")
    return with_order(df, "t")


def _by(rows, col):
    out = {}
    for r in sorted(rows, key=lambda r: r.t):
        out.setdefault(r.consignee_name, []).append(round(r[col], 4))
    return out


def test_history_clean(spark):
    out = H.engineer_customer_pickup_features(_history_frame(spark)).collect()
    assert _by(out, "lifetime_avg_pickup") == {"a": [-1, 10, 15], "b": [-1, 1, 1.5], "c": [-1]}
    assert _by(out, "lifetime_std_pickup") == {"a": [-1, -1, 7.0711], "b": [-1, -1, 0.7071], "c": [-1]}
    assert _by(out, "lifetime_median_pickup") == {"a": [-1, 10, 15], "b": [-1, 1, 1.5], "c": [-1]}
    assert _by(out, "consignee_history_count") == {"a": [0, 1, 2], "b": [0, 1, 2], "c": [0]}
    assert _by(out, "last_one_day_pickup") == {"a": [-1, 1, 1], "b": [-1, 1, 1], "c": [-1]}
    assert all(r.low_history_flag is True for r in out)


def test_history_carry_over(spark):
    out = H.engineer_customer_pickup_features(_history_frame(spark), carry_over=True).collect()
    assert _by(out, "lifetime_avg_pickup") == {"a": [-1, 10, 15], "b": [30, 1, 1.5], "c": [3]}
    assert _by(out, "lifetime_std_pickup") == {"a": [-1, -1, 7.0711], "b": [26.4575, -1, 0.7071], "c": [2.6458]}
    assert _by(out, "lifetime_median_pickup") == {"a": [-1, 10, 15], "b": [20, 1, 1.5], "c": [2]}


def test_decayed_mean(spark):
    rows = [("a", i, v) for i, v in enumerate([10.0, 20.0, 60.0, 5.0])]
    df = spark.createDataFrame(rows, "consignee_name string, t int, arrival_to_pickup_time double")
    df = df.withColumn("arrival_time", F.timestamp_seconds(F.col("t")).cast("timestamp_ntz")).withColumn(
        "one_day_pickup", F.lit(0))
    out = H.engineer_customer_pickup_features(with_order(df, "t")).orderBy("t").collect()
    got = [round(r.weighted_avg_pickup, 6) for r in out]
    assert got == [-1, 10, 15.263158, 31.771218]


def test_rolling_needs_all_values(spark):
    df = spark.createDataFrame([(0, 1.0), (1, 2.0), (2, None), (3, 4.0)], "t int, x double")
    w = Window.orderBy("t")
    out = df.select("t", H._full_window_mean(F.col("x"), w.rowsBetween(-2, -1), 2).alias("m")).orderBy("t")
    assert [r.m for r in out.collect()] == [None, None, 1.5, None]


def test_one_hot_drop_first_and_null(spark):
    df = spark.createDataFrame([(0, "E"), (1, "F"), (2, None), (3, "Unknown")], "i int, c string")
    out = apply_one_hot_encoding(df, ["c"])
    assert out.columns == ["i", "c_F", "c_Unknown"]
    assert [(r.c_F, r.c_Unknown) for r in out.orderBy("i").collect()] == [(0, 0), (1, 0), (0, 0), (0, 1)]


def test_one_hot_pinned_categories_and_bound(spark):
    df = spark.createDataFrame([(0, "E"), (1, "Z")], "i int, c string")
    out = apply_one_hot_encoding(df, ["c"], categories={"c": ["E", "F"]})
    assert out.columns == ["i", "c_F"]
    with pytest.raises(ValueError):
        apply_one_hot_encoding(df, ["c"], max_categories=1)


def test_ordinal_codes_and_mapping(spark):
    df = spark.createDataFrame([(0, "b"), (1, None), (2, "a")], "i int, c string")
    enc, mapping = convert_objects_to_ints(df)
    assert [r.c for r in enc.orderBy("i").collect()] == [1, -1, 0]
    assert sorted((r.code, r.category) for r in mapping.collect()) == [(0, "a"), (1, "b")]


def test_binary_codes(spark):
    df = spark.createDataFrame([(0, "b"), (1, None), (2, "a"), (3, "c")], "i int, c string")
    out = binary_encode(df, ["c"]).orderBy("i").collect()
    assert [(r.c_bin0, r.c_bin1) for r in out] == [("0", "1"), (None, None), ("0", "0"), ("1", "0")]
    one = binary_encode(spark.createDataFrame([(0, "a")], "i int, c string"), ["c"])
    assert one.columns == ["i", "c_bin0"]


def test_weekend_and_day_name(spark):
    df = spark.createDataFrame([(D(2024, 1, 6, 13),)], "ts timestamp_ntz")
    r = add_time_parts(add_day_of_week(df, "ts"), "ts").collect()[0]
    assert (r.avp_day_of_week, r.arrival_weekday, r.arrival_hour, r.is_weekend) == ("Saturday", 5, 13, True)


def test_epoch_millis_sink(spark):
    df = spark.createDataFrame([(D(2024, 1, 1), 1.123456789012345)], "ts timestamp_ntz, x double")
    r = to_records(df).collect()[0]
    assert r.ts == 1704067200000 and math.isclose(r.x, 1.1234567890)


def test_fill_null_values_requires_column(spark):
    df = spark.createDataFrame([(None,)], "a string")
    assert fill_null_values(df, "a", "Unknown").collect()[0].a == "Unknown"
    with pytest.raises(KeyError):
        fill_null_values(df, "b", "x")


def test_global_index_is_consecutive_across_partitions(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7 % 1000).alias("v"))
    out = global_index(df, ["v"], partitions=7).collect()
    assert sorted((r.v, r._idx) for r in out) == [(i, i) for i in range(1000)]
    prev = previous_row(df, "v", ["v"], partitions=5).collect()
    assert sorted((r.v, r.prev_v) for r in prev) == [(0, None)] + [(i, i - 1) for i in range(1, 1000)]
