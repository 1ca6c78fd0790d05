"""Scalar helpers: headers, key parts, numeric and date coercion (FIXTURES §3 key/header rows)."""

import datetime as dt

from pyspark.sql import functions as F

from berthline.functions.text import normalise_header
from berthline.operators.columns import (add_next_voyage, create_key_feature, create_voyage_code,
                                         create_voyage_code_1, standardize_column_names,
                                         standardize_datetime_columns)


def test_header_rules():
    assert normalise_header(" Equipment ID#") == "equipment_id"
    assert normalise_header("B/P_BOL") == "b_p_bol"
    assert normalise_header("__x__") == "x"
    assert normalise_header("Ünit") == "nit"


def test_header_collision_is_an_error(spark):
    df = spark.createDataFrame([(1, 2)], "`a b` int, `a-b` int")
    try:
        standardize_column_names(df)
    except ValueError:
        return
    raise AssertionError("collision not detected")


def test_key_parts_null_text_and_integral_text(spark):
    rows = [("A", "12"), (None, "x"), ("B", None), ("C", "12.0"), ("D", "12.5")]
    df = spark.createDataFrame(rows, "equipment_id string, booking_number string")
    out = create_key_feature(df).orderBy("equipment_id").collect()
    got = {r.equipment_id: (r.booking_number, r.key) for r in out}
    assert got["A"] == (12, "A_12")
    assert got[None] == (None, "nan_<NA>")
    assert got["B"] == (None, "B_<NA>")
    assert got["C"] == (12, "C_12")
    assert got["D"] == (None, "D_<NA>")  # fractional -> missing (non-strict)


def test_key_feature_noop_without_columns(spark):
    df = spark.createDataFrame([("A",)], "equipment_id string")
    assert create_key_feature(df).columns == ["equipment_id"]


def test_voyage_codes_canonical_numbers(spark):
    sch = spark.createDataFrame([("V1", "12"), ("V1", "12.0"), ("V2", None)], "vessel_code string, voyage_number string")
    codes = [r.voyage_code for r in create_voyage_code(sch, "vessel_code", "voyage_number").collect()]
    assert codes == ["V1_12_E", "V1_12_E", "V2_nan_E"]
    m = spark.createDataFrame([("V1", "11", "E"), ("V1", "bad", "W")], "vessel_code string, voyage string, direction_seq string")
    m = create_voyage_code_1(add_next_voyage(m, "voyage"), "vessel_code", "next_voyage", "direction_seq")
    assert [(r.next_voyage, r.voyage_code) for r in m.collect()] == [(12, "V1_12_E"), (None, "V1_<NA>_W")]


def test_datetime_parsing_formats_and_idempotence(spark):
    df = spark.createDataFrame([("2024-01-02 03:04:05",), ("01/06/2024 10:00:00",), ("2024-01-07",), ("junk",)],
                               "event_date string")
    once = standardize_datetime_columns(df, ["event_date", "not_there"])
    twice = standardize_datetime_columns(once, ["event_date"])
    got = [r.event_date for r in twice.collect()]
    assert got == [dt.datetime(2024, 1, 2, 3, 4, 5), dt.datetime(2024, 1, 6, 10), dt.datetime(2024, 1, 7), None]
    assert str(twice.schema["event_date"].dataType) == "TimestampNTZType()"


def test_strict_integer_coercion_raises(spark):
    from berthline.functions.numeric import coerce_long
    df = spark.createDataFrame([("12.5",)], "b string")
    try:
        df.select(coerce_long(F.col("b"), strict=True)).collect()
    except Exception:  # noqa: BLE001
        return
    raise AssertionError("fractional value accepted in strict mode")


def test_durations_ignore_session_time_zone(spark):
    from berthline.functions.time import hours_between
    df = spark.createDataFrame([("2024-03-10 01:00:00", "2024-03-10 03:00:00.250001"),
                                ("2024-11-03 00:30:00", "2024-11-03 02:30:00")], "a string, b string")
    df = df.select(F.col("a").cast("timestamp_ntz").alias("a"), F.col("b").cast("timestamp_ntz").alias("b"))
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        got = [r.h for r in df.select(hours_between(F.col("a"), F.col("b")).alias("h")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == [7200250001 / 3.6e9, 2.0]


def test_other_date_layouts(spark):
    df = spark.createDataFrame([("12/31/2023 23:59",), ("07-Jan-2024",), ("07-jan-2024 01:02:03",), ("13/45/2024",),
                                ("2024-02-30",)], "d string")
    got = [r.d for r in standardize_datetime_columns(df, ["d"]).collect()]
    assert got == [dt.datetime(2023, 12, 31, 23, 59), dt.datetime(2024, 1, 7), dt.datetime(2024, 1, 7, 1, 2, 3),
                   None, None]


def test_strict_date_parsing_raises_only_on_bad_text(spark):
    from berthline.functions.time import coerce_timestamp
    ok = spark.createDataFrame([("2024-01-02",), (None,)], "d string")
    assert [r.t for r in ok.select(coerce_timestamp(F.col("d"), strict=True).alias("t")).collect()] == \
        [dt.datetime(2024, 1, 2), None]
    bad = spark.createDataFrame([("junk",)], "d string")
    try:
        bad.select(coerce_timestamp(F.col("d"), strict=True)).collect()
    except Exception:  # noqa: BLE001
        return
    raise AssertionError("bad text accepted in strict mode")
