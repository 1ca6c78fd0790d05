"""The cleaning job against the independent pandas oracle, on inputs derived from sf0.001."""

import math

import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from berthline.plans.cleaning import clean_container_data
from berthline.plans.inputs import event_log, manifest, schedule

from .conftest import SF_SMALL
from .pandas_oracle import clean

COMPARE = ["consignee_name", "arrival_time", "pickup_date", "avp_date", "dfv_event_date", "load_date",
           "hlp_count", "storage_time", "time_til_avp", "time_to_unload", "arrival_to_pickup_time",
           "port_to_ste_time", "journey_length", "one_day_pickup", "avp_day_of_week", "voyage_code",
           "hazard_type_code", "commodity", "equipment_type_height_code",
           "consignee_history_count", "low_history_flag", "lifetime_avg_pickup", "lifetime_std_pickup",
           "lifetime_median_pickup", "recent_5_avg_pickup", "recent_10_avg_pickup", "weighted_avg_pickup",
           "recent_5_24h_rate", "last_one_day_pickup", "arrival_hour", "arrival_weekday", "is_weekend"]


def _ranked(df):
    """Small test inputs to pandas with their row order as a plain rank."""
    return df.withColumn("_rank", F.row_number().over(Window.orderBy("_ord"))).drop("_ord").toPandas()


@pytest.fixture(scope="module")
def inputs(spark):
    return event_log(spark, SF_SMALL), manifest(spark, SF_SMALL), schedule(spark, SF_SMALL)


def _same(a, b):
    if a is None or (isinstance(a, float) and math.isnan(a)) or a is pd.NaT:
        return b is None or (isinstance(b, float) and math.isnan(b)) or b is pd.NaT
    if isinstance(a, float) or isinstance(b, float):
        return b is not None and math.isclose(float(a), float(b), rel_tol=1e-9, abs_tol=1e-9)
    if hasattr(a, "to_pydatetime"):
        a = a.to_pydatetime()
    if hasattr(b, "to_pydatetime"):
        b = b.to_pydatetime()
    return a == b


@pytest.mark.parametrize("plan,early_prune", [("rows", True), ("rows", False), ("collapsed", True)])
def test_cleaning_matches_pandas_oracle(spark, inputs, plan, early_prune):
    ev, mf, sc = inputs
    got = clean_container_data(ev, mf, sc, early_prune=early_prune, plan=plan).toPandas()
    want = clean(_ranked(ev), _ranked(mf), _ranked(sc))
    assert len(got) > 0 and len(got) == len(want)
    assert sorted(c for c in got.columns if "_" in c and c.startswith(("trade_route", "pds_code"))) == \
        sorted(c for c in want.columns if c.startswith(("trade_route", "pds_code")))
    g = got.set_index("key").sort_index()
    w = want.set_index("key").sort_index()
    assert list(g.index) == list(w.index)
    for col in COMPARE:
        bad = [k for k in g.index if not _same(g.at[k, col], w.at[k, col])]
        assert not bad, (col, bad[:3], [(g.at[k, col], w.at[k, col]) for k in bad[:3]])


def test_collapsed_plan_is_chosen_and_equals_rows(spark, inputs):
    ev, mf, sc = inputs
    a = clean_container_data(ev, mf, sc, plan="rows", keep_order=True)
    b = clean_container_data(ev, mf, sc, keep_order=True)  # auto -> collapsed for this manifest
    assert sorted(a.columns) == sorted(b.columns)
    cols = sorted(a.columns)
    assert sorted(map(tuple, a.select(cols).collect())) == sorted(map(tuple, b.select(cols).collect()))


def test_pinned_categories_skip_the_fit(spark, inputs):
    ev, mf, sc = inputs
    cats = {"empty_full_code": ["E", "F"], "trade_route": ["A", "B"], "pds_code": ["P1", "P2", "Unknown"],
            "plan_equip_type_code": ["D20", "D40", "R40"]}
    out = clean_container_data(ev, mf, sc, one_hot_categories=cats)
    for c in ("empty_full_code_F", "trade_route_B", "pds_code_P2", "pds_code_Unknown",
              "plan_equip_type_code_D40", "plan_equip_type_code_R40"):
        assert c in out.columns
    assert out.count() > 0


def test_precomputed_event_summary_equals_row_plan(spark, inputs):
    from berthline.functions.text import normalise_header
    from berthline.plans.cleaning import summarize_events
    ev, mf, sc = inputs
    upload = mf.where(F.col("Carrier Code") == "F")
    summary = summarize_events(ev, [normalise_header(c) for c in mf.columns]).checkpoint(eager=True)
    a = clean_container_data(ev, upload, sc, plan="rows", keep_order=True)
    b = clean_container_data(ev, upload, sc, summary=summary, keep_order=True)
    cols = sorted(a.columns)
    assert sorted(b.columns) == cols
    rows = sorted(map(tuple, a.select(cols).collect()))
    assert rows and rows == sorted(map(tuple, b.select(cols).collect()))
