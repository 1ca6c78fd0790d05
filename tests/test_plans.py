"""Plan shape: pruning and pushdown reach the scan, Python runs in scoring and the chunked median only, shuffles are few."""

import re

from berthline.operators.quality import remove_null_records
from berthline.plans import catalog

from .conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_column_pruning_reaches_the_scan(spark):
    plan = _plan(catalog.QUERIES["event_count_by_key"](spark, SF_SMALL))
    # the events scan reads only the columns the query needs (never value/props)
    read = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert read and all({c.split(":")[0] for c in r.split(",")} <= {"event_id", "user_id", "event_type"} for r in read)


def test_filter_pushdown(spark):
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    plan = _plan(remove_null_records(orders, ["o_orderstatus"]))
    pushed = re.search(r"PushedFilters: \[([^\]]*)\]", plan).group(1)
    assert "IsNotNull(o_orderstatus)" in pushed


#: Scoring calls a model; the running median over rows dealt by position follows two heaps.
_SCORING = {"score_stub", "request_score"}
_MEDIAN = {"history_features_split", "history_hot_consignee", "history_median_hot", "history_undated", "clean_container"}


def test_python_runs_in_scoring_and_the_chunked_median_only(spark):
    python = re.compile("PythonUDF|MapInPandas|ArrowEvalPython|MapInArrow|FlatMapGroups")
    seen = {name for name, fn in catalog.QUERIES.items() if python.search(_plan(fn(spark, SF_SMALL)))}
    assert seen == _SCORING | _MEDIAN


def test_scoring_is_arrow_batched(spark):
    plan = _plan(catalog.QUERIES["score_stub"](spark, SF_SMALL))
    assert "MapInPandas" in plan or "MapInArrow" in plan or "PythonMapInArrow" in plan


def test_flagship_shuffles_once_per_key(spark):
    df = catalog.QUERIES["history_features"](spark, SF_SMALL)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    # one exchange for the lineitem/orders join side(s) and one for the consignee window
    assert plan.count("Exchange hashpartitioning") <= 3
    assert "Window" in plan


def test_event_aggregates_combine_map_side(spark):
    df = catalog.QUERIES["event_latest_by_key"](spark, SF_SMALL)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan
