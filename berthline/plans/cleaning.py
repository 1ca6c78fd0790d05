"""The cleaning job: event log + manifest + sailing schedule -> one row per shipment.

The steps follow the surveyed order exactly (each one is a library operator):

a. normalise headers of all three tables; build ``key`` on events and manifest
b. left lookup of the manifest onto the events by ``key`` (manifest overwrites)
c. schedule code ``vessel_voyage_E``; ``next_voyage``; row code
   ``vessel_next_direction``; arrival time of that sailing
d. drop the fixed column list; parse the date columns
e. per-key event features in one aggregate: hlp_count, pickup/avp/dfv dates,
   storage_time, time_til_avp, avp_day_of_week, time_to_unload,
   arrival_to_pickup_time, port_to_ste_time
f. keep rows whose five durations are all ``>= 0``
g. ``load_date`` (after the filter); ``one_day_pickup``
h. drop rows missing a required column; journey length; null fills; one-hot
i. full-row distinct (first copy), last row per key, consignee history

Physical plan: the per-key steps shuffle on ``key`` (the manifest and
schedule lookups become broadcast joins when AQE measures them small), the
distinct shuffles on the full row, and the history shuffles on the consignee.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import (DATE_COLUMNS, DROP_COLUMNS, EVENT_AVP, EVENT_DFV, EVENT_HLP, EVENT_LTV,
                         EVENT_PICKUP, NON_NEGATIVE_COLUMNS, NULL_FILLS, ONE_DAY_HOURS, ONE_HOT_COLUMNS,
                         PICKUP_LOCATIONS, REQUIRED_COLUMNS)
from ..functions.text import normalise_header
from ..operators import columns as C
from ..operators import events as EV
from ..operators import history as H
from ..operators import lookup as L
from ..operators import quality as Q
from ..operators.encode import OneHotModel, fit_one_hot, one_hot_per_group
from ..operators.ordering import ORD, ensure_order
from ..session import ensure_checkpoint_dir


def collapsible(manifest_columns, event_columns=()) -> bool:
    """True when the job's filters, fills and categories are constant per key.

    The manifest must own the columns that make arrival time, and no required, filled or
    one-hot column may come from the event log, where its value can differ between the rows
    of a key.
    """
    names = {normalise_header(c) for c in manifest_columns}
    from_events = {normalise_header(c) for c in event_columns} - names - set(DROP_COLUMNS)
    per_row = from_events & {*REQUIRED_COLUMNS, *ONE_HOT_COLUMNS, *(c for c, _ in NULL_FILLS)}
    return {"vessel_code", "voyage", "direction_seq"} <= names and not per_row


def clean_container_data(event_df: DataFrame, vessel_df: DataFrame, schedule_df: DataFrame,
                         one_hot_categories: dict[str, list[str]] | None = None,
                         early_prune: bool = True, checkpoint_before_fit: bool = True,
                         carry_over: bool = False, keep_order: bool = False,
                         history_strategy: str = "split", plan: str = "auto",
                         summary: DataFrame | None = None, max_categories: int = 1024,
                         upload: str | None = None) -> DataFrame:
    """Run the whole cleaning job; returns the cleaned rows (lazy except for materializations).

    ``plan="rows"`` follows the surveyed steps row by row. ``plan="collapsed"``
    (chosen by ``"auto"`` when :func:`collapsible` holds) reduces the event log to one row per key first, which is
    exact because then every filter keeps or drops whole keys (see
    :func:`_collapsed_plan`). ``summary`` (collapsed plan only) is a precomputed
    :func:`summarize_events` table used instead of aggregating ``event_df`` again.
    ``max_categories`` bounds the categories of each one-hot column (the fit raises above it,
    naming the column). Other options are described in :func:`_row_plan`.

    ``upload`` names a manifest column that tells several uploads apart. They are then cleaned in
    one plan, each as if alone: it is part of the key of every lookup, aggregate, window and
    one-hot fit (see :func:`one_hot_per_group` for the columns), and stays in the result.
    """
    if upload is not None and upload not in vessel_df.columns:
        raise KeyError(f"no column {upload!r} in the manifest")
    kw = dict(one_hot_categories=one_hot_categories, checkpoint_before_fit=checkpoint_before_fit,
              carry_over=carry_over, keep_order=keep_order, history_strategy=history_strategy,
              max_categories=max_categories, upload=upload)
    if plan == "auto":
        plan = "collapsed" if collapsible(vessel_df.columns, event_df.columns) else "rows"
    if plan == "collapsed":
        return _collapsed_plan(event_df, vessel_df, schedule_df, summary=summary, **kw)
    if plan != "rows":
        raise ValueError(f"unknown plan {plan!r}")
    return _row_plan(event_df, vessel_df, schedule_df, early_prune=early_prune, **kw)


def event_rows(event_df: DataFrame, manifest_columns, live: DataFrame | None = None) -> DataFrame:
    """Event rows: ``key``, the event columns (those the manifest does not overwrite and the drop list
    keeps) and the position. ``live`` (a one-column ``key`` table) filters the events."""
    ev = C.create_key_feature(C.standardize_column_names(ensure_order(event_df)))
    owned = set(manifest_columns) | {"key"}
    ev_cols = [c for c in ev.columns if c not in owned and c not in DROP_COLUMNS and c != ORD]
    ev = C.standardize_datetime_columns(ev.select("key", *ev_cols, ORD), DATE_COLUMNS)
    if live is not None:
        ev = ev.join(live, "key", "left_semi")
    return ev


def distinct_events(event_df: DataFrame, manifest_columns, live: DataFrame | None = None) -> DataFrame:
    """Distinct event rows of :func:`event_rows` with ``_first`` (position of the first copy) and ``_copies``."""
    ev = event_rows(event_df, manifest_columns, live)
    return ev.groupBy(*[c for c in ev.columns if c != ORD]).agg(F.min(ORD).alias("_first"), F.count(F.lit(1)).alias("_copies"))


def per_key_events(distinct_rows: DataFrame) -> DataFrame:
    """One row per key from :func:`distinct_events`."""
    ev_cols = [c for c in distinct_rows.columns if c not in ("key", "_first", "_copies")]
    e, loc, d = F.col("event_type"), F.col("inventory_location_code"), F.col("event_date")
    pick = (e == EVENT_PICKUP) & loc.isin(*PICKUP_LOCATIONS) & d.isNotNull()
    avp = (e == EVENT_AVP) & d.isNotNull()
    per_key = distinct_rows.groupBy("key").agg(
        F.coalesce(F.sum(F.when(e == EVENT_HLP, F.col("_copies"))), F.lit(0)).cast("bigint").alias("hlp_count"),
        F.min_by(F.when(pick, d), F.when(pick, F.col("_first"))).alias("pickup_date"),
        F.min_by(F.when(avp, d), F.when(avp, F.col("_first"))).alias("avp_date"),
        F.max(F.when(e == EVENT_DFV, d)).alias("dfv_event_date"),
        F.max(F.when(e == EVENT_LTV, d)).alias("load_date"),
        F.max_by(F.struct(*[F.col(c) for c in ev_cols], F.col("_first").alias(ORD)), F.col("_first")).alias("_row"))
    return per_key.select("key", *[F.col("_row")[c].alias(c) for c in ev_cols], F.col("_row")[ORD].alias(ORD),
                          "hlp_count", "pickup_date", "avp_date", "dfv_event_date", "load_date")


def summarize_events(event_df: DataFrame, manifest_columns, live: DataFrame | None = None) -> DataFrame:
    """The per-key part of the collapsed cleaning job: one row per key of the event log.

    Columns: ``key``, the event columns of the key's last distinct row, its ``_ord``,
    and ``hlp_count, pickup_date, avp_date, dfv_event_date, load_date``. It depends on
    the manifest only through ``manifest_columns`` (normalised names), so a stream of
    uploads can compute it once from the static event log and reuse it for every
    upload (:mod:`event_summary` keeps it).
    """
    return per_key_events(distinct_events(event_df, manifest_columns, live))


def _collapsed_plan(event_df: DataFrame, vessel_df: DataFrame, schedule_df: DataFrame,
                    one_hot_categories=None, checkpoint_before_fit: bool = True,
                    carry_over: bool = False, keep_order: bool = False,
                    history_strategy: str = "split", broadcast_bytes: int = 64 << 20,
                    summary: DataFrame | None = None, max_categories: int = 1024,
                    upload: str | None = None) -> DataFrame:
    """The cleaning job with the event log reduced to one row per key up front.

    Why it is exact: the lookup overwrites the manifest's columns onto every event
    row of a key, so vessel/voyage/direction, hence the sailing code and arrival
    time, are constant per key; every duration is a per-key statistic minus that
    arrival, and the required columns come from the manifest or are durations. So
    both filters keep or drop whole keys, and the surviving rows of a key are all
    its rows. The full-row distinct only compares event columns (everything else is
    constant per key), and keep-last picks the distinct row whose first copy is
    latest. Two aggregates therefore give every per-key fact:

    1. ``groupBy(key, event columns)`` -> first position and number of copies
    2. ``groupBy(key)`` -> HLP count (copies summed), first pickup / AVP date (by
       first position), latest DFV / LTV date, and the last distinct row

    Both aggregate map-side before their shuffle (a hot key collapses early), and
    all later steps run on the per-key table. Keys whose manifest row has no
    booking number cannot survive the required-column filter and are dropped in
    the manifest join.
    """
    mf = C.standardize_column_names(ensure_order(vessel_df))
    sc = C.standardize_column_names(ensure_order(schedule_df))
    mf = C.create_key_feature(mf)

    by = [upload] if upload else []
    if summary is not None:  # dealt once, for the first row per key and for the join with the summary's buckets
        mf = mf.repartition(int(mf.sparkSession.conf.get("spark.sql.shuffle.partitions")), "key")
    manifest = L.first_per_key(mf, [*by, "key"], ORD)
    if "booking_number" in manifest.columns:
        manifest = manifest.where(F.col("booking_number").isNotNull())
    if summary is None:
        # keep only events of live bookings. Uploads are small beside the event log: their keys are
        # broadcast (filter map-side, then aggregate map-side) when they measure at most
        # ``broadcast_bytes``, else a shuffle join on the key
        live = manifest.select("key").distinct() if by else manifest.select("key")
        size = live.agg(F.sum(F.octet_length("key") + F.lit(32))).first()[0] or 0
        per_key = summarize_events(event_df, manifest.columns, live=F.broadcast(live) if size <= broadcast_bytes else live)
    else:
        per_key = summary  # one row per key of the log; the join below keeps the live ones

    df = per_key.join(manifest.drop(ORD), "key", "inner")
    sc = C.create_voyage_code(sc, "vessel_code", "voyage_number")
    df = C.add_next_voyage(df, "voyage")
    df = C.create_voyage_code_1(df, "vessel_code", "next_voyage", "direction_seq")
    df = L.add_arrival_time(df, sc)
    df = C.remove_columns(df, DROP_COLUMNS)
    df = C.standardize_datetime_columns(df, DATE_COLUMNS)

    df = EV.add_stage_durations(df).withColumn("avp_day_of_week", F.date_format(F.col("avp_date"), "EEEE"))
    df = Q.remove_negative_values(df, NON_NEGATIVE_COLUMNS)
    df = C.create_binary_feature(df, "arrival_to_pickup_time", ONE_DAY_HOURS, "one_day_pickup")
    df = Q.remove_null_records(df, REQUIRED_COLUMNS)
    df = EV.calculate_journey_length(df)
    for col, value in NULL_FILLS:
        df = C.fill_null_values(df, col, value)
    # one row per key from here on: materialize once, then fit, encode and build history
    ensure_checkpoint_dir(df.sparkSession)
    if one_hot_categories is None or history_strategy == "split":
        df = df.checkpoint(eager=True)
    df = _one_hot(df, one_hot_categories, max_categories, upload)
    df = H.engineer_customer_pickup_features(df, group=[*by, "consignee_name"], carry_over=carry_over, strategy=history_strategy)
    return df if keep_order else df.drop(ORD)


def _one_hot(df: DataFrame, categories: dict[str, list[str]] | None, max_categories: int, upload: str | None) -> DataFrame:
    if categories is not None:
        return OneHotModel(dict(categories)).transform(df)
    if upload:
        return one_hot_per_group(df, ONE_HOT_COLUMNS, upload, max_categories)
    return fit_one_hot(df, ONE_HOT_COLUMNS, max_categories).transform(df)


def _row_plan(event_df: DataFrame, vessel_df: DataFrame, schedule_df: DataFrame,
                         one_hot_categories: dict[str, list[str]] | None = None,
                         early_prune: bool = True, checkpoint_before_fit: bool = True,
                         carry_over: bool = False, keep_order: bool = False,
                         history_strategy: str = "split", max_categories: int = 1024,
                         upload: str | None = None) -> DataFrame:
    """Run the whole cleaning job; returns the cleaned rows (lazy except for the one-hot fit).

    ``one_hot_categories`` pins the dummy columns (required for streams, and it
    skips the fit pass). Without it the categories are fitted at the surveyed
    point (after the null filter, before de-duplication); the intermediate table
    is then checkpointed to the shared folder so the fit and the rest of the job
    read it instead of recomputing the joins.

    ``early_prune`` drops event rows whose key has no manifest row with a
    booking number before the first shuffle. Such rows always die at the
    required-column filter (the lookup overwrites ``booking_number`` with the
    manifest's, NULL on a miss) and per-key features never mix keys, so the
    result is unchanged; it removes the hot ``nan_<NA>`` key early.

    ``history_strategy="split"`` (default) deals the history's rows by position, so no task holds a
    whole huge consignee (see :mod:`berthline.operators.history_split`).
    """
    event_df = ensure_order(event_df)
    vessel_df = ensure_order(vessel_df)
    schedule_df = ensure_order(schedule_df)

    # a
    event_df = C.standardize_column_names(event_df)
    vessel_df = C.standardize_column_names(vessel_df)
    schedule_df = C.standardize_column_names(schedule_df)
    event_df = C.create_key_feature(event_df)
    vessel_df = C.create_key_feature(vessel_df)

    # b
    by = [upload] if upload else []
    manifest = L.first_per_key(vessel_df, [*by, "key"], ORD)
    if upload or early_prune and "booking_number" in manifest.columns:
        # lookup and prune in one join: only keys whose manifest row has a booking number live
        live = manifest.where(F.col("booking_number").isNotNull())
        df = L.map_on_key(event_df, live, "key", deduplicated=True, how="inner")
    else:
        df = L.map_on_key(event_df, manifest, "key", deduplicated=True)

    # c
    schedule_df = C.create_voyage_code(schedule_df, "vessel_code", "voyage_number")
    df = C.add_next_voyage(df, "voyage")
    df = C.create_voyage_code_1(df, "vessel_code", "next_voyage", "direction_seq")
    df = L.add_arrival_time(df, schedule_df)

    # d
    df = C.remove_columns(df, DROP_COLUMNS)
    df = C.standardize_datetime_columns(df, DATE_COLUMNS)

    # e (+ g's load date when it cannot depend on the filter)
    # The sailing code, hence the arrival time, is built from vessel/voyage/direction.
    # When the manifest owns those columns the lookup makes them constant per key, so
    # every duration is constant per key, the filter keeps or drops whole keys, and the
    # latest LTV date of the surviving rows equals that of all rows of the key.
    per_key_arrival = all(c in vessel_df.columns for c in ("vessel_code", "voyage", "direction_seq"))
    df = EV.key_event_features(df, key=[*by, "key"], with_load_date=per_key_arrival)

    # f
    df = Q.remove_negative_values(df, NON_NEGATIVE_COLUMNS)

    # g
    if not per_key_arrival:
        df = EV.add_load_date(df, [*by, "key"])
    df = C.create_binary_feature(df, "arrival_to_pickup_time", ONE_DAY_HOURS, "one_day_pickup")

    # h
    df = Q.remove_null_records(df, REQUIRED_COLUMNS)
    df = EV.calculate_journey_length(df)
    for col, value in NULL_FILLS:
        df = C.fill_null_values(df, col, value)
    if one_hot_categories is None and checkpoint_before_fit:
        ensure_checkpoint_dir(df.sparkSession)
        df = df.checkpoint(eager=True)
    df = _one_hot(df, one_hot_categories, max_categories, upload)

    # i
    df = Q.remove_duplicates(df, ORD)
    df = Q.keep_last_per_key(df, [*by, "key"], ORD)
    if history_strategy == "split":
        # one row per shipment: far smaller than the event log, and the split history
        # reads it more than once (range boundaries, then the rows)
        ensure_checkpoint_dir(df.sparkSession)
        df = df.checkpoint(eager=True)
    df = H.engineer_customer_pickup_features(df, group=[*by, "consignee_name"], carry_over=carry_over, strategy=history_strategy)
    return df if keep_order else df.drop(ORD)
