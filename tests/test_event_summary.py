"""Kept event summaries: new versions, joins without a shuffle of the summary, uploads over them."""

import pytest
from pyspark.sql import functions as F

from berthline.plans.cleaning import clean_container_data, summarize_events
from berthline.plans.event_summary import EventSummary
from berthline.plans.inputs import event_log, manifest, schedule
from berthline.plans.scoring import clean_uploads
from berthline.session import scratch_path
from berthline.sources.csv import write_csv

SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted(map(repr, df.drop("_ord").collect()))


def test_versions_equal_a_summary_of_all_events(spark):
    m, log = manifest(spark, SF), event_log(spark, SF)
    # positions follow the parts: events of later parts come later in the whole log too
    log = log.withColumn("part", F.col("_ord.l_orderkey") % 3)
    part = F.col("part")
    whole = log.withColumn("_ord", F.struct(part.alias("part"), F.col("_ord").alias("o")))
    kept = EventSummary(spark, scratch_path(spark, "kept"), m.columns, buckets=4)
    assert kept.latest() == 0
    assert kept.create(log.where(part == 0).drop("part")) == 1 and kept.add(log.where(part == 1).drop("part")) == 2
    again = log.where(part == 2).drop("part")
    assert kept.add(again) == 3
    assert kept.add(again.where(F.col("Event Type") == "HLP")) == 4  # copies of rows that are there
    assert _rows(kept.summary(3)) == _rows(summarize_events(whole.drop("part"), kept.owned))
    copies = whole.where(part == 2).where(F.col("Event Type") == "HLP").withColumn(
        "_ord", F.struct(F.lit(3).cast("bigint").alias("part"), F.col("_ord.o").alias("o")))
    assert _rows(kept.summary()) == _rows(summarize_events(whole.unionByName(copies).drop("part"), kept.owned))
    other = EventSummary(spark.newSession(), kept.path, m.columns)
    assert other.latest() == 4 and _rows(other.summary(1)) == _rows(kept.summary(1))
    with pytest.raises(FileNotFoundError):
        kept.summary(9)
    assert EventSummary(spark, kept.path, ["Key", "Vessel Code"]).latest() == 0  # other columns, other summary


def test_uploads_do_not_shuffle_the_summary(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        kept = EventSummary(spark, scratch_path(spark, "bucketed"), manifest(spark, SF).columns, buckets=4)
        kept.create(event_log(spark, SF))
        keys = manifest(spark, SF).select(F.concat_ws("_", "Equipment ID", "Booking Number").alias("key"))
        plan = kept.summary().join(keys, "key")._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning(key") == 1 and plan.count("Bucketed: true") == 1
        merged = kept.state()._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in merged
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_uploads_use_the_kept_summary(spark):
    root = scratch_path(spark, "kept-uploads")
    m, log, sched = manifest(spark, SF), event_log(spark, SF), schedule(spark, SF)
    write_csv(m.drop("_ord").coalesce(1), f"{root}/in/a")
    kept = f"{root}/summaries"
    for n in (1, 2):
        clean_uploads(spark, f"{root}/in", f"{root}/cleaned{n}", log, sched, summaries=kept)
    owned = [*m.drop("_ord").columns, "source_file"]
    assert EventSummary(spark, kept, owned).latest() == 1  # made once
    read = lambda n: spark.read.json(f"{root}/cleaned{n}/batch=*/*/*.json")
    alone = clean_container_data(log, m, sched)
    assert read(1).count() == read(2).count() == alone.count() > 300
    assert {r["key"] for r in read(2).select("key").collect()} == {r["key"] for r in alone.select("key").collect()}


def _log(spark, rows):
    """Events ``(booking, type, day, place)`` of one container each; the place is the position in the log."""
    return spark.createDataFrame([(f"E{b}", str(b), t, f"2024-01-{d:02d} 00:00:00", "STE1", at) for b, t, d, at in rows],
                                 "`Equipment ID` string, `Booking Number` string, `Event Type` string, `Event Date` string, "
                                 "`Inventory Location Code` string, at long").selectExpr("* except (at)", "struct(at as x) as _ord")


def test_state_keeps_the_place_in_the_key_and_one_position(spark):
    owned = ["Equipment ID", "Booking Number"]
    kept = EventSummary(spark, scratch_path(spark, "places"), owned, buckets=4)
    kept.create(_log(spark, [(1, "AVP", 3, 7), (1, "OGT", 4, 2), (1, "OGT", 4, 9), (2, "AVP", 1, 1)]))
    kept.add(_log(spark, [(1, "OGT", 4, 0), (2, "DFV", 2, 5), (2, "AVP", 2, 4)]))  # only copies for the first key

    def state(version):
        return sorted((r["key"], r["event_type"], r["_first"]["version"], r["_first"]["place"], r["_first"]["at"] and r["_first"]["at"]["x"],
                       r["_copies"]) for r in kept.state(version).collect())

    assert state(1) == [("E1_1", "AVP", 1, 2, 7, 1), ("E1_1", "OGT", 1, 1, None, 2), ("E2_2", "AVP", 1, 1, 1, 1)]
    assert state(2) == [("E1_1", "AVP", 1, 2, 7, 1), ("E1_1", "OGT", 1, 1, None, 3), ("E2_2", "AVP", 1, 1, None, 1),
                        ("E2_2", "AVP", 2, 2, None, 1), ("E2_2", "DFV", 2, 3, 5, 1)]
    last = {r["key"]: (r["event_type"], r["_ord"]["version"], r["_ord"]["at"]["x"], r["avp_date"].day) for r in kept.summary().collect()}
    assert last == {"E1_1": ("AVP", 1, 7, 3), "E2_2": ("DFV", 2, 5, 1)}


def test_events_are_shuffled_once(spark):
    """Distinct rows, state and merge lie in the buckets of the event rows; there are as many as shuffle partitions."""
    kept = EventSummary(spark, scratch_path(spark, "once"), ["Equipment ID", "Booking Number"], buckets=3)
    assert kept.buckets == 6  # of 4 partitions
    log = _log(spark, [(b, "AVP", 1 + b % 9, b) for b in range(50)])
    kept.create(log)
    merged = kept._placed(kept._distinct(kept.state().unionByName(kept._rows(log, 2))))
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and plan.count("Bucketed: true") == 1
    files = kept.state().select("_metadata.file_path").distinct().count()
    assert files <= kept.buckets  # one a bucket


def test_summary_without_state(spark):
    kept = EventSummary(spark, scratch_path(spark, "no-state"), ["Equipment ID", "Booking Number"])
    log = _log(spark, [(b % 20, t, 1 + b % 9, b) for b, t in enumerate(["AVP", "OGT", "HLP", "DFV"] * 30)])
    alone = EventSummary(spark, scratch_path(spark, "with-state"), ["Equipment ID", "Booking Number"])
    alone.create(log)
    kept.create(log, keep=False)
    assert sorted(map(repr, kept.summary().collect())) == sorted(map(repr, alone.summary().collect()))
    with pytest.raises(FileNotFoundError):
        kept.add(log)


def test_uploads_without_kept_summaries_write_no_state(spark, monkeypatch):
    root = scratch_path(spark, "unkept-uploads")
    write_csv(manifest(spark, SF).drop("_ord").coalesce(1), f"{root}/in/a")
    names, write = [], EventSummary._write
    monkeypatch.setattr(EventSummary, "_write", lambda self, df, version, name: names.append(name) or write(self, df, version, name))
    clean_uploads(spark, f"{root}/in", f"{root}/cleaned", event_log(spark, SF), schedule(spark, SF))
    assert names == ["summary"]
    assert spark.read.json(f"{root}/cleaned/batch=*/*/*.json").count() > 300
