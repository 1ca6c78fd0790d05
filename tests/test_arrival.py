"""Uploads that differ: column order, missing-value tokens, sub-folders, bad files, later runs."""

import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from berthline.operators.score import score_requests
from berthline.plans.cleaning import clean_container_data, collapsible
from berthline.session import scratch_path
from berthline.sources.csv import read_csv
from berthline.sources.records import to_records
from berthline.streaming.arrival import WaitingFiles, failed_files, run_once
from berthline.streaming.ledger import passing


def _put(root, name, text):
    path = os.path.join(root, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def _out(spark, sink):
    rows = spark.read.option("recursiveFileLookup", True).schema("id string, name string, file string").json(sink)
    return sorted((r["file"], r["id"], r["name"]) for r in rows.collect())


def _named(batch):
    if "id" not in batch.columns:
        raise ValueError("no id column")
    return batch.select("id", "name", F.regexp_extract("source_file", "[^/]+$", 0).alias("file"))


@pytest.mark.parametrize("max_files", [1, None])
def test_uploads_keep_their_own_header_and_earlier_output(spark, max_files):
    root = scratch_path(spark, "arrival")
    _put(root, "in/a.csv", "id,name\n1,x\n2,NA\n")
    _put(root, "in/broken.csv", "other\n5\n")
    run_once(spark, f"{root}/in", f"{root}/out", _named, max_files=max_files)
    first = [("a.csv", "1", "x"), ("a.csv", "2", None)]
    assert _out(spark, f"{root}/out") == first
    _put(root, "in/b.csv", "name,id\ny,3\n")
    _put(root, "in/sub dir/c.csv", "name,id\nz,4\n")
    run_once(spark, f"{root}/in", f"{root}/out", _named, max_files=max_files)
    assert _out(spark, f"{root}/out") == [*first, ("b.csv", "3", "y"), ("c.csv", "4", "z")]
    _put(root, "in2/d.csv", "id,name\n6,w\n")  # another source into the same sink
    run_once(spark, f"{root}/in2", f"{root}/out", _named, max_files=max_files)
    assert len(_out(spark, f"{root}/out")) == 5
    bad = failed_files(spark, f"{root}/out").collect()
    assert [r["source_file"].rsplit("/", 1)[1] for r in bad] == ["broken.csv"] and "no id column" in bad[0]["error"]
    assert failed_files(spark, f"{root}/nothing").count() == 0


class _Away:
    """A transform whose store is away for the first ``n`` calls."""

    def __init__(self, n, error=ConnectionError("store away")):
        self.n, self.calls, self.error = n, 0, error

    def __call__(self, batch):
        self.calls += 1
        if self.calls <= self.n:
            raise self.error
        return _named(batch)


@pytest.mark.parametrize("max_files", [1, None])
def test_a_passing_failure_loses_no_upload(spark, max_files):
    root = scratch_path(spark, "away")
    _put(root, "in/a.csv", "id,name\n1,x\n")
    _put(root, "in/b.csv", "id,name\n2,y\n")
    once = _Away(1)
    status = run_once(spark, f"{root}/in", f"{root}/out", once, max_files=max_files)  # taken up again within the run
    rows = [("a.csv", "1", "x"), ("b.csv", "2", "y")]
    assert _out(spark, f"{root}/out") == rows
    got = {r["source_file"].rsplit("/", 1)[1]: (r["state"], r["status"]) for r in status.collect()}
    assert got == {"a.csv": ("done", 200), "b.csv": ("done", 200)}
    long = _Away(99)
    with pytest.raises(WaitingFiles, match="a.csv"):
        run_once(spark, f"{root}/in", f"{root}/later", long, max_files=max_files)
    assert failed_files(spark, f"{root}/later").where("status = 503").count() == 2
    long.n = 0
    status = run_once(spark, f"{root}/in", f"{root}/later", long, max_files=max_files)
    assert _out(spark, f"{root}/later") == rows and status.where("state = 'done' and attempt > 0").count() == 2
    calls = long.calls
    run_once(spark, f"{root}/in", f"{root}/later", long, max_files=max_files)
    assert long.calls == calls  # nothing is processed twice


def test_one_bad_file_of_many_is_found_and_the_others_written(spark):
    root = scratch_path(spark, "halves")
    for k in range(7):
        _put(root, f"in/f{k}.csv", f"id,name\n{'x' if k == 4 else k},n{k}\n")

    def strict(batch):
        return _named(batch).withColumn("id", F.col("id").cast("int").cast("string"))

    status = run_once(spark, f"{root}/in", f"{root}/out", strict, max_files=None)
    assert [r[1] for r in _out(spark, f"{root}/out")] == ["0", "1", "2", "3", "5", "6"]
    bad = status.where("state = 'bad'").collect()
    assert len(bad) == 1 and bad[0]["source_file"].endswith("f4.csv") and "CAST_INVALID_INPUT" in bad[0]["error"]


def test_a_batch_that_is_run_again_skips_what_is_done(spark):
    from berthline.streaming.arrival import _job
    root = scratch_path(spark, "again")
    _put(root, "in/a.csv", "id,name\n1,x\n")
    t = _Away(0)
    job = _job(spark, f"{root}/in", f"{root}/out", t)
    for _ in range(2):
        job.process([(f"file:{root}/in/a.csv", 0)], "k-0")
    assert t.calls == 1 and job.ledger.latest().count() == 1


def test_errors_are_the_files_or_pass(spark):
    def caught(fn):
        try:
            fn()
        except Exception as e:  # noqa: BLE001
            return e

    assert passing(ConnectionError("x")) and passing(OSError(28, "No space left")) and passing(RuntimeError("executor lost"))
    assert not passing(ValueError("x")) and not passing(KeyError("x"))
    assert not passing(caught(lambda: spark.range(1).select("nothing")))
    assert not passing(caught(lambda: spark.range(1).select(F.lit("x").cast("int")).collect()))
    assert passing(caught(lambda: spark.read.parquet("/nowhere/at/all")))

    def fails(error):
        def run(batches):
            raise error
            yield
        return caught(lambda: spark.range(1).mapInArrow(run, "id bigint").collect())

    assert not passing(fails(ValueError("negative"))) and passing(fails(ConnectionError("model away")))


def test_odd_file_names(spark):
    root = scratch_path(spark, "names")
    for n in ("a b.csv", "c%41.csv", "d[1].csv", "é{x}.csv"):
        _put(root, f"in/{n}", f"id,name\n1,{n}\n")
    run_once(spark, f"{root}/in", f"{root}/out", lambda b: b.select("id", "name", F.lit("f").alias("file")), max_files=None)
    assert sorted(r[2] for r in _out(spark, f"{root}/out")) == ["a b.csv", "c%41.csv", "d[1].csv", "é{x}.csv"]


def _near(df):
    """Rows with doubles to nine digits: where rows are cut into ranges, sums add up in another order."""
    doubles = [f.name for f in df.schema.fields if f.dataType.typeName() == "double"]
    return sorted(map(repr, df.withColumns({c: F.round(c, 9) for c in doubles}).collect()))


def test_uploads_cleaned_in_one_plan_equal_each_alone(spark):
    from berthline.plans.inputs import event_log, manifest, schedule
    from berthline.plans.scoring import clean_uploads
    sf = "/root/testdata/sf0.001"
    events, sched = event_log(spark, sf).cache(), schedule(spark, sf).cache()
    m = manifest(spark, sf)
    parts = [m.where(F.col("Carrier Code") == s) for s in ("F", "O", "P")]
    parts.append(parts[0].where(F.col("Trade Route") > "B"))  # bookings of another upload again, fewer categories
    both = parts[0].withColumn("source_file", F.lit("u0"))
    for k, p in enumerate(parts[1:], 1):
        both = both.unionByName(p.withColumn("source_file", F.lit(f"u{k}")))
    both = both.withColumn("_ord", F.struct("source_file", F.col("_ord").alias("o")))
    for plan in ("auto", "rows"):
        together = clean_container_data(events, both, sched, upload="source_file", plan=plan, carry_over=True).cache()
        for k, p in enumerate(parts):
            alone = clean_container_data(events, p, sched, plan=plan, carry_over=True)
            got = together.where(F.col("source_file") == f"u{k}")
            extra = set(got.columns) - set(alone.columns) - {"source_file"}
            assert all(got.where(F.col(c).isNotNull()).count() == 0 for c in extra)
            assert _near(got.select(*alone.columns)) == _near(alone)
    root = scratch_path(spark, "many-uploads")
    for k, p in enumerate(parts):
        p.drop("_ord").coalesce(1).write.option("header", True).csv(f"{root}/in/u{k}")
    status = clean_uploads(spark, f"{root}/in", f"{root}/cleaned", events, sched)
    assert {r["state"] for r in status.collect()} == {"done"} and status.select("batch").distinct().count() == 1


def test_batch_reader_never_exchanges_columns(spark):
    root = scratch_path(spark, "headers")
    _put(root, "a.csv", "id,name\n1,x\n")
    _put(root, "b.csv", "name,id\ny,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, root).collect()
    got = read_csv(spark, root, by_header=True).select("id", "name").collect()
    assert sorted(map(tuple, got)) == [("1", "x"), ("2", "y")]


def test_records_have_no_nan(spark):
    df = spark.createDataFrame([(float("nan"),), (float("inf"),), (float("-inf"),), (1.5,), (None,)], "x double")
    assert [json.loads(r[0]).get("x") for r in to_records(df).select(F.to_json(F.struct("x"))).collect()] == [None, None, None, 1.5, None]


def _model():
    def score(pdf):
        if (pdf["k"] < 0).any():
            raise ValueError("negative k")
        return pdf["k"] * 2
    return score


def test_request_status_belongs_to_the_request(spark):
    rec = T.StructType([T.StructField("k", T.DoubleType())])
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 2)
    try:
        many = json.dumps([{"k": float(i)} for i in range(5)] + [{"k": -1.0}])
        req = spark.createDataFrame([(1, "[]"), (2, many), (3, '[{"k": 4}]'), (4, "{")], "request_id long, body string")
        got = sorted((r["request_id"], r["status"], r["stowage_priority"]) for r in
                     score_requests(req, rec, _model, project=("stowage_priority",)).collect())
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert got == [(1, 200, None), (2, 500, None), (3, 200, 8.0), (4, 500, None)]


def test_collapse_needs_constant_columns(spark):
    own = ["Vessel Code", "Voyage", "Direction Seq", "Carrier Code"]
    assert collapsible(own, ["Equipment ID", "Event Type"])
    assert not collapsible(own, ["Equipment ID", "PDS Code"]) and not collapsible(own[:2], [])


def test_event_owned_carrier_gives_the_same_rows(spark):
    from berthline.plans.inputs import event_log, manifest, schedule
    sf = "/root/testdata/sf0.001"
    # the carrier differs between the rows of a key and is missing on some, also on last ones
    line = F.col("Check Digit").cast("int")
    events = event_log(spark, sf).withColumn("Carrier Code", F.when(line % 3 != 0, F.concat(F.lit("M"), line % 2))) \
        .withColumn("PDS Code", F.concat(F.lit("P"), line % 3))
    books = manifest(spark, sf).drop("Carrier Code", "PDS Code", "Pds Code")
    auto = clean_container_data(events, books, schedule(spark, sf))
    rows = clean_container_data(events, books, schedule(spark, sf), plan="rows")
    assert auto.columns == rows.columns and any(c.startswith("pds_code_P") for c in auto.columns)
    assert auto.count() > 0 and sorted(map(repr, auto.collect())) == sorted(map(repr, rows.collect()))
