"""File-arrival streams: per-file processing, naming rule, restart without duplicates."""

import glob
import os

from pyspark.sql import functions as F

from berthline.operators.score import priority_stub
from berthline.plans.scoring import score_cleaned_files
from berthline.session import scratch_path
from berthline.sources.csv import write_csv
from berthline.sources.paths import cleaned_path, prediction_path
from berthline.streaming.arrival import run_once


def test_path_rules(spark):
    df = spark.createDataFrame([("s3://b/cleaned/upload1.json",), ("/x/raw/clean_input/a.csv",)], "p string")
    got = df.select(prediction_path(F.col("p")).alias("a"), cleaned_path(F.col("p")).alias("b")).collect()
    assert got[0].a == "s3://b/predictions/upload1_predictions.json"
    assert got[1].b == "cleaned/a.json"


def _uploads(spark, root):
    rows = [(i, f"C{i % 4}", float(i)) for i in range(30)]
    df = spark.createDataFrame(rows, "id long, consignee string, hours double")
    for part in range(3):
        write_csv(df.where(F.col("id") % 3 == part).coalesce(1), f"{root}/in", mode="append")


def test_stream_is_per_file_and_restartable(spark):
    root = scratch_path(spark, "stream-test")
    _uploads(spark, root)

    def per_file(batch):
        # rows per consignee within the uploaded file only
        return batch.groupBy("source_file", "consignee").agg(F.count(F.lit(1)).alias("n"))

    ckpt = f"{root}/ckpt"
    run_once(spark, f"{root}/in", f"{root}/out", per_file, checkpoint=ckpt, sink_format="parquet")
    out = spark.read.option("recursiveFileLookup", True).parquet(f"{root}/out")
    assert out.select("source_file").distinct().count() == 3
    assert out.count() == 12 and out.agg(F.sum("n")).first()[0] == 30
    before = out.count()
    run_once(spark, f"{root}/in", f"{root}/out", per_file, checkpoint=ckpt, sink_format="parquet")
    again = spark.read.option("recursiveFileLookup", True).parquet(f"{root}/out")
    assert again.count() == before  # nothing reprocessed


def test_chained_scoring_writes_prediction_files(spark):
    root = scratch_path(spark, "chain-test")
    _uploads(spark, root)

    def clean(batch):
        return batch.select(F.col("id").cast("long").alias("booking_number"),
                            F.concat(F.lit("EQ"), "id").alias("equipment_id"),
                            F.col("consignee").alias("consignee_name"),
                            F.col("hours").cast("double").alias("arrival_to_pickup_time"),
                            (F.col("hours").cast("double") < 24).cast("int").alias("one_day_pickup"),
                            "source_file")

    score_cleaned_files(spark, f"{root}/in", f"{root}/cleaned", f"{root}/predictions", clean, priority_stub)
    names = {os.path.basename(os.path.dirname(p)) for p in
             glob.glob(f"{root}/predictions/**/*.json", recursive=True) if os.path.isfile(p)}
    assert len(names) == 3 and all(n.startswith("prediction_file=predictions%2F") and
                                   n.endswith("_predictions.json") for n in names)
    preds = spark.read.option("recursiveFileLookup", True).json(f"{root}/predictions")
    assert sorted(preds.columns) == ["booking_number", "consignee_name", "equipment_id", "stowage_priority"]
    got = {r.booking_number: r.stowage_priority for r in preds.collect()}
    assert len(got) == 30
    assert abs(got[0] - 0.5) < 1e-12 and abs(got[29] - 29 / 480) < 1e-12
