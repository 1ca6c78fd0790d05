"""CSV uploads (quoted newlines, NA tokens), request bodies and request-level error isolation."""

import os

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from berthline.operators.score import score_requests
from berthline.session import scratch_path
from berthline.sources.csv import read_csv


def test_csv_quoted_newlines_and_tokens(spark):
    d = scratch_path(spark, "csv-test")
    os.makedirs(d)
    with open(os.path.join(d, "upload.csv"), "w") as f:
        f.write('Equipment ID,Note,Booking Number\n')
        f.write('E1,"two\nlines",12\n')
        f.write('E2,NA,n/a\n')
        f.write('E3,"say ""hi""",12.0\n')
    df = read_csv(spark, d, multiline=True, schema=T.StructType([T.StructField("Booking Number", T.DoubleType())]))
    rows = sorted(df.collect(), key=lambda r: r["_ord"])
    assert [r["Equipment ID"] for r in rows] == ["E1", "E2", "E3"]
    assert rows[0]["Note"] == "two\nlines" and rows[1]["Note"] is None and rows[2]["Note"] == 'say "hi"'
    assert [r["Booking Number"] for r in rows] == [12.0, None, 12.0]


REC = T.StructType([T.StructField("equipment_id", T.StringType()), T.StructField("k", T.DoubleType())])


def _picky_model():
    def model(pdf: pd.DataFrame):
        if (pdf["k"] < 0).any():
            raise ValueError("negative k")
        return pdf["k"] * 2
    return model


def test_request_errors_are_isolated(spark):
    req = spark.createDataFrame([
        (1, '[{"equipment_id": "A", "k": 1.5}, {"equipment_id": "B", "k": 2}]'),
        (2, '[{"equipment_id": "C", "k": -1}]'),
        (3, 'not json'),
    ], "request_id long, body string")
    out = score_requests(req, REC, _picky_model, project=("equipment_id", "stowage_priority"))
    got = sorted((r.request_id, r.status, r.equipment_id, r.stowage_priority, r.error) for r in out.collect())
    assert got[0][:4] == (1, 200, "A", 3.0) and got[1][:4] == (1, 200, "B", 4.0)
    assert got[2][:2] == (2, 500) and "negative" in got[2][4]
    assert got[3][:2] == (3, 500) and got[3][4] == "invalid request body"


def test_parsed_bodies_are_accepted(spark):
    schema = T.StructType([T.StructField("request_id", T.LongType()), T.StructField("body", T.ArrayType(REC))])
    req = spark.createDataFrame([(1, [("A", 1.0)])], schema)
    out = score_requests(req, REC, _picky_model, project=("equipment_id", "stowage_priority")).collect()
    assert [(r.equipment_id, r.stowage_priority, r.status) for r in out] == [("A", 2.0, 200)]


def test_records_of_any_schema(spark):
    from berthline.sources.records import shred, variant_reader
    root = scratch_path(spark, "variant")
    os.makedirs(root)
    lines = {"a": '{"a": 1, "b": "x", "it\'s": 2}\n{"a": "2", "c": null}\n', "b": '[{"a": 3.7, "b": {"deep": 1}}, {"b": "y"}]\n', "c": "\n[]\n"}
    for n, t in lines.items():
        with open(f"{root}/{n}.json", "w") as f:
            f.write(t)
    df = variant_reader(spark).load(root).withColumn("file", F.col("_metadata.file_name"))
    got = shred(df, "a int, b string, `it's` bigint")
    assert got.columns == ["file", "a", "b", "it's"]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, [
        ("a.json", 1, "x", 2), ("a.json", 2, None, None), ("b.json", 3, '{"deep":1}', None), ("b.json", None, "y", None)]))
    with pytest.raises(ValueError, match="there already"):
        shred(df, "file string")
    with open(f"{root}/d.json", "w") as f:
        f.write("{oops\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        shred(variant_reader(spark).load(root), "a int").collect()
