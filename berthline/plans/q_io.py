"""Registered end-to-end queries: cleaning job, scoring, requests, CSV/JSON round trips, streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import SCORED_COLUMNS
from ..operators import quality
from ..operators.columns import create_binary_feature, create_key_feature, standardize_column_names
from ..operators.score import priority_stub, score_batch, score_requests
from ..session import scratch_path
from ..sources.csv import read_csv, write_csv
from ..sources.paths import cleaned_path, prediction_path
from ..sources.records import read_records, write_records
from ..streaming.arrival import WaitingFiles, run_once
from .cleaning_sql import CATEGORIES, CLEAN_CONTAINER_SQL, CLEANED_SQL, UPLOAD_SCORE_SQL
from .cleaning import clean_container_data
from .event_summary import EventSummary
from .inputs import event_log, manifest, schedule
from .registry import register
from .scoring import clean_uploads, score_cleaned, score_cleaned_files
from .tables import SHIPMENTS_SQL, rounded, shipments, table


@register("clean_container", CLEAN_CONTAINER_SQL)
def q_clean_container(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole cleaning job over the event log, manifest and schedule derived from the tables.

    The one-hot categories are pinned, so that the columns don't depend on the data; tests
    compare the fitted job with an independent pandas implementation on the sf0.001 tables.
    """
    out = clean_container_data(event_log(spark, sf_dir), manifest(spark, sf_dir), schedule(spark, sf_dir),
                               one_hot_categories=CATEGORIES)
    return rounded(out)


_STUB_SQL = "0.5 * one_day_pickup + least(greatest(arrival_to_pickup_time, 0), 240) / 480.0"


@register("score_stub", f"""
WITH s AS (SELECT *, CAST(coalesce(arrival_to_pickup_time < 24, false) AS INTEGER) AS one_day_pickup
           FROM ({SHIPMENTS_SQL}) WHERE arrival_to_pickup_time >= 0)
SELECT 'EQ' || CAST(l_partkey AS VARCHAR) AS equipment_id, l_orderkey AS booking_number,
       'C' || CAST(consignee AS VARCHAR) AS consignee_name,
       'V_' || CAST(l_suppkey AS VARCHAR) || '_E' AS voyage_code,
       round({_STUB_SQL}, 4) AS stowage_priority
FROM s
""")
def q_score_stub(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score picked-up shipments with the stub model, keep the scored-output columns."""
    s = quality.remove_negative_values(shipments(spark, sf_dir), ["arrival_to_pickup_time"])
    s = create_binary_feature(s, "arrival_to_pickup_time", 24, "one_day_pickup").select(
        F.concat(F.lit("EQ"), F.col("l_partkey").cast("string")).alias("equipment_id"),
        F.col("l_orderkey").alias("booking_number"),
        F.concat(F.lit("C"), F.col("consignee").cast("string")).alias("consignee_name"),
        F.concat(F.lit("V_"), F.col("l_suppkey").cast("string"), F.lit("_E")).alias("voyage_code"),
        "one_day_pickup", "arrival_to_pickup_time")
    return rounded(score_batch(s, priority_stub))


REQUEST_RECORD = T.StructType([
    T.StructField("equipment_id", T.StringType()),
    T.StructField("consignee_name", T.StringType()),
    T.StructField("voyage_code", T.StringType()),
    T.StructField("one_day_pickup", T.IntegerType()),
    T.StructField("arrival_to_pickup_time", T.DoubleType()),
])


@register("request_score", """
WITH r AS (SELECT event_id AS request_id, user_id, event_type, value, unnest(range(n)) AS pos,
                  CAST(json_extract(props, '$.k') AS INTEGER) AS k
           FROM (SELECT *, CASE WHEN event_id % 50 IN (0, 1) THEN 1 WHEN event_id % 50 = 2 THEN 3 ELSE 1 END AS n
                 FROM events))
SELECT request_id,
       CASE WHEN request_id % 50 = 0 THEN 500 ELSE 200 END AS status,
       CASE WHEN request_id % 50 = 0 THEN 'invalid request body' END AS error,
       CASE WHEN request_id % 50 > 1 THEN 'E' || CAST(request_id AS VARCHAR) || '-' || CAST(pos AS VARCHAR) END AS equipment_id,
       CASE WHEN request_id % 50 > 1 THEN 'U' || CAST(user_id AS VARCHAR) END AS consignee_name,
       CASE WHEN request_id % 50 > 1 THEN event_type END AS voyage_code,
       CASE WHEN request_id % 50 > 1 THEN round(0.5 * CAST(k < 50 AS INTEGER)
            + least(greatest(value, 0), 240) / 480.0, 4) END AS stowage_priority
FROM r
""")
def q_request_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event is a request with a JSON body of one record; every 50th body is malformed,
    every 50th an empty list and every 50th a list of three records."""
    e = table(spark, sf_dir, "events")
    k, i = F.get_json_object("props", "$.k"), F.col("event_id") % 50

    def record(pos: int):
        return F.concat(
            F.lit('{"equipment_id": "E'), F.col("event_id").cast("string"), F.lit(f'-{pos}'),
            F.lit('", "consignee_name": "U'), F.col("user_id").cast("string"),
            F.lit('", "voyage_code": "'), F.col("event_type"),
            F.lit('", "one_day_pickup": '), (k.cast("int") < 50).cast("int").cast("string"),
            F.lit(', "arrival_to_pickup_time": '), F.col("value").cast("string"), F.lit("}"))

    many = F.concat(F.lit("["), F.concat_ws(", ", *map(record, range(3))), F.lit("]"))
    body = (F.when(i == 0, "{not json").when(i == 1, "[]").when(i == 2, many)
            .otherwise(F.concat(F.lit("["), record(0), F.lit("]"))))
    req = e.select(F.col("event_id").alias("request_id"), body.alias("body"))
    return rounded(score_requests(req, REQUEST_RECORD, priority_stub))


_TOKENS_SQL = "('NA', 'n/a', 'NULL', '#N/A', 'nan', '')"


@register("csv_roundtrip", """
SELECT c_custkey, c_name, round(c_acctbal, 4) AS c_acctbal,
       CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 11 = 0 THEN NULL
            WHEN c_custkey % 13 = 0 THEN NULL ELSE c_mktsegment END AS segment
FROM customer
""")
def q_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer -> CSV with missing-value tokens -> read back typed, tokens as NULL."""
    c = table(spark, sf_dir, "customer")
    ck = F.col("c_custkey")
    src = c.select("c_custkey", "c_name", "c_acctbal",
                   F.when(ck % 7 == 0, "NA").when(ck % 11 == 0, "n/a").when(ck % 13 == 0, "#N/A")
                    .otherwise(F.col("c_mktsegment")).alias("segment"))
    path = scratch_path(spark, "csv-roundtrip")
    write_csv(src, path)
    schema = T.StructType([T.StructField("c_custkey", T.LongType()), T.StructField("c_acctbal", T.DoubleType())])
    back = read_csv(spark, path, schema=schema, input_order=False)
    return rounded(back.select("c_custkey", "c_name", "c_acctbal", "segment"))


@register("json_sink", """
SELECT o_orderkey, epoch_ms(o_orderdate) AS o_orderdate,
       CASE WHEN o_orderkey % 11 > 1 THEN round(o_totalprice, 4) END AS o_totalprice,
       CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus
FROM orders
""")
def q_json_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders -> record JSON (epoch-ms dates, NULLs kept, NaN and Infinity missing) -> read back."""
    odd = F.col("o_orderkey") % 11
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderdate",
        F.when(odd == 0, float("nan")).when(odd == 1, float("-inf")).otherwise(F.col("o_totalprice")).alias("o_totalprice"),
        F.when(F.col("o_orderkey") % 7 == 0, F.lit(None)).otherwise(F.col("o_orderstatus")).alias("o_orderstatus"))
    path = scratch_path(spark, "json-sink")
    write_records(o, path)
    schema = "o_orderkey bigint, o_orderdate bigint, o_totalprice double, o_orderstatus string"
    return rounded(read_records(spark, path, schema))


def _upload_transform(batch: DataFrame) -> DataFrame:
    """Per-file cleaning of an orders upload (stateless per file)."""
    d = standardize_column_names(batch)
    d = d.withColumn("booking_number", F.col("o_orderkey")).withColumn(
        "equipment_id", F.concat(F.lit("EQ"), F.col("o_custkey")))
    d = create_key_feature(d)
    d = d.withColumn("arrival_to_pickup_time", F.col("o_totalprice").cast("double") / 10000.0)
    d = create_binary_feature(d, "arrival_to_pickup_time", 24, "one_day_pickup")
    return d.select("equipment_id", "booking_number",
                    F.concat(F.lit("C"), F.col("o_custkey")).alias("consignee_name"),
                    F.concat_ws("_", "o_orderstatus", F.substring("o_orderdate", 1, 4), F.lit("E")).alias("voyage_code"),
                    "one_day_pickup", "arrival_to_pickup_time", "source_file")


@register("file_arrival", """
SELECT 'EQ' || CAST(o_custkey AS VARCHAR) AS equipment_id, o_orderkey AS booking_number,
       'C' || CAST(o_custkey AS VARCHAR) AS consignee_name,
       o_orderstatus || '_' || CAST(year(o_orderdate) AS VARCHAR) || '_E' AS voyage_code,
       round(0.5 * CAST(o_totalprice / 10000.0 < 24 AS INTEGER)
             + least(greatest(o_totalprice / 10000.0, 0), 240) / 480.0, 4) AS stowage_priority
FROM orders
""")
def q_file_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders land as CSV uploads; stream 1 cleans each file to record JSON, stream 2 scores each
    cleaned file and writes predictions under the ``predictions/`` naming rule."""
    root = scratch_path(spark, "file-arrival")
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("o_orderdate"))
    for status in ("F", "O", "P"):
        write_csv(o.where(F.col("o_orderstatus") == status), f"{root}/raw/clean_input", mode="append")
    score_cleaned_files(spark, f"{root}/raw/clean_input", f"{root}/cleaned", f"{root}/predictions",
                        _upload_transform, priority_stub, upload_glob="*.csv", max_files=None)
    schema = "equipment_id string, booking_number bigint, consignee_name string, voyage_code string, " \
             "stowage_priority double"
    preds = spark.read.option("recursiveFileLookup", True).schema(schema).json(f"{root}/predictions")
    return rounded(preds.select(*SCORED_COLUMNS))


#: What the stub model and the scored output take from a record.
MODEL_COLUMNS = ("equipment_id string, booking_number bigint, consignee_name string, voyage_code string, "
                 "one_day_pickup int, arrival_to_pickup_time double")


@register("upload_clean_score", UPLOAD_SCORE_SQL)
def q_upload_clean_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C2 + C3 end to end: the manifest derived from orders lands as one CSV upload per order
    status; each upload is cleaned against the static event log and schedule, written as
    record JSON, then scored into prediction files."""
    root = scratch_path(spark, "upload-clean-score")
    m = manifest(spark, sf_dir)
    for status in ("F", "O", "P"):
        write_csv(m.where(F.col("Carrier Code") == status).drop("_ord"), f"{root}/raw/clean_input", mode="append")
    # the static side tables are files, as in the surveyed job (written once, read per upload)
    event_log(spark, sf_dir).write.option("compression", "zstd").parquet(f"{root}/static/events")
    schedule(spark, sf_dir).write.parquet(f"{root}/static/schedule")
    events = spark.read.parquet(f"{root}/static/events")
    sched = spark.read.parquet(f"{root}/static/schedule")
    clean_uploads(spark, f"{root}/raw/clean_input", f"{root}/cleaned", events, sched)
    score_cleaned(spark, f"{root}/cleaned", f"{root}/predictions", priority_stub, columns=MODEL_COLUMNS)
    schema = "equipment_id string, booking_number bigint, consignee_name string, voyage_code string, " \
             "stowage_priority double"
    preds = spark.read.option("recursiveFileLookup", True).schema(schema).json(f"{root}/predictions")
    return rounded(preds.select(*SCORED_COLUMNS))


@register("prediction_paths", """
SELECT o_orderkey, 'cleaned/' || o_orderstatus || '-' || CAST(o_orderkey AS VARCHAR) || '.json' AS cleaned_file,
       'predictions/' || o_orderstatus || '-' || CAST(o_orderkey AS VARCHAR) || '_predictions.json' AS prediction_file
FROM orders
""")
def q_prediction_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of the cleaned and the scored file of every upload (one upload per order)."""
    name = F.concat(F.lit("store://uploads/raw/clean_input/"), "o_orderstatus", F.lit("-"), F.col("o_orderkey").cast("string"), F.lit(".csv"))
    cleaned = cleaned_path(name)
    return table(spark, sf_dir, "orders").select("o_orderkey", cleaned.alias("cleaned_file"), prediction_path(cleaned).alias("prediction_file"))


@register("upload_ledger", """
SELECT o_orderstatus AS upload, 'done' AS state, CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS attempt, count(*) AS n_rows
FROM orders GROUP BY 1, 3
UNION ALL
SELECT 'N', 'bad', 0, 0
""")
def q_upload_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What became of every upload when the store fails in the middle: the orders land as one upload per
    status, and an upload without order columns among them. The first attempt at status ``P`` meets a
    store that is away; it is taken up again, the upload without the columns is bad."""
    root = scratch_path(spark, "upload-ledger")
    o = table(spark, sf_dir, "orders")
    for status in ("F", "O", "P"):
        write_csv(o.where(F.col("o_orderstatus") == status).select("o_orderkey", "o_orderstatus").coalesce(1), f"{root}/in/{status}")
    write_csv(table(spark, sf_dir, "nation").coalesce(1), f"{root}/in/N")
    upload = F.regexp_extract("source_file", "([^/]+)/[^/]+$", 1)
    away = {"P"}

    def keep(batch: DataFrame) -> DataFrame:
        names = {r["upload"] for r in batch.select(upload.alias("upload")).distinct().collect()}
        if names & away:
            away.difference_update(names)
            raise ConnectionError("the store is away")
        return batch.select("o_orderkey", "source_file")

    try:
        status = run_once(spark, f"{root}/in", f"{root}/out", keep)
    except WaitingFiles:
        status = run_once(spark, f"{root}/in", f"{root}/out", keep)
    rows = spark.read.option("recursiveFileLookup", True).schema("o_orderkey string, source_file string").json(f"{root}/out")
    rows = rows.groupBy(upload.alias("upload")).agg(F.count(F.lit(1)).alias("n_rows"))
    status = status.select(upload.alias("upload"), "state", "attempt")
    return status.join(rows, "upload", "left").select("upload", "state", "attempt", F.coalesce("n_rows", F.lit(0)).alias("n_rows"))


_VERSIONED_SQL = CLEANED_SQL.replace("row(l_orderkey, l_linenumber", "row(e_place, l_orderkey, l_linenumber")


@register("event_summary", f"""
WITH {_VERSIONED_SQL}
SELECT 'EQ' || CAST(ok AS VARCHAR) || '_' || CAST(ok AS VARCHAR) AS key, hlp_count, pickup_date, avp_date, dfv_event_date, load_date,
       x.event_type, x.event_date, x.inventory_location_code
FROM per_key JOIN lasts x USING (ok)
""")
def q_event_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event log's kept summary after new events: the second events of all line items come in as
    a new version of a summary made from the first ones."""
    path = scratch_path(spark, "event-log")
    event_log(spark, sf_dir).write.option("compression", "zstd").parquet(path)  # made once: both parts are read from it
    log = spark.read.parquet(path)
    kept = EventSummary(spark, scratch_path(spark, "summaries"), manifest(spark, sf_dir).columns, buckets=8)
    kept.create(log.where("_ord.e_place = 0"))
    kept.add(log.where("_ord.e_place = 1"))
    return kept.summary().select("key", "hlp_count", "pickup_date", "avp_date", "dfv_event_date", "load_date", "event_type",
                                 "event_date", "inventory_location_code")


@register("mixed_records", """
SELECT 'EQ' || CAST(o_custkey AS VARCHAR) AS equipment_id,
       CASE WHEN o_orderstatus <> 'O' THEN o_orderkey END AS booking_number, 'C' || CAST(o_custkey AS VARCHAR) AS consignee_name,
       CASE WHEN o_orderstatus = 'F' THEN 'V' || CAST(o_custkey % 5 AS VARCHAR) END AS voyage_code,
       round(0.5 * CAST(floor(o_totalprice) < 240000 AS INTEGER) + least(greatest(floor(o_totalprice) / 10000.0, 0), 240) / 480.0, 4)
         AS stowage_priority
FROM orders
""")
def q_mixed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned record files of three schemas, scored in one pass: whole records, records without the
    booking whose numbers are text, and lists of records without the voyage."""
    root = scratch_path(spark, "mixed-records")
    hours = F.floor("o_totalprice") / 10000.0
    o = table(spark, sf_dir, "orders").select(
        "o_orderstatus", F.concat(F.lit("EQ"), F.col("o_custkey").cast("string")).alias("equipment_id"), F.col("o_orderkey").alias("booking_number"),
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("consignee_name"),
        F.concat(F.lit("V"), (F.col("o_custkey") % 5).cast("string")).alias("voyage_code"),
        (hours < 24).cast("int").alias("one_day_pickup"), hours.alias("arrival_to_pickup_time"))
    whole = o.where("o_orderstatus = 'F'").drop("o_orderstatus")
    texts = o.where("o_orderstatus = 'O'").select("equipment_id", "consignee_name", F.col("one_day_pickup").cast("string").alias("one_day_pickup"),
                                                  F.col("arrival_to_pickup_time").cast("string").alias("arrival_to_pickup_time"))
    lists = o.where("o_orderstatus = 'P'").drop("o_orderstatus", "voyage_code")
    lists = lists.groupBy(F.pmod("booking_number", F.lit(64)).alias("line")).agg(F.collect_list(F.struct(*lists.columns)).alias("r"))  # a list a line
    write_records(whole, f"{root}/cleaned/cleaned_file=a")
    write_records(texts, f"{root}/cleaned/cleaned_file=b")
    lists.select(F.to_json("r").alias("value")).write.text(f"{root}/cleaned/cleaned_file=c")
    score_cleaned(spark, f"{root}/cleaned", f"{root}/predictions", priority_stub, columns=MODEL_COLUMNS, glob="part-*")
    schema = "equipment_id string, booking_number bigint, consignee_name string, voyage_code string, stowage_priority double"
    preds = spark.read.option("recursiveFileLookup", True).schema(schema).json(f"{root}/predictions")
    return rounded(preds.select(*SCORED_COLUMNS))
