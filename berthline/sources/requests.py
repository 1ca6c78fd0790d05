"""Request bodies: a JSON text **or** an already-parsed list of records per request."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

INVALID_BODY = "invalid request body"


def parse_requests(requests: DataFrame, record_schema: T.StructType, body_col: str = "body",
                   id_col: str = "request_id") -> DataFrame:
    """One row per request with ``_records`` (array of structs, NULL when the body is malformed)."""
    body_type = requests.schema[body_col].dataType
    if isinstance(body_type, T.StringType):
        recs = F.from_json(F.col(body_col), T.ArrayType(record_schema), {"mode": "PERMISSIVE"})
    else:
        recs = F.col(body_col)
    return requests.select(id_col, recs.alias("_records"))


def explode_requests(parsed: DataFrame, id_col: str = "request_id"):
    """Split parsed requests into (records, failures, empty).

    records: one row per record with ``request_id`` and ``_pos``; failures: one row per
    malformed request with status 500 and the error text; empty: one row with status 200
    per request whose list has no records.
    """
    ok = parsed.where(F.col("_records").isNotNull())
    records = ok.select(id_col, F.posexplode("_records").alias("_pos", "_r")).select(id_col, "_pos", "_r.*")
    failed = parsed.where(F.col("_records").isNull()).select(
        id_col, F.lit(500).alias("status"), F.lit(INVALID_BODY).alias("error"))
    empty = parsed.where(F.size("_records") == 0).select(
        id_col, F.lit(200).alias("status"), F.lit(None).cast("string").alias("error"))
    return records, failed, empty
