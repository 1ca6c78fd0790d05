"""Distributed scoring with any model function (Arrow batches via ``mapInPandas``).

The surveyed handlers send a whole file of records to a model endpoint in one
call. Here each Python worker loads the model once (``model_factory``) and
scores Arrow batches of the partitions it owns, so scoring scales with the
cluster. The model takes a pandas DataFrame of records and returns either the
records with the score column added or a vector of scores in row order.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import REQUEST_COLUMNS, SCORED_COLUMNS
from ..sources.requests import explode_requests, parse_requests
from .columns import select_present

ModelFn = Callable[[pd.DataFrame], "pd.DataFrame | pd.Series | np.ndarray"]
_MODELS: dict[str, ModelFn] = {}


def _model(factory: Callable[[], ModelFn], key: str) -> ModelFn:
    """Load a model once per Python worker process."""
    m = _MODELS.get(key)
    if m is None:
        m = _MODELS[key] = factory()
    return m


def _scores(model: ModelFn, pdf: pd.DataFrame, out_col: str) -> np.ndarray:
    res = model(pdf)
    if isinstance(res, pd.DataFrame):
        if len(res) != len(pdf):
            raise ValueError("model returned a different number of records")
        return res[out_col].to_numpy(dtype="float64", na_value=np.nan)
    return np.asarray(res, dtype="float64")


def score_batch(df: DataFrame, model_factory: Callable[[], ModelFn], out_col: str = "stowage_priority",
                model_key: str | None = None, project: Sequence[str] | None = SCORED_COLUMNS) -> DataFrame:
    """Add ``out_col`` to every row, then keep the ``project`` columns that exist (batch output)."""
    key = model_key or f"{getattr(model_factory, '__module__', '')}.{getattr(model_factory, '__qualname__', id(model_factory))}"
    base = [f for f in df.schema.fields if f.name != out_col]
    schema = T.StructType(base + [T.StructField(out_col, T.DoubleType())])

    def run(batches):
        model = _model(model_factory, key)
        for pdf in batches:
            pdf = pdf.drop(columns=[out_col], errors="ignore")
            pdf[out_col] = _scores(model, pdf, out_col) if len(pdf) else np.array([], dtype="float64")
            yield pdf

    out = df.mapInPandas(run, schema)
    return select_present(out, project) if project else out


def score_requests(requests: DataFrame, record_schema: T.StructType,
                   model_factory: Callable[[], ModelFn], out_col: str = "stowage_priority",
                   body_col: str = "body", id_col: str = "request_id",
                   project: Sequence[str] = REQUEST_COLUMNS, model_key: str | None = None) -> DataFrame:
    """Score a table of requests; a malformed body or a failing model gives status 500.

    Output: ``request_id, status, error`` and the ``project`` columns: one row per scored
    record, one row per failed request, one row with status 200 and nulls for an empty list.
    The status belongs to the request: when one of its records fails, all of it has failed,
    also when its records were scored in several batches.
    """
    key = model_key or f"{getattr(model_factory, '__module__', '')}.{getattr(model_factory, '__qualname__', id(model_factory))}"
    records, failed, empty = explode_requests(parse_requests(requests, record_schema, body_col, id_col), id_col)
    fields = [f for f in records.schema.fields if f.name != out_col]
    schema = T.StructType(fields + [T.StructField(out_col, T.DoubleType()),
                                    T.StructField("status", T.IntegerType()),
                                    T.StructField("error", T.StringType())])
    names = [f.name for f in record_schema.fields]

    def run(batches):
        model = _model(model_factory, key)
        for pdf in batches:
            pdf = pdf.drop(columns=[out_col], errors="ignore")
            try:
                pdf[out_col] = _scores(model, pdf[names], out_col) if len(pdf) else np.array([], "float64")
                pdf["status"], pdf["error"] = 200, None
            except Exception:  # noqa: BLE001 - isolate the failure to its own requests
                parts = []
                for _, req in pdf.groupby(id_col, sort=False):
                    req = req.copy()
                    try:
                        req[out_col] = _scores(model, req[names], out_col)
                        req["status"], req["error"] = 200, None
                    except Exception as e:  # noqa: BLE001
                        req[out_col], req["status"], req["error"] = np.nan, 500, str(e)
                    parts.append(req)
                pdf = pd.concat(parts) if parts else pdf
            yield pdf

    scored = records.mapInPandas(run, schema)
    keep = [c for c in project if c in scored.columns]
    each = Window.partitionBy(id_col)
    judged = (scored.withColumn("_worst", F.max("status").over(each))
              .withColumn("_first", F.row_number().over(each.orderBy(F.col("error").isNull(), "_pos")))
              .where((F.col("_worst") == 200) | (F.col("_first") == 1)))
    ok = judged.select(id_col, F.col("_worst").alias("status"), "error", *[
        F.when(F.col("_worst") == 200, F.col(c)).alias(c) if c != id_col else F.col(c) for c in keep])
    rest = failed.unionByName(empty)
    blank = [F.lit(None).cast(ok.schema[c].dataType).alias(c) for c in keep]
    return ok.unionByName(rest.select(id_col, "status", "error", *blank))


def priority_stub() -> ModelFn:
    """Deterministic stand-in for the external model (the real one is not part of the survey).

    ``0.5 * one_day_pickup + clip(arrival_to_pickup_time, 0, 240) / 480``; missing inputs count 0.
    """
    def model(pdf: pd.DataFrame) -> pd.DataFrame:
        flag = pd.to_numeric(pdf.get("one_day_pickup", 0), errors="coerce")
        hours = pd.to_numeric(pdf.get("arrival_to_pickup_time", 0), errors="coerce")
        flag = pd.Series(flag, index=pdf.index).fillna(0).astype("float64")
        hours = pd.Series(hours, index=pdf.index).fillna(0).astype("float64").clip(0, 240)
        out = pdf.copy()
        out["stowage_priority"] = 0.5 * flag + hours / 480.0
        return out
    return model
