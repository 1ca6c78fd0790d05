"""Fitted encoders as versioned tables: fit once, transform in other sessions.

A version is a folder ``version=<n>`` with the fitted rows (``table``, Parquet: one row per category)
and one record (``model``, JSON: kind, columns and types of the fit, parameters). The record is written
last, so a version without it is not there. Versions are never changed; a save makes the next one.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .encode import ConsigneeModel, OneHotModel, OrdinalModel, TargetModel

Model = OneHotModel | OrdinalModel | TargetModel | ConsigneeModel
_RECORD = "kind string, types string, parameters string, note string"
_ONE_HOT = "at int, code int, category string"


def _parts(model: Model, spark: SparkSession) -> tuple[DataFrame, dict]:
    if isinstance(model, OneHotModel):
        rows = [(n, k, v) for n, vals in enumerate(model.categories.values()) for k, v in enumerate(vals)]  # bounded by the fit
        return spark.createDataFrame(rows, _ONE_HOT), {"columns": list(model.categories)}
    if isinstance(model, OrdinalModel):
        return model.table, {}
    if isinstance(model, TargetModel):
        return model.table, {"global_mean": model.global_mean}
    return model.table, {"global_mean": model.global_mean, "rare_thresh": model.rare_thresh}


def versions(spark: SparkSession, path: str) -> DataFrame:
    """``version, kind, types, parameters, note`` of every complete version."""
    root = path.rstrip("/")
    try:
        records = spark.read.schema(_RECORD).json(f"{root}/version=*/model")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], f"version int, {_RECORD}")
    number = F.regexp_extract(F.col("_metadata.file_path"), r"/version=(\d+)/model/", 1).cast("int")
    return records.select(number.alias("version"), "kind", "types", "parameters", "note")


def save(spark: SparkSession, model: Model, path: str, note: str = "") -> int:
    """Write the model as the next version; returns its number (from 1)."""
    root = path.rstrip("/")
    version = (versions(spark, root).agg(F.max("version")).first()[0] or 0) + 1
    table, parameters = _parts(model, spark)
    table.write.mode("overwrite").parquet(f"{root}/version={version}/table")
    record = (type(model).__name__, json.dumps(model.types), json.dumps(parameters), note)
    spark.createDataFrame([record], _RECORD).coalesce(1).write.mode("overwrite").json(f"{root}/version={version}/model")
    return version


def load(spark: SparkSession, path: str, version: int | None = None) -> Model:
    """The given version, or the latest one."""
    found = versions(spark, path)
    if version is not None:
        found = found.where(F.col("version") == version)
    r = found.orderBy(F.col("version").desc()).first()
    if r is None:
        raise FileNotFoundError(f"no {'model' if version is None else f'version {version}'} in {path}")
    table = spark.read.parquet(f"{path.rstrip('/')}/version={r['version']}/table")
    types, parameters = json.loads(r["types"]), json.loads(r["parameters"])
    if r["kind"] == "OneHotModel":
        categories: dict[str, list[str]] = {c: [] for c in parameters["columns"]}
        for x in table.orderBy("at", "code").collect():  # bounded by the fit
            categories[parameters["columns"][x["at"]]].append(x["category"])
        return OneHotModel(categories, types)
    if r["kind"] == "OrdinalModel":
        return OrdinalModel(types, table)
    if r["kind"] == "TargetModel":
        return TargetModel(types, table, parameters["global_mean"])
    return ConsigneeModel(types, table, parameters["global_mean"], parameters["rare_thresh"])
