"""Upload -> cleaned records -> predictions, as two chained file-arrival streams.

* :func:`clean_uploads` (upload -> clean -> write): every manifest CSV that lands
  under the upload folder runs the whole cleaning job against the static event
  log and schedule; the cleaned rows are written as record JSON under a
  ``cleaned/<upload name>.json`` partition.
* :func:`score_cleaned` (cleaned file -> score -> write): every cleaned file is
  scored and cut to the scored-output columns under the
  ``predictions/<name>_predictions.json`` partition.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import SCORED_COLUMNS
from ..operators.ordering import ORD
from ..operators.score import ModelFn, score_batch
from ..sources.paths import cleaned_path, prediction_path
from ..sources.records import shred, to_records
from ..streaming.arrival import run_once
from ..functions.text import normalise_header
from ..session import scratch_path
from .cleaning import clean_container_data, collapsible
from .event_summary import EventSummary


def clean_files(spark: SparkSession, uploads: str, cleaned: str, clean: Callable[[DataFrame], DataFrame],
                upload_glob: str = "*.csv", max_files: int | None = 1) -> DataFrame:
    """Stage 1 with any cleaning function (``source_file`` is kept by ``clean``); the files' statuses."""
    def stage(batch: DataFrame) -> DataFrame:
        out = to_records(clean(batch))
        return out.withColumn("cleaned_file", cleaned_path(F.col("source_file"))).drop("source_file")

    return run_once(spark, uploads, cleaned, stage, fmt="csv", glob=upload_glob, partition_by="cleaned_file",
                    max_files=max_files)


def clean_uploads(spark: SparkSession, uploads: str, cleaned: str, events: DataFrame, schedule: DataFrame,
                  upload_glob: str = "*.csv", max_files: int | None = None, summaries: str | None = None, **clean_kw) -> DataFrame:
    """C2: each uploaded manifest file is cleaned on its own (history never spans uploads).

    The uploads of a micro-batch that share a header are one plan with ``source_file`` as part of every
    key, so the cost does not grow with their number; ``max_files`` bounds a batch.

    When the upload schema allows the collapsed plan, uploads join a summary of the event log by key
    (:class:`EventSummary`, bucketed, so only the uploads are shuffled) instead of re-reading and
    re-aggregating the whole log. ``summaries`` is the folder where summaries are kept: the
    last version there is used, whatever ``events`` holds by then (``EventSummary.add`` brings new
    events in), and one is made if there is none. Without it a summary is made once per
    header for this call, without the state that only later events would need. Returns the files' statuses.
    """
    known: dict[tuple, DataFrame] = {}

    def options(columns: list[str]) -> dict:
        """The collapsed plan with the log's summary for this upload's columns, where it holds."""
        if not (collapsible(columns, events.columns) and clean_kw.get("plan", "auto") in ("auto", "collapsed")):
            return clean_kw
        owned = tuple(sorted({normalise_header(c) for c in columns if c != ORD}))
        if owned not in known:
            kept = EventSummary(spark, summaries or scratch_path(spark, "event-summary"), owned)
            known[owned] = kept.summary(kept.latest() or kept.create(events, keep=summaries is not None))
        return {**clean_kw, "plan": "collapsed", "summary": known[owned]}

    def clean(batch: DataFrame) -> DataFrame:
        return clean_container_data(events, batch, schedule, upload="source_file", **options(batch.columns))

    return clean_files(spark, uploads, cleaned, clean, upload_glob, max_files)


def _cleaned_name(source: F.Column) -> F.Column:
    # the partition folder holds the cleaned name URL-encoded (and the file URI encodes it again)
    raw = F.url_decode(F.regexp_extract(source, r"cleaned_file=([^/]+)/", 1))
    return F.when(raw.contains("%2F"), F.url_decode(raw)).otherwise(raw)


def score_cleaned(spark: SparkSession, cleaned: str, predictions: str, model_factory: Callable[[], ModelFn],
                  cleaned_schema: T.StructType | str | None = None, max_files: int | None = None,
                  columns: T.StructType | str | None = None, glob: str = "*.json") -> DataFrame:
    """C3: score every cleaned record file; keep the scored-output columns. Returns the files' statuses.

    Scoring is row by row and names its output from each row's source file, so one
    micro-batch may hold many cleaned files (``max_files=None``). With ``columns`` (what the model
    and the output need, typed) files of any and of different schemas are read once, as VARIANT
    records from which these columns are taken. ``cleaned_schema`` gives the whole schema of the
    files; with neither it is inferred, which reads all files once more.
    """
    schema = cleaned_schema if isinstance(cleaned_schema, T.StructType) or cleaned_schema is None else T.StructType.fromDDL(cleaned_schema)
    if schema is None and columns is None:
        schema = (spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).json(cleaned).schema)

    def stage(batch: DataFrame) -> DataFrame:
        rows = batch if columns is None else shred(batch, columns)
        named = rows.withColumn("prediction_file", prediction_path(_cleaned_name(F.col("source_file"))))
        scored = score_batch(named, model_factory, project=None)
        return scored.select(*[c for c in SCORED_COLUMNS if c in scored.columns], "prediction_file")

    return run_once(spark, cleaned, predictions, stage, fmt="json", glob=glob, schema=None if columns is not None else schema,
                    partition_by="prediction_file", recursive=True, max_files=max_files)


def score_cleaned_files(spark: SparkSession, uploads: str, cleaned: str, predictions: str,
                        clean: Callable[[DataFrame], DataFrame], model_factory: Callable[[], ModelFn],
                        upload_glob: str = "*.csv", cleaned_schema: str | None = None,
                        max_files: int | None = 1) -> None:
    """Both stages over every file present now, with a custom per-file cleaning function
    (``max_files=None`` when ``clean`` is row-level and may see several files at once)."""
    clean_files(spark, uploads, cleaned, clean, upload_glob, max_files)
    score_cleaned(spark, cleaned, predictions, model_factory, cleaned_schema)
