"""What became of every uploaded file: a ledger of small committed records beside a sink.

A file is ``seen`` when its batch starts and ends as ``done`` (its rows are written), ``bad`` (the
file itself cannot be processed: its header, values or the model's answer to them) or ``retry`` (the
attempt failed for a reason outside the file, such as a store that is briefly away, a lost
executor or a full disk). Files in ``retry`` are taken up again; ``bad`` ones are not.

Every write of the ledger is a folder of its own, named after the batch and its step, and is
overwritten when the batch is run again. The latest record of a file is that of its last attempt.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.errors import AnalysisException, PySparkException, PythonException
from pyspark.errors.exceptions import captured
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "source string, source_file string, attempt int, state string, status int, error_class string, error string, batch string"
_ORDER = {"seen": 0, "retry": 1, "bad": 2, "done": 3}
_STATUS = {"done": 200, "bad": 422, "retry": 503}

# Python errors that point at the file's rows or columns; all others may pass.
_OF_THE_FILE = (ValueError, LookupError, TypeError, ArithmeticError, AttributeError, AssertionError)
_SPARK_OF_THE_FILE = tuple(getattr(captured, n) for n in (
    "AnalysisException", "ParseException", "ArithmeticException", "DateTimeException", "NumberFormatException",
    "IllegalArgumentException", "ArrayIndexOutOfBoundsException", "SparkNoSuchElementException", "SparkRuntimeException")
    if hasattr(captured, n))
# Conditions of these classes that are about the store, not about the file.
_AWAY = ("PATH_NOT_FOUND", "FAILED_READ_FILE.FILE_NOT_EXIST", "LOAD_DATA_PATH_NOT_EXISTS", "UNABLE_TO_INFER_SCHEMA")
_HEADER = "CSV header does not conform"


def _worker_error(text: str) -> str:
    """The name of the exception that ended a Python worker's traceback."""
    names = re.findall(r"^([A-Za-z_][\w.]*)(?::|$)", text, re.M)
    return names[-1].rsplit(".", 1)[-1] if names else ""


def passing(error: BaseException) -> bool:
    """Whether the same file may succeed at another time."""
    text = str(error)
    if _HEADER in text:
        return False
    condition = error.getCondition() if isinstance(error, PySparkException) else None
    if condition and condition.startswith(_AWAY):
        return True
    if isinstance(error, (PythonException, captured.PythonException)):
        import builtins
        kind = getattr(builtins, _worker_error(text.split("\n\tat ")[0]), None)
        return not (isinstance(kind, type) and issubclass(kind, _OF_THE_FILE))
    return not isinstance(error, (*_OF_THE_FILE, AnalysisException, *_SPARK_OF_THE_FILE))


class Ledger:
    """The ledger beside ``sink``, for the files of ``source``."""

    def __init__(self, spark: SparkSession, sink: str, source: str) -> None:
        self.spark, self.root, self.source = spark, f"{sink.rstrip('/')}/_ledger", source

    def write(self, name: str, files: Iterable[tuple[str, int, str, BaseException | None]]) -> None:
        """Commit ``(file, attempt, state, error)`` records under ``name``."""
        rows = [(self.source, f, n, state, _STATUS.get(state), type(e).__name__ if e else None, str(e)[:2000] if e else None, name)
                for f, n, state, e in files]
        if rows:
            self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{self.root}/{name}")

    def _read(self, glob: str) -> DataFrame:
        try:
            return self.spark.read.schema(SCHEMA).parquet(f"{self.root}/{glob}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], SCHEMA)

    def latest(self) -> DataFrame:
        """One row per file of the source: its last record."""
        order = F.create_map(*[F.lit(x) for kv in _ORDER.items() for x in kv])[F.col("state")]
        records = self._read("*").where(F.col("source") == self.source)
        cols = [c for c in records.columns if c not in ("source", "source_file")]
        last = records.groupBy("source_file").agg(F.max_by(F.struct(*cols), F.struct("attempt", order)).alias("r"))
        return last.select("source_file", *[F.col("r")[c].alias(c) for c in cols])

    def waiting(self, limit: int = 10_000) -> list[tuple[str, int]]:
        """Files to take up again, with their next attempt (``limit`` at a time, in name order)."""
        rows = self.latest().where("state = 'retry'").select("source_file", "attempt").orderBy("source_file").limit(limit)
        return [(r["source_file"], r["attempt"] + 1) for r in rows.collect()]

    def done_in(self, name: str) -> set[str]:
        """Files that this batch has finished already (a batch that is run again)."""
        return {r["source_file"] for r in self._read(f"{name}-end").where("state <> 'retry'").select("source_file").collect()}


def statuses(spark: SparkSession, sink: str, source: str) -> DataFrame:
    """``source_file, attempt, state, status, error_class, error, batch`` of every file of ``source``."""
    return Ledger(spark, sink, source.rstrip("/")).latest()


def failed_files(spark: SparkSession, sink: str) -> DataFrame:
    """``source_file, status, error`` of files that are bad or still wait, of every source of the sink."""
    every = Ledger(spark, sink, "")._read("*")
    sources = [r["source"] for r in every.select("source").distinct().collect()]  # one per watched folder
    out = spark.createDataFrame([], "source_file string, status int, error string")
    for s in sources:
        out = out.unionByName(Ledger(spark, sink, s).latest().where("state in ('bad', 'retry')").select("source_file", "status", "error"))
    return out
