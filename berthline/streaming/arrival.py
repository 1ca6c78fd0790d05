"""File-arrival processing with Structured Streaming.

New files under a watched folder start a batch transform over them (the surveyed jobs are
stateless per file: history never spans uploads; ``source_file`` travels through the job as part of
every key). The stream itself carries only file names, from the file index: no upload is read to learn
that it is there (a file without a byte is not seen). ``max_files`` bounds the files of a micro-batch; ``None`` takes all that arrived.

CSV uploads are read as in :func:`berthline.sources.csv.read_csv`: the files of a batch that share a
header are one DataFrame and one job, with missing-value tokens nulled. Progress lives beside
the sink (``<sink>/_progress``), one folder per source, so a later run continues where the last one
ended, and every batch writes to folders of its own: no run touches the output of another
file. A batch that is run again overwrites its own folders.

The :mod:`ledger` beside the sink holds what became of each file. If a job of several files fails
because of a file, it is halved until the file is found, which is recorded as bad; the others are
written. If it fails for a reason that may pass, its files wait: they are taken up again with the
next batch, at the end of the run and in later runs, until they are done. :func:`run_once` raises if files still wait.
"""

from __future__ import annotations

import hashlib
import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.ordering import with_input_order
from ..sources.csv import files_by_header, read_csv
from ..sources.paths import literal
from ..sources.records import variant_reader
from .ledger import Ledger, failed_files, passing, statuses

__all__ = ["Transform", "WaitingFiles", "failed_files", "run_once", "statuses", "watch"]

Transform = Callable[[DataFrame], DataFrame]
_NAMES = "path string, modificationTime timestamp, length bigint, content binary"
_log = logging.getLogger(__name__)


class WaitingFiles(RuntimeError):
    """Files whose last attempt failed for a reason that may pass; the next run takes them up again."""


def _short(*text: str) -> str:
    return hashlib.sha1("\n".join(text).encode()).hexdigest()[:12]


class _Job:
    """The transform of one source into one sink, over given files."""

    def __init__(self, spark: SparkSession, source: str, sink: str, transform: Transform, schema: T.StructType | None,
                 fmt: str, sink_format: str, partition_by: str | None, max_files: int | None) -> None:
        self.spark, self.sink, self.transform, self.schema = spark, sink.rstrip("/"), transform, schema
        self.fmt, self.sink_format, self.partition_by, self.max_files = fmt, sink_format, partition_by, max_files
        self.key = _short(source.rstrip("/"))
        self.ledger = Ledger(spark, sink, source.rstrip("/"))

    def rows(self, files: list[str]) -> DataFrame:
        paths = [literal(f) for f in files]
        if self.fmt == "csv":
            rows = read_csv(self.spark, paths, source_file=True)
            if self.schema is not None:
                rows = rows.withColumns({f.name: F.col(f.name).try_cast(f.dataType) for f in self.schema.fields
                                         if f.name in rows.columns})
            return rows
        reader = variant_reader(self.spark) if self.fmt == "json" and self.schema is None else self.spark.read.format(self.fmt)
        reader = reader.option("recursiveFileLookup", True)
        if self.schema is not None:
            reader = reader.schema(self.schema)
        return with_input_order(reader.load(paths)).withColumn("source_file", F.col("_metadata.file_path"))

    def write(self, out: DataFrame, name: str) -> None:
        w = out.write.mode("overwrite")
        if self.sink_format == "json":
            w = w.option("ignoreNullFields", "false")
        if self.partition_by:
            w = w.partitionBy(self.partition_by)
        w.format(self.sink_format).save(f"{self.sink}/batch={name}")

    def attempt(self, files: list[str], name: str) -> list[tuple[str, str, BaseException | None]]:
        """Process ``files`` together: ``(file, state, error)`` of each."""
        try:
            self.write(self.transform(self.rows(files)), name)
            return [(f, "done", None) for f in files]
        except Exception as e:  # noqa: BLE001 - every error is recorded; none that may pass is taken as the file's
            if passing(e):
                return [(f, "retry", e) for f in files]
            if len(files) == 1:
                return [(files[0], "bad", e)]
            half = len(files) // 2
            return self.attempt(files[:half], f"{name}-0") + self.attempt(files[half:], f"{name}-1")

    def groups(self, names: list[str], ends: list) -> list[list[str]]:
        """Files that are read together; what cannot be grouped goes to ``ends``."""
        if self.fmt != "csv":
            return [names]
        try:
            groups = files_by_header(self.spark, list(map(literal, names)))
        except Exception as e:  # noqa: BLE001 - as in attempt
            if not passing(e):
                return [[f] for f in names]
            ends += [(f, "retry", e) for f in names]
            return []
        empty = set(names) - {f for g in groups for f in g}
        ends += [(f, "bad", ValueError("the file has no header")) for f in sorted(empty)]
        return groups

    def process(self, files: list[tuple[str, int]], name: str) -> None:
        """One batch of ``(file, attempt)``: seen, processed by header, and ended in the ledger."""
        finished = self.ledger.done_in(name)
        number = {f: n for f, n in files if f not in finished}
        if not number:
            return
        names = sorted(number)
        self.ledger.write(f"{name}-start", [(f, number[f], "seen", None) for f in names])
        ends = []
        for n, part in enumerate(groups := self.groups(names, ends)):
            ends += self.attempt(part, name + (f"-h{n}" if len(groups) > 1 else ""))
        self.ledger.write(f"{name}-end", [(f, number[f], state, e) for f, state, e in ends])
        for f, state, e in ends:
            if state != "done":
                _log.warning("%s: %s (%s)", f, state, type(e).__name__)

    def take_up(self) -> None:
        """Another attempt at the files that wait."""
        files = self.ledger.waiting()
        step = self.max_files or len(files) or 1
        for k in range(0, len(files), step):
            part = files[k:k + step]
            self.process(part, f"{self.key}-again-{_short(*[f'{f} {n}' for f, n in part])}")


def _job(spark, source, sink, transform, schema=None, fmt="csv", sink_format="json", partition_by=None, max_files=1, **_) -> _Job:
    return _Job(spark, source, sink, transform, schema, fmt, sink_format, partition_by, max_files)


def watch(spark: SparkSession, source: str, sink: str, transform: Transform,
          schema: T.StructType | None = None, fmt: str = "csv", glob: str | None = None,
          checkpoint: str | None = None, sink_format: str = "json", partition_by: str | None = None,
          available_now: bool = True, max_files: int | None = 1, recursive: bool = True) -> StreamingQuery:
    """Start a file-arrival stream ``source -> transform -> sink``.

    ``max_files=1`` makes each micro-batch one file; ``None`` lets a batch take every new file, which
    needs a transform that keys on ``source_file``. Files in sub-folders count as uploads too.

    ``available_now`` processes what is there and stops (a scheduled run);
    otherwise the query keeps watching. JSON files without a ``schema`` come as one VARIANT column
    ``record`` (see :func:`berthline.sources.records.shred`). ``transform`` sees a batch DataFrame
    with ``source_file`` and an ``_ord`` row order (file, split, position).
    """
    job = _job(spark, source, sink, transform, schema, fmt, sink_format, partition_by, max_files)
    reader = (spark.readStream.format("binaryFile").schema(_NAMES).option("pathGlobFilter", glob or f"*.{fmt}")
              .option("recursiveFileLookup", recursive))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    names = reader.load(source).select("path")  # the content column is pruned: only the index is read

    def each_batch(batch: DataFrame, epoch_id: int) -> None:
        job.take_up()
        files = sorted(r["path"] for r in batch.distinct().collect())  # as many as the batch takes
        job.process([(f, 0) for f in files], f"{job.key}-{epoch_id}")

    checkpoint = checkpoint or f"{job.sink}/_progress/{job.key}"
    writer = names.writeStream.foreachBatch(each_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()


def run_once(spark: SparkSession, source: str, sink: str, transform: Transform, **kw) -> DataFrame:
    """Process every file present now, and those that wait from earlier runs; the status of every
    file of the source (see :func:`statuses`). Raises :class:`WaitingFiles` if some still wait."""
    job = _job(spark, source, sink, transform, **kw)
    job.take_up()
    q = watch(spark, source, sink, transform, available_now=True, **kw)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    waiting = job.ledger.waiting()
    if waiting:
        job.take_up()
        waiting = job.ledger.waiting()
    if waiting:
        names = ", ".join(f for f, _ in waiting[:20])
        raise WaitingFiles(f"{len(waiting)} files wait for another run: {names}")
    return job.ledger.latest()
