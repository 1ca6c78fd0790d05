"""The event log's summary for the cleaning job, kept as versioned tables bucketed by key.

A version holds the distinct event rows with position and number of copies (``state``) and what the
job needs per key (``summary``), both in ``buckets`` buckets by ``key``. So

* uploads join the summary without shuffling it: only the manifest is dealt to its buckets;
* new events make the next version from the last one's state and their own rows alone:
  ``min`` of positions and ``sum`` of copies merge, and everything per key follows from them.

Event rows are shuffled once, to their buckets: distinct rows, state and summary are made there
(a bucket is sorted, never held in memory). There are so many buckets as the session has shuffle
partitions, at least, so that buckets don't grow with the log where partitions are set to its size.

New events come after all earlier ones: the position starts with the version they came in. Within a
version the state keeps the place among the key's rows; the position in the log, which is wide,
stays with the key's last row, whose summary needs it. A version
is complete once its record is written, which is last. Nothing depends on a catalog that outlives
the session: the tables are files, named in the session's catalog when they are opened.
"""

from __future__ import annotations

import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.text import normalise_header
from ..operators.ordering import ORD, ensure_order
from .cleaning import event_rows, per_key_events

_RECORD = "buckets int, owned string, state string, summary string"


class EventSummary:
    """Kept summaries below ``path`` for uploads with the given (normalised) manifest columns;
    new versions have ``buckets`` buckets (``spark.sql.shuffle.partitions`` by default), or the first
    multiple of them that is not below ``spark.sql.shuffle.partitions``."""

    def __init__(self, spark: SparkSession, path: str, manifest_columns, buckets: int | None = None) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.buckets = buckets * max(1, -(-partitions // buckets)) if buckets else partitions
        self.owned = sorted({normalise_header(c) for c in manifest_columns if c != ORD})

    def _records(self) -> DataFrame:
        try:
            found = self.spark.read.schema(_RECORD).json(f"{self.path}/version=*/record")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], f"version int, {_RECORD}")
        number = F.regexp_extract(F.col("_metadata.file_path"), r"/version=(\d+)/record/", 1).cast("int")
        return found.select(number.alias("version"), "buckets", "owned", "state", "summary").where(F.col("owned") == json.dumps(self.owned))

    def latest(self) -> int:
        """The last complete version for these columns; 0 if there is none."""
        return self._records().agg(F.max("version")).first()[0] or 0

    def _next(self) -> int:
        try:
            used = self.spark.read.schema("x string").json(f"{self.path}/version=*/record").select(F.col("_metadata.file_path").alias("f"))
            return 1 + (used.agg(F.max(F.regexp_extract("f", r"/version=(\d+)/", 1).cast("int"))).first()[0] or 0)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return 1

    def _write(self, df: DataFrame, version: int, name: str) -> str:
        table = f"berthline_{uuid.uuid4().hex}"
        # one file per bucket: the rows lie in partitions as in the buckets (if not, the files are more)
        (df.write.mode("overwrite").option("path", f"{self.path}/version={version}/{name}").option("compression", "zstd").format("parquet")
         .bucketBy(self.buckets, "key").sortBy("key").saveAsTable(table))
        schema = self.spark.table(table).schema.json()
        self.spark.sql(f"DROP TABLE {table}")  # external: the files stay
        return schema

    def _open(self, version: int, name: str) -> DataFrame:
        r = self._records().where(F.col("version") == version).first()
        if r is None:
            raise FileNotFoundError(f"no version {version} in {self.path}")
        if not r[name]:
            raise FileNotFoundError(f"version {version} in {self.path} was made without its {name}")
        return self._bucketed(f"{self.path}/version={version}/{name}", r[name], r["buckets"])

    def _bucketed(self, path: str, schema: str, buckets: int | None = None) -> DataFrame:
        """Written files as a bucketed table of this session."""
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in StructType.fromJson(json.loads(schema)).fields)
        table = f"berthline_{uuid.uuid4().hex}"
        self.spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet OPTIONS (path '{path}') "
                       f"CLUSTERED BY (key) SORTED BY (key) INTO {buckets or self.buckets} BUCKETS")
        return self.spark.table(table)

    def _commit(self, rows: DataFrame, version: int, keep: bool = True) -> int:
        kinds = {"state": ""}
        if keep:
            kinds["state"] = self._write(self._placed(rows), version, "state")
            # from the written state: grouped by key without an exchange
            rows = self._bucketed(f"{self.path}/version={version}/state", kinds["state"])
        summary = per_key_events(rows).withColumn(ORD, F.struct(f"{ORD}.version", f"{ORD}.at"))
        kinds["summary"] = self._write(summary, version, "summary")
        record = (self.buckets, json.dumps(self.owned), kinds["state"], kinds["summary"])
        self.spark.createDataFrame([record], _RECORD).coalesce(1).write.mode("overwrite").json(f"{self.path}/version={version}/record")
        return version

    def _rows(self, events: DataFrame, version: int) -> DataFrame:
        """The event rows in their buckets, as a state before its equal rows meet."""
        rows = event_rows(ensure_order(events), self.owned).repartition(self.buckets, "key")
        first = F.struct(F.lit(version).alias("version"), F.lit(0).cast("bigint").alias("place"), F.col(ORD).alias("at"))
        return rows.select(*[c for c in rows.columns if c != ORD], first.alias("_first"), F.lit(1).cast("bigint").alias("_copies"))

    def _distinct(self, rows: DataFrame) -> DataFrame:
        keys = [c for c in rows.columns if c not in ("_first", "_copies")]
        return rows.groupBy(*keys).agg(F.min("_first").alias("_first"), F.sum("_copies").alias("_copies"))

    def _placed(self, distinct_rows: DataFrame) -> DataFrame:
        """Distinct rows with their place among the key's rows; the last one keeps its position in the log."""
        at = Window.partitionBy("key").orderBy("_first")
        last = F.lead(F.lit(True)).over(at).isNull()
        return distinct_rows.withColumn("_first", F.struct(
            F.col("_first.version").alias("version"), F.row_number().over(at).cast("bigint").alias("place"),
            F.when(last, F.col("_first.at")).alias("at")))

    def create(self, events: DataFrame, keep: bool = True) -> int:
        """Summarise a whole event log as the next version; without ``keep`` it has no state, and no events can be added."""
        version = self._next()
        return self._commit(self._distinct(self._rows(events, version)), version, keep)

    def add(self, events: DataFrame) -> int:
        """The next version: the last one with new events (same columns), which come after all earlier ones."""
        last = self.latest()
        if not last:
            return self.create(events)
        version = self._next()
        new, old = self._rows(events, version), self.state(last)
        if sorted(new.columns) != sorted(old.columns):
            raise ValueError(f"the new events have columns {new.columns}, earlier ones {old.columns}")
        if "place" not in old.schema["_first"].dataType.names:  # a state that keeps every position
            old = old.withColumn("_first", F.struct("_first.version", F.lit(0).cast("bigint").alias("place"), "_first.at"))
        return self._commit(self._distinct(old.unionByName(new)), version)

    def state(self, version: int | None = None) -> DataFrame:
        return self._open(version or self.latest(), "state")

    def summary(self, version: int | None = None) -> DataFrame:
        """One row per key, see :func:`cleaning.summarize_events`."""
        return self._open(version or self.latest(), "summary")
