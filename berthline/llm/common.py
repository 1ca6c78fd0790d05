"""Helpers shared by the operators: table reading, materialized intermediates, components."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path


ROWS_PER_BATCH = 2000
_BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only


def _bound_batches(spark: SparkSession) -> None:
    """Rows hold whole texts, so Arrow batches of Spark's default 10,000 rows would be large: the
    session's batch size is lowered to ROWS_PER_BATCH unless it has been changed already."""
    if spark.conf.get(_BATCH_CONF) == "10000":
        spark.conf.set(_BATCH_CONF, str(ROWS_PER_BATCH))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A whole input table."""
    _bound_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` as Parquet below the shared folder and read it back."""
    _bound_batches(df.sparkSession)
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.scratch = path
    return out


def discard(df: DataFrame) -> None:
    """Delete the files of a materialized table that nothing reads any more."""
    spark = df.sparkSession
    path = getattr(df, "scratch", None)
    if path is not None:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def slices(source: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of ``rows`` rows: bounds what a worker holds at a time.

    After each batch freed memory goes back to the system, since workers live on between tasks.
    """
    for b in source:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)
        del b
        return_memory()


def return_memory() -> None:
    """Give freed memory back to the system."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


class Forest:
    """Union-find over arbitrary hashable nodes; the root is the smallest node."""

    def __init__(self) -> None:
        self.up: dict = {}

    def find(self, x):
        up = self.up
        r = x
        while up.setdefault(r, r) != r:
            r = up[r]
        while up[x] != r:
            up[x], x = r, up[x]
        return r

    def union(self, a, b) -> bool:
        ra, rb = self.find(a), self.find(b)
        if ra == rb:
            return False
        if rb < ra:
            ra, rb = rb, ra
        self.up[rb] = ra
        return True


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace each batch of edges by the star forest that connects the same nodes."""
    for b in batches:
        f = Forest()
        for u, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            f.union(u, v)
        pairs = [(x, f.find(x)) for x in f.up]
        u = np.array([p[0] for p in pairs if p[0] != p[1]], dtype=np.int64)
        v = np.array([p[1] for p in pairs if p[0] != p[1]], dtype=np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges(u, v)`` (bigint): ``(node, root)``, root the smallest node.

    Alternating large-star and small-star rounds. Each round takes the minimum per node with a
    map-side partial aggregate and joins it back, so that a hub's edges are split by the
    skew-join rule instead of meeting in one task. Batches are first contracted to forests.
    Only the two counters of the stop test reach the driver. Nodes without edges don't appear.
    Raises when ``max_rounds`` (far above the logarithmic bound) is reached.
    """
    e = (edges.select(F.col("u").cast("bigint").alias("u"), F.col("v").cast("bigint").alias("v"))
         .where("u is not null and v is not null and u <> v"))
    e = materialize(e.mapInArrow(_contract, "u bigint, v bigint").distinct(), "cc")
    before = None
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        j = large.join(low, "u")
        small = j.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        last, e = e, materialize(small, "cc")
        discard(last)  # the new round stands on its own files
        now = e.agg(F.count(F.lit(1)).alias("n"),
                    F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if before == (now["n"], now["h"]):
            break
        before = (now["n"], now["h"])
    else:
        raise RuntimeError("components did not settle")
    roots = e.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
