"""Near-duplicate vectors by cross-polytope hashing.

Vectors are rotated by sign flips and fast Hadamard transforms; the hash of a rotation is the
largest coordinate with its sign, and a table joins several. Each vector also goes to the
buckets of its next largest coordinates (multiprobe). Large inputs join more rotations in a
table and get as many more tables as keep the share of missed pairs at the threshold below
``MISSED``, measured on drawn pairs of that cosine and dimension. Rows that meet in a bucket are compared
exactly, by cosine in double precision, block by block as matrix products.

Equal vectors are joined beforehand and one of them is compared. A pair that meets in several
buckets counts in the first one only, which both rows can tell from their own bucket lists.
So every block reports sums per row and a spanning forest, never its pairs. Large buckets are
cut into blocks, and every pair of blocks is a task of its own.

Defined results: only vectors with equal, non-null labels and equal dimension are compared;
vectors that are null, empty, zero or hold null or non-finite components, and rows without an
id, have no links and are their own component; repeated rows count once; an empty table gives
an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Forest, components, materialize, slices

TABLES = 8        # least number of tables
MISSED = 1e-4     # wanted share of pairs at the threshold that meet in no table
PROBES = 2        # further buckets of each table
BLOCK_ROWS = 1024
BUCKET_ROWS = 64  # wanted rows per bucket; decides how many rotations a table joins
SEED = 20


def _hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Hadamard transform of the rows (width a power of two)."""
    n, h = x.shape[1], 1
    while h < n:
        y = x.reshape(len(x), -1, 2, h)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(len(x), n)
        h *= 2
    return x


def buckets(x: np.ndarray, tables: int, joined: int, probes: int) -> np.ndarray:
    """Bucket numbers (rows x tables * (1 + probes)) of unit vectors."""
    width = 1 << max(1, (x.shape[1] - 1).bit_length())
    base = np.zeros((len(x), width))
    base[:, :x.shape[1]] = x
    each = np.arange(len(x))
    out = []
    for t in range(tables):
        code = np.full(len(x), t, dtype=np.int64)
        best_gap = np.full((probes, len(x)), np.inf)
        other = np.zeros((probes, len(x)), dtype=np.int64)
        for j in range(joined):
            sign = np.random.RandomState(SEED + 1009 * t + j).randint(0, 2, (3, width)) * 2 - 1
            y = base
            for s in sign:
                y = _hadamard(y * s) / np.sqrt(width)
            size = np.abs(y)
            top = np.argsort(-size, axis=1, kind="stable")[:, :probes + 1]
            symbol = top * 2 + (y[each[:, None], top] < 0)
            scale = (2 * width) ** j * tables
            code += symbol[:, 0] * scale
            for p in range(1, min(probes + 1, top.shape[1])):
                gap = size[each, top[:, 0]] - size[each, top[:, p]]
                delta = (symbol[:, p] - symbol[:, 0]) * scale
                for q in range(probes):  # keep the probes with the smallest gaps
                    better = gap < best_gap[q]
                    gap, best_gap[q] = np.where(better, best_gap[q], gap), np.where(better, gap, best_gap[q])
                    delta, other[q] = np.where(better, other[q], delta), np.where(better, delta, other[q])
        out += [code, *(code + o for o in other)]
    return np.stack(out, axis=1)


def tables_for(joined: int, dim: int, threshold: float, probes: int = PROBES) -> int:
    """Tables by which at most about ``MISSED`` of the pairs at the threshold never meet."""
    rng = np.random.RandomState(SEED)
    x, y = rng.normal(size=(2, 500, max(dim, 2)))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y -= (x * y).sum(axis=1, keepdims=True) * x
    y = threshold * x + np.sqrt(max(0.0, 1 - threshold ** 2)) * y / np.linalg.norm(y, axis=1, keepdims=True)
    a, b = (buckets(z, TABLES, joined, probes).reshape(len(x), TABLES, -1) for z in (x, y))
    met = (a[..., :, None] == b[..., None, :]).any(axis=(2, 3)).mean()
    return max(TABLES, int(np.ceil(np.log(MISSED) / np.log1p(-np.clip(met, 1e-2, 0.999)))))


def _usable(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors that can be compared: ``vec_id, label, dim, digest, v`` (v in single precision where that is exact)."""
    for b in slices(source, 2000):
        rows = []
        for i, label, v in zip(*(b.column(k).to_pylist() for k in range(3))):
            if i is None or label is None or not v or None in v:
                continue
            x = np.array(v, dtype=np.float64)
            if not np.isfinite(x).all() or not x.any():
                continue
            data = (x + 0.0).tobytes()
            single = x.astype(np.float32)
            held = (single + np.float32(0)).tobytes() if (single == x).all() else data  # half the bytes, the same numbers
            rows.append((i, label, len(v), blake2b(data, digest_size=16).digest(), held))
        cols = list(zip(*rows)) or [()] * 5
        kinds = (pa.int64(), pa.string(), pa.int32(), pa.binary(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                         names=["vec_id", "label", "dim", "digest", "v"])


def _unit(data: list[bytes], dim: int) -> np.ndarray:
    """Unit vectors in double precision."""
    x = np.empty((len(data), dim))
    wide = np.array([len(d) == 8 * dim for d in data])
    for part, kind in ((wide, np.float64), (~wide, np.float32)):
        if part.any():
            x[part] = np.frombuffer(b"".join([data[k] for k in np.flatnonzero(part)]), dtype=kind).reshape(-1, dim)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # against overflow
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _hashed(tables: int, joined: int, probes: int):
    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(source, 2000):
            dims = b.column("dim").to_numpy()
            for d in np.unique(dims).tolist():
                part = b.take(pa.array(np.flatnonzero(dims == d)))
                codes = buckets(_unit(part.column("v").to_pylist(), d), tables, joined, probes)
                at = np.arange(len(codes) + 1, dtype=np.int32) * codes.shape[1]
                lists = pa.ListArray.from_arrays(pa.array(at), pa.array(codes.ravel()))
                yield pa.RecordBatch.from_arrays([*part.columns, lists], names=[*part.schema.names, "codes"])

    return run


def _first_shared(codes: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least code that rows ``i`` and ``j`` share; ``codes`` is rows x tables x codes of a table (codes of
    different tables differ)."""
    out = np.empty(len(i), dtype=np.int64)
    for at in range(0, len(i), 8192):
        a, b = codes[i[at:at + 8192]], codes[j[at:at + 8192]]
        both = (a[..., :, None] == b[..., None, :]).any(axis=3)
        out[at:at + 8192] = np.where(both, a, np.iinfo(np.int64).max).min(axis=(1, 2))
    return out


def _compare(threshold: float, tables: int):
    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, rows = None, []

        def done() -> list[tuple]:
            if at is None or len(rows) < 2:
                return []
            dim, code, lo, hi = at[1:]
            x = _unit([r[3] for r in rows], dim)
            blk, rep, many = np.array([r[0] for r in rows]), [r[1] for r in rows], np.array([r[2] for r in rows])
            a, b = np.flatnonzero(blk == lo), np.flatnonzero(blk == hi)
            near = np.argwhere(x[a] @ x[b].T >= threshold - 1e-9)
            i, j = a[near[:, 0]], b[near[:, 1]]
            if lo == hi:
                i, j = i[i < j], j[i < j]
            exact = (x[i] * x[j]).sum(axis=1) >= threshold
            i, j = i[exact], j[exact]
            codes = np.array([r[4] for r in rows], dtype=np.int64).reshape(len(rows), tables, -1)
            own = _first_shared(codes, i, j) == code
            i, j = i[own], j[own]
            n = np.zeros(len(rows), dtype=np.int64)
            np.add.at(n, i, many[j])
            np.add.at(n, j, many[i])
            forest = Forest()
            edges = {}
            for p, q in zip(i.tolist(), j.tolist()):
                if forest.union(rep[p], rep[q]):
                    edges.setdefault(p, []).append(rep[q])
            return [(rep[k], int(n[k]) if f == 0 else 0, e)
                    for k in range(len(rows)) if n[k] for f, e in enumerate(edges.get(k) or [None])]

        for b in slices(source, 5000):
            found: list[tuple] = []
            cols = [b.column(c).to_pylist() for c in ("label", "dim", "code", "lo", "hi", "blk", "rep", "many", "v", "codes")]
            for label, dim, code, lo, hi, *row in zip(*cols):
                if (label, dim, code, lo, hi) != at:
                    found += done()
                    at, rows = (label, dim, code, lo, hi), []
                rows.append(row)
            yield _out(found)
        yield _out(done())

    return run


def _out(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [()] * 3
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["rep", "n", "other"])


def near_vectors(vectors: DataFrame, threshold: float = 0.93, tables: int | None = None,
                 probes: int = PROBES, joined: int | None = None) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for ``vectors(vec_id, embedding, label)``."""
    base = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("string").alias("label"),
                          F.col("embedding").cast("array<double>").alias("embedding"))
    usable = base.mapInArrow(_usable, "vec_id bigint, label string, dim int, digest binary, v binary")
    usable = materialize(usable.dropDuplicates(["vec_id", "label", "digest"]), "vectors")
    classes = (usable.groupBy("label", "dim", "digest")
               .agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("many"), F.any_value("v").alias("v")))
    # one row per dimension: the distinct vectors of its largest label
    groups = [(r["dim"], r["n"]) for r in classes.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("n"))
              .groupBy("dim").agg(F.max("n").alias("n")).collect()]
    if joined is None:
        joined = max([1, *(round(np.log(max(n, 2) / BUCKET_ROWS) / np.log(2 << max(1, (d - 1).bit_length())) + 0.5)
                           for d, n in groups)])
    if tables is None:
        tables = max([TABLES, *(tables_for(joined, d, threshold, probes) for d, _ in groups)])
    coded = materialize(classes.mapInArrow(
        _hashed(tables, joined, probes),
        "label string, dim int, digest binary, rep bigint, many bigint, v binary, codes array<bigint>"), "hashed")
    placed = coded.withColumn("code", F.explode(F.array_distinct("codes")))
    sizes = (placed.groupBy("label", "dim", "code").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
             .select("label", "dim", "code", F.ceil(F.col("c") / BLOCK_ROWS).cast("int").alias("nb")))
    blocks = (placed.join(sizes, ["label", "dim", "code"])
              .withColumn("blk", F.pmod(F.xxhash64("rep"), F.col("nb")).cast("int"))
              .withColumn("o", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
              .select("label", "dim", "code", F.least("blk", "o").alias("lo"), F.greatest("blk", "o").alias("hi"),
                      "blk", "rep", "many", "v", "codes"))
    keys = ["label", "dim", "code", "lo", "hi"]
    found = materialize(blocks.repartition(*keys).sortWithinPartitions(*keys)
                        .mapInArrow(_compare(threshold, tables), "rep bigint, n bigint, other bigint"), "links")
    counts = found.groupBy("rep").agg(F.sum("n").alias("n"))
    members = (usable.join(classes.select("label", "digest", "rep", "many"), ["label", "digest"])
               .join(counts, "rep", "left")
               .select("vec_id", "rep", (F.col("many") - 1 + F.coalesce("n", F.lit(0))).alias("links")))
    members = materialize(members, "members")
    edges = (found.where("other is not null").select(F.col("rep").alias("u"), F.col("other").alias("v"))
             .unionByName(members.where("vec_id <> rep").select(F.col("vec_id").alias("u"), F.col("rep").alias("v"))))
    roots = components(edges)
    links = members.groupBy("vec_id").agg(F.sum("links").alias("links"))
    out = (base.select("vec_id").join(links, "vec_id", "left")
           .join(roots.withColumnRenamed("node", "vec_id"), "vec_id", "left"))
    component = F.coalesce("root", "vec_id")
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("bigint").alias("n_links"),
                      component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"))
