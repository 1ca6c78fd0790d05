"""Near-duplicate join on word n-grams by vertical partitioning.

All n-grams have one global order, that of their 64-bit hashes. The order is cut into fragments
of equal width, so each document's sorted set falls into segments, one per fragment.

*Candidates.* Sets whose Jaccard similarity reaches the threshold differ in at most ``H``
n-grams, with ``H`` bounded by their sizes, so at most ``H`` of a document's segments differ
from the other one's. Segments have one order of strength that follows from their n-grams alone:
first by the number of rare ones, then by that of all, then by their key. Each document shows its
``H + 1`` strongest segments. The strongest segment that linked documents have in common has at
most ``H`` stronger ones in either, those that differ, so both show it: documents that share no
shown segment can't be linked. Weak segments, empty ones or those of one n-gram or of boilerplate,
would bring unlike documents together; more fragments than needed leave them room to stay unshown.
Sizes are graded so that both documents use the same cut. N-grams that many documents share
are found beforehand by a count sketch of fixed size over all documents. The sketch decides how
many documents meet, never which are linked. Documents that share segments form a candidate
group (connected components over one edge per document and segment, never over pairs).

*Overlaps.* Each document's set is sent once to its candidate group. There the partial overlaps
are counted fragment by fragment and summed per pair, and the sum decides exactly. Large
groups are cut into blocks, and every pair of blocks is a task of its own. A block pair reports
the links as a spanning forest, so what it writes is linear in its rows.

Exact copies are joined beforehand by a digest of the set, and only one of them is compared.

Defined results: null or blank texts have an empty set, size 0, and are linked with nothing;
texts of fewer words than the n-gram have one n-gram, the whole sequence; rows that share an
id are one document with several texts; rows with a null id are not linked and get a null
component; an empty table gives an empty table.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, materialize, slices
from .words import U64, Words, batches, mix

SPARE = 0.15          # fragments beyond H + 1, as a part of them, and two more
SKETCH_CELLS = 1 << 18  # cells of a part of the count sketch
SKETCH_PARTS = 16
GRADE = 1.5           # ratio of the size grades
FRAGMENTS = 16        # fragments in which the overlaps of a block pair are counted
BLOCK_GRAMS = 1_500_000
BLOCK_ROWS = 2048  # a pair of blocks takes counts of 2048 x 2048 pairs, about 130 MB in all
MEMBER_BYTES, BROADCAST_BYTES = 24, 32 << 20  # rows of candidate groups are broadcast up to this size
PAIRS = 1_000_000     # meetings of equal n-grams counted at a time

_WEIGHTS = (0x9FB21C651E98DF25, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
            0x27D4EB2F165667C5, 0xFF51AFD7ED558CCD, 0x2545F4914F6CDD1D, 0xA0761D6478BD642F)


def gram_sets(texts: list[bytes], n: int = 3, lower: bool = True) -> Iterator[np.ndarray]:
    """The sorted distinct n-gram hashes of each text."""
    for _, group in batches(texts):
        w = Words(group, lower=lower)
        h, first = w.hashes, w.first
        grams = np.zeros(len(h), dtype=U64)
        if len(h) >= n:
            s = grams[:len(h) - n + 1]
            for k in range(n):
                s += h[k:len(h) - n + 1 + k] * U64(_WEIGHTS[k % 8] + 2 * (k // 8))
            grams = mix(grams)
        for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
            if b - a >= n:
                yield np.unique(grams[a:b - n + 1])
            elif b > a:
                short = np.array([b - a], dtype=U64)
                for k in range(a, b):
                    short = mix(short * U64(_WEIGHTS[0]) + h[k:k + 1])
                yield short
            else:
                yield np.zeros(0, dtype=U64)


class Grades:
    """Size grades of the threshold ``num / den`` and the cut of each."""

    def __init__(self, num: int, den: int) -> None:
        self.num, self.den = num, den
        self.caps: list[int] = []
        cap = 0
        while self.differences(cap + 1) == 0:
            cap += 1
        self.caps.append(cap)  # up to here only equal sets are linked

    def differences(self, cap: int) -> int:
        """Most n-grams in which linked sets differ when the smaller has ``cap`` at most."""
        return (self.den - self.num) * (cap + cap * self.den // self.num) // (self.den + self.num)

    def of(self, size: int) -> list[int]:
        """The grades in which a set of ``size`` shows its segments."""
        while self.caps[-1] < size:
            self.caps.append(max(int(self.caps[-1] * GRADE), self.caps[-1] + 1))
        g = int(np.searchsorted(self.caps, size))
        out = [g] if g else []
        while g > 1 and size * self.num <= self.caps[g - 1] * self.den:
            g -= 1
            out.append(g)
        return out

    def parts(self, grade: int) -> int:
        """Number of fragments of a grade."""
        least = self.differences(self.caps[grade]) + 1
        return least + int(SPARE * least) + 2

    @staticmethod
    def _segments(grams: np.ndarray, rare: np.ndarray, parts: int, space: int) -> tuple[np.ndarray, np.ndarray]:
        """Key of each segment, and its strength: its rare n-grams first, then all of them."""
        sums = np.zeros(len(grams) + 1, dtype=U64)
        np.cumsum(mix(grams ^ U64(0x6A09E667F3BCC909)), out=sums[1:])
        weight = np.zeros(len(grams) + 1, dtype=np.int64)
        np.cumsum(rare * (1 << 32) + 1, out=weight[1:])
        bounds = np.arange(1, parts, dtype=U64) * U64((1 << 64) // parts + 1)
        at = np.concatenate([[0], np.searchsorted(grams, bounds), [len(grams)]])
        key = mix(sums[at[1:]] - sums[at[:-1]] + np.arange(parts, dtype=U64) * U64(0x9FB21C651E98DF25) + U64(space))
        return key, weight[at[1:]] - weight[at[:-1]]

    def keys(self, grams: np.ndarray, rare: np.ndarray) -> np.ndarray:
        """Keys of the segments that a sorted set of n-gram hashes shows; ``rare`` marks those not frequent."""
        out, size = [], len(grams)
        for k, g in enumerate(self.of(size) if size else ()):
            key, strength = self._segments(grams, rare, self.parts(g), g)
            partner = self.caps[g] if k else size * self.den // self.num  # the largest set that may be linked here
            most = (self.den - self.num) * (size + partner) // (self.den + self.num)
            out.append(key[np.lexsort((key, strength))[-1 - most:]])
        return np.concatenate(out) if out else np.zeros(0, dtype=U64)


def _cells(grams: np.ndarray) -> np.ndarray:
    return (mix(grams ^ U64(0xBB67AE8584CAA73B)) % U64(SKETCH_CELLS * SKETCH_PARTS)).astype(np.int64)


def _packed(cells: np.ndarray) -> bytes:
    return zlib.compress(cells.astype(np.min_scalar_type(int(cells.max()))).tobytes(), 1)


def _unpacked(data: bytes) -> np.ndarray:
    data = zlib.decompress(data)
    return np.frombuffer(data, dtype=f"u{len(data) // SKETCH_CELLS}").astype(np.int64)


def count_grams(docs: DataFrame, n: int) -> DataFrame:
    """``doc_id, n_shingles, digest`` of each row of ``docs(doc_id, text)``; besides, rows with a
    ``part`` hold what each task has counted for the sketch, in ``SKETCH_PARTS`` compressed parts."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(SKETCH_CELLS * SKETCH_PARTS, dtype=np.int64)
        for b in slices(source):
            got = list(gram_sets([(t or "").encode() for t in b.column(1).to_pylist()], n))
            if got:
                cells += np.bincount(_cells(np.concatenate(got)), minlength=len(cells))
            digests = [blake2b(g.tobytes(), digest_size=16).digest() if len(g) else None for g in got]
            none = pa.nulls(b.num_rows, pa.binary())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(g) for g in got], pa.int64()), pa.array(digests, pa.binary()),
                 pa.nulls(b.num_rows, pa.int32()), none], names=names)
        if cells.any():
            none = pa.nulls(SKETCH_PARTS, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [none, none, pa.nulls(SKETCH_PARTS, pa.binary()), pa.array(range(SKETCH_PARTS), pa.int32()),
                 pa.array([_packed(x) for x in np.split(cells, SKETCH_PARTS)], pa.binary())], names=names)

    names = ["doc_id", "n_shingles", "digest", "part", "data"]
    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
        run, "doc_id bigint, n_shingles bigint, digest binary, part int, data binary")


def frequent_grams(counted: DataFrame) -> np.ndarray:
    """Cells of the count sketch that hold clearly more n-grams than the average one.

    The result has ``SKETCH_CELLS * SKETCH_PARTS`` bits, however large the table.
    """
    def add(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in slices(source, 20):
            for k, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                total[k] = total.get(k, 0) + _unpacked(x)
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()),
                                          pa.array([_packed(x) for x in total.values()], pa.binary())],
                                         names=["part", "data"])

    rows = (counted.where("part is not null").select("part", "data").repartition(SKETCH_PARTS, "part")
            .mapInArrow(add, "part int, data binary").collect())
    cells = np.zeros((SKETCH_PARTS, SKETCH_CELLS), dtype=np.int64)
    for r in rows:
        cells[r["part"]] = _unpacked(r["data"])
    usual = float(np.median(cells))
    return np.packbits(cells.ravel() > usual + 2 * np.sqrt(usual) + 2)


def segment_keys(docs: DataFrame, frequent: np.ndarray, num: int, den: int, n: int) -> DataFrame:
    """``doc_id, keys`` of each row of ``docs(doc_id, text)`` with an id and words."""
    marks = docs.sparkSession.sparkContext.broadcast(frequent)  # 512 KB

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grades, often = Grades(num, den), np.unpackbits(marks.value).astype(bool)
        for b in slices(source, 2000):
            keys = [grades.keys(g, ~often[_cells(g)])
                    for g in gram_sets([(t or "").encode() for t in b.column(1).to_pylist()], n)]
            at = np.concatenate([[0], np.cumsum([len(k) for k in keys])]).astype(np.int32)
            flat = np.concatenate(keys) if keys else np.zeros(0, dtype=U64)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.ListArray.from_arrays(pa.array(at), pa.array(flat.view(np.int64)))],
                names=["doc_id", "keys"])

    return (docs.select(F.col("doc_id").cast("bigint"), "text").where("doc_id is not null and text is not null")
            .mapInArrow(run, "doc_id bigint, keys array<bigint>"))


def _meet_locally(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per batch: one row (key, node) for each key, and an edge for every further row of it."""
    for b in slices(source, 3000):
        ids, col = b.column(0).to_numpy(zero_copy_only=False), b.column(1)
        at = col.offsets.to_numpy().astype(np.int64)
        node, key = np.repeat(ids, np.diff(at)), col.flatten().to_numpy(zero_copy_only=False)
        order = np.lexsort((node, key))
        node, key = node[order], key[order]
        head = np.ones(len(key), dtype=bool)
        head[1:] = key[1:] != key[:-1]
        pivot = node[np.maximum.accumulate(np.where(head, np.arange(len(key)), 0))] if len(key) else node
        far = ~head & (node != pivot)
        edges = np.unique(np.stack([node[far], pivot[far]], axis=1), axis=0)
        k = np.concatenate([key[head], edges[:, 0]])
        u = np.concatenate([node[head], edges[:, 0]])
        v = pa.array(np.concatenate([np.zeros(int(head.sum()), np.int64), edges[:, 1]]),
                     mask=np.concatenate([np.ones(int(head.sum()), bool), np.zeros(len(edges), bool)]))
        yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(u), v], names=["key", "u", "v"])


def _meet(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key and node -> an edge from each row to the first of its key."""
    key0 = node0 = None
    for b in slices(source, 100_000):
        key, u = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        ready = b.column(2).is_valid().to_numpy(zero_copy_only=False)
        v = b.column(2).fill_null(0).to_numpy(zero_copy_only=False)
        e1, open_ = (u[ready], v[ready]), ~ready
        key, u = key[open_], u[open_]
        if len(key):
            head = np.ones(len(key), dtype=bool)
            head[1:] = key[1:] != key[:-1]
            first = np.maximum.accumulate(np.where(head, np.arange(len(key)), 0))
            pivot = u[first]
            if key0 is not None and key[0] == key0:
                pivot[first == 0] = node0
            key0, node0 = key[-1], pivot[-1]
            far = pivot != u
            e2 = (u[far], pivot[far])
        else:
            e2 = (u, u)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([e1[0], e2[0]])),
                                          pa.array(np.concatenate([e1[1], e2[1]]))], names=["u", "v"])


def candidate_edges(keys: DataFrame) -> DataFrame:
    """``(u, v)``: a document and another one with an equal segment; one edge per row and key.

    Rows of one key are first combined inside each batch, so that a key common to very many
    documents sends few rows to the shuffle.
    """
    local = (keys.where("size(keys) > 0")
             .mapInArrow(_meet_locally, "key bigint, u bigint, v bigint"))
    return (local.repartition("key").sortWithinPartitions("key", "u")
            .mapInArrow(_meet, "u bigint, v bigint"))


def _links(a: list[tuple], b: list[tuple] | None, num: int, den: int) -> list[tuple[int, int]]:
    """Links among ``a`` (``b`` None) or between ``a`` and ``b``, as a spanning forest.

    Rows are (node, sorted gram hashes). Partial overlaps are counted in each fragment of the
    global order and summed per pair.
    """
    ya = b if b is not None else a
    shape = (len(a), len(ya))
    total = np.zeros(shape[0] * shape[1], dtype=np.int32)
    ga = np.concatenate([x[1] for x in a])
    ra = np.repeat(np.arange(len(a)), [len(x[1]) for x in a])
    gb = np.concatenate([x[1] for x in ya])
    rb = np.repeat(np.arange(len(ya)), [len(x[1]) for x in ya])
    oa, ob = np.argsort(ga, kind="stable"), np.argsort(gb, kind="stable")
    ga, ra, gb, rb = ga[oa], ra[oa], gb[ob], rb[ob]
    cuts = np.arange(1, FRAGMENTS, dtype=U64) * U64((1 << 64) // FRAGMENTS)
    ca = np.concatenate([[0], np.searchsorted(ga, cuts), [len(ga)]]).tolist()
    cb = np.concatenate([[0], np.searchsorted(gb, cuts), [len(gb)]]).tolist()
    for i, j, k, m in zip(ca, ca[1:], cb, cb[1:]):
        if j == i or m == k:
            continue
        lo, hi = np.searchsorted(gb[k:m], ga[i:j]), np.searchsorted(gb[k:m], ga[i:j], side="right")
        n = hi - lo
        at = np.cumsum(n) - n
        cuts_at = np.unique(np.searchsorted(at, np.arange(0, int(n.sum()) + PAIRS, PAIRS))).tolist()
        for x, y in zip([0, *cuts_at], [*cuts_at, len(n)]):  # one n-gram of one row at least
            if y > x:
                c = n[x:y]
                left = np.repeat(ra[i + x:i + y], c)
                step = np.arange(len(left)) - np.repeat(np.cumsum(c) - c, c)
                right = rb[k:m][np.repeat(lo[x:y], c) + step]
                np.add(total, np.bincount(left * shape[1] + right, minlength=len(total)), out=total, casting="unsafe")
    total = total.reshape(shape).astype(np.int64)
    sa = np.array([len(x[1]) for x in a])[:, None]
    sb = np.array([len(x[1]) for x in ya])[None, :]
    linked = den * total >= num * (sa + sb - total)
    if b is None:
        linked = np.triu(linked, 1)
    nodes = [x[0] for x in a] + ([x[0] for x in b] if b is not None else [])
    root, out = np.arange(len(nodes)), []
    for i in range(len(a)):  # a link is kept where it joins two parts: at most one per row
        near = np.flatnonzero(linked[i]) + (len(a) if b is not None else 0)
        while len(near := near[root[near] != root[i]]):
            j = int(near[0])
            if nodes[i] != nodes[j]:
                out.append((nodes[i], nodes[j]))
            root[root == root[j]] = root[i]
    return out


def _block_links(num: int, den: int):
    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, rows = None, []

        def done() -> list[tuple[int, int]]:
            if at is None:
                return []
            lo, hi = at[1:]
            if lo == hi:
                return _links([r[1:] for r in rows], None, num, den) if len(rows) > 1 else []
            a, b = ([r[1:] for r in rows if r[0] == x] for x in (lo, hi))
            return _links(a, b, num, den) if a and b else []

        for batch in slices(source, 500):
            found: list[tuple[int, int]] = []
            cols = [batch.column(c).to_pylist() for c in ("grp", "lo", "hi", "blk", "node", "grams")]
            for g, lo, hi, blk, node, grams in zip(*cols):
                if (g, lo, hi) != at:
                    found += done()
                    at, rows = (g, lo, hi), []
                rows.append((blk, node, np.frombuffer(grams, dtype=U64)))
            yield _edges(found)
        yield _edges(done())

    return run


def _edges(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.int64()),
                                       pa.array([p[1] for p in pairs], pa.int64())], names=["u", "v"])


def _with_grams(n: int):
    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(source):
            sets = [g.tobytes() for g in gram_sets([(t or "").encode() for t in b.column(3).to_pylist()], n)]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(sets, pa.binary())],
                                             names=["grp", "node", "nb", "grams"])

    return run


def near_duplicates(docs: DataFrame, num: int = 90, den: int = 100, n: int = 3) -> DataFrame:
    """Near-duplicate classes of ``docs(doc_id, text)``: ``doc_id, n_shingles, component_id``.

    Two documents are linked when ``den * |A and B| >= num * |A or B|`` for their sets of word
    n-grams (A-Z in lower case); ``component_id`` is the smallest id reachable by links.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    counted = materialize(count_grams(docs, n), "grams")
    grams = counted.where("part is null").select("doc_id", "n_shingles", "digest")
    known = grams.where("doc_id is not null and digest is not null")
    first = known.groupBy("digest").agg(F.min("doc_id").alias("rep"))
    copies = (known.select("doc_id", "digest").join(first, "digest").where("doc_id <> rep")
              .select(F.col("doc_id").alias("u"), F.col("rep").alias("v")))

    groups = components(candidate_edges(segment_keys(docs, frequent_grams(counted), num, den, n)))
    sizes = known.select("doc_id", "digest", "n_shingles").distinct()
    # one row per distinct text of a candidate group
    members = (groups.join(sizes, groups.node == sizes.doc_id).join(first, "digest").where("doc_id = rep")
               .select("node", F.col("root").alias("grp"), "n_shingles", "digest"))
    members = materialize(members, "members")
    blocks = (members.groupBy("grp").agg(F.sum("n_shingles").alias("g"), F.count(F.lit(1)).alias("c"))
              .where("c > 1")
              .select("grp", F.greatest(F.ceil(F.col("g") / BLOCK_GRAMS), F.ceil(F.col("c") / BLOCK_ROWS))
                      .cast("int").alias("nb")))
    compared = members.join(blocks, "grp").select("grp", "node", "nb").distinct()
    if members.count() * MEMBER_BYTES <= BROADCAST_BYTES:  # measured; else the texts are shuffled to their members
        compared = F.broadcast(compared)
    texts = docs.join(compared, docs.doc_id == compared.node).select("grp", "node", "nb", "text")
    sets = texts.mapInArrow(_with_grams(n), "grp bigint, node bigint, nb int, grams binary")
    placed = (sets.withColumn("blk", F.pmod(F.xxhash64("node"), F.col("nb")).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
              .select("grp", F.least("blk", "other").alias("lo"), F.greatest("blk", "other").alias("hi"),
                      "blk", "node", "grams"))
    links = (placed.repartition("grp", "lo", "hi").sortWithinPartitions("grp", "lo", "hi")
             .mapInArrow(_block_links(num, den), "u bigint, v bigint"))
    linked = components(links.unionByName(copies))
    return (grams.select("doc_id", "n_shingles").join(linked, grams.doc_id == linked.node, "left")
            .select("doc_id", "n_shingles", F.coalesce("root", "doc_id").alias("component_id")))
