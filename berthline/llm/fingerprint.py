"""Document fingerprints by content-defined chunking.

A gear hash over the last 32 bytes of UTF-8 text marks cut positions. Cutting is normalised:
below the normal chunk size a cut needs more hash bits than above it, and every chunk has a
smallest and a largest size. A cut depends on nearby bytes only, so an insertion or a shift
changes the chunks around it and no others. The fingerprint is the set of chunk digests with
chunk lengths; the containment of one document in another is the share of its length that
lies in chunks of the other.

Defined results: null texts are empty; the fingerprint of an empty text is the empty string,
and two empty texts contain each other (1.0), while an empty and a non-empty one don't (0.0);
equal texts have equal fingerprints; rows with equal ids follow each other by text, rows
without an id come last; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices
from .words import U64, _BASE, _BASE_INVERSE, _power_table, batches, mix

SMALLEST, NORMAL, LARGEST = 24, 64, 256
STRICT_BITS, LOOSE_BITS = 7, 5
_WINDOW = 32
_GEAR = (mix(np.arange(256, dtype=U64) + U64(0x5EED)) >> U64(32)).astype(np.uint32)
_BYTES = mix(np.arange(1, 257, dtype=U64) * U64(0x8CB92BA72F3D8DD7))
_GAP = b"\0" * _WINDOW
MAX_RANGES = 4096  # ranges of ids; their bounds and first rows are all that the driver sees

Print = tuple[np.ndarray, np.ndarray]  # sorted chunk digests, chunk lengths


def _gear(data: np.ndarray, gap: np.ndarray) -> np.ndarray:
    """Gear hash at each byte over the 32 bytes up to it (sum of table values, each shifted
    once per byte), all positions at once by doubling. ``gap`` bytes count as nothing."""
    h = _GEAR[data]
    h[gap] = 0
    step = 1
    while step < _WINDOW:
        h[step:] += h[:-step] << np.uint32(step)
        step *= 2
    return h


def fingerprints(texts: list[bytes]) -> list[Print]:
    """The fingerprint of each text."""
    out: list[Print] = []
    for _, group in batches(texts):
        blob = _GAP.join(group)
        data = np.frombuffer(blob, dtype=np.uint8)
        sizes = np.fromiter(map(len, group), dtype=np.int64, count=len(group))
        first = np.cumsum(sizes + _WINDOW) - sizes - _WINDOW
        gap = np.zeros(len(data), dtype=bool)
        for k in range(_WINDOW):
            at = first[1:] - 1 - k
            gap[at] = True
        h = _gear(data, gap) if len(data) else np.zeros(0, np.uint32)
        loose_at = np.flatnonzero(h >> np.uint32(32 - LOOSE_BITS) == 0) + 1
        strict = (loose_at[h[loose_at - 1] >> np.uint32(32 - STRICT_BITS) == 0]).tolist() + [1 << 62]
        loose = loose_at.tolist() + [1 << 62]
        starts: list[int] = []
        ends: list[int] = []
        count = []
        for p, n in zip(first.tolist(), sizes.tolist()):
            end, before = p + n, len(starts)
            while p < end:
                cut = strict[bisect_left(strict, p + SMALLEST)]
                if cut >= p + NORMAL:
                    cut = min(loose[bisect_left(loose, p + NORMAL)], p + LARGEST)
                if cut > end:
                    cut = end
                starts.append(p)
                ends.append(cut)
                p = cut
            count.append(len(starts) - before)
        a, b = np.array(starts, dtype=np.int64), np.array(ends, dtype=np.int64)
        sums = np.zeros(len(data) + 1, dtype=U64)
        np.cumsum(_BYTES[data] * _power_table(_BASE, len(data))[:len(data)], out=sums[1:])
        digest = mix((sums[b] - sums[a]) * _power_table(_BASE_INVERSE, len(data))[a] + (b - a).astype(U64))
        length, at = b - a, 0
        for c in count:
            d, k = np.unique(digest[at:at + c], return_index=True)
            out.append((d, length[at:at + c][k]))
            at += c
    return out


def containment(a: Print, b: Print) -> float:
    """Share of the length of ``a`` in chunks that ``b`` has too."""
    if not len(a[0]):
        return float(not len(b[0]))
    if not len(b[0]):
        return 0.0
    at = np.searchsorted(b[0], a[0])
    at[at == len(b[0])] = 0
    return float(a[1][b[0][at] == a[0]].sum() / a[1].sum())


def as_text(p: Print) -> str:
    """The fingerprint as text: 16 hex digits of digest and 2 of length - 1 for each chunk."""
    rows = np.empty((len(p[0]), 9), dtype=np.uint8)
    rows[:, :8] = p[0].astype(">u8").view(np.uint8).reshape(-1, 8)
    rows[:, 8] = p[1] - 1
    return rows.tobytes().hex()


_LAST = -(1 << 63)  # place of rows without an id


def _ranges(docs: DataFrame) -> tuple[np.ndarray, dict[int, int]]:
    """Bounds of id ranges of about equal counts, and for each range the first id (descending)
    of the rows that follow it: the next lower range's, or the very first after the last."""
    spark = docs.sparkSession
    n = min(MAX_RANGES, 8 * int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
    ids = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_LAST)).alias("s"))
    probs = [float(x) for x in np.arange(1, n) / n] or [0.5]
    got = ids.agg(F.percentile_approx("s", probs, 10 * n)).first()[0]
    bounds = np.unique(np.array(got or [], dtype=np.int64))

    def count(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in source:
            s = b.column(0).to_numpy()
            r = np.searchsorted(bounds, s, side="left")
            u = np.unique(r)
            top = [int(s[r == x].max()) for x in u]
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(top, pa.int64())], names=["r", "s"])

    heads = {x["r"]: x["m"] for x in ids.mapInArrow(count, "r bigint, s bigint").groupBy("r")
             .agg(F.max("s").alias("m")).collect()}
    order = sorted(heads, reverse=True)
    return bounds, {r: heads[order[(k + 1) % len(order)]] for k, r in enumerate(order)}


_RESULT = ("doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
           "edited_fingerprint string, near_edited double, near_next double")


def compare_with_edited(docs: DataFrame, part: int = 3) -> DataFrame:
    """Fingerprints of every text of ``docs(doc_id, text)`` and of its edited text, whose last
    ``floor(n_chars / part)`` code points are the first as many of the next document (by
    descending id, the first one after the last).

    Rows are dealt to id ranges, sorted there, and each is compared with its neighbour as the
    rows stream by. The first row of a range is also sent to the range before it.
    """
    bounds, follow = _ranges(docs)
    lead: dict[int, list[int]] = {}
    for r, s in follow.items():
        lead.setdefault(s, []).append(r)

    def deal(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leads = np.array(sorted(lead), dtype=np.int64)
        for b in source:
            s = b.column(2).to_numpy()
            r = np.searchsorted(bounds, s, side="left")
            rows, to = [np.arange(len(s))], [r]
            for k in np.flatnonzero(np.isin(s, leads)).tolist():
                rows.append(np.full(len(lead[int(s[k])]), k))
                to.append(np.array(lead[int(s[k])]))
            at = np.concatenate(rows)
            extra = np.arange(len(at)) >= len(s)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(to).astype(np.int64)), pa.array(extra), *(c.take(pa.array(at)) for c in b.columns)],
                names=["range", "extra", "doc_id", "text", "s"])

    def compare(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # range, id, text, fingerprint of the row that waits for its neighbour
        for b in slices(source):
            kinds, extra, ids, texts = (b.column(c).to_pylist() for c in ("range", "extra", "doc_id", "text"))
            texts = [t or "" for t in texts]
            prints = fingerprints([t.encode() for t in texts])
            pairs = []
            for r, x, i, t, p in zip(kinds, extra, ids, texts, prints):
                if held is not None and held[0] == r:
                    pairs.append((*held[1:], t, p))
                held = None if x else (r, i, t, p)
            edited = [t[:len(t) - len(t) // part] + u[:len(t) // part] for _, t, _, u, _ in pairs]
            data = [e.encode() for e in edited]
            after = fingerprints(data)
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in pairs], pa.int64()), pa.array([len(x[1]) for x in pairs], pa.int64()),
                 pa.array([hashlib.sha256(e).hexdigest() for e in data], pa.string()),
                 pa.array([as_text(x[2]) for x in pairs], pa.string()), pa.array(map(as_text, after), pa.string()),
                 pa.array([containment(x[2], e) for x, e in zip(pairs, after)], pa.float64()),
                 pa.array([containment(x[2], x[4]) for x in pairs], pa.float64())],
                names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                       "near_edited", "near_next"])

    place = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_LAST)).alias("s")
    dealt = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", place).mapInArrow(
        deal, "range bigint, extra boolean, doc_id bigint, text string, s bigint")
    return (dealt.repartition("range").sortWithinPartitions("range", "extra", F.desc("s"), "text")
            .mapInArrow(compare, _RESULT))
