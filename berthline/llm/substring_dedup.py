"""Removal of repeated passages by a relative Lempel-Ziv parse over content-defined blocks.

The reference is the whole collection. A window is ``window`` consecutive words of one document. Each
window has an anchor: the leftmost of its ``gram``-word sequences with the smallest hash. Windows with
equal words have equal anchors at equal places, so the consecutive windows of one anchor form a
block, about half a window wider than the window, which any copy of the passage is cut into likewise.

*Index.* All blocks of all documents are indexed by anchor and content. Where an anchor has one
content only and occurs twice, every block gets a source: another place with the same words.
*Factor boundaries.* Where an anchor occurs with different contents a factor may end inside
the block; only there single windows are looked up, each with its source, which makes the ends exact.
*Parse.* Each document then walks its matched blocks and windows from left to right and extends the
present factor as long as the next one continues at the same place of the same source; otherwise a
new factor starts. A factor is at least one window long; the words that factors cover are
the duplicate spans. Text between them has no window that occurs elsewhere.

A block has one source, not all, so a factor may end where a longer one of another source would not; what
the factors cover does not depend on the choice. Factors of two sources overlap by less than a window.

Both lookups need rows whose key occurs twice. Rows are first combined within a batch, so a
passage that very many documents share sends at most one row per batch and key to the shuffle.
The anchors that need single windows are shipped as a bit set of bounded size; false hits there
cost work, not correctness.

Defined results: words are runs of bytes other than blank and 9 to 13; null texts have no
words; every copy of a repeated passage goes, the first included; repeated rows are
separate documents; rows may share ids or have none; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, slices
from .words import U64, Words, batches, mix

WINDOW = 35
GRAM = 8
BATCH_ROWS = 3000  # documents combined at a time
BITS = 27  # largest bit set of anchors: 2 ** 27 bits, 16 MB
_BASE = U64(0x369DEA0F31A53F85)

UNDECIDED, REPEATED, MIXED, FOUND = 0, 1, 2, 3


def _poly(h: np.ndarray, n: int) -> np.ndarray:
    """Polynomial hash of every ``n`` consecutive values, by doubling."""
    out, width, block, power = None, 0, h, _BASE
    one = np.array([_BASE], dtype=U64)
    step, size = one, 1
    while True:
        if n & size:
            if out is None:
                out, width = block, size
            else:  # what is held so far goes behind the larger block
                k = len(block) - width
                tail = out[size:size + len(h) - size - width + 1]
                shift = np.array([1], dtype=U64)
                for _ in range(width):
                    shift = shift * one
                out = block[:len(tail)] * shift + tail
                width += size
        if size * 2 > n:
            return out[:max(0, len(h) - n + 1)]
        block = block[:-size] * step + block[size:] if len(block) > size else block[:0]
        step = step * step
        size *= 2


def _leftmost_smallest(v: np.ndarray, n: int) -> np.ndarray:
    """Position of the smallest of every ``n`` consecutive values, the leftmost of equal ones."""
    at = np.arange(len(v))
    width = 1
    while width < n:
        step = min(width, n - width)
        right = v[step:] < v[:-step]
        at = np.where(right, at[step:], at[:-step])
        v = np.minimum(v[step:], v[:-step])
        width += step
    return at


class Blocks:
    """Blocks of all texts of a batch: ``text``, ``lo`` (first window in the text), ``n`` windows,
    ``key`` (anchor), ``ctx`` (content); ``windows(i)`` are the window hashes of block ``i``."""

    def __init__(self, texts: list[bytes], window: int = WINDOW, gram: int = GRAM) -> None:
        w = Words(texts)
        h, first = w.hashes, w.first
        sizes = np.diff(first)
        none = np.zeros(0, dtype=np.int64)
        self.text = self.lo = self.n = none
        self.key = self.ctx = none.astype(U64)
        count = np.maximum(sizes - window + 1, 0)
        if not count.sum():
            return
        start = np.repeat(first[:-1], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        grams = mix(_poly(h, gram))
        anchor = _leftmost_smallest(grams, window - gram + 1)[start]
        self.hashes = mix(_poly(h, window))[start]
        text = np.repeat(np.arange(len(texts)), count)
        head = np.ones(len(start), dtype=bool)
        head[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
        at = np.flatnonzero(head)
        self.at, self.n = at, np.diff(np.append(at, len(start)))
        self.text, self.lo, self.key = text[at], (start - first[text])[at], grams[anchor[at]]
        sums = np.zeros(len(start) + 1, dtype=U64)
        np.cumsum(mix(self.hashes * U64(0xD6E8FEB86659FD93) + (anchor - start).astype(U64)), out=sums[1:])
        self.ctx = mix(sums[at + self.n] - sums[at] + self.n.astype(U64))


def _blocks(batch: pa.RecordBatch, window: int, gram: int) -> Iterator[tuple[Blocks, np.ndarray]]:
    """Blocks of the batch's texts (third column), with the batch row of each text."""
    texts = [(t or "").encode() for t in batch.column(2).to_pylist()]
    for first, group in batches(texts):
        yield Blocks(group, window, gram), first


def _groups(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that sorts by ``keys`` and the group number along it."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), dtype=np.int64)
    for k in keys:
        s = k[order]
        new[1:] |= s[1:] != s[:-1]
    return order, np.cumsum(new)


_TYPES = {"key": "bigint", "ctx": "bigint", "state": "int", "row_id": "bigint", "row_key": "bigint", "lo": "int", "n": "int",
          "line": "int", "src_id": "bigint", "src_lo": "int"}


def _own(named: bool) -> list[str]:
    """A range: its row (by a hash of id and text; ``named`` rows also by id), first window and number of windows."""
    return ["row_id", "row_key", "lo", "n"] if named else ["row_key", "lo", "n"]


def _source(named: bool) -> list[str]:
    """A source as the line it lies on, a hash of its row and of its place less the range's own: ranges that
    go on at the same place of one source share it. ``named`` sources also have id and place."""
    return ["line", "src_id", "src_lo"] if named else ["line"]


def _schema(*columns: str) -> str:
    return ", ".join(f"{c} {_TYPES[c]}" for c in columns)


def _line(key: np.ndarray, src_lo: np.ndarray, lo: np.ndarray) -> np.ndarray:
    """32 bits are enough: they only tell whether neighbouring ranges belong to one factor."""
    return (mix(key.view(U64) + mix((src_lo.astype(np.int64) - lo).view(U64))) >> U64(32)).astype(np.uint32).view(np.int32)


def _other(group: np.ndarray) -> np.ndarray:
    """For rows sorted by group: a row of the group that is another one, the first or else the second."""
    first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if len(group) else group
    at = np.repeat(first, np.diff(np.append(first, len(group))))
    return np.where(at == np.arange(len(group)), np.minimum(at + 1, len(group) - 1), at)


def _sources(b: pa.RecordBatch, without: int, rows: np.ndarray, src_lo: np.ndarray, lo: np.ndarray, named: bool) -> list[pa.Array]:
    """Source columns of a batch's output: none for the first ``without`` rows, then those of ranges at ``lo`` with their
    sources, rows of the batch and places there."""
    key = b.column(1).take(pa.array(rows)).to_numpy(zero_copy_only=False)
    out = [pa.concat_arrays([pa.nulls(without, pa.int32()), pa.array(_line(key, src_lo, lo), pa.int32())])]
    if named:
        out += [pa.concat_arrays([pa.nulls(without, pa.int64()), b.column(0).take(pa.array(rows))]),
                pa.concat_arrays([pa.nulls(without, pa.int32()), pa.array(src_lo.astype(np.int32))])]
    return out


def _index_locally(window: int, gram: int, named: bool):
    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(source, BATCH_ROWS):
            got = [(x, first) for x, first in _blocks(b, window, gram) if len(x.key)]
            if not got:
                continue
            key, ctx = (np.concatenate([getattr(x, c) for x, _ in got]) for c in ("key", "ctx"))
            lo, n = (np.concatenate([getattr(x, c) for x, _ in got]).astype(np.int32) for c in ("lo", "n"))
            row = np.concatenate([x.text + first for x, first in got])
            order, of_key = _groups(key, ctx)
            key, ctx, lo, n, row = key[order], ctx[order], lo[order], n[order], row[order]
            new_ctx = np.ones(len(key), dtype=bool)
            new_ctx[1:] = (key[1:] != key[:-1]) | (ctx[1:] != ctx[:-1])
            new_key = np.ones(len(key), dtype=bool)
            new_key[1:] = key[1:] != key[:-1]
            kid = np.cumsum(new_key) - 1
            rows_of, kinds_of = np.bincount(kid), np.bincount(kid, weights=new_ctx).astype(np.int64)
            several, alone = kinds_of[kid] > 1, rows_of[kid] == 1
            repeated = ~several & ~alone
            state = np.where(several, MIXED, np.where(alone, UNDECIDED, REPEATED)).astype(np.int32)
            sent = new_key | alone                       # one row per key
            other = _other(kid)[repeated]
            out = [np.concatenate([key[sent], mix(key + lo.astype(U64) + row.astype(U64))[repeated]]),
                   np.concatenate([ctx[sent], ctx[repeated]]),
                   np.concatenate([state[sent], np.full(int(repeated.sum()), FOUND, np.int32)]),
                   np.concatenate([row[sent], row[repeated]]),
                   np.concatenate([lo[sent], lo[repeated]]), np.concatenate([n[sent], n[repeated]])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0].view(np.int64)), pa.array(out[1].view(np.int64)), pa.array(out[2]),
                 *(b.column(c).take(pa.array(out[3])) for c in ((0, 1) if named else (1,))),
                 pa.array(out[4]), pa.array(out[5]), *_sources(b, int(sent.sum()), row[other], lo[other], lo[repeated], named)],
                names=["key", "ctx", "state", *_own(named), *_source(named)])

    return run


def _held_back(source: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Re-cut sorted batches so that rows with equal first ``keys`` columns stay together.

    Equal keys are at most one row per batch of the combining step, so a piece stays small.
    """
    rest = None
    for b in source:
        t = pa.Table.from_batches([b])
        t = pa.concat_tables([rest, t]) if rest is not None else t
        if not t.num_rows:
            continue
        same = np.ones(t.num_rows, dtype=bool)
        for c in range(keys):
            k = t.column(c).to_numpy()
            same &= k == k[-1]
        cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
        rest = t.slice(cut)
        if cut:
            yield t.slice(0, cut)
    if rest is not None and rest.num_rows:
        yield rest


def _index(named: bool):
    """Rows sorted by key -> ranges (rows with a null key) and keys that need single windows."""
    return lambda source: _matched_blocks(source, named)


def _matched_blocks(source: Iterator[pa.RecordBatch], named: bool) -> Iterator[pa.RecordBatch]:
    for t in _held_back(source, 1):
        key, ctx, state = (t.column(c).to_numpy() for c in ("key", "ctx", "state"))
        found = state == FOUND
        live = np.flatnonzero(~found)
        k, x, s = key[live], ctx[live], state[live]
        head = np.ones(len(k), dtype=bool)
        head[1:] = k[1:] != k[:-1]
        g = np.cumsum(head) - 1
        at = np.flatnonzero(head)
        if len(k):
            mixed = (np.maximum.reduceat(s, at) == MIXED) | (np.minimum.reduceat(x, at) != np.maximum.reduceat(x, at))
            twice = np.bincount(g) > 1
            fresh = (s == UNDECIDED) & (twice & ~mixed)[g]
            good, other, keys = live[fresh], live[_other(g)[fresh]], k[at][mixed]
        else:
            good, other, keys = live, live, k
        yield _matched(t, np.flatnonzero(found), good, other, keys, named)


def _matched(t: pa.Table, found: np.ndarray, good: np.ndarray, other: np.ndarray, keys: np.ndarray, named: bool) -> pa.RecordBatch:
    """Ranges that were found before with their sources, ranges found here with theirs, and keys."""
    def column(name: str, rows: np.ndarray) -> pa.Array:
        c = t.column(name).take(pa.array(rows)).combine_chunks()
        return pa.concat_arrays(c.chunks) if isinstance(c, pa.ChunkedArray) and c.num_chunks else \
            (pa.nulls(0, t.schema.field(name).type) if isinstance(c, pa.ChunkedArray) else c)

    rows = np.concatenate([found, good])
    m = len(keys)
    cols = [pa.concat_arrays([pa.nulls(len(rows), pa.int64()), pa.array(keys, pa.int64())])]
    for name in _own(named):
        c = column(name, rows)
        cols.append(pa.concat_arrays([c, pa.nulls(m, c.type)]))
    line = _line(*(column(name, of).to_numpy(zero_copy_only=False) for name, of in (("row_key", other), ("lo", other), ("lo", good))))
    fresh = [pa.array(line, pa.int32()), *([column("row_id", other), column("lo", other)] if named else [])]
    for name, new in zip(_source(named), fresh):
        c = pa.concat_arrays([column(name, found), new])
        cols.append(pa.concat_arrays([c, pa.nulls(m, c.type)]))
    return pa.RecordBatch.from_arrays(cols, names=["key", *_own(named), *_source(named)])


def _windows_locally(window: int, gram: int, bits: int, bitmap, named: bool):
    """Single windows of the blocks whose anchor is in the bit set, combined within the batch."""
    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        has = np.frombuffer(bitmap.value, dtype=np.uint8)
        for b in slices(source, BATCH_ROWS):
            keys, hashes, los, rows = [], [], [], []
            for x, first in _blocks(b, window, gram):
                if not len(x.key):
                    continue
                slot = (x.key & U64((1 << bits) - 1)).astype(np.int64)
                take = np.flatnonzero((has[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1)
                n = x.n[take]
                step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                keys.append(np.repeat(x.key[take], n))
                hashes.append(x.hashes[np.repeat(x.at[take], n) + step])
                los.append(np.repeat(x.lo[take], n) + step)
                rows.append(np.repeat(x.text[take] + first, n))
            if not keys:
                continue
            key, w, lo, row = (np.concatenate(c) for c in (keys, hashes, los, rows))
            order, g = _groups(key, w)
            key, w, lo, row = key[order], w[order], lo[order], row[order]
            many = np.bincount(g, minlength=1)[g] > 1 if len(g) else np.zeros(0, dtype=bool)
            head = np.ones(len(g), dtype=bool)
            head[1:] = g[1:] != g[:-1]
            # found here: as ranges of consecutive windows of a text that continue in one source
            other = _other(g)[many]
            fr, fl, sr, sl = row[many], lo[many], row[other], lo[other]
            o = np.lexsort((fl, fr))
            fr, fl, sr, sl = fr[o], fl[o], sr[o], sl[o]
            new = np.ones(len(fr), dtype=bool)
            new[1:] = (fr[1:] != fr[:-1]) | (fl[1:] != fl[:-1] + 1) | (sr[1:] != sr[:-1]) | (sl[1:] != sl[:-1] + 1)
            at = np.flatnonzero(new)
            fn = np.diff(np.append(at, len(fr)))
            m = len(at)
            row_out = np.concatenate([row[head], fr[at]])
            state = np.concatenate([np.where(many[head], REPEATED, UNDECIDED), np.full(m, FOUND)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([key[head], mix(fr[at].astype(U64) * U64(31) + fl[at].astype(U64))]).view(np.int64)),
                 pa.array(np.concatenate([w[head], np.zeros(m, U64)]).view(np.int64)), pa.array(state),
                 *(b.column(c).take(pa.array(row_out)) for c in ((0, 1) if named else (1,))),
                 pa.array(np.concatenate([lo[head], fl[at]]).astype(np.int32)),
                 pa.array(np.concatenate([np.ones(int(head.sum()), np.int64), fn]).astype(np.int32)),
                 *_sources(b, int(head.sum()), sr[at], sl[at], fl[at], named)],
                names=["key", "ctx", "state", *_own(named), *_source(named)])

    return run


def _windows(named: bool):
    """Rows sorted by key and window -> the windows that occur twice."""
    return lambda source: _matched_windows(source, named)


def _matched_windows(source: Iterator[pa.RecordBatch], named: bool) -> Iterator[pa.RecordBatch]:
    for t in _held_back(source, 2):
        key, w, state = (t.column(c).to_numpy() for c in ("key", "ctx", "state"))
        found = state == FOUND
        head = np.ones(len(key), dtype=bool)
        head[1:] = (key[1:] != key[:-1]) | (w[1:] != w[:-1])
        g = np.cumsum(head) - 1
        live = np.flatnonzero(~found)  # found ranges have keys of their own
        evidence = np.bincount(g, weights=~found)[g[live]] > 1
        fresh = (state[live] == UNDECIDED) & evidence
        out = _matched(t, np.flatnonzero(found), live[fresh], live[_other(g[live])[fresh]], np.zeros(0, np.int64), named)
        yield out.select(out.schema.names[1:])


def _bit_set(keys: DataFrame) -> tuple[int, bytes]:
    """A bit set over the low bits of ``keys(key)``: about 16 bits per key, 2 ** BITS at most."""
    n = keys.count()
    bits = min(BITS, max(16, int(16 * n).bit_length()))
    low = F.col("key").bitwiseAND(F.lit((1 << bits) - 1))
    rows = (keys.select(F.shiftright(low, 15).alias("bucket"), (low % 32768).alias("bit"))
            .groupBy("bucket").agg(F.expr("bitmap_construct_agg(bit)").alias("map")).collect())
    out = bytearray((1 << bits) // 8)
    for r in rows:
        out[r["bucket"] * 4096:(r["bucket"] + 1) * 4096] = r["map"]
    return bits, bytes(out)


def repeated_windows(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, named: bool = False) -> DataFrame:
    """``row_key, lo, n, line``: windows ``lo .. lo + n - 1`` of a row start elsewhere too, in a
    source row from some place on; ``named`` adds ``row_id``, the source's ``src_id`` and the place ``src_lo``.

    ``docs(row_id, row_key, text)`` names its rows by two numbers.
    """
    spark = docs.sparkSession
    ranges = [*_own(named), *_source(named)]
    blocks = _schema("key", "ctx", "state", *ranges)
    local = docs.mapInArrow(_index_locally(window, gram, named), blocks)
    index = (local.repartition("key").sortWithinPartitions("key")
             .mapInArrow(_index(named), _schema("key", *ranges)))
    index = materialize(index, "blocks")
    bits, content = _bit_set(index.where("key is not null").select("key"))
    bitmap = spark.sparkContext.broadcast(content)
    single = (docs.mapInArrow(_windows_locally(window, gram, bits, bitmap, named), blocks)
              .repartition("key", "ctx").sortWithinPartitions("key", "ctx")
              .mapInArrow(_windows(named), _schema(*ranges)))
    return index.where("key is null").drop("key").unionByName(single)


def parse(lo: np.ndarray, n: np.ndarray, line: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Factors of one document from its matched ranges and the lines of their sources: rows of first word,
    number of words, and the range they start with. Ranges that go on along the same line extend the factor."""
    order = np.lexsort((-n, lo))
    lo, end, line = lo[order], (lo + n)[order], line[order]
    new = np.ones(len(lo), dtype=bool)
    new[1:] = (line[1:] != line[:-1]) | (lo[1:] > end[:-1])
    at = np.flatnonzero(new)
    return np.stack([lo[at], np.maximum.reduceat(end, at) - lo[at] + window - 1, order[at]], axis=1)


_FACTOR = "array<struct<start:bigint,words:bigint,source_id:bigint,source_start:bigint>>"
_FACTOR_TYPE = pa.list_(pa.struct([(f, pa.int64()) for f in ("start", "words", "source_id", "source_start")]))


def _cut(window: int, extra: list[str], with_factors: bool):
    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(source):
            words, removed, kept, factors = [], [], [], []
            lists = [b.column(f"__llm_{c}").to_pylist() for c in ("lo", "n", *_source(with_factors))]
            for t, los, *more in zip(b.column("__llm_text").to_pylist(), *lists):
                parts = (t or "").encode().split()
                found = []
                if los:
                    own = parse(*(np.array(x, dtype=np.int64) for x in (los, *more[:2])), window)
                    edge = np.zeros(len(parts) + 1, dtype=np.int64)
                    np.add.at(edge, own[:, 0], 1)
                    np.add.at(edge, own[:, 0] + own[:, 1], -1)
                    keep = np.cumsum(edge)[:-1] == 0
                    left = [p for p, k in zip(parts, keep.tolist()) if k]
                    if with_factors:
                        found = [{"start": s, "words": w, "source_id": more[2][k], "source_start": more[3][k]} for s, w, k in own.tolist()]
                else:
                    left = parts
                factors.append(found)
                words.append(len(parts))
                removed.append(len(parts) - len(left))
                kept.append(b" ".join(left).decode())
            out = [*(b.column(c) for c in extra), pa.array(words, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())]
            names = [*extra, "n_words", "n_removed", "kept_text"]
            if with_factors:
                out, names = [*out, pa.array(factors, _FACTOR_TYPE)], [*names, "factors"]
            yield pa.RecordBatch.from_arrays(out, names=names)

    return run


def remove_repeated(docs: DataFrame, window: int = WINDOW, gram: int = GRAM,
                    keep: list[str] | None = None, factors: bool = False) -> DataFrame:
    """Add ``n_words, n_removed, kept_text`` (words joined by one blank) to ``docs(doc_id, text)``.

    ``keep`` names the columns carried along (all by default; columns named like the results
    are replaced). With ``factors`` also the parse: first word, number of words, and a source (id of its
    document, first word there) of every factor.
    """
    made = ["n_words", "n_removed", "kept_text", *(["factors"] if factors else [])]
    extra = [c for c in (keep if keep is not None else docs.columns) if c not in made]
    named = docs.select(*extra, F.col("text").alias("__llm_text"), F.xxhash64("doc_id", "text").alias("__llm_key"))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("row_id"), F.xxhash64("doc_id", "text").alias("row_key"), "text")
    # copies of a row have equal ranges: with one source each they are at most as many as the text has windows
    one = F.min(F.struct(*_source(True)) if factors else "line").alias("s")
    ranges = repeated_windows(rows, window, gram, factors).groupBy("row_key", "lo", "n").agg(one)
    source = [F.col("s.line").alias("line"), "s.src_id", "s.src_lo"] if factors else [F.col("s").alias("line")]
    spans = (ranges.groupBy(F.col("row_key").alias("__llm_k"))
             .agg(F.collect_list(F.struct("lo", "n", *source)).alias("__llm_s")))
    joined = named.join(spans, F.col("__llm_key") == F.col("__llm_k"), "left")
    fields = ["lo", "n", *_source(factors)]
    flat = joined.select(*extra, "__llm_text", *[F.col(f"__llm_s.{c}").alias(f"__llm_{c}") for c in fields])
    schema = docs.select(*extra).withColumns({"n_words": F.lit(0).cast("bigint"), "n_removed": F.lit(0).cast("bigint"),
                                              "kept_text": F.lit("")} | ({"factors": F.lit(None).cast(_FACTOR)} if factors else {})).schema
    return flat.mapInArrow(_cut(window, extra, factors), schema)
