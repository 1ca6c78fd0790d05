"""Benchmark decontamination with an FM-index per shard of documents.

Words are the terms of :mod:`.terms`. A *phrase* is a window of ``window`` consecutive words of
an item; an item of fewer words, but not none, is one phrase. Every word of a document that lies
inside an occurrence of a phrase is hit.

A task takes its documents shard by shard. A shard's text is written over the alphabet of the
phrases: a word of no phrase ends a run, since no occurrence can contain it, and runs shorter
than the shortest phrase are left out for the same reason. Over these runs the shard gets an
FM-index: the Burrows-Wheeler transform in a wavelet matrix with rank counts, and suffix
positions sampled every ``SAMPLE`` symbols and at each run's start. All phrases are searched
backwards together, one symbol a step, by ranks; the rows found are located by stepping back to
a sampled position; the occurrences of a document are merged into removal spans.

The items are read in blocks of bounded size (``BLOCK_WORDS``), each block is searched in all
documents, and what a document collects from the blocks is merged. There is no shuffle: hot
sources, copies or phrases only lengthen the tasks that hold their texts. A task holds one shard
(about ``SHARD_BYTES`` of text or ``SHARD_SYMBOLS`` indexed symbols, or one longer document).

Odd input: null and empty texts have no words and no spans; items without words are ignored;
a null item id counts as an item and is written as an empty string; items that share an id count
once; equal rows each get the same result; empty tables give empty results or clean documents;
extra columns are untouched, those named in ``keep`` are returned. Words are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, slices
from .terms import Vocabulary, item_blocks, term_words, utf8
from .words import batches

BLOCK_WORDS = 1 << 19
SHARD_SYMBOLS = 1 << 19
SHARD_BYTES = 24 << 20
SAMPLE = 16
_FOUND = "array<struct<word:bigint,word_end:bigint,start:bigint,end:bigint>>"
_SPAN = pa.list_(pa.struct([(f, pa.int64()) for f in ("word", "word_end", "start", "end")]))


class Ranks:
    """A bit vector with the number of ones before each position."""

    def __init__(self, bits: np.ndarray) -> None:
        padded = np.zeros((len(bits) // 64 + 1) * 64, dtype=np.uint8)
        padded[:len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.zeros(len(self.words) + 1, dtype=np.int64)
        np.cumsum(np.bitwise_count(self.words), out=self.before[1:])
        self.ones = int(self.before[-1])

    def rank(self, at: np.ndarray) -> np.ndarray:
        w, b = at >> 6, (at & 63).astype(np.uint64)
        low = self.words[w] & ((np.uint64(1) << b) - np.uint64(1))
        return self.before[w] + np.bitwise_count(low)

    def get(self, at: np.ndarray) -> np.ndarray:
        return ((self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)


class Wavelet:
    """Wavelet matrix of a symbol array: access and rank, one bit vector per symbol bit."""

    def __init__(self, symbols: np.ndarray, top: int) -> None:
        self.levels: list[tuple[int, Ranks, int]] = []
        for bit in range(max(1, int(top).bit_length()) - 1, -1, -1):
            one = ((symbols >> bit) & 1).astype(bool)
            self.levels.append((bit, Ranks(one), int(len(one) - one.sum())))
            symbols = np.concatenate([symbols[~one], symbols[one]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often ``symbol`` occurs before position ``at``."""
        low, high = np.zeros_like(at), at
        for bit, ones, zeros in self.levels:
            one = ((symbol >> bit) & 1).astype(bool)
            a, b = ones.rank(low), ones.rank(high)
            low, high = np.where(one, zeros + a, low - a), np.where(one, zeros + b, high - b)
        return high - low

    def access(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols at ``at``, and how often each occurs before."""
        symbol, low, high = np.zeros(len(at), dtype=np.int64), np.zeros_like(at), at
        for bit, ones, zeros in self.levels:
            one = ones.get(high)
            a, b = ones.rank(low), ones.rank(high)
            symbol |= one.astype(np.int64) << bit
            low, high = np.where(one, zeros + a, low - a), np.where(one, zeros + b, high - b)
        return symbol, high - low


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Positions in the order of their suffixes; each separator (0) is a symbol of its own, smaller
    than all others and than later separators, so that no comparison passes it."""
    n = len(symbols)
    separator = symbols == 0
    rank = np.where(separator, np.cumsum(separator) - 1, int(separator.sum()) + symbols).astype(np.int64)
    step = 1
    while True:
        key = rank * (int(rank.max()) + 2)
        key[:n - step] += rank[step:] + 1
        order = np.argsort(key, kind="stable")
        key = key[order]
        new = np.empty(n, dtype=np.int64)
        new[order] = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])])
        if int(new[order[-1]]) == n - 1 or step >= n:
            return order
        rank, step = new, 2 * step


class ShardIndex:
    """FM-index of runs of symbols ``1..top``; every run is preceded by a separator 0."""

    def __init__(self, symbols: np.ndarray, top: int) -> None:
        order = suffix_order(symbols)
        before = symbols[order - 1].astype(np.int64)  # position 0 holds a separator, as the run's first symbol sees
        counts = np.bincount(symbols, minlength=top + 1)
        self.first = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
        self.wavelet = Wavelet(before, top)
        sampled = (order % SAMPLE == 0) | (before == 0)
        self.marks, self.at = Ranks(sampled), order[sampled]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranges of rows that start with each phrase; ``phrases`` is padded with 0 on the left."""
        low = np.zeros(len(phrases), dtype=np.int64)
        high = np.full(len(phrases), int(self.first[-1]), dtype=np.int64)
        for k in range(phrases.shape[1] - 1, -1, -1):
            live = np.flatnonzero((phrases[:, k] > 0) & (high > low))
            if not len(live):
                break
            c = phrases[live, k].astype(np.int64)
            low[live], high[live] = (self.first[c] + self.wavelet.rank(c, x[live]) for x in (low, high))
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of the suffixes at ``rows``."""
        out, back = np.full(len(rows), -1, dtype=np.int64), 0
        todo, row = np.arange(len(rows)), rows
        while len(todo):
            known = self.marks.get(row)
            out[todo[known]] = self.at[self.marks.rank(row[known])] + back
            todo, row = todo[~known], row[~known]
            symbol, before = self.wavelet.access(row)
            row, back = self.first[symbol] + before, back + 1
        return out


class Phrases:
    """The distinct phrases of a block of items, and the items of each."""

    def __init__(self, ids: list, texts: list[bytes], window: int) -> None:
        self.ids = ["" if i is None else str(i) for i in ids]
        words = term_words(texts)
        self.vocabulary = Vocabulary(words.hashes)
        numbers = self.vocabulary.numbers(words.hashes)
        found: dict[bytes, set[int]] = {}
        self.shortest = window
        for k in range(len(texts)):
            own = numbers[words.first[k]:words.first[k + 1]]
            size = min(window, len(own))
            self.shortest = min(self.shortest, size)
            for at in range(len(own) - size + 1):
                padded = np.zeros(window, dtype=np.int32)
                padded[window - size:] = own[at:at + size]
                found.setdefault(padded.tobytes(), set()).add(k)
        self.phrases = np.frombuffer(b"".join(found), dtype=np.int32).reshape(-1, window)
        self.sizes = (self.phrases > 0).sum(axis=1)
        self.items = [sorted(v) for v in found.values()]


class _Shard:
    """Documents of one shard: their batches, and their runs over the phrases' alphabet."""

    def __init__(self, phrases: Phrases) -> None:
        self.p = phrases
        self.clear()

    def clear(self) -> None:
        self.batches: list[pa.RecordBatch] = []
        self.n_words: list[np.ndarray] = []
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.rows = self.bytes = self.symbols = 0

    def add(self, batch: pa.RecordBatch) -> None:
        texts = utf8(batch.column("text"))
        for at, group in batches(texts):
            words = term_words(group)
            self._add_runs(words, self.rows + at)
            self.n_words.append(np.diff(words.first))
        self.batches.append(batch)
        self.rows += len(texts)
        self.bytes += sum(map(len, texts))

    def _add_runs(self, words, row: int) -> None:
        number = self.p.vocabulary.numbers(words.hashes)
        inside = number > 0
        if not inside.any():
            return
        edge = inside.copy()  # first words of runs: after an outside word or at a text's start
        edge[1:] &= ~inside[:-1]
        starts = words.first[:-1]
        starts = starts[starts < len(inside)]
        edge[starts] |= inside[starts]
        at = np.flatnonzero(inside)
        run = np.cumsum(edge[at]) - 1
        long = np.bincount(run)[run] >= self.p.shortest
        at = at[long]
        if not len(at):
            return
        doc = np.searchsorted(words.first, at, side="right") - 1
        self.parts.append((number[at], edge[at], row + doc, at - words.first[doc],
                           words.starts[at] - words.offsets[doc], words.ends[at] - words.offsets[doc]))
        self.symbols += len(at)

    def full(self) -> bool:
        return self.symbols >= SHARD_SYMBOLS or self.bytes >= SHARD_BYTES

    def _hits(self) -> dict[int, tuple[list, list]]:
        """Row -> its spans in words and bytes, and the ordinals of its items."""
        if not self.parts:
            return {}
        number, edge, doc, word, start, end = (np.concatenate(c) for c in zip(*self.parts))
        place = np.arange(len(number)) + np.cumsum(edge)  # a separator before each run
        text = np.zeros(int(place[-1]) + 1, dtype=np.int64)
        text[place] = number
        back = np.full(len(text), -1, dtype=np.int64)
        back[place] = np.arange(len(number))
        index = ShardIndex(text, len(self.p.vocabulary))
        low, high = index.search(self.p.phrases)
        count = np.maximum(high - low, 0)
        which = np.repeat(np.arange(len(count)), count)
        if not len(which):
            return {}
        rows = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)
        at = back[index.locate(rows)]
        size = self.p.sizes[which]
        cover = np.bincount(at, minlength=len(number) + 1) - np.bincount(at + size, minlength=len(number) + 1)
        hit = np.flatnonzero(np.cumsum(cover)[:len(number)] > 0)
        new = np.ones(len(hit), dtype=bool)
        new[1:] = (doc[hit[1:]] != doc[hit[:-1]]) | (word[hit[1:]] != word[hit[:-1]] + 1)
        first, last = hit[new], hit[np.append(np.flatnonzero(new)[1:], len(hit)) - 1]
        out: dict[int, tuple[list, list]] = {}
        for d, *span in zip(doc[first].tolist(), word[first].tolist(), (word[last] + 1).tolist(),
                            start[first].tolist(), end[last].tolist()):
            out.setdefault(d, ([], set()))[0].append(span)
        pairs = np.unique(np.stack([doc[at], which], axis=1), axis=0)
        for d, w in pairs.tolist():
            out[d][1].update(self.p.items[w])
        return out

    def flush(self) -> Iterator[pa.RecordBatch]:
        hits = self._hits()
        row = 0
        n_words = np.concatenate(self.n_words) if self.n_words else np.zeros(0, dtype=np.int64)
        for b in self.batches:
            spans, items = b.column("found").to_pylist(), b.column("items").to_pylist()
            texts = b.column("text")
            for k in range(b.num_rows):
                if row + k in hits:
                    own, which = hits[row + k]
                    spans[k] = _merge((spans[k] or []) + _in_characters(texts[k].as_py(), own))
                    items[k] = sorted({*(items[k] or []), *(self.p.ids[i] for i in which)})
            columns = {f: b.column(f) for f in b.schema.names}
            columns["n_words"] = pa.array(n_words[row:row + b.num_rows].astype(np.int64))
            columns["found"] = pa.array(spans, type=_SPAN)
            columns["items"] = pa.array(items, type=pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))
            row += b.num_rows
        self.clear()


def _in_characters(text: str, spans: list[list[int]]) -> list[dict]:
    """Byte offsets as code points."""
    data = text.encode("utf-8", "surrogatepass")
    out, at, chars = [], 0, 0
    for word, word_end, *ends in spans:
        for k, e in enumerate(ends):
            chars += len(data[at:e].decode("utf-8", "surrogatepass"))
            at, ends[k] = e, chars
        out.append({"word": word, "word_end": word_end, "start": ends[0], "end": ends[1]})
    return out


def _merge(spans: list[dict]) -> list[dict]:
    out: list[dict] = []
    for s in sorted(spans, key=lambda s: s["word"]):
        if out and s["word"] <= out[-1]["word_end"]:
            if s["word_end"] > out[-1]["word_end"]:
                out[-1] |= {"word_end": s["word_end"], "end": s["end"]}
        else:
            out.append(dict(s))
    return out


def _search(phrases: Phrases):
    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = _Shard(phrases)
        for b in slices(source):
            shard.add(b)
            if shard.full():
                yield from shard.flush()
        yield from shard.flush()
    return run


def _no_search(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Only counts words: there is nothing to search."""
    empty = Phrases([], [], 1)
    return _search(empty)(source)


def find_phrases(docs: DataFrame, items: DataFrame, window: int = 10, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns, ``n_words``, ``n_hit``, ``spans`` (merged removal spans in words and code
    points, ends exclusive), ``items`` (ids as strings, sorted) and ``cleaned`` (the text without
    its spans) of every document; see the module for method and odd input."""
    keep = ["doc_id"] if keep is None else keep
    df = docs.select(*[docs[c].alias(f"k{n}") for n, c in enumerate(keep)], docs["text"].alias("text"))
    df = df.select("*", F.lit(0).cast("bigint").alias("n_words"), F.lit(None).cast(_FOUND).alias("found"),
                   F.lit(None).cast("array<string>").alias("items"))
    passes = 0
    for ids, texts in item_blocks(items, "item_id", "text", BLOCK_WORDS):
        if passes:  # one block at a time on the executors and in the plan
            df = materialize(df, "phrases")
        df = df.mapInArrow(_search(Phrases(ids, texts, window)), df.schema)
        passes += 1
    if not passes:
        df = df.mapInArrow(_no_search, df.schema)
    spans = F.coalesce("found", F.array().cast(_FOUND))
    hit = F.aggregate(spans, F.lit(0).cast("bigint"), lambda n, s: n + s["word_end"] - s["word"])
    text = F.coalesce("text", F.lit(""))
    cleaned = F.aggregate(
        spans, F.struct(F.lit("").alias("out"), F.lit(0).cast("bigint").alias("at")),
        lambda a, s: F.struct(F.concat(a["out"], F.substring(text, a["at"].cast("int") + 1, (s["start"] - a["at"]).cast("int")))
                              .alias("out"), s["end"].alias("at")),
        lambda a: F.concat(a["out"], F.substring(text, a["at"].cast("int") + 1, F.length(text))))
    return df.select(*[F.col(f"k{n}").alias(c) for n, c in enumerate(keep)], "n_words", hit.alias("n_hit"), spans.alias("spans"),
                     F.coalesce("items", F.array().cast("array<string>")).alias("items"),
                     F.when(F.size(spans) > 0, cleaned).otherwise(F.col("text")).alias("cleaned"))
