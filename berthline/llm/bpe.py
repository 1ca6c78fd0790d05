"""Byte-level BPE by prefix dynamic programming.

For a byte string the table ``last[i]`` holds the only token that can end the encoding of the
first ``i`` bytes. ``last[i]`` is found from earlier entries: a token ``t`` of length ``k``
that ends at ``i`` is the one whose neighbour ``last[i - k]`` stays apart from it under the
merge rules. Reading the table backwards gives the encoding. Appending bytes only extends
the table, and after an edit it is recomputed only until it agrees with the old table again.

Documents are encoded in Arrow batches. Pieces of text that a worker has met are remembered in
a bounded table; the tables of all new pieces of a batch are filled together, one prefix length
at a time, with array operations (:meth:`Vocabulary.encode_many`). Long pieces use
:class:`PrefixEncoder`, which also offers the appends and edits.

Defined results: null and empty texts give no ids; every other column is kept, except that an
existing column named like an output is replaced; repeated rows give repeated results; an
empty table gives an empty table. Special tokens are never produced.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices
from .words import SPACE, U64, range_hashes

TABLE_BITS = 20          # places of a worker's table of chunks
STORE_IDS = 4_000_000    # ids of these chunks; the table is emptied when there are more
KNOWN_PAIRS = 300_000    # remembered verdicts on neighbours
TOGETHER_BYTES = 32      # longest piece whose table is filled together with others
TOGETHER_CHARS = 400_000 # text handled at a time

_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: Cuts a text only where the piece pattern cuts it too: around runs of white space, one
#: blank staying with the run that follows it.
_WIDE_SPACE = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_CHUNKS = re.compile(f" ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")


def read_ranks(path: str | None = None) -> bytes:
    """The rank file's content (read on the driver, shipped with the job; about 1 MB)."""
    with open(path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        return f.read()


class Vocabulary:
    """Ranks of byte strings, with what the table of last tokens needs: splits and neighbours."""

    def __init__(self, ranks: dict[bytes, int], merges: dict[tuple[int, int], int] | None = None) -> None:
        """``merges`` lists the pairs that may merge and their results; by default every pair
        whose joined bytes are in ``ranks`` merges. Lower results are merged first."""
        self.ranks, self.merges = ranks, merges
        self.bytes_of = {r: b for b, r in ranks.items()}
        self.longest = max(map(len, ranks), default=1)
        self._split: dict[int, tuple[int, int] | None] = {}
        self.known: dict[tuple[int, int], bool] = {}
        self._tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self._pair = np.full(1 << 20, -1, dtype=np.int64)   # direct-mapped copy of known
        self._pair_ok = np.zeros(1 << 20, dtype=bool)
        self.length_of = np.zeros(max(self.bytes_of, default=0) + 1, dtype=np.int32)
        for b, r in ranks.items():
            self.length_of[r] = len(b)

    @classmethod
    def parse(cls, content: bytes) -> Vocabulary:
        rows = (line.split() for line in content.splitlines() if line)
        return cls({base64.b64decode(a): int(b) for a, b in rows})

    def joined(self, a: int, b: int) -> int | None:
        """The token that ``a`` and ``b`` merge into, if they merge."""
        if self.merges is not None:
            return self.merges.get((a, b))
        return self.ranks.get(self.bytes_of[a] + self.bytes_of[b])

    def split(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes ``token``; None for a single byte.

        ``(-1, -1)`` marks a token that merging its own bytes never reaches: it can only be
        the whole of a piece.
        """
        if token not in self._split:
            parts = [self.ranks[bytes([x])] for x in self.bytes_of[token]]
            if len(parts) == 1:
                self._split[token] = None
            else:
                while len(parts) > 2:
                    pairs = [(self.joined(a, b), k) for k, (a, b) in enumerate(zip(parts, parts[1:]))]
                    best = min((x for x in pairs if x[0] is not None), default=None)
                    if best is None:
                        break
                    parts[best[1]:best[1] + 2] = [best[0]]
                whole = len(parts) == 2 and self.joined(*parts) == token
                self._split[token] = (parts[0], parts[1]) if whole else (-1, -1)
        return self._split[token]

    def reached(self, token: int) -> bool:
        return self.split(token) != (-1, -1)

    def apart(self, left: int, right: int) -> bool:
        """Whether the merge rules leave ``left`` and ``right`` standing side by side."""
        if len(self.known) > KNOWN_PAIRS:
            self.known.clear()
        ok = self.reached(right) and (left < 0 or self._stay_apart(left, right))
        self.known[left, right] = ok
        return ok

    def _table(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of ``k`` bytes as sorted fixed-width byte strings, and their ranks."""
        if k not in self._tables:
            rows = sorted((b, r) for b, r in self.ranks.items() if len(b) == k)
            keys = np.frombuffer(b"".join(b for b, _ in rows), dtype=np.uint8).reshape(len(rows), k)
            self._tables[k] = (_keys(keys), np.array([r for _, r in rows], dtype=np.int64))
        return self._tables[k]

    def _pairs_apart(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """:meth:`apart` for arrays; ``left`` is -1 at a piece's start."""
        code = ((left + 1) << 32) | right
        slot = (code.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)
        new = self._pair[slot] != code
        ok = self._pair_ok[slot]
        if new.any():
            codes, where = np.unique(code[new], return_inverse=True)
            found = np.empty(len(codes), dtype=bool)
            for n, c in enumerate(codes.tolist()):
                pair = (c >> 32) - 1, c & 0xFFFFFFFF
                known = self.known.get(pair)
                found[n] = known if known is not None else self.apart(*pair)
            ok = ok.copy()
            ok[new] = found[where]
            self._pair[slot[new]], self._pair_ok[slot[new]] = code[new], ok[new]
        return ok

    def encode_many(self, pieces: list[bytes]) -> list[bytes]:
        """The ids (little-endian int32) of pieces of 1 to TOGETHER_BYTES bytes."""
        if not pieces:
            return []
        sizes = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        order = np.argsort(-sizes, kind="stable")
        sizes, most = sizes[order], int(sizes.max())
        data = np.frombuffer(b"".join(p.ljust(most, b"\0") for p in pieces), dtype=np.uint8)
        data = np.ascontiguousarray(data.reshape(-1, most)[order].T)  # a row per position
        last = np.full((most + 1, len(pieces)), -1, dtype=np.int64)
        for end in range(1, most + 1):
            todo = np.arange(int(np.searchsorted(-sizes, -end, side="right")))
            for k in range(min(end, self.longest), 0, -1):
                keys, ranks = self._table(k)
                if not len(keys):
                    continue
                sub = _keys(np.ascontiguousarray(data[end - k:end, todo].T))
                at = np.searchsorted(keys, sub)
                at[at == len(keys)] = 0
                hit = keys[at] == sub
                rows, token = todo[hit], ranks[at[hit]]
                ok = self._pairs_apart(last[end - k, rows], token)
                last[end, rows[ok]] = token[ok]
                gone = np.zeros(len(todo), dtype=bool)
                gone[np.flatnonzero(hit)[ok]] = True
                todo = todo[~gone]
                if not len(todo):
                    break
            else:
                raise ValueError("a byte is missing from the vocabulary")
        steps, end, each = [], sizes.copy(), np.arange(len(pieces))
        count = np.zeros(len(pieces), dtype=np.int64)
        while end.any():
            token = np.where(end > 0, last[end, each], -1)
            steps.append(token)
            count += end > 0
            end = end - np.where(token >= 0, self.length_of[token], 0)
        starts = np.cumsum(count) - count
        flat = np.empty(int(count.sum()), dtype="<i4")
        for n, token in enumerate(steps):
            live = token >= 0
            flat[(starts + count - 1 - n)[live]] = token[live]
        blob, out = flat.tobytes(), [b""] * len(pieces)
        for i, a, c in zip(order.tolist(), (starts * 4).tolist(), (count * 4).tolist()):
            out[i] = blob[a:a + c]
        return out

    def _stay_apart(self, left: int, right: int) -> bool:
        # Undo merges from the latest to the earliest. At every moment the border has a right
        # end of the left token and a left end of the right one; a merge over the border
        # that comes before the undone ones would have been made instead of them. Of merges
        # of equal rank the one further left is made first.
        undone = 1 << 62
        a, b = left, right
        while True:
            over = self.joined(a, b)
            if over is not None and over < undone:
                return False
            sa, sb = self.split(a), self.split(b)
            if sa is None and sb is None:
                return True
            if sb is None or (sa is not None and a > b):
                undone, a = a, sa[1]
            else:
                undone, b = b + 1, sb[0]


def _keys(rows: np.ndarray) -> np.ndarray:
    """Rows of k bytes as sortable scalars: integers up to 8 bytes, byte strings above."""
    k = rows.shape[1]
    if k > 8:  # a trailing byte keeps zeros at the end from being dropped
        rows = np.concatenate([rows, np.ones((len(rows), 1), dtype=np.uint8)], axis=1)
        return np.ascontiguousarray(rows).view(f"S{k + 1}").ravel()
    out = np.zeros(len(rows), dtype=np.uint64)
    for j in range(k):
        out = (out << np.uint64(8)) | rows[:, j]
    return out


class PrefixEncoder:
    """The table of last tokens of one byte string, with exact appends and local re-encoding."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b"") -> None:
        self.v, self.data, self.last = vocabulary, b"", []
        self.append(data)

    def _extend(self, last: list[int], stop: int) -> None:
        """Compute the entries of ``last`` up to ``stop`` bytes."""
        data, longest, get, known = self.data, self.v.longest, self.v.ranks.get, self.v.known.get
        for end in range(len(last) + 1, stop + 1):
            for start in range(end - longest if end > longest else 0, end):
                t = get(data[start:end])
                if t is None:
                    continue
                if start:
                    left = last[start - 1]
                    ok = known((left, t))
                    if ok is None:
                        ok = self.v.apart(left, t)
                else:
                    ok = self.v.reached(t)
                if ok:
                    last.append(t)
                    break
            else:
                raise ValueError("a byte is missing from the vocabulary")

    def append(self, more: bytes) -> None:
        self.data += more
        self._extend(self.last, len(self.data))

    def replace(self, start: int, stop: int, new: bytes) -> int:
        """Exchange ``data[start:stop]``; returns how many entries were computed anew."""
        old, shift = self.last, len(new) - (stop - start)
        self.data = self.data[:start] + new + self.data[stop:]
        last, same, done = old[:start], 0, 0
        for end in range(start + 1, len(self.data) + 1):
            if same >= self.v.longest:  # the window that decides the next entry is as it was
                last.extend(old[end - 1 - shift:])
                break
            self._extend(last, end)
            done += 1
            inside = end - len(new) > start and 0 <= end - 1 - shift < len(old)
            same = same + 1 if inside and last[-1] == old[end - 1 - shift] else 0
        self.last = last
        return done

    def ids(self) -> list[int]:
        out, end = [], len(self.data)
        while end:
            out.append(self.last[end - 1])
            end -= len(self.v.bytes_of[out[-1]])
        return out[::-1]


def _runs(data: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of white space and of other bytes, cut at the texts' borders: start, end, is space."""
    space = SPACE[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[1:-1] = space[1:] != space[:-1]
    edge[first] = edge[last] = True
    cut = np.flatnonzero(edge)
    edge[:] = True
    edge[last] = False  # the byte between two texts
    a, b = cut[:-1], cut[1:]
    inside = edge[a]
    a, b = a[inside], b[inside]
    return a, b, space[a]


def cut_blanks(data: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Chunks like ``_CHUNKS`` where all white space is one byte wide: starts and ends."""
    a, b, space = _runs(data, first, last)
    if not len(a):
        return a, b
    led = np.zeros(len(a), dtype=bool)             # white space before a word of the same text
    led[:-1] = space[:-1] & ~space[1:] & (b[:-1] == a[1:])
    blank = led & (data[b - 1] == 32)
    one = ~space | ~led | (b - a > 1)              # the word, or the white space but for its end
    two = led & ~blank                             # an end that is no blank stands alone
    after = np.zeros(len(a), dtype=bool)
    after[1:] = blank[:-1]
    starts, ends = a - (after & ~space), np.where(led, b - 1, b)
    n = one.astype(np.int64) + two
    at = np.cumsum(n) - n
    out_a, out_b = np.empty(int(n.sum()), np.int64), np.empty(int(n.sum()), np.int64)
    out_a[at[one]], out_b[at[one]] = starts[one], ends[one]
    k = (at + one)[two]
    out_a[k], out_b[k] = (b - 1)[two], b[two]
    return out_a, out_b


def cut_words(data: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of bytes other than white space: starts and ends."""
    a, b, space = _runs(data, first, last)
    return a[~space], b[~space]


def _cut_by_pattern(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """``_CHUNKS`` of each text, as places in the texts joined by one byte."""
    starts, at = [], 0
    ends: list[int] = []
    for t in texts:
        for c in _CHUNKS.findall(t):
            starts.append(at)
            at += len(c.encode())
            ends.append(at)
        at += 1
    return np.array(starts, dtype=np.int64), np.array(ends, dtype=np.int64)


class Pieces:
    """Ids of texts, with a bounded table of the chunks met so far.

    ``cut`` finds the chunks, ``pattern`` cuts a chunk into pieces; ``end`` is put behind each
    piece (vocabularies with word ends). ``whole`` takes a piece that is itself a token as
    this token, even if merging doesn't reach it. The table is indexed by a 64-bit hash of the
    chunk, verified by a second one, and each place holds the chunk that came last.
    """

    def __init__(self, vocabulary: Vocabulary, pattern: str, cut: Callable = cut_blanks, end: bytes = b"",
                 whole: bool = True, bits: int = TABLE_BITS) -> None:
        self.v, self.find, self.cut, self.end, self.whole = vocabulary, regex.compile(pattern).findall, cut, end, whole
        self.bits = bits
        self._forget()

    def _forget(self) -> None:
        n = 1 << self.bits
        self.key, self.check = np.zeros(n, dtype=U64), np.zeros(n, dtype=U64)
        self.at, self.n = np.zeros(n, dtype=np.int32), np.zeros(n, dtype=np.int32)
        self.store, self.used = np.zeros(1 << 16, dtype="<i4"), 0

    def _encode_chunks(self, chunks: list[bytes]) -> list[bytes]:
        get, end, together, alone = self.v.ranks.get, self.end, {}, {}
        parts: list[list] = []
        for raw in chunks:
            chunk = raw.decode()
            # letters are one piece, and so is white space: what follows it is not in the chunk
            whole = chunk.isspace() or chunk.isalpha() or chunk[0] == " " and chunk[1:].isalpha()
            ids: list = []
            for data in [raw] if whole else map(str.encode, self.find(chunk)):
                data += end
                token = get(data)
                if token is not None and (self.whole or self.v.reached(token)):
                    ids.append(token.to_bytes(4, "little"))
                elif len(data) <= TOGETHER_BYTES:
                    ids.append(~together.setdefault(data, len(together)))
                else:
                    if data not in alone:
                        alone[data] = array("i", PrefixEncoder(self.v, data).ids()).tobytes()
                    ids.append(alone[data])
            parts.append(ids)
        found = self.v.encode_many(list(together))
        return [b"".join([x if x.__class__ is bytes else found[~x] for x in ids]) for ids in parts]

    def _keep(self, ids: np.ndarray) -> int:
        start = self.used
        if start + len(ids) > len(self.store):
            more = np.zeros(2 * (start + len(ids)), dtype="<i4")
            more[:start] = self.store[:start]
            self.store = more
        self.store[start:start + len(ids)] = ids
        self.used += len(ids)
        return start

    def _group(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and the number of ids of each text."""
        if self.used > STORE_IDS:
            self._forget()
        raw = [t.encode() for t in texts]
        blob = b" ".join(raw)
        data = np.frombuffer(blob, dtype=np.uint8)
        size = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))
        first = np.cumsum(size + 1) - size - 1
        if self.cut is cut_blanks and any(map(_WIDE_SPACE.search, texts)):
            a, b = _cut_by_pattern(texts)
        else:
            a, b = self.cut(data, first, first + size) if len(data) else (first[:0], first[:0])
        if not len(a):
            return np.zeros(0, dtype="<i4"), np.zeros(len(texts), dtype=np.int64)
        key, check = range_hashes(data, a, b)
        slot = (key >> U64(64 - self.bits)).astype(np.int64)
        n, at = self.n[slot], self.at[slot].astype(np.int64)
        miss = np.flatnonzero((n == 0) | (self.key[slot] != key) | (self.check[slot] != check))
        if len(miss):
            _, where, back = np.unique(key[miss], return_index=True, return_inverse=True)
            new = miss[where]
            found = self._encode_chunks([blob[x:y] for x, y in zip(a[new].tolist(), b[new].tolist())])
            count = np.fromiter(map(len, found), dtype=np.int64, count=len(found)) // 4
            start = self._keep(np.frombuffer(b"".join(found), dtype="<i4")) + np.cumsum(count) - count
            n, at = n.copy(), at
            n[miss], at[miss] = count[back], start[back]
            place = slot[new]
            self.key[place], self.check[place], self.at[place], self.n[place] = key[new], check[new], start, count
        n = n.astype(np.int64)
        step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        ids = self.store[np.repeat(at, n) + step]
        total = np.concatenate([[0], np.cumsum(n)])
        edge = np.searchsorted(a, first)
        return ids, total[np.append(edge[1:], len(a))] - total[edge]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and where each text's ids begin and end."""
        ids, counts, start = [], [], 0
        while start < len(texts):
            stop, room = start, TOGETHER_CHARS
            while stop < len(texts) and (stop == start or room >= len(texts[stop])):
                room -= len(texts[stop])
                stop += 1
            i, c = self._group(texts[start:stop])
            ids.append(i)
            counts.append(c)
            start = stop
        n = np.concatenate(counts) if counts else np.zeros(0, dtype=np.int64)
        return (np.concatenate(ids) if ids else np.zeros(0, dtype="<i4")), np.concatenate([[0], np.cumsum(n)])


_held: dict[tuple, Pieces] = {}


def pieces_of(content: bytes, pattern: str) -> Pieces:
    """The worker's table for this vocabulary (kept between tasks)."""
    key = (hash(content), pattern)
    if key not in _held:
        _held.clear()
        _held[key] = Pieces(Vocabulary.parse(content), pattern)
    return _held[key]


def _with_column(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    names = [n for n in batch.schema.names if n != name]
    return pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), values], names=[*names, name])


def _schema(df: DataFrame, name: str, kind: str) -> str:
    kept = df.select(*[c for c in df.columns if c != name]).withColumn(name, F.lit(None).cast(kind))
    return kept.schema


def encode(df: DataFrame, ranks: bytes | None = None, pattern: str = public_tokenizers.PATTERN,
           text: str = "text", out: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """Add ``out`` (array<int>), the ids of ``text``. ``keep`` names the columns carried along
    (all by default)."""
    content = ranks or read_ranks()
    columns = [c for c in (keep if keep is not None else df.columns) if c != out]
    df = df.select(*dict.fromkeys([*columns, text]))
    result = df.select(*columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(content, pattern)
        for b in slices(batches):
            ids, at = pieces.encode([t or "" for t in b.column(text).to_pylist()])
            lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids))
            yield _with_column(b.select(columns), out, lists)

    return df.mapInArrow(run, _schema(result, out, "array<int>"))


def decode(df: DataFrame, ranks: bytes | None = None, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add ``out`` (binary), the bytes of the tokens in ``ids``; null ids give no bytes."""
    content = ranks or read_ranks()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = pieces_of(content, public_tokenizers.PATTERN).v.bytes_of.__getitem__
        for b in slices(batches):
            col = b.column(ids).fill_null([])
            flat, at = col.values.to_numpy(zero_copy_only=False), col.offsets.to_numpy()
            rows = [b"".join(map(token, flat[i:j].tolist())) for i, j in zip(at[:-1].tolist(), at[1:].tolist())]
            yield _with_column(b, out, pa.array(rows, type=pa.binary()))

    return df.mapInArrow(run, _schema(df, out, "binary"))
