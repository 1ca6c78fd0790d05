"""Best-fit packing of token sequences by linear grouping.

The number of distinct piece lengths is bounded by the sequence length, so the packing is
planned from the histogram of lengths alone, whatever the number of documents:

1. large lengths are sorted, cut into groups of equal cardinality and rounded up to the
   largest of their group, which leaves few sizes;
2. the best mix of configurations (sets of sizes that fill one sequence) for these few sizes
   is the optimum of the covering linear program, solved by column generation with a knapsack
   as pricing step; whole multiples of each configuration are taken, the rest is best-fit;
3. the actual documents of each group, longest first, take the places of their rounded size,
   which splits every configuration into runs of sequences with equal true lengths;
4. what is left of each sequence is filled by the small lengths, longest first, each into the
   tightest run that holds it; when none does, new sequences are opened.

The plan is a table of runs ``(length, first rank, sequence, offset)``. Spark ranks the pieces
within their length (by salted buckets, so no length is numbered in one task) and each piece
reads its place from the plan. The plan's size depends on the sequence length only.

Defined results: null and empty texts are one piece holding the end id alone; repeated rows
are packed as separate pieces; an empty table gives an empty table.
"""

from __future__ import annotations

import bisect
import re
from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .bpe import Pieces, cut_words
from .common import materialize, slices

SEQUENCE = 4096
END = 1
LARGE_PART = 4      # lengths above SEQUENCE / LARGE_PART are large
GROUPS = (8, 16, 32)  # groups of large lengths; the plan with the fewest sequences is taken
RANK_ROWS = 5_000   # pieces numbered in one bucket of the ranking, about

# --------------------------------------------------------------------------- tokens

#: Other characters make their word *odd*: it is given to the tokenizer as a whole. Up to U+02FF every
#: word is composed already, lower-casing goes by character and white space separates words.
_ODD = "[^\t-\r -\x84\x86-\u02ff]"
_ANY_ODD = re.compile(_ODD)
_ODD_RUN = re.compile(rf"[^\t-\r ]*{_ODD}[^\t-\r ]*")
_SPECIAL = re.compile(r"<\|")
_PIECE = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"  # the file's own, lower case
TABLE_BITS = 21     # places of a worker's table of words
ODD_WORDS = 50_000  # odd words whose ids a worker holds; emptied when there are more

_MARKS = np.zeros(256, dtype=bool)  # punctuation that is a piece of its own behind a letter or digit
_MARKS[list(b".,;:!?")] = True
_PLAIN_END = np.zeros(256, dtype=bool)
_PLAIN_END[48:58] = _PLAIN_END[97:123] = True


def _byte_characters() -> dict[int, str]:
    """The characters that stand for bytes in the file: printable ones for themselves, the
    others for 256, 257, ... in order."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    other = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(other)}


def _cut_marks(data: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words without the punctuation that ends them, and this punctuation: starts and ends."""
    a, b = cut_words(data, first, last)
    if not len(a):
        return a, b
    before = np.where(_MARKS[data], -1, np.arange(len(data)))  # the last byte that is no mark
    end = np.maximum.accumulate(before)[b - 1] + 1
    two = (end > a) & (end < b) & _PLAIN_END[data[end - 1]]
    at = np.arange(len(a)) + np.cumsum(two) - two
    starts, ends = np.empty(len(a) + int(two.sum()), np.int64), np.empty(len(a) + int(two.sum()), np.int64)
    starts[at], ends[at] = a, np.where(two, end, b)
    starts[at[two] + 1], ends[at[two] + 1] = end[two], b[two]
    return starts, ends


class _Table(Pieces):
    """Words met so far and their ids, from the tokenizer's own model."""

    def __init__(self, model) -> None:
        self.tokenize, self.characters = model.tokenize, _byte_characters()
        super().__init__(None, _PIECE, _cut_marks, whole=False, bits=TABLE_BITS)

    def _ids(self, piece: str) -> list[int]:
        if not (piece.isascii() and piece.isprintable()):
            piece = piece.encode().decode("latin-1").translate(self.characters)
        return [t.id for t in self.tokenize(piece)]

    def _encode_chunks(self, chunks: list[bytes]) -> list[bytes]:
        out = []
        for raw in chunks:
            chunk = raw.decode()
            parts = [chunk] if chunk.isalpha() else self.find(chunk)
            out.append(array("I", [i for p in parts for i in self._ids(p)]).tobytes())
        return out


class Words:
    """The tokenizer's ids of texts (little-endian uint32).

    Texts are lower-cased and cut at white space, and each word is encoded once by the tokenizer's model.
    Odd words are given to the tokenizer with its own normalizer; texts with a special token whole.
    """

    def __init__(self, content: str) -> None:
        self.t = Tokenizer.from_str(content)
        self.table = _Table(self.t.model)
        self.odd: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return array("I", self.t.encode(text, add_special_tokens=False).ids).tobytes()

    def _odd(self, word: str) -> bytes:
        ids = self.odd.get(word)
        if ids is None:
            if len(self.odd) >= ODD_WORDS:
                self.odd.clear()
            ids = self.whole(word)
            if len(word) <= 64:
                self.odd[word] = ids
        return ids

    def ids(self, texts: list[str]) -> list[bytes]:
        flat: list[str] = []    # plain texts, and what stands between odd words
        parts: list = []        # per text: bytes, a place in flat, or a list of these
        for t in texts:
            if _SPECIAL.search(t):
                parts.append(self.whole(t))
                continue
            row, at = [], 0
            for m in _ODD_RUN.finditer(t) if _ANY_ODD.search(t) else ():
                row += [len(flat), self._odd(m[0])]
                flat.append(t[at:m.start()].lower())
                at = m.end()
            parts.append([*row, len(flat)] if row else len(flat))
            flat.append((t[at:] if at else t).lower())
        ids, at = self.table.encode(flat)
        data, at = ids.tobytes(), (4 * at).tolist()
        read = lambda x: x if x.__class__ is bytes else data[at[x]:at[x + 1]]
        return [b"".join(map(read, p)) if p.__class__ is list else read(p) for p in parts]


_held: dict[int, Words] = {}


def _words(content: str) -> Words:
    key = hash(content)
    if key not in _held:
        _held.clear()
        _held[key] = Words(content)
    return _held[key]


def read_tokenizer(path: str | None = None) -> str:
    """The tokenizer file's content (read on the driver, shipped with the job; under 2 MB)."""
    with open(path or public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        return f.read()


PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids binary"


def token_pieces(docs: DataFrame, tokenizer: str | None = None, limit: int = SEQUENCE,
                 end: int = END) -> DataFrame:
    """Tokenize ``docs(doc_id, text)``, append ``end`` and cut into pieces of ``limit`` ids.

    Returns ``doc_id, piece, start, length, ids`` (ids as little-endian uint32 bytes).
    """
    content = tokenizer or read_tokenizer()
    tail = array("I", [end]).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _words(content)
        for b in slices(batches):
            rows: list[tuple] = []
            found = words.ids([t or "" for t in b.column(1).to_pylist()])
            for i, ids in zip(b.column(0).to_pylist(), found):
                ids += tail
                for k, at in enumerate(range(0, len(ids), 4 * limit)):
                    part = ids[at:at + 4 * limit]
                    rows.append((i, k, at // 4, len(part) // 4, part))
            cols = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int64()),
                 pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.binary())],
                names=["doc_id", "piece", "start", "length", "ids"])

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, PIECES)


# --------------------------------------------------------------------------- plan

def configurations(sizes: list[int], need: np.ndarray, limit: int) -> list[tuple[np.ndarray, float]]:
    """Optimal fractional mix of configurations: ``[(count per size, how many), ...]``.

    Minimises the number of sequences that cover ``need`` items of each size (linear program
    over all configurations, by column generation; the knapsack finds the best new one).
    """
    k = len(sizes)
    w = np.array(sizes)
    basis = np.zeros((k, k))
    for i, s in enumerate(sizes):
        basis[i, i] = limit // s
    amount = need / basis.diagonal()
    for _ in range(60 * k + 200):
        price = np.linalg.solve(basis.T, np.ones(k))
        best = np.zeros(limit + 1)
        take = np.full(limit + 1, -1)
        worth = np.flatnonzero(price > 1e-12)
        lo = int(w[worth].min()) if len(worth) else limit + 1
        wl, pl = w[worth], price[worth]
        for c in range(lo, limit + 1):
            fits = wl <= c
            value = best[c - wl[fits]] + pl[fits]
            j = int(value.argmax())
            if value[j] > best[c - 1] + 1e-15:
                best[c], take[c] = value[j], worth[fits][j]
            else:
                best[c] = best[c - 1]
        if best[limit] <= 1 + 1e-9:
            break
        column, c = np.zeros(k), limit
        while c >= lo and best[c] > 0:
            if take[c] < 0:
                c -= 1
                continue
            column[take[c]] += 1
            c -= w[take[c]]
        step = np.linalg.solve(basis, column)
        ratio = np.where(step > 1e-9, amount / np.where(step > 1e-9, step, 1), np.inf)
        out = int(ratio.argmin())
        by = ratio[out]
        amount = np.maximum(amount - by * step, 0)
        amount[out] = by
        basis[:, out] = column
    return [(basis[:, i].round().astype(int), float(amount[i])) for i in range(k)]


class _Queue:
    """Items of one group, longest first, as runs of equal lengths with consecutive ranks."""

    def __init__(self, runs: list[tuple[int, int, int]]) -> None:
        self.runs = [list(r) for r in runs]  # [length, first rank, count]
        self.left = sum(r[2] for r in runs)

    def head(self) -> list[int]:
        return self.runs[0]

    def take(self, n: int) -> tuple[int, int]:
        r = self.runs[0]
        first = r[1]
        r[1] += n
        r[2] -= n
        self.left -= n
        if not r[2]:
            self.runs.pop(0)
        return r[0], first


class Plan:
    """Runs of items in runs of sequences; :meth:`place` reads a piece's sequence and offset."""

    def __init__(self, limit: int) -> None:
        self.limit, self.sequences = limit, 0
        self.rows: dict[int, list[tuple[int, int, int]]] = {}
        self.gaps: dict[int, list[list[int]]] = {}  # free room -> [[first sequence, count], ...]
        self.rooms: list[int] = []                  # sorted keys of gaps

    def open(self, n: int) -> int:
        first = self.sequences
        self.sequences += n
        return first

    def put(self, length: int, rank: int, first: int, offset: int) -> None:
        self.rows.setdefault(length, []).append((rank, first, offset))

    def leave(self, room: int, first: int, n: int) -> None:
        if room > 0 and n > 0:
            if room not in self.gaps:
                self.gaps[room] = []
                bisect.insort(self.rooms, room)
            self.gaps[room].append([first, n])

    def best_fit(self, length: int, rank: int, count: int) -> None:
        """Place ``count`` items of one length: tightest run of sequences first."""
        while count:
            i = bisect.bisect_left(self.rooms, length)
            if i == len(self.rooms):
                each = self.limit // length
                n = max(1, count // each)
                self.leave(self.limit, self.open(n), n)
                continue
            room = self.rooms[i]
            first, n = self.gaps[room].pop()
            if not self.gaps[room]:
                del self.gaps[room], self.rooms[i]
            used = min(n, count)
            # leave the rest of the run as it was; several of a length go one after another
            self.leave(room, first + used, n - used)
            self.put(length, rank, first, self.limit - room)
            self.leave(room - length, first, used)
            rank += used
            count -= used

    def places(self) -> "Places":
        return Places([(n, *run) for n, runs in self.rows.items() for run in sorted(runs)])

    def place(self, length: int, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.places().find(np.full(len(rank), length), rank)


class Places:
    """The runs of a plan as arrays sorted by (length, first rank): what the tasks get."""

    def __init__(self, runs: list[tuple[int, int, int, int]]) -> None:
        table = np.array(sorted(runs), dtype=np.int64).reshape(-1, 4)
        self.length, self.rank, self.sequence, self.offset = np.ascontiguousarray(table.T)

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = lambda n, r: (n.astype(np.int64) << 48) | r  # noqa: E731 - lengths and ranks are below 2^15 and 2^48
        at = np.searchsorted(key(self.length, self.rank), key(length, rank), side="right") - 1
        return self.sequence[at] + rank - self.rank[at], self.offset[at]


def make_plan(histogram: dict[int, int], limit: int = SEQUENCE, groups: tuple[int, ...] = GROUPS) -> Plan:
    """Plan the packing of ``histogram[length]`` items of each length (ranks from 0)."""
    return min((_plan(histogram, limit, g) for g in groups), key=lambda p: p.sequences)


def _plan(histogram: dict[int, int], limit: int, groups: int) -> Plan:
    plan = Plan(limit)
    large = sorted((n for n in histogram if n * LARGE_PART > limit), reverse=True)
    total = sum(histogram[n] for n in large)
    each = max(1, -(-total // groups))
    parts: list[list[tuple[int, int, int]]] = []
    room = 0
    for n in large:  # equal cardinality: a length with many items may span groups
        at, left = 0, histogram[n]
        while left:
            if not room:
                parts.append([])
                room = each
            c = min(left, room)
            parts[-1].append((n, at, c))
            at, left, room = at + c, left - c, room - c
    merged: dict[int, list[tuple[int, int, int]]] = {}
    for p in parts:  # groups with one rounded size are one size of the program
        merged.setdefault(p[0][0], []).extend(p)
    sizes = sorted(merged, reverse=True)
    queues = [_Queue(merged[s]) for s in sizes]
    if sizes:
        mix = configurations(sizes, np.array([q.left for q in queues], dtype=float), limit)
        for column, amount in sorted(mix, key=lambda m: -m[1]):
            slots = [i for i, c in enumerate(column) for _ in range(c)]
            count = int(amount + 1e-6)
            for i in set(slots):
                count = min(count, queues[i].left // int(column[i]))
            while count > 0 and slots:  # a run ends where any slot's length changes
                n = count
                for i in set(slots):
                    n = min(n, max(1, queues[i].head()[2] // int(column[i])))
                first, offset, short = plan.open(n), 0, n
                if any(queues[i].head()[2] < int(column[i]) for i in set(slots)):
                    short = 1
                n = short
                plan.sequences = first + n
                for i in slots:
                    length, rank = queues[i].take(n)
                    plan.put(length, rank, first, offset)
                    offset += length
                plan.leave(limit - offset, first, n)
                count -= n
    for q in queues:  # what whole multiples left over, longest first
        while q.left:
            _, _, c = q.head()
            length, rank = q.take(c)
            plan.best_fit(length, rank, c)
    for n in sorted((n for n in histogram if n * LARGE_PART <= limit), reverse=True):
        plan.best_fit(n, 0, histogram[n])
    return plan


# --------------------------------------------------------------------------- Spark

def pack(pieces: DataFrame, limit: int = SEQUENCE, groups: tuple[int, ...] = GROUPS) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` (bigint) to ``pieces`` (with ``length`` 1..limit).

    Rows are numbered within their length. Rows without a stored number ``_row`` are written out
    with one first: it deals rows, equal ones too, to buckets, and makes the order total, so a
    task that is run again numbers its rows as before. Only the histogram of lengths (at
    most ``limit`` rows) reaches the driver, and the plan's arrays the tasks.
    """
    if "_row" not in pieces.columns:
        pieces = materialize(pieces.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    counts = {int(r["length"]): int(r["count"]) for r in pieces.groupBy("length").count().collect()}
    plan = make_plan(counts, limit, groups).places()
    salts = max(1, -(-sum(counts.values()) // RANK_ROWS))
    keyed = pieces.withColumn("_salt", F.pmod(F.xxhash64("_row"), F.lit(salts)))
    before = (keyed.groupBy("length", "_salt").agg(F.count(F.lit(1)).alias("_n"))
              .withColumn("_before", F.sum("_n").over(Window.partitionBy("length").orderBy("_salt")) - F.col("_n"))
              .drop("_n"))
    number = F.row_number().over(Window.partitionBy("_salt", "length").orderBy("_row"))
    ranked = (keyed.withColumn("_r", number - 1).join(before, ["_salt", "length"])
              .withColumn("_r", F.col("_r") + F.col("_before")).drop("_before", "_salt"))
    kept = [c for c in pieces.columns if c != "_row"]
    schema = pieces.drop("_row").withColumns({"sequence_id": F.lit(0).cast("bigint"), "offset": F.lit(0).cast("bigint")}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seq, off = plan.find(*(b.column(c).to_numpy(zero_copy_only=False) for c in ("length", "_r")))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), pa.array(seq), pa.array(off)],
                                             names=[*kept, "sequence_id", "offset"])

    return ranked.select(*kept, "_r").mapInArrow(run, schema)


def pack_documents(docs: DataFrame, tokenizer: str | None = None, limit: int = SEQUENCE) -> DataFrame:
    """Pieces of all documents with their places: ``doc_id, piece, start, length, ids_crc32,
    sequence_id, offset``. The ids stay behind; :func:`token_pieces` gives them."""
    cut = token_pieces(docs, tokenizer, limit)
    pieces = cut.withColumn("ids_crc32", F.crc32("ids")).drop("ids").withColumn("_row", F.monotonically_increasing_id())
    return pack(materialize(pieces, "pieces"), limit)
