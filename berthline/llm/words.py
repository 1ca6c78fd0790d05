"""Words and word hashes of many texts at once.

Words are runs of bytes other than blank and the control characters 9 to 13, on UTF-8; none of
these bytes is part of a longer character. Hashes are 64-bit polynomials over a table of byte
values, computed for all words of a batch with array operations.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

U64 = np.uint64
BATCH_BYTES = 1 << 19  # texts are handled together up to this size; a longer one by itself


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    return _mixed(x + U64(0x9E3779B97F4A7C15))


_BASE = 0x5851F42D4C957F2D          # odd, 5 modulo 8
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
_EXACT = mix(np.arange(1, 257, dtype=U64) * U64(0xD1342543DE82EF95))
_LOWER = _EXACT.copy()
_LOWER[65:91] = _EXACT[97:123]
_powers: dict[int, np.ndarray] = {}


def _power_table(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** n modulo 2 ** 64."""
    known = _powers.get(base)
    if known is None or len(known) <= n:
        row = np.full(max(n, BATCH_BYTES) + 1, base & (2**64 - 1), dtype=U64)
        row[0] = 1
        known = np.multiply.accumulate(row)
        if n <= 4 * BATCH_BYTES:
            _powers[base] = known
    return known


_BASE_2 = 0x2545F4914F6CDD1D
_BASE_2_INVERSE = pow(_BASE_2, -1, 1 << 64)
_EXACT_2 = mix(np.arange(1, 257, dtype=U64) * U64(0x9FB21C651E98DF25))


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of the byte ranges."""
    out = []
    for values, base, inverse in ((_EXACT, _BASE, _BASE_INVERSE), (_EXACT_2, _BASE_2, _BASE_2_INVERSE)):
        sums = np.zeros(len(data) + 1, dtype=U64)
        np.cumsum(values[data] * _power_table(base, len(data))[:len(data)], out=sums[1:])
        raw = (sums[ends] - sums[starts]) * _power_table(inverse, len(data))[starts]
        out.append(mix(raw + (ends - starts).astype(U64)))
    return out[0], out[1]


class Words:
    """Words of a batch of texts: ``hashes``, byte ``starts`` and ``ends`` in ``blob``;
    text ``k`` has the words ``first[k]:first[k + 1]``. ``between`` marks the bytes that are no
    part of a word; a blank must be among them."""

    def __init__(self, texts: list[bytes], lower: bool = False, between: np.ndarray = SPACE) -> None:
        self.blob = blob = b" ".join(texts) + b" "
        data = np.frombuffer(blob, dtype=np.uint8)
        space = between[data]
        edge = np.flatnonzero(space[1:] != space[:-1]) + 1
        if len(data) and not space[0]:
            edge = np.concatenate([[0], edge])
        self.starts, self.ends = edge[0::2], edge[1::2]
        sums = np.zeros(len(data) + 1, dtype=U64)
        powers = _power_table(_BASE, len(data))
        np.cumsum((_LOWER if lower else _EXACT)[data] * powers[:len(data)], out=sums[1:])
        raw = (sums[self.ends] - sums[self.starts]) * _power_table(_BASE_INVERSE, len(data))[self.starts]
        self.hashes = mix(raw + (self.ends - self.starts).astype(U64) * U64(0xA24BAED4963EE407))
        sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)) + 1
        self.offsets = np.cumsum(sizes) - sizes
        self.first = np.searchsorted(self.starts, np.concatenate([self.offsets, [len(data)]]))


def batches(texts: list[bytes], limit: int = BATCH_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """Consecutive groups of texts of about ``limit`` bytes, each with its first position."""
    start, room, group = 0, limit, []
    for k, t in enumerate(texts):
        if group and len(t) > room:
            yield start, group
            start, room, group = k, limit, []
        group.append(t)
        room -= len(t) + 1
    if group:
        yield start, group
