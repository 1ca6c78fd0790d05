"""Terms of texts, and stated sets of items (benchmark rows) in bounded blocks.

Terms are runs of a-z, 0-9 and bytes above 0x7F after A-Z are lower-cased. Items are read one
block at a time, so neither the driver nor a task ever holds more of them than one block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame

from .words import Words

#: Bytes that are no part of a term.
BETWEEN = np.ones(256, dtype=bool)
BETWEEN[0x30:0x3A] = BETWEEN[0x41:0x5B] = BETWEEN[0x61:0x7B] = BETWEEN[0x80:] = False
_SIEVE_BITS = 20


def term_words(texts: list[bytes]) -> Words:
    return Words(texts, lower=True, between=BETWEEN)


def utf8(column) -> list[bytes]:
    """The texts of an Arrow column as UTF-8; null is empty."""
    return [b"" if t is None else t.encode("utf-8", "surrogatepass") for t in column.to_pylist()]


def item_blocks(items: DataFrame, id_col: str, text_col: str, words: int) -> Iterator[tuple[list, list[bytes]]]:
    """``(ids, texts)`` of consecutive items of at least ``words`` bytes / 4 together.

    Rows come to the driver partition by partition. A block ends once its texts reach
    ``4 * words`` bytes, which bounds what is shipped at once; only a single longer item makes a
    larger block. Items without any term are left out.
    """
    ids, texts, size = [], [], 0
    for r in items.select(items[id_col].alias("i"), items[text_col].alias("t")).toLocalIterator():
        t = (r["t"] or "").encode("utf-8", "surrogatepass")
        if not len(term_words([t]).hashes):
            continue
        ids.append(r["i"])
        texts.append(t)
        size += len(t)
        if size >= 4 * words:
            yield ids, texts
            ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


class Vocabulary:
    """Hashes of the distinct words of one block, numbered from 1 in hash order."""

    def __init__(self, hashes: np.ndarray) -> None:
        self.hashes = np.unique(hashes)
        self.sieve = np.zeros(1 << _SIEVE_BITS, dtype=bool)
        self.sieve[(self.hashes >> np.uint64(64 - _SIEVE_BITS)).astype(np.int64)] = True

    def __len__(self) -> int:
        return len(self.hashes)

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Number of each word, 0 for words outside."""
        out = np.zeros(len(hashes), dtype=np.int32)
        maybe = np.flatnonzero(self.sieve[(hashes >> np.uint64(64 - _SIEVE_BITS)).astype(np.int64)])
        if len(maybe) and len(self.hashes):
            h = hashes[maybe]
            at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
            out[maybe] = np.where(self.hashes[at] == h, at + 1, 0)
        return out
