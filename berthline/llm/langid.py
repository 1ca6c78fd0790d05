"""Language identification by a string kernel.

The kernel of two texts is the number of character n-grams (1 to 3) that both contain, presence
and not frequency, over the root of the product of their own numbers (blended spectrum). A
Nyström map with landmark texts turns it into features, on which one-versus-rest kernel ridge
regression is solved in closed form. Whole texts are scored in batches: presence matrix times
landmark matrix, times the regression matrix.

The model is fitted on a bounded sample, at most about ``rows_per_language`` labelled rows of
each language, chosen by a hash of the id; the held-out quarter is never read for it. Sample
rows travel as n-gram codes, never as texts.

Defined results: ``und`` with score 0 for texts that are null or have no letter, and for all
texts when there is nothing to learn from; ties go to the alphabetically first language; rows
without an id are scored and not learned from; an empty table gives an empty table.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

ROWS_PER_LANGUAGE = 1000
LANDMARKS = 128
RIDGE = 1e-3
SYMBOLS = 64
SIZES = (SYMBOLS, SYMBOLS ** 2, SYMBOLS ** 3)
CODES = sum(SIZES)
BATCH_ROWS = 48
BATCH_CHARS = 400_000
UNKNOWN = "und"


def _symbol(cp: int) -> int:
    """0 for what is no letter, 1 to 26 for a to z, one of 37 shared symbols for other letters."""
    if not unicodedata.category(chr(cp)).startswith("L"):
        return 0
    return cp - 96 if 97 <= cp <= 122 else 27 + (cp * 2654435761 % (1 << 32) >> 7) % 37


_tables: list[np.ndarray] = []


def _table() -> np.ndarray:
    if not _tables:
        _tables.append(np.array([_symbol(c) for c in range(0x3000)], dtype=np.uint8))
    return _tables[0]


def _symbols(text: str) -> np.ndarray:
    """The text's symbols in lower case, with runs of other characters as one 0."""
    cps = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype=np.uint32)
    table = _table()
    s = table[np.minimum(cps, len(table) - 1)]
    far = cps >= len(table)
    if far.any():
        codes, where = np.unique(cps[far], return_inverse=True)
        s[far] = np.array([_symbol(int(c)) for c in codes], dtype=np.uint8)[where]
    keep = s != 0
    keep[1:] |= s[:-1] != 0
    return s[keep]


def presence(texts: list[str]) -> np.ndarray:
    """Rows of 0 and 1: which n-gram codes each text contains."""
    out = np.zeros((len(texts), CODES), dtype=np.uint8)
    for row, t in zip(out, texts):
        if not t:
            continue
        s = _symbols(t).astype(np.int32)
        if not s.any():
            continue
        row[s] = 1
        two = s[:-1] * SYMBOLS + s[1:]
        row[two + SIZES[0]] = 1
        row[two[:-1] * SYMBOLS + s[2:] + SIZES[0] + SIZES[1]] = 1
        row[0] = 0
    return out


def _groups(texts: list[str]) -> Iterator[list[str]]:
    group, chars = [], 0
    for t in texts:
        if group and (len(group) == BATCH_ROWS or chars + len(t) > BATCH_CHARS):
            yield group
            group, chars = [], 0
        group.append(t)
        chars += len(t)
    if group:
        yield group


class Model:
    """Landmarks, their n-gram columns and the regression matrix."""

    def __init__(self, codes: list[np.ndarray], langs: list[str], landmarks: int = LANDMARKS,
                 ridge: float = RIDGE) -> None:
        self.langs = sorted(set(langs))
        if not self.langs:
            return
        y = np.array([self.langs.index(x) for x in langs])
        each = max(1, landmarks // len(self.langs))
        marks = np.concatenate([np.flatnonzero(y == k)[:each] for k in range(len(self.langs))])
        self.columns = np.unique(np.concatenate([codes[m] for m in marks]))
        where = np.full(CODES, -1, dtype=np.int32)
        where[self.columns] = np.arange(len(self.columns))

        def rows(which: np.ndarray) -> np.ndarray:
            out = np.zeros((len(which), len(self.columns)), dtype=np.float32)
            for r, k in zip(out, which):
                at = where[codes[k]]
                r[at[at >= 0]] = 1
            return out

        norm = np.sqrt(np.array([len(c) for c in codes], dtype=np.float64))
        self.marks = np.ascontiguousarray((rows(marks) / norm[marks][:, None]).T.astype(np.float32))
        km = np.concatenate([rows(marks[k:k + 256]) @ self.marks for k in range(0, len(marks), 256)]).astype(np.float64)
        km /= norm[marks][:, None]
        value, vector = np.linalg.eigh((km + km.T) / 2)
        good = value > value.max() * 1e-6
        to_features = vector[:, good] / np.sqrt(value[good])
        every = np.arange(len(codes))
        k = np.concatenate([rows(every[a:a + 256]) @ self.marks for a in range(0, len(every), 256)])
        phi = (k / norm[:, None]) @ to_features
        target = np.where(y[:, None] == np.arange(len(self.langs))[None, :], 1.0, -1.0)
        weight = 1.0 / np.bincount(y)[y]  # languages count alike
        a = phi.T @ (phi * weight[:, None]) + ridge / len(self.langs) * np.eye(phi.shape[1])
        self.weights = (to_features @ np.linalg.solve(a, phi.T @ (target * weight[:, None]))).astype(np.float32)
        score = phi @ np.linalg.solve(a, phi.T @ (target * weight[:, None]))
        self.scale = min((0.5, 1, 2, 3, 4, 6, 8, 12), key=lambda s: self._loss(score * s, y))

    @staticmethod
    def _loss(z: np.ndarray, y: np.ndarray) -> float:
        z = z - z.max(axis=1, keepdims=True)
        return float((np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(y)), y]).mean())

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        if not self.langs:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        names, scores = [], []
        for group in _groups(texts):
            x = presence(group)
            size = x.sum(axis=1, dtype=np.int64)
            kernel = x[:, self.columns].astype(np.float32) @ self.marks
            z = (kernel / np.sqrt(np.maximum(size, 1))[:, None]) @ self.weights * self.scale
            z = np.exp(z - z.max(axis=1, keepdims=True))
            p = z / z.sum(axis=1, keepdims=True)
            best = p.argmax(axis=1)
            names += [self.langs[b] if n else UNKNOWN for b, n in zip(best.tolist(), size.tolist())]
            scores += [float(p[k, b]) if n else 0.0 for k, (b, n) in enumerate(zip(best.tolist(), size.tolist()))]
        return names, scores


def held_out(doc_id: str = "doc_id"):
    """Whether a row belongs to the quarter that is never learned from."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def _codes(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(source, 200):
        texts = [t or "" for t in b.column(1).to_pylist()]
        found = [np.flatnonzero(r).astype(np.int32).tobytes() for g in _groups(texts) for r in presence(g)]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(found, pa.binary())],
                                         names=["lang", "place", "codes"])


def fit(docs: DataFrame, rows_per_language: int = ROWS_PER_LANGUAGE) -> Model:
    """Fit on ``docs(doc_id, text, lang)``; the caller leaves the held-out rows away."""
    known = docs.where("lang is not null and text is not null and doc_id is not null")
    counts = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    place = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("langid")), F.lit(1 << 30))
    share = F.lit(0)
    for lang, n in counts.items():  # a threshold on the hash for each language
        share = F.when(F.col("lang") == lang, int(min(1.0, rows_per_language / n) * (1 << 30))).otherwise(share)
    sample = known.where(place < share).select("lang", "text", place.alias("place"))
    got = sorted(((r["place"], r["lang"], r["codes"]) for r in
                  sample.mapInArrow(_codes, "lang string, place bigint, codes binary").collect()))
    rows = [(np.frombuffer(c, dtype=np.int32), lang) for _, lang, c in got if len(c)]
    return Model([c for c, _ in rows], [lang for _, lang in rows])


def predict(docs: DataFrame, model: Model, keep: list[str] | None = None) -> DataFrame:
    """Add ``lang_pred`` and ``score`` to ``docs``; ``keep`` names the columns carried along."""
    names = [c for c in (keep if keep is not None else docs.columns) if c not in ("lang_pred", "score")]
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        for b in slices(source):
            lang, score = m.predict([t or "" for t in b.column(b.num_columns - 1).to_pylist()])
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in range(len(names))), pa.array(lang, pa.string()),
                                              pa.array(score, pa.float64())], names=[*names, "lang_pred", "score"])

    schema = docs.select(*names).withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0)}).schema
    return docs.select(*names, F.col("text").alias("__llm_text")).mapInArrow(run, schema)
