"""Quality classifier by co-training.

Two classifiers see different views of a page. The text view has its words (hashed, presence)
and shape statistics of the text; the metadata view has source, language, stored length and
their combinations. Both are logistic regressions. In every round both score *all* unlabelled
rows, and each hands those it ranks highest and lowest (``HAND`` of each class's share) to the
other one as training rows, weighted by how sure it is. At the end both are calibrated,
a small logistic regression combines them, and all documents are scored. Three folds of the
labelled rows, none of them trained on, serve the sureness, the calibration and the combination.

A good document has quality 1 and is not toxic. Features of all documents are written once, without
texts. Labelled rows are a bounded sample (about ``labelled`` rows and ``SAMPLE_BYTES`` of word
numbers), which the driver holds. Unlabelled rows never leave the tasks: a pass over them
returns histograms of the two scores (which give the ranks) or, for the rows handed over, the
gradient and curvature of the other view's loss, summed over tasks in a tree. Between passes the driver
minimises the labelled loss plus the quadratic model of the rest. What reaches the driver
does not depend on the number of documents.

Defined results: null texts are empty; missing metadata is a value of its own; label rows
without quality are ignored, several for one id count as bad if one is; without labels of both
kinds every document is kept and its score is the share of good labels (1.0 if none); rows
may repeat or have no id; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, return_memory, slices
from .words import U64, Words, batches

LABELLED = 8000
SAMPLE_BYTES = 48 << 20  # of the labelled rows' word numbers on the driver, about
ROUNDS = 3
PASSES = 2           # passes over the rows handed over in each round
HAND = 0.1           # share of the unlabelled rows that a view hands over, dealt to the classes by their shares
PSEUDO = 0.5         # weight of all rows handed over against that of all labelled ones
GRID = 4096          # places of the histogram of scores
SHAPES = 11          # shape statistics
SHAPE_GRID = 8192    # places of their histograms
FOLDS = 12           # labelled rows of folds 0, 1, 2 are not trained on
TREE = 16            # partial sums that reach the driver
KEEP = 0.4           # a document is kept from this score on
WORD_BITS = 18
META_BITS = 12
META = 5             # metadata numbers of a row
BINS = 24            # most bins of a shape statistic
WORD_RIDGE, SHAPE_RIDGE, META_RIDGE = 2e-3, 5e-5, 1e-3
MIN_ROWS, MIN_SHARE = 4, 3e-4  # rows, and share of all rows, in which a word must occur

_CLASS = np.zeros(256, dtype=np.uint8)  # 0 other
_CLASS[97:123] = 1
_CLASS[128:] = 1
_CLASS[65:91] = 2
_CLASS[48:58] = 3
_CLASS[[9, 10, 11, 12, 13, 32]] = 4
_CLASS[[ord(c) for c in ".,;:'\"?()-"]] = 5
_CLASS[ord("!")] = 6
_CLASS[ord("|")] = 7
_PLAIN = bytes(b if _CLASS[b] in (1, 2, 4) else 32 for b in range(256))


def text_features(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For groups of texts: row numbers and word numbers (distinct per row), and shape rows."""
    for _, group in batches([t.encode() for t in texts]):
        n = len(group)
        w = Words([g.translate(_PLAIN) for g in group], lower=True)
        row = np.repeat(np.arange(n), np.diff(w.first))
        code = (row.astype(U64) << U64(WORD_BITS)) | (w.hashes & U64((1 << WORD_BITS) - 1))
        code, count = np.unique(code, return_counts=True)
        rows = (code >> U64(WORD_BITS)).astype(np.int64)
        top = np.zeros(n)
        np.maximum.at(top, rows, count)
        data = _CLASS[np.frombuffer(b" ".join(group) + b" ", dtype=np.uint8)]
        size = np.fromiter(map(len, group), dtype=np.float64, count=n)
        where = np.repeat(np.arange(n), size.astype(np.int64) + 1)
        kinds = np.bincount(where * 8 + data, minlength=8 * n).reshape(n, 8).astype(float)
        words = np.maximum(np.bincount(row, minlength=n), 1)
        lines = np.array([g.count(b"\n") + 1 for g in group])
        letters = kinds[:, 1] + kinds[:, 2] + 1
        shape = np.stack([np.log2(size + 1), kinds[:, 2] / letters, kinds[:, 3] / (size + 1), kinds[:, 0] / (size + 1),
                          kinds[:, 5] / (size + 1), kinds[:, 6] / words, kinds[:, 7] / words, top / words,
                          np.bincount(rows, minlength=n) / words, letters / words, words / lines], axis=1)
        yield rows, (code & U64((1 << WORD_BITS) - 1)).astype(np.int32), shape


def meta_features(source: list, lang: list, n_chars: list) -> np.ndarray:
    """Five hashed metadata numbers per row."""
    out = np.zeros((len(source), META), dtype=np.int32)
    for row, s, g, n in zip(out, source, lang, n_chars):
        size = -1 if n is None else int(n).bit_length()
        for k, v in enumerate((("s", s), ("l", g), ("n", size), ("sl", s, g), ("ln", g, size))):
            row[k] = xxhash.xxh64_intdigest(repr(v)) & ((1 << META_BITS) - 1)
    return out


class Logistic:
    """Logistic regression on rows of present columns, fitted by accelerated gradient steps."""

    def __init__(self, ridge: np.ndarray, steps: int = 200) -> None:
        self.w, self.b, self.ridge, self.steps = np.zeros(len(ridge)), 0.0, ridge, steps

    def raw(self, rows: np.ndarray, cols: np.ndarray, n: int) -> np.ndarray:
        return np.bincount(rows, weights=self.w[cols], minlength=n) + self.b

    def fit(self, rows: np.ndarray, cols: np.ndarray, y: np.ndarray, more: Sums | None = None) -> Logistic:
        """Balanced loss of the given rows, plus the quadratic model ``more`` of others around the present weights."""
        n, width = len(y), len(self.w)
        weight = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
        each = np.bincount(rows, minlength=n).max(initial=1) + 1.0
        # diagonal curvature as step size
        curve = np.bincount(cols, weights=(weight * 0.25)[rows], minlength=width) * np.sqrt(each) + self.ridge
        w0, b0 = self.w, self.b
        w, b = np.zeros(width), 0.0  # from the start each time: the steps end before the weights fit every row
        if more is not None:
            curve = curve + more.curve
        mw, mb, t = w.copy(), b, 1.0
        for _ in range(self.steps):
            z = np.bincount(rows, weights=mw[cols], minlength=n) + mb
            r = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y)
            g, gb = np.bincount(cols, weights=r[rows], minlength=width) + self.ridge * mw, r.sum()
            if more is not None:
                g, gb = g + more.grad + more.curve * (mw - w0), gb + more.bias + more.bias_curve * (mb - b0)
            w2, b2 = mw - g / curve, mb - gb
            t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
            mw, mb = w2 + (t - 1) / t2 * (w2 - w), b2 + (t - 1) / t2 * (b2 - b)
            w, b, t = w2, b2, t2
        self.w, self.b = w, b
        return self


class Sums:
    """Gradient and curvature of a view's loss over rows handed to it; additive."""

    def __init__(self, width: int) -> None:
        self.grad, self.curve, self.bias, self.bias_curve = np.zeros(width), np.zeros(width), 0.0, 0.0

    def add(self, model: Logistic, rows: np.ndarray, cols: np.ndarray, y: np.ndarray, weight: np.ndarray) -> None:
        n, width = len(y), len(self.grad)
        each = np.bincount(rows, minlength=n)
        r = weight * (1 / (1 + np.exp(-np.clip(model.raw(rows, cols, n), -30, 30))) - y)
        self.grad += np.bincount(cols, weights=r[rows], minlength=width)
        self.curve += np.bincount(cols, weights=(0.25 * weight * np.sqrt(each + 1))[rows], minlength=width)
        self.bias += float(r.sum())
        self.bias_curve += 0.25 * float(weight.sum())

    def array(self) -> np.ndarray:
        return np.concatenate([self.grad, self.curve, [self.bias, self.bias_curve]])

    @staticmethod
    def of(data: np.ndarray) -> Sums:
        out = Sums(len(data) // 2 - 1)
        out.grad, out.curve = data[:len(out.grad)].copy(), data[len(out.grad):-2].copy()
        out.bias, out.bias_curve = data[-2:].tolist()
        return out


def _newton(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Logistic regression on a few dense columns; labels count as one row less than certain (Platt)."""
    w = np.zeros(x.shape[1])
    good = (y == 1).sum()
    y = np.where(y == 1, (good + 1) / (good + 2), 1 / (len(y) - good + 2))
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + ridge * np.eye(len(w)),
                               x.T @ (p - y) + ridge * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _calibrated(raw: np.ndarray, ab: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(raw * ab[0] + ab[1], -30, 30)))


def _reliability(raw: np.ndarray, y: np.ndarray) -> float:
    """Square of 2 AUC - 1 of scores against labels, 0 below chance; ties count half."""
    order = np.argsort(raw, kind="stable")
    _, first, count = np.unique(raw[order], return_index=True, return_counts=True)
    rank = np.repeat(first + (count + 1) / 2, count)
    good = y[order] == 1
    n, m = int(good.sum()), int((~good).sum())
    return max(0.0, 2 * (rank[good].sum() - n * (n + 1) / 2) / (n * m) - 1) ** 2


class View:
    """One view's rows as (row, column) pairs."""

    def __init__(self, rows: np.ndarray, cols: np.ndarray, ridge: np.ndarray) -> None:
        order = np.argsort(rows, kind="stable")
        self.rows, self.cols, self.ridge = rows[order].astype(np.int32), cols[order].astype(np.int32), ridge

    def of(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        first, last = np.searchsorted(self.rows, which), np.searchsorted(self.rows, which, side="right")
        n = last - first
        at = np.repeat((first - np.cumsum(n) + n).astype(np.int32), n)
        at += np.arange(len(at), dtype=np.int32)
        return np.repeat(np.arange(len(which), dtype=np.int32), n), self.cols[at]


def _statistics(f: Features) -> np.ndarray:
    """Rows in which each word number occurs, and histograms of the shape statistics on a fixed grid."""
    _, cols, shapes, _ = f
    place = np.minimum((shapes / (1 + shapes) * SHAPE_GRID).astype(np.int64), SHAPE_GRID - 1) + np.arange(SHAPES) * SHAPE_GRID
    return np.concatenate([np.bincount(cols, minlength=1 << WORD_BITS), np.bincount(place.ravel(), minlength=SHAPES * SHAPE_GRID)])


def _edges(count: np.ndarray) -> np.ndarray:
    """Bin edges of a statistic: quantiles, closer in the upper tail, and those of the values above the least."""
    value = np.arange(SHAPE_GRID) / SHAPE_GRID
    value = value / (1 - value)
    some = np.flatnonzero(count)
    if not len(some):
        return np.zeros(0)

    def quantiles(n: np.ndarray, at: list[float]) -> np.ndarray:
        upto = np.cumsum(n)
        return value[np.minimum(np.searchsorted(upto, np.array(at) * upto[-1], side="left"), SHAPE_GRID - 1)]

    parts = [quantiles(count, [*np.arange(1, 12) / 12, 0.95, 0.98])]
    above = count.copy()
    above[some[0]] = 0
    if above.any():
        parts.append(quantiles(above, [1e-9, *np.arange(1, 8) / 8, 0.95]))
    return np.unique(np.concatenate(parts))


class Giver:
    """The two views as they are at a round's start: they decide which rows are handed over."""

    def __init__(self, weights: list[tuple[np.ndarray, float]], ab: list[np.ndarray], hands: list[HandOver]) -> None:
        self.weights, self.ab, self.hands = weights, ab, hands

    def choose(self, views: list[tuple[np.ndarray, np.ndarray]], n: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        raw = [np.bincount(r, weights=w[c], minlength=n) + b for (r, c), (w, b) in zip(views, self.weights)]
        return [h.choose(_calibrated(x, ab)) for x, ab, h in zip(raw, self.ab, self.hands)]


class HandOver:
    """Which unlabelled rows a view hands over in a round, as what, and with what weight."""

    def __init__(self, histogram: np.ndarray, good_share: float, reliability: float = 1.0, hand: float = HAND) -> None:
        """``histogram`` has the number of rows per place of the score grid; ``reliability`` is
        0 for a view that ranks labelled rows of its own at random and 1 for one that never errs."""
        count, total = histogram, histogram.sum()
        middle = GRID // 2  # a row is handed over as what it more likely is
        above = np.cumsum(count[::-1])[::-1]
        below = np.cumsum(count)
        # the places of the asked ranks belong in whole: a view with few different scores hands over more
        self.high = max(middle, int(np.searchsorted(-above, -round(hand * good_share * total), side="right")) - 1)
        self.low = min(middle, int(np.searchsorted(below, round(hand * (1 - good_share) * total), side="left")) + 1)
        # rows of a class weigh PSEUDO / 2 together if the view is certain of all and never errs, else less
        self.scale = np.array([0.5 * PSEUDO * reliability / max(n, 1) for n in (count[:self.low].sum(), count[self.high:].sum())])

    def choose(self, p: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows handed over, their labels and weights."""
        at = _place(p)
        which = np.flatnonzero((at < self.low) | (at >= self.high))
        y = (at[which] >= self.high).astype(int)
        return which, y, self.scale[y] * np.abs(2 * p[which] - 1)


def _place(p: np.ndarray) -> np.ndarray:
    return np.minimum((p * GRID).astype(np.int64), GRID - 1)


def _histogram(p: np.ndarray) -> np.ndarray:
    return np.bincount(_place(p), minlength=GRID).astype(float)


Features = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]  # row and number of words, shapes, metadata numbers


class Model:
    """Both classifiers with their calibration, and the combination.

    ``unlabelled(per_batch, width)`` applies a function of :data:`Features` that returns ``width``
    numbers to all batches of unlabelled rows and returns the sums.
    """

    share: float | None = None

    def __init__(self, words: tuple[np.ndarray, np.ndarray], shapes: np.ndarray, meta: np.ndarray, y: np.ndarray,
                 fold: np.ndarray, statistics: np.ndarray, n_rows: int, unlabelled=None, rounds: int = ROUNDS,
                 passes: int = PASSES) -> None:
        """Labelled rows with ``y`` 1 or 0; ``fold`` 0 is for sureness, 1 for calibration, 2 for the combination;
        ``statistics`` are the sums of :func:`_statistics` over all ``n_rows`` rows."""
        parts = [np.flatnonzero(fold == k) for k in range(3)]
        train = np.flatnonzero(fold > 2)
        self.handed: list[list[int]] = []
        if any(min((y[p] == 1).sum(), (y[p] == 0).sum()) == 0 for p in (train, *parts)):
            self.share = float(y.mean()) if len(y) else 1.0
            return
        rows, cols = words
        self.known = np.flatnonzero(statistics[:1 << WORD_BITS] >= max(MIN_ROWS, MIN_SHARE * n_rows))
        self.column = np.full(1 << WORD_BITS, -1, dtype=np.int32)
        self.column[self.known] = np.arange(len(self.known))
        self.edges = [_edges(h) for h in statistics[1 << WORD_BITS:].reshape(SHAPES, SHAPE_GRID)]
        views = [View(r, c, ridge) for (r, c), ridge in zip(self.columns((rows, cols, shapes, meta)), (
            np.repeat([WORD_RIDGE, SHAPE_RIDGE], [len(self.known), BINS * shapes.shape[1]]), np.full(1 << META_BITS, META_RIDGE)))]
        self.models = [Logistic(v.ridge).fit(*v.of(train), y[train]) for v in views]
        good = float(y.mean())
        for _ in range(rounds if unlabelled else 0):
            self.ab = self._platt(views, parts[0], y)
            trust = [_reliability(m.raw(*v.of(parts[0]), len(parts[0])), y[parts[0]]) for m, v in zip(self.models, views)]
            histograms = unlabelled(self._score_histograms, 2 * GRID).reshape(2, -1)
            hands = [HandOver(h, good, r) for h, r in zip(histograms, trust)]
            givers, width = self._givers(hands), [len(m.w) for m in self.models]
            for _ in range(passes):
                sums = unlabelled(self._gradients(givers), 2 + 2 * sum(width) + 4)
                self.handed.append([int(x) for x in sums[:2]])
                at = 2
                for k, (view, model) in enumerate(zip(views, self.models)):
                    more = Sums.of(sums[at:at + 2 * width[k] + 2])
                    at += 2 * width[k] + 2
                    self.models[k] = model.fit(*view.of(train), y[train], more)
        self.ab = self._platt(views, parts[1], y)
        last = parts[2]
        z = [np.stack([m.raw(*v.of(last), len(last)) * ab[0] + ab[1]], axis=1) for m, v, ab in zip(self.models, views, self.ab)]
        self.mixing = _newton(np.concatenate([*z, np.ones((len(last), 1))], axis=1), y[last], ridge=1e-2)

    def _platt(self, views: list[View], part: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        return [_newton(np.stack([m.raw(*v.of(part), len(part)), np.ones(len(part))], axis=1), y[part])
                for m, v in zip(self.models, views)]

    def columns(self, f: Features) -> list[tuple[np.ndarray, np.ndarray]]:
        """(row, column) pairs of both views."""
        rows, cols, shapes, meta = f
        c = self.column[cols]
        good = c >= 0
        srow, scol = self._binned(shapes)
        return [(np.concatenate([rows[good], srow]), np.concatenate([c[good], scol])),
                (np.repeat(np.arange(len(meta)), meta.shape[1]), meta.ravel())]

    def _score_histograms(self, f: Features) -> np.ndarray:
        n = len(f[3])
        return np.concatenate([_histogram(_calibrated(m.raw(*v, n), ab)) for m, v, ab in zip(self.models, self.columns(f), self.ab)])

    def _givers(self, hands: list[HandOver]) -> Giver:
        return Giver([(m.w.copy(), m.b) for m in self.models], self.ab, hands)

    def _gradients(self, givers: Giver):
        def run(f: Features) -> np.ndarray:
            views, n = self.columns(f), len(f[3])
            chosen = givers.choose(views, n)
            out = [np.array([float(len(c[0])) for c in chosen])]
            for k, (model, view) in enumerate(zip(self.models, views)):  # each view gets the other one's rows
                which, y, weight = chosen[1 - k]
                own = View(*view, model.ridge).of(which)
                sums = Sums(len(model.w))
                sums.add(model, *own, y, weight)
                out.append(sums.array())
            return np.concatenate(out)
        return run

    def _binned(self, shapes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cols = np.stack([np.searchsorted(e, shapes[:, k], side="right") + k * BINS + len(self.known)
                         for k, e in enumerate(self.edges)], axis=1)
        return np.repeat(np.arange(len(shapes)), cols.shape[1]), cols.ravel()

    def score(self, texts: list[str], meta: np.ndarray) -> np.ndarray:
        """Columns: text view, metadata view, combined."""
        if self.share is not None:
            return np.full((len(texts), 3), self.share)
        raw = []
        for rows, cols, shapes in text_features(texts):
            raw.append(self.models[0].raw(*self.columns((rows, cols, shapes, meta[:0]))[0], len(shapes)))
        z = [np.concatenate(raw) if raw else np.zeros(0),
             self.models[1].raw(np.repeat(np.arange(len(meta)), meta.shape[1]), meta.ravel(), len(meta))]
        z = [r * ab[0] + ab[1] for r, ab in zip(z, self.ab)]
        both = z[0] * self.mixing[0] + z[1] * self.mixing[1] + self.mixing[2]
        return 1 / (1 + np.exp(-np.clip(np.stack([*z, both], axis=1), -30, 30)))


_META = ("source", "lang", "n_chars")


def _with_meta(docs: DataFrame) -> list:
    """The metadata columns, null where the table lacks one."""
    kinds = {"source": "string", "lang": "string", "n_chars": "bigint"}
    return [(F.col(c) if c in docs.columns else F.lit(None)).cast(kinds[c]).alias(f"_{c}") for c in _META]


def _features(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(source, 500):
        words, shapes = [], []
        for rows, cols, shape in text_features([t or "" for t in b.column("text").to_pylist()]):
            at = np.searchsorted(rows, np.arange(len(shape) + 1))
            words += [cols[x:y].tobytes() for x, y in zip(at[:-1].tolist(), at[1:].tolist())]
            shapes += [s.tobytes() for s in shape]
        meta = meta_features(*(b.column(f"_{c}").to_pylist() for c in _META))
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), pa.array(words, pa.binary()), pa.array(shapes, pa.binary()),
             pa.array([m.tobytes() for m in meta], pa.binary())], names=["doc_id", "words", "shape", "meta"])


def _read(words: list[bytes], shape: list[bytes], meta: list[bytes]) -> Features:
    n = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) // 4
    return (np.repeat(np.arange(len(words)), n), np.frombuffer(b"".join(words), dtype=np.int32),
            np.frombuffer(b"".join(shape)).reshape(-1, SHAPES), np.frombuffer(b"".join(meta), dtype=np.int32).reshape(-1, META))


def summed(rows: DataFrame, per_batch, width: int) -> np.ndarray:
    """Sum of ``per_batch(features)`` over all rows: per task, then in ``TREE`` tasks, then here. What a task
    hands on has single precision (counts below 2^24 are exact)."""
    def partial(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for b in slices(source, 500):
            if b.num_rows:
                total += per_batch(_read(*(b.column(c).to_pylist() for c in ("words", "shape", "meta"))))
        yield pa.RecordBatch.from_arrays([pa.array([total.astype(np.float32).tobytes()], pa.binary())], names=["v"])

    def add(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for b in source:
            for v in b.column("v").to_pylist():
                total += np.frombuffer(v, dtype=np.float32 if len(v) == 4 * width else np.float64)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["v"])

    parts = rows.select("words", "shape", "meta").mapInArrow(partial, "v binary").repartition(TREE).mapInArrow(add, "v binary")
    last = parts.repartition(1).mapInArrow(add, "v binary").first()  # TREE rows meet in one task, one reaches the driver
    return np.zeros(width) if last is None else np.frombuffer(last["v"])  # no row for a table without partitions


def fit(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, rounds: int = ROUNDS) -> Model:
    """Fit on ``docs(doc_id, text, source, lang, n_chars)`` and ``labels(doc_id, quality, toxic)``."""
    known = (labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
             .agg(F.min((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)).cast("int").alias("y")))
    rows = (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", *_with_meta(docs))
            .mapInArrow(_features, "doc_id bigint, words binary, shape binary, meta binary"))
    # the same join at every size: the labels grow with the documents
    rows = materialize(rows.join(known.hint("merge"), "doc_id", "left"), "features")
    own, rest = rows.where("y is not null"), rows.where("y is null")
    n, size = own.agg(F.count(F.lit(1)), F.sum(F.octet_length("words"))).first()
    share = min(1.0, labelled / max(n, 1), SAMPLE_BYTES / max(size or 0, 1))
    place = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("quality")), F.lit(1 << 30))
    got = sorted(own.where(place < int(share * (1 << 30))).select("doc_id", "y", "words", "shape", "meta").collect())  # bounded sample
    statistics = summed(rows, _statistics, (1 << WORD_BITS) + SHAPES * SHAPE_GRID)
    word_rows, words, shapes, meta = _read(*([r[c] for r in got] for c in ("words", "shape", "meta")))
    fold = np.array([xxhash.xxh64_intdigest(str(r["doc_id"])) % FOLDS for r in got])
    y = np.array([r["y"] for r in got], dtype=int)
    del got
    model = Model((word_rows, words), shapes, meta, y, fold, statistics, rows.count(),
                  lambda per_batch, width: summed(rest, per_batch, width), rounds)
    return_memory()
    return model


_MADE = ("score_text", "score_meta", "score", "keep")


def score(docs: DataFrame, model: Model, keep: list[str] | None = None) -> DataFrame:
    """Add ``score_text, score_meta, score`` (probability of a good document) and ``keep``."""
    names = [c for c in (keep if keep is not None else docs.columns) if c not in _MADE]
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, k = held.value, len(names)
        for b in slices(source):
            meta = meta_features(*(b.column(k + 1 + j).to_pylist() for j in range(3)))
            p = m.score([t or "" for t in b.column(k).to_pylist()], meta)
            keeps = p[:, 2] >= KEEP if m.share is None else np.ones(len(p), dtype=bool)
            yield pa.RecordBatch.from_arrays([*(b.column(j) for j in range(k)), *(pa.array(np.ascontiguousarray(c)) for c in p.T),
                                              pa.array(keeps)], names=[*names, *_MADE])

    schema = docs.select(*names).withColumns({c: F.lit(0.0) for c in _MADE[:3]} | {"keep": F.lit(True)}).schema
    return docs.select(*names, F.col("text").alias("__llm_text"), *_with_meta(docs)).mapInArrow(run, schema)
