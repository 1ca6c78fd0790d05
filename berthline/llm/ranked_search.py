"""Ranked lexical search over a document FP-tree with branch and bound.

Terms, weights and scores. Terms are those of :mod:`.terms`. ``N`` documents hold a term, ``L``
terms in all; a document has ``n`` terms, ``df`` documents hold a term, ``tf`` times each. A term
weighs ``w = floor(1000 ln((2N + 2) / (2df + 1)))``; a document has ``m = 100 - B + (B n N) div L``
with ``B = 75``; it scores the sum of ``w * ((10^9 tf) div (1000 tf + 8 m))`` over the terms of an
item, repeats included. Each item gets its ``top`` documents with scores above 0, equal scores by
ascending id. All but the logarithm is 64-bit integer arithmetic.

Method. Items are read in blocks of bounded size; a block's terms are its vocabulary. One pass
over the documents writes their vectors restricted to the vocabulary, from which ``N``, ``L`` and
``df`` are summed over all documents. Then a task builds one FP-tree after the other from its
vectors: terms in descending ``df``, so that vectors share paths from the root; paths without a
branch are one edge. Each node keeps, over the documents below it, the largest ``tf`` of each
term and the least ``m``. The score rises with ``tf`` and falls with ``m``, so these bound every
score below the node. Each item walks the tree depth first, best child first, leaves out nodes
whose bound is under its ``top``-th score so far, and scores subtrees of at most ``LEAF``
documents at once. That score is carried from tree to tree within a task. A task returns at most ``top``
rows per item; the best of all tasks are taken with a window whose partial limit runs before its shuffle.

Memory: a tree takes ``CELLS`` cells of documents times terms, whatever the table; the
vocabulary of a block is bounded by its ``BLOCK_WORDS``. Nothing is collected but one block of items and
``N``, ``L`` and the ``df`` of its terms.

Odd input: null and empty texts have no terms and never rank, nor do they count in ``N``;
equal rows are documents of their own and rank one after the other; a null id comes after all
others on equal scores; items without terms get no rows, items that share an id are ranked each
by itself; empty tables give no rows; extra columns are not read.
"""

from __future__ import annotations

import bisect
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, slices
from .terms import Vocabulary, item_blocks, term_words, utf8
from .words import batches

B = 75
BLOCK_WORDS = 1 << 14
CELLS = 1 << 23
LEAF = 8
_NO_ID = np.iinfo(np.int64).max


def _vectors(vocabulary: Vocabulary):
    """Per document its id, number of terms and restricted vector: terms and counts as packed int32."""
    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(source, 500):
            n, terms, counts = [], [], []
            for _, group in batches(utf8(b.column("text"))):
                words = term_words(group)
                number = vocabulary.numbers(words.hashes)
                inside = np.flatnonzero(number)
                doc = np.searchsorted(words.first, inside, side="right") - 1
                key, tf = np.unique(doc * (len(vocabulary) + 1) + number[inside], return_counts=True)
                doc, term = key // (len(vocabulary) + 1), (key % (len(vocabulary) + 1)).astype(np.int32)
                at = np.searchsorted(doc, np.arange(len(group) + 1)).tolist()
                tf = tf.astype(np.int32)
                n += np.diff(words.first).tolist()
                terms += [term[i:j].tobytes() for i, j in zip(at, at[1:])]
                counts += [tf[i:j].tobytes() for i, j in zip(at, at[1:])]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(terms, pa.binary()), pa.array(counts, pa.binary())],
                names=["doc_id", "n", "terms", "counts"])
    return run


def _frequencies(size: int):
    """Per task the number of documents of each term; term 0 counts documents, -1 their terms."""
    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, length = np.zeros(size + 1, dtype=np.int64), 0
        for b in source:
            n = np.asarray(b.column("n"))
            df[0] += int((n > 0).sum())
            length += int(n.sum())
            every = np.frombuffer(b"".join(b.column("terms").to_pylist()), dtype=np.int32)
            df += np.bincount(every, minlength=size + 1)
        term = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(term, -1).astype(np.int32)), pa.array(np.append(df[term], length))], names=["term", "n"])
    return run


def gain(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


class Corpus:
    """Counts over all documents, and what follows from them."""

    def __init__(self, documents: int, terms: int, df: np.ndarray) -> None:
        self.documents, self.terms = documents, terms
        self.weights = np.zeros(len(df), dtype=np.int64)
        for t in np.flatnonzero(df).tolist():
            self.weights[t] = math.floor(1000 * math.log((2 * documents + 2) / (2 * int(df[t]) + 1)))
        self.rank = np.zeros(len(df), dtype=np.int64)  # 0 for the most frequent term
        self.rank[np.lexsort((np.arange(len(df)), -df))] = np.arange(len(df))

    def length_part(self, n: np.ndarray) -> np.ndarray:
        if len(n) and int(n.max()) * B * self.documents >= 1 << 62:
            return np.array([100 - B + B * int(x) * self.documents // self.terms for x in n], dtype=np.int64)
        return 100 - B + (B * n * self.documents) // max(1, self.terms)


class Tree:
    """FP-tree of some documents; ``columns`` of its tables are terms by rank."""

    def __init__(self, paths: list[np.ndarray], counts: list[np.ndarray], m: np.ndarray, ids: np.ndarray, width: int) -> None:
        keys = [p.astype(">u4").tobytes() for p in paths]
        order = sorted(range(len(keys)), key=keys.__getitem__)
        self.m, self.ids = m[order], ids[order]
        self.tf = np.zeros((len(order), width), dtype=np.int32)
        for row, k in enumerate(order):
            self.tf[row, paths[k]] = counts[k]
        shared = [_shared(paths[a], paths[b]) for a, b in zip(order, order[1:])]
        self._grow([len(paths[k]) for k in order], shared)
        # tf maxima and m minima of every node from its children and own documents
        self.most = np.zeros((len(self.low), width), dtype=np.int32)
        self.least_m = np.zeros(len(self.low), dtype=np.int64)
        for v in range(len(self.low)):
            kids, own = self.kids[v], self.own[v]
            parts = ([self.most[kids].max(axis=0)] if len(kids) else []) + ([self.tf[own].max(axis=0)] if len(own) else [])
            self.most[v] = np.maximum.reduce(parts)
            self.least_m[v] = min([int(self.least_m[k]) for k in kids] + [int(self.m[k]) for k in own])

    def _grow(self, length: list[int], shared: list[int]) -> None:
        """Branching nodes as intervals of rows in path order, children before their parents. A
        node's own documents are those not below a child: their paths go on without a branch, or end here."""
        self.low: list[int] = []
        self.high: list[int] = []
        self.kids: list[np.ndarray] = []
        self.own: list[np.ndarray] = []
        stack: list[tuple[int, int, list[int], list[int]]] = [(0, 0, [], [])]  # depth, first row, children, own rows

        def close(high: int) -> int:
            _, low, kids, own = stack.pop()
            self.low.append(low)
            self.high.append(high)
            self.kids.append(np.array(kids, dtype=np.int64))
            self.own.append(np.array(own, dtype=np.int64))
            return len(self.low) - 1

        rows = len(length)
        for row in range(rows):
            before = shared[row - 1] if row else 0
            after = shared[row] if row + 1 < rows else 0
            if after > max(before, stack[-1][0]):  # a new node starts with this row
                stack.append((after, row, [], [row]))
            else:
                stack[-1][3].append(row)
            while stack[-1][0] > after:
                top_depth, low = stack[-1][0], stack[-1][1]
                closed = close(row + 1)
                if stack[-1][0] < after:
                    stack.append((after, low, [closed], []))
                else:
                    stack[-1][2].append(closed)
        self.root = close(rows)


def _shared(a: np.ndarray, b: np.ndarray) -> int:
    n = min(len(a), len(b))
    differ = a[:n] != b[:n]
    at = int(differ.argmax()) if n else 0
    return at if n and differ[at] else n


class Best:
    """The ``top`` best documents so far: highest score first, then smallest id."""

    def __init__(self, top: int) -> None:
        self.top, self.rows = top, []
        self.bar = 1  # the least score that can still enter

    def offer(self, scores: np.ndarray, ids: np.ndarray) -> None:
        good = np.flatnonzero(scores >= self.bar)
        for s, i in zip(scores[good].tolist(), ids[good].tolist()):
            if len(self.rows) < self.top or (-s, i) < self.rows[-1]:
                bisect.insort(self.rows, (-s, i))
                del self.rows[self.top:]
        if len(self.rows) == self.top:
            self.bar = -self.rows[-1][0]


def search(tree: Tree, columns: np.ndarray, weights: np.ndarray, best: Best) -> int:
    """Depth-first branch and bound of one item; returns the number of nodes it opened."""
    def bounds(most: np.ndarray, m: np.ndarray) -> np.ndarray:
        tf = most[:, columns].astype(np.int64)
        return (gain(tf, m[:, None]) * weights).sum(axis=1)

    opened = 0
    root = np.array([tree.root])
    todo = [(int(bounds(tree.most[root], tree.least_m[root])[0]), tree.root)]
    while todo:
        bound, v = todo.pop()
        if bound < best.bar:
            continue
        opened += 1
        low, high, kids = tree.low[v], tree.high[v], tree.kids[v]
        if high - low <= LEAF or not len(kids):
            best.offer(bounds(tree.tf[low:high], tree.m[low:high]), tree.ids[low:high])
            continue
        own = tree.own[v]
        if len(own):
            best.offer(bounds(tree.tf[own], tree.m[own]), tree.ids[own])
        below = bounds(tree.most[kids], tree.least_m[kids])
        for k in np.argsort(below, kind="stable").tolist():
            if below[k] >= best.bar:
                todo.append((int(below[k]), int(kids[k])))
    return opened


def _ranked(items: list[tuple[np.ndarray, np.ndarray]], corpus: Corpus, block: int, top: int):
    width = len(corpus.weights)
    rows = max(64, CELLS // width)

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(top) for _ in items]
        for b in slices(source, rows):
            terms, counts = b.column("terms").to_pylist(), b.column("counts").to_pylist()
            some = [k for k, t in enumerate(terms) if t]
            if not some:
                continue
            paths, tfs = [], []
            for k in some:
                path = corpus.rank[np.frombuffer(terms[k], dtype=np.int32)]
                order = np.argsort(path)
                paths.append(path[order])
                tfs.append(np.frombuffer(counts[k], dtype=np.int32)[order])
            m = corpus.length_part(np.asarray(b.column("n"))[some])
            ids = np.array([_NO_ID if i is None else i for i in b.column("doc_id").to_pylist()], dtype=np.int64)[some]
            tree = Tree(paths, tfs, m, ids, width)
            for (columns, weights), own in zip(items, best):
                search(tree, columns, weights, own)
        found = [(k, -s, None if i == _NO_ID else i) for k, own in enumerate(best) for s, i in own.rows]
        yield pa.RecordBatch.from_arrays(
            [pa.array([block] * len(found), pa.int64()), *[pa.array([f[c] for f in found], pa.int64()) for c in range(3)]],
            names=["block", "item", "score", "doc_id"])
    return run


def rank_documents(docs: DataFrame, items: DataFrame, top: int = 10) -> DataFrame:
    """``item_id, rank`` (from 1), ``doc_id, score`` of the ``top`` best documents of each item; see the module."""
    spark = docs.sparkSession
    texts = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"].alias("text"))
    kind = items.schema["item_id"].dataType
    out = None
    for block, (ids, item_texts) in enumerate(item_blocks(items, "item_id", "text", BLOCK_WORDS)):
        words = term_words(item_texts)
        vocabulary = Vocabulary(words.hashes)
        vectors = materialize(texts.mapInArrow(_vectors(vocabulary), "doc_id bigint, n bigint, terms binary, counts binary"),
                              "vectors")
        counts = vectors.mapInArrow(_frequencies(len(vocabulary)), "term int, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
        df, n_docs, n_terms = np.zeros(len(vocabulary) + 1, dtype=np.int64), 0, 0
        for r in counts.collect():  # at most one row per term of the block, and two
            if r["term"] > 0:
                df[r["term"]] = r["n"]
            elif r["term"] == 0:
                n_docs = r["n"]
            else:
                n_terms = r["n"]
        corpus = Corpus(n_docs, n_terms, df)
        number = vocabulary.numbers(words.hashes)
        own = [np.unique(number[words.first[k]:words.first[k + 1]], return_counts=True) for k in range(len(ids))]
        queries = [(corpus.rank[t], corpus.weights[t] * c) for t, c in own]
        rows = vectors.mapInArrow(_ranked(queries, corpus, block, top), "block bigint, item bigint, score bigint, doc_id bigint")
        names = spark.createDataFrame([(k, i) for k, i in enumerate(ids)], "item bigint, item_id " + kind.simpleString())
        first = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
        rows = rows.select("*", F.row_number().over(first).alias("rank")).where(F.col("rank") <= top)
        rows = rows.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")  # names: one block of items
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        return spark.createDataFrame([], f"item_id {kind.simpleString()}, rank int, doc_id bigint, score bigint")
    return out
