"""Benchmark decontamination and ranked search against plain versions."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from berthline.llm import decontaminate, ranked_search
from berthline.llm.terms import term_words

from .support import no_documents, odd_documents, prose

WORD = re.compile("[0-9a-z\x80-\U0010ffff]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return WORD.findall((text or "").translate(LOWER))


def _plain(docs, items, window):
    windows = {}
    for i, text in items:
        w = words_of(text)
        for at in range(len(w) - min(window, len(w)) + 1 if w else 0):
            windows.setdefault(tuple(w[at:at + window]), set()).add("" if i is None else str(i))
    out = []
    for doc_id, text in docs:
        w, hit, ids = words_of(text), set(), set()
        for n in {len(k) for k in windows}:
            for at in range(len(w) - n + 1):
                if (k := tuple(w[at:at + n])) in windows:
                    hit |= set(range(at, at + n))
                    ids |= windows[k]
        out.append((doc_id, len(w), len(hit), sorted(ids)))
    return sorted(out, key=repr)


def _found(df):
    return sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in df.collect()), key=repr)


def _planted(rng, n_docs=60):
    items = [(k, prose(rng, rng.randint(1, 30))) for k in range(12)] + [(None, "Solo"), (3, prose(rng, 12)), (20, None), (21, " . ")]
    items.append((22, items[0][1]))
    docs = []
    for d in range(n_docs):
        parts = [prose(rng, rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            own = words_of(rng.choice(items)[1])
            at = rng.randint(0, len(own))
            parts += ["-é! ".join(own[at:at + rng.randint(0, 14)]).upper(), prose(rng, rng.randint(0, 5))]
        docs.append((d, " ".join(parts)))
    docs += [docs[0], (5, docs[6][1] * 3), (None, items[1][1]), (99, ""), (98, None)]
    return docs, items


@pytest.mark.parametrize("window", [3, 10])
def test_hits_equal_a_plain_search(spark, monkeypatch, window):
    docs, items = _planted(random.Random(window))
    d = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    i = spark.createDataFrame(items, "item_id bigint, text string")
    expected = _plain(docs, items, window)
    assert any(r[2] for r in expected) and any(not r[2] for r in expected)
    assert _found(decontaminate.find_phrases(d, i, window)) == expected
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 40)
    monkeypatch.setattr(decontaminate, "SHARD_SYMBOLS", 50)
    assert _found(decontaminate.find_phrases(d, i, window)) == expected  # several blocks, small shards


def test_spans_and_cleaned_text(spark):
    d = spark.createDataFrame([(1, "été 😀 One-two THREE four! five six"), (2, "one two")], "doc_id bigint, text string")
    i = spark.createDataFrame([(7, "one two three"), (8, "Two, three four.")], "item_id int, text string")
    a, b = decontaminate.find_phrases(d, i, 3).orderBy("doc_id").collect()
    assert [s.asDict() for s in a["spans"]] == [{"word": 2, "word_end": 6, "start": 6, "end": 24}]
    assert a["cleaned"] == "été 😀 ! five six" and a["items"] == ["7", "8"]
    assert b["cleaned"] == "one two" and not b["spans"]


def test_index_ranks_ranges_and_positions():
    rng = np.random.default_rng(4)
    for n, top in ((1, 1), (40, 2), (700, 3), (5000, 40)):
        text = rng.integers(0, top + 1, n)
        text[0] = 0
        text = np.concatenate([text, [1], text[1:], np.full(200, 1)])
        index = decontaminate.ShardIndex(text, top)
        phrases = [[0] * (4 - k) + rng.integers(1, top + 1, k).tolist() for k in (1, 2, 3, 4) for _ in range(20)]
        low, high = index.search(np.array(phrases, dtype=np.int32))
        for p, a, b in zip(phrases, low, high):
            p = [x for x in p if x]
            at = [k for k in range(len(text) - len(p) + 1) if text[k:k + len(p)].tolist() == p]
            assert sorted(index.locate(np.arange(a, b)).tolist()) == at


def test_odd_documents_and_empty_tables(spark):
    docs = odd_documents(spark)
    items = spark.createDataFrame([(1, "a a"), (2, "日本語 текст"), (3, "")], "item_id bigint, text string").withColumn("found", F.lit(1))
    got = _found(decontaminate.find_phrases(docs, items, 10))
    assert got == _plain([(r["doc_id"], r["text"]) for r in docs.collect()], [(1, "a a"), (2, "日本語 текст")], 10)
    kept = decontaminate.find_phrases(docs, items, 10, keep=docs.columns)
    assert kept.count() == docs.count() and set(docs.columns) <= set(kept.columns)
    assert _found(decontaminate.find_phrases(no_documents(spark), items)) == []
    none = decontaminate.find_phrases(docs, items.limit(0))
    assert none.agg(F.sum("n_hit")).first()[0] == 0 and none.agg(F.sum("n_words")).first()[0] > 0


def test_terms_are_runs_of_letters_digits_and_other_bytes():
    w = term_words(["Aé-b2_c".encode(), b"", b"  x"])
    assert w.first.tolist() == [0, 3, 3, 4]
    assert w.hashes[0] == term_words(["aé".encode()]).hashes[0]


def _plain_ranking(docs, items, top=10):
    bags = [(i, Counter(words_of(t))) for i, t in docs]
    bags = [(i, b, sum(b.values())) for i, b in bags if b]
    n_docs, n_terms = len(bags), sum(n for *_, n in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    out = []
    for item, text in items:
        scored = []
        for i, b, n in bags:
            m = 25 + 75 * n * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * b[t] // (1000 * b[t] + 8 * m))
                    for t in words_of(text) if t in b)
            if s:
                scored.append((-s, i is None, i))
        out += [(item, k + 1, i, -s) for k, (s, _, i) in enumerate(sorted(scored)[:top])]
    return sorted(out, key=repr)


def _ranking(df):
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect()), key=repr)


@pytest.mark.parametrize("cells", [1 << 23, 1])
def test_ranking_equals_scoring_every_document(spark, monkeypatch, cells):
    monkeypatch.setattr(ranked_search, "CELLS", cells)
    docs, items = _planted(random.Random(31), 400)
    docs += [(1000 + k, docs[7][1]) for k in range(40)] + [(500, "t1"), (501, None)]  # ties and copies
    d = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    i = spark.createDataFrame(items, "item_id bigint, text string")
    expected = _plain_ranking(docs, items)
    assert _ranking(ranked_search.rank_documents(d, i)) == expected
    monkeypatch.setattr(ranked_search, "BLOCK_WORDS", 30)
    assert _ranking(ranked_search.rank_documents(d, i)) == expected  # several blocks of items


def test_bounds_hold_and_leave_nodes_out():
    rng = np.random.default_rng(8)
    width, rows = 60, 900
    weights = rng.integers(0, 8000, width)
    paths = [np.unique(np.minimum(rng.geometric(0.08, rng.integers(1, 30)), width) - 1) for _ in range(rows)]
    paths[5] = paths[9] = paths[700]
    counts = [rng.integers(1, 6, len(p)).astype(np.int32) for p in paths]
    m, ids = rng.integers(25, 400, rows), np.arange(rows)
    tree = ranked_search.Tree(paths, counts, m, ids, width)
    covered = sorted(k for own in tree.own for k in own.tolist())
    assert covered == list(range(rows)) and tree.high[tree.root] == rows
    for v in range(len(tree.low)):
        inside = tree.tf[tree.low[v]:tree.high[v]]
        assert (tree.most[v] == inside.max(axis=0)).all() and tree.least_m[v] == tree.m[tree.low[v]:tree.high[v]].min()
    opened = 0
    for _ in range(30):
        columns = rng.choice(width, 12, replace=False)
        best = ranked_search.Best(5)
        opened += ranked_search.search(tree, columns, weights[columns], best)
        scores = (ranked_search.gain(tree.tf[:, columns].astype(np.int64), tree.m[:, None]) * weights[columns]).sum(axis=1)
        assert best.rows == sorted((-int(s), int(i)) for s, i in zip(scores, tree.ids) if s > 0)[:5]
    assert opened < 30 * len(tree.low) / 2


def test_ranking_of_odd_and_empty_tables(spark):
    docs = odd_documents(spark)
    items = [(1, "a a one"), (2, "日本語 текст"), (3, ""), (1, "two words x"), (None, "one")]
    i = spark.createDataFrame(items, "item_id int, text string").withColumn("rank", F.lit("old"))
    plain = _plain_ranking([(r["doc_id"], r["text"]) for r in docs.collect()], items)
    assert _ranking(ranked_search.rank_documents(docs, i)) == plain
    assert _ranking(ranked_search.rank_documents(no_documents(spark), i)) == []
    assert _ranking(ranked_search.rank_documents(docs, i.limit(0))) == []
