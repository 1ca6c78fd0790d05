"""Jaccard join, repeated passages, fingerprints and vectors against brute force."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from berthline.llm import embed_dedup, fingerprint, jaccard_join, queries, substring_dedup
from berthline.llm.common import Forest, components

from .support import SF_SMALL, documents, no_documents, odd_documents, prose, rows


def test_components_of_a_hub_a_chain_and_repeats(spark):
    edges = [(1, k) for k in range(2, 60)] + [(k, k + 1) for k in range(100, 160)] + [(200, 200), (201, 202), (202, 201)]
    got = dict(rows(components(spark.createDataFrame(edges, "u bigint, v bigint")), "node", "root"))
    assert {got[k] for k in range(1, 60)} == {1} and {got[k] for k in range(100, 161)} == {100}
    assert got[202] == 201 and 200 not in got
    assert components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def _jaccard(texts, num, den, n):
    sets = {}
    for i, t in texts:
        w = (t or "").encode().lower().split()
        grams = set(zip(*(w[k:] for k in range(n)))) if len(w) >= n else ({tuple(w)} if w else set())
        sets.setdefault(i, []).append(grams)
    f = Forest()
    ids = [i for i in sets if i is not None]
    inverted = defaultdict(set)
    for i in ids:
        for g in set().union(*sets[i]):
            inverted[g].add(i)
    for i in ids:
        f.find(i)
        for j in set().union(*(inverted[g] for s in sets[i] for g in s)) if sets[i] else ():
            if j < i and any(den * len(a & b) >= num * len(a | b) for a in sets[i] for b in sets[j] if a and b):
                f.union(i, j)
    out = Counter()
    for i, t in texts:
        w = (t or "").encode().lower().split()
        grams = set(zip(*(w[k:] for k in range(n)))) if len(w) >= n else ({tuple(w)} if w else set())
        out[i, len(grams), f.find(i) if i is not None else None] += 1
    return out


def _near_texts(rng, n):
    """Groups of texts with a few words changed, some around the threshold, and a shared passage."""
    out, passage = [], prose(rng, 60)
    for _ in range(n):
        base = prose(rng, rng.choice([3, 9, 12, 30, 120])).split()
        for _ in range(rng.randint(1, 6)):
            v = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                v[rng.randrange(len(v))] = rng.choice(["neu", "zwo", "tri"])
            out.append(" ".join(v) + (" " + passage if rng.random() < 0.2 else ""))
    rng.shuffle(out)
    return list(enumerate(out))


@pytest.mark.parametrize("num,den,n", [(90, 100, 3), (80, 100, 5), (50, 100, 1)])
@pytest.mark.parametrize("blocks", [(60_000, 512), (400, 5)])
def test_jaccard_join_equals_brute_force(spark, monkeypatch, num, den, n, blocks):
    monkeypatch.setattr(jaccard_join, "BLOCK_GRAMS", blocks[0])
    monkeypatch.setattr(jaccard_join, "BLOCK_ROWS", blocks[1])
    texts = _near_texts(random.Random(n), 60)
    docs = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(3)
    got = Counter(rows(jaccard_join.near_duplicates(docs, num, den, n), "doc_id", "n_shingles", "component_id"))
    assert got == _jaccard(texts, num, den, n)


def test_sets_that_may_be_linked_share_a_key():
    rng = np.random.default_rng(1)
    for num, den in ((90, 100), (80, 100)):
        grades = jaccard_join.Grades(num, den)
        for size in (5, 9, 10, 13, 20, 41, 97, 400):
            for _ in range(30):
                a = np.unique(rng.integers(0, 2**64, size, dtype=np.uint64))
                most = 0
                while den * (size - most - 1) >= num * size:  # drop only
                    most += 1
                b = np.sort(rng.permutation(a)[most:])
                often = rng.random(size) < rng.choice([0, 0.3, 0.6, 0.95])
                rare = lambda x: ~np.isin(x, a[often[:len(a)]])
                if most:
                    assert np.intersect1d(grades.keys(a, rare(a)), grades.keys(b, rare(b))).size


def test_few_documents_meet_by_a_shared_passage_alone():
    """Unlike sets that share a twentieth of their n-grams, which the sketch takes for rare."""
    rng, grades = np.random.default_rng(3), jaccard_join.Grades(80, 100)
    passage = rng.integers(0, 2**64, 200, dtype=np.uint64)
    shown = []
    for _ in range(60):
        g = np.unique(np.concatenate([passage, rng.integers(0, 2**64, 3800, dtype=np.uint64)]))
        shown.append(set(grades.keys(g, np.ones(len(g), dtype=bool)).tolist()))
    met = sum(bool(shown[i] & shown[j]) for i in range(60) for j in range(i))
    assert met <= 0.15 * 60 * 59 / 2


def test_sketch_counts_every_text_and_marks_shared_ngrams(spark):
    rng = random.Random(11)
    passage = prose(rng, 30)
    texts = [(i, prose(rng, 40) + " " + passage) for i in range(60)] + [(None, passage), (60, None), (61, "")]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(5)
    counted = jaccard_join.count_grams(docs, 5)
    got = Counter(rows(counted.where("part is null"), "doc_id", "n_shingles"))
    assert got == Counter((i, n) for (i, n, _), k in _jaccard(texts, 80, 100, 5).items() for _ in range(k))
    often = np.unpackbits(jaccard_join.frequent_grams(counted)).astype(bool)
    shared, = jaccard_join.gram_sets([passage.encode()], 5)
    alone, = jaccard_join.gram_sets([prose(rng, 2000).encode()], 5)
    assert often[jaccard_join._cells(shared)].all() and often[jaccard_join._cells(alone)].mean() < 0.01


def test_jaccard_join_odd_rows(spark):
    docs = odd_documents(spark)
    got = Counter(rows(jaccard_join.near_duplicates(docs), "doc_id", "n_shingles", "component_id"))
    assert got == _jaccard([(r["doc_id"], r["text"]) for r in docs.collect()], 90, 100, 3)
    assert jaccard_join.near_duplicates(no_documents(spark)).count() == 0


def _removed(texts, window):
    count = Counter()
    split = [(i, (t or "").encode().split()) for i, t in texts]
    for _, w in split:
        for k in range(len(w) - window + 1):
            count[tuple(w[k:k + window])] += 1
    out = Counter()
    for i, w in split:
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if count[tuple(w[k:k + window])] > 1:
                gone[k:k + window] = [True] * window
        out[i, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode()] += 1
    return out


@pytest.mark.parametrize("window,gram", [(35, 8), (6, 3), (5, 5), (4, 1)])
def test_repeated_passages_equal_brute_force(spark, window, gram):
    rng = random.Random(window)
    passages = [prose(rng, k) for k in (4, 8, 40, 60)]
    texts = []
    for i in range(60):
        parts = [prose(rng, rng.randint(0, 50))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages).split()
            a = rng.randint(0, len(p) // 2)
            parts += [" ".join(p[a:a + rng.randint(0, len(p))]), "la " * rng.choice([0, 3, 50])]
        texts.append((i, "\n".join(parts)))
    docs = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(4)
    got = substring_dedup.remove_repeated(docs, window, gram)
    assert Counter(rows(got, "doc_id", "n_words", "n_removed", "kept_text")) == _removed(texts, window)


def test_repeated_passages_odd_rows(spark):
    docs = odd_documents(spark)
    got = substring_dedup.remove_repeated(docs)
    assert Counter(rows(got, "doc_id", "n_words", "n_removed", "kept_text")) == _removed(
        [(r["doc_id"], r["text"]) for r in docs.collect()], 35)
    assert got.first()["row_id"] == "old row_id"
    assert substring_dedup.remove_repeated(no_documents(spark)).count() == 0


def _chunks(data):
    def gear(i):
        h = 0
        for k in range(max(0, i - 31), i + 1):
            h = (h << 1) + int(fingerprint._GEAR[data[k]])
        return h % 2**32
    out, p = [], 0
    while p < len(data):
        cut = min(p + fingerprint.LARGEST, len(data))
        for q in range(p + fingerprint.SMALLEST, cut + 1):
            bits = fingerprint.STRICT_BITS if q < p + fingerprint.NORMAL else fingerprint.LOOSE_BITS
            if gear(q - 1) >> (32 - bits) == 0:
                cut = q
                break
        out.append(data[p:cut])
        p = cut
    return out


def test_chunks_equal_a_plain_gear_hash():
    rng = random.Random(2)
    texts = [prose(rng, rng.randint(0, 200)).encode() for _ in range(25)] + [b"", b"a", b"a" * 1000]
    for t, p in zip(texts, fingerprint.fingerprints(texts)):
        chunks = set(_chunks(t))
        assert sorted(p[1].tolist()) == sorted(map(len, chunks))


def test_containment_equals_sets_of_plain_chunks():
    """Likeness of texts from the bytes of plainly cut chunks, without digests."""
    rng = random.Random(12)
    texts = [prose(rng, rng.randint(0, 250)) for _ in range(12)]
    texts += [texts[3][:len(texts[3]) // 2] + texts[4], texts[5] + texts[5], "", "x"]
    prints = fingerprint.fingerprints([t.encode() for t in texts])
    sets = [set(_chunks(t.encode())) for t in texts]
    for p, a in zip(prints, sets):
        for q, b in zip(prints, sets):
            want = sum(len(c) for c in a & b) / sum(map(len, a)) if a else float(not b)
            assert fingerprint.containment(p, q) == pytest.approx(want, abs=1e-12)


def test_fingerprints_resist_shifts():
    rng = random.Random(3)
    text = prose(rng, 3000)
    a, b, c = fingerprint.fingerprints([x.encode() for x in (text, "Some words before. " + text, prose(rng, 3000))])
    assert fingerprint.containment(a, b) > 0.97 and fingerprint.containment(a, c) < 0.1
    empty = fingerprint.fingerprints([b""])[0]
    assert fingerprint.containment(empty, empty) == 1 and fingerprint.containment(empty, a) == 0 == fingerprint.containment(a, empty)


def _check_edited(docs, got):
    key = lambda r: (r["doc_id"] is None, -(r["doc_id"] or 0), (r["text"] or "").encode() if r["text"] is not None else b"")
    order = sorted(docs, key=key)
    want = Counter()
    for r, after in zip(order, order[1:] + order[:1]):
        t, u = r["text"] or "", after["text"] or ""
        e = t[:len(t) - len(t) // 3] + u[:len(t) // 3]
        a, b, c = fingerprint.fingerprints([x.encode() for x in (t, e, u)])
        want[r["doc_id"], len(t), hashlib.sha256(e.encode()).hexdigest(), fingerprint.as_text(a), fingerprint.as_text(b),
             fingerprint.containment(a, b), fingerprint.containment(a, c)] += 1
    cols = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
    assert Counter(tuple(r[c] for c in cols) for r in got) == want


def test_fingerprint_query(spark):
    _check_edited(documents(spark).collect(), queries.op3_content_chunks(spark, SF_SMALL).collect())


def test_fingerprint_odd_rows(spark):
    docs = odd_documents(spark)
    _check_edited(docs.collect(), fingerprint.compare_with_edited(docs).collect())
    assert fingerprint.compare_with_edited(no_documents(spark)).count() == 0
    one = docs.where("doc_id = 8")
    _check_edited(one.collect(), fingerprint.compare_with_edited(one).collect())


def _vector_links(data, threshold):
    use = {}
    for i, v, label in data:
        ok = i is not None and label is not None and v and None not in v and all(map(math.isfinite, v)) and any(v)
        if ok:
            use[i] = (np.array(v, dtype=float) / max(map(abs, v)), label)
    f, n = Forest(), Counter()
    for i, (x, a) in use.items():
        for j, (y, b) in use.items():
            if j < i and a == b and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= threshold:
                f.union(i, j)
                n[i] += 1
                n[j] += 1
    return sorted((i, n[i], f.find(i) if i is not None else None, f.find(i) == i if i is not None else True)
                  for i in {d[0] for d in data} if i is not None)


def test_vectors_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embed_dedup, "BLOCK_ROWS", 7)
    rng = np.random.default_rng(4)
    data = []
    for g in range(30):
        base = rng.normal(size=32)
        for _ in range(int(rng.integers(1, 12))):
            data.append((len(data), (base + rng.normal(size=32) * rng.choice([0, 0.05, 0.2, 0.4])).tolist(), g % 3))
    data += [(len(data) + k, v, l) for k, (v, l) in enumerate([
        (None, 1), ([], 1), ([0.0] * 32, 1), ([1.0] + [None] * 31, 1), ([float("nan")] * 32, 1), ([float("inf")] * 32, 1),
        (data[0][1], None), (data[0][1][:16], 0), (data[0][1], 0), ([x * 1e300 for x in data[0][1]], 0)])]
    schema = "vec_id bigint, embedding array<double>, label int"
    df = spark.createDataFrame([*data, data[0], (None, data[0][1], 0)], schema).repartition(3)
    got = [r for r in rows(embed_dedup.near_vectors(df, 0.93), "vec_id", "n_links", "component_id", "kept")]
    assert sorted({r for r in got if r[0] is not None}) == _vector_links(data, 0.93)
    assert len(got) == len(data) + 2
    assert embed_dedup.near_vectors(df.limit(0)).count() == 0


def _at_cosine(rng, n, dim, cosine):
    x, y = rng.normal(size=(2, n, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y -= (x * y).sum(axis=1, keepdims=True) * x
    return x, cosine * x + math.sqrt(1 - cosine ** 2) * y / np.linalg.norm(y, axis=1, keepdims=True)


@pytest.mark.parametrize("joined", [1, 2, 3, 4])
def test_pairs_at_the_threshold_meet_with_any_number_of_rotations(joined):
    x, y = _at_cosine(np.random.default_rng(8), 4000, 64, 0.93)
    tables = embed_dedup.tables_for(joined, 64, 0.93)
    a, b = (embed_dedup.buckets(v, tables, joined, embed_dedup.PROBES) for v in (x, y))
    met = np.mean([bool(set(p) & set(q)) for p, q in zip(a.tolist(), b.tolist())])
    assert met >= 0.999


@pytest.mark.parametrize("joined", [2, 3, 4])
def test_links_at_the_threshold_with_more_rotations(spark, joined):
    x, y = _at_cosine(np.random.default_rng(9), 400, 64, 0.9301)
    data = [(k, v.tolist(), 0) for k, v in enumerate(np.concatenate([x, y]))]
    df = spark.createDataFrame(data, "vec_id bigint, embedding array<double>, label int")
    got = rows(embed_dedup.near_vectors(df, 0.93, joined=joined), "vec_id", "n_links", "component_id", "kept")
    assert sorted(got) == _vector_links(data, 0.93)


@pytest.mark.parametrize("window", [8, 35])
def test_factors_point_at_equal_words_and_cover_every_repeated_window(spark, window):
    """The parse itself: every factor's words stand at its source too (somewhere else), factors are a
    window long at least, and what they cover is exactly what brute force removes."""
    rng = random.Random(window)
    shared = [prose(rng, rng.randint(window - 3, 4 * window)) for _ in range(6)]
    texts = []
    for i in range(40):
        parts = [prose(rng, rng.randint(0, 50))]
        for _ in range(rng.randint(0, 3)):
            w = rng.choice(shared).split()
            at = rng.randint(0, max(0, len(w) - window))
            parts += [" ".join(w[at:]), prose(rng, rng.randint(0, 30))]
        texts.append((i, " ".join(parts)))
    texts += [(100, texts[3][1]), (101, texts[3][1] + " " + texts[4][1])]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(3)
    got = substring_dedup.remove_repeated(docs, window, 4, factors=True).collect()
    words = {i: t.split() for i, t in texts}
    longest = 0
    removed = {i: n for i, _, n, _ in _removed(texts, window)}
    for r in got:
        covered, last = set(), -1
        for f in r["factors"]:
            own = words[r["doc_id"]][f["start"]:f["start"] + f["words"]]
            assert f["words"] >= window and f["start"] >= last
            assert own == words[f["source_id"]][f["source_start"]:f["source_start"] + f["words"]]
            assert (f["source_id"], f["source_start"]) != (r["doc_id"], f["start"])
            covered |= set(range(f["start"], f["start"] + f["words"]))
            longest, last = max(longest, f["words"]), f["start"]
        assert len(covered) == r["n_removed"] == removed[r["doc_id"]]
    assert longest >= 3 * window // 2


def test_ranges_of_equal_rows_do_not_grow_with_their_number(spark):
    """One row of 60 words repeated 400 times: the span list of the text has its few ranges only once."""
    text = prose(random.Random(5), 60)
    docs = spark.createDataFrame([(1, text)] * 400 + [(2, "short")], "doc_id bigint, text string").repartition(4)
    rows_ = docs.selectExpr("doc_id row_id", "xxhash64(doc_id, text) row_key", "text")
    spans = substring_dedup.repeated_windows(rows_, 35).select("row_key", "lo", "n").distinct()
    assert spans.count() <= len(text.split())
    got = substring_dedup.remove_repeated(docs, 35)
    assert got.where("n_removed = 60").count() == 400


def test_vectors_with_clashing_columns_and_of_any_precision(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=64)
    exact = base.astype(np.float32).astype(float).tolist()
    rows = [(1, exact, "a"), (2, [x + 1e-9 for x in exact], "a"), (3, (-base).tolist(), "a"), (4, base.tolist(), "a"), (5, exact, "b")]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label string")
    for c in ("rep", "many", "v", "codes", "code", "lo", "hi", "blk", "root", "node", "links", "digest", "dim"):
        df = df.withColumn(c, F.lit("old"))
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embed_dedup.near_vectors(df).collect()}
    assert got == {1: (2, 1), 2: (2, 1), 3: (0, 3), 4: (2, 1), 5: (0, 5)}


def test_first_shared_code_equals_sets():
    rng = np.random.default_rng(6)
    codes = rng.integers(0, 5, (200, 4, 3)) * 4 + np.arange(4)[None, :, None]
    i, j = rng.integers(0, 200, (2, 3000))
    want = [min(set(codes[a].ravel()) & set(codes[b].ravel()), default=np.iinfo(np.int64).max) for a, b in zip(i, j)]
    assert embed_dedup._first_shared(codes, i, j).tolist() == want
