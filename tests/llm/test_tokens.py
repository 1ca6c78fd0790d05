"""Byte-level BPE and packing against the tokenizer libraries and by their own invariants."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from berthline.llm import bpe, packing, queries

from .support import SF_SMALL, documents, no_documents, odd_documents, prose

ODD = "abc XYZ'sré \x1c\x1f\x85\n\t  12½²³一二가😀é̀ΣİLL'll're<|endoftext|>--==　​\x00﻿ß"


@pytest.fixture(scope="module")
def pieces():
    return bpe.pieces_of(bpe.read_ranks(), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library(pieces):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=pieces.v.ranks, special_tokens={})


def _ids(pieces, text):
    return pieces.encode([text])[0].tolist()


def test_encoding_equals_the_library_on_odd_texts(pieces, library):
    rng = random.Random(3)
    texts = ["".join(rng.choices(ODD, k=rng.randint(0, 40))) for _ in range(1500)]
    texts += ["", "a" * 4000, "ab" * 2000, " " * 3000, "\n" * 99, "é" * 900, prose(rng, 3000)]
    for t in texts:
        assert _ids(pieces, t) == library.encode_ordinary(t), t[:80]


def test_small_tables_and_many_texts_at_once(pieces, library, monkeypatch):
    monkeypatch.setattr(bpe, "TOGETHER_CHARS", 3000)
    monkeypatch.setattr(bpe, "STORE_IDS", 200)
    fresh = bpe.Pieces(pieces.v, public_tokenizers.PATTERN, bits=6)
    rng = random.Random(9)
    texts = [rng.choice(["", " ", " x", "\n\n ", prose(rng, 40), "".join(rng.choices(ODD, k=30)),
                         "".join(rng.choices("ab \n\t.", k=20))]) for _ in range(600)]
    ids, at = fresh.encode(texts)
    for t, a, b in zip(texts, at[:-1].tolist(), at[1:].tolist()):
        assert ids[a:b].tolist() == library.encode_ordinary(t), t


def test_appends_and_edits_equal_a_fresh_table(pieces):
    rng = random.Random(4)
    for _ in range(120):
        data = bytes(rng.choices(b"abcde the ing", k=rng.randint(0, 400)))
        i = rng.randint(0, len(data))
        j = rng.randint(i, min(len(data), i + 5))
        new = bytes(rng.choices(b"abcde ", k=rng.randint(0, 6)))
        e = bpe.PrefixEncoder(pieces.v, data)
        e.replace(i, j, new)
        fresh = bpe.PrefixEncoder(pieces.v, data[:i] + new + data[j:])
        assert e.last == fresh.last and e.ids() == fresh.ids()
        e.append(b"tion the")
        assert e.ids() == bpe.PrefixEncoder(pieces.v, e.data).ids()


def test_an_edit_recomputes_only_near_it(pieces):
    e = bpe.PrefixEncoder(pieces.v, b"the ing tion " * 400)
    assert e.replace(100, 102, b"xyz") < 1000


def test_query_round_trip(spark, library):
    text = {r["doc_id"]: r["text"] for r in documents(spark).collect()}
    got = queries.op10_byte_bpe(spark, SF_SMALL).collect()
    assert len(got) == len(text)
    for r in got:
        ids = library.encode_ordinary(text[r["doc_id"]] or "")
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((text[r["doc_id"]] or "").encode()).hexdigest()


def test_odd_rows_and_clashing_columns(spark, library):
    got = bpe.decode(bpe.encode(odd_documents(spark))).collect()
    assert len(got) == 15 and got[0]["row_id"] == "old row_id"
    for r in got:
        assert r["ids"] == library.encode_ordinary(r["text"] or "") and r["decoded"] == (r["text"] or "").encode()
    assert bpe.decode(bpe.encode(no_documents(spark))).count() == 0


def test_word_ids_equal_the_library():
    words = packing._words(packing.read_tokenizer())
    rng = random.Random(5)
    plain = "".join(map(chr, range(0x300)))
    texts = ["".join(rng.choices(ODD, k=rng.randint(0, 40))) for _ in range(800)]
    texts += ["".join(rng.choices(plain, k=rng.randint(0, 60))) for _ in range(800)]
    texts += [prose(rng, 500), "<|startoftext|> x", "DON'T we'll 123", ""]
    words_and_marks = ["Word", "it's.", "x1...", "\u201cquoted\u201d,", "na\u00efve;", "e\u0301t\u00e9", "\u039f\u03a3", "\u4e2d\u6587", "\u2014", "don't!?", " ", "\u0301", "\u00bb."]
    texts += [rng.choice([" ", "\n", "\u00a0", "  "]).join(rng.choices(words_and_marks, k=rng.randint(1, 25))) for _ in range(600)]
    for t, got in zip(texts, words.ids(texts)):
        assert got == words.whole(t), t


def _check_plan(histogram, limit=4096):
    plan = packing.make_plan(dict(histogram), limit)
    sequences = defaultdict(list)
    for n, c in histogram.items():
        s, o = plan.place(n, np.arange(c))
        for a, b in zip(s.tolist(), o.tolist()):
            sequences[a].append((b, n))
    for places in sequences.values():
        at = 0
        for offset, n in sorted(places):
            assert offset == at
            at += n
        assert at <= limit
    return len(sequences)


def test_plans_are_gapless_and_tight():
    rng = random.Random(6)
    assert _check_plan({}) == 0
    assert _check_plan({4096: 3, 1: 2}) == 4
    assert _check_plan({2049: 100, 2048: 50}) == 125
    assert _check_plan({3: 10}, limit=9) == 4
    for k in (5, 50, 2000):
        h = Counter(rng.choices(range(1, 2000), k=k))
        lower = -(-sum(n * c for n, c in h.items()) // 4096)
        assert _check_plan(h) <= lower * 1.02 + 1


def _check_packed(docs, got):
    words = packing._words(packing.read_tokenizer())
    want = Counter()
    for r in docs:
        ids = words.whole(r["text"] or "") + (1).to_bytes(4, "little")
        for k, at in enumerate(range(0, len(ids), 4 * 4096)):
            part = ids[at:at + 4 * 4096]
            want[r["doc_id"], k, at // 4, len(part) // 4, zlib.crc32(part)] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    sequences = defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in sequences.values():
        at = 0
        for offset, n in sorted(places):
            assert offset == at
            at += n
        assert at <= 4096
    return len(sequences)


def test_packing_query(spark):
    got = queries.op4_best_fit(spark, SF_SMALL).collect()
    n = _check_packed(documents(spark).collect(), got)
    assert n <= -(-sum(r["length"] for r in got) // 4096) + 1


def test_packing_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(packing, "RANK_ROWS", 3)  # many buckets
    docs = odd_documents(spark)
    _check_packed(docs.collect(), packing.pack_documents(docs).collect())
    assert packing.pack_documents(no_documents(spark)).count() == 0


def test_equal_ids_and_equal_rows_are_numbered_apart(spark, monkeypatch):
    """A third of the rows have no id and one text: they are dealt to several buckets of the ranking."""
    monkeypatch.setattr(packing, "RANK_ROWS", 10)
    rng = random.Random(8)
    rows = [(None, "same text")] * 60 + [(7, prose(rng, k % 9)) for k in range(60)] + [(k, prose(rng, 30)) for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = packing.pack_documents(docs).collect()
    assert _check_packed(docs.collect(), got) <= -(-sum(r["length"] for r in got) // 4096) + 1
