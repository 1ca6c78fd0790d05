"""Quality, personal data, language and licence operators."""

import hashlib
import math
import random
import re
import textwrap
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from berthline.llm import langid, license_scan, pii, quality, queries

from .support import SF_SMALL, documents, no_documents, odd_documents, prose

SF = "/root/testdata/sf0.01"


def _auc(good, bad):
    ranks = np.argsort(np.argsort(np.concatenate([good, bad]))) + 1
    return (ranks[:len(good)].sum() - len(good) * (len(good) + 1) / 2) / len(good) / len(bad)


def test_quality_ranks_rows_it_was_not_fitted_on(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    seen, unseen = labels.where("doc_id % 3 <> 0"), labels.where("doc_id % 3 = 0").collect()
    got = {r["doc_id"]: r for r in quality.score(docs, quality.fit(docs, seen)).collect()}
    assert len(got) == docs.count()
    good = np.array([got[r["doc_id"]]["score"] for r in unseen if r["quality"] == 1 and not r["toxic"]])
    bad = np.array([got[r["doc_id"]]["score"] for r in unseen if r["quality"] == 0])
    assert _auc(good, bad) > 0.9
    assert np.mean([got[r["doc_id"]]["keep"] for r in unseen if r["quality"] == 1 and not r["toxic"]]) > 0.9


def _views(rng, n, noise):
    """Words and metadata that both follow the truth, the metadata less so."""
    truth = rng.integers(0, 2, n)
    seen = np.where(rng.random(n) < noise, 1 - truth, truth)
    words = (np.repeat(np.arange(n), 3), np.stack([truth + 10, np.full(n, 5), rng.integers(20, 40, n)], axis=1).ravel().astype(np.int32))
    return truth, (*words, rng.random((n, 11)), np.repeat((seen + 3)[:, None], 5, axis=1).astype(np.int32))


def _batched(features, size):
    rows, cols, shapes, meta = features
    for at in range(0, len(meta), size):
        inside = (rows >= at) & (rows < at + size)
        yield rows[inside] - at, cols[inside], shapes[at:at + size], meta[at:at + size]


def _all(*parts):
    return sum(quality._statistics(f) for f in parts)


def test_both_views_hand_over_rows_of_all_unlabelled_ones():
    rng = np.random.default_rng(1)
    y, own = _views(rng, 400, 0.2)
    truth, rest = _views(rng, 3000, 0.2)
    seen = []

    def unlabelled(per_batch, width):
        seen.append(sum(len(f[3]) for f in _batched(rest, 170)))
        return sum((per_batch(f) for f in _batched(rest, 170)), np.zeros(width))

    m = quality.Model(own[:2], own[2], own[3], y, np.arange(400) % 8, _all(own, rest), 3400, unlabelled)
    assert set(seen) == {3000} and len(seen) == quality.ROUNDS * (1 + quality.PASSES)
    assert all(min(h) >= 0.9 * quality.HAND * 3000 for h in m.handed)


def test_one_round_equals_a_plain_one():
    """Rows handed over, gradients and curvatures of one round, against dense arithmetic over all rows."""
    rng = np.random.default_rng(3)
    y, own = _views(rng, 400, 0.3)
    truth, rest = _views(rng, 900, 0.3)
    m = quality.Model(own[:2], own[2], own[3], y, np.arange(400) % 8, _all(own, rest), 1300)
    histograms = sum(m._score_histograms(f) for f in _batched(rest, 100))
    hands = [quality.HandOver(h, 0.4) for h in histograms.reshape(2, -1)]
    givers = m._givers(hands)
    got = sum(m._gradients(givers)(f) for f in _batched(rest, 77))
    dense = []
    for (rows, cols), model in zip(m.columns(rest), m.models):
        x = np.zeros((900, len(model.w)))
        np.add.at(x, (rows, cols), 1)
        dense.append(x)
    p = [1 / (1 + np.exp(-((x @ k.w + k.b) * ab[0] + ab[1]))) for x, k, ab in zip(dense, m.models, m.ab)]
    at, sizes = 2, []
    for k in (0, 1):
        giver = p[1 - k]
        cell = np.floor(giver * quality.GRID)
        order = np.sort(cell)
        top = max(quality.GRID // 2, order[-36])
        good, bad = cell >= top, cell < quality.GRID // 2
        bad &= cell <= order[54 - 1]
        weight = np.zeros(900)
        for part in (good, bad):
            weight += 0.5 * quality.PSEUDO * np.abs(2 * giver - 1) * part / max(part.sum(), 1)
        r = weight * (p_raw(dense[k], m.models[k]) - good)
        width = dense[k].shape[1]
        each = dense[k].sum(axis=1)
        np.testing.assert_allclose(got[at:at + width], dense[k].T @ r, atol=1e-12)
        np.testing.assert_allclose(got[at + width:at + 2 * width], dense[k].T @ (0.25 * weight * np.sqrt(each + 1)), atol=1e-12)
        np.testing.assert_allclose(got[at + 2 * width], r.sum(), atol=1e-12)
        np.testing.assert_allclose(got[at + 2 * width + 1], 0.25 * weight.sum(), atol=1e-12)
        at += 2 * width + 2
        sizes.append(int((good | bad).sum()))
    assert got[:2].astype(int).tolist() == sizes[::-1]


def p_raw(x, model):
    return 1 / (1 + np.exp(-(x @ model.w + model.b)))


def test_sums_over_tasks_cover_every_unlabelled_row(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = docs.select("doc_id", "text", *quality._with_meta(docs)).mapInArrow(
        quality._features, "doc_id bigint, words binary, shape binary, meta binary").repartition(5)
    got = quality.summed(rows, lambda f: np.array([len(f[3]), len(f[1]), f[2][:, 0].sum()]), 3)
    assert got[0] == docs.count() and got[1] > 50 * got[0] and got[2] > got[0]
    m = quality.fit(docs, labels, rounds=1)
    assert len(m.handed) == quality.PASSES and min(min(h) for h in m.handed) > 0


def test_quality_odd_rows(spark):
    docs = odd_documents(spark)
    labels = spark.createDataFrame([(4, 1, None), (4, None, 1), (None, 0, 0), (8, 0, 0)], "doc_id int, quality int, toxic int")
    got = quality.score(docs, quality.fit(docs, labels)).collect()
    assert len(got) == 15 and all(0 <= r["score"] <= 1 for r in got) and got[0]["row_id"] == "old row_id"
    none = quality.score(docs, quality.fit(docs, labels.limit(0))).collect()
    assert all(r["keep"] and r["score"] == 1.0 for r in none)
    assert quality.score(no_documents(spark), quality.fit(no_documents(spark), labels)).count() == 0
    bare = docs.select("doc_id", "text")
    assert quality.score(bare, quality.fit(bare, labels)).count() == 15


def _base(t):
    digits = lambda s: [int(c) for c in s if c in "0123456789"]

    def luhn(d):
        return sum(x if k % 2 == 0 else sum(divmod(2 * x, 10)) for k, x in enumerate(d[::-1])) % 10 == 0

    return {
        "email": [m.span() for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)],
        "ip": [m.span() for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t)
               if all(int(x) <= 255 for x in m.group().split("."))],
        "card": [m.span() for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t)
                 if 16 <= len(digits(m.group())) <= 19 and luhn(digits(m.group()))],
        "phone": [m.span() for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 8 <= len(digits(m.group())) <= 15]}


def test_base_spans_equal_the_patterns():
    rng = random.Random(7)
    for k in range(20_000):
        t = "".join(rng.choices("a1@.-_ +2()0%b", k=rng.randint(0, 40))) if k % 4 else "".join(rng.choices("0123456789 -4", k=40))
        assert pii.base_spans(t) == _base(t), t


def test_personal_data_query(spark):
    text = {r["doc_id"]: r["text"] or "" for r in documents(spark).collect()}
    got = queries.op2_weak_supervision(spark, SF_SMALL).collect()
    assert len(got) == len(text)
    for r in got:
        base = _base(text[r["doc_id"]])
        listed = ",".join(f"{k}:{a}:{b}" for k in pii.KINDS[:4] for a, b in base[k])
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [len(base[k]) for k in pii.KINDS[:4]]
        assert r["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert set(filter(None, listed.split(","))) <= set(r["spans"].split(","))


def test_labelers_that_agree_add_spans_and_others_do_not(spark):
    iban = "DE89 3704 0044 0532 0130 00"
    rows = [(k, f"call me at +1 (555) 123-45{k % 100:02d} or mail a{k}@b.example.com") for k in range(60)]
    rows += [(100 + k, f"my iban is {iban}, ssn 123-45-67{k:02d}") for k in range(30)]
    rows += [(200 + k, f"see version 555 123 45{k:02d} of part 1111-11-1111") for k in range(30)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    models = pii.fit(docs)
    got = {r["doc_id"]: r for r in pii.find_personal_data(docs, models, mask=True).collect()}
    assert all("iban:11:38" in got[100 + k]["spans"] for k in range(30))
    assert got[100]["masked_text"].startswith("my iban is <iban>, ssn ")
    assert got[0]["masked_text"] == "call me at <phone> or mail <email>"
    assert all(got[200 + k]["spans"] == "" for k in range(30))
    assert models.reliability["form"][1][2] > models.reliability["form"][0][2]


def _iban(rng):
    body = "".join(rng.choices("0123456789", k=18))
    check = 98 - int(body + "131400") % 97  # D is 13, E is 14
    s = f"DE{check:02d}{body}"
    return " ".join(s[k:k + 4] for k in range(0, 22, 4))


def _planted_spans(rng, n):
    """Texts with one planted string each, its kind (None: no personal data) and place."""
    digits = lambda k: "".join(rng.choices("0123456789", k=k))

    def bad_card():
        while True:
            d = rng.choice("4523") + digits(15)
            if not pii.luhn(d):
                return d

    make = [
        ("iban", lambda: f"my account {_iban(rng)}"), (None, lambda: f"my account DE00 {digits(4)} {digits(4)} {digits(4)} {digits(4)} 00"),
        ("ssn", lambda: f"social security {rng.randint(100, 599)}-{rng.randint(10, 99)}-{rng.randint(1000, 9999)}"),
        (None, lambda: f"part 000-{rng.randint(10, 99)}-{rng.randint(1000, 9999)}"),
        ("email", lambda: f"mail {rng.choice(['kim', 'lee', 'ray'])}{digits(2)} [at] host{digits(2)} [dot] {rng.choice(['com', 'org', 'de'])}"),
        ("name", lambda: f"signed Dr. {rng.choice(['Maria', 'Peter', 'Claire', 'Pablo'])} {rng.choice(['Stone', 'Weber', 'Roux'])}"),
        ("secret", lambda: f"export api_key=ghp_{''.join(rng.choices('abcdefXYZ', k=12))}{digits(8)}"),
        (None, lambda: f"the password: {''.join(rng.choices('abcdef', k=9))} is a word"),
        ("phone", lambda: f"call (0{digits(2)}) 5{digits(2)} 7{digits(3)}"), (None, lambda: f"order 555 1{digits(2)} 4{digits(3)}"),
        (None, lambda: f"number {bad_card()}"),
    ]
    for k in range(n):
        kind, text = make[k % len(make)][0], make[k % len(make)][1]()
        yield k, f"{prose(rng, 20)} {text} {prose(rng, 20)}", kind


@pytest.mark.parametrize("n", [400, 4000])
def test_planted_spans_are_found_and_others_left(spark, n):
    rows = list(_planted_spans(random.Random(n), n))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    models = pii.fit(docs)
    got = {r["doc_id"]: r["spans"] for r in pii.find_personal_data(docs, models).collect()}
    hit = sum(k is not None and f"{k}:" in got[i] for i, _, k in rows)
    wrong = sum(k is None and got[i] != "" for i, _, k in rows)
    planted = sum(k is not None for *_, k in rows)
    assert hit >= 0.9 * planted, (hit, planted)
    assert wrong <= 0.05 * (hit + wrong), (wrong, hit)


def test_verdicts_do_not_depend_on_the_size_of_the_corpus(spark):
    """The same shares of patterns give the same verdicts, and a failed checksum is never accepted."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    counts = {r["pattern"]: r["n"] for r in docs.select("text").mapInArrow(pii._patterns, "pattern string, n bigint")
              .groupBy("pattern").agg(F.sum("n").alias("n")).collect()}
    one, many = pii.Models(counts), pii.Models({p: 1000 * c for p, c in counts.items()})
    large = pii.fit(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"))
    every = sorted(counts)
    np.testing.assert_allclose(one.score(every), many.score(every), atol=1e-6)
    assert [large.accepts(p) for p in every] == [one.accepts(p) for p in every]
    assert not any(m.accepts("card 0 -1 0 0 0 1 1 1 3") for m in (one, many, large))


def test_a_model_from_other_documents_scores_unseen_patterns(spark):
    docs = spark.createDataFrame([(1, f"my iban is {_iban(random.Random(1))}, ok")], "doc_id bigint, text string")
    other = pii.fit(spark.createDataFrame([(1, "call +1 555 123 4567"), (2, "nothing")], "doc_id bigint, text string"))
    for m in (other, pii.fit(docs), pii.Models({})):
        assert "iban:11:38" in pii.find_personal_data(docs, m).first()["spans"]


def test_personal_data_odd_rows(spark):
    docs = odd_documents(spark)
    got = pii.find_personal_data(docs, pii.fit(docs), mask=True).collect()
    assert len(got) == 15 and all(r["n_email"] == 0 for r in got)
    assert pii.find_personal_data(no_documents(spark), pii.fit(no_documents(spark))).count() == 0


def test_language_of_held_out_rows(spark):
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.op8_string_kernel(spark, SF).collect()
    held = [r for r in got if r["held_out"]]
    assert len(got) == len(lang) and 0.2 < len(held) / len(got) < 0.3
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in held]) > 0.95


def test_language_kernel_is_the_shared_share():
    x = langid.presence(["Abc abd!", "abd", "..."])
    assert x.sum(axis=1).tolist()[2] == 0
    grams = lambda t: {t[i:i + n] for n in (1, 2, 3) for i in range(len(t) - n + 1)} - {" "}
    assert int((x[0] & x[1]).sum()) == len(grams("abc abd ") & grams("abd"))
    assert int(x[0].sum()) == len(grams("abc abd "))


def test_predictions_equal_plain_kernel_ridge_regression():
    """With every text a landmark the Nyström map is exact: scores equal kernel ridge regression on the
    full kernel matrix of n-gram sets, up to single precision."""
    rng = random.Random(4)
    make = {"x": "abcde", "y": "defgh", "z": "ghabi"}
    texts = [("".join(rng.choices(make[k] + " ", k=rng.randint(5, 60))), k) for k in "xyz" for _ in range(20)]
    texts = [(t, k) for t, k in texts if t.strip()]
    codes = [np.flatnonzero(r).astype(np.int32) for r in langid.presence([t for t, _ in texts])]
    model = langid.Model(codes, [k for _, k in texts], landmarks=3 * len(texts))
    sets = [set(c.tolist()) for c in codes]
    kernel = lambda a, b: len(a & b) / math.sqrt(len(a) * len(b))
    k = np.array([[kernel(a, b) for b in sets] for a in sets])
    langs = "xyz"
    y = np.array([langs.index(lang) for _, lang in texts])
    target = np.where(y[:, None] == np.arange(3)[None, :], 1.0, -1.0)
    weight = np.diag(1.0 / np.bincount(y)[y])
    alpha = np.linalg.solve(weight @ k + langid.RIDGE / 3 * np.eye(len(sets)), weight @ target)  # weighted, in the dual
    new = ["abc dea bcd", "hgf edh", "iabg hh a", "cab fgi"]
    rows = [set(np.flatnonzero(r).tolist()) for r in langid.presence(new)]
    z = np.array([[kernel(a, b) for b in sets] for a in rows]) @ alpha * model.scale
    p = np.exp(z - z.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    names, scores = model.predict(new)
    assert names == [langs[i] for i in p.argmax(axis=1)]
    np.testing.assert_allclose(scores, p.max(axis=1), atol=5e-3)


def test_language_odd_rows(spark):
    docs = odd_documents(spark)
    model = langid.fit(docs.where(~langid.held_out()))
    got = langid.predict(docs, model).collect()
    assert len(got) == 15
    for r in got:
        if not any(c.isalpha() for c in r["text"] or ""):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        else:
            assert r["lang_pred"] in ("de", "en", "es", "fr") and 0 <= r["score"] <= 1
    none = langid.fit(no_documents(spark))
    assert {r["lang_pred"] for r in langid.predict(docs, none).collect()} == {"und"}
    assert langid.predict(no_documents(spark), model).count() == 0


@pytest.fixture(scope="module")
def licence_model():
    rng = random.Random(1)
    return license_scan.Model([prose(rng, 20) for _ in range(200)])


def _licences(text, model):
    out = []
    at = {g: n for n, g in enumerate(model.vocabulary)}
    for n, line in enumerate((text or "").split("\n")):
        grams = license_scan.features(license_scan.words(line), model.anchors)
        known = [at[g] for g in grams if g in at]
        if not known:
            continue
        z = model.weights[known].sum(axis=0) + model.bias
        p = np.exp(z - z.max())
        best = license_scan.CLASSES[int(p.argmax())]
        if best == license_scan.NONE:
            continue
        sure = 1 / p.sum() >= license_scan.SURE and best != license_scan.UNKNOWN
        parts = Counter()
        size = Counter((f, k) for f, k, _ in model.templates)
        for f, k, g in model.templates:
            parts[f, k] += g in grams
        held = max((parts[t] / size[t] for t in size if t[0] == best), default=0)
        out.append(f"{n}:{best if sure else 'unknown'}:{int(sure and held >= license_scan.CONFIRM)}")
    return ",".join(out)


def test_licences_equal_a_plain_classifier(spark, licence_model):
    rng = random.Random(2)
    lines = [t for f in license_scan.TEMPLATES.values() for t in f]
    texts = []
    for k in range(80):
        t = rng.choice(lines)
        if rng.random() < 0.5:
            w = t.split()
            t = " ".join(w[:rng.randint(1, len(w))] + prose(rng, 3).split())
        texts.append((k, "\n".join([prose(rng, 12), t.upper() if k % 7 == 0 else t, prose(rng, 5)])))
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    got = {r["doc_id"]: r["licences"] for r in license_scan.scan(docs, licence_model).collect()}
    assert got == {k: _licences(t, licence_model) for k, t in texts}


def test_every_template_is_found_and_prose_is_not(spark, licence_model):
    rng = random.Random(3)
    rows = [(f"{f}", t) for f, ts in license_scan.TEMPLATES.items() if f != "unknown" for t in ts]
    docs = spark.createDataFrame([(k, prose(rng, 10) + "\n" + t) for k, (_, t) in enumerate(rows)], "doc_id bigint, text string")
    got = {r["doc_id"]: r["family"] for r in license_scan.scan(docs, licence_model).collect()}
    assert [got[k] for k in range(len(rows))] == [f for f, _ in rows]
    plain = spark.createDataFrame([(k, prose(rng, 100)) for k in range(50)], "doc_id bigint, text string")
    assert license_scan.scan(plain, licence_model).where("n_licences > 0").count() == 0


def test_licence_scan_uses_no_python(spark, licence_model):
    plan = license_scan.scan(documents(spark).select("doc_id", "text"), licence_model)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", text) and "BroadcastHashJoin" in text


def test_licence_odd_rows(spark):
    docs = odd_documents(spark).union(odd_documents(spark).limit(1).replace("old kind", "new"))
    got = license_scan.scan(docs, license_scan.fit(docs)).collect()
    assert len(got) == 16 and all(r["n_licences"] == 0 for r in got)
    assert sorted(r["n_paragraphs"] for r in got if r["doc_id"] in (1, 2)) == [0, 0]
    assert license_scan.scan(no_documents(spark), license_scan.fit(no_documents(spark))).count() == 0
    twice = spark.createDataFrame([(1, "Released under the MIT License.")] * 2, "doc_id bigint, text string")
    assert {(r["licences"], r["family"]) for r in license_scan.scan(twice, license_scan.fit(twice)).collect()} == {("0:mit:1", "mit")}
    assert math.isfinite(license_scan.fit(docs).scale)


def test_short_notices_in_a_third_of_the_documents_are_found(spark):
    rng = random.Random(9)
    short = ["MIT License", "License: MIT", "Apache License"]
    rows = [(k, "\n".join([*(prose(rng, 12).replace("\n", " ") for _ in range(8)), *([short[k % 9 // 3]] if k % 3 == 0 else []),
                          *(["Released under the MIT License."] if k % 50 == 0 else [])])) for k in range(600)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in license_scan.scan(docs, license_scan.fit(docs)).collect()}
    assert all(got[k]["n_licences"] == (k % 3 == 0) + (k % 50 == 0) for k in got)
    assert all(got[k]["family"] == "mit" for k in got if k % 50 == 0)


def test_a_notice_word_of_another_language_is_no_licence(spark):
    rng = random.Random(10)
    rows = [(k, " ".join([*prose(rng, 9).split(), "mit", *prose(rng, 9).split(), *(["mit"] * (k % 2))])) for k in range(300)]
    docs = spark.createDataFrame([*rows, (300, "Licensed under the MIT License.")], "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in license_scan.scan(docs, license_scan.fit(docs)).collect()}
    assert [k for k in got if got[k]["n_licences"]] == [300] and got[300]["family"] == "mit"


def test_sampled_lines_reach_the_model_whole(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(license_scan, "Model", seen.extend)
    long = " ".join(f"word{k}" for k in range(300)) + " mit"
    license_scan.fit(spark.createDataFrame([(k, long) for k in range(5)], "doc_id bigint, text string"))
    assert seen == [long] * 5


def test_wrapped_notices_are_found(spark, licence_model):
    rng = random.Random(11)
    long = [(f, t) for f, ts in license_scan.TEMPLATES.items() if f != "unknown" for t in ts if len(t) > 90]
    rows, want = [], {}
    for width in (24, 40, 60):
        for f, t in long:
            lines = textwrap.wrap(t, width)
            before = ["zzz " * 8] * rng.randint(0, 3)
            rows.append((len(rows), "\n".join([*before, *lines, "", prose(rng, 8)])))
            want[len(rows) - 1] = f
    (mit,), (bsd,) = ([t for t in license_scan.TEMPLATES[f] if "ermission is hereby granted, free" in t or "source and binary" in t]
                      for f in ("mit", "bsd"))
    rows.append((len(rows), "\n".join(textwrap.wrap(mit, 60) + textwrap.wrap(bsd, 60))))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in license_scan.scan(docs, licence_model).collect()}
    assert {k: got[k]["family"] for k in want} == want
    both = {x.split(":")[1] for x in got[len(want)]["licences"].split(",") if x.endswith(":1")}
    assert both == {"mit", "bsd"}
    # the MIT paragraph at 75 characters is one notice, at its first line
    only = spark.createDataFrame([(0, "zzz zzz\n" + "\n".join(textwrap.wrap(mit, 75)))], "doc_id bigint, text string")
    assert license_scan.scan(only, licence_model).first()["licences"] == "1:mit:1"
