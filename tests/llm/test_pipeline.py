"""The pipeline stage by stage, and the registered queries with SQL twins."""

from collections import Counter

import duckdb
import pytest

import corpus_pipeline
from berthline.llm import packing, pii, quality, queries

from .support import SF_SMALL, documents, no_documents, odd_documents, rows
from .test_duplicates import _jaccard, _removed
from .test_tokens import _check_packed

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_every_operator_has_one_query():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES)
    assert numbers == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    rel = con.sql(queries.ORACLES[name])
    got = queries.QUERIES[name](spark, SF_SMALL)
    assert sorted(got.columns) == sorted(rel.columns)
    assert rows(got, *rel.columns) == sorted(rel.fetchall(), key=repr)


def test_stages_equal_their_brute_force_versions(spark):
    docs = documents(spark)
    d0 = docs.collect()
    d1 = corpus_pipeline.keep_good(spark, docs, SF_SMALL)
    assert d1.columns == COLUMNS
    model = quality.fit(docs, spark.read.parquet(f"{SF_SMALL}/labels.parquet"))
    meta = quality.meta_features(*([r[c] for r in d0] for c in ("source", "lang", "n_chars")))
    keeps = model.score([r["text"] or "" for r in d0], meta)[:, 2] >= quality.KEEP
    assert rows(d1, *COLUMNS) == sorted((tuple(r) for r, k in zip(d0, keeps) if k or model.share is not None), key=repr)

    d2 = corpus_pipeline.drop_near_duplicates(spark, d1, SF_SMALL)
    root = {i: c for i, _, c in _jaccard([(r["doc_id"], r["text"]) for r in d1.collect()], 80, 100, 5)}
    assert d2.columns == COLUMNS
    assert rows(d2, *COLUMNS) == [r for r in rows(d1, *COLUMNS) if root[r[0]] == r[0]]

    d3 = corpus_pipeline.drop_repeated_passages(spark, d2, SF_SMALL)
    before = {r["doc_id"]: r for r in d2.collect()}
    want = []
    for i, _, n, kept in _removed([(i, r["text"]) for i, r in before.items()], 35):
        t = kept if n else before[i]["text"]
        want.append((i, t, before[i]["lang"], before[i]["source"], len(t) if t is not None else None))
    assert rows(d3, *COLUMNS) == sorted(want, key=repr)

    d4 = corpus_pipeline.mask_personal_data(spark, d3, SF_SMALL)
    assert d4.columns == COLUMNS and d4.count() == d3.count()
    for r in d4.collect():
        assert not any(pii.base_spans(r["text"] or "")[k] for k in ("email", "phone", "ip"))
    untouched = {r["doc_id"]: r["text"] for r in d3.collect()}
    assert all(r["text"] == untouched[r["doc_id"]] for r in d4.collect()
               if not any(pii.base_spans(untouched[r["doc_id"]] or "").values()) and "=" not in untouched[r["doc_id"]])

    _check_packed(d4.collect(), corpus_pipeline.pack_sequences(spark, d4, SF_SMALL).collect())


def test_run_is_the_chain_of_stages(spark):
    got = corpus_pipeline.run(spark, SF_SMALL)
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert got.agg({"length": "max"}).first()[0] <= packing.SEQUENCE
    assert got.where("piece = 0").count() == got.select("doc_id").distinct().count()


@pytest.mark.parametrize("make", [odd_documents, no_documents])
def test_stages_take_odd_tables(spark, make):
    docs = make(spark)
    n = Counter()
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_SMALL)
        n[name] = out.count()
        if name != "best-fit packing":
            assert out.columns == docs.columns
            docs = out
    assert (n["best-fit packing"] > 0) == (n["quality classifier"] > 0)
