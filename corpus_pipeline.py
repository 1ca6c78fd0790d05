"""From raw documents to packed training sequences.

``STAGES`` lists the stages in order. Each takes ``(spark, docs, sf_dir)`` and returns a
DataFrame; all but the last return the columns of ``documents``. :func:`run` writes each
result below the shared folder and reads it back as the next one's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from berthline.llm import jaccard_join, packing, pii, quality, substring_dedup
from berthline.llm.common import materialize, table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained quality classifier keeps."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model).where("keep").select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each group linked at 0.8 on 5-word shingles.
    Rows without an id stay."""
    found = jaccard_join.near_duplicates(docs, num=80, den=100, n=5)
    gone = found.where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without words of repeated 35-word windows; untouched texts stay as they are."""
    found = substring_dedup.remove_repeated(docs, window=35)
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    return _with_text(found, text, docs.columns)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with every personal-data span replaced by its kind."""
    found = pii.find_personal_data(docs, pii.fit(docs), mask=True)
    text = F.when(F.col("spans") != "", F.col("masked_text")).otherwise(F.col("text"))
    return _with_text(found, text, docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents, packed into sequences of at most 4096 tokens."""
    return packing.pack_documents(docs)


def _with_text(df: DataFrame, text, columns: list[str]) -> DataFrame:
    df = df.withColumn("text", text)
    if "n_chars" in columns:
        df = df.withColumn("n_chars", F.length("text").cast("bigint"))
    return df.select(*columns)


STAGES = [
    ("quality classifier", keep_good),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("substring dedup", drop_repeated_passages),
    ("PII", mask_personal_data),
    ("best-fit packing", pack_sequences),
]

#: The classifiers are trained models, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for n, (_, stage) in enumerate(STAGES):
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{n + 1}")
    return docs
