"""Small tables for the corpus operators."""

import random

from tests.conftest import SF_SMALL

SYLLABLES = "the an ing er on re tion ou sh li ka mo be ra du fi".split()


def prose(rng: random.Random, n: int) -> str:
    words = ["".join(rng.choices(SYLLABLES, k=rng.randint(1, 3))) for _ in range(n)]
    return "".join(w + (rng.choice([" ", " ", " ", ".\n"])) for w in words).strip()


def documents(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def odd_documents(spark):
    """Nulls everywhere, empty, blank and very long texts, repeated rows, clashing column names."""
    rng = random.Random(5)
    long = prose(rng, 30_000)
    data = [(None, long, None, None, None), (1, None, "en", "a", 0), (2, "", "en", None, 0), (3, " \t\n ", None, "a", 4),
            (4, long, "en", "a", len(long)), (4, long, "en", "a", len(long)), (5, "one", "de", "b", 3),
            (6, "One", "de", "b", 3), (7, "two words", "de", None, 9), (7, prose(rng, 200), "fr", "b", None),
            (None, None, None, None, None), (8, prose(rng, 60), "fr", "c", 1), (9, "日本語 текст 😀 \x00 é", "es", "c", 12),
            (10, "x" * 5000, "es", "c", 5000), (11, "a a a " * 200, "es", "c", 1200)]
    clash = ("row_id row_key key ctx state lo n u v node root grp ids decoded score keep spans base length piece "
             "_text _id range extra s kind start").split()
    df = spark.createDataFrame(data, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    from pyspark.sql import functions as F
    return df.select("*", *[F.lit(f"old {c}").alias(c) for c in clash])


def no_documents(spark):
    return odd_documents(spark).limit(0)
