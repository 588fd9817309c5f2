"""Edge rows that every operator must take: nulls, empty and very long texts,
ties, repeated rows, clashing names, empty tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, fp long, score string, size string, pii_base string, m_id long, taken string"
LONG = "lorem ipsum dolor " * 40_000


def edge_rows() -> list[tuple]:
    words = " ".join(f"w{i}" for i in range(80))
    rows = [
        (1, None, None, None, None), (2, "", "en", "a", 0), (3, "   \n\t ", "en", "a", 6), (4, words, "en", "b", 1), (5, words, "en", "b", 1),
        (5, words, "en", "b", 1), (6, words + " tail", None, None, None), (None, words, "en", "a", 2), (None, None, None, None, None),
        (7, LONG, "en", "b", 9), (8, "one", "de", "c", 3), (9, "mail a.b@c.de, call +1 (743) 555-3824 or 10.0.0.1, card 4111 1111 1111 1111", "en", "c", 70),
        (5, "another text under the same id " + words, "en", "z", 3),
    ]
    return [(*r, "x", 1, "y", "z", "p", 5, "t") for r in rows]


def edge_docs(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(edge_rows(), SCHEMA)


def no_docs(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)
