"""Tables with everything an operator must take: NULLs, empty and very long texts, ties, repeats, clashing columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

LONG = " ".join(f"word{i % 7919}" for i in range(60_000))

#: Names that the operators use themselves.
EXTRA = "key long, kept boolean, size long, score double, row string, order long, tile int, _id long, entry long, fingerprint string"

ROWS = [
    (1, "The cat sat on the mat.\nIt was a good mat."),
    (2, "The cat sat on the mat.\nIt was a good mat."),
    (3, "The  cat sat\ton the mat. It was a good mat."),
    (4, ""),
    (5, None),
    (6, " \t\n "),
    (7, "word"),
    (8, LONG),
    (9, LONG + " more"),
    (10, "ÄÖÜ straße 日本 😀\x00 <|endoftext|>"),
    (11, "x" * 100_000),
    (None, "no id at all"),
    (None, "no id at all"),
    (12, "repeated row"),
    (12, "repeated row"),
    (12, "same id, other text"),
    (-3, "a negative id"),
    ((1 << 62), "a large id"),
]


def documents(spark: SparkSession, rows=ROWS) -> DataFrame:
    sources = ["a", "b", None, "ä"]
    full = [
        (i, text, None if n % 5 == 0 else "en", sources[n % 4], None if n % 3 == 0 else len(text or ""), n, None, n, 0.5, "r", n, n, n, n, "f")
        for n, (i, text) in enumerate(rows)
    ]
    return spark.createDataFrame(full, f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}")


def no_documents(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], documents(spark).schema)
