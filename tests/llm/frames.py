"""Hand-made tables with the rows that real ones surprise with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, `key` string, fp long"
#: Columns after ``source`` clash with names that the operators use inside.
LONG = " ".join(f"word{k % 977}" for k in range(30_000))


def documents(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame([(i, t, "en", "s", 0, 0.5, "k", 1) for i, t in rows], DOCS)


ODD = [
    (1, None),
    (2, ""),
    (3, "   \n\t "),
    (4, "One short line."),
    (4, "One short line."),
    (4, "Another text under the same id, with enough words to be a unit of its own."),
    (None, "A row without an id, with enough words to be a unit of its own."),
    (5, None),
    (6, LONG),
    (7, LONG),
    (8, "ünïcode Wörter, 你好 world\u00a0here \x1c and \x85 odd spaces é"),
    (9, "<|endoftext|> is text here <|startoftext|>"),
]
