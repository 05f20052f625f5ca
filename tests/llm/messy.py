"""Documents with everything that may come in: nulls, empty and very long texts, ties, repeated rows, further columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

LONG = " ".join(f"word{i % 977} lorem{i % 31}" for i in range(30_000))
PASSAGE = "the quick brown fox jumps over the lazy dog and then it runs away from every single hound in the village"
ROWS = [
    (1, "alpha beta gamma delta epsilon zeta eta theta", "en"),
    (2, "ALPHA  beta\tgamma delta epsilon zeta eta theta", "en"),
    (3, None, "en"),
    (4, "", None),
    (5, " \n\t ", "fr"),
    (6, LONG, "en"),
    (7, LONG, "en"),
    (7, LONG, "en"),
    (8, "héhé 日本語 😀 ñ " * 40, "es"),
    (9, f"before {PASSAGE} after", "en"),
    (10, f"other things, then {PASSAGE}. And more of it", "en"),
    (None, f"nameless {PASSAGE} too", "en"),
    (None, None, None),
    (11, "one two", "de"),
    (12, "x", "de"),
    (-5, "alpha beta gamma delta epsilon zeta eta theta", "en"),
]
# Names that the operators use inside.
EXTRA = "fp string, chunk string, ids string, spans string, key string, row string, doc string"


def messy(spark: SparkSession, extra: bool = True) -> DataFrame:
    rows = [(i, t, lang, "s", None if t is None else len(t)) for i, t, lang in ROWS]
    kinds = "doc_id long, text string, lang string, source string, n_chars long"
    if not extra:
        return spark.createDataFrame(rows, kinds)
    return spark.createDataFrame([(*r, *"abcdefg") for r in rows], f"{kinds}, {EXTRA}")


def empty(spark: SparkSession) -> DataFrame:
    return messy(spark).filter("false")
