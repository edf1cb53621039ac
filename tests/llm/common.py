"""Small frames with the awkward rows that every operator must take."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns that operators use as names of their own.
CLASHING = ["pos", "h1", "h2", "v", "n", "token", "site", "spans", "n_words", "n_hit", "kept", "score", "n_tokens", "doc",
            "drops", "root", "keeper", "t1", "t2", "component_id", "n_shingles", "__s", "__doc", "url", "rule"]


def sentence(words: int, seed: int = 0) -> str:
    """Plain words, none of which repeats."""
    return " ".join(f"{'bcdfghklmnprst'[(i + seed) % 14]}{'aeiou'[(i * 7 + seed) % 5]}x{i + seed * 1000}".translate(
        {ord(str(d)): "abcdefghij"[d] for d in range(10)}) for i in range(words))


def rows() -> list[tuple]:
    long_text = "\n".join(sentence(40, s) + "." for s in range(500))
    return [
        (1, sentence(80, 1), "en", "a", 1), (2, sentence(80, 1), "en", "b", None), (3, None, "en", "a", 0),
        (4, "", None, "a", 0), (5, " \n\t ", "en", None, 4), (None, sentence(80, 2), "en", "c", 5),
        (7, "word", "en", "a", 4), (8, long_text, "en", "a", 0), (8, long_text, "en", "a", 0),
        (9, sentence(79, 1) + " other", "en", "c", 0), (None, None, None, None, None), (10, "日本 " * 60, "ja", "a", 0),
    ]


def docs(spark: SparkSession, data: list[tuple] | None = None, clashing: bool = True) -> DataFrame:
    frame = spark.createDataFrame(rows() if data is None else data, SCHEMA).repartition(3)
    return frame.withColumns({c: F.lit(7) for c in CLASHING}) if clashing else frame


def texts(spark: SparkSession, *values: str | None, source: str = "a") -> DataFrame:
    return docs(spark, [(i, t, "en", source, 0) for i, t in enumerate(values)], clashing=False)


def empty(spark: SparkSession) -> DataFrame:
    return docs(spark, [])
