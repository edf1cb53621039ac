"""From raw documents to token ids: the operators on training text, one after the other.

Every stage takes what the one before kept, as Parquet in the shared folder; ``run`` deletes the
copies that a stage read once its own result is written. Null, empty and blank texts have no words
and are rejected by the quality rules, as the rules' own docstring says; documents may share an
id or have none, and of near copies one row stays whatever their ids; an empty table gives an empty
result. Extra columns of the documents stay until the last stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from feedquality.llm.bpe import ids_and_digests
from feedquality.llm.decontaminate import decontaminate
from feedquality.llm.jaccard_join import keep_one
from feedquality.llm.line_dedup import drop_boilerplate
from feedquality.llm.quality_rules import filter_quality
from feedquality.session import discard, scratch_path, staging


def _with_text(docs: DataFrame, changed: DataFrame) -> DataFrame:
    """The documents' columns, their length that of the text as it is now."""
    rows = changed.select("doc.*")
    return rows.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else rows


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return filter_quality(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines go; so does a document that had none but boilerplate lines of others."""
    changed = drop_boilerplate(docs)
    left = F.regexp_replace("doc.text", "[\\x20\\x09-\\x0D]+", "") != ""
    return _with_text(docs, changed.filter((F.col("n_removed") == 0) | left))


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of test items go; so does a document that is mostly test items."""
    return _with_text(docs, decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left as text and as token ids (little-endian unsigned 32-bit numbers), with the digests of the
    ids and of the bytes decoded from them."""
    import public_tokenizers

    found = ids_and_digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return docs.select("doc_id", "text", found.alias("__s")).select(
        "doc_id", "__s.n_tokens", "__s.ids_sha256", "__s.decoded_sha256", "text", "__s.ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules), ("line_dedup", line_dedup), ("jaccard_join", jaccard_join),
    ("benchmark_decontamination", benchmark_decontamination), ("byte_bpe", encode)]

#: The rules' accuracies are estimated by iteration, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder for the next one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, function in STAGES[:-1]:
        path = scratch_path(spark, name)
        with staging(spark):  # what a stage stages for itself goes when its result is written
            kept = function(spark, docs, sf_dir)
            kept.write.parquet(path)
        docs = spark.read.schema(kept.schema).parquet(path)
        if before:
            discard(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
