"""From raw documents to token ids: five stages, each one operator.

``run`` applies them to the documents table; each stage's result is written as
Parquet to the shared checkpoint folder and read again by the next.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streetflow.llm import bottomk, bpe, fuzzy_lines, site_quality, winnow
from streetflow.llm.graph import staged
from streetflow.llm.similar import small

#: No SQL for the whole: fuzzy lines, the fitted classifier and BPE have none.
ORACLE_SQL = None


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """Rows of ``docs`` but those whose id and text's hash ``t`` are in ``gone``."""
    gone = staged(gone.select(F.col("doc_id").alias("gone_id"), F.col("t").alias("gone_t")).distinct(), "gone")
    return docs.join(small(gone), docs["doc_id"].eqNullSafe(F.col("gone_id"))
                     & F.xxhash64(docs["text"].cast("string")).eqNullSafe(F.col("gone_t")), "left_anti")


def _small_batches(spark: SparkSession) -> None:
    """Documents that a Python worker and the JVM hold at a time (Arrow's default is 10,000)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")


def _drop_shuffles(spark: SparkSession) -> None:
    """Shuffle files go when the execution that wrote them ends; a stage has very many
    shuffles, and else they stay until the driver happens to collect its garbage."""
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    _drop_shuffles(spark)
    _small_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return _without(docs, site_quality.classify(docs, labels).where("not kept"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that repeat; a document that keeps no text goes."""
    _drop_shuffles(spark)
    _small_batches(spark)
    cleaned = fuzzy_lines.dedup_lines(docs, short_copies=True)
    out = cleaned.where("n_removed = 0 or length(trim(text)) > 0").select("row.*", F.col("text").alias("cleaned"))
    return out.select(*[
        F.col("cleaned").alias("text") if c == "text"
        else F.length("cleaned").cast("long").alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near duplicates."""
    _drop_shuffles(spark)
    _small_batches(spark)
    found = staged(bottomk.near_duplicates(docs), "groups")
    same = found.where("doc_id is not null").groupBy("doc_id", "t").agg(F.count("*").alias("n"))
    if not same.where("n > 1").isEmpty():  # rows given twice
        docs = docs.dropDuplicates(["doc_id", "text"])
    return _without(docs, found.where("not kept and component_id is not null"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    _drop_shuffles(spark)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _without(docs, winnow.decontaminate(docs, items).where("n_hit > 0"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with their digest and that of what they decode to."""
    _small_batches(spark)
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.decode(bpe.encode(docs, path), path).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids",
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("tokens", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
