"""A corpus pipeline of five stages: quality, near duplicates, repeated passages, benchmark leaks, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept; its result is
written as Parquet and read again as the next one's docs. All but the last return the columns of
documents.

Defined results, for all stages: rows are documents, whatever their doc_id; a null text has no words and stays, but for what
the classifier makes of it; other columns, whatever they are called, are carried along; of an empty table an
empty one is left. Rows that repeat a doc_id and its text stay one from the second stage on.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from foliospark.llm.common import compact, crc_mod, discard, materialise, table
from foliospark.llm.decontaminate import decontaminate
from foliospark.llm.jaccard_join import one_of_each
from foliospark.llm.packing import pack
from foliospark.llm.quality_gam import quality_filter
from foliospark.llm.substring_dedup import substring_dedup

#: A classifier is fitted and a sequence packed; SQL has neither.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    labels = table(spark, sf_dir, "labels").where(crc_mod(F.col("doc_id"), 3) != 1).select("doc_id", F.col("quality").alias("label"))
    return compact(quality_filter(docs, labels))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of documents that share 0.8 of their runs of five words or more, the one with the smallest
    doc_id (then the smallest hash of the text); rows that repeat it stay one. Documents without words stay."""
    return compact(one_of_each(docs, k=5, percent=80))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words that earlier documents have in the same windows; those left without a word go.

    n_chars, where there is one, is counted anew for texts that lose words.
    """
    names = [f"_c{k}" for k in range(len(docs.columns))]
    out = substring_dedup(docs, kept_text=True).toDF(*names, "n_words", "n_removed", "kept_sha256", "intervals")
    at = dict(zip(docs.columns, names))
    out = out.where((F.col("n_removed") < F.col("n_words")) | (F.col("n_removed") == 0))
    if "n_chars" in at:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn(at["n_chars"], F.when(F.col("n_removed") > 0, F.length(at["text"]).cast(kind)).otherwise(F.col(at["n_chars"])))
    return compact(out.select(*(F.col(n).alias(c) for c, n in at.items())))


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs, however long they are."""
    leaks = decontaminate(docs, table(spark, sf_dir, "benchmark")).where("n_hit > 0").select(F.struct("doc_id", F.col("text_hash").alias("v")).alias("_leak_key"))
    return compact(docs.withColumn("_leak_key", F.struct("doc_id", F.xxhash64("text").alias("v"))).join(leaks, "_leak_key", "left_anti").select(*docs.columns))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences."""
    return compact(pack(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")))


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("repeated_passages", repeated_passages), ("benchmark_leaks", benchmark_leaks), ("packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        last, docs = docs, materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
        discard(last)
    return docs
