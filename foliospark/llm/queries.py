"""The queries of this subpackage over the tables of a folder, with their SQL twins."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from . import decontaminate as dec, jaccard_join as jac, language_id as lid, packing, quality_gam as gam, quality_rules as rules, reshard as sharding, substring_dedup as sub, toxicity as tox, url_filter as urls
from .common import crc_mod, table


def op1_quality_rules(spark, sf_dir):
    out = rules.quality_rules(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "posterior")


def op2_substring_dedup(spark, sf_dir):
    out = sub.substring_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", "kept_sha256", F.size("intervals").cast("long").alias("n_intervals"))


def op3_quality_gam(spark, sf_dir):
    held = crc_mod(F.col("doc_id"), 3) == 1
    labels = table(spark, sf_dir, "labels").where(~held).select("doc_id", F.col("quality").alias("label"))
    out = gam.quality_gam(table(spark, sf_dir, "documents").select("doc_id", "text"), labels)
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op4_decontaminate(spark, sf_dir):
    return dec.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("items", "text_hash")


def op5_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op6_url_filter(spark, sf_dir):
    return urls.url_filter(table(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict")


def op7_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = crc_mod(F.col("doc_id"), 3) == 1
    out = lid.language_id(docs.drop("lang"), docs.where(~held))
    return out.select("doc_id", held.alias("held_out"), "lang_pred", "score", "rejected")


def op8_reshard(spark, sf_dir):
    """Twelve old shards by the doc_id's crc32, as an earlier run might have left them, become sixteen of even bytes; their files are rewritten."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    old = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 12
    out = sharding.moved(docs, old)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op9_toxicity(spark, sf_dir):
    held = crc_mod(F.col("doc_id"), 5) == 0
    labels = table(spark, sf_dir, "labels").where(~held).select("doc_id", F.col("toxic").alias("label"))
    out = tox.toxicity(table(spark, sf_dir, "documents").select("doc_id", "text"), labels)
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_jaccard_join(spark, sf_dir):
    return jac.jaccard_join(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


QUERIES = {f.__name__: f for f in (op1_quality_rules, op2_substring_dedup, op3_quality_gam, op4_decontaminate, op5_packing, op6_url_filter, op7_language_id, op8_reshard, op9_toxicity, op10_jaccard_join)}
ORACLES = {"op2_substring_dedup": sub.ORACLE, "op4_decontaminate": dec.ORACLE, "op6_url_filter": urls.oracle()}
