"""What a training run reads: a reproducible shuffle, its head, the chat template and its inverse."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import strip

SYSTEM, USER, ASSISTANT = "<|system|>", "<|user|>", "<|assistant|>"


def shuffle_head(rows: DataFrame, key: str, n: int | None, seed: int = 42) -> DataFrame:
    """The first n rows (all, if n is None or not positive) in an order drawn by a hash of key and seed."""
    out = rows.orderBy(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string"))), key)
    return out.limit(n) if n and n > 0 else out


def chat_template(prompt: Column, train: Column, target: Column, end: str) -> Column:
    or_empty = lambda c: F.coalesce(c, F.lit(""))
    return F.concat(F.lit(SYSTEM + "\n"), or_empty(prompt), F.lit(end + USER + "\n"), or_empty(train), F.lit(end + ASSISTANT + "\n"), or_empty(target))


def training_rows(rows: DataFrame, *keep: str, end: str = "<|endoftext|>") -> DataFrame:
    return rows.select(*keep, chat_template(F.col("Prompt"), F.col("Train"), F.col("Target"), end).alias("text")).where(F.length("text") > 0)


def required(rows: DataFrame) -> DataFrame:
    """rows, or an error where there are none: a run must not begin on nothing."""
    if rows.isEmpty():
        raise ValueError("no training rows are left")
    return rows


def parse_template(rows: DataFrame, text: str = "text") -> DataFrame:
    """rows with prompt and expected, where the text holds the assistant's tag; expected ends at a second tag."""
    parts = F.split(F.col(text), r"<\|assistant\|>", -1)
    return rows.where(F.col(text).contains(ASSISTANT)).withColumns({"prompt": F.concat(parts[0], F.lit(ASSISTANT + "\n")), "expected": strip(parts[1])})


def every(step: Column, n: int = 500) -> Column:
    return (step > 0) & (F.pmod(step, F.lit(n)) == 0)


def latest_checkpoint(paths: DataFrame, path: str = "path") -> DataFrame:
    """The path checkpoint-<n> with the largest number."""
    n = F.regexp_extract(path, r"checkpoint-(\d+)\z", 1)
    return paths.where(n != "").agg(F.max_by(path, n.cast("long")).alias(path))
