"""Batched correction: lines to batches, prompts, results, and how far a result is from its batch."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ..functions.text import TAGS, greedy_ends, let, squeeze, token_length, words

#: Fixed value: the correction prompt, before and after a batch.
PROMPT = ("<|system|>\nCorrect the spelling mistakes and find the book sections in the following sentences. Do not change content or do not add any extra sentences.<|endoftext|>\n<|user|>\n", "<|endoftext|>\n<|assistant|>\n")


class Corrector(Protocol):
    """One model, loaded once for each Python worker; a text, or None where it fails."""

    def __call__(self, prompts: list[str]) -> list[str | None]: ...


def line_length(line: Column, length: Callable[[Column], Column] = token_length) -> Column:
    """Token length of a line and its line break; length: that of a word, a stand-in unless a tokenizer's own is given."""
    return F.aggregate(words(line), F.lit(1).cast("long"), lambda a, w: a + length(w).cast("long"))


def pack_lines(lines: DataFrame, keys: list[str], cap: int = 1024, length: Callable[[Column], Column] = token_length) -> DataFrame:
    """keys, batch_index and original_batch, its lines each ended by a line break; empty lines are left out.

    A line that doesn't fit a batch with lines in it ends that batch; alone over the cap it is a batch of its own. One that is over
    the cap and meets an empty batch stays in it until the next line comes. A book's lines are gathered in one row, as its batches
    depend on all before them.
    """
    rows = F.array_sort(F.collect_list(F.struct(F.col("line_no"), line_length(F.col("line"), length).alias("size"), F.col("line"))))
    out = lines.where(F.col("line") != "").groupBy(*keys).agg(rows.alias("_r"))
    out = out.select(*keys, F.col("_r.line").alias("_l"), F.col("_r.size").alias("_z"))
    out = out.select(*keys, "_l", greedy_ends("_z", cap, alone=True).alias("_e"))
    batch = F.expr("transform(_e, (e, i) -> concat(array_join(slice(_l, if(i = 0, 0, _e[i - 1]) + 1, e - if(i = 0, 0, _e[i - 1])), '\n'), '\n'))")
    return out.select(*keys, F.posexplode(batch).alias("batch_index", "original_batch")).withColumn("batch_index", F.col("batch_index").cast("long"))


def prompt(batch: Column) -> Column:
    return F.concat(F.lit(PROMPT[0]), batch, F.lit(PROMPT[1]))


def round_robin(index: Column, n: int) -> Column:
    return F.pmod(index, F.lit(n))


def correct(batches: DataFrame, make: Callable[[], Corrector], instances: int | None = None) -> DataFrame:
    """batches with processed_result and error, from a Corrector that make() loads once for each worker.

    A failing model never fails the job: its rows get a null result and the error's text.
    """
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in batches.schema)
    if instances:
        batches = batches.repartition(instances, round_robin(F.col("batch_index"), instances))

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = None
        for part in parts:
            prompts = [PROMPT[0] + b + PROMPT[1] for b in part["original_batch"]]
            try:
                model = model or make()
                out, errors = [normal_output(x) for x in model(prompts)], [None] * len(part)
            except Exception:  # noqa: BLE001
                out, errors = [], []
                for one in prompts:  # so that a failing prompt spoils no other
                    try:
                        model = model or make()
                        out.append(normal_output(model([one])[0]))
                        errors.append(None)
                    except Exception as e:  # noqa: BLE001
                        out.append(None)
                        errors.append(str(e) or type(e).__name__)
            yield part.assign(processed_result=pd.Series(out, index=part.index, dtype=object), error=pd.Series(errors, index=part.index, dtype=object))

    return batches.mapInPandas(run, f"{fields}, processed_result string, error string")


def normal_output(x) -> str | None:
    """A model's output as a text: [{'generated_text': t}] as t, None as None, anything else as it prints."""
    if isinstance(x, list) and x and isinstance(x[0], dict) and "generated_text" in x[0]:
        return x[0]["generated_text"]
    return x if x is None or isinstance(x, str) else str(x)


def normalise(text: Column, markers: tuple[str, ...] = TAGS) -> Column:
    """A text as it is compared: markers as blanks, "- " as "-", ellipses as dots, a blank before a capital
    that follows a full stop, white space collapsed."""
    for m in markers:
        text = F.replace(text, F.lit(m), F.lit(" "))
    text = F.replace(F.replace(text, F.lit("- "), F.lit("-")), F.lit("…"), F.lit("..."))
    return squeeze(F.regexp_replace(text, r"\.([A-Z])", ". $1"))


@F.pandas_udf(StructType([StructField(n, IntegerType()) for n in ("fails", "ratio", "last")]))
def first_failure(a: pd.Series, b: pd.Series, threshold: pd.Series) -> pd.DataFrame:
    """Of lists of word pairs: the place of the first whose ratio, round(100 * 2M / T) of the lower-cased words with M by the
    standard library's sequence matcher, isn't over the threshold, and its ratio; null where none is. last: the last one's ratio."""
    from difflib import SequenceMatcher

    known: dict[tuple[str, str], int] = {}

    def ratio(x: str, y: str) -> int:
        if (x, y) not in known:
            known[x, y] = int(round(100 * SequenceMatcher(None, x.lower(), y.lower()).ratio()))
        return known[x, y]

    rows = []
    for xs, ys, least in zip(a, b, threshold):
        found = next(((k, r) for k, (x, y) in enumerate(zip(xs, ys)) if (r := ratio(x, y)) <= least), (None, None))
        rows.append((*found, ratio(xs[-1], ys[-1]) if len(xs) else None))
    return pd.DataFrame(rows, columns=["fails", "ratio", "last"]).astype("Int32")


def prefix_scored(pairs: DataFrame, a: Column, b: Column, threshold: int = 90, fuzzy: bool = True) -> DataFrame:
    """pairs with match_count, matched_chars and last_match_ratio: words are compared in turn while their ratio is over threshold.

    All is done inside the row; only pairs of different words reach Python, and none after the first failure is scored but the last.
    fuzzy=False: 100 for equal words, 0 for others.
    """
    some = lambda c: words(F.coalesce(c, F.lit("")))
    at = pairs.select("*", some(a).alias("_a"), some(b).alias("_b")).withColumn("_n", F.least(F.size("_a"), F.size("_b")))
    at = at.withColumn("_d", F.expr("filter(transform(slice(_a, 1, _n), (x, i) -> if(x = _b[i] or lower(x) = lower(_b[i]), null, struct(i, x, _b[i] as y))), p -> p is not null)"))
    if fuzzy:
        at = at.withColumn("_f", first_failure(F.col("_d.x"), F.col("_d.y"), F.lit(threshold)))
    else:
        some_ = F.size("_d") > 0
        at = at.withColumn("_f", F.struct(F.when(some_, 0).alias("fails"), F.when(some_, 0).alias("ratio"), F.when(some_, 0).alias("last")))
    stop = F.col("_f.fails").isNotNull()
    at = at.withColumn("match_count", F.when(stop, F.get("_d", F.col("_f.fails"))["i"]).otherwise(F.col("_n")).cast("long"))
    ends_unlike = F.try_element_at("_d", F.lit(-1))["i"] == F.col("_n") - 1
    last = F.when(F.col("_n") == 0, 0).when(stop, F.col("_f.ratio")).when(ends_unlike, F.col("_f.last")).otherwise(100)
    chars = F.length(F.array_join(F.slice("_a", F.lit(1), F.col("match_count").cast("int")), "")).cast("long")
    return at.withColumns({"matched_chars": chars, "last_match_ratio": last.cast("int")}).drop("_a", "_b", "_n", "_d", "_f")


def prefix_score(pairs: DataFrame, keys: list[str], a: str, b: str, threshold: int = 90, fuzzy: bool = True) -> DataFrame:
    return prefix_scored(pairs.select(*keys, a, b), F.col(a), F.col(b), threshold, fuzzy).drop(a, b)


def compare(done: DataFrame, embed: Callable[[Column], Column], original: str = "original_batch", result: str = "processed_result", fuzzy: bool = True) -> DataFrame:
    """done with comparison: (fuzzy_match_score: (match_count, matched_chars, last_match_ratio), cosine_similarity) of the texts as they
    are compared (see normalise; markers are taken out of the result alone); null where there is no result.

    embed: the vector of a text.
    """
    left, right = normalise(F.col(original), ()), normalise(F.col(result))
    at = prefix_scored(done.select(F.struct("*").alias("_in"), left.alias("_x"), right.alias("_y")), F.col("_x"), F.col("_y"), fuzzy=fuzzy)
    score = F.struct("match_count", "matched_chars", "last_match_ratio").alias("fuzzy_match_score")
    both = F.when(F.col(f"_in.{result}").isNotNull(), F.struct(score, cosine(embed(F.col("_x")), embed(F.col("_y"))).alias("cosine_similarity")))
    return at.select("_in.*", both.alias("comparison"))


def mean_pool(rows: DataFrame, key: str, vector: str, order: str | None = None, most: int = 512) -> DataFrame:
    """key and the mean vector of its rows, by place; partial sums are kept for each key and place. order: if given, of
    the first `most` rows in that order (a model's tokens, say)."""
    if order:
        rows = rows.withColumn("_k", F.row_number().over(Window.partitionBy(key).orderBy(order))).where(F.col("_k") <= most)
    at = rows.select(key, F.posexplode(vector).alias("i", "x")).groupBy(key, "i").agg(F.avg(F.col("x").cast("double")).alias("x"))
    return at.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda s: s["x"]).alias(vector))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity in double precision; 0 beside a zero vector, null beside a null."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    ratio = lambda x, y, norm: F.when(norm == 0, F.lit(0.0)).otherwise(dot(x, y) / norm)
    return let(a, lambda x: let(b, lambda y: let(F.sqrt(dot(x, x)) * F.sqrt(dot(y, y)), lambda norm: ratio(x, y, norm))))


def result_records(done: DataFrame, *keep: str) -> DataFrame:
    """Status and error of processed batches: a null result has failed; an error from the call itself is a future_error."""
    status = F.when(F.col("error").isNotNull(), "future_error").when(F.col("processed_result").isNull(), "processing_failed").otherwise("success")
    more = ["comparison"] if "comparison" in done.columns else []  # see compare
    return done.select(*keep, "batch_index", "original_batch", "processed_result", *more, status.alias("status"), "error")


def outcome_counts(results: DataFrame, *keys: str) -> DataFrame:
    ok = F.when(F.col("status") == "success", 1).otherwise(0)
    return results.groupBy(*keys).agg(F.sum(ok).cast("long").alias("succeeded"), F.sum(1 - ok).cast("long").alias("failed"))
