"""Page quality: how much of a page a dictionary knows, and where the page goes next."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.sizes import dealt
from ..functions.text import dictionary_tokens, strip

#: Dictionaries up to this many words are broadcast; larger ones are joined by a shuffle.
BROADCAST_WORDS = 1_000_000


def build_dictionary(*sources: DataFrame, text: str = "text") -> DataFrame:
    """word: the distinct lower-case tokens of all sources, two letters or more."""
    out = None
    for source in sources:
        one = source.select(F.explode(dictionary_tokens(F.col(text))).alias("word")).select(F.lower("word").alias("word"))
        out = one if out is None else out.unionByName(one)
    return out.where(F.length("word") >= 2).distinct()


def word_counts(pages: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """keys, word and n: how often each token occurs under its keys. A task counts what it reads before that is shuffled, so large
    inputs are dealt to small pieces first: the table of a task doesn't grow with them, nor with the size of a split."""
    tokens = dealt(pages.select(*dict.fromkeys([*keys, text]))).select(*keys, F.explode(dictionary_tokens(F.col(text))).alias("word"))
    return tokens.groupBy(*keys, "word").agg(F.count("*").alias("n"))


def valid_word_ratio(pages: DataFrame, dictionary: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """keys, tokens, known and ratio of every page (rows that share keys are one page); 0.0 for a page without a token.

    A dictionary of up to BROADCAST_WORDS words is fetched once, by an action of its own, and sent to the pages: their tokens
    meet it where they are, and only two sums of each page are shuffled.
    """
    known = dictionary.select("word", F.lit(1).alias("known")).distinct()
    found = dictionary.select("word").distinct().limit(BROADCAST_WORDS + 1).collect()
    if len(found) <= BROADCAST_WORDS:
        known = F.broadcast(dictionary.sparkSession.createDataFrame([(r["word"], 1) for r in found], "word string, known int"))
    tokens = pages.select(*keys, F.explode_outer(dictionary_tokens(F.col(text))).alias("_t")).withColumn("word", F.lower("_t"))
    sums = tokens.join(known, "word", "left").groupBy(*keys).agg(F.count("_t").alias("tokens"), F.count("known").alias("known"))
    return sums.withColumn("ratio", F.when(F.col("tokens") == 0, F.lit(0.0)).otherwise(F.col("known") / F.col("tokens")))


def route(text: Column, ratio: Column, min_ratio: float = 0.8, min_chars: int = 10) -> Column:
    """'short' and 'garbled' pages go to recognition, 'ok' ones stay."""
    return F.when(F.length(strip(F.coalesce(text, F.lit("")))) <= min_chars, "short").when(ratio < min_ratio, "garbled").otherwise("ok")


def page_record(text: Column, route_: Column | None = None, recognised: Column | None = None) -> Column:
    """(text, prob): the recognised text of a page that isn't 'ok', empty where recognition failed; else the page's own."""
    own = F.coalesce(text, F.lit(""))
    return F.struct((own if route_ is None else F.when(route_ == "ok", own).otherwise(F.coalesce(recognised, F.lit("")))).alias("text"), F.lit(0).alias("prob"))


def recognise(pages: DataFrame, routed: str, recogniser, text: str = "text") -> DataFrame:
    """Run recogniser (a function of an iterator of Arrow batches, for mapInArrow) over the pages that need it alone."""
    todo = pages.where(F.col(routed) != "ok")
    return pages.where(F.col(routed) == "ok").unionByName(todo.mapInArrow(recogniser, todo.schema)).withColumn(text, F.coalesce(text, F.lit("")))
