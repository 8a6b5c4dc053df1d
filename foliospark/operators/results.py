"""Results after correction: which stay, and the text they make."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: More keys than this are joined away instead of being listed in the plan.
MAX_LISTED = 1_000


def filter_results(results: DataFrame, drop: list[int], index: str = "batch_index") -> DataFrame:
    """Successful results whose index isn't among `drop`; a null index stays."""
    ok = results.where(F.col("status") == "success")
    if len(drop) <= MAX_LISTED:
        return ok.where(F.col(index).isNull() | ~F.col(index).isin(drop)) if drop else ok
    gone = results.sparkSession.createDataFrame([(k,) for k in set(drop)], "k long")
    return ok.join(gone, F.col(index) == F.col("k"), "left_anti")


def removed_count(before: DataFrame, after: DataFrame) -> DataFrame:
    return before.agg(F.count("*").alias("before")).crossJoin(after.agg(F.count("*").alias("after"))).select((F.col("before") - F.col("after")).alias("removed"))


def joined(rows: DataFrame, keys: list[str], order: str, text: str, end: bool = False) -> DataFrame:
    """The non-empty texts in order, with an empty line between (end: after each) of them."""
    parts = F.transform(F.array_sort(F.collect_list(F.when(F.length(text) > 0, F.struct(order, text)))), lambda x: x[text])
    body: Column = F.array_join(parts, "\n\n")
    return rows.groupBy(*keys).agg(F.when(F.size(parts) > 0, F.concat(body, F.lit("\n\n"))).otherwise("").alias(text) if end else body.alias(text))
