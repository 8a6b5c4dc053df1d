"""Texts to be read aloud: page numbers removed, paragraphs split, work dealt to processes and devices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.text import WS, strip

# The patterns of this module are fixed values: they say what a page number, a paragraph and a part file are.


def remove_page_numbers(text: Column) -> Column:
    """Lines that are a number, begin with one or end in one, on the whole text: a number on a line of its
    own takes the line before it along, as white space may run over a line's end."""
    number = rf"(?md)^[{WS}]*\p{{Nd}}+[{WS}]*$|^[{WS}]*\p{{Nd}}+[{WS}]+[^\n]*$|^[^\n]*[{WS}]+\p{{Nd}}+[{WS}]*$"
    return strip(F.regexp_replace(F.regexp_replace(text, number, ""), rf"\n[{WS}]*\n", "\n"))


def rejoin(text: Column) -> Column:
    return F.regexp_replace(text, r"(?<=[a-z])\n\n+(?=[a-z])", " ")


def unwrap(text: Column) -> Column:
    return strip(F.regexp_replace(text, r"(?<![.!?])\n(?![A-Z])", " "))


def paragraphs(texts: DataFrame, keys: list[str], text: str = "text", clean_first: bool = False) -> DataFrame:
    """keys, para_no (from 0) and paragraph. clean_first removes page numbers, and with them all empty lines."""
    t = remove_page_numbers(F.col(text)) if clean_first else F.col(text)
    parts = F.filter(F.transform(F.split(rejoin(t), r"\n\n+"), unwrap), lambda p: p != "")
    return texts.select(*keys, F.posexplode(parts).alias("para_no", "paragraph")).withColumn("para_no", F.col("para_no").cast("long"))


def schedule(paras: DataFrame, keys: list[str], devices: int, prefix: str = "data/output") -> DataFrame:
    """paras with proc, gpu, part and path: contiguous runs of ceil(n / processes) paragraphs, one process for
    each device (one without any, never more than paragraphs)."""
    w = Window.partitionBy(*keys)
    out = paras.withColumns({"_n": F.count("*").over(w), "_i": F.row_number().over(w.orderBy("para_no")) - 1})
    out = out.withColumn("_size", F.ceil(F.col("_n") / F.least(F.lit(max(devices, 1)), F.col("_n"))))
    out = out.withColumn("proc", F.floor(F.col("_i") / F.col("_size")).cast("long"))
    out = out.withColumns({"gpu": F.pmod("proc", F.lit(devices)).cast("long") if devices > 0 else F.lit(-1).cast("long"), "part": (F.col("_i") - F.col("proc") * F.col("_size")).cast("long")})
    return out.withColumn("path", F.concat(F.lit(f"{prefix}_part_proc"), "proc", F.lit("_part_"), "gpu", F.lit("_"), "part", F.lit(".wav"))).drop("_n", "_i", "_size")


def part_order(path: str = "path", by_name: bool = False) -> list[Column]:
    """Parts in the order of their numbers; by_name: of their names, where _10 comes before _2."""
    number = lambda k: F.regexp_extract(path, r"_proc(\d+)_part_-?\d+_(\d+)\.wav\z", k).cast("long")
    return [F.col(path)] if by_name else [number(1), number(2), F.col(path)]
