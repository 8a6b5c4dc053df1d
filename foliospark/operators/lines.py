"""Lines: their structure, and the order-sensitive clean-up of a book's lines.

Lines are rows (keys, line_no, line); what depends on neighbours is a window over a book in line order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.text import BULLETS, LIST_MARKER, WS, is_roman, lstrip, strip


def split_lines(pages: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """One row per line, empty ones too."""
    return pages.select(*keys, F.posexplode(F.split(F.col(text), "\n", -1)).alias("line_no", "line")).withColumn("line_no", F.col("line_no").cast("long"))


def concat_pages(pages: DataFrame, book: list[str], page: str = "page_no", text: str = "text") -> DataFrame:
    """One text per book, its non-null pages in order, for books that fit a row; split_lines over pages needs no such row."""
    rows = F.array_sort(F.collect_list(F.when(F.col(text).isNotNull(), F.struct(page, text))))
    return pages.groupBy(*book).agg(F.array_join(F.transform(rows, lambda x: x[text]), "\n").alias(text))


def ordered(keys: list[str]):
    return Window.partitionBy(*keys).orderBy("line_no")


def line_stats(lines: DataFrame, keys: list[str], factor: float = 0.5, default: float = 10.0) -> DataFrame:
    """mean, std (of the population) and the short-line threshold over lines that aren't empty."""
    n = F.when(F.length("line") > 0, F.length("line").cast("double"))
    out = lines.groupBy(*keys).agg(F.avg(n).alias("mean"), F.stddev_pop(n).alias("std"))
    return out.withColumn("threshold", F.coalesce(F.col("mean") * factor, F.lit(default)))


def dot_dash(line: Column) -> Column:
    return (F.length(line) - F.length(F.replace(F.replace(line, F.lit("."), F.lit("")), F.lit("-"), F.lit("")))).cast("long")


def classify(line: Column, threshold: Column, max_dot_dash: int = 5) -> Column:
    short = (F.length(line) < threshold) | (dot_dash(line) > max_dot_dash)
    return F.when(strip(line) == "", "Empty Line").when(is_roman(line), "Roman Numeral").when(short, "Likely Short/Header").otherwise("Regular Line")


def classify_lines(lines: DataFrame, keys: list[str], factor: float = 0.5, default: float = 10.0) -> DataFrame:
    """lines with length, class and check. One shuffle by book serves this window and those that follow."""
    mean = F.avg(F.when(F.length("line") > 0, F.length("line").cast("double"))).over(Window.partitionBy(*keys))
    out = lines.withColumn("_threshold", F.coalesce(mean * factor, F.lit(default)))
    out = out.withColumns({"length": F.length("line").cast("long"), "class": classify(F.col("line"), F.col("_threshold"))}).drop("_threshold")
    return out.withColumn("check", F.col("class") != "Regular Line")


def unwanted(line: Column) -> Column:
    return line.rlike(rf"\A[{WS}]*(\p{{Nd}}+|[A-Za-z]|_+)[{WS}]*\z")


def filter_unwanted(lines: DataFrame) -> DataFrame:
    """Checked lines go if they hold digits only, one ASCII letter, or underscores only."""
    return lines.where(~(F.col("check") & unwanted(F.col("line"))))


def concat_paragraphs(lines: DataFrame, keys: list[str]) -> DataFrame:
    """Glue a line to the one before it unless that is checked or this one begins a list item.

    A line that holds a list marker alone counts as an item only with a text glued to it; in a run of
    such lines that alternates from below, which the distance to the end of the run tells.
    """
    w = ordered(keys)
    rest = w.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    s = strip(F.col("line"))
    out = lines.withColumns({"_i": F.row_number().over(w), "_item": s.rlike(rf"\A{LIST_MARKER}[{WS}]+"), "_follows": F.lead(s).over(w), "_after": F.lag("check").over(w)})
    out = out.withColumn("_bare", s.rlike(rf"\A{LIST_MARKER}\z") & ~F.col("check") & F.coalesce(F.col("_follows") != "", F.lit(False)))
    out = out.withColumns({"_end": F.min(F.when(~F.col("_bare"), F.col("_i"))).over(rest), "_base": F.first(F.when(~F.col("_bare"), F.col("_item")), ignorenulls=True).over(rest)})
    marked = F.col("_base") != (F.pmod(F.col("_end") - F.col("_i"), F.lit(2)) == 1)
    out = out.withColumn("_new", F.when((F.col("_i") == 1) | F.col("_after") | marked, 1).otherwise(0))
    out = out.withColumn("_g", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    rows = F.array_sort(F.collect_list(F.struct("line_no", "line")))
    out = out.groupBy(*keys, "_g").agg(F.min("line_no").alias("line_no"), rows.alias("_r"))
    head, tail = F.col("_r")[0]["line"], F.expr("slice(_r, 2, greatest(size(_r) - 1, 0))")
    n = F.size("_r") - 1
    glued = F.transform(tail, lambda x, i: F.when(i == n - 1, strip(x["line"])).otherwise(lstrip(x["line"])))
    return out.select(*keys, "line_no", F.when(n > 0, F.concat(head, F.lit(" "), strip(F.array_join(glued, " ")))).otherwise(head).alias("line"))


def clean_whitespace(line: Column) -> Column:
    return F.replace(F.regexp_replace(line, " {2,}", " "), F.lit("\t"), F.lit(""))


def drop_blank(lines: DataFrame) -> DataFrame:
    """Blanks collapsed, then tabs removed, then lines without a text dropped; the others aren't stripped."""
    return lines.withColumn("line", clean_whitespace(F.col("line"))).where(strip(F.col("line")) != "")


def merge_bullets(lines: DataFrame, keys: list[str]) -> DataFrame:
    """A line of one bullet takes the next line, whatever that is; in a run of bullets every other one takes."""
    w = ordered(keys)
    s = strip(F.col("line"))
    out = lines.withColumns({"_i": F.row_number().over(w), "_b": s.rlike(rf"\A{BULLETS}\z"), "_next": F.lead(s).over(w)})
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    # Bullets just before this line: the distance to the last line that isn't one.
    out = out.withColumn("_run", F.col("_i") - 1 - F.coalesce(F.max(F.when(~F.col("_b"), F.col("_i"))).over(before), F.lit(0)))
    out = out.where(F.pmod("_run", F.lit(2)) == 0)
    return out.select(*keys, "line_no", F.when(F.col("_b") & F.col("_next").isNotNull(), F.concat(s, F.lit(" "), "_next")).otherwise(F.col("line")).alias("line"))


def skip_front(lines: DataFrame, keys: list[str], k: int) -> DataFrame:
    return lines.withColumn("_i", F.row_number().over(ordered(keys))).where(F.col("_i") > k).drop("_i")


def clean_lines(lines: DataFrame, keys: list[str]) -> DataFrame:
    """Classify, filter, glue, clean and merge, in that order."""
    out = concat_paragraphs(filter_unwanted(classify_lines(lines, keys)), keys)
    return merge_bullets(drop_blank(out), keys)


def cleaned_book(pages: DataFrame, keys: list[str], text: str = "text") -> DataFrame | None:
    """clean_lines of pages, or None where there is no text at all to clean; lines of books without one are left out."""
    rows = pages.where(F.length(strip(F.coalesce(F.col(text), F.lit("")))) > 0)
    return None if rows.isEmpty() else clean_lines(split_lines(rows, keys, text), keys)
