"""Training pairs from tagged articles: sections removed, words packed, noise added."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.text import MARKERS, TAGS, dice, draw, greedy_ends, hits, let, roll, squeeze, token_length, words

ARTICLE, SECTION, PARAGRAPH, _ = TAGS
#: What a word may be prefixed with (LF FF VT BEL CR TAB BS), and the kinds of noise.
SPECIAL = (10, 12, 11, 7, 13, 9, 8)
KINDS = ("remove", "add", "swap", "special")
#: Fixed value: the prompt of a training pair.
PROMPT = "Correct the spelling mistakes and find the book sections in the following sentences without changing content or add any more sentences."


def tag(line: Column) -> Column:
    return F.when(line.contains(SECTION), "section").when(line.contains(ARTICLE), "article")


def select_tags(lines: DataFrame, key: str, p: float = 0.7, salt: str = "tags") -> DataFrame:
    """lines with tag and selected: each tagged line is chosen with probability p, by a hash of key and line_no."""
    out = lines.withColumn("tag", tag(F.col("line")))
    return out.withColumn("selected", F.col("tag").isNotNull() & (draw(key, "line_no", salt=salt) < p))


def remove_sections(lines: DataFrame, key: str, p: float = 0.7, salt: str = "tags") -> DataFrame:
    """Lines from a chosen tag up to the next paragraph tag go; a line with a paragraph tag always stays."""
    w = Window.partitionBy(key).orderBy("line_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    para = F.col("line").contains(PARAGRAPH)
    out = select_tags(lines, key, p, salt)
    skip = F.coalesce(F.last(F.when(F.col("selected"), 1).when(para, 0), ignorenulls=True).over(w), F.lit(0))
    return out.withColumn("_skip", skip).where((F.col("_skip") == 0) | para).select(key, "line_no", "line")


def reassemble(lines: DataFrame, key: str) -> DataFrame:
    """One text per key, without its first character (the corpus begins every article with a line break)."""
    rows = F.array_sort(F.collect_list(F.struct("line_no", "line")))
    return lines.groupBy(key).agg(F.substring(F.array_join(F.transform(rows, lambda x: x["line"]), "\n"), 2, 2**31 - 1).alias("text"))


def split_at_characters(docs: DataFrame, key: str, n: int, text: str = "text") -> DataFrame:
    """n contiguous runs of characters, fewer for a short text: one per 100 characters."""
    size = F.length(text)
    parts = F.when(F.lit(n) > size, F.greatest(F.lit(1), F.floor(size / 100).cast("int"))).otherwise(F.lit(n))
    out = docs.withColumn("_n", parts).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    begin = F.expr(f"cast(chunk * length(`{text}`) div _n as int)")
    end = F.expr(f"cast((chunk + 1) * length(`{text}`) div _n as int)")
    return out.select(key, F.col("chunk").cast("long").alias("chunk"), F.substring(F.col(text), begin + 1, end - begin).alias("chunk_text"))


def samples(docs: DataFrame, keys: list[str], text: str = "text", cap: int = 490, length: Callable[[Column], Column] = token_length) -> DataFrame:
    """keys, seq (from 0) and sample: words joined by blanks as long as their token lengths sum to at most cap.

    A word over the cap is a sample of its own; sums restart in every text. length: the token length of a word, a stand-in unless
    a tokenizer's own is given.
    """
    out = docs.select(*keys, words(F.coalesce(F.col(text), F.lit(""))).alias("_w")).withColumn("_z", F.transform("_w", lambda w: length(w).cast("long")))
    out = out.select(*keys, "_w", greedy_ends("_z", cap).alias("_e"))
    # The samples are cut in the row, so that no row carries all words once for each sample.
    out = out.select(*keys, F.posexplode(F.expr("transform(_e, (e, i) -> array_join(slice(_w, if(i = 0, 0, _e[i - 1]) + 1, e - if(i = 0, 0, _e[i - 1])), ' '))")).alias("seq", "sample"))
    return out.withColumn("seq", F.col("seq").cast("long"))


def quota(samples_: DataFrame, chunk: str, order: list[str], total: int, chunks: int, by: tuple[str, ...] = ()) -> DataFrame:
    """At most ceil(total / chunks) samples of each chunk, the first in order, and of these the first `total` in the order of chunks;
    by: the columns of which every value has its own total (a split of the dataset, say)."""
    first = Window.partitionBy(*by, chunk).orderBy(*order)
    out = samples_.withColumn("_k", F.row_number().over(first)).where(F.col("_k") <= -(-total // chunks))
    if not by:
        return out.orderBy(chunk, *order).limit(total).drop("_k")
    return out.withColumn("_k", F.row_number().over(Window.partitionBy(*by).orderBy(chunk, *order))).where(F.col("_k") <= total).drop("_k")


def offsets(rows: DataFrame, group: str, order: str, size: Column, pieces: int = 64) -> DataFrame:
    """rows with start: the sum of size over the rows of the group that come before, by a numeric order without ties.

    Sums are taken over `pieces` ranges of order first and inside them then, so no group is sorted in one task.
    """
    ends = rows.agg(F.min(order).alias("_low"), F.max(order).alias("_high"))
    at = rows.withColumn("_size", size.cast("long")).join(F.broadcast(ends), how="cross")  # one row
    at = at.withColumn("_piece", F.coalesce(F.expr(f"width_bucket(double(`{order}`), double(_low), double(_high) + 1, {pieces})"), F.lit(0)))
    sums = at.groupBy(group, "_piece").agg(F.sum("_size").alias("_sum"))
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_before", F.coalesce(F.sum("_sum").over(before(Window.partitionBy(group).orderBy("_piece"))), F.lit(0))).drop("_sum")
    inner = F.coalesce(F.sum("_size").over(before(Window.partitionBy(group, "_piece").orderBy(order))), F.lit(0))
    return at.join(sums, [group, "_piece"]).withColumn("start", F.col("_before") + inner).select(*rows.columns, "start")


def drop_fragment(text: Column) -> Column:
    """Up to the last ". ", ended by a full stop; unchanged without one."""
    return F.regexp_replace(text, r"(?s)\A(.*)\. .*\z", "$1.")


def remove_markers(text: Column) -> Column:
    return squeeze(F.regexp_replace(text, MARKERS, " "))


def noise_special(w: Column, *key: Column) -> Column:
    return special(w, dice(*key, salt="noise"))


def noise_remove(w: Column, *key: Column) -> Column:
    return remove(w, dice(*key, salt="noise"))


def noise_add(w: Column, *key: Column) -> Column:
    return add(w, dice(*key, salt="noise"))


def noise_swap(w: Column, *key: Column) -> Column:
    return swap(w, dice(*key, salt="noise"))


# The draws of a word's dice: whether it is changed, how, where, and a letter or a second place.
APPLY, KIND, PLACE, OTHER = range(4)


def special(w: Column, d: Column) -> Column:
    return F.concat(F.element_at(F.array(*(F.lit(chr(c)) for c in SPECIAL)), roll(d, PLACE, len(SPECIAL)) + 1), w)


def remove(w: Column, d: Column) -> Column:
    i = roll(d, PLACE, F.length(w))
    return F.when(F.length(w) > 1, F.concat(F.substring(w, F.lit(1), i), F.substring(w, i + 2, F.length(w)))).otherwise(w)


def add(w: Column, d: Column) -> Column:
    i = roll(d, PLACE, F.length(w) + 1)
    return F.concat(F.substring(w, F.lit(1), i), F.substring(F.lit("abcdefghijklmnopqrstuvwxyz"), roll(d, OTHER, 26) + 1, F.lit(1)), F.substring(w, i + 1, F.length(w)))


def swap(w: Column, d: Column) -> Column:
    """Two different places change letters; the second is drawn among the others, so no draw is thrown away."""
    return exchange(w, *places(w, d))


def places(w: Column, d: Column) -> tuple[Column, Column]:
    n = F.greatest(F.length(w), F.lit(1))
    i = roll(d, PLACE, n)
    return i, F.pmod(i + 1 + roll(d, OTHER, n - 1), n)


def exchange(w: Column, i: Column, j: Column) -> Column:
    """w with its letters at i and j exchanged. The condition names each of both twice, outside of any branch: so Spark computes them,
    and the digest below them, once a row and not at each mention in the branch."""
    a, b = F.least(i, j), F.greatest(i, j)
    at = lambda k: F.substring(w, k + 1, F.lit(1))
    return F.when(a < b, F.concat(F.substring(w, F.lit(1), a), at(b), F.substring(w, a + 2, b - a - 1), at(a), F.substring(w, b + 2, F.length(w)))).otherwise(w)


def introduce(w: Column, d: Column) -> Column:
    """w changed by the kind of noise that its dice choose."""
    kinds = lambda kind: F.when(kind == 0, remove(w, d)).when(kind == 1, add(w, d)).when(kind == 2, let(F.struct(*(x.alias(n) for x, n in zip(places(w, d), "ij"))), lambda p: exchange(w, p["i"], p["j"]))).otherwise(special(w, d))
    return let(roll(d, KIND, len(KINDS)), kinds)


def noisy(text: Column, key: Column, p: float = 0.1) -> Column:
    """Each word, with probability p, changed by one kind of noise; words joined by single blanks. One digest tells whether a word is
    changed, and is made again for all draws of those that are; what the digests of a text begin with is made once."""
    def one(start: Column) -> Column:
        dice_ = lambda i: F.md5(F.concat(start, i.cast("string")))  # noqa: E731  # dice(key, i, salt="noise")
        return F.array_join(F.transform(words(text), lambda w, i: F.when(hits(dice_(i), APPLY, p), let(dice_(i), lambda d: introduce(w, d))).otherwise(w)), " ")

    return let(F.concat(F.concat_ws(":", F.lit("noise"), key.cast("string")), F.lit(":")), one)


def noise_pairs(samples_: DataFrame, key: str, text: str, p: float = 0.1) -> DataFrame:
    """key, text (markers removed, noise added) and target (the sample as it is)."""
    return samples_.select(key, noisy(remove_markers(F.col(text)), F.col(key), p).alias("text"), F.col(text).alias("target"))


def prompt_rows(pairs: DataFrame, *keep: str, prompt: str = PROMPT) -> DataFrame:
    return pairs.select(*keep, F.lit(prompt).alias("Prompt"), F.coalesce("text", F.lit("")).alias("Train"), F.coalesce("target", F.lit("")).alias("Target"))
