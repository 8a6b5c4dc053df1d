"""Text functions with the semantics of Unicode-aware scripting languages, as Spark columns.

Patterns are written so that Java's engine and RE2 read them alike; what RE2 lacks (look-around) has a
twin beside it.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, functions as F

#: Inside of a character class: all Unicode white space, with the separators U+001C to U+001F.
WS = r"\s\x0b\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
#: The same 29 characters as a text, and as a class for Java's engine alone: most characters are told by one comparison.
BLANKS = "".join(map(chr, (*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
BLANK = f"[[^!-~]&&[{WS}]]"
WORD = r"(?<![\p{L}\p{N}_])[a-zA-Z]{2,}(?![\p{L}\p{N}_])"
#: Roman numerals, list markers, the corpus's tags and what a marker looks like.
ROMAN = r"(?=[MDCLXVI])M{0,4}(CM|CD|D?C{0,3})(XC|XL|L?X{0,3})(IX|IV|V?I{0,3})\.?"
BULLETS = r"[\p{Nd}•◦∙·‣⁃-]"
LIST_MARKER = rf"({BULLETS}|[a-zA-Z]\)|[a-zA-Z]\.|{ROMAN})"
TAGS = ("_START_ARTICLE_", "_START_SECTION_", "_START_PARAGRAPH_", "_NEWLINE_")
MARKERS = r"_[A-Z]+(_[A-Z]+)*_"


def strip(c: Column) -> Column:
    """Without white space at both ends, which are looked at from outside; a pattern would be tried at each place of the text."""
    return F.btrim(c, F.lit(BLANKS))


def lstrip(c: Column) -> Column:
    return F.ltrim(c, F.lit(BLANKS))


def words(c: Column) -> Column:
    """Words between any white space, without empty ones."""
    return F.array_remove(F.split(c, f"{BLANK}+"), "")


def squeeze(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, f"{BLANK}+", " "))


def dictionary_tokens(c: Column) -> Column:
    """ASCII words of two letters or more that no letter, digit or underscore touches."""
    return F.regexp_extract_all(c, F.lit(WORD), F.lit(0))


def is_roman(c: Column) -> Column:
    return strip(c).rlike(rf"(?i)\A{ROMAN}\z")


def greedy_ends(sizes: str, cap: int, alone: bool = False) -> Column:
    """Greedy groups of neighbours whose sizes sum to at most cap: the 1-based places where groups end, as an array.

    sizes: name of a column of array<bigint>. An element over the cap is a group of its own if others stand before it in its group;
    alone: then it ends its group, too; else the next element does. The fold runs over runs of elements, and its state holds
    only the ends of one run, as it is copied with every step.
    """
    full, more = f"t.n + x > {cap} and t.o = 1", "struct(concat(t.e, t.i, ',') as e, x as n, 1 as o, t.i + 1 as i)"
    if alone:
        more = f"if(x > {cap}, struct(concat(t.e, t.i, ',', t.i + 1, ',') as e, 0L as n, 0 as o, t.i + 1 as i), {more})"
    step = f"if({full}, {more}, struct(t.e as e, t.n + x as n, 1 as o, t.i + 1 as i))"
    run = f"aggregate(slice({sizes}, k * 512 + 1, 512), struct('' as e, s.n as n, s.o as o, k * 512 as i), (t, x) -> {step}, t -> struct(concat(s.e, t.e) as e, t.n as n, t.o as o))"
    last = f"if(s.o = 1, concat(s.e, size({sizes})), s.e)"
    return F.expr(f"transform(filter(split(aggregate(sequence(0, greatest(size({sizes}) - 1, 0) div 512), struct('' as e, 0L as n, 0 as o), (s, k) -> {run}, s -> {last}), ','), e -> e <> ''), e -> int(e))")


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """f(value), with value evaluated once however often f names it; for functions of lambdas, whose other parts Spark doesn't share."""
    return F.transform(F.array(value), f)[0]


def dice(*key: Column | str, salt: str) -> Column:
    """32 hexadecimal digits that depend on the key and the salt alone: four draws, of eight digits each."""
    return F.md5(F.concat_ws(":", F.lit(salt), *(F.col(k).cast("string") if isinstance(k, str) else k.cast("string") for k in key)))


def roll(dice_: Column, k: int, n: Column | int) -> Column:
    """A whole number from 0 to n - 1, of the k-th draw of dice."""
    return F.floor(F.conv(F.substring(dice_, 8 * k + 1, 8), 16, 10).cast("long").cast("double") / F.lit(4294967296.0) * n).cast("int")


def hits(dice_: Column, k: int, p: float) -> Column:
    """True with probability p, by the k-th draw of dice: its digits are compared as text."""
    least = math.ceil(p * 2**32)
    return F.lit(True) if least >= 2**32 else F.substring(dice_, 8 * k + 1, 8) < F.lit(f"{least:08x}")


def draw(*key: Column | str, salt: str) -> Column:
    """A number in [0, 1) that depends on the key and the salt alone, so neither on partitions nor on retries."""
    parts = [F.lit(salt), *(F.col(k).cast("string") if isinstance(k, str) else k.cast("string") for k in key)]
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def token_length(word: Column) -> Column:
    """Stand-in for a tokenizer: a quarter of the characters, rounded up, at least one."""
    return F.greatest(F.lit(1), F.ceil(F.length(word) / 4)).cast("long")
