"""Line operators against folds over plain lists, on random ordered lines."""
import random
import re

import pytest
from pyspark.sql import functions as F

from foliospark.functions import text as T
from foliospark.operators import corpus as E, lines as L

ROMAN = r"(?=[MDCLXVI])M{0,4}(CM|CD|D?C{0,3})(XC|XL|L?X{0,3})(IX|IV|V?I{0,3})\.?"
ITEM = re.compile(rf"([\d•◦∙·‣⁃-]|[a-zA-Z]\)|[a-zA-Z]\.|{ROMAN})\s+")
POOL = ["", "   ", "•", " - ", "5", "12", "a) item", "A. x", "I went", "IV. x", "xiv.", "- dash item", "a long enough line of plain text here", "another line of plain text, also long ", "  padded line with enough characters\t ", "____", "x", "        •     ", "..-..-..", "a  b \t c"]


def classify(line, lines):
    sizes = [len(x) for x in lines if x]
    short = sum(sizes) / len(sizes) * 0.5 if sizes else 10
    s = line.strip()
    if not s:
        return "Empty Line"
    if re.fullmatch(ROMAN, s, re.I):
        return "Roman Numeral"
    return "Likely Short/Header" if len(line) < short or line.count(".") + line.count("-") > 5 else "Regular Line"


def kept(rows):
    return [(x, c) for x, c in rows if not (c and re.match(r"\s*(\d+|[A-Za-z]|_+)\s*$", x))]


def tidy(lines):
    return [y for y in (re.sub("\t+", "", re.sub(" +", " ", x)) for x in lines) if y.strip()]


def bullets(lines):
    out, rest = [], list(lines)
    while rest:
        x = rest.pop(0)
        out.append(f"{x.strip()} {rest.pop(0).strip()}" if re.fullmatch(r"[\d•◦∙·‣⁃-]", x.strip()) and rest else x)
    return out


@pytest.fixture(scope="module")
def books():
    draw = random.Random(5)
    return [[draw.choice(POOL if b % 3 else POOL[:4] + POOL[10:14] + POOL[17:18]) for _ in range(draw.randrange(1, 25))] for b in range(120)]


@pytest.fixture(scope="module")
def frame(spark, books):
    rows = [(b, i * 10, x) for b, lines in enumerate(books) for i, x in enumerate(lines)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "book long, line_no long, line string").repartition(7)


def gathered(df, n):
    out = [[] for _ in range(n)]
    for r in sorted(df.collect(), key=lambda r: (r.book, r.line_no)):
        out[r.book].append(r.line)
    return out


def test_classes_and_checks(frame, books):
    got = {(r.book, r.line_no): (r["class"], r.check) for r in L.classify_lines(frame, ["book"]).collect()}
    for b, lines in enumerate(books):
        for i, x in enumerate(lines):
            c = classify(x, lines)
            assert got[b, i * 10] == (c, c != "Regular Line"), x


def test_each_step_and_the_whole(frame, books):
    marked = [[(x, classify(x, lines) != "Regular Line") for x in lines] for lines in books]
    checked = L.filter_unwanted(L.classify_lines(frame, ["book"]))
    assert gathered(checked, len(books)) == [[x for x, _ in kept(m)] for m in marked]
    glued = gathered(L.concat_paragraphs(checked, ["book"]), len(books))
    for m, out in zip(marked, glued):
        rows = kept(m)
        # No word is lost or moved; a line begins anew after a checked one, and otherwise only as a list item.
        assert " ".join(out).split() == " ".join(x for x, _ in rows).split()
        assert len(out) >= 1 + sum(c for _, c in rows[:-1]) if rows else not out
        assert len(out) <= 1 + sum(c or bool(ITEM.match(y.strip() + " ")) for (_, c), (y, _) in zip(rows, rows[1:])) if rows else not out
    assert gathered(L.drop_blank(frame), len(books)) == [tidy(lines) for lines in books]
    assert gathered(L.merge_bullets(frame, ["book"]), len(books)) == [bullets(lines) for lines in books]
    assert gathered(L.clean_lines(frame, ["book"]), len(books)) == [bullets(tidy(g)) for g in glued]


#: (lines, the numbers of checked ones, what they are glued to), by hand.
GLUED = [
    (["one", " two ", "three "], [], ["one two  three"]),
    (["  head", "tail  "], [], ["  head tail"]),  # the first line's own blanks stay
    (["one", "- x", "• x", "1 x", "a) x", "A. x", "IV. x", "iv. x"], [], ["one", "- x", "• x", "1 x", "a) x", "A. x", "IV. x iv. x"]),
    (["one", "1. x", "12 x"], [], ["one 1. x 12 x"]),  # no markers: a digit needs white space after it
    (["one", "I went"], [], ["one", "I went"]),
    (["HEAD", "one", "two"], [0], ["HEAD", "one two"]),
    (["one", "HEAD", "two"], [1], ["one HEAD", "two"]),
    (["one", "  •  ", "two"], [], ["one", "  •   two"]),  # a marker alone begins a line only with a text behind it
    (["one", "  •  "], [], ["one •"]),
    (["one", "•", ""], [], ["one •"]),
    (["one", "•", "•", "two"], [], ["one •", "• two"]),
    ([""], [], [""]),
]


def test_gluing_by_hand(spark):
    rows = [(b, i, x, i in checked) for b, (lines, checked, _) in enumerate(GLUED) for i, x in enumerate(lines)]
    got = gathered(L.concat_paragraphs(spark.createDataFrame(rows, "book long, line_no long, line string, check boolean"), ["book"]), len(GLUED))
    for out, (lines, _, want) in zip(got, GLUED):
        assert out == want, lines


def test_books_without_text(spark):
    pages = spark.createDataFrame([(1, 0, None), (2, 0, "  \n")], "book long, line_no long, text string").select("book", "text")
    assert L.cleaned_book(pages, ["book"]) is None
    some = pages.union(spark.createDataFrame([(3, "a line\nand more")], "book long, text string"))
    assert [r.line for r in L.cleaned_book(some, ["book"]).collect()] == ["a line and more"]


def test_stats_and_front_matter(spark, frame, books):
    got = {r.book: r for r in L.line_stats(frame, ["book"]).collect()}
    for b, lines in enumerate(books):
        n = [len(x) for x in lines if x]
        assert (got[b].mean is None) == (not n) and got[b].threshold == pytest.approx(sum(n) / len(n) / 2 if n else 10)
    assert gathered(L.skip_front(frame, ["book"], 3), len(books)) == [lines[3:] for lines in books]
    assert L.clean_lines(frame.limit(0), ["book"]).collect() == []


def test_sections(spark):
    draw = random.Random(9)
    kinds = ["_START_SECTION_ a", "_START_ARTICLE_", "_START_PARAGRAPH_", "text", "_START_SECTION_ _START_PARAGRAPH_"]
    books = [[draw.choice(kinds) for _ in range(30)] for _ in range(40)]
    rows = spark.createDataFrame([(b, i, x) for b, lines in enumerate(books) for i, x in enumerate(lines)], "book long, line_no long, line string")
    chosen = {(r.book, r.line_no) for r in E.select_tags(rows, "book").where("selected").collect()}
    tagged = sum(("SECTION" in x or "ARTICLE" in x) for lines in books for x in lines)
    assert abs(len(chosen) / tagged - 0.7) < 0.08
    want = []
    for b, lines in enumerate(books):
        skip, out = False, []
        for i, x in enumerate(lines):
            if (b, i) in chosen:
                skip = True
            elif "_START_PARAGRAPH_" in x:
                skip = False
            if not skip or "_START_PARAGRAPH_" in x:
                out.append(x)
        want.append(out)
    assert gathered(E.remove_sections(rows, "book"), len(books)) == want


def test_strip_split_and_roman_on_any_characters(spark):
    draw = random.Random(3)
    pool = list("abIVX. \t\n\r\x0b\x0c\x1c\x1f\x85\xa0 　​é😀")
    texts = ["".join(draw.choice(pool) for _ in range(draw.randrange(9))) for _ in range(3000)] + ["mix", "IIII", " iv ", "."]
    rows = spark.createDataFrame(list(enumerate(texts)), "i long, t string")
    got = rows.select("i", T.strip(F.col("t")).alias("s"), T.words(F.col("t")).alias("w"), T.is_roman(F.col("t")).alias("r")).collect()
    for r in got:
        assert r.s == texts[r.i].strip() and r.w == texts[r.i].split() and r.r == bool(re.fullmatch(ROMAN, texts[r.i].strip(), re.I) and "ı" not in texts[r.i])


def test_blanks_are_the_class(spark):
    every = spark.range(0x110000).where("not id between 55296 and 57343").select(F.expr("decode(unhex(lpad(hex(id), 8, '0')), 'UTF-32')").alias("c"))
    assert sorted(r.c for r in every.where(F.col("c").rlike(rf"\A[{T.WS}]\z")).collect()) == sorted(T.BLANKS) == sorted(r.c for r in every.where(F.col("c").rlike(rf"\A{T.BLANK}\z")).collect())


def test_texts_are_stripped_and_split_as_by_patterns(spark):
    some = random.Random(5)
    odd = ["", None, T.BLANKS, "a", f"{T.BLANKS}é{T.BLANKS}\U0001f600 {T.BLANKS}", "﻿a​", *("".join(some.choices([*T.BLANKS, "a", "é", "~", "!", "\x7f", "​"], k=12)) for _ in range(400))]
    c, w = F.col("t"), f"[{T.WS}]"
    pairs = {"strip": (T.strip(c), F.regexp_replace(c, rf"^{w}+|{w}+\z", "")), "lstrip": (T.lstrip(c), F.regexp_replace(c, f"^{w}+", "")), "words": (T.words(c), F.array_remove(F.split(c, f"{w}+"), "")),
             "squeeze": (T.squeeze(c), F.regexp_replace(F.regexp_replace(c, f"{w}+", " "), r"^ | \z", "")), "tidy": (L.clean_whitespace(c), F.regexp_replace(F.regexp_replace(c, " +", " "), "\t+", "")), "dots": (L.dot_dash(F.concat(c, F.lit(".-."), c)), F.lit(3).cast("long") + F.length(c) - F.length(c))}
    rows = spark.createDataFrame([(t,) for t in odd], "t string").select("t", *(F.struct(a.alias("a"), b.alias("b")).alias(k) for k, (a, b) in pairs.items())).collect()
    assert len(rows) == len(odd) and all(r[k].a == r[k].b for r in rows for k in pairs)


def test_ends_are_found_without_a_pattern(spark):
    plan = L.clean_lines(L.split_lines(spark.range(1).select("id", F.lit("a").alias("text")), ["id"]), ["id"])._jdf.queryExecution().optimizedPlan().toString()
    assert rf"[{T.WS}]+\z" not in plan
