import hashlib
import random
import re

import numpy as np
import pytest

from foliospark.llm import jaccard_join as jac, substring_dedup as sub
from foliospark.llm.components import connected_components
from foliospark.llm.decontaminate import decontaminate
from foliospark.llm import wordhash
from foliospark.llm.wordhash import exact_numbers, word_table

SPLIT = re.compile("[\x20\x09-\x0d]+")
SCHEMA = "doc_id long, text string, c int, n_words string, found string"  # columns that clash with inner names


def words(text):
    return [w for w in SPLIT.split(text or "") if w]


def prose(draw, n, vocabulary=3000):
    return [f"w{draw.randrange(vocabulary)}" for _ in range(n)]


@pytest.fixture(scope="module")
def corpus():
    draw = random.Random(11)
    docs, passage = [], prose(draw, 45)
    base = prose(draw, 160)
    for i in range(60):
        w = prose(draw, draw.choice([0, 1, 2, 5, 19, 20, 21, 120]))
        if i % 4 == 0:
            w = w[:50] + passage + w[50:]
        docs.append(" ".join(w))
    for k in range(70):  # one large group of near copies, some too far from its base to link with it
        w = list(base)
        for _ in range(draw.choice([0, 1, 1, 2, 2, 3, 4, 6])):
            w[draw.randrange(len(w))] = f"e{draw.randrange(10_000)}"
        docs.append("\t\n ".join(w) if k % 9 == 0 else " ".join(w))
    docs += [None, "", "  \n ", "a a a a a", " ".join(["x", "y", "z", "v", "u"] * 30), "É " * 25, "one two", "ONE Two", "z" * 70_000, " ".join(prose(draw, 30_000))]
    docs += docs[10:20]
    return [(i * 3 % 1000, t, i, "x", None) for i, t in enumerate(docs)]


def dedup_brute(rows):
    seen, gone = set(), {}
    for doc, text in sorted(rows, key=lambda r: r[0]):
        w = words(text)
        gone[doc] = set()
        for i in range(len(w) - 19):
            key = tuple(w[i : i + 20])
            if key in seen:
                gone[doc] |= set(range(i, i + 20))
            seen.add(key)
    return {d: (len(words(t)), len(gone[d]), hashlib.sha256(" ".join(w for i, w in enumerate(words(t)) if i not in gone[d]).encode()).hexdigest()) for d, t in rows}


def test_substring_dedup_against_brute_force(spark, corpus):
    got = sub.substring_dedup(spark.createDataFrame(corpus, SCHEMA).repartition(5)).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got} == dedup_brute([r[:2] for r in corpus])


def test_substring_dedup_carries_columns_and_keeps_clean_texts(spark, corpus):
    got = sub.substring_dedup(spark.createDataFrame(corpus, SCHEMA), kept_text=True)
    assert got.columns[:5] == ["doc_id", "text", "c", "n_words", "found"]
    rows = {r[0]: r for r in got.select("doc_id", "text", "c", "n_removed").collect()}
    for doc, text, c, *_ in corpus:
        assert rows[doc].c == c
        if not rows[doc].n_removed:
            assert rows[doc].text == text


def test_substring_dedup_repeated_rows_null_ids_empty_table(spark):
    t = " ".join(f"k{i}" for i in range(30))
    got = sorted(map(tuple, sub.substring_dedup(spark.createDataFrame([(1, t), (1, t), (2, t), (None, t)], "doc_id long, text string")).select("doc_id", "n_removed").collect()), key=str)
    assert got == [(1, 30), (1, 30), (2, 30), (None, 0)]
    got = sub.substring_dedup(spark.createDataFrame([(1, t), (1, t)], "doc_id long, text string"))
    assert [r.n_removed for r in got.collect()] == [0, 0]
    assert sub.substring_dedup(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_substring_dedup_where_a_chunk_has_few_words(spark):
    """Fewer words than a window in all: from none to nineteen, each alone in the table."""
    for n in (0, 1, 2, 3, 16, 19, 20):
        got = sub.substring_dedup(spark.createDataFrame([(n, " ".join(f"w{k}" for k in range(n)))], "doc_id long, text string")).collect()
        assert [(r.doc_id, r.n_words, r.n_removed) for r in got] == [(n, n, 0)]


def test_fm_index_counts_patterns():
    draw = np.random.default_rng(1)
    symbols = draw.integers(1, 6, 400)
    size = np.array([100, 37, 263])
    left = np.concatenate([np.arange(n)[::-1] for n in size])
    index = sub.FmIndex(symbols, left)
    step, depth = sub.BLOCK, sub.SIZE // sub.BLOCK
    grams = [tuple(symbols[i + k * step] for k in range(depth)) for i in range(400) if left[i] >= step * (depth - 1)]
    patterns = np.array(sorted(set(grams)))
    deep, low, high = index.search(patterns, least=1)
    assert (deep == depth).all()
    assert [(high - low)[k] for k in range(len(patterns))] == [grams.count(tuple(p)) for p in patterns]


def shingles(text, k=3):
    w = words((text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def test_jaccard_join_against_brute_force(spark, corpus):
    rows = [r[:2] for r in corpus]
    sets = {d: shingles(t) for d, t in rows}
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jac.jaccard_join(spark.createDataFrame(corpus, SCHEMA).repartition(4)).collect()}
    assert got == {d: (len(s), root(d)) for d, s in sets.items()}
    assert len({c for _, c in got.values()}) < len(got) - 40


def test_jaccard_join_empty_table(spark):
    assert jac.jaccard_join(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 160)] + [(200, 200)]
    random.Random(2).shuffle(edges)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {k: 100 for k in range(100, 160)} | {200: 200}


def test_word_table_matches_a_plain_split():
    texts = ["a b\x0bc", "", "  x", "é\u00a0y z\n", "tail"]
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(raw), dtype=np.uint8)
    start, stop, owner, h = word_table(data, np.cumsum([len(r) for r in raw]))
    got = [(int(o), bytes(data[a:b]).decode()) for o, a, b in zip(owner, start, stop)]
    assert got == [(i, w) for i, t in enumerate(texts) for w in words(t)]
    assert len(set(h.tolist())) == len({w for _, w in got})


def leak_brute(docs, items):
    cut = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    windows = {}
    for item, text in items:
        w = cut.findall((text or "").translate(low))
        for i in range(max(1, len(w) - 12) if w else 0):
            windows.setdefault(tuple(w[i : i + 13]), set()).add(str(item))
    out = {}
    for doc, text in docs:
        w, hit, found = cut.findall((text or "").translate(low)), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if (got := windows.get(tuple(w[i : i + n]))):
                    hit |= set(range(i, i + n))
                    found |= got
        out[doc] = (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w))
    return out


@pytest.mark.parametrize("limit", [200_000, 0])
def test_decontamination_against_brute_force(spark, limit):
    draw = random.Random(4)
    items = [(i, " ".join(prose(draw, draw.choice([13, 14, 30, 60]), 400)).upper()) for i in range(12)] + [(50, "short one here"), (51, None), (52, ""), (7, "Été 5 w1"), (60, "solo")]
    docs = []
    for i in range(60):
        w = prose(draw, draw.choice([0, 3, 12, 13, 40, 200]), 400)
        for _ in range(draw.choice([0, 0, 1, 2])):
            src = (draw.choice(items)[1] or "").split()
            a = draw.randrange(max(1, len(src)))
            w[draw.randrange(len(w) + 1) : 0] = src[a : a + draw.choice([5, 12, 13, 20])]
        docs.append((i, ("," if i % 3 else "\n").join(w)))
    docs += [(100, None), (101, ""), (102, "a short one-here solo"), (103, "ÉTÉ 5 W1 été 5 w1"), (104, " ".join(prose(draw, 20_000, 400)))]
    frame = spark.createDataFrame([(d, t, "x", 1) for d, t in docs], "doc_id long, text string, _w string, fp int")
    got = decontaminate(frame, spark.createDataFrame(items, "item_id long, text string"), broadcast_rows=limit)
    assert {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got.collect()} == leak_brute(docs, items)


def test_decontamination_without_items_or_documents(spark):
    items = spark.createDataFrame([], "item_id long, text string")
    docs = spark.createDataFrame([(1, "a b c"), (None, "x")], "doc_id long, text string")
    assert sorted(map(tuple, decontaminate(docs, items).select("doc_id", "n_hit", "contaminated").collect()), key=str) == [(1, 0, False), (None, 0, False)]
    assert decontaminate(docs.limit(0), spark.createDataFrame([(1, "a b")], "item_id long, text string")).collect() == []


def thue_morse(n):
    return "".join("ab"[bin(i).count("1") % 2] for i in range(n))


def test_words_that_a_polynomial_hashes_alike_stay_apart(spark):
    a, b = thue_morse(1024), thue_morse(1024).translate(str.maketrans("ab", "ba"))
    t = [f"k{i}" for i in range(19)]
    rows = spark.createDataFrame([(1, " ".join([*t, a])), (2, " ".join([*t, b])), (3, a), (4, b)], "doc_id long, text string")
    assert [r.n_removed for r in sub.substring_dedup(rows).orderBy("doc_id").collect()] == [0, 0, 0, 0]
    assert [r.component_id for r in jac.jaccard_join(rows).orderBy("doc_id").collect()] == [1, 2, 3, 4]


def test_numbers_are_exact_whatever_the_hashes():
    raw = [b"a", b"b", b"a", b"cc", b"b", b"", b"cc", b"cd"]
    data, ends = np.frombuffer(b"".join(raw), dtype=np.uint8), np.cumsum([len(r) for r in raw])
    begin = ends - [len(r) for r in raw]
    for h in (np.zeros(8, np.uint64), np.array([len(r) for r in raw], np.uint64), np.array([sum(r) % 3 for r in raw], np.uint64)):
        got = exact_numbers(data, begin, ends, h)
        assert [[x == y for x in got] for y in got] == [[x == y for x in raw] for y in raw]


@pytest.mark.parametrize("bits", [3, 10])
def test_runs_are_exact_when_hashes_collide(monkeypatch, bits):
    draw = np.random.default_rng(bits)
    number = draw.integers(0, 3, 300)
    monkeypatch.setattr(wordhash, "mix", lambda h: h & np.uint64((1 << bits) - 1))
    got, runs = wordhash.exact_runs(number, 5), [tuple(number[i : i + 5]) for i in range(296)]
    assert len(set(got.tolist())) == len(set(runs)) == len(set(zip(got.tolist(), runs)))


def test_substring_dedup_of_differing_texts_under_one_id(spark):
    draw = random.Random(8)
    p, q = prose(draw, 25, 10**6), prose(draw, 30, 10**6)
    a, b = " ".join(p + q), " ".join(["x", "y"] + q)
    rows = [(5, a), (5, b), (5, a), (9, " ".join(q)), (None, " ".join(p)), (7, None)]
    found = sub.substring_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    got = sorted(((r.doc_id, r.n_words, r.n_removed, [tuple(x) for x in r.intervals]) for r in found), key=str)
    # p stands first in the null row, q in b (at 2) before a (at 25).
    assert got == sorted([(5, 55, 55, [(0, 55)]), (5, 55, 55, [(0, 55)]), (5, 32, 0, []), (9, 30, 30, [(0, 30)]), (None, 25, 0, []), (7, 0, 0, [])], key=str)


def test_jaccard_join_of_differing_texts_under_one_id_and_of_null_ids(spark):
    draw = random.Random(6)
    a, b, c, d = (prose(draw, 100, 10**6) for _ in range(4))
    near = lambda w: " ".join([*w[:-1], "end"])
    rows = [(7, " ".join(a)), (7, " ".join(b)), (7, " ".join(b)), (9, near(b)), (3, near(a)), (None, " ".join(c)), (None, near(c)), (12, " ".join([*c[:-1], "other"])), (None, " ".join(d)), (None, None), (4, "")]
    got = sorted((map(tuple, jac.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "component_id").collect())), key=str)
    assert got == sorted([(7, 3), (7, 3), (7, 3), (9, 3), (3, 3), (None, 12), (None, 12), (12, 12), (None, None), (None, None), (4, 4)], key=str)
