import random

import __spark_entry__
import corpus_pipeline
import pytest

SF = "/root/testdata/sf0.001"


def test_pipeline_stages_keep_the_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id for r in docs.select("doc_id").collect()}
        docs = corpus_pipeline.materialise(stage(spark, docs, SF), name)
        after = {r.doc_id for r in docs.select("doc_id").collect()}
        assert after <= before and len(after) > 0.7 * len(before)
        if name != "packing":
            assert docs.columns == columns
    assert {"sequence_id", "offset", "ids_crc32"} <= set(docs.columns)


def test_near_duplicates_against_brute_force(spark):
    draw, rows = random.Random(4), []
    for i in range(24):
        w = [f"w{draw.randrange(10**6)}" for _ in range(100 + 100 * (i % 2))]
        rows.append((3 * i, " ".join(w)))
        for k in range(1, 3):  # far apart: from 5-word Jaccard 0.9 and 3-word Jaccard 0.94 down to what is no near copy
            c = list(w)
            for j in range((1 + i % 2) * (1 + (i // 2 + k) % 4)):
                c[10 + 11 * j] = f"n{i}k{k}j{j}"
            rows.append((3 * i + k, " ".join(c)))
    grams = lambda t, k: {tuple(t.split()[i : i + k]) for i in range(len(t.split()) - k + 1)}
    near = lambda a, b, k: len(grams(a, k) & grams(b, k)) / len(grams(a, k) | grams(b, k))
    group = {d: d for d, _ in rows}
    between = 0
    for a, s in rows:
        for b, t in rows:
            if a < b and a // 3 == b // 3 and near(s, t, 5) >= 0.8:
                between += near(s, t, 3) < 0.9
                low, high = sorted((group[a], group[b]))
                group = {d: low if g == high else g for d, g in group.items()}
    got = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), SF)
    assert between > 3 and {r.doc_id for r in got.collect()} == {d for d, g in group.items() if d == g}


ODD = "doc_id long, text string, n_chars int, n_words string, v int, _w string"


def odd(rows):
    return [(d, t, len(t or ""), "w", k, "x") for k, (d, t) in enumerate(rows)]


def key(rows):
    return sorted(map(tuple, rows), key=str)


def prose(draw, n):
    return " ".join(f"w{draw.randrange(10**6)}" for _ in range(n))


def test_every_stage_on_odd_rows(spark):
    """Nulls, empty and very long texts, ties, repeated rows and ids, clashing columns, by hand."""
    draw = random.Random(3)
    a, b, long = prose(draw, 120), prose(draw, 90), prose(draw, 30_000)
    near = " ".join([*a.split()[:-1], "other"])
    rows = odd([(None, None), (1, None), (2, ""), (3, a), (3, a), (4, near), (5, b), (5, long), (None, b), (None, a), (7, " ".join([*b.split()[:60], prose(draw, 500)]))])
    frame = spark.createDataFrame(rows, ODD)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, frame.limit(0), SF).columns == frame.columns and stage(spark, frame.limit(0), SF).collect() == []
    assert corpus_pipeline.packing(spark, frame.limit(0), SF).collect() == []

    # Near duplicates: a, its repeats and near copies (id 3 stands for them); b of ids 5 and null. Of rows without words none goes.
    kept = corpus_pipeline.near_duplicates(spark, frame, SF).collect()
    assert key((r.doc_id, r.text) for r in kept) == key([(None, None), (1, None), (2, ""), (3, a), (5, b), (5, long), (7, rows[10][1])])
    assert all(tuple(r) in rows for r in kept)

    # Repeated passages: null ids come first, so theirs stay; what others repeat of them goes, and texts of which nothing is left.
    kept = corpus_pipeline.repeated_passages(spark, frame, SF).collect()
    rest = " ".join(rows[10][1].split()[60:])
    assert key((r.doc_id, r.text, r.n_chars) for r in kept) == key([(None, None, 0), (1, None, 0), (2, "", 0), (4, "other", 5), (5, long, len(long)), (None, b, len(b)), (None, a, len(a)), (7, rest, len(rest))])

    # Leaks: a window of an item anywhere in a text, however long it is; equal ids don't matter.
    item = next(r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").collect() if r.text and len(r.text.split()) > 20)
    leaky = odd([(8, f"{long} {item}"), (8, "clean words here"), (None, item), (None, "more clean words"), (9, None), (9, None)])
    kept = corpus_pipeline.benchmark_leaks(spark, spark.createDataFrame(leaky, ODD), SF).collect()
    assert key(kept) == key(leaky[i] for i in (1, 3, 4, 5))

    # The classifier leaves every row as it is or out.
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(50).collect()
    more = spark.createDataFrame(rows + odd([(r.doc_id, r.text) for r in docs]), ODD)
    kept = corpus_pipeline.quality(spark, more, SF).collect()
    assert 20 < len(kept) <= 61 and {tuple(r) for r in kept} <= {tuple(r) for r in more.collect()}

    # Packing: every row's ids lie in pieces, each place in one.
    pieces = corpus_pipeline.packing(spark, frame, SF).collect()
    total = {}
    for r in pieces:
        total.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, r.length))
    assert sum(r.length for r in pieces) == sum(n * len([1 for s, _ in spans if s == 0]) for (_, n), spans in total.items())
    assert len({(r.sequence_id, r.offset) for r in pieces}) == len(pieces) and sum(r.start == 0 for r in pieces) == len(rows)


def test_small_inputs_are_not_written_as_heaps_of_tiny_files(spark, monkeypatch):
    """Far more shuffle partitions than the input asks for: no table of near_duplicates, no stage's result has a file for each."""
    from foliospark.llm import common, components, jaccard_join

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plain = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, SF).collect()}
    files = []

    def counted(df, tag):
        out = common.materialise(df, tag)
        files.append((len(out.inputFiles()), tag))
        return out

    monkeypatch.setattr(jaccard_join, "materialise", counted)
    monkeypatch.setattr(components, "materialise", counted)
    many = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in many}
    try:
        for k, v in many.items():
            spark.conf.set(k, v)
        got = counted(corpus_pipeline.near_duplicates(spark, docs, SF), "near_duplicates")
        counted(corpus_pipeline.repeated_passages(spark, got, SF), "repeated_passages")
        counted(corpus_pipeline.benchmark_leaks(spark, got, SF), "benchmark_leaks")
        counted(corpus_pipeline.packing(spark, got, SF), "packing")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert {r.doc_id for r in got.collect()} == plain and len(files) > 10
    assert max(files)[0] <= 2 * spark.sparkContext.defaultParallelism


def test_pipeline_is_registered():
    names = __spark_entry__.queries()
    assert "pipeline" in names and len([n for n in names if n.startswith("op")]) == 10


@pytest.mark.parametrize("name", ["op2_substring_dedup", "op4_decontaminate", "op6_url_filter"])
def test_sql_twins(spark, name):
    import duckdb

    c = duckdb.connect()
    for t in ("documents", "benchmark", "pages"):
        c.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    df = __spark_entry__.queries()[name](spark, SF)
    cur = c.execute(__spark_entry__.oracle_sql()[name])
    names = [x[0] for x in cur.description]
    assert sorted(map(repr, cur.fetchall())) == sorted(repr(tuple(r[k] for k in names)) for r in df.collect())
