import difflib
import math
import random
import wave

import pytest
from pyspark.sql import functions as F

from foliospark.operators import correction as G, corpus as E, pages as B, results as H, speech as I, training as R
from foliospark.sources import io
from foliospark.streaming import results as S


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"t {kind}").select(f(F.col("t")).alias("x")).first().x


def size(w):
    return max(1, math.ceil(len(w) / 4))


def test_word_packing(spark):
    """By hand, at a cap of 12: a quarter of a word's letters, rounded up, is its size."""
    w = lambda *n: " ".join("w" * k for k in n)
    cases = [("", []), (w(48), [w(48)]), (w(24, 24), [w(24, 24)]), (w(24, 24, 1), [w(24, 24), w(1)]), (w(1, 90, 1), [w(1), w(90), w(1)]), (w(90, 90), [w(90), w(90)]), (w(90), [w(90)]), (w(25, 20, 1), [w(25, 20), w(1)])]
    draw = random.Random(2)
    cases += [(w(*(draw.choice([1, 4, 9, 30, 90]) for _ in range(draw.choice([3, 40, 700, 1100, 3000])))), None) for _ in range(40)]
    rows = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "i long, text string")
    got = {}
    for r in E.samples(rows, ["i"], cap=12).orderBy("i", "seq").collect():
        assert r.seq == len(got.setdefault(r.i, []))
        got[r.i].append(r.sample)
    total = lambda s: sum(map(size, s.split()))
    for i, (t, want) in enumerate(cases):
        found = got.get(i, [])
        assert want is None or found == want
        assert " ".join(found) == t and all(total(s) <= 12 or " " not in s for s in found)
        assert all(total(a) + size(b.split()[0]) > 12 for a, b in zip(found, found[1:]))  # none could have held more
    whole = E.samples(rows.where("i = 2"), ["i"], cap=2, length=lambda c: F.lit(1)).collect()
    assert [r.sample for r in whole] == [w(24, 24)]


def test_quota(spark):
    rows = spark.createDataFrame([(s, c, i) for s in "ab" for c in range(4) for i in range(10)], "split string, chunk long, i long")
    one = rows.where("split = 'a'")
    assert sorted((r.chunk, r.i) for r in E.quota(one, "chunk", ["i"], 10, 4).collect()) == sorted([(c, i) for c in range(3) for i in range(3)] + [(3, 0)])
    both = E.quota(rows, "chunk", ["i"], 10, 4, by=("split",)).collect()
    assert len(both) == 20 and {(r.chunk, r.i) for r in both if r.split == "b"} == {(r.chunk, r.i) for r in E.quota(one, "chunk", ["i"], 10, 4).collect()}


def test_offsets_and_ordered_files(spark, tmp_path):
    draw = random.Random(5)
    rows = [(draw.choice("xyz"), i * i, "t" * draw.randrange(5)) for i in range(200)]
    frame = spark.createDataFrame(rows, "g string, k long, t string").repartition(5)
    got = {(r.g, r.k): r.start for r in E.offsets(frame, "g", "k", F.length("t") + 1, pieces=7).collect()}
    at = {}
    for g, k, t in rows:
        assert got[g, k] == at.get(g, 0)
        at[g] = at.get(g, 0) + len(t) + 1
    assert E.offsets(frame.limit(0), "g", "k", F.length("t")).collect() == []
    io.write_concat(frame, "g", "k", "t", str(tmp_path / "c"), pieces=3)
    for g in "xyz":
        files = sorted((tmp_path / "c" / f"g={g}").glob("part-*"))
        assert "".join(f.read_text() for f in files) == "".join(t + "\n" for h, _, t in rows if h == g)


def test_line_batching(spark):
    """By hand, at a cap of 20: a line's size is that of its words and one for its break."""
    w = lambda n: "w" * n
    cases = [
        ([], []), (["", ""], []), ([w(36), "", w(36)], [[w(36), w(36)]]),  # an exact fit; empty lines don't count
        ([w(36), w(36), w(1)], [[w(36), w(36)], [w(1)]]),
        ([w(90), w(1)], [[w(90)], [w(1)]]),  # too long, on an empty batch: the next line ends it
        ([w(1), w(90), w(1), w(1)], [[w(1)], [w(90)], [w(1), w(1)]]),  # too long, on a batch with lines
        ([w(1), w(90), w(200)], [[w(1)], [w(90)], [w(200)]]),
    ]
    draw = random.Random(4)
    cases += [([w(draw.choice([0, 1, 12, 40, 90, 200])) for _ in range(draw.choice([3, 30, 600]))], None) for _ in range(40)]
    rows = spark.createDataFrame([(b, i, x) for b, (ls, _) in enumerate(cases) for i, x in enumerate(ls)], "b long, line_no long, line string").repartition(5)
    got = {}
    for r in G.pack_lines(rows, ["b"], 20).orderBy("b", "batch_index").collect():
        assert r.batch_index == len(got.setdefault(r.b, []))
        got[r.b].append(r.original_batch)
    total = lambda lines: sum(size(x) + 1 for x in lines)
    for b, (ls, want) in enumerate(cases):
        found = got.get(b, [])
        assert "".join(found) == "".join(x + "\n" for x in ls if x)
        parts = [x.split("\n")[:-1] for x in found]
        assert want is None or parts == want
        assert all(total(p) <= 20 or len(p) == 1 for p in parts)
        assert all(total(p) + total(q[:1]) > 20 for p, q in zip(parts, parts[1:]))


def test_noise(spark):
    rows = spark.range(4000).select("id", F.lit("abcdef").alias("w"))
    got = rows.select(*(getattr(E, f"noise_{k}")(F.col("w"), F.col("id")).alias(k) for k in E.KINDS)).collect()
    assert {len(r["remove"]) for r in got} == {5} and {len(r.add) for r in got} == {7} and all(r.special[1:] == "abcdef" and ord(r.special[0]) in E.SPECIAL for r in got)
    assert all(sorted(r.swap) == list("abcdef") and sum(a != b for a, b in zip(r.swap, "abcdef")) == 2 for r in got)
    assert len({r.swap for r in got}) == 15
    assert one(spark, "a", lambda c: F.concat(E.noise_remove(c, F.lit(1)), E.noise_swap(c, F.lit(1)))) == "aa"
    changed = one(spark, " ".join(["word"] * 20_000), lambda c: E.noisy(c, F.lit(1))).replace("\n", "?").replace("\r", "?").split(" ")
    assert abs(sum(w != "word" for w in changed) / 20_000 - 0.1) < 0.02


def test_a_swap_takes_one_digest(spark):
    rows = spark.range(4).select("id", F.element_at(F.array(F.lit("ab"), F.lit("a"), F.lit(""), F.lit(None).cast("string")), (F.col("id") + 1).cast("int")).alias("w"))
    got = rows.select("id", E.noise_swap(F.col("w"), F.col("id")).alias("w"))
    assert [r.w for r in got.orderBy("id").collect()] == ["ba", "a", "", None]
    plan = got._jdf.queryExecution().executedPlan()
    assert getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package").codegenString(plan).count("md5Hex") == 1


def test_noise_names_its_draws_once(spark):
    from hashlib import md5

    text = " ".join(f"word{i}" for i in range(600))
    rows = spark.createDataFrame([(7, text), (None, text), (8, ""), (9, None)], "k int, t string")
    got = rows.select("k", E.noisy(F.col("t"), F.col("k")).alias("n"))
    assert got._jdf.queryExecution().optimizedPlan().toString().count("conv(") < 12
    found = {r.k: r.n for r in got.collect()}
    assert found[8] == "" and found[9] is None
    for k, start in ((7, "noise:7:"), (None, "noise:")):
        hit = {i for i in range(600) if int(md5(f"{start}{i}".encode()).hexdigest()[:8], 16) < 0.1 * 2**32}
        assert {i for i, (a, b) in enumerate(zip(found[k].split(" "), text.split(" "))) if a != b} == hit


def test_a_cosine_takes_each_vector_once(spark):
    rows = spark.createDataFrame([([1.0, 2.0], [2.0, 1.0]), ([0.0, 0.0], [1.0, 1.0]), (None, [1.0, 1.0]), ([1.0, 1.0], None)], "x array<double>, y array<double>")
    got = rows.select(G.cosine(F.reverse("x"), F.reverse("y")).alias("c"))
    assert [r.c if r.c is None else round(r.c, 9) for r in got.collect()] == [0.8, 0.0, None, None]
    assert got._jdf.queryExecution().optimizedPlan().toString().count("reverse(") == 2


def test_capitals_and_words_that_differ(spark):
    assert one(spark, "a.B.C..D. E.\u00c9.f .A", G.normalise) == "a. B. C.. D. E.\u00c9.f . A"
    rows = spark.createDataFrame([(1, "a B c d", "A b c x"), (2, "a", None), (3, "a b", "a b c"), (4, "a x b", "a y B")], "k int, a string, b string")
    got = {r.k: (r.match_count, r.matched_chars, r.last_match_ratio) for r in G.prefix_score(rows, ["k"], "a", "b", fuzzy=False).collect()}
    assert got == {1: (3, 3, 0), 2: (0, 0, 0), 3: (2, 2, 100), 4: (1, 1, 0)}


def test_markers_fragments_and_templates(spark):
    assert one(spark, "a_START_ARTICLE_b _NEWLINE__NEWLINE_ _lower_ __", E.remove_markers) == "a b _lower_ __"
    assert one(spark, "One. Two. Three", E.drop_fragment) == "One. Two." and one(spark, "None", E.drop_fragment) == "None" and one(spark, "End. ", E.drop_fragment) == "End."
    rows = spark.createDataFrame([("P", "a <|assistant|> b", None)], "Prompt string, Train string, Target string")
    text = R.training_rows(rows).first().text
    assert text == "<|system|>\nP<|endoftext|><|user|>\na <|assistant|> b<|endoftext|><|assistant|>\n"
    parsed = R.parse_template(spark.createDataFrame([(text,), ("none",)], "text string")).collect()
    assert len(parsed) == 1 and parsed[0].expected == "b<|endoftext|>" and parsed[0].prompt.endswith("a <|assistant|>\n")
    paths = spark.createDataFrame([("c/checkpoint-9",), ("c/checkpoint-10",), ("c/other",)], "path string")
    assert R.latest_checkpoint(paths).first().path == "c/checkpoint-10"


def test_normalise_and_prefix_scores(spark):
    a, b = "This is the original sentence with _START_SECTION_ marker.", "This is the original sentence with marker ."
    assert one(spark, a, G.normalise) == "This is the original sentence with marker."
    assert one(spark, "well- known…end.Next U.S.A _NEWLINE_", G.normalise) == "well-known...end. Next U. S. A"
    rows = [(0, "same words here", "same words here"), (1, "abcdefghij x", "abcdefghix x"), (2, "abcdefghijk x", "abcdefghijx x"), (3, "abcd", "abcde"), (4, "abcde", "abcdef"), (5, "", "x"), (6, None, "x"), (7, a, b)]
    frame = spark.createDataFrame(rows, "k long, a string, b string")
    got = {r.k: tuple(r)[1:] for r in G.prefix_score(frame, ["k"], "a", "b").collect()}
    for k, x, y in rows:
        count = chars = last = 0
        for p, q in zip((x or "").split(), (y or "").split()):
            last = int(round(100 * difflib.SequenceMatcher(None, p.lower(), q.lower()).ratio()))
            if last <= 90:
                break
            count, chars = count + 1, chars + len(p)
        assert got[k] == (count, chars, last), k
    assert got[1][0] == 0 and got[2][0] == 2 and got[3][0] == 0 and got[4][0] == 1


def test_comparison(spark):
    a, b = "This is the original sentence with _START_SECTION_ marker.", "This is the original sentence with marker ."
    rows = spark.createDataFrame([(0, b, a), (1, b, None), (2, "", "x")], "batch_index long, original_batch string, processed_result string")
    letters = lambda t: F.array(*((F.length(t) - F.length(F.replace(t, F.lit(c), F.lit("")))).cast("double") for c in "ist"))
    got = {r.batch_index: r for r in G.result_records(G.compare(rows, letters).withColumn("error", F.lit(None).cast("string"))).collect()}
    # The seventh words are "marker" and "marker.", of ratio 92.
    assert got[0].comparison.fuzzy_match_score.asDict() == {"match_count": 7, "matched_chars": 35, "last_match_ratio": 92} and got[0].comparison.cosine_similarity == pytest.approx(1)
    assert got[1].comparison is None and got[1].status == "processing_failed"
    assert tuple(got[2].comparison.fuzzy_match_score) == (0, 0, 0) and got[2].comparison.cosine_similarity == 0


def test_cosine_and_mean(spark):
    rows = spark.createDataFrame([(0, [1.0, 0.0], [0.0, 2.0]), (1, [1.0, 1.0], [2.0, 2.0]), (2, [1.0, 0.0], [-3.0, 0.0]), (3, [0.0, 0.0], [1.0, 1.0]), (4, None, [1.0, 1.0])], "k long, a array<double>, b array<double>")
    got = {r.k: r.c for r in rows.select("k", G.cosine(F.col("a"), F.col("b")).alias("c")).collect()}
    assert got[0] == 0 and got[1] == pytest.approx(1) and got[2] == -1 and got[3] == 0 and got[4] is None
    assert G.mean_pool(rows.where("k < 3").withColumn("g", F.lit(1)), "g", "b", order="k", most=2).first().b == pytest.approx([1.0, 2.0])
    assert G.mean_pool(rows.where("k < 3").withColumn("g", F.lit(1)), "g", "b").first().b == pytest.approx([-1 / 3, 4 / 3])


def test_correction_never_fails_the_job(spark):
    def make():
        def model(prompts):
            if any("boom" in p for p in prompts):
                raise ValueError("no")
            return [[{"generated_text": p[-40:]}] for p in prompts]
        return model

    rows = spark.createDataFrame([(0, "fine\n"), (1, "boom\n")], "batch_index long, original_batch string")
    got = {r.batch_index: r for r in G.result_records(G.correct(rows, make, instances=2)).collect()}
    assert got[0].status == "success" and got[1].status == "future_error" and got[1].processed_result is None
    assert [G.normal_output(x) for x in (None, "t", 5)] == [None, "t", "5"]


def test_filter_results(spark):
    rows = spark.createDataFrame([(0, "success"), (1, "success"), (2, "processing_failed"), (None, "success")], "batch_index long, status string")
    assert sorted(str(r.batch_index) for r in H.filter_results(rows, [0, 2, 3]).collect()) == ["1", "None"]
    assert sorted(str(r.batch_index) for r in H.filter_results(rows, [0, *range(2, 2000)]).collect()) == ["1", "None"]
    assert H.removed_count(rows, H.filter_results(rows, [0])).first().removed == 2


def test_pages(spark):
    known = B.build_dictionary(spark.createDataFrame([("Alpha beta a ab12 café",)], "text string"))
    assert sorted(r.word for r in known.collect()) == ["alpha", "beta"]
    pages = spark.createDataFrame([(1, "alpha Beta xx"), (2, "12 34"), (3, None), (4, "alpha beta alpha beta zz")], "p long, text string")
    got = {r.p: r for r in pages.join(B.valid_word_ratio(pages, known, ["p"]), "p").withColumn("route", B.route(F.col("text"), F.col("ratio"))).collect()}
    assert [got[p].route for p in (1, 2, 3, 4)] == ["garbled", "short", "short", "ok"] and got[2].ratio == 0.0 and got[4].ratio == 0.8
    routed = pages.withColumn("route", F.when(F.col("p") == 3, "short").otherwise("ok")).withColumnsRenamed({"p": "page_no"}).withColumn("book_id", F.lit("b"))
    done = {r.page_no: r.text for r in B.recognise(routed, "route", io.recogniser(lambda book, page: f"{book}{page}")).collect()}
    assert done[3] == "b3" and done[1] == "alpha Beta xx"


def test_page_numbers_and_paragraphs(spark):
    assert one(spark, "123\n  45 \nTitle 67\n89 Chapter\nplain\nin 3 words\nabove\n7\nend", I.remove_page_numbers) == "plain\nin 3 words\nend"
    rows = spark.createDataFrame([(1, "low\n\nlow again\n\nUpper. \nNext\nline."), (2, "")], "k long, text string")
    assert [r.paragraph for r in I.paragraphs(rows, ["k"]).orderBy("para_no").collect()] == ["low low again", "Upper. \nNext line."]
    paras = spark.createDataFrame([(1, i, "p") for i in range(23)] + [(2, 0, "p")], "k long, para_no long, paragraph string")
    got = I.schedule(paras, ["k"], 2).orderBy("k", "para_no").collect()
    assert [(r.proc, r.gpu, r.part) for r in got[:13]][-2:] == [(0, 0, 11), (1, 1, 0)] and got[-1].path == "data/output_part_proc0_part_0_0.wav"
    assert {r.gpu for r in I.schedule(paras, ["k"], 0).collect()} == {-1}
    by_number = [r.para_no for r in I.schedule(paras, ["k"], 2).where("k = 1").orderBy(*I.part_order()).collect()]
    by_name = [r.para_no for r in I.schedule(paras, ["k"], 2).where("k = 1").orderBy(*I.part_order(by_name=True)).collect()]
    assert by_number == list(range(23)) and by_name != by_number


def test_sources_and_sinks(spark, tmp_path):
    for name, body in (("one.pdf", "a|b"), ("bad.pdf", "!"), ("note.txt", "x")):
        (tmp_path / name).write_text(body)

    def extract(path, content):
        if content == b"!":
            raise ValueError
        return content.decode().split("|")

    assert [(r.page_no, r.text) for r in io.read_pages(spark, str(tmp_path), extract).orderBy("page_no").collect()] == [(0, "a"), (1, "b")]
    rows = spark.createDataFrame([("train", 1), ("dev", 2)], "split string, x long")
    io.write_splits(rows, str(tmp_path / "s"))
    assert [r.x for r in io.read_splits(spark, str(tmp_path / "s")).collect()] == [1]
    parts = spark.createDataFrame([(1, 0, 10, [5.0]), (1, 0, 2, [1.0, 2.0, 3.0]), (1, 0, 3, [])], "k long, proc long, part long, samples array<double>")
    assert io.concat_samples(parts, ["k"]).first().samples == [1.0, 2.0, 3.0, 5.0]
    assert io.concat_samples(parts, ["k"], fade=1).first().samples == [0.5, 2.0, 1.5, 2.5]
    models = io.ModelProvider(lambda n: n.upper() if n != "bad" else 1 / 0)
    assert models.several(["a", "bad"]) == ["A"] and models.get("bad") is None
    with pytest.warns(UserWarning, match="validation"):
        io.read_splits(spark, str(tmp_path / "s"))
    (tmp_path / "w").write_text("dog.n.01\nice_cream x-ray\n")
    found = lambda f: sorted(r.text for r in f(spark, str(tmp_path / "w")).collect())
    assert found(io.read_lemmas) == ["dog", "icecream x-ray"] and found(io.read_words) == ["dog.n.01", "ice_cream x-ray"] and found(io.read_system_words) == ["dog", "x-ray"]


def test_saved_tables_parts_and_speech(spark, tmp_path):
    io.save(spark.range(3), str(tmp_path / "t"))
    assert sorted(r.id for r in io.load(spark, str(tmp_path / "t"), "id long").collect()) == [0, 1, 2]
    paras = spark.createDataFrame([(0, 0, k, f"{tmp_path}/x_proc0_part_0_{k}.wav", t) for k, t in enumerate(["a", "!", "c"])], "proc long, gpu long, part long, path string, paragraph string")

    def make():
        def speak(text, path):
            if text == "!":
                raise ValueError
            with wave.open(path, "wb") as f:
                f.setnchannels(1)
                f.setsampwidth(2)
                f.setframerate(1000)
                f.writeframes(bytes([ord(text), 0]) * 100)
        return speak

    assert {r.part: r.ok for r in io.synthesise(paras, make).collect()} == {0: True, 1: False, 2: True}
    assert [(r.proc, r.part) for r in io.read_parts(spark, str(tmp_path)).orderBy("part").collect()] == [(0, 0), (0, 2)]
    paths, out = [f"{tmp_path}/x_proc0_part_0_{k}.wav" for k in range(3)], f"{tmp_path}/all.wav"
    assert io.concat_waves(paths, out)
    with wave.open(out, "rb") as f:
        assert f.readframes(1000) == b"a\0" * 100 + b"c\0" * 100
    assert io.concat_and_clean([f"{tmp_path}/none.wav"], f"{tmp_path}/no.wav") == (False, 0, 0)
    assert io.concat_and_clean(paths, out, fade_ms=10) == (True, 2, 1)
    with wave.open(out, "rb") as f:
        raw = f.readframes(1000)
    assert len(raw) == 400 and raw[0] < raw[20] == ord("a") and raw[198] < ord("a") and raw[200] < ord("c")


def test_model_and_metrics_boundaries(spark, tmp_path):
    for word in ("one", "two"):
        io.save_model(lambda folder: open(f"{folder}/weights", "w").write(word), str(tmp_path / "m"))  # noqa: B023
    assert (tmp_path / "m" / "weights").read_text() == "two"
    got = io.train(spark.range(5), lambda: lambda rows, checkpoint: {"n": sum(1 for _ in rows), "from": float(checkpoint is not None)}, str(tmp_path / "run"), "c")
    assert got == {"n": 5, "from": 1.0} and (tmp_path / "run" / "metrics.jsonl").read_text() == '{"from": 1.0, "n": 5, "step": 0}\n'
    with pytest.raises(ValueError):
        R.required(spark.range(0))
    assert R.required(spark.range(1)).count() == 1


def test_streamed_results_come_once(spark, tmp_path):
    src, out, mark = (str(tmp_path / x) for x in ("in", "out", "mark"))
    schema = "batch_index long, status string"
    for part in ([(0, "success")], [(1, "success"), (2, "processing_failed")]):
        spark.createDataFrame(part, schema).write.mode("append").parquet(src)
        S.append_results(S.read_results(spark, src, schema), out, mark).awaitTermination()
    S.append_results(S.read_results(spark, src, schema), out, mark).awaitTermination()
    assert sorted(r.batch_index for r in spark.read.parquet(out).collect()) == [0, 1, 2]


def test_words_of_large_inputs_are_counted_in_small_pieces(spark, tmp_path, monkeypatch):
    from foliospark.functions import sizes

    rows = [(k % 40 if k % 5 else None, f"w{chr(97 + k % 7)} Some words {'x' * (k % 4)} w{chr(97 + k % 3)}") for k in range(400)]
    spark.createDataFrame(rows, "doc_id int, text string").coalesce(1).write.parquet(str(tmp_path / "d"))
    pages = spark.read.parquet(str(tmp_path / "d"))
    count = lambda: B.word_counts(pages, ["doc_id"])
    whole = count()
    assert "Repartition" not in whole._jdf.queryExecution().optimizedPlan().toString()
    monkeypatch.setattr(sizes, "PIECE_BYTES", -(-sizes.input_bytes(pages) // 9), raising=False)
    parts = count()
    assert "Repartition 9" in parts._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(repr, parts.collect())) == sorted(map(repr, whole.collect())) and sum(r.n for r in parts.collect()) == sum(len([w for w in t.split() if len(w) > 1]) for _, t in rows)


def test_partitions_do_not_matter(spark):
    rows = spark.range(300).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.lit("some words"), "id").alias("t"))
    found = [sorted(map(tuple, E.noise_pairs(rows.repartition(n), "doc_id", "t").collect())) for n in (1, 7)]
    assert found[0] == found[1]
    heads = [[r.doc_id for r in R.shuffle_head(rows.repartition(n), "doc_id", 20).collect()] for n in (1, 7)]
    assert heads[0] == heads[1] and len(heads[0]) == 20 and R.shuffle_head(rows, "doc_id", None).count() == 300
