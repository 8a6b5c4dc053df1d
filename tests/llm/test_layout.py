import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from foliospark.llm import packing, reshard

VOCABULARY, RANKS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def texts():
    draw = random.Random(6)
    rows = [None, "", " ", "a", "<|endoftext|> inside", "naïve café 123\n\n  x", "日本語 テキスト", "🙂" * 30, "same words here " * 40, "same words here " * 40, "long " * 6000]
    return rows + [" ".join(draw.choice(["alpha", "beta", "Gamma,", "7", "delta.\n"]) for _ in range(draw.randrange(900))) for _ in range(80)]


@pytest.mark.parametrize("size", [1024, 64])
def test_packing_is_an_exact_round_trip(spark, size):
    rows = [(i, t, 1, "x") for i, t in enumerate(texts())]
    got = packing.pack(spark.createDataFrame(rows, "doc_id long, text string, rank int, start string"), VOCABULARY, RANKS, size=size).toPandas()
    slow = Tokenizer.from_file(VOCABULARY)
    ids = {i: np.array(slow.encode(t or "", add_special_tokens=False).ids + [0], dtype="<u4") for i, t, *_ in rows}
    assert set(got.doc_id) == set(ids)
    for doc, part in got.sort_values("start").groupby("doc_id"):
        at = 0
        for r in part.itertuples():
            assert r.start == at and r.length > 0 and r.doc_tokens == len(ids[doc]) and r.ids_crc32 == zlib.crc32(ids[doc][at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids[doc])
    for _, part in got.sort_values("offset").groupby("sequence_id"):
        assert part.offset.tolist() == np.concatenate([[0], part.length.cumsum().to_numpy()[:-1]]).tolist() and part.length.sum() <= size
    sequences = got.sequence_id.nunique()
    assert sorted(got.sequence_id.unique()) == list(range(sequences))
    assert sequences * size - got.length.sum() < max(2 * size, 0.02 * got.length.sum())


def test_packing_repeated_rows_and_empty_table(spark):
    frame = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (2, None)], "doc_id long, text string")
    got = packing.pack(frame, VOCABULARY).collect()
    assert sorted((r.doc_id, r.length) for r in got) == [(1, 4), (1, 4), (2, 1)] and sorted(r.offset for r in got)[0] == 0
    assert packing.pack(frame.limit(0), VOCABULARY).collect() == []


def test_both_encoders_agree():
    fast, slow = packing.encoder(VOCABULARY, RANKS), packing.encoder(VOCABULARY)
    draw = random.Random(1)
    pool = list("abc XYZ'sll 12.,!?\n\t\r\x0b\x1c\x85\xa0éßñÀ\u2028\u3000\u200b日🙂—’\u0301٣Ⅷ")
    for _ in range(3000):
        t = "".join(draw.choice(pool) for _ in range(draw.randrange(40)))
        assert (fast(t) == slow(t)).all(), repr(t)


def test_the_faster_encoder_is_proven_on_every_character_it_gets():
    """Each code point that may reach it, between letters, digits, marks and blanks."""
    fast, slow = packing.encoder(VOCABULARY, RANKS), packing.encoder(VOCABULARY)
    let = [chr(k) for k in range(0x110000) if not 0xD800 <= k < 0xE000 and not packing._PLAIN.search(chr(k))]
    assert 300 < len(let) < 1000
    draw = random.Random(7)
    for c in let:
        for t in (c, c * 3, f"a{c}b", f"1{c}2", f" {c}", f"{c} ", f"x {c}{c} y", f".{c},", f"'{c}", f"\n{c}\t"):
            assert fast(t).tolist() == slow(t).tolist(), repr(t)
    for _ in range(3000):
        t = "".join(draw.choice(let) for _ in range(draw.randrange(60)))
        assert fast(t).tolist() == slow(t).tolist(), repr(t)


def test_column_generation_reaches_the_bound():
    draw = np.random.default_rng(5)
    lengths, demand = list(range(1, 120)), draw.integers(1, 400, 119).tolist()
    found = packing.solve(lengths, demand, 256)
    made = {n: 0.0 for n in lengths}
    for pattern, x in found:
        assert sum(n * a for n, a in pattern.items()) <= 256
        for n, a in pattern.items():
            made[n] += a * x
    assert all(abs(made[n] - d) < 1e-6 * d + 1e-6 for n, d in zip(lengths, demand))
    assert sum(x for _, x in found) * 256 < 1.002 * sum(n * d for n, d in zip(lengths, demand))


def test_min_cost_flow_moves_the_fewest():
    for seed in range(20):
        draw = random.Random(seed)
        supply = [draw.randrange(60) for _ in range(4)]
        capacity = reshard.even_capacities(sum(supply), 5)
        flow = reshard.min_cost_flow(supply, capacity, [[int(i != j) for j in range(5)] for i in range(4)])
        assert [sum(r) for r in flow] == supply and [sum(r[j] for r in flow) for j in range(5)] == capacity
        assert sum(flow[i][i] for i in range(4)) == sum(min(supply[i], capacity[i]) for i in range(4))


def test_reshard(spark):
    draw = random.Random(2)
    rows = [(i, None if i % 50 == 0 else "é" * draw.choice([1, 5, 60, 300, 900]), 0, 1) for i in range(1500)] + [(7, "dup", 0, 0), (7, "dup", 0, 0), (2000, "x" * 9000, 0, 0)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, shard int, size int")
    got = reshard.reshard(frame, F.when(F.col("doc_id") % 3 == 0, F.lit(0)).when(F.col("doc_id") % 3 == 1, F.pmod("doc_id", F.lit(6))), shards=6).toPandas()
    want = sorted((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    assert sorted(zip(got.doc_id, got["size"], got.text_crc32)) == want
    total = got.groupby("shard")["size"].sum()
    assert total.max() - total.min() < 400
    for _, part in got.groupby("shard"):
        assert sorted(part.slot) == list(range(len(part)))
    # A half of all bytes sits in old shard 0, which keeps all that it has room for.
    stay = got[(got.old_shard == 0) & (got.shard == 0)]["size"].sum()
    assert stay > 0.9 * total[0]
    # What moves is little more than the flow's optimum: each flow ends within about one small document.
    supply = got.groupby("old_shard")["size"].sum().to_dict()
    capacity = reshard.even_capacities(int(got["size"].sum()), 6)
    least = got["size"].sum() - sum(min(supply.get(j, 0), capacity[j]) for j in range(6))
    assert least <= got[got.old_shard != got.shard]["size"].sum() + 6 * 700 and got[got.old_shard != got.shard]["size"].sum() <= least + 12 * 700
    assert reshard.reshard(frame.limit(0), F.lit(0)).collect() == []


def test_rewrite_leaves_untouched_shards(spark, tmp_path):
    frame = spark.createDataFrame([(i, "t" * 10) for i in range(120)], "doc_id long, text string")
    placed = reshard.reshard(frame, F.pmod("doc_id", F.lit(2)).cast("int"), capacities=[2, 1, 1], shards=3)
    reshard.rewrite(frame, placed, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    want = {(r.doc_id, r.shard) for r in placed.collect()}
    assert {(r.doc_id, r.shard) for r in back.collect()} <= want


@pytest.mark.parametrize("keyed", [True, False])
def test_rewrite_keeps_each_row_once(spark, tmp_path, keyed):
    rows = [(i, "t" * (i % 9), i, 7) for i in range(60)] + [(None, "n", 1, 7), (None, None, 2, 7), (None, "n", 3, 7), (5, "a", 4, 7), (5, "b", 5, 7), (5, "b", 6, 7)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, shard int, Slot int")
    frame = reshard.numbered(frame) if keyed else frame
    placed = reshard.reshard(frame, F.coalesce(F.pmod("doc_id", F.lit(3)).cast("int"), F.lit(0)), shards=5)
    still = {r.shard for r in reshard.rewrite(frame, placed, str(tmp_path / "out")).collect()}
    back = spark.read.parquet(str(tmp_path / "out"))
    key = lambda r: tuple(map(str, r))
    assert not still and set(back.columns) == {"doc_id", "text", "doc_shard", "doc_Slot", "shard", "slot"}
    assert sorted(((r.doc_id, r.text, r.doc_shard, r.doc_Slot) for r in back.collect()), key=key) == sorted(rows, key=key)
    want = sorted(((r.doc_id, r.size, r.text_crc32, r.shard, r.slot) for r in placed.collect()), key=key)
    assert sorted(((r.doc_id, len(r.text or "") + 1, zlib.crc32((r.text or "").encode()), r.shard, r.slot) for r in back.collect()), key=key) == want


def test_query_rewrites_files_and_keeps_untouched_shards(spark):
    rows = [(i, "t" * 9, 1) for i in range(120)] + [(None, "n" * 9, 1), (None, "n" * 9, 1)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, slot int")
    # Shards 0 and 1 share what both hold; shard 2 has what it shall have.
    old = F.when(F.col("doc_id") < 60, F.lit(0)).when(F.col("doc_id") < 80, F.lit(1)).otherwise(F.lit(2))
    got = reshard.moved(frame, old, capacities=[40, 40, 42], shards=3).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in rows) and {r.size for r in got} == {10}
    for k, n in enumerate((40, 40, 42)):
        part = [r for r in got if r.shard == k]
        assert sorted(r.slot for r in part) == list(range(len(part))) and abs(len(part) - n) <= 1
    assert reshard.moved(frame.limit(0), F.lit(0)).collect() == []
