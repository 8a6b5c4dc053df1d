"""Sequence packing by cutting-stock column generation.

A document of n ids gives n // SIZE full pieces, each a sequence of its own, a half piece if SIZE / 2
ids or more are left, and a remainder shorter than that. (Uncut remainders between half a sequence and
a whole one can't share a sequence; cutting them at the half brings padding from an eighth to under a
hundredth.) Two half pieces make a sequence. Remainders are known by length alone: a linear program over patterns (multisets of lengths
that fit a sequence) is solved on the driver over the histogram of at most SIZE / 2 - 1 lengths; a knapsack
dynamic program prices new patterns. Pattern counts are rounded down and dealt to documents by their
rank within a length; what rounding leaves over (fewer than one sequence for each basic pattern) is
laid end to end and cut every SIZE ids, so one sequence of all may be padded.

Ranks come from sums over (length, chunk of doc_ids), so no length's documents meet in one task.
Ids never leave the task that makes them: pieces carry a checksum. Only the documents that are cut
outside their full pieces (fewer than SIZE / 2 of them) are encoded twice.

Defined results: a null text is an empty one and gives the single end id; rows that repeat a doc_id are
packed each on its own; other columns are ignored; an empty table gives no pieces.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import compact, materialise, shuffle_width, small_table
from .reshard import running

SIZE, END_ID = 1024, 0
_LOADED: dict = {}
#: Where both encoders of the vocabulary split alike beyond doubt; other texts go to the slower one.
_PLAIN = re.compile(r"[^\x00-\x1b\x20-\x7e¡-¬®-ȳ‐-‧€]|<\|endoftext\|>")


def encoder(vocabulary: str, ranks: str | None = None):
    """text -> ids as uint32. `vocabulary` is a tokenizers file; `ranks`, if given, the same vocabulary for the faster library."""
    if (vocabulary, ranks) not in _LOADED:
        from tokenizers import Tokenizer

        slow = Tokenizer.from_file(vocabulary)
        fast = None
        if ranks:
            import tiktoken

            with open(ranks, "rb") as f:
                table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
            fast = tiktoken.Encoding("pack", pat_str=r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+", mergeable_ranks=table, special_tokens={})

        def encode(text: str) -> np.ndarray:
            if fast is None or _PLAIN.search(text):
                return np.array(slow.encode(text, add_special_tokens=False).ids, dtype="<u4")
            return np.array(fast.encode_ordinary(text), dtype="<u4")

        _LOADED[vocabulary, ranks] = encode
    return _LOADED[vocabulary, ranks]


def document_ids(text: str | None, encode) -> np.ndarray:
    return np.append(encode(text or ""), np.array([END_ID], dtype="<u4"))


def starts(n: int, size: int) -> list[int]:
    """Where the full pieces, the half piece and the remainder of n ids begin."""
    full, rest = divmod(n, size)
    return [*range(0, n - rest, size), *([n - rest] if rest else []), *([n - rest + size // 2] if rest > size // 2 else [])]


def solve(lengths: list[int], demand: list[int], size: int = SIZE, rounds: int = 500, slack: float = 1e-4) -> list[tuple[dict[int, int], float]]:
    """The linear program's patterns and how often each is used: Gilmore and Gomory's column generation
    with the revised simplex method. Stops when no pattern improves the bound by more than `slack`."""
    m = len(lengths)
    if not m:
        return []
    length, d = np.array(lengths), np.array(demand, dtype=float)
    columns, order = first_patterns(length, d, size)
    inverse = inverse_of(columns, order)
    x = (inverse * d).sum(axis=1)
    for _ in range(rounds):
        value, pattern = best_pattern(length, inverse.sum(axis=0), size)
        if value <= 1 + slack:
            break
        used = np.flatnonzero(pattern)
        u = (inverse[:, used] * pattern[used]).sum(axis=1)
        ratios = np.where(u > 1e-9, x / np.where(u > 1e-9, u, 1), np.inf)
        out = int(np.argmin(ratios))
        if not np.isfinite(ratios[out]):
            break
        x -= u * ratios[out]
        x[out] = ratios[out]
        row = inverse[out] / u[out]
        inverse -= np.outer(u, row)
        inverse[out] = row
        columns[:, out] = pattern
    return [({int(length[i]): int(columns[i, j]) for i in np.flatnonzero(columns[:, j] > 0.5)}, float(x[j])) for j in range(m) if x[j] > 1e-9]


def first_patterns(length: np.ndarray, demand: np.ndarray, size: int) -> tuple[np.ndarray, list[int]]:
    """A basis to start from: full patterns of the lengths that are left, long and frequent ones first, each
    used until one of its lengths runs out. Taken in that order (returned too) the columns form a triangle."""
    left, columns, order = demand.copy(), np.zeros((len(length), len(length))), []
    active = np.arange(len(length))
    while len(active):
        much = left[active] / max(left[active].max(), 1e-9)
        part = best_pattern(length[active], length[active] * (1 + 0.01 * length[active] / size + 0.01 * much), size)[1]
        pattern = np.zeros(len(length))
        pattern[active] = part
        used = active[part > 0]
        out = used[np.argmin(left[used] / pattern[used])]
        left = np.maximum(left - pattern * (left[out] / pattern[out]), 0)
        columns[:, out] = pattern
        order.append(int(out))
        active = active[active != out]
    return columns, order


def inverse_of(columns: np.ndarray, order: list[int]) -> np.ndarray:
    """The inverse of first_patterns' basis, by forward elimination: in `order` it is a lower triangle."""
    at = np.ix_(order, order)
    a, inverse = columns[at], np.eye(len(order))
    for k in range(len(order)):
        inverse[k] /= a[k, k]
        below = k + 1 + np.flatnonzero(a[k + 1 :, k])
        inverse[below] -= a[below, k][:, None] * inverse[k]
    out = np.empty_like(inverse)
    out[at] = inverse
    return out


def best_pattern(length: np.ndarray, price: np.ndarray, size: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the pattern of at most `size` of the greatest price."""
    best, took = np.zeros(size + 1), np.full(size + 1, -1)
    at = np.searchsorted(length, np.arange(size + 1), side="right")  # lengths ascend
    for w in range(1, size + 1):
        best[w] = best[w - 1]
        if at[w]:
            got = best[w - length[: at[w]]] + price[: at[w]]
            k = int(got.argmax())
            if got[k] > best[w] + 1e-12:
                best[w], took[w] = got[k], k
    pattern, w = np.zeros(len(length)), size
    while w > 0:
        if took[w] < 0:
            w -= 1
        else:
            pattern[took[w]] += 1
            w -= length[took[w]]
    return float(best[size]), pattern


def plan(histogram: dict[int, int], size: int = SIZE) -> tuple[list[tuple], dict[int, tuple[int, int]], int, int]:
    """Deals for ranks of each length: (length, from rank, to rank, a, first sequence, offset), the rest's
    {length: (from rank, from place)}, the sequences dealt out and the ids in the rest."""
    left = dict(histogram)
    used = dict.fromkeys(histogram, 0)
    deals, sequences = [], 0
    lengths = sorted(histogram)
    for pattern, x in sorted(solve(lengths, [histogram[n] for n in lengths], size), key=lambda p: sorted(p[0].items())):
        times = min([int(x + 1e-7), *(left[n] // a for n, a in pattern.items())])
        if times:
            at = 0
            for n, a in sorted(pattern.items(), reverse=True):
                deals.append((n, used[n], used[n] + a * times, a, sequences, at))
                used[n] += a * times
                left[n] -= a * times
                at += a * n
            sequences += times
    rest, place = {}, 0
    for n in sorted(lengths, reverse=True):
        if left[n]:
            rest[n] = (used[n], place)
            place += n * left[n]
    return deals, rest, sequences, place


def pack(docs: DataFrame, vocabulary: str, ranks: str | None = None, text: str = "text", size: int = SIZE) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    spark = docs.sparkSession
    source = docs.select("doc_id", F.col(text).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary, ranks)
        for batch in batches:
            tokens, crcs = [], []
            for t in batch.column("text"):
                ids = document_ids(t.as_py(), encode)
                tokens.append(len(ids))
                crcs.append([zlib.crc32(x.tobytes()) for x in np.split(ids, starts(len(ids), size)[1:]) if len(x)])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(tokens, pa.int64()), pa.array(crcs, pa.list_(pa.int64()))], ["doc_id", "doc_tokens", "crcs"])

    at = source.mapInArrow(count, "doc_id long, doc_tokens long, crcs array<bigint>")
    at = at.withColumn("_chunk", F.pmod(F.xxhash64("doc_id"), F.lit(max(16, shuffle_width(spark)))).cast("int"))
    at = materialise(compact(at.withColumn("r", F.pmod("doc_tokens", F.lit(size // 2)).cast("int"))), "pack-counts")
    deals, rest, sequences, over = plan({r["r"]: r["n"] for r in at.where("r > 0").groupBy("r").agg(F.count("*").alias("n")).collect()}, size)
    full_from = sequences + -(-over // size)

    order = ["doc_id", "doc_tokens", "crcs"]
    full = running(at.where(F.col("doc_tokens") >= size).withColumn("_all", F.lit(0)), ["_all"], F.floor(F.col("doc_tokens") / size), "before", order)
    full = full.select("doc_id", "doc_tokens", "before", F.posexplode(F.slice("crcs", F.lit(1), F.floor(F.col("doc_tokens") / size).cast("int"))).alias("k", "ids_crc32"))
    full = full.select("doc_id", (F.col("k").cast("long") * size).alias("start"), F.lit(size).cast("long").alias("length"), "ids_crc32", "doc_tokens", (F.lit(full_from) + F.col("before") + F.col("k")).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))

    halves = running(at.where(F.pmod("doc_tokens", F.lit(size)) >= size // 2).withColumn("_all", F.lit(0)), ["_all"], F.lit(1).cast("long"), "before", order)
    half_from = full_from + at.agg(F.sum(F.floor(F.col("doc_tokens") / size))).first()[0] if at.head(1) else full_from
    halves = halves.select("doc_id", (F.col("doc_tokens") - F.pmod("doc_tokens", F.lit(size))).alias("start"), F.lit(size // 2).cast("long").alias("length"), F.get("crcs", F.floor(F.col("doc_tokens") / size).cast("int")).alias("ids_crc32"), "doc_tokens", (F.lit(half_from) + F.floor(F.col("before") / 2)).cast("long").alias("sequence_id"), (F.pmod("before", F.lit(2)) * (size // 2)).cast("long").alias("offset"))

    ranked = running(at.where("r > 0"), ["r"], F.lit(1).cast("long"), "rank", order)
    ranked = ranked.select("doc_id", "doc_tokens", "r", "rank", F.element_at("crcs", -1).alias("crc"), (F.col("doc_tokens") - F.col("r")).alias("start"))
    # At most size / 2 - 1 lengths times the patterns that hold one: bounded, whatever the corpus.
    dealt = small_table(spark, deals, n=pa.int32(), low=pa.int64(), high=pa.int64(), a=pa.int64(), first=pa.int64(), at=pa.int64())
    left = small_table(spark, [(n, low, place) for n, (low, place) in rest.items()], n=pa.int32(), low=pa.int64(), place=pa.int64())
    in_patterns = ranked.join(F.broadcast(dealt), (F.col("r") == F.col("n")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")))
    k = F.col("rank") - F.col("low")
    in_patterns = in_patterns.select("doc_id", "start", F.col("r").cast("long").alias("length"), F.col("crc").alias("ids_crc32"), "doc_tokens", (F.col("first") + F.floor(k / F.col("a"))).cast("long").alias("sequence_id"), (F.col("at") + F.pmod(k, F.col("a")) * F.col("r")).cast("long").alias("offset"))
    loose = ranked.join(F.broadcast(left), (F.col("r") == F.col("n")) & (F.col("rank") >= F.col("low")))
    loose = loose.withColumn("p", F.col("place") + (F.col("rank") - F.col("low")) * F.col("r")).withColumn("first", F.least(F.col("r").cast("long"), size - F.pmod("p", F.lit(size))))
    spot = ((F.lit(sequences) + F.floor(F.col("p") / size)).cast("long").alias("sequence_id"), F.pmod("p", F.lit(size)).cast("long").alias("offset"))
    whole = loose.where(F.col("first") == F.col("r")).select("doc_id", "start", F.col("r").cast("long").alias("length"), F.col("crc").alias("ids_crc32"), "doc_tokens", *spot)
    out = full.unionByName(halves).unionByName(in_patterns).unionByName(whole)
    cut = [tuple(r) for r in loose.where(F.col("first") < F.col("r")).select("doc_id", "doc_tokens", "crc", "start", "first", *spot).collect()]  # fewer than the rest's sequences
    return out.unionByName(_cut_pieces(source, cut, vocabulary, ranks, size)) if cut else out


def _cut_pieces(source: DataFrame, cut: list[tuple], vocabulary: str, ranks: str | None, size: int) -> DataFrame:
    """Encode the documents that are cut once more, for the checksums of both parts."""
    wanted = small_table(source.sparkSession, [(c[0], list(c[1:])) for c in cut], id=pa.int64(), how=pa.list_(pa.int64())).groupBy("id").agg(F.collect_list("how").alias("how"))
    texts = source.join(F.broadcast(wanted), F.col("doc_id").eqNullSafe(F.col("id"))).select("doc_id", "text", "how")
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary, ranks)
        for batch in batches:
            rows = []
            for doc, text, how in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "how"))):
                ids = document_ids(text, encode)
                for n, crc, start, first, sequence, offset in how:
                    if n == len(ids) and zlib.crc32(ids[start:].tobytes()) == crc:
                        rows.append((doc, start, first, zlib.crc32(ids[start : start + first].tobytes()), n, sequence, offset, crc))
                        rows.append((doc, start + first, n - start - first, zlib.crc32(ids[start + first :].tobytes()), n, sequence + 1, 0, crc))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(len(names))], names)

    # Equal rows of one doc_id share their list of cuts: each piece comes once.
    return texts.mapInArrow(cut_up, ", ".join(f"`{n}` long" for n in names)).dropDuplicates()
