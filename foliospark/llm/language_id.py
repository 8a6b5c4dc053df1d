"""Language identification: averaged hashed subword embeddings and a linear softmax, trained in numpy.

A text's vector is the mean of the embeddings of its byte n-grams, hashed into BUCKETS rows; since the
softmax is linear, scoring folds both matrices into one table of BUCKETS x languages and averages that.
Every n-gram of the whole text counts. Training is stochastic gradient descent over the bucket counts
of at most MAX_FIT different labelled texts (one of each language at least: those of the smallest hashes within it), counted on the executors.

A temperature is fitted on a tenth of the sample that training does not see, and on the same tenth the score from which on
PRECISION of the predictions are right; below it, predictions are marked as rejected.

Defined results: null or empty texts, and texts without a letter, get `und` and score 0 and count as rejected; rows with a
null lang are never learned from; repeated rows give repeated results, and are learned from once; other columns are ignored; if
nothing can be learned from, every text gets `und`. More than MAX_LANGS languages are refused with an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from . import blas  # noqa: F401

GRAMS, BUCKETS, DIM = (2, 3, 4), 1 << 13, 16
MAX_FIT, MAX_LANGS, PRECISION = 3_000, 1_000, 0.99


def bucket_stream(buffer: np.ndarray, ends: np.ndarray, sizes: tuple[int, ...] = GRAMS, bits: int = 13) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n-gram size: the buckets of the grams that stay inside a text, and each text's number of them.

    buffer: the texts' bytes one after another; ends: where each text ends.
    """
    low = buffer.astype(np.uint32)
    low |= ((low >= 65) & (low <= 90)).astype(np.uint32) << 5  # A-Z as a-z
    low[low <= 32] = 32
    begins = np.concatenate([[0], ends[:-1]])
    gram, shift = low.copy(), 1
    for n in range(2, max(sizes) + 1):
        while shift < n:
            gram = gram[:-1] * np.uint32(257) + low[shift:]
            shift += 1
        if n in sizes:
            count = np.maximum(ends - begins - n + 1, 0)
            inside = np.ones(len(gram), dtype=bool)
            for k in range(1, n):  # grams that reach over an end
                over = ends - k
                inside[over[(over >= 0) & (over < len(gram))]] = False
            mixed = gram * np.uint32(2654435761 + 2 * n & 0xFFFFFFFF)
            yield (mixed >> np.uint32(32 - bits))[inside], count


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column one after another, and where each ends; nulls are empty."""
    column = column.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]] if column.buffers()[2] else np.zeros(0, np.uint8)
    return data, offsets[1:] - offsets[0]


def blocks(batch: pa.RecordBatch, most: int = 1_000_000) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with about `most` bytes of text: work memory follows that, or the longest text."""
    _, ends = text_buffer(batch.column("text"))
    at = 0
    while at < batch.num_rows:
        begin = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, begin + most, side="right")))
        yield batch.slice(at, to - at)
        at = to


def counts_of(text: str) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    found = np.concatenate([b for b, _ in bucket_stream(data, np.array([len(data)]))]) if len(data) else np.zeros(0, np.uint32)
    return np.unique(found, return_counts=True)


def has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


def train(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, classes: int, rounds: int = 12, rate: float = 2.0, seed: int = 3) -> tuple[np.ndarray, float]:
    """The folded table (embedding @ softmax weights, times the temperature's factor) and the score below which predictions are rejected."""
    draw = np.random.default_rng(seed)
    emb = draw.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
    out = draw.normal(0, 0.1, (DIM, classes)).astype(np.float32)
    order = draw.permutation(len(rows))
    held, used = order[: len(rows) // 10], order[len(rows) // 10 :]
    for k in range(rounds):
        step = rate * (1 - k / rounds)
        for i in draw.permutation(used):
            ids, n = rows[i]
            if not len(ids):
                continue
            share = (n / n.sum()).astype(np.float32)
            hidden = share @ emb[ids]
            z = hidden @ out
            p = np.exp(z - z.max())
            p /= p.sum()
            p[labels[i]] -= 1
            back = out @ p
            out -= step * 0.1 * np.outer(hidden, p)
            emb[ids] -= step * share[:, None] * back * 10
    table = emb @ out
    scores = np.array([(rows[i][1] / max(1, rows[i][1].sum())) @ table[rows[i][0]] for i in held]).reshape(-1, classes)
    heat = temperature(scores, labels[held])
    p = softmax(scores * heat)
    return (table * heat).astype(np.float32), rejection(p.max(axis=1), p.argmax(axis=1) == labels[held]) if len(held) else 0.0


def softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def rejection(top: np.ndarray, right: np.ndarray, precision: float = PRECISION) -> float:
    """The least score from which on `precision` of the predictions are right; 0 if all together are, above 1 if none are."""
    order = np.argsort(-top, kind="stable")
    good = np.flatnonzero(np.cumsum(right[order]) >= precision * np.arange(1, len(top) + 1))
    return 0.0 if len(good) and good[-1] == len(top) - 1 else float(top[order[good[-1]]]) if len(good) else 1.1


def temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """Of a grid, the factor on the scores with the least log loss on held-out texts."""
    best = (np.inf, 1.0)
    for t in np.geomspace(0.1, 10, 25):
        p = softmax(scores * t) if len(scores) else scores
        loss = float(-np.log(np.maximum(p[np.arange(len(p)), labels], 1e-300)).mean()) if len(p) else 0.0
        best = min(best, (loss, float(t)))
    return best[1]


def fit_sample(docs: DataFrame, most: int = MAX_FIT) -> DataFrame:
    """At most `most` different texts in all, as many of each lang as there are (one at least), by the smallest hash: text, lang."""
    at = docs.where("lang is not null and text is not null").select("text", "lang", F.xxhash64("text").alias("h"))
    sizes = {r["lang"]: r["n"] for r in at.groupBy("lang").agg(F.approx_count_distinct("h", 0.02).alias("n")).limit(MAX_LANGS + 1).collect()}
    if len(sizes) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages")
    each = max(1, most // max(1, len(sizes)))
    # Some four times as many as are wanted are left by their hash alone, however many there are.
    share = at.sparkSession.createDataFrame([(g, min(1 << 20, 64 + ((4 * each << 20) // max(1, n)))) for g, n in sizes.items()], "lang string, share long")
    few = at.join(F.broadcast(share), "lang").where(F.pmod("h", F.lit(1 << 20)) < F.col("share")).select("text", "lang", "h")
    best = few.select("lang", "h").distinct().withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy("h"))).where(F.col("k") <= each).select("lang", "h")
    # Copies become one on the executors.
    return few.join(F.broadcast(best), ["lang", "h"], "left_semi").groupBy("lang", "h").agg(F.min("text").alias("text")).select("text", "lang")


def language_id(docs: DataFrame, labelled: DataFrame) -> DataFrame:
    """doc_id, lang_pred, score and rejected of every row of docs (doc_id, text); labelled has text and lang."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [counts_of(t.as_py() or "") for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array([i.astype("<u2").tobytes() for i, _ in found], pa.binary()), pa.array([n.astype("<u4").tobytes() for _, n in found], pa.binary())], ["lang", "ids", "n"])

    rows = fit_sample(labelled).mapInArrow(count, "lang string, ids binary, n binary").collect()  # MAX_FIT or, if there are more, a row a language
    rows = sorted((r["lang"], bytes(r["ids"]), bytes(r["n"])) for r in rows if r["ids"])
    langs = sorted({r[0] for r in rows})
    table, cut = train([(np.frombuffer(i, "<u2").astype(np.int64), np.frombuffer(n, "<u4")) for _, i, n in rows], np.array([langs.index(g) for g, _, _ in rows]), len(langs)) if langs else (None, 1.1)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in blocks(whole):
                text = batch.column("text")
                data, ends = text_buffer(text)
                p = softmax(score_block(data, ends, table)[0] if table is not None else np.zeros((len(ends), 1)))
                best, top = p.argmax(axis=1), p.max(axis=1)
                known = np.array([has_letter(t.as_py()) for t in text], dtype=bool) & (table is not None)
                pred, top = [langs[b] if k else "und" for b, k in zip(best, known)], np.where(known, top, 0.0)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(pred, pa.string()), pa.array(top, pa.float64()), pa.array(~known | (top < cut))], ["doc_id", "lang_pred", "score", "rejected"])

    return docs.select("doc_id", "text").mapInArrow(score, "doc_id long, lang_pred string, score double, rejected boolean")


def score_block(data: np.ndarray, ends: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The mean of the table's rows over each text's n-grams, and their number."""
    sums, total = np.zeros((len(ends), table.shape[1])), np.zeros(len(ends), dtype=np.int64)
    for buckets, count in bucket_stream(data, ends):
        if len(buckets):
            doc = np.repeat(np.arange(len(ends)), count)
            for c in range(table.shape[1]):
                sums[:, c] += np.bincount(doc, weights=table[:, c][buckets], minlength=len(ends))
        total += count
    return sums / np.maximum(total, 1)[:, None], total
