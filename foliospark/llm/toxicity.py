"""Toxicity: a bidirectional gated recurrent network with attention pooling over character and word inputs.

A word's input joins a hashed word embedding with the mean of its hashed character n-grams' embeddings.
Words of more than LONGEST_WORD bytes (texts without ASCII white space are one) are read as pieces of
about PIECE bytes that overlap by half, in training and scoring alike; a piece is a word from then on.
The network reads windows of LENGTH words that overlap by half; attention pools the states of a window
and a logistic unit scores it. A text's score is that of its worst window. Every window of the whole
text is scored; trained in numpy on the driver.

Labels are of whole texts: of a toxic text the windows count whose words are most typical of toxic
texts (by smoothed log odds of word buckets), of a clean text its most suspicious windows and some others.
At most about MAX_FIT labelled texts, chosen by a hash of doc_id, are learned from, and of each at most
EACH windows reach the driver.

Defined results: null texts and texts without words are scored as one empty window; labels that are
null are left out, and repeated rows and labels are learned from once; without labels of both kinds every score is 0; repeated rows give repeated results;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import blas  # noqa: F401
from .common import discard, materialise
from .language_id import blocks, bucket_stream, text_buffer
from .wordhash import word_table

LENGTH, STEP, WORD_BUCKETS, GRAM_BITS, EMBED, HIDDEN, ATTEND = 32, 16, 1 << 14, 15, 8, 8, 8
GRAM_BUCKETS, GRAMS = 1 << GRAM_BITS, (3, 4, 5)
MAX_FIT, EACH, LONGEST_WORD, PIECE, CLUES, ASIDE = 4_000, 3, 64, 24, 1 << 18, 30


def windows(words: np.ndarray) -> np.ndarray:
    """[windows, LENGTH] places into words (a row of one text), -1 beyond the end; the last window ends with the text."""
    n = len(words)
    begins = np.unique(np.append(np.arange(0, max(1, n - LENGTH + 1), STEP), max(0, n - LENGTH)))
    at = begins[:, None] + np.arange(LENGTH)
    return np.where(at < n, at, -1)


class Vocabulary:
    """Distinct words: their word bucket and character n-gram buckets."""

    def __init__(self, data: np.ndarray, ends: np.ndarray, h: np.ndarray):
        self.word = (h % np.uint64(WORD_BUCKETS)).astype(np.int64)
        parts = list(bucket_stream(data, ends, GRAMS, GRAM_BITS)) if len(data) else []
        counts = sum((c for _, c in parts), np.zeros(len(ends), dtype=np.int64))
        owner = np.concatenate([np.repeat(np.arange(len(ends)), c) for _, c in parts]) if parts else np.zeros(0, np.int64)
        grams = np.concatenate([g for g, _ in parts]) if parts else np.zeros(0, np.uint32)
        self.grams = grams[np.argsort(owner, kind="stable")].astype(np.int64)
        self.counts, self.begin = counts, np.cumsum(counts) - counts

    def grams_of(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The n-gram buckets of some words, one after another, and each one's word."""
        n = self.counts[which]
        owner = np.repeat(np.arange(len(which)), n)
        return self.grams[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.begin[which], n)], owner


def gathered(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """The bytes of some spans of data, one after another."""
    size = stop - start
    return data[np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(start, size)]


def step_table(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """word_table, with the pieces of each word over LONGEST_WORD in its place: every n-gram of the word is whole
    in one of them. Pieces begin and end with a character and have PIECE - 3 to PIECE + 3 bytes."""
    start, stop, owner, h = word_table(data, ends, lower=True)
    size = stop - start
    many = np.where(size > LONGEST_WORD, -(-(size - PIECE) // (PIECE // 2)) + 1, 1)
    if len(many) == many.sum():
        return start, stop, owner, h
    word = np.repeat(np.arange(len(start)), many)
    k = np.arange(len(word)) - np.repeat(np.cumsum(many) - many, many)
    cut = many[word] > 1
    begin = start[word] + np.where(cut, np.minimum(k * (PIECE // 2), size[word] - PIECE), 0)
    end = np.where(cut, begin + PIECE, stop[word])
    for _ in range(3):  # back to where a character begins
        begin = begin - (cut & (begin > start[word]) & (data[begin] & 0xC0 == 0x80))
        end = end - (cut & (end < stop[word]) & (data[np.minimum(end, len(data) - 1)] & 0xC0 == 0x80))
    h = h[word]
    h[cut] = word_table(gathered(data, begin[cut], end[cut]), np.cumsum((end - begin)[cut]), lower=True)[3]
    return begin, end, owner[word], h


def distinct_words(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, Vocabulary]:
    """The text of each word, its number among the distinct words, and those."""
    start, stop, owner, h = step_table(data, ends)
    unique, first, number = np.unique(h, return_index=True, return_inverse=True)
    size = stop[first] - start[first]
    at = np.cumsum(size) - size
    take = np.arange(size.sum()) - np.repeat(at, size)
    padded = np.full(size.sum() + 2 * len(size), 32, dtype=np.uint8)  # a blank on either side, so that n-grams know where a word begins and ends
    padded[take + np.repeat(at + 2 * np.arange(len(size)) + 1, size)] = data[take + np.repeat(start[first], size)]
    return owner, number, Vocabulary(padded, np.cumsum(size + 2), unique)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Network:
    def __init__(self, seed: int = 5):
        draw = np.random.default_rng(seed)
        make = lambda *s, scale=0.3: draw.normal(0, scale, s).astype(np.float32)
        self.p = {"words": make(WORD_BUCKETS, EMBED, scale=0.05), "grams": make(GRAM_BUCKETS, EMBED, scale=0.1), "attend": make(2 * HIDDEN, ATTEND), "query": make(ATTEND), "out": make(2 * HIDDEN), "bias": np.zeros(1, np.float32)}
        for d in "fb":
            self.p |= {f"in_{d}": make(2 * EMBED, 3 * HIDDEN), f"state_{d}": make(HIDDEN, 3 * HIDDEN), f"base_{d}": np.zeros(3 * HIDDEN, np.float32)}

    def inputs(self, vocabulary: Vocabulary, which: np.ndarray, keep: np.ndarray | None = None) -> np.ndarray:
        """keep: a weight for each n-gram of the words."""
        grams, owner = vocabulary.grams_of(which)
        chars = np.stack([np.bincount(owner, weights=self.p["grams"][:, c][grams] if keep is None else self.p["grams"][:, c][grams] * keep, minlength=len(which)) for c in range(EMBED)], axis=1) if len(grams) else np.zeros((len(which), EMBED))
        return np.concatenate([self.p["words"][vocabulary.word[which]], chars / np.sqrt(np.maximum(vocabulary.counts[which], 1))[:, None]], axis=1).astype(np.float32)

    def run(self, gates: np.ndarray, at: np.ndarray, mask: np.ndarray, d: str, keep: list | None = None) -> np.ndarray:
        """States [time, windows, HIDDEN] of one direction; gates: the input's part of the gates of each distinct word."""
        state, out = np.zeros((at.shape[1], HIDDEN), np.float32), np.zeros((*at.shape, HIDDEN), np.float32)
        recurrent = self.p[f"state_{d}"]
        for t in range(len(at)) if d == "f" else reversed(range(len(at))):
            x, s = gates[at[t]], state @ recurrent
            zr = sigmoid(x[:, : 2 * HIDDEN] + s[:, : 2 * HIDDEN])
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            n = np.tanh(x[:, 2 * HIDDEN :] + r * s[:, 2 * HIDDEN :])
            new = n + z * (state - n)
            if keep is not None:
                keep.append((t, state, z, r, n, s[:, 2 * HIDDEN :]))
            m = mask[t][:, None]
            state = new if m.all() else np.where(m, new, state)
            out[t] = state
        return out

    def pool(self, states: np.ndarray, mask: np.ndarray):
        a = np.tanh(states @ self.p["attend"])
        s = np.where(mask, a @ self.p["query"], -1e9)
        w = np.exp(s - s.max(axis=0))
        w = (w / w.sum(axis=0)).astype(np.float32)
        pooled = (w[:, :, None] * states).sum(axis=0)
        return a, w, pooled, pooled @ self.p["out"] + self.p["bias"]

    def gates(self, x: np.ndarray, d: str) -> np.ndarray:
        return x @ self.p[f"in_{d}"] + self.p[f"base_{d}"]

    def score(self, vocabulary: Vocabulary, at: np.ndarray, most: int = 2048) -> np.ndarray:
        """The log odds of each window of `at` [windows, LENGTH], numbers of distinct words, -1 for none."""
        x = self.inputs(vocabulary, np.arange(len(vocabulary.word))) if len(vocabulary.word) else np.zeros((1, 2 * EMBED), np.float32)
        gates = {d: self.gates(x, d) for d in "fb"}
        out = np.zeros(len(at), np.float32)
        for k in range(0, len(at), most):
            part = np.ascontiguousarray(at[k : k + most].T)
            mask = part >= 0
            part = np.maximum(part, 0)
            states = np.concatenate([self.run(gates[d], part, mask, d) for d in "fb"], axis=2)
            out[k : k + most] = self.pool(states, mask)[3]
        return out

    def gradients(self, vocabulary: Vocabulary, at: np.ndarray, y: np.ndarray, draw: np.random.Generator, drop: float = 0.5) -> dict[str, np.ndarray]:
        """drop: how often a distinct word's own embedding, and each of its n-grams, is left out."""
        p, g = self.p, {k: np.zeros_like(v) for k, v in self.p.items()}
        which, part = np.unique(np.maximum(at, 0), return_inverse=True)
        part, mask = part.reshape(at.shape).T, (at >= 0).T
        keep = (draw.random(vocabulary.counts[which].sum()) >= drop) / (1 - drop)
        x = self.inputs(vocabulary, which, keep)
        known = ((draw.random(len(which)) >= drop) / (1 - drop))[:, None]
        x[:, :EMBED] *= known
        kept: dict[str, list] = {"f": [], "b": []}
        states = np.concatenate([self.run(self.gates(x, d), part, mask, d, kept[d]) for d in "fb"], axis=2)
        a, w, pooled, z = self.pool(states, mask)
        dz = ((sigmoid(z) - y) / len(y)).astype(np.float32)
        g["out"], g["bias"] = pooled.T @ dz, np.array([dz.sum()], np.float32)
        dp = dz[:, None] * p["out"]
        ds = w[:, :, None] * dp
        dw = (states * dp).sum(axis=2)
        da = (w * (dw - (w * dw).sum(axis=0)))[:, :, None] * p["query"] * (1 - a * a)
        g["query"] = np.einsum("tb,tba->a", w * (dw - (w * dw).sum(axis=0)), a)
        g["attend"] = np.einsum("tbh,tba->ha", states, da)
        ds = ds + da @ p["attend"].T
        dx = np.zeros_like(x)
        for i, d in enumerate("fb"):
            back, dg = np.zeros((at.shape[0], HIDDEN), np.float32), np.zeros((*part.shape, 3 * HIDDEN), np.float32)
            for t, before, zt, r, n, sn in reversed(kept[d]):
                dh = ds[t][:, i * HIDDEN : (i + 1) * HIDDEN] + back
                m = mask[t][:, None]
                dn = np.where(m, dh, 0)
                back = np.where(m, dn * zt, dh)
                d_z = dn * (before - n) * zt * (1 - zt)
                d_n = dn * (1 - zt) * (1 - n * n)
                d_r = d_n * sn * r * (1 - r)
                ds_gate = np.concatenate([d_z, d_r, d_n * r], axis=1)
                g[f"state_{d}"] += before.T @ ds_gate
                back = back + ds_gate @ p[f"state_{d}"].T
                dg[t] = np.concatenate([d_z, d_r, d_n], axis=1)
            flat, where = dg.reshape(-1, 3 * HIDDEN), part.reshape(-1)
            per_word = np.stack([np.bincount(where, weights=flat[:, c], minlength=len(which)) for c in range(3 * HIDDEN)], axis=1).astype(np.float32)
            g[f"base_{d}"] = flat.sum(axis=0)
            g[f"in_{d}"] = x.T @ per_word
            dx += per_word @ p[f"in_{d}"].T
        grams, owner = vocabulary.grams_of(which)
        each = dx[:, EMBED:] / np.sqrt(np.maximum(vocabulary.counts[which], 1))[:, None]
        dx[:, :EMBED] *= known
        for c in range(EMBED):
            g["words"][:, c] = np.bincount(vocabulary.word[which], weights=dx[:, c], minlength=WORD_BUCKETS)
            g["grams"][:, c] = np.bincount(grams, weights=each[:, c][owner] * keep, minlength=GRAM_BUCKETS)
        return g


def common_buckets(vocabulary: Vocabulary, at: np.ndarray, least: int = 3) -> dict[str, np.ndarray]:
    """1 for the buckets of words and of n-grams that `least` windows or more hold, 0 for others: what is seen
    less is learned by heart, and no model of it is of use elsewhere."""
    words, grams = np.zeros(WORD_BUCKETS, dtype=np.int64), np.zeros(GRAM_BUCKETS, dtype=np.int64)
    for k in range(0, len(at), 500):
        window, place = np.nonzero(at[k : k + 500] >= 0)
        pairs = np.unique(np.stack([window, at[k + window, place]]), axis=1)
        words += np.bincount(np.unique(pairs[0] * WORD_BUCKETS + vocabulary.word[pairs[1]]) % WORD_BUCKETS, minlength=WORD_BUCKETS)
        found, owner = vocabulary.grams_of(pairs[1])
        grams += np.bincount(np.unique(pairs[0][owner] * GRAM_BUCKETS + found) % GRAM_BUCKETS, minlength=GRAM_BUCKETS)
    return {"words": (words >= least).astype(np.float32), "grams": (grams >= least).astype(np.float32)}


def train(texts: list[str], y: np.ndarray, net: Network | None = None, telling: np.ndarray | None = None, rounds: int = 6, least: int = 300, batch: int = 128, rate: float = 0.01, decay: float = 0.1, swap: float = 0.5, seed: int = 5) -> Network:
    """texts: windows of at most LENGTH words; Adam on the mean log loss, both labels weighing alike in a
    batch's draw, for `rounds` rounds and at least `least` batches. swap: up to this share of a window's words is
    exchanged for words of clean windows, so that no window can be learned by heart. telling marks clues that tell a toxic text:
    where a toxic window has words with such clues, nearly all its others are exchanged."""
    raw = [t.encode() for t in texts]
    data, ends = np.frombuffer(b"".join(raw), dtype=np.uint8), np.cumsum([len(t) for t in raw])
    owner, number, vocabulary = distinct_words(data, ends)
    at = np.full((len(texts), LENGTH), -1)
    place = np.arange(len(owner)) - np.searchsorted(owner, owner)
    at[owner[place < LENGTH], place[place < LENGTH]] = number[place < LENGTH]
    net, draw = net or Network(seed), np.random.default_rng(seed)
    often = {k: v[:, None] for k, v in common_buckets(vocabulary, at).items()}
    for name, keep in often.items():
        net.p[name] *= keep
    pool = at[y == 0]
    pool = pool[pool >= 0]
    share = np.full(at.shape, swap)
    if telling is not None and len(owner):
        found, of = clues(data, ends)
        word = np.maximum.reduceat(telling[found], np.searchsorted(of, np.arange(len(owner))))
        tells = np.zeros(at.shape, dtype=bool)
        tells[owner[place < LENGTH], place[place < LENGTH]] = word[place < LENGTH]
        borne = (y == 1) & tells.any(axis=1)
        share[borne] = np.where(tells[borne], 0.2, 0.95)
    first, second, step = {k: np.zeros_like(v) for k, v in net.p.items()}, {k: np.zeros_like(v) for k, v in net.p.items()}, 0
    sides = [np.flatnonzero(y == 0), np.flatnonzero(y == 1)]
    size = max(len(s) for s in sides)
    rounds = max(rounds, -(-least * batch // max(1, 2 * size)))
    for k in range(rounds):
        order = np.stack([np.resize(draw.permutation(s), size) for s in sides], axis=1).reshape(-1)
        for i in range(0, len(order), batch):
            part = order[i : i + batch]
            mixed = at[part]
            other = (mixed >= 0) & (draw.random(mixed.shape) < share[part] * np.where(share[part] > swap, 1, draw.random((len(part), 1))))
            mixed[other] = pool[draw.integers(len(pool), size=int(other.sum()))]
            grads = net.gradients(vocabulary, mixed, y[part], draw)
            step += 1
            lr = rate * (1 - k / rounds) + 1e-4
            for name, g in grads.items():
                g = g * often[name] if name in often else g
                first[name] += 0.1 * (g - first[name])
                second[name] += 0.01 * (g * g - second[name])
                if name in often:
                    net.p[name] *= 1 - decay * lr
                net.p[name] -= lr * (first[name] / (1 - 0.9**step)) / (np.sqrt(second[name] / (1 - 0.99**step)) + 1e-7)
    return net


def toxicity(docs: DataFrame, labels: DataFrame, most: int = MAX_FIT) -> DataFrame:
    """doc_id and score of every row of docs (doc_id, text); labels (doc_id, label 0 or 1) are what may be learned from."""
    known = labels.where(F.col("label").isin(0, 1)).select("doc_id", "label").distinct()
    sizes = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    # Half of the sample from either label, as far as there are as many.
    share = F.lit(0)
    for label, n in sizes.items():
        share = F.when(F.col("label") == label, F.lit(max(1, min(1 << 20, ((most // 2) << 20) // n)))).otherwise(share)
    chosen = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < share)
    # At most about MAX_FIT rows; copies of a row become one before they meet.
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label", F.xxhash64("text")).agg(F.min("text").alias("text"))
    sample = materialise(sample.select("doc_id", "text", "label"), "toxicity-sample")
    net = fit_network(sample) if len(sizes) == 2 else None
    discard(sample)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in blocks(whole):
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score_texts(net, *text_buffer(batch.column("text"))) if net else np.zeros(batch.num_rows))], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(score, "doc_id long, score double")


def score_texts(net: Network, data: np.ndarray, ends: np.ndarray, odds: bool = False) -> np.ndarray:
    """The score of each text's worst window; odds: its log odds."""
    owner, number, vocabulary = distinct_words(data, ends)
    sizes = np.bincount(owner, minlength=len(ends))
    first = np.cumsum(sizes) - sizes
    many = np.maximum(-(-(sizes - LENGTH) // STEP), 0) + 1  # windows of each text
    text = np.repeat(np.arange(len(ends)), many)
    k = np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many)
    begin = np.maximum(np.minimum(k * STEP, sizes[text] - LENGTH), 0)
    at = begin[:, None] + np.arange(LENGTH)
    at = np.where(at < sizes[text][:, None], first[text][:, None] + at, -1)
    at = np.where(at >= 0, number[np.maximum(at, 0)], -1) if len(number) else np.full(at.shape, -1)
    z = net.score(vocabulary, at)
    worst = np.maximum.reduceat(z, np.cumsum(many) - many).astype(np.float64) if len(ends) else np.zeros(0)
    return worst if odds else sigmoid(worst)


def clues(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of each word's whole and of its first four and five bytes, of words as long as a piece of those
    at each of its places; and each bucket's word, ascending."""
    start, stop, _, h = step_table(data, ends)
    low = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data).astype(np.uint64)
    size = stop - start
    places = np.where(size >= PIECE - 3, size - 3, 1)
    word = np.repeat(np.arange(len(start)), places)
    begin = start[word] + np.arange(len(word)) - np.repeat(np.cumsum(places) - places, places)
    out, owner, head = [h % np.uint64(CLUES)], [np.arange(len(start))], np.zeros(len(word), dtype=np.uint64)
    for k in range(5):
        at = begin + k
        head = head * np.uint64(257) + np.where(at < stop[word], low[np.minimum(at, len(low) - 1)], 1) if len(low) else head
        if k >= 3:
            out.append((head * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(20)) % np.uint64(CLUES))
            owner.append(word)
    order = np.argsort(np.concatenate(owner), kind="stable")
    return np.concatenate(out)[order].astype(np.int64), np.concatenate(owner)[order]


def fit_network(sample: DataFrame, again: int = 2) -> Network:
    """Passes over the sample: how often words and their beginnings go with either label, the windows
    they point to, `again` times the windows that the network trained so far finds worst, and at last
    whole texts' scores, between which the bias is set: those of a fifth of the sample that training doesn't see, if it holds
    enough toxic ones."""
    aside = F.pmod(F.xxhash64("doc_id", F.lit("aside")), F.lit(5)) == 0
    whole_sample, calls = sample, sample.where(aside)
    if calls.where("label = 1").limit(ASIDE).count() == ASIDE:
        sample = whole_sample.where(~aside)
    else:
        calls = whole_sample
    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((2, CLUES), dtype=np.int32)
        for batch in batches:
            for text, label in zip(batch.column("text"), batch.column("label")):
                raw = np.frombuffer((text.as_py() or "").encode(), dtype=np.uint8)
                seen[label.as_py(), np.unique(clues(raw, np.array([len(raw)]))[0])] += 1
        yield pa.RecordBatch.from_arrays([pa.array([0, 1], pa.int32()), pa.array([s.tobytes() for s in seen], pa.binary())], ["label", "seen"])

    seen = np.zeros((2, CLUES))
    for r in sample.select("text", "label").mapInArrow(held, "label int, seen binary").toLocalIterator():
        seen[r["label"]] += np.frombuffer(bytes(r["seen"]), dtype=np.int32)
    totals = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    # Three toxic texts have it, and five times as many of a hundred as of clean ones.
    telling = (seen[1] >= 3) & (seen[1] / max(1, totals.get(1, 0)) > 5 * (seen[0] + 0.5) / max(1, totals.get(0, 0)))
    odds = (np.log((seen[1] + 1) / (totals.get(1, 0) + 1)) - np.log((seen[0] + 1) / (totals.get(0, 0) + 1))).astype(np.float32)

    def typical(words: list[bytes], at: np.ndarray) -> np.ndarray:
        raw = np.frombuffer(b" ".join(words), dtype=np.uint8)
        found, owner = clues(raw, np.array([len(raw)]))
        value = np.append(np.maximum.reduceat(odds[found], np.searchsorted(owner, np.arange(len(words)))) if len(words) else np.zeros(0), 0.0)
        return np.sort(value[at], axis=1)[:, -2:].sum(axis=1)

    rows = pick(sample, typical)
    net = train([t for _, t in rows], np.array([k for k, _ in rows], dtype=np.float32), telling=telling)
    for _ in range(again):
        now = net  # the closure below is sent to executors with the network as it is

        def worst(words: list[bytes], at: np.ndarray) -> np.ndarray:
            raw = np.frombuffer(b" ".join(words), dtype=np.uint8)
            _, number, vocabulary = distinct_words(raw, np.array([len(raw)]))
            return now.score(vocabulary, np.where(at >= 0, np.append(number, -1)[at], -1))

        fresh = pick(sample, worst)
        rows = sorted({*(r for r in rows if not r[0]), *fresh})
        net = train([t for _, t in rows], np.array([k for k, _ in rows], dtype=np.float32), net, telling, rounds=3, least=150, rate=0.004)
    final = net

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [float(score_texts(final, *text_buffer(pa.array([t.as_py() or ""])), odds=True)[0]) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(scores, pa.float64())], ["label", "z"])

    done = sorted((r["z"], r["label"]) for r in calls.select("text", "label").mapInArrow(whole, "label int, z double").collect())
    net.p["bias"] -= np.float32(threshold(np.array([z for z, _ in done]), np.array([k for _, k in done])))
    return net


def threshold(z: np.ndarray, y: np.ndarray) -> float:
    """The cut between ascending scores with the fewest errors; of equally good ones the middle of the widest gap."""
    errors = np.concatenate([[0], np.cumsum(y)]) + (y == 0).sum() - np.concatenate([[0], np.cumsum(y == 0)])
    edge = np.concatenate([[z[0] - 1], z, [z[-1] + 1]]) if len(z) else np.zeros(2)
    best = np.flatnonzero(errors == errors.min())
    k = best[np.argmax(edge[best + 1] - edge[best])]
    return float(edge[k] + edge[k + 1]) / 2


def pick(sample: DataFrame, value) -> list[tuple[int, str]]:
    """(label, words) of windows: a toxic text's of the highest value, a clean one's highest and others spread over it."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label_of, texts = [], []
            for text, label in zip(batch.column("text"), batch.column("label")):
                raw = (text.as_py() or "").encode()
                start, stop, _, _ = step_table(np.frombuffer(raw, dtype=np.uint8), np.array([len(raw)]))
                words = [raw[a:b] for a, b in zip(start.tolist(), stop.tolist())]
                at = windows(np.array(words, dtype=object))
                rank = np.argsort(-value(words, at), kind="stable")
                picked = rank[:1] if label.as_py() else np.append(rank[:1], rank[1:][:: max(1, -(-len(rank[1:]) // (EACH - 1)))][: EACH - 1])
                for k in picked:
                    texts.append(b" ".join(words[i] for i in at[k] if i >= 0).decode())
                    label_of.append(label.as_py())
            yield pa.RecordBatch.from_arrays([pa.array(label_of, pa.int32()), pa.array(texts, pa.string())], ["label", "text"])

    return sorted((r["label"], r["text"]) for r in sample.select("text", "label").mapInArrow(cut, "label int, text string").collect())
