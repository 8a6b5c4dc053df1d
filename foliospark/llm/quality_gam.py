"""Quality classifier: a generalised additive model with pairwise interactions.

Cyclic boosting fits one shallow tree at a time, on the binned values of one feature (then of one pair
of features), in turn; each tree is added to that feature's lookup table, so the model is a set of
tables and a score is a sum of their entries. Features are byte and word statistics of the whole text.

Fitted on at most about MAX_FIT labelled rows, chosen by a hash of doc_id. Defined results: null and
empty texts have all features 0 and are scored like any other; labels that are null are left out,
repeated rows and labels are learned from once; without any label every score is 0.5; repeated rows give repeated results;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import materialise
from .language_id import blocks, text_buffer
from .wordhash import word_table

MAX_FIT, BINS, COARSE = 20_000, 32, 8
FEATURES = ("log_bytes", "log_words", "word_length", "upper", "symbols", "bars", "marks", "digits", "stops", "commas", "lines", "repeats", "repeats2", "distinct", "high_bytes", "other")
_KIND = np.zeros(256, dtype=np.int64)
for _k, _chars in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"#*$%&<>^~=+_\\@", b"|", b"!?", b"0123456789", b".:;", b",", b"\n", b" \t\r", bytes(range(128, 256)), b"abcdefghijklmnopqrstuvwxyz"), 1):
    _KIND[list(_chars)] = _k


def features(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A row of FEATURES for each text."""
    n = len(ends)
    size = np.diff(ends, prepend=0)
    text = np.repeat(np.arange(n), size)
    kinds = np.bincount(text * 12 + _KIND[data], minlength=12 * n).reshape(n, 12).astype(float)
    pairs = np.zeros(n)
    if len(data) > 1:  # capitals beyond ASCII that take two bytes: U+00C0 to U+00DE
        pairs = np.bincount(text[1:][(data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)], minlength=n)
    start, stop, owner, h = word_table(data, ends)
    words = np.bincount(owner, minlength=n)
    same = lambda lag: np.bincount(owner[lag:][(h[lag:] == h[:-lag]) & (owner[lag:] == owner[:-lag])], minlength=n) if len(h) > lag else np.zeros(n)
    keys = np.sort(owner.astype(np.uint64) << np.uint64(40) | h >> np.uint64(24))
    distinct = np.bincount((keys[np.concatenate([[True], keys[1:] != keys[:-1]])] >> np.uint64(40)).astype(np.int64), minlength=n) if len(keys) else np.zeros(n)
    chars, w = np.maximum(size - kinds[:, 8] - kinds[:, 9], 1), np.maximum(words, 1)
    letters = np.maximum(kinds[:, 1] + kinds[:, 11] + kinds[:, 10] / 2, 1)
    return np.column_stack([np.log1p(size), np.log1p(words), chars / w * (words > 0), (kinds[:, 1] + pairs) / letters, kinds[:, 2] / chars, kinds[:, 3] / w, kinds[:, 4] / w, kinds[:, 5] / chars, kinds[:, 6] / w, kinds[:, 7] / w, kinds[:, 8] / w, same(1) / w, same(2) / w, distinct / w, kinds[:, 10] / chars, kinds[:, 0] / chars])


class Gam:
    """edges[f]: upper limits of feature f's bins; tables[f]: its scores; pairs: [(f, g, table over coarse bins)]."""

    def __init__(self, edges: list[np.ndarray], tables: list[np.ndarray], pairs: list, bias: float):
        self.edges, self.tables, self.pairs, self.bias = edges, tables, pairs, bias

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(self.edges)]) if len(x) else np.zeros((0, len(self.edges)), int)

    def score(self, x: np.ndarray) -> np.ndarray:
        b = self.bins(x)
        z = np.full(len(x), self.bias)
        for f, t in enumerate(self.tables):
            z += t[b[:, f]]
        for f, g, t in self.pairs:
            z += t[coarse(b[:, f], self.edges[f]), coarse(b[:, g], self.edges[g])]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def coarse(b: np.ndarray, edges: np.ndarray) -> np.ndarray:
    return b * COARSE // (len(edges) + 1)


def best_cut(grad: np.ndarray, weight: np.ndarray, least: float) -> tuple[float, int]:
    """The gain and place of the best cut of a row of bins; place 0: none."""
    g, w = np.cumsum(grad), np.cumsum(weight)
    left, right = w[:-1], w[-1] - w[:-1]
    ok = (left >= least) & (right >= least)
    gain = np.where(ok, g[:-1] ** 2 / (left + 1) + (g[-1] - g[:-1]) ** 2 / (right + 1) - g[-1] ** 2 / (w[-1] + 1), 0) if len(g) > 1 else np.zeros(0)
    k = int(gain.argmax()) if len(gain) else 0
    return (float(gain[k]), k + 1) if len(gain) and gain[k] > 1e-9 else (0.0, 0)


def shallow_tree(grad: np.ndarray, weight: np.ndarray, least: float = 1.0) -> np.ndarray:
    """The steps of a tree of at most four leaves over a feature's bins."""
    step, spans = np.zeros(len(grad)), [(0, len(grad))]
    for _ in range(2):
        spans = [part for a, b in spans for c in [best_cut(grad[a:b], weight[a:b], least)[1]] for part in ([(a, a + c), (a + c, b)] if c else [(a, b)])]
    for a, b in spans:
        step[a:b] = grad[a:b].sum() / (weight[a:b].sum() + 1)
    return step


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 150, rate: float = 0.2, pairs: int = 6, pair_rounds: int = 60) -> Gam:
    """Main effects first, round after round over all features; then the pairs that most of what is left depends on."""
    n, k = x.shape
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) if n else np.zeros(0) for f in range(k)]
    share = (y.sum() + 1) / (n + 2)
    model = Gam(edges, [np.zeros(len(e) + 1) for e in edges], [], float(np.log(share / (1 - share))))
    if not n or y.min() == y.max():
        return model
    b, z = model.bins(x), np.full(n, model.bias)
    for _ in range(rounds):
        for f in range(k):
            p = 1 / (1 + np.exp(-z))
            size = len(edges[f]) + 1
            step = rate * shallow_tree(np.bincount(b[:, f], y - p, size), np.bincount(b[:, f], p * (1 - p), size))
            model.tables[f] += step
            z += step[b[:, f]]
    c = [coarse(b[:, f], edges[f]) for f in range(k)]
    p = 1 / (1 + np.exp(-z))
    def quadrants(f: int, g: int, p: np.ndarray) -> tuple[float, np.ndarray]:
        at = c[f] * COARSE + c[g]
        grad, weight = (np.bincount(at, v, COARSE * COARSE).reshape(COARSE, COARSE) for v in (y - p, p * (1 - p)))
        gs, ws = grad.cumsum(0).cumsum(1), weight.cumsum(0).cumsum(1)
        best = (0.0, np.zeros((COARSE, COARSE)))
        for i in range(COARSE - 1):
            for j in range(COARSE - 1):
                parts = [(gs[i, j], ws[i, j]), (gs[i, -1] - gs[i, j], ws[i, -1] - ws[i, j]), (gs[-1, j] - gs[i, j], ws[-1, j] - ws[i, j]), (gs[-1, -1] - gs[i, -1] - gs[-1, j] + gs[i, j], ws[-1, -1] - ws[i, -1] - ws[-1, j] + ws[i, j])]
                gain = sum(a * a / (w + 1) for a, w in parts)
                if gain > best[0]:
                    step = np.empty((COARSE, COARSE))
                    for (a, w), where in zip(parts, ((slice(None, i + 1), slice(None, j + 1)), (slice(None, i + 1), slice(j + 1, None)), (slice(i + 1, None), slice(None, j + 1)), (slice(i + 1, None), slice(j + 1, None)))):
                        step[where] = a / (w + 1)
                    best = (gain, step)
        return best
    ranked = sorted(((quadrants(f, g, p)[0], f, g) for f in range(k) for g in range(f)), reverse=True)[:pairs]
    model.pairs = [(f, g, np.zeros((COARSE, COARSE))) for _, f, g in ranked]
    for _ in range(pair_rounds):
        for f, g, t in model.pairs:
            step = rate * quadrants(f, g, 1 / (1 + np.exp(-z)))[1]
            t += step
            z += step[c[f], c[g]]
    return model


def feature_table(docs: DataFrame) -> DataFrame:
    """doc_id and an array of FEATURES for every row of docs (doc_id, text)."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in blocks(whole):
                x = features(*text_buffer(batch.column("text")))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(list(x), pa.list_(pa.float64()))], ["doc_id", "x"])

    return docs.select("doc_id", "text").mapInArrow(count, "doc_id long, x array<double>")


def fit_rows(known: DataFrame) -> Gam:
    """The model of rows with label and x; sorted, so that the order of arrival doesn't matter."""
    rows = sorted((r["doc_id"], r["label"], r["x"]) for r in known.select("doc_id", "label", "x").distinct().collect())
    return fit(np.array([r[2] for r in rows]).reshape(len(rows), len(FEATURES)), np.array([float(r[1]) for r in rows]))


def sampled(labels: DataFrame, most: int) -> DataFrame:
    """About `most` of the rows with a label and a doc_id at most, by a hash of doc_id."""
    labels = labels.where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", "label")
    n = labels.count()
    return labels.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < max(1, (most << 20) // n)) if n > most else labels


def quality_gam(docs: DataFrame, labels: DataFrame, most: int = MAX_FIT) -> DataFrame:
    """doc_id and score of every row of docs; labels (doc_id, label 0 or 1) are what may be learned from."""
    at = materialise(feature_table(docs), "quality-gam")
    model = fit_rows(at.join(sampled(labels, most), "doc_id"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.score(x), pa.float64())], ["doc_id", "score"])

    return at.mapInArrow(score, "doc_id long, score double")


def quality_filter(docs: DataFrame, labels: DataFrame, least: float = 0.5, most: int = MAX_FIT) -> DataFrame:
    """The rows of docs, all columns, whose score is `least` or more; nothing but the labelled sample's features leaves its task."""
    chosen = F.broadcast(sampled(labels, most))  # bounded by `most`
    known = docs.select("doc_id", "text").join(chosen, "doc_id").select("doc_id", "text", "label")
    model = fit_rows(feature_table(known.select("doc_id", "text")).join(chosen, "doc_id"))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in blocks(whole):
                yield batch.filter(pa.array(model.score(features(*text_buffer(batch.column("text")))) >= least))

    return docs.mapInArrow(keep, docs.schema)
