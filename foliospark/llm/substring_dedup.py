"""Substring deduplication: repeated windows of words, found by backward search in compressed FM-indexes.

A window is SIZE consecutive words of one document; a word goes if a window that covers it also starts
earlier (smaller doc_id, or the same document further up).

1. Each window has a minimiser, the least hash of its runs of RUN words; neighbouring windows that share
   one form a segment. Equal windows have equal minimisers, so a window whose minimiser stands at one
   place only cannot be repeated. Chunks of documents send their distinct minimisers, packed, to
   buckets and get back those that occur again.
2. The words of segments with such minimisers go to the shard of their minimiser, of equal segments of a
   chunk the first two: a hot passage arrives twice from each chunk, however many documents hold it.
   A shard numbers the words and the BLOCK-word runs of its segments (by their bytes, so that equal numbers
   are equal words), sorts the suffixes as far as a window
   reaches, and keeps the Burrows-Wheeler transform in a wavelet matrix of packed bits. All windows
   are searched backwards at once; a search ends as soon as its interval holds the window alone, so
   the steps that it made are the window's matching statistic, in blocks. The interval of a whole
   window begins with its earliest occurrence.
3. Shards report runs of repeated windows, as intervals, to the chunks; what holds for the second of equal segments
   holds for those after it. Chunks drop the words and join the rest.

Chunks are hashes of doc_id; their number and that of the shards follow the input's bytes (`pieces`), so that
either keeps its size as the corpus grows. The texts are shuffled once, to their chunks.

Hashes only choose candidates; windows are compared as words. Defined results: null and empty texts have no words and
an empty kept text; a null doc_id comes before all others; rows that share a doc_id are one document: equal
rows are that document read again, and in rows with another text what stands further up in any of them is earlier;
windows at equal starts are no repeats of each other; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import pieces
from .language_id import blocks, text_buffer
from .wordhash import exact_numbers, exact_runs, mix, ranges, window_hashes, word_table

SIZE, RUN, BLOCK = 20, 8, 5
#: A shard works through its segments in parts of at most about so many symbols, by their minimisers.
PART = 400_000
NULL_ID = np.iinfo(np.int64).min


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` neighbours."""
    if len(x) < width:
        return x[:0]
    span = 1
    while span * 2 <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[: len(x) - (width - span)], x[width - span :]) if span < width else x


class Segments:
    """The segments of a run of texts: minimiser, whether it stands there twice, row, first word in the row's text and number of windows."""

    def __init__(self, text: pa.Array, row: int):
        data, ends = text_buffer(text)
        begin, stop, owner, h = word_table(data, ends)
        self.data, self.begin, self.size = data, begin, stop - begin
        self.words = np.bincount(owner, minlength=len(ends))
        runs = window_hashes(h, RUN)
        minimum = sliding_min(runs, SIZE - RUN + 1)
        n = len(minimum)
        valid = owner[: n] == owner[SIZE - 1 :] if n else np.zeros(0, bool)
        new = np.ones(n, dtype=bool)
        new[1:] = (minimum[1:] != minimum[:-1]) | (owner[1:n] != owner[: max(0, n - 1)])
        new &= valid
        self.at = np.flatnonzero(new)
        run = np.cumsum(new) - 1
        self.n = np.bincount(run[valid], minlength=len(self.at)) if len(self.at) else np.zeros(0, np.int64)
        self.minimum = minimum[self.at]
        # A segment whose minimiser stands at two places may repeat itself.
        span = self.n + SIZE - RUN
        same = runs[ranges(self.at, span)] == np.repeat(self.minimum, span)
        self.inner = np.bincount(np.repeat(np.arange(len(self.at)), span)[same], minlength=len(self.at)) > 1
        first = np.cumsum(self.words) - self.words
        self.row = owner[self.at] + row
        self.start = self.at - first[owner[self.at]]

    def texts(self, which: np.ndarray) -> list[bytes]:
        """The words of some segments, each ended by a blank."""
        count = self.n[which] + SIZE - 1
        word = ranges(self.at[which], count)
        size = self.size[word] + 1
        end = np.cumsum(size)
        out = self.data[np.minimum(ranges(self.begin[word], size), len(self.data) - 1)]
        out[end - 1] = 32
        cuts = np.concatenate([np.zeros(1, np.int64), end])[np.cumsum(np.concatenate([np.zeros(1, np.int64), count]))].tolist()
        raw = out.tobytes()
        return [raw[a:b] for a, b in zip(cuts, cuts[1:])]


def chunk_segments(texts: pa.Array) -> list[Segments]:
    batch = pa.RecordBatch.from_arrays([texts], ["text"])
    out, row = [], 0
    for part in blocks(batch):
        out.append(Segments(part.column("text"), row))
        row += part.num_rows
    return out


def chosen_texts(parts: list[Segments], chosen: np.ndarray) -> list[bytes]:
    """The words of the chosen segments of all parts, which chosen marks one part after another."""
    out, at = [], 0
    for p in parts:
        out += p.texts(np.flatnonzero(chosen[at : at + len(p.n)]))
        at += len(p.n)
    return out


def models(texts: list[bytes], doc: list[int], start: list[int]) -> list[int]:
    """For each segment (in the order of doc) the place of the one that stands for it: of equal segments the first stands for those at
    its own doc and start, the next one for all others."""
    seen: dict[bytes, list[int]] = {}
    out = []
    for k, t in enumerate(texts):
        have = seen.setdefault(t, [k])
        if doc[have[0]] == doc[k] and start[have[0]] == start[k]:
            out.append(have[0])
            continue
        if len(have) == 1:
            have.append(k)
        out.append(have[1])
    return out


def one_array(column: pa.ChunkedArray) -> pa.Array:
    return column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)


def ordered(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """The order of the rows by doc_id and the hash of their text, and in it the doc_ids, these hashes and the texts."""
    ids = one_array(table.column("doc_id")).fill_null(int(NULL_ID)).to_numpy(zero_copy_only=False)
    variant = one_array(table.column("v")).to_numpy(zero_copy_only=False)
    order = np.lexsort((variant, ids))
    return order, ids[order], variant[order], one_array(table.column("text")).take(pa.array(order, pa.int64()))


class WaveletMatrix:
    """Ranks of symbols in a sequence, from one packed bit a symbol and level and a count for every 64."""

    def __init__(self, sequence: np.ndarray, levels: int):
        self.levels, self.zeros, self.bits, self.counts = levels, [], [], []
        n = len(sequence)
        for k in reversed(range(levels)):
            bit = (sequence >> k & 1).astype(bool)
            packed = np.zeros((n // 64 + 1) * 64, dtype=bool)
            packed[:n] = bit
            packed = np.packbits(packed, bitorder="little").view(np.uint64)
            count = np.zeros(len(packed), dtype=np.int32)
            np.cumsum(np.bitwise_count(packed[:-1]), dtype=np.int32, out=count[1:])
            self.bits.append(packed)
            self.counts.append(count)
            self.zeros.append(n - int(bit.sum()))
            sequence = np.concatenate([sequence[~bit], sequence[bit]])

    def ranks(self, symbols: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How often each symbol stands before place low, and before place high."""
        begin = np.zeros(len(symbols), dtype=np.int64)
        for k in range(self.levels):
            one = (symbols >> (self.levels - 1 - k) & 1).astype(bool)
            out = []
            for at in (begin, low, high):
                word = at >> 6
                ones = self.counts[k][word] + np.bitwise_count(self.bits[k][word] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)))
                out.append(np.where(one, self.zeros[k] + ones, at - ones))
            begin, low, high = out
        return low - begin, high - begin


class FmIndex:
    """Of a collection of strings, each a phase (every BLOCK-th symbol) of a segment; symbols are whole numbers from 1.

    Suffixes are sorted by their first SIZE / BLOCK symbols and, where these are equal, by place, which
    is all that searches of that length ask for.
    """

    def __init__(self, symbols: np.ndarray, left: np.ndarray):
        """left: how many symbols follow each one in its segment."""
        self.depth = SIZE // BLOCK
        n, rank = len(symbols), symbols
        follow = lambda a, k: np.where(left >= k, np.append(a[k:], np.zeros(min(k, n), a.dtype))[:n], 0)
        span = 1
        while span < self.depth:
            rank = np.unique(rank.astype(np.uint64) * np.uint64(n + 2) + follow(rank, span * BLOCK).astype(np.uint64), return_inverse=True)[1] + 1
            span *= 2
        self.suffixes = np.argsort(rank, kind="stable")
        self.first = np.concatenate([np.zeros(2, np.int64), np.cumsum(np.bincount(symbols, minlength=int(symbols.max(initial=0)) + 1)[1:])])
        # A string's last symbol stands before its empty suffix. Those suffixes come before all others and are not
        # stored: they are counted here.
        self.base = self.first + np.append(np.bincount(symbols[left < BLOCK], minlength=len(self.first) - 1), 0)
        before = np.zeros(n, dtype=np.int64)
        has = np.flatnonzero(left >= BLOCK)
        before[has + BLOCK] = symbols[has]
        self.transform = WaveletMatrix(before[self.suffixes], max(1, int(symbols.max(initial=1)).bit_length()))

    def search(self, patterns: np.ndarray, least: int = 2) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Backward search of the rows of patterns, the last symbol first, as long as `least` suffixes match.

        Returns the matching statistic (symbols matched so) and the last interval of each row.
        """
        low, high = self.first[patterns[:, -1]], self.first[patterns[:, -1] + 1]
        deep = (high - low >= least).astype(np.int64)
        open_ = np.flatnonzero(deep)
        for k in range(patterns.shape[1] - 2, -1, -1):
            c = patterns[open_, k]
            a, b = self.transform.ranks(c, low[open_], high[open_])
            a, b = self.base[c] + a, self.base[c] + b
            ok = b - a >= least
            open_ = open_[ok]
            low[open_], high[open_] = a[ok], b[ok]
            deep[open_] += 1
        return deep, low, high


def repeated_windows(symbols: np.ndarray, n: np.ndarray, doc: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Of segments in the order of (doc, start), with the numbers of their BLOCK-word runs (from 1) one after another: True for
    every window (n of each segment) that also starts earlier."""
    size = n + SIZE - BLOCK
    place = np.arange(len(symbols)) - np.repeat(np.cumsum(size) - size, size)
    index = FmIndex(symbols, np.repeat(size, size) - 1 - place)
    window = np.flatnonzero(place < np.repeat(n, size))
    patterns = np.stack([symbols[window + k * BLOCK] for k in range(SIZE // BLOCK)], axis=1)
    deep, low, _ = index.search(patterns)
    found = np.flatnonzero(deep == SIZE // BLOCK)
    out = np.zeros(len(window), dtype=bool)
    earliest, own = index.suffixes[low[found]], window[found]
    segment = np.repeat(np.arange(len(n)), size)
    d, p = doc[segment], start[segment] + place
    out[found] = (d[earliest] < d[own]) | (d[earliest] == d[own]) & (p[earliest] < p[own])
    return out


def segment_symbols(texts: list[bytes], n: np.ndarray) -> np.ndarray:
    """The numbers of the BLOCK-word runs of segments of n windows, one segment after another, from 1."""
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    begin, stop, _, h = word_table(data, np.cumsum([len(t) for t in texts]))
    runs = exact_runs(exact_numbers(data, begin, stop, h), BLOCK)
    words = n + SIZE - 1
    return runs[ranges(np.cumsum(words) - words, words - BLOCK + 1)] + 1


def packed(key: np.ndarray, keys: int) -> Iterator[tuple[int, np.ndarray]]:
    """(key, places) of each key that occurs, places in order."""
    order = np.argsort(key, kind="stable")
    ends = np.cumsum(np.bincount(key, minlength=keys))
    for k in np.unique(key):
        yield int(k), order[(ends[k - 1] if k else 0) : ends[k]]


def spread(h: np.ndarray, n: int) -> np.ndarray:
    return (mix(h) % np.uint64(n)).astype(np.int64)


def substring_dedup(docs: DataFrame, text: str = "text", kept_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and intervals (start and length in words of each run of removed words) of every row of docs.

    kept_text: all columns of docs before these, the text being the kept words joined by blanks where words went,
    and as it was elsewhere.
    """
    chunks, buckets = pieces(docs, 4), pieces(docs)
    carried = [c for c in docs.columns if c not in ("doc_id", text)] if kept_text else []
    at = docs.select("doc_id", F.col(text).alias("text"), *(F.col(c).alias(f"x{k}") for k, c in enumerate(carried)), F.xxhash64(text).alias("v")).withColumn("c", F.pmod(F.xxhash64("doc_id", "v"), F.lit(chunks)).cast("int"))

    def minimisers(key: tuple, table: pa.Table) -> pa.Table:
        parts = chunk_segments(one_array(table.column("text")))
        found, counts = np.unique(np.concatenate([p.minimum for p in parts]), return_counts=True) if parts else (np.zeros(0, np.uint64), np.zeros(0, int))
        counts = np.where(np.isin(found, np.concatenate([p.minimum[p.inner] for p in parts])), 2, counts) if parts else counts
        rows = [(b, key[0].as_py(), found[i].tobytes(), (counts[i] > 1).tobytes()) for b, i in packed(spread(found, buckets), buckets)]
        return pa.table([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int32(), pa.int32(), pa.binary(), pa.binary()))], ["b", "c", "found", "twice"])

    def again(table: pa.Table) -> pa.Table:
        all_ = np.frombuffer(b"".join(table.column("found").to_pylist()), dtype=np.uint64)
        twice = np.frombuffer(b"".join(table.column("twice").to_pylist()), dtype=bool)
        _, number, counts = np.unique(all_, return_inverse=True, return_counts=True)
        counts += np.bincount(number[twice], minlength=len(counts))
        repeated, out, a = counts[number] > 1, [], 0
        for c, found in zip(table.column("c").to_pylist(), table.column("found").to_pylist()):
            b = a + len(found) // 8
            out.append((c, all_[a:b][repeated[a:b]].tobytes()))
            a = b
        return pa.table([pa.array([c for c, _ in out], pa.int32()), pa.array([x for _, x in out], pa.binary())], ["c", "found"])

    def send(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["shard", "c", "minimum", "doc", "variant", "start", "n", "words"]
        kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 5, pa.list_(pa.binary())]
        repeated = np.sort(np.frombuffer(b"".join(right.column("found").to_pylist()), dtype=np.uint64))
        if not len(repeated) or not left.num_rows:
            return pa.table([pa.array([], k) for k in kinds], names)
        _, ids, variant, texts = ordered(left)
        parts = chunk_segments(texts)
        minimum, row, start, n = (np.concatenate([getattr(p, name) for p in parts]) for name in ("minimum", "row", "start", "n"))
        i = np.minimum(np.searchsorted(repeated, minimum), len(repeated) - 1)
        which = np.flatnonzero(repeated[i] == minimum)
        words = chosen_texts(parts, repeated[i] == minimum)
        first = np.array([own == k for k, own in enumerate(models(words, ids[row[which]].tolist(), start[which].tolist()))], dtype=bool)
        rows, order = [], np.flatnonzero(first)
        for shard, k in packed(spread(minimum[which[order]], buckets), buckets):
            w = which[order[k]]
            rows.append((shard, key[0].as_py(), minimum[w].tobytes(), ids[row[w]].tobytes(), variant[row[w]].tobytes(), start[w].astype(np.int32).tobytes(), n[w].astype(np.int32).tobytes(), [words[j] for j in order[k].tolist()]))
        return pa.table([pa.array([r[j] for r in rows], kind) for j, kind in enumerate(kinds)], names)

    def search(table: pa.Table) -> pa.Table:
        c = np.repeat(table.column("c").to_numpy(), [len(x) // 8 for x in table.column("minimum").to_pylist()])
        get = lambda name, kind: np.frombuffer(b"".join(table.column(name).to_pylist()), dtype=kind)
        minimum, doc, variant, start, n = get("minimum", np.uint64), get("doc", np.int64), get("variant", np.int64), get("start", np.int32).astype(np.int64), get("n", np.int32).astype(np.int64)
        words = one_array(table.column("words")).flatten()
        many = int(-(-(n + SIZE - BLOCK).sum() // PART))
        part = (mix(minimum ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(max(1, many))).astype(np.int64)
        found = []
        for p in range(many):
            k = np.flatnonzero(part == p)
            k = k[np.lexsort((start[k], doc[k]))]
            if not len(k):
                continue
            gone = repeated_windows(segment_symbols(words.take(pa.array(k)).to_pylist(), n[k]), n[k], doc[k], start[k])
            # Runs of repeated windows inside a segment.
            segment, place = np.repeat(np.arange(len(k)), n[k]), ranges(np.zeros(len(k), np.int64), n[k])
            before = np.append(False, gone[:-1]) & (place > 0)
            opens = np.flatnonzero(gone & ~before)
            after = np.append(gone[1:], False) & (place < n[k][segment] - 1)
            closes = np.flatnonzero(gone & ~after)
            s = k[segment[opens]]
            found.append((c[s], doc[s], variant[s], start[s] + place[opens], closes - opens + 1))
        rows = []
        if found:
            cs, ds, vs, ps, ns = (np.concatenate([f[j] for f in found]) for j in range(5))
            for chunk, i in packed(cs, int(cs.max(initial=0)) + 1):
                rows.append((chunk, ds[i].tobytes(), vs[i].tobytes(), ps[i].astype(np.int32).tobytes(), ns[i].astype(np.int32).tobytes()))
        return pa.table([pa.array([r[j] for r in rows], pa.binary() if j else pa.int32()) for j in range(5)], ["c", "doc", "variant", "start", "n"])

    def drop(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        order, ids, variant, texts = ordered(left) if left.num_rows else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), pa.array([], pa.string()))
        parts = chunk_segments(texts)
        words = np.concatenate([p.words for p in parts]) if parts else np.zeros(0, np.int64)
        first = np.cumsum(words) - words
        change = np.zeros(int(words.sum()) + 1, dtype=np.int64)

        def mark(row: np.ndarray, start: np.ndarray, length: np.ndarray) -> None:
            np.add.at(change, first[row] + start, 1)
            np.add.at(change, first[row] + start + length, -1)

        doc, which, at_, many = (np.frombuffer(b"".join(right.column(name).to_pylist()), dtype=kind).astype(np.int64) for name, kind in (("doc", np.int64), ("variant", np.int64), ("start", np.int32), ("n", np.int32)))
        edge = np.flatnonzero(np.concatenate([[True], (ids[1:] != ids[:-1]) | (variant[1:] != variant[:-1]), [True]])) if len(ids) else np.zeros(1, np.int64)
        place_of = dict(zip(zip(ids[edge[:-1]].tolist(), variant[edge[:-1]].tolist()), range(len(edge) - 1)))
        at_row = np.array([place_of[k] for k in zip(doc.tolist(), which.tolist())], dtype=np.int64)
        low, high = edge[at_row], edge[at_row + 1] if len(at_row) else at_row  # equal rows
        own, equal = np.repeat(np.arange(len(doc)), high - low), ranges(low, high - low)
        mark(equal, at_[own], many[own] + SIZE - 1)
        if parts and len(doc):
            # What was found in the first two of equal segments holds for the others.
            minimum, row, start, n = (np.concatenate([getattr(p, name) for p in parts]) for name in ("minimum", "row", "start", "n"))
            _, number, counts = np.unique(minimum, return_inverse=True, return_counts=True)
            several = np.flatnonzero(counts[number] > 1)
            model = several[models(chosen_texts(parts, counts[number] > 1), ids[row[several]].tolist(), start[several].tolist())]
            copy, model = several[model != several], model[model != several]
            begin = first[low] + at_  # where intervals begin among the chunk's words
            by = np.argsort(begin, kind="stable")
            top = first[row[model]] + start[model]
            a = np.searchsorted(begin[by], top, side="left")
            b = np.searchsorted(begin[by], top + n[model], side="left")
            pick, of = by[ranges(a, b - a)], np.repeat(np.arange(len(copy)), b - a)
            mark(row[copy][of], start[copy][of] + begin[pick] - top[of], many[pick] + SIZE - 1)
        gone = np.cumsum(change)[:-1] > 0
        total = np.concatenate([np.zeros(1, np.int64), np.cumsum(gone)])
        removed = total[first + words] - total[first]
        sums, kept, spans = [], [], []
        for i, t in enumerate(texts):
            raw, runs = (t.as_py() or "").encode().split(), []
            if removed[i]:
                away = np.concatenate([[False], gone[first[i] : first[i] + words[i]], [False]])
                edges = np.flatnonzero(away[1:] != away[:-1]).tolist()
                runs = [{"start": a, "length": b - a} for a, b in zip(edges[::2], edges[1::2])]
                raw = [raw[k] for k in np.flatnonzero(~away[1:-1])]
            spans.append(runs)
            raw = b" ".join(raw)
            sums.append(hashlib.sha256(raw).hexdigest())
            if kept_text:
                kept.append(raw.decode() if removed[i] else t.as_py())
        out = {"doc_id": pa.array([None if d == NULL_ID else d for d in ids.tolist()], pa.int64())}
        if kept_text:
            out["text"] = pa.array(kept, pa.string())
            out |= {f"x{k}": one_array(left.column(f"x{k}")).take(pa.array(order, pa.int64())) for k in range(len(carried))} if left.num_rows else {f"x{k}": pa.array([], left.schema.field(f"x{k}").type) for k in range(len(carried))}
        return pa.table(out | {"n_words": pa.array(words, pa.int64()), "n_removed": pa.array(removed, pa.int64()), "kept_sha256": pa.array(sums, pa.string()), "intervals": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())])))})

    repeated = at.groupBy("c").applyInArrow(minimisers, "b int, c int, found binary, twice binary").groupBy("b").applyInArrow(again, "c int, found binary")
    sent = at.groupBy("c").cogroup(repeated.groupBy("c")).applyInArrow(send, "shard int, c int, minimum binary, doc binary, variant binary, start binary, n binary, words array<binary>")
    found = sent.groupBy("shard").applyInArrow(search, "c int, doc binary, variant binary, start binary, n binary")
    base = "doc_id long, " + ("text string, " + "".join(f"x{k} {docs.schema[c].dataType.simpleString()}, " for k, c in enumerate(carried)) if kept_text else "")
    out = at.groupBy("c").cogroup(found.groupBy("c")).applyInArrow(drop, base + "n_words long, n_removed long, kept_sha256 string, intervals array<struct<start:long,length:long>>")
    if not kept_text:
        return out
    back = {"doc_id": "doc_id", text: "text"} | {c: f"x{k}" for k, c in enumerate(carried)}
    return out.select(*(F.col(back[c]).alias(c) for c in docs.columns), "n_words", "n_removed", "kept_sha256", "intervals")


ORACLE = r"""
with d as (select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents),
win as (select doc_id, i, md5(array_to_string(w[i:i + 19], ' ')) as win from (select doc_id, w, unnest(range(1, len(w) - 18)) as i from d where len(w) >= 20)),
gone as (select doc_id, i from (select doc_id, i, row_number() over (partition by win order by doc_id, i) as k from win) where k > 1),
p as (select doc_id, list(distinct p) as p from (select doc_id, unnest(range(i, i + 20)) as p from gone) group by doc_id),
r as (select doc_id, count(*) as n from (select doc_id, p, lag(p) over (partition by doc_id order by p) as before from (select doc_id, unnest(p) as p from p)) where before is null or before < p - 1 group by doc_id),
k as (select d.doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(len(p), 0) as bigint) as n_removed, cast(coalesce(r.n, 0) as bigint) as n_intervals, w, coalesce(p, []) as p from d left join p using (doc_id) left join r using (doc_id))
select doc_id, n_words, n_removed, n_intervals, sha256(array_to_string(list_filter(w, lambda x, i: not list_contains(p, i)), ' ')) as kept_sha256 from k
"""
