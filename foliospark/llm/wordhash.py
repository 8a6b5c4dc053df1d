"""Words of many texts at once, as numpy arrays: places, owners and 64-bit hashes, without a Python loop over words.

A word's hash is a sum over its bytes, each mixed with its place in the word; a run's hash mixes its words
one after another. Mixing isn't linear, so there are no families of texts that hash alike, as a polynomial
modulo a power of two has them. `exact_numbers` turns hashes into numbers that are equal only for equal bytes.
"""

from __future__ import annotations

import numpy as np

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_SEED = np.uint64(0x9E3779B97F4A7C15)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


#: What a byte stands for at each of a word's first places; beyond, it is mixed when it is met.
_NEAR = mix(np.arange(64 * 256, dtype=np.uint64) + _SEED)


def ranges(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """begin[0], begin[0] + 1, ... (size[0] numbers), then the same from begin[1] on."""
    return np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(begin, size)


def span_hashes(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """A hash of each span of data; spans ascend and don't overlap."""
    size = stop - start
    place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    byte = data[place + np.repeat(start, size)]
    key = place << 8 | byte
    value = _NEAR[np.minimum(key, len(_NEAR) - 1)]
    far = np.flatnonzero(place >= 64)
    value[far] = mix(key[far].astype(np.uint64) + _SEED)
    sums = np.zeros(len(value) + 1, dtype=np.uint64)
    np.cumsum(value, out=sums[1:])
    end = np.cumsum(size)
    return mix(sums[end] - sums[end - size] + size.astype(np.uint64))


def word_table(data: np.ndarray, ends: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, stop, text, hash) of each word of [^\\x20\\x09-\\x0D]+; data holds the texts' bytes, ends where each text ends.

    lower: hash A-Z as a-z.
    """
    n = len(data)
    if not n:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none, np.zeros(0, dtype=np.uint64)
    if lower:
        data = lower_case(data)
    word = ~_SPACE[data]
    first = np.zeros(n + 1, dtype=bool)
    first[0] = True
    first[ends] = True  # a text's first byte, and the end
    begins = word.copy()
    begins[1:] &= ~word[:-1] | first[1:n]
    closes = word.copy()
    closes[:-1] &= ~word[1:] | first[1:n]
    start, stop = np.flatnonzero(begins), np.flatnonzero(closes) + 1
    return start, stop, np.searchsorted(ends, start, side="right"), span_hashes(data, start, stop)


def lower_case(data: np.ndarray) -> np.ndarray:
    """A-Z as a-z."""
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def window_hashes(h: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of `size` neighbouring word hashes; one for each of the first len(h) - size + 1 places."""
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = mix(h[:n] + _SEED)
    for k in range(1, size):
        out = mix(out + h[k : k + n])
    return out


def exact_numbers(data: np.ndarray, start: np.ndarray, stop: np.ndarray, h: np.ndarray) -> np.ndarray:
    """A number of each span of data, equal for equal bytes alone: spans with one hash are compared with the first of them."""
    _, first, number = np.unique(h, return_index=True, return_inverse=True)
    model, size = first[number], stop - start
    same = size == size[model]
    check = np.flatnonzero(same & (model != np.arange(len(h))))
    equal = data[ranges(start[check], size[check])] == data[ranges(start[model[check]], size[check])]
    wrong = np.add.reduceat(~equal, np.cumsum(size[check]) - size[check]) > 0 if len(check) else np.zeros(0, bool)
    if same.all() and not wrong.any():
        return number
    seen: dict[bytes, int] = {}
    raw = data.tobytes()
    return np.array([seen.setdefault(raw[a:b], len(seen)) for a, b in zip(start.tolist(), stop.tolist())], dtype=np.int64)


def exact_runs(number: np.ndarray, size: int) -> np.ndarray:
    """A number of each run of `size` neighbouring numbers, equal for equal runs alone; one for each of the first len - size + 1 places."""
    h = window_hashes(number.astype(np.uint64), size)
    if not len(h):
        return np.zeros(0, dtype=np.int64)
    _, first, out = np.unique(h, return_index=True, return_inverse=True)
    model, n = first[out], len(h)
    if all(np.array_equal(number[k : k + n], number[model + k]) for k in range(size)):
        return out
    out = number[:n].astype(np.int64)
    for k in range(1, size):  # pairs of whole numbers, numbered anew
        out = np.unique(out * (int(number.max()) + 1) + number[k : k + n], return_inverse=True)[1]
    return out
