"""Word hashes of whole batches of texts, in numpy.

A batch is worked on as one array of UTF-8 bytes, so no Python code runs per word. A word is a run of bytes other than
space and 0x09 to 0x0D; A-Z are lower-cased first, if wanted. Its hash is the sum of a random 64-bit value per byte times a power
that falls with the position, finished by a mixer: equal words have equal hashes, different ones differ but for one
chance in 2**64 or so a pair.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from sievework.llm.workers import per_worker

MASK = (1 << 64) - 1
_POWER = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_POWER, -1, 1 << 64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def random_values(n: int, seed: int) -> np.ndarray:
    """n fixed 64-bit values for a seed."""
    start = np.uint64((seed * 0xD1342543DE82EF95 + 1) & MASK)
    return mixed(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_POWER) + start)


def _byte_values(fold: bool) -> np.ndarray:
    values = random_values(256, 1)
    values[[0x20, *range(0x09, 0x0E)]] = 0  # what separates words adds nothing
    if fold:
        upper = np.arange(ord("A"), ord("Z") + 1)
        values[upper] = values[upper + 32]
    return values


_VALUES = {fold: _byte_values(fold) for fold in (True, False)}
_CHUNK = 1 << 16  # bytes whose terms stay in a core's own cache


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[0] = 1
    done = 1
    while done < n:  # doubling
        step = min(done, n - done)
        out[done : done + step] = out[:step] * np.uint64(pow(base, done, 1 << 64))
        done += step
    return out


def _rising_and_falling() -> tuple[np.ndarray, np.ndarray]:
    return _powers(_POWER, _CHUNK), _powers(_INVERSE, _CHUNK)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts and each text's bounds in them; a null text is empty."""
    texts = texts.fill_null("") if texts.null_count else texts
    if not pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.large_string())
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if not len(texts) or texts.buffers()[2] is None:
        return np.empty(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[bounds[0] : bounds[-1]]
    return data, bounds - bounds[0]


def word_hashes(texts: pa.Array, fold: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words in order, and each text's bounds in them. Without ``fold`` A-Z differ from a-z."""
    data, bounds = text_bytes(texts)
    if not len(data):
        return np.empty(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    inside = data - np.uint8(0x09) > 0x0D - 0x09  # smaller bytes wrap round
    inside &= data != 0x20
    first = inside.copy()
    np.greater(inside[1:], inside[:-1], out=first[1:])
    edges = bounds[1:-1]
    edges = edges[edges < len(data)]
    first[edges] = inside[edges]  # a text's first byte starts a word, whatever ends the text before it
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.empty(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    sums = np.empty(len(starts), np.uint64)
    rising, falling = per_worker(("powers", _CHUNK), _rising_and_falling, shared=True)  # too large to travel with every task
    at = 0
    while at < len(starts):  # pieces of about _CHUNK bytes that end where words end
        to = max(at + 1, int(np.searchsorted(starts, starts[at] + _CHUNK, side="right")) - 1)
        if to < len(starts) and starts[to] - starts[at] > _CHUNK:
            to = at + 1
        if to >= len(starts) - 1 and len(data) - starts[at] <= _CHUNK:
            to = len(starts)
        low, high = int(starts[at]), int(starts[to]) if to < len(starts) else len(data)
        up, down = (rising, falling) if high - low <= _CHUNK else (_powers(_POWER, high - low), _powers(_INVERSE, high - low))
        terms = _VALUES[fold].take(data[low:high])
        terms *= up[: high - low]
        np.cumsum(terms, out=terms)
        own = starts[at:to] - low
        until = terms[np.append(own[1:], high - low) - 1]  # a word's last separator, up to the next word
        sums[at:to] = np.diff(until, prepend=np.uint64(0)) * down[own]
        at = to
    return mixed(sums), np.searchsorted(starts, bounds)


def ngram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """The hash of each run of n words of one sequence; runs that cross texts are the caller's to drop."""
    if len(words) < n:
        return np.empty(0, np.uint64)
    out = words[: len(words) - n + 1].copy()
    for k in range(1, n):
        out = mixed(out * np.uint64(_POWER) + words[k : len(words) - n + 1 + k])
    return out


def shingle_sets(words: np.ndarray, bounds: np.ndarray, n: int) -> list[np.ndarray]:
    """Per text its distinct n-word shingle hashes, sorted; with fewer words the whole sequence is one shingle."""
    runs = ngram_hashes(words, n)
    out = []
    for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if high - low >= n:
            own = np.sort(runs[low : high - n + 1])
            out.append(own[np.concatenate(([True], own[1:] != own[:-1]))])
        elif high > low:
            out.append(mixed(ngram_hashes(words[low:high], high - low) + np.uint64(high - low)))
        else:
            out.append(np.empty(0, np.uint64))
    return out
