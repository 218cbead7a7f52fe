"""Sets of hashed word shingles of whole texts."""

from __future__ import annotations

import numpy as np

WORDS = 5

_MIX = np.uint64(0xD6E8FEB86659FD93)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
#: A-Z in lower case; each byte then stands for a random number.
_FOLDED = np.arange(256)
_FOLDED[ord("A") : ord("Z") + 1] += 32
_BYTES = np.random.default_rng(20_240_501).integers(0, 2**64, 256, np.uint64)[_FOLDED]


def mixed(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(32))) * _MIX
        h = (h ^ (h >> np.uint64(29))) * _BASE
        return h ^ (h >> np.uint64(32))


#: Bytes that are hashed at once: arrays of a number for each of them stay in the processor's cache.
RUN_BYTES = 1 << 18
_POWERS = np.full((2, RUN_BYTES), [[pow(int(_BASE), -1, 1 << 64)], [int(_BASE)]], np.uint64)
_POWERS[:, 0] = 1
_POWERS = np.cumprod(_POWERS, axis=1)


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word, in order, and where it starts; words are runs of bytes other than blanks."""
    blank = np.ones(len(data) + 2, bool)
    np.take(_BLANK, data, out=blank[1:-1])
    edges = np.flatnonzero(blank[1:] != blank[:-1])
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64), starts
    # Horner's rule over all words at once: sums of each letter times a power that falls along a run of bytes.
    h = np.zeros(len(starts), np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, len(data), RUN_BYTES):
            run = _BYTES[data[at : at + RUN_BYTES]]
            sums = np.zeros(len(run) + 1, np.uint64)
            np.cumsum(run * _POWERS[0, : len(run)], out=sums[1:])
            some = slice(np.searchsorted(ends, at, "right"), np.searchsorted(starts, at + len(run)))
            low, high = np.maximum(starts[some] - at, 0), np.minimum(ends[some] - at, len(run))
            # What an earlier run holds of a word goes before what this one does.
            before = h[some] * _POWERS[1, np.minimum(high - low, RUN_BYTES - 1)]
            if some.start < some.stop and high[0] - low[0] == RUN_BYTES:
                before[0] *= _BASE
            h[some] = before + (sums[high] - sums[low]) * _POWERS[1, high - 1]
        return mixed(h + (ends - starts).astype(np.uint64) * _MIX), starts


def shingles(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each run of WORDS words of each text, in order, and how many each text has.

    A text with fewer words has its whole sequence as one; a text without words has none.
    """
    data = np.frombuffer(b"\n".join(texts), np.uint8)
    words, starts = word_hashes(data)
    stops = np.cumsum([len(x) + 1 for x in texts])
    last = np.searchsorted(starts, stops)  # of each text's words, one past the last
    count = np.diff(last, prepend=0)
    size = np.where(count >= WORDS, count - WORDS + 1, (count > 0).astype(count.dtype))
    with np.errstate(over="ignore"):
        run = words.copy()
        for i in range(1, min(WORDS, len(words))):
            run[: len(words) - i] = run[: len(words) - i] * _BASE + words[i:]
        run = mixed(run + np.uint64(WORDS))
        own = np.repeat(np.arange(len(texts)), count)
        place = np.arange(len(words)) - np.repeat(last - count, count)
        out = run[place < size[own]] if len(words) else run
        short = np.flatnonzero((count > 0) & (count < WORDS))
        at = np.cumsum(size) - size
        for t in short:
            h = np.uint64(0)
            for w in words[last[t] - count[t] : last[t]]:
                h = h * _BASE + w
            out[at[t]] = mixed(np.array([h + np.uint64(count[t])]))[0]
    return out, size


def distinct(values: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's values in ascending order, without repeats, and how many are left. Sorts in place."""
    stops = np.cumsum(size)
    for a, b in zip(stops - size, stops, strict=True):
        values[a:b].sort()
    own = np.repeat(np.arange(len(size)), size)
    first = np.ones(len(values), bool)
    first[1:] = (values[1:] != values[:-1]) | (own[1:] != own[:-1])
    return values[first], np.bincount(own[first], minlength=len(size))
