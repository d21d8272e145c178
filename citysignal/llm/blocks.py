"""Words of Arrow text columns as arrays of hashes, without a Python loop over words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from citysignal.llm.common import byte_table

SLICE_BYTES = 1 << 20
# Fixed odd multipliers.
BASE = 0x9E3779B97F4A7C15
MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
_POWERS: dict[str, np.ndarray] = {}


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values: a bijection, so what differs stays different."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(MIX[0])
    h ^= h >> np.uint64(27)
    h *= np.uint64(MIX[1])
    return h ^ (h >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE to the powers 0..n-1 and their inverses, modulo 2**64."""
    if len(_POWERS.get("up", ())) < n:
        size = max(n, SLICE_BYTES + (1 << 17))
        for name, factor in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
            steps = np.full(size, factor, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def slices(texts, limit: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of rows with about ``limit`` bytes; nulls are empty."""
    import pyarrow as pa

    texts = texts.cast(pa.large_string())
    if not len(texts):
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    held = texts.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), len(texts))
        own = offsets[first : last + 1]
        yield first, data[own[0] : own[-1]], own - own[0]
        first = last


def _starts(data: np.ndarray, offsets: np.ndarray, words_are: str) -> tuple:
    """Lowered bytes, which are in words, which begin a row, and where words start."""
    n = len(data)
    lowered = np.frombuffer(byte_table(words_are), np.uint8)[data]
    inside = lowered != 0x20
    begins = np.zeros(n + 1, bool)
    begins[offsets] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | begins[1:n]
    return lowered, inside, begins, np.flatnonzero(starts)


def word_counts(data: np.ndarray, offsets: np.ndarray, words_are: str = "no spaces") -> np.ndarray:
    """How many words each row has."""
    if not len(data):
        return np.zeros(len(offsets) - 1, np.int64)
    return np.diff(np.searchsorted(_starts(data, offsets, words_are)[-1], offsets))


def hashed_words(data: np.ndarray, offsets: np.ndarray, words_are: str = "no spaces"):
    """Hashes of all words and how many each row has."""
    n, rows = len(data), len(offsets) - 1
    if not n:
        return np.zeros(0, np.uint64), np.zeros(rows, np.int64)
    lowered, inside, begins, at = _starts(data, offsets, words_are)
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | begins[1:n]
    stop = np.flatnonzero(ends) + 1
    up, down = _powers(n)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((lowered.astype(np.uint64) + np.uint64(1)) * up, out=total[1:])
    h = mixed((total[stop] - total[at]) * down[at] + (stop - at).astype(np.uint64))
    counts = np.diff(np.searchsorted(at, offsets))
    return h, counts


def shingle_sets(h: np.ndarray, counts: np.ndarray, n: int = 5):
    """Hashes and row numbers of each row's distinct n-word shingles, not sorted."""
    row = np.repeat(np.arange(len(counts)), counts)
    if len(h) >= n:
        total = np.zeros(len(h) - n + 1, np.uint64)
        for k in range(n):
            total = (total + h[k : len(h) - n + 1 + k]) * np.uint64(BASE)
        whole = row[: len(total)] == row[n - 1 :]
        made, owner = mixed(total[whole]), row[: len(total)][whole]
    else:
        made, owner = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    few = np.flatnonzero((counts > 0) & (counts < n))
    if len(few):
        start = np.cumsum(counts) - counts
        short = []
        for r in few:
            value = np.uint64(counts[r])
            with np.errstate(over="ignore"):
                for x in h[start[r] : start[r] + counts[r]]:
                    value = (value + x) * np.uint64(MIX[1])
            short.append(value)
        made = np.concatenate([made, mixed(np.array(short, np.uint64))])
        owner = np.concatenate([owner, few])
    return made, owner
