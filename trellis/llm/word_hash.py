"""Words and word shingles of many texts at once, as 64-bit hashes in numpy.

A word is a run of bytes other than ASCII white space, with A-Z lower-cased.  Its hash is a
polynomial over fixed random values of its bytes, taken from running sums over the whole
buffer, and then mixed.  Two different words (or shingles) share a hash with a chance of
about 2^-64.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

_RNG = np.random.Generator(np.random.PCG64(20260101))
_ODD = np.uint64(1)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + _ODD
_BYTE[65:91] = _BYTE[97:123]                      # A-Z as a-z
_STEP = int(_RNG.integers(1, 2**60)) * 8 + 5      # odd, so it has an inverse
_BACK = pow(_STEP, -1, 2**64)
_PLACE = _RNG.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + _ODD
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_POWERS: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _powers(base: int, n: int) -> np.ndarray:
    """1, base, base^2, ... modulo 2^64; doubled in place of a loop."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        have = np.ones(size, np.uint64)
        step, filled = base, 1
        while filled < size:
            have[filled:2 * filled] = have[:filled] * np.uint64(step)
            step, filled = step * step % 2**64, 2 * filled
        if size <= 1 << 21:                        # more are made anew for a very long text
            _POWERS[base] = have
    return have[:n]


def word_hashes(texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word in order, start of each text in it: one more than texts)."""
    buf = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    space = _SPACE[buf]
    edge = np.diff(space.astype(np.int8), prepend=1)
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if space[0]:                                   # a leading space is no end of a word
        ends = ends[ends > 0]
    sums = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_BYTE[buf] * _powers(_STEP, len(buf)), out=sums[1:])
    h = mix((sums[ends] - sums[starts]) * _powers(_BACK, len(buf))[starts])
    bounds = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=bounds[1:])
    return h, np.searchsorted(starts, bounds)


def shingle_hashes(h: np.ndarray, bounds: np.ndarray, k: int = 5, short_whole: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every k-word shingle in order, start of each text in it).

    A text of fewer words than ``k`` is one shingle (of its own length) if ``short_whole``,
    else none; a text without words has none."""
    n = np.diff(bounds)
    sums = np.zeros(max(len(h) - k + 1, 0), np.uint64)
    for j in range(k if len(sums) else 0):
        sums += h[j:len(h) - k + 1 + j] * _PLACE[j]
    full = np.maximum(n - k + 1, 0)
    first = np.repeat(bounds[:-1], full) if len(sums) else np.zeros(0, np.int64)
    at = first + np.arange(len(first)) - np.repeat(np.cumsum(full) - full, full)
    out = mix(sums[at] + np.uint64(k)) if len(sums) else np.zeros(0, np.uint64)
    if not short_whole:
        return out, np.concatenate([[0], np.cumsum(full)]).astype(np.int64)
    short = np.flatnonzero((n > 0) & (n < k))
    if len(short):
        start = np.cumsum(full) - full
        whole = [mix(np.array([(h[bounds[i]:bounds[i + 1]] * _PLACE[:n[i]]).sum(dtype=np.uint64)], np.uint64)
                     + np.uint64(n[i]))[0] for i in short]
        out = np.insert(out, start[short], np.array(whole, np.uint64))
        full = full.copy()
        full[short] = 1
    return out, np.concatenate([[0], np.cumsum(full)]).astype(np.int64)


def distinct_by_text(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct values of each text, one text after the other, and their starts."""
    values = values.copy()
    for lo, hi in zip(bounds[:-1], bounds[1:]):
        values[lo:hi].sort()
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    new[bounds[:-1][np.diff(bounds) > 0]] = True
    kept = np.zeros(len(values) + 1, np.int64)
    np.cumsum(new, out=kept[1:])
    return values[new], kept[bounds]


def chunks(texts: Sequence[str | None], most: int = 2_000_000) -> Iterator[tuple[int, list[bytes]]]:
    """Texts as bytes, in runs of about ``most`` bytes (a longer text is a run of its own):
    (place of the first, the run).  Null counts as empty."""
    run: list[bytes] = []
    size = first = 0
    for i, t in enumerate(texts):
        b = (t or "").encode("utf-8", "surrogatepass")
        if run and size + len(b) > most:
            yield first, run
            run, size, first = [], 0, i
        run.append(b)
        size += len(b)
    if run:
        yield first, run
