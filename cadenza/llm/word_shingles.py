"""Word shingles of texts as sorted arrays of distinct 64-bit hashes."""

from __future__ import annotations

import numpy as np

from cadenza.llm.common import mix64, text_slices

WORDS = 5
SLICE_CHARS = 500_000
KEPT_POWERS = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_STEP = pow(_BASE, -1, 1 << 64)
_random = np.random.Generator(np.random.PCG64(7))
_BYTE = _random.integers(1, 1 << 63, 256, dtype=np.uint64)
_PLACE = _random.integers(1, 1 << 63, WORDS, dtype=np.uint64) | np.uint64(1)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_powers: list[np.ndarray] = []


def _made(size: int) -> list[np.ndarray]:
    made = []
    for base in (_BASE, _STEP):
        table = np.full(size, base, dtype=np.uint64)
        table[0] = 1
        made.append(np.cumprod(table, dtype=np.uint64))
    return made


def _power_tables(size: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2 ** 64, at least ``size``.

    The first ``KEPT_POWERS`` stay in the worker; longer tables, for a very long
    text, last for one call.
    """
    if size > KEPT_POWERS:
        return _made(size)
    if not _powers:
        _powers.extend(_made(KEPT_POWERS))
    return _powers


def hash_runs(data: np.ndarray, first: np.ndarray, ends) -> list[np.ndarray]:
    """64-bit hashes of the bytes from each ``first`` up to each of ``ends``."""
    power, inverse = _power_tables(len(data) + 1)
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[data] * power[:len(data)], out=total[1:])
    return [mix64((total[last] - total[first]) * inverse[first]) for last in ends]


def _words(raws) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of all texts, and each text's first word (n + 1 bounds)."""
    data = np.frombuffer(b"\n".join(raws) + b"\n", dtype=np.uint8)
    ends = np.cumsum([len(r) + 1 for r in raws])
    space = _SPACE[data]
    before = np.concatenate([[True], space[:-1]])
    first = np.flatnonzero(~space & before)
    (value,) = hash_runs(data, first, [np.flatnonzero(space & ~before)])
    return value, np.concatenate([[0], np.searchsorted(first, ends)])


def shingle_sets(texts) -> list[np.ndarray]:
    """Distinct hashes of the shingles of each text (null: empty), ascending.

    A-Z are lower-cased, words end at space and 0x09-0x0D; a text of one to four
    words has its whole sequence as one shingle, one without words has none.
    Hashes stand for shingles: two different ones of a pair of texts agree with a
    probability of about 2 ** -64.
    """
    texts = [t or "" for t in texts]
    out: list[np.ndarray] = []
    for a, b in text_slices(texts, SLICE_CHARS):
        raws = [t.encode("utf-8", "surrogatepass").lower() for t in texts[a:b]]
        value, bounds = _words(raws)
        size = max(0, len(value) - WORDS + 1)
        runs = np.zeros(size, dtype=np.uint64)
        for k in range(WORDS):
            runs += value[k:k + size] * _PLACE[k]
        runs = mix64(runs)
        for i in range(b - a):
            start, end = bounds[i], bounds[i + 1]
            if end - start >= WORDS:
                out.append(np.unique(runs[start:end - WORDS + 1]))
            elif end > start:
                whole = (value[start:end] * _PLACE[:end - start]).sum(dtype=np.uint64)
                out.append(mix64(np.array([whole + np.uint64(end - start)])))
            else:
                out.append(np.zeros(0, dtype=np.uint64))
    return out
