"""Words of a text, shared by the operators that run over document texts inside tasks.

A word is a run of characters other than space and \\t \\n \\v \\f \\r.  Python's own ``split`` also
cuts at other white space, so it is used only on texts that hold none of it.
"""

from __future__ import annotations

import re

import numpy as np

WORD_PATTERN = r"[^\x20\x09-\x0D]+"
WORD = re.compile(WORD_PATTERN)
_OTHER_SPACE = re.compile("[\x1c-\x1f\x85\xa0  -     　]")

MIX = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[str]:
    """The words of a text, none for a null."""
    if not text:
        return []
    return WORD.findall(text) if _OTHER_SPACE.search(text) else text.split()


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers (the splitmix finaliser)."""
    with np.errstate(over="ignore"):
        v = values + MIX
        v = (v ^ (v >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        v = (v ^ (v >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return v ^ (v >> np.uint64(31))


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
#: random numbers of the bytes, and of the length of a word
_CODES = mixed(np.arange(256, dtype=np.uint64))
_LOWER_CODES = _CODES[_LOWER]
_LENGTH = np.uint64(0xD6E8FEB86659FD93)
_BASE = 0x9E3779B97F4A7C15
_powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers, at least, of the base and of its inverse modulo 2^64."""
    global _powers
    if len(_powers[0]) < n:
        with np.errstate(over="ignore"):
            _powers = tuple(np.concatenate([[np.uint64(1)], np.cumprod(np.full(2 * n, b, np.uint64))]) for b in (_BASE, pow(_BASE, -1, 1 << 64)))
    return _powers


def word_hashes(text: str | None, lower: bool = False) -> np.ndarray:
    """A 64-bit hash of each word, in order; ``lower`` folds A-Z first.

    White space is ASCII, so the bytes of a word are what lies between spaces.  A word's hash is a polynomial in
    random numbers of its bytes, from running sums over the whole text.
    """
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    return hashes_of_words(raw, np.array([0, len(raw)]), lower)[0]


def hashes_of_words(raw: np.ndarray, edges: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """``word_hashes`` of several texts at once, and where each text's words begin (one more than texts).

    Text i has the bytes ``raw[edges[i]:edges[i + 1]]``, and ``raw`` has no others.
    """
    inside = ~_SPACE[raw]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    between = edges[(edges > 0) & (edges < len(raw))]  # a word ends with its text
    first[between] = inside[between]
    last[between - 1] = inside[between - 1]
    begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    up, down = _powers_to(len(raw))
    with np.errstate(over="ignore"):
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum((_LOWER_CODES if lower else _CODES)[raw] * up[:len(raw)], out=sums[1:])
        hashes = mixed((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(np.uint64) * _LENGTH)
    return hashes, np.searchsorted(begin, edges)


def window_hashes(values: np.ndarray, width: int) -> np.ndarray:
    """One 64-bit hash for each run of ``width`` values, in order; empty when there are fewer."""
    n = len(values) - width + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    with np.errstate(over="ignore"):
        # doubling: hashes of runs of 1, 2, 4 ... are combined to the binary digits of the width
        run, length, out, done = mixed(values), 1, None, 0
        rest = width
        while rest:
            if rest & 1:
                part = run[done : done + n]
                out = part.copy() if out is None else mixed(out * np.uint64(0x100000001B3) + part)
                done += length
            rest >>= 1
            if rest:
                run = mixed(run[:-length] * np.uint64(0x100000001B3) + run[length:])
                length *= 2
        return out
