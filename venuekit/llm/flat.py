"""Many texts as one array of code points, so that numpy handles all their words at once."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import cache

import numpy as np

#: Code points that are worked on at once; a longer text is a piece of its own.
CHARS = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so that it has an inverse modulo 2**64
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


@cache
def letters() -> np.ndarray:
    """True for each code point that is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


@cache
def alphanumerics() -> np.ndarray:
    return np.fromiter((chr(c).isalnum() for c in range(0x110000)), bool, 0x110000)


def pieces(texts: Sequence[str], chars: int = CHARS) -> Iterator[slice]:
    """Cut a list of texts into runs of about ``chars`` code points."""
    start = size = 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= chars:
            yield slice(start, i + 1)
            start, size = i + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))


def code_points(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """All texts with a line feed after each, and where each begins (one entry more than texts)."""
    flat = np.frombuffer("".join(f"{t}\n" for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=starts[1:])
    return flat, starts


def runs(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True; the last entry must be False."""
    edge = np.flatnonzero(np.diff(inside.view(np.int8), prepend=np.int8(0)))
    return edge[::2], edge[1::2]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


@cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        up = np.cumprod(np.full(n, _BASE))
        down = np.cumprod(np.full(n, _INVERSE))
    return up, down


def run_hashes(flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run of code points, the same wherever the run stands."""
    size = 1 << max(20, int(len(flat) + 1).bit_length())
    up, down = _powers(size)
    total = np.zeros(len(flat) + 1, np.uint64)
    np.cumsum(mix(flat.astype(np.uint64) + np.uint64(1)) * up[: len(flat)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts])
