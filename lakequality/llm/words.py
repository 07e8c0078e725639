"""Words of whole texts as NumPy arrays: positions and 64-bit hashes, without a Python loop per word.

A text is its UTF-8 bytes. Hashes are a polynomial in an odd base, modulo 2**64, mixed at the end;
they depend on the bytes of a word alone and are the same on every executor.
"""

from __future__ import annotations

import numpy as np

BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}

# The words of lower-cased text are runs of letters, digits and anything outside ASCII.
ALNUM = np.array([48 <= b <= 57 or 97 <= b <= 122 or b >= 128 for b in range(256)])
# Other words are runs of anything but blanks.
SOLID = np.array([not (b == 32 or 9 <= b <= 13) for b in range(256)])


def powers(base: int, n: int) -> np.ndarray:
    """base**0 ... base**(n-1) modulo 2**64; kept, and doubled when a longer text comes."""
    held = _powers.get(base)
    if held is None or len(held) < n:
        size = 1 << max(16, (n - 1).bit_length())
        held = np.full(size, base, dtype=np.uint64)
        held[0] = 1
        held = np.multiply.accumulate(held)
        _powers[base] = held
    return held[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over the whole number (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def as_bytes(text: str | bytes | None, lower: bool = False) -> np.ndarray:
    """UTF-8 bytes of a text, null as empty; `lower` changes A-Z only."""
    raw = b"" if text is None else text.encode("utf-8") if isinstance(text, str) else text
    return np.frombuffer(raw.lower() if lower else raw, dtype=np.uint8)


def spans(data: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of every run of bytes that `inside` marks."""
    flags = np.zeros(len(data) + 2, dtype=np.int8)
    flags[1:-1] = inside[data]
    edges = np.flatnonzero(np.diff(flags))
    return edges[0::2], edges[1::2]


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One hash for each span."""
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(BASE, len(data)), out=sums[1:])
    return mix((sums[ends] - sums[starts]) * powers(INVERSE, len(data))[starts])


def windows(words: np.ndarray, n: int) -> np.ndarray:
    """One hash for every `n` consecutive words."""
    count = len(words) - n + 1
    if count <= 0:
        return np.zeros(0, dtype=np.uint64)
    if n == 1:
        return words
    sums = np.zeros(len(words) + 1, dtype=np.uint64)
    np.cumsum(words * powers(BASE, len(words)), out=sums[1:])
    return mix((sums[n:] - sums[:count]) * powers(INVERSE, count))


def repeated(values: np.ndarray) -> np.ndarray:
    """Which values occur more than once."""
    order = np.argsort(values)
    ranked = values[order]
    same = ranked[1:] == ranked[:-1]
    out = np.zeros(len(values), dtype=bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def texts(column) -> list[bytes | None]:
    """The values of an Arrow text column as UTF-8 bytes."""
    import pyarrow as pa

    return column.cast(pa.large_binary()).to_pylist()
