"""Suffix sorting by external induction, with common-prefix lengths.

The text is a concatenation of strings, each ended by a zero byte. Suffixes that start a rising run
(S*) are sorted by their first bytes; they induce the falling suffixes (L) in one ascending pass, and
those induce the rising ones (S) in one descending pass. Both passes move tuples (place, common
prefix) through a priority queue: the key is the first byte, tuples of one key leave in the order
they came, and tuples beyond a memory bound wait on disk. The common prefix of two neighbours in a
bucket is one more than the least of those between the suffixes that induced them.

Prefixes are compared to `cap` bytes; suffixes that agree on that many may come in any order.
Scratch files are private to the task that calls this, like those of a sort that spills, and go when
it ends.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator

import numpy as np

CHUNK = 1 << 16
FAR = 255  # a common prefix that no minimum keeps


def _merged(parts: list) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The same tuples in fewer, larger arrays."""
    waiting, size = [], 0
    for part in parts:
        waiting.append(part)
        size += len(part[0])
        if size >= CHUNK:
            yield np.concatenate([p for p, _ in waiting]), np.concatenate([l for _, l in waiting])
            waiting, size = [], 0
    if waiting:
        yield np.concatenate([p for p, _ in waiting]), np.concatenate([l for _, l in waiting])


class BucketQueue:
    """A priority queue of (place, prefix) tuples with 256 keys, first come first out in each."""

    def __init__(self, folder: str, hold: int):
        self.folder, self.hold, self.held = folder, hold, 0
        self.memory: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        self.files: dict[int, list[int]] = {}

    def push(self, key: int, places: np.ndarray, prefixes: np.ndarray) -> None:
        self.memory.setdefault(key, []).append((places, prefixes))
        self.held += len(places)
        if self.held > self.hold:
            self._spill()

    def _path(self, key: int, what: str) -> str:
        return os.path.join(self.folder, f"{what}{key}")

    def _spill(self) -> None:
        for key, parts in self.memory.items():
            for places, prefixes in _merged(parts):
                for at in range(0, len(places), CHUNK):
                    with open(self._path(key, "p"), "ab") as p, open(self._path(key, "l"), "ab") as q:
                        p.write(places[at : at + CHUNK].tobytes())
                        q.write(prefixes[at : at + CHUNK].tobytes())
                    self.files.setdefault(key, []).append(len(places[at : at + CHUNK]))
        self.memory, self.held = {}, 0

    def _stored(self, sizes: list[int], paths: tuple[str, str], backwards: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        ends = np.cumsum(sizes, dtype=np.int64)
        steps = range(len(sizes))
        for k in reversed(steps) if backwards else steps:
            first = int(ends[k]) - sizes[k]
            yield (
                np.fromfile(paths[0], np.int64, sizes[k], offset=8 * first),
                np.fromfile(paths[1], np.uint8, sizes[k], offset=first),
            )

    def _paths(self, key: int) -> tuple[str, str]:
        return self._path(key, "p"), self._path(key, "l")

    def pop(self, key: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Take everything under a key, including what is pushed under it meanwhile."""
        while key in self.memory or key in self.files:
            sizes, parts = self.files.pop(key, []), self.memory.pop(key, [])
            self.held -= sum(len(p) for p, _ in parts)
            if sizes:  # what is pushed meanwhile may be spilled under the same name
                taken = (self._path(key, "tp"), self._path(key, "tl"))
                for old, new in zip(self._paths(key), taken, strict=True):
                    os.rename(old, new)
                yield from self._stored(sizes, taken, False)
                for path in taken:
                    os.remove(path)
            yield from _merged(parts)

    def read(self, key: int, backwards: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Everything under a key, left in place; backwards the arrays are reversed too."""
        if not backwards:
            yield from self._stored(self.files.get(key, []), self._paths(key), False)
            yield from _merged(self.memory.get(key, []))
            return
        for places, prefixes in reversed(list(_merged(self.memory.get(key, [])))):
            yield places[::-1], prefixes[::-1]
        for places, prefixes in self._stored(self.files.get(key, []), self._paths(key), True):
            yield places[::-1], prefixes[::-1]


def _least_between(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The least of values[first..last] for many ranges, from a table of doubling spans."""
    span = last - first + 1
    out = np.empty(len(first), dtype=np.uint8)
    level, table, width = np.frexp(span)[1] - 1, values, 1
    for k in range(int(level.max(initial=0)) + 1):
        here = np.flatnonzero(level == k)
        if len(here):
            out[here] = np.minimum(table[first[here]], table[last[here] - width + 1])
        table = np.minimum(table[:-width], table[width:]) if len(table) > width else table
        width *= 2
    return out


class Inducer:
    def __init__(self, text: np.ndarray, cap: int, hold: int, folder: str):
        self.n, self.cap, self.folder, self.hold = len(text), cap, folder, hold
        padded = np.zeros(len(text) + 72, dtype=np.uint8)
        padded[: len(text)] = text
        self.text = padded
        self.words = np.ndarray((len(text) + 64,), dtype="<u8", buffer=padded, strides=(1,))
        ends = np.flatnonzero(padded[: self.n] != padded[1 : self.n + 1])
        ends = np.append(ends, self.n - 1) if not len(ends) or ends[-1] != self.n - 1 else ends
        rising = padded[ends] < padded[ends + 1]
        rising[-1] = True  # the last separator, least of all
        self.rising = np.repeat(rising, np.diff(ends, prepend=-1))

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common prefixes of pairs of suffixes, to `cap`."""
        out = np.full(len(a), self.cap, dtype=np.int64)
        open_ = np.arange(len(a))
        for at in range(0, self.cap, 8):
            differ = self.words[a + at] ^ self.words[b + at]
            found = np.flatnonzero(differ)
            # The lowest set bit is in the first byte that differs, and exact as a float.
            low = differ[found]
            low &= ~low + np.uint64(1)
            out[open_[found]] = at + (np.frexp(low.astype(np.float64))[1] - 1) // 8
            rest = np.flatnonzero(differ == 0)
            if not len(rest):
                break
            open_, a, b = open_[rest], a[rest], b[rest]
        return np.minimum(out, self.cap).astype(np.uint8)

    def seeds(self) -> tuple[np.ndarray, np.ndarray]:
        starts = np.flatnonzero(self.rising[1:] & ~self.rising[:-1]) + 1
        heads = np.ndarray((self.n,), dtype=f"S{self.cap}", buffer=self.text, strides=(1,))[starts]
        starts = starts[np.argsort(heads)].astype(np.int64)
        prefixes = np.zeros(len(starts), dtype=np.uint8)
        prefixes[1:] = self.common(starts[:-1], starts[1:])
        return starts, prefixes

    def _induce(self, queue: BucketQueue, places, prefixes, rising: bool, since: np.ndarray) -> None:
        """Push the predecessors of a chunk that are of the wanted kind."""
        for at in range(0, len(places), CHUNK):
            p, l = places[at : at + CHUNK], prefixes[at : at + CHUNK]
            before = p - 1
            take = np.flatnonzero((p > 0) & (self.rising[before] == rising))
            keys = self.text[before[take]]
            order = np.argsort(keys, kind="stable")
            take, keys = take[order], keys[order]
            if len(keys):
                heads = np.concatenate(([0], np.flatnonzero(keys[1:] != keys[:-1]) + 1))
                new = np.empty(len(keys), dtype=np.uint8)
                inner = np.ones(len(keys), dtype=bool)
                inner[heads] = False
                inner = np.flatnonzero(inner)
                new[inner] = _least_between(l, take[inner - 1] + 1, take[inner])
                new[heads] = np.minimum(since[keys[heads]], np.minimum.accumulate(l)[take[heads]])
                new = np.minimum(new, self.cap - 1) + 1
            np.minimum(since, l.min(initial=FAR), out=since)
            if len(keys):
                after = np.append(np.minimum.accumulate(l[::-1])[::-1], FAR)
                bounds = [*heads.tolist(), len(keys)]
                for a, b in zip(bounds, bounds[1:], strict=False):
                    key = int(keys[a])
                    since[key] = after[take[b - 1] + 1]
                    queue.push(key, before[take[a:b]], new[a:b].astype(np.uint8))

    def run(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Chunks (places, common prefix with the suffix before) of all suffixes but separators."""
        starts, prefixes = self.seeds()
        cuts = np.searchsorted(self.text[starts], np.arange(257))
        folders = [os.path.join(self.folder, name) for name in ("open", "falling", "risen")]
        for name in folders:
            os.mkdir(name)
        queue, falling, risen = (BucketQueue(name, self.hold) for name in folders)
        since = np.zeros(256, dtype=np.uint8)
        lasts: dict[int, int] = {}
        for key in range(256):
            last = None
            for p, l in queue.pop(key):
                if last is None:
                    l = l.copy()
                    l[0] = 0
                falling.push(key, p, l)
                last = int(p[-1])
                self._induce(queue, p, l, False, since)
            if last is not None:
                lasts[key] = last
            a, b = cuts[key], cuts[key + 1]
            if a < b:
                l = prefixes[a:b].copy()
                l[0] = 0 if last is None else self.common(np.array([last]), starts[a : a + 1])[0]
                self._induce(queue, starts[a:b], l, False, since)
        since[:] = 0
        least: dict[int, int] = {}
        for key in range(255, 0, -1):
            last = None
            for p, l in queue.pop(key):
                if last is None:
                    l = l.copy()
                    l[0] = 0
                risen.push(key, p, l)
                last = int(p[-1])
                self._induce(queue, p, l, True, since)
            if last is not None:
                least[key] = last
            # Falling suffixes from the largest: each with its prefix in common with the one above.
            above = 0
            if last is not None and key in lasts:
                above = int(self.common(np.array([last]), np.array([lasts[key]]))[0])
            for p, l in falling.read(key, backwards=True):
                up = np.concatenate(([above], l[:-1])).astype(np.uint8)
                above = int(l[-1])
                self._induce(queue, p, up, True, since)
        for key in range(1, 256):
            yield from falling.read(key)
            below = 0
            if key in least and key in lasts:
                below = int(self.common(np.array([lasts[key]]), np.array([least[key]]))[0])
            for p, l in risen.read(key, backwards=True):
                # Stored with the prefix in common with the suffix above; wanted is that below.
                down = np.concatenate(([below], l[:-1])).astype(np.uint8)
                below = int(l[-1])
                yield p, down


def sorted_suffixes(
    text: np.ndarray, cap: int, hold: int = 1 << 23
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Suffixes of zero-separated bytes in order, in chunks of places and common prefixes.

    `hold` bounds the tuples that each of three queues keeps in memory.
    """
    if not len(text):
        return
    with tempfile.TemporaryDirectory(prefix="suffixes-") as folder:
        yield from Inducer(text, cap, hold, folder).run()
