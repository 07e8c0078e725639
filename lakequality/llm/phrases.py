"""Fingerprints of documents from Lempel-Ziv phrases.

A text is cut from left to right into phrases, each the longest one seen before plus one byte. The
hashed set of its phrases stands for the text: texts that would compress well together share many
phrases. A fingerprint holds the least hashes of the set. The likeness of two fingerprints estimates
the share of phrases that both sets have, and is exact where the sets are no larger than a fingerprint.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakequality.llm import words
from lakequality.llm.tables import Scratch, col, without

# Hashes of a fingerprint; the standard error of a likeness is at most 0.045.
SIZE = 128
# Phrases of one dictionary. A longer text goes on with an empty one, so a task's memory is bounded;
# a text below 1 MB does not reach it.
DICTIONARY = 1 << 18
# Bytes whose phrases are hashed at once.
_CHUNK = 1 << 20
_HASH = np.dtype(">u4")


class Parser:
    """Phrases of one text. The dictionary is a trie of nested dictionaries: byte -> node."""

    def __init__(self, limit: int = DICTIONARY):
        self.limit = limit
        self.root: dict = {}
        self.node = self.root
        self.count = 0

    def ends(self, data: bytes, new: list | None = None) -> array:
        """Where phrases end in `data`, which goes on from the text before; `new` gets the new places of the trie."""
        found = array("q")
        root = self.root
        node, room = self.node, self.limit - self.count
        for at, byte in enumerate(data):
            after = node.get(byte)
            if after is not None:
                node = after
                continue
            node[byte] = {}
            found.append(at + 1)
            if new is not None:
                new.append((node, byte))
            room -= 1
            if not room:
                root, room = {}, self.limit
            node = root
        self.root, self.node, self.count = root, node, self.limit - room
        return found

    def both(self, data: bytes, other: bytes) -> tuple[array, array]:
        """Ends of phrases in `data`, and in `other`, each read from the state at hand."""
        state, new = (self.root, self.node, self.count), []
        one = self.ends(data, new)
        for node, byte in new:
            del node[byte]
        self.root, self.node, self.count = state
        return one, self.ends(other)


def _distinct(values: np.ndarray) -> np.ndarray:
    values.sort()
    new = np.ones(len(values), dtype=bool)
    np.not_equal(values[1:], values[:-1], out=new[1:])
    return values[new]


def least(data: bytes, ends: np.ndarray, size: int = SIZE) -> np.ndarray:
    """The `size` least distinct hashes of the phrases that lie side by side up to the given ends."""
    best = np.zeros(0, dtype=np.uint32)
    first, base = 0, 0
    while first < len(ends):
        last = max(first + 1, int(np.searchsorted(ends, base + _CHUNK, side="right")))
        cuts = np.concatenate([[base], ends[first:last]]) - base
        part = np.frombuffer(data, dtype=np.uint8, count=int(cuts[-1]), offset=base)
        hashed = (words.hashes(part, cuts[:-1], cuts[1:]) >> np.uint64(32)).astype(np.uint32)
        best = _distinct(np.concatenate([best, hashed]))[:size]
        first, base = last, int(ends[last - 1])
    return best.astype(_HASH)


def fingerprint(text: bytes, size: int = SIZE) -> np.ndarray:
    return least(text, np.frombuffer(Parser().ends(text), dtype=np.int64), size)


def fingerprints(text: bytes, cut: int, tail: bytes, size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of `text`, and of its first `cut` bytes with `tail` behind; the start is parsed once."""
    parser = Parser()
    head = parser.ends(text[:cut])
    own, other = parser.both(text[cut:], tail)
    head, own, other = (np.frombuffer(e, dtype=np.int64) for e in (head, own, other))
    return (
        least(text, np.concatenate([head, own + cut]), size),
        least(text[:cut] + tail, np.concatenate([head, other + cut]), size),
    )


def likeness(one: np.ndarray, other: np.ndarray, size: int = SIZE) -> float:
    """Estimated share of common phrases, 0 to 1: of the `size` least hashes of both, those in both."""
    if not len(one) or not len(other):
        return float(len(one) == len(other))
    both = np.concatenate([one, other]).astype(np.uint32)
    both.sort()
    twice = np.zeros(len(both), dtype=bool)
    np.equal(both[1:], both[:-1], out=twice[:-1])
    new = np.ones(len(both), dtype=bool)
    new[1:] = ~twice[:-1]
    seen = twice[new][:size]
    return float(seen.sum() / len(seen))


def edit(text: bytes, following: bytes) -> tuple[int, bytes, int]:
    """Bytes that stay of a text, the start of the following text put behind them, and its code points."""
    said = text.decode("utf-8")
    swapped = len(said) // 4
    kept = len(said[: len(said) - swapped].encode("utf-8"))
    start = following[: 4 * swapped].decode("utf-8", "ignore")[:swapped]  # a code point has at most four bytes
    return kept, start.encode("utf-8"), len(said)


def _measured(text: bytes, following: bytes, size: int) -> tuple[int, str, np.ndarray, np.ndarray, float]:
    kept, tail, n_chars = edit(text, following)
    own, edited = fingerprints(text, kept, tail, size)
    digest = hashlib.sha256(text[:kept] + tail).hexdigest()
    return n_chars, digest, own, edited, likeness(own, edited, size)


_ADDED = {
    "n_chars": T.LongType(),
    "edited_sha256": T.StringType(),
    "fingerprint": T.BinaryType(),
    "edited_fingerprint": T.BinaryType(),
    "near_edited": T.DoubleType(),
    "near_next": T.DoubleType(),
}
# Texts of the first and the last row of a range, whose neighbours are in other ranges.
_BORDER = {"__part": T.LongType(), "__head": T.BinaryType(), "__tail": T.BinaryType()}


def compare_neighbours(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, keep: list[str] | None = None
) -> DataFrame:
    """Every document with its fingerprint, and how like it is to an edited copy and to the next document.

    The edited text has the last floor(n_chars / 4) code points replaced by the first as many, or
    all, of the next document in ascending id (after the last: of the first). Adds `n_chars`,
    `edited_sha256`, `fingerprint`, `edited_fingerprint` (binary, four bytes a hash, ascending),
    `near_edited` and `near_next`; input columns of these names are replaced.

    Null texts are empty; an empty text has an empty fingerprint, like another empty one by 1.0 and
    anything else by 0.0. Null ids come last. Rows of one id follow each other by a 64-bit hash of
    their texts, then in the order of the table; a row alone is its own next. An empty table gives no
    rows.

    Texts are range-partitioned by that order, in one shuffle, so neither a hot id nor copies stay in
    one task, and a task goes through its range batch by batch. The last row of a range waits for the
    first of the next one; those few are joined, one row for each range.
    """
    import pyarrow as pa

    passed = [c for c in without(docs, list(_ADDED)) if keep is None or c in keep]
    text = F.coalesce(col(text_col).cast("string"), F.lit(""))
    source = docs.select(
        *(col(c) for c in passed),
        text.cast("binary").alias("__text"),
        col(id_col).isNull().alias("__none"),
        col(id_col).alias("__id"),
        F.xxhash64(text).alias("__hash"),
        F.monotonically_increasing_id().alias("__row"),
    )
    order = ["__none", "__id", "__hash", "__row"]
    ranged = source.repartitionByRange(*order).sortWithinPartitions(*order).select(
        *(col(c) for c in passed), F.spark_partition_id().cast("bigint").alias("__part"), "__text"
    )
    own = [ranged.schema[c] for c in passed]
    schema = T.StructType(own + [T.StructField(n, t) for n, t in {**_ADDED, **_BORDER}.items()])
    at, binary = len(passed), pa.binary()

    def finished(columns: list, texts: list[bytes], following: bytes | None, head: bool):
        """Rows of a range; only a row without a following text stays open, its text as `__tail`."""
        n = len(texts)
        done = [_measured(t, f, size) for t, f in zip(texts, [*texts[1:], following], strict=True) if f is not None]
        chars, digests, prints, edited, near = (list(v) for v in zip(*done, strict=True)) if done else ([] for _ in range(5))
        after = [*prints[1:], fingerprint(following, size)] if following is not None else prints[1:]
        if following is None:
            last = fingerprint(texts[-1], size)
            after, prints = [*after, last][: n - 1], [*prints, last]
            chars.append(len(texts[-1].decode("utf-8")))
            digests.append(None), edited.append(None), near.append(None)
        steps = [likeness(a, b, size) for a, b in zip(prints, after, strict=False)]
        steps += [None] * (n - len(steps))
        values = [
            pa.array(chars, pa.int64()),
            pa.array(digests, pa.string()),
            pa.array([p.tobytes() for p in prints], binary),
            pa.array([None if e is None else e.tobytes() for e in edited], binary),
            pa.array(near, pa.float64()),
            pa.array(steps, pa.float64()),
            columns[at],
            pa.array([t if head and not i else None for i, t in enumerate(texts)], binary),
            pa.array([t if following is None and i == n - 1 else None for i, t in enumerate(texts)], binary),
        ]
        return pa.RecordBatch.from_arrays(columns[:at] + values, names=schema.names)

    def through(batches) -> Iterator:
        """One batch stays in hand until the next one's first text is known."""
        held, first = None, True
        for batch in batches:
            if not batch.num_rows:
                continue
            texts = batch.column(at + 1).to_pylist()
            if held is not None:
                yield finished(*held, texts[0], first)
                first = False
            held = (batch.columns, texts)
        if held is not None:
            yield finished(*held, None, first)

    rows = Scratch(ranged.mapInArrow(through, schema), "phrases").rows
    heads = rows.filter(F.col("__head").isNotNull()).select(
        F.col("__part").alias("__at"), F.col("__head").alias("__next"), F.col("fingerprint").alias("__print")
    )
    by_part = Window.orderBy("__at")  # one row for each range, numbers only
    steps = heads.select("__at").select(
        F.col("__at").alias("__from"),
        F.coalesce(F.lead("__at").over(by_part), F.first("__at").over(by_part)).alias("__at"),
    )
    waiting = rows.filter(F.col("__tail").isNotNull()).withColumnRenamed("__part", "__from")
    pairs = waiting.join(steps, "__from").join(heads, "__at")
    names = [*passed, *_ADDED]
    reads = pairs.select(*(col(c) for c in passed), "__tail", "__next", "__print")

    def closed(batches) -> Iterator:
        for batch in batches:
            texts, nexts, prints = (batch.column(at + k).to_pylist() for k in range(3))
            done = [_measured(t, f, size) for t, f in zip(texts, nexts, strict=True)]
            steps = [likeness(d[2], np.frombuffer(p, dtype=_HASH), size) for d, p in zip(done, prints, strict=True)]
            values = [
                pa.array([d[0] for d in done], pa.int64()),
                pa.array([d[1] for d in done], pa.string()),
                pa.array([d[2].tobytes() for d in done], binary),
                pa.array([d[3].tobytes() for d in done], binary),
                pa.array([d[4] for d in done], pa.float64()),
                pa.array(steps, pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(batch.columns[:at] + values, names=names)

    ended = reads.mapInArrow(closed, T.StructType(own + [T.StructField(n, t) for n, t in _ADDED.items()]))
    return rows.filter(F.col("__tail").isNull()).select(*(col(c) for c in names)).unionByName(ended)
