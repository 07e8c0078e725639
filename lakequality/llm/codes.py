"""Short codes for vectors: each part of a vector becomes the index of its nearest codebook entry.

Nearest entries are found through memoised grid cells. The space of a part is cut into boxes of
2**bits units a side. For a box, an entry whose least distance to it exceeds another entry's
greatest distance can be nearest nowhere inside, so the box remembers the entries that are left, and
only those are compared exactly for the parts that fall into it. All arithmetic is on integers, so
codes, errors and codebooks do not depend on how the rows are dealt.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakequality.llm.tables import col, small, store

N_PARTS = 8
N_ENTRIES = 16
ROUNDS = 6
SCALE = 4096
# Cells that one task remembers for a part; beyond it the memory of the part starts anew.
MEMO_CELLS = 1 << 14
# A component's integer has fewer bits than this.
COMPONENT_BITS = 30


class Nearest:
    """Nearest entry and squared distance of many parts, ties to the lower index."""

    def __init__(self, entries: np.ndarray, memo_cells: int = MEMO_CELLS):
        self.entries = entries
        self.bits = cell_bits(entries)
        self.memo_cells = memo_cells
        self.memo: dict[bytes, np.ndarray] = {}
        self.compared = 0

    def candidates(self, cells: np.ndarray) -> np.ndarray:
        """For each cell, which entries are nearest to some place in it; one row of flags a cell."""
        low = (cells << self.bits)[:, None, :]
        high = low + ((1 << self.bits) - 1)
        entries = self.entries[None, :, :]
        gap = np.maximum(np.maximum(low - entries, entries - high), 0)
        reach = np.maximum(np.abs(low - entries), np.abs(high - entries))
        least, most = (gap * gap).sum(axis=2), (reach * reach).sum(axis=2)
        return least <= most.min(axis=1, keepdims=True)

    def _remembered(self, cells: np.ndarray) -> np.ndarray:
        """Flags of the candidates for each row's cell, from the memory where it has the cell."""
        keys = np.ascontiguousarray(cells).view(np.dtype((np.void, 8 * cells.shape[1]))).ravel()
        _, first, which = np.unique(keys, return_index=True, return_inverse=True)
        names = [keys[i].tobytes() for i in first]
        if len(self.memo) + len(names) > self.memo_cells:
            self.memo.clear()
        new = [k for k, name in enumerate(names) if name not in self.memo]
        if new:
            for k, flags in zip(new, self.candidates(cells[first[new]]), strict=True):
                self.memo[names[k]] = flags
        return np.array([self.memo[name] for name in names])[which.ravel()]

    def __call__(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        best = np.zeros(len(parts), dtype=np.int64)
        distance = np.full(len(parts), np.iinfo(np.int64).max)
        if not parts.shape[1]:
            return best, np.zeros_like(distance)
        flags = self._remembered(parts >> self.bits)
        for k, entry in enumerate(self.entries):
            rows = np.flatnonzero(flags[:, k])
            apart = parts[rows] - entry
            found = (apart * apart).sum(axis=1)
            closer = found < distance[rows]
            best[rows[closer]], distance[rows[closer]] = k, found[closer]
            self.compared += len(rows)
        return best, distance


def cell_bits(entries: np.ndarray) -> int:
    """Bits of a box side: the power of two nearest to half the entries' spread along an axis.

    A coarser box is met again more often but keeps more candidates. On the given vectors (parts of
    eight components) this one keeps 6 of 16 entries, one of twice the side 13.
    """
    spread = float(entries.std(axis=0).mean()) / 2 if entries.size else 0.0
    return max(0, round(math.log2(spread))) if spread >= 1 else 0


def _matrix(column, n_parts: int) -> np.ndarray:
    """The vectors of an Arrow list column as (rows, parts, components of a part)."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat.reshape(len(column), n_parts, -1 if len(flat) else 0)


def kept_vectors(vectors: DataFrame, vector_col: str, scale: int) -> DataFrame:
    """Rows whose vector is whole and finite, with it as integers in `__ints`; a null in it drops the row."""
    vector = col(vector_col).cast("array<double>")
    whole = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))) & ~F.isnan(x))
    large = F.raise_error(F.lit(f"a component times {scale} does not fit in {COMPONENT_BITS} bits"))
    limit = float(1 << COMPONENT_BITS)
    ints = F.transform(
        vector, lambda x: F.when(F.abs(x * scale) < limit, F.floor(x * scale).cast("int")).otherwise(large.cast("int"))
    )
    return vectors.filter(vector.isNotNull() & whole).withColumn("__ints", ints)


def _first_books(rows: DataFrame, n_parts: int, n_entries: int) -> np.ndarray:
    """The parts of the vectors of the least ids, as (parts, entries, components)."""
    first = rows.orderBy(F.col("__id").asc_nulls_last(), "__ints").limit(n_entries).select("__ints").collect()
    return np.array([r[0] for r in first], dtype=np.int64).reshape(len(first), n_parts, -1).transpose(1, 0, 2).copy()


def _moved(rows: DataFrame, books: np.ndarray, memo_cells: int) -> np.ndarray:
    """The codebooks after one round: every entry at the floored mean of the parts nearest to it.

    A task sends one row for each part and entry; their sums go to the driver, as many numbers as the
    codebooks hold.
    """
    import pyarrow as pa

    n_parts, n_entries, width = books.shape

    def tally(batches) -> Iterator:
        nearest = [Nearest(book, memo_cells) for book in books]
        sums, counts = np.zeros_like(books), np.zeros((n_parts, n_entries), dtype=np.int64)
        for batch in batches:
            matrix = _matrix(batch.column(0), n_parts)
            for p in range(n_parts):
                best, _ = nearest[p](matrix[:, p, :])
                counts[p] += np.bincount(best, minlength=n_entries)
                np.add.at(sums[p], best, matrix[:, p, :])
        used = np.argwhere(counts > 0)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(used[:, 0], pa.int32()),
                pa.array(used[:, 1], pa.int32()),
                pa.array([int(counts[p, k]) for p, k in used], pa.int64()),
                pa.array([sums[p, k].tolist() for p, k in used], pa.list_(pa.int64())),
            ],
            names=["part", "entry", "n", "sums"],
        )

    tallies = rows.select("__ints").mapInArrow(tally, "part int, entry int, n bigint, sums array<bigint>")
    totals = tallies.select("part", "entry", "n", F.posexplode_outer("sums").alias("at", "value"))
    moved = books.copy()
    for r in totals.groupBy("part", "entry", "at").agg(F.sum("n").alias("n"), F.sum("value").alias("value")).toLocalIterator():
        if r["at"] is not None:
            moved[r["part"], r["entry"], r["at"]] = r["value"] // r["n"]
    return moved


def books_digest(books: np.ndarray) -> str:
    """SHA-256 of all components as decimal text, by part, entry and place, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    n_parts: int = N_PARTS,
    n_entries: int = N_ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    memo_cells: int = MEMO_CELLS,
) -> tuple[DataFrame, np.ndarray]:
    """The codes of all whole vectors, and the codebooks as (parts, entries, components).

    Rows are `id`, `label`, `codes` (array<int>, one index for each part), `error` (long, squared
    distances summed over the parts) and `label_error` (long, summed over rows of one label).
    A component x counts as floor(scale * x). The codebooks start from the vectors of the least ids
    (null ids last, equal ids by vector); fewer vectors than entries give shorter codebooks.

    A vector that is null, or holds a null, NaN or infinity, is dropped. Null labels are one label.
    Repeated rows count as often as they come. Other columns are not read. Empty vectors have code 0
    and no error; an empty table gives no rows and empty codebooks. All vectors must have one length
    that `n_parts` divides, and components small enough for 64-bit sums, else ValueError is raised.

    Whole vectors are stored once as integers; each round reads them, sums in the tasks and sends
    only the codebooks' sums to the driver. Label totals are counted map-side and joined back, which
    Spark broadcasts only below its measured size limit and splits where a label is hot beyond it.
    """
    named = kept_vectors(vectors.select(col(id_col).alias("__id"), col(label_col).alias("__label"), col(vector_col).alias("__v")), "__v", scale)
    rows = store(named.select("__id", "__label", "__ints"), "vectors")
    seen = rows.agg(
        F.min(F.size("__ints")).alias("shortest"), F.max(F.size("__ints")).alias("longest"),
        F.min(F.array_min("__ints")).alias("low"), F.max(F.array_max("__ints")).alias("high"),
    ).first()
    empty = f"__id {rows.schema['__id'].dataType.simpleString()}, __label {rows.schema['__label'].dataType.simpleString()}"
    if seen.shortest is None:
        none = small(rows.sparkSession, [], f"{empty}, codes array<int>, error bigint, label_error bigint")
        return none.withColumnsRenamed({"__id": "id", "__label": "label"}), np.zeros((n_parts, 0, 0), dtype=np.int64)
    if seen.shortest != seen.longest or seen.longest % n_parts:
        raise ValueError(f"vectors have {seen.shortest} to {seen.longest} components; one length that {n_parts} divides is needed")
    if seen.longest and seen.longest * (2 * max(abs(seen.low), abs(seen.high)) + 2) ** 2 >= 1 << 63:
        raise ValueError("components are too large for squared distances of 64 bits")
    books = _first_books(rows, n_parts, n_entries)
    for _ in range(rounds):
        books = _moved(rows, books, memo_cells)
    coded = store(_coded(rows, books, memo_cells), "codes")
    totals = coded.groupBy(F.col("label").alias("__of")).agg(F.sum("error").alias("label_error"))
    joined = coded.join(totals, F.col("label").eqNullSafe(F.col("__of")))
    return joined.select("id", "label", "codes", "error", "label_error"), books


def _coded(rows: DataFrame, books: np.ndarray, memo_cells: int) -> DataFrame:
    import pyarrow as pa

    n_parts = len(books)

    def assign(batches) -> Iterator:
        nearest = [Nearest(book, memo_cells) for book in books]
        for batch in batches:
            matrix = _matrix(batch.column(2), n_parts)
            found = [nearest[p](matrix[:, p, :]) for p in range(n_parts)]
            codes = np.stack([best for best, _ in found], axis=1).astype(np.int32)
            ends = np.arange(0, codes.size + 1, n_parts, dtype=np.int32)
            error = sum(distance for _, distance in found)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.ListArray.from_arrays(ends, codes.ravel()), pa.array(error, pa.int64())],
                names=["id", "label", "codes", "error"],
            )

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    return rows.mapInArrow(assign, f"id {kinds['__id']}, label {kinds['__label']}, codes array<int>, error bigint")


def decode(codes: Sequence[int], books: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """The vector that a code stands for."""
    return np.concatenate([books[p, k] for p, k in enumerate(codes)]) / scale


def code_text(codes) -> F.Column:
    """Two lower-case hex digits for each index of a code."""
    return F.lower(F.array_join(F.transform(codes, lambda k: F.lpad(F.hex(k), 2, "0")), ""))
