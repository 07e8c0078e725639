"""Ranked lexical search: every query item against all documents, by branch and bound over a term trie.

Documents are reduced to the terms that items ask for, as vectors of term counts. A task sorts the
vectors of some thousand documents by frequent terms first and shares their common starts, which
gives a trie. Every node knows the greatest count of each term and the least length norm below it,
so the score of the best document there is bounded without looking at one. Each item goes down the
trie depth first, best bound first, and leaves out what can't reach its best documents so far.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakequality.llm.tables import col, small, store

TOP = 20
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Distinct terms and term occurrences that the items of one block have, or one item; each block reads the documents once.
BLOCK_TERMS = 8192
# Documents below a leaf, unless their vectors are alike.
LEAF_ROWS = 32
# Cells of a task's dense table of counts, and the most documents of one trie.
_CELLS = 1 << 23
_TREE_ROWS = 4096
_CHUNK = 1 << 20
_TERM_BYTES = re.compile(rb"[0-9a-z\x80-\xff]+")
_GAP = re.compile(rb"[^0-9a-z\x80-\xff]")
_ID_LAST = np.iinfo(np.int64).max


def term_counts(text: bytes) -> Counter:
    """Terms of a whole text with their occurrences; a long text is read piece by piece."""
    text, counts, at = text.lower(), Counter(), 0
    while at < len(text):
        gap = _GAP.search(text, at + _CHUNK)
        end = gap.start() if gap else len(text)
        counts.update(_TERM_BYTES.findall(text, at, end))
        at = end
    return counts


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def norm(n_terms: int, n_docs: int, all_terms: int) -> int:
    """A document's length norm: 100 at the mean length, 75 at none."""
    return 75 + 25 * n_terms * n_docs // all_terms


def scores(tf: np.ndarray, norms: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Scores of rows of counts. They never fall when a count grows or the norm shrinks, so maxima
    of counts with the minimum of norms bound the score of all rows they come from."""
    tf = tf.astype(np.int64)
    return ((1_000_000_000 * tf) // (1000 * tf + 12 * norms[:, None])) @ weights


class Best:
    """The best documents of an item so far: highest score, then least id, null ids last."""

    def __init__(self, top: int):
        self.top = top
        self.score, self.none, self.id = np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)

    def worth(self, score, none, ident):
        """Whether documents of these scores, and of no lesser ids, can be among the best."""
        if len(self.score) < self.top:
            return score > 0
        s, e, i = self.score[-1], self.none[-1], self.id[-1]
        earlier = (none < e) | ((none == e) & (ident < i))
        return (score > s) | ((score == s) & earlier)

    def add(self, score, none, ident) -> None:
        here = np.flatnonzero(self.worth(score, none, ident) & (score > 0))
        if not len(here):
            return
        score = np.concatenate([self.score, score[here]])
        none = np.concatenate([self.none, none[here]])
        ident = np.concatenate([self.id, ident[here]])
        order = np.lexsort((ident, none, -score))[: self.top]
        self.score, self.none, self.id = score[order], none[order], ident[order]


class Trie:
    """Documents by their restricted vectors, terms of many documents first.

    `lengths` has the terms of each document, `ranks` and `tf` the terms (0 is the most frequent) and
    counts of all of them one after another. Equal starts are shared; a node is a range of the sorted
    documents, a start with one way on is no node, and small neighbours share a leaf.
    """

    def __init__(self, lengths, ranks, tf, norms, none, ident, n_terms: int, leaf_rows: int = LEAF_ROWS):
        owner = np.repeat(np.arange(len(lengths)), lengths)
        inside = np.lexsort((ranks, owner))
        ranks, tf = ranks[inside], tf[inside]
        starts = np.concatenate([[0], np.cumsum(lengths)])
        path = ranks.astype(">u4").tobytes()
        order = np.array(sorted(range(len(lengths)), key=lambda i: path[4 * starts[i] : 4 * starts[i + 1]]), dtype=np.int64)
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        self.tf = np.zeros((len(order), n_terms), dtype=np.int32)
        self.tf[place[owner], ranks] = tf
        self.norms, self.none, self.id = norms[order], none[order], ident[order]
        self._grow(ranks, starts[:-1][order], lengths[order], leaf_rows)
        self.seen = 0

    def _grow(self, ranks, starts, lengths, leaf_rows: int) -> None:
        ends: list[tuple[int, int]] = []
        children: list[list[int]] = []
        open_nodes = [(0, len(starts), 0, -1)]
        while open_nodes:
            low, high, depth, parent = open_nodes.pop()
            node = len(ends)
            ends.append((low, high))
            children.append([])
            if parent >= 0:
                children[parent].append(node)
            while high - low > leaf_rows:
                goes_on = lengths[low:high] > depth
                step = np.full(high - low, -1, dtype=np.int64)
                step[goes_on] = ranks[starts[low:high][goes_on] + depth]
                cuts = np.flatnonzero(step[1:] != step[:-1]) + 1
                if len(cuts):
                    open_nodes += [(a, b, depth, node) for a, b in _joined([low, *(low + cuts).tolist(), high], leaf_rows)]
                    break
                if step[0] < 0:
                    break  # equal vectors, however many
                depth += 1
        self.ends, self.children = ends, [np.array(c, dtype=np.int64) for c in children]
        self.most = np.zeros((len(ends), self.tf.shape[1]), dtype=np.int32)
        self.least_norm = np.zeros(len(ends), dtype=np.int64)
        self.least_none, self.least_id = np.zeros(len(ends), dtype=bool), np.zeros(len(ends), dtype=np.int64)
        for node in range(len(ends) - 1, -1, -1):
            below = self.children[node]
            if len(below):
                self.most[node] = self.most[below].max(axis=0)
                norms, none, ident = self.least_norm[below], self.least_none[below], self.least_id[below]
            else:
                part = slice(*ends[node])
                self.most[node] = self.tf[part].max(axis=0)
                norms, none, ident = self.norms[part], self.none[part], self.id[part]
            self.least_norm[node] = norms.min()
            self.least_none[node] = none.min()
            self.least_id[node] = ident[none == none.min()].min()

    def search(self, terms: np.ndarray, weights: np.ndarray, best: Best) -> None:
        """Bring the best documents of an item up to date with this trie's."""
        nodes = np.zeros(1, dtype=np.int64)
        todo: list[tuple[int, int]] = []
        while True:
            if len(nodes):
                bounds = scores(self.most[nodes][:, terms], self.least_norm[nodes], weights)
                useful = np.flatnonzero(best.worth(bounds, self.least_none[nodes], self.least_id[nodes]))
                useful = useful[np.argsort(bounds[useful], kind="stable")]
                todo += zip(bounds[useful].tolist(), nodes[useful].tolist(), strict=True)
            if not todo:
                return
            bound, node = todo.pop()
            nodes = self.children[node]
            if not best.worth(bound, self.least_none[node], self.least_id[node]):
                nodes = nodes[:0]
            elif not len(nodes):
                part = slice(*self.ends[node])
                self.seen += part.stop - part.start
                best.add(scores(self.tf[part][:, terms], self.norms[part], weights), self.none[part], self.id[part])


def _joined(cuts: list[int], leaf_rows: int) -> Iterator[tuple[int, int]]:
    """Ranges between cuts, small neighbours joined up to `leaf_rows`."""
    first = cuts[0]
    for a, b in zip(cuts, [*cuts[1:], None], strict=True):
        if b is None or b - first > leaf_rows:
            if a > first:
                yield first, a
            first = a


def restricted(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """Each document's `id`, number of terms `n`, and its `terms` of the vocabulary with counts `tf`."""
    import pyarrow as pa

    def count(batches) -> Iterator:
        for batch in batches:
            n, terms, tf = [], [], []
            for text in batch.column(1).to_pylist():
                counts = term_counts(text)
                n.append(sum(counts.values()))
                known = [(vocabulary[t], c) for t, c in counts.items() if t in vocabulary]
                terms.append([t for t, _ in known])
                tf.append([c for _, c in known])
            kinds = (pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()))
            arrays = [pa.array(v, k) for v, k in zip((n, terms, tf), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=["id", "n", "terms", "tf"])

    text = F.coalesce(col(text_col).cast("string"), F.lit("")).cast("binary")
    rows = docs.select(col(id_col).cast("bigint").alias("id"), text.alias("text"))
    return rows.mapInArrow(count, "id bigint, n bigint, terms array<int>, tf array<int>")


def _blocks(items: DataFrame, item_id: str, item_text: str, block_terms: int) -> Iterator[list[tuple[object, Counter]]]:
    """Item ids with their term counts, in groups of at most `block_terms` terms (or one item), one group at a time."""
    terms = F.regexp_extract_all(F.translate(col(item_text).cast("string"), UPPER, LOWER), F.lit(f"({TERM})"))
    rows = items.select(col(item_id).alias("id"), terms.alias("terms")).filter(F.size("terms") > 0)
    block, held = [], 0
    for row in rows.orderBy("id", "terms").toLocalIterator():
        if block and held + len(row.terms) > block_terms:
            yield block
            block, held = [], 0
        block.append((row.id, Counter(t.encode("utf-8") for t in row.terms)))
        held += len(row.terms)
    if block:
        yield block


def _ranked_block(docs: DataFrame, block, kind: T.DataType, id_col: str, text_col: str, top: int, leaf_rows: int) -> DataFrame | None:
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_type

    names = sorted({t for _, counts in block for t in counts})
    vocabulary = {t: k for k, t in enumerate(names)}
    rows = store(restricted(docs, vocabulary, id_col, text_col), "term-vectors")
    sums = rows.agg(F.count_if(F.col("n") > 0).alias("docs"), F.sum("n").alias("terms")).first()
    if not sums.docs:
        return None
    n_docs, all_terms = sums.docs, sums.terms
    # One number for each term of the block reaches the driver.
    df = dict(rows.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("n")).toLocalIterator())
    by_df = sorted(df, key=lambda t: (-df[t], t))
    rank = np.full(len(names), -1, dtype=np.int64)
    rank[by_df] = np.arange(len(by_df))
    asked = []
    for ident, counts in block:
        held = [(int(rank[vocabulary[t]]), c * weight(n_docs, df[vocabulary[t]])) for t, c in counts.items() if vocabulary[t] in df]
        asked.append((ident, *(np.array(v, dtype=np.int64) for v in zip(*held, strict=True))) if held else (ident, None, None))
    tree_rows = max(16, min(_TREE_ROWS, _CELLS // max(1, len(by_df))))

    def flat(column) -> tuple[np.ndarray, np.ndarray]:
        lengths = np.diff(column.offsets.to_numpy())
        return lengths, column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)

    def walk(batches) -> Iterator:
        best = [Best(top) for _ in asked]
        held, size = [], 0

        def climb():
            one = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            lengths, terms = flat(one.column(2))
            tf = flat(one.column(3))[1]
            norms = np.array([norm(n, n_docs, all_terms) for n in one.column(1).to_pylist()], dtype=np.int64)
            none = one.column(0).is_null().to_numpy(zero_copy_only=False)
            ident = one.column(0).fill_null(_ID_LAST).to_numpy()
            trie = Trie(lengths, rank[terms], tf, norms, none, ident, len(by_df), leaf_rows)
            for (_, terms, weights), found in zip(asked, best, strict=True):
                if terms is not None:
                    trie.search(terms, weights, found)

        for batch in batches:
            for first in range(0, batch.num_rows, tree_rows):
                part = batch.slice(first, tree_rows)
                if size + part.num_rows > tree_rows:
                    climb()
                    held, size = [], 0
                held.append(part)
                size += part.num_rows
        if held:
            climb()
        found = [(k, ident, b) for k, ((ident, _, _), b) in enumerate(zip(asked, best, strict=True)) if len(b.score)]
        ids = [None if e else i for _, _, b in found for e, i in zip(b.none.tolist(), b.id.tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([k for k, _, b in found for _ in b.score], pa.int32()),
                pa.array([i for _, i, b in found for _ in b.score], to_arrow_type(kind)),
                pa.array(ids, pa.int64()),
                pa.array([s for _, _, b in found for s in b.score.tolist()], pa.int64()),
            ],
            names=["at", "item", "id", "score"],
        )

    schema = T.StructType().add("at", T.IntegerType()).add("item", kind).add("id", T.LongType()).add("score", T.LongType())
    local = rows.filter(F.size("terms") > 0).select("id", "n", "terms", "tf").mapInArrow(walk, schema)
    by_item = Window.partitionBy("at").orderBy(F.desc("score"), F.col("id").asc_nulls_last())
    return local.withColumn("rank", F.row_number().over(by_item)).filter(F.col("rank") <= top).drop("at")


def search(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    top: int = TOP,
    block_terms: int = BLOCK_TERMS,
    leaf_rows: int = LEAF_ROWS,
) -> DataFrame:
    """The `top` best documents of every item: `item`, `rank` (from 1), `id` and `score`.

    Terms are runs of letters, digits and characters outside ASCII, with A-Z in lower case, in whole
    texts. A term weighs floor(1000 * ln((2 N + 2) / (2 df + 1))), N and df counted over all documents
    that have a term; a document's score sums weight * (10**9 tf div (1000 tf + 12 m)) over the
    item's terms, repeats included. Only scores above 0 are returned; equal scores rank by id, null
    ids last, and equal rows as often as they come.

    Null and empty texts have no terms: such documents are never found and such items find nothing.
    Every row of `items` is an item, repeated ones too. Empty tables give no rows; other columns are
    not read. Document ids are whole numbers, and 10**9 times a term's count must fit in 64 bits.

    Items go in blocks of `block_terms` terms, so what travels to the tasks is bounded; a longer item
    is a block of its own. Each block reads the documents once and stores their counts of the block's
    terms, which have no text. A task keeps `top` documents for each item; they are merged by item.
    """
    kind = items.schema[item_id].dataType
    found = None
    for block in _blocks(items, item_id, item_text, block_terms):
        part = _ranked_block(docs, block, kind, id_col, text_col, top, leaf_rows)
        if part is None:
            break
        found = part if found is None else found.unionByName(part)
    if found is None:
        return small(docs.sparkSession, [], f"item {kind.simpleString()}, id bigint, score bigint, rank int")
    return found
