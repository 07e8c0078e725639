"""Benchmark passages in documents: a broadcast set of hashed n-grams, scanned by word windows.

Words are runs of letters, digits and characters outside ASCII, with A-Z in lower case. An item's
windows are its `n` consecutive words; an item of fewer words is one window. A hash hit is verified
word by word before it counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakequality.llm import words
from lakequality.llm.tables import add_columns, col, store

NGRAM = 10
_SIEVE = np.uint64(44)
# Bytes of benchmark text in one broadcast block; a larger benchmark takes several passes.
BLOCK_BYTES = 64 << 20


def _cut(text: bytes | None):
    data = words.as_bytes(text, lower=True)
    starts, ends = words.spans(data, words.ALNUM)
    return data, starts, ends, words.hashes(data, starts, ends)


def _said(data, starts, ends, first: int, size: int) -> bytes:
    bounds = zip(starts[first : first + size], ends[first : first + size], strict=True)
    return b" ".join(data[s:e].tobytes() for s, e in bounds)


def window_set(items: list[tuple[str, bytes]], n: int) -> dict:
    """The windows of some items by number of words: a sieve over the top bits of their hashes, the
    sorted hashes, and hash -> [(words, items)]."""
    by_size: dict[int, dict[int, list[tuple[bytes, list[str]]]]] = {}
    for name, text in items:
        data, starts, ends, hashed = _cut(text)
        size = min(n, len(starts))
        if not size:
            continue
        held = by_size.setdefault(size, {})
        for i, h in enumerate(words.windows(hashed, size).tolist()):
            said = _said(data, starts, ends, i, size)
            for known, owners in held.setdefault(h, []):
                if known == said:
                    if owners[-1] != name:
                        owners.append(name)
                    break
            else:
                held[h].append((said, [name]))
    out = {}
    for size, held in by_size.items():
        known = np.array(sorted(held), dtype=np.uint64)
        sieve = np.zeros(1 << 20, dtype=bool)
        sieve[known >> _SIEVE] = True
        out[size] = (sieve, known, held)
    return out


def scan(table: dict, data, starts, ends, hashed) -> tuple[np.ndarray, set[str]]:
    """Which words lie inside an occurrence, and the items that occur."""
    edges = np.zeros(len(starts) + 1, dtype=np.int32)
    found: set[str] = set()
    for size, (sieve, known, held) in table.items():
        here = words.windows(hashed, size)
        maybe = np.flatnonzero(sieve[here >> _SIEVE])
        near = np.minimum(np.searchsorted(known, here[maybe]), len(known) - 1)
        for i in maybe[known[near] == here[maybe]].tolist():
            said = _said(data, starts, ends, i, size)
            for text, owners in held[int(here[i])]:
                if text == said:
                    edges[i] += 1
                    edges[i + size] -= 1
                    found.update(owners)
    return np.cumsum(edges[:-1]) > 0, found


def _runs(marked: np.ndarray) -> list[tuple[int, int]]:
    flags = np.zeros(len(marked) + 2, dtype=np.int8)
    flags[1:-1] = marked
    edges = np.flatnonzero(np.diff(flags))
    return list(zip(edges[0::2].tolist(), edges[1::2].tolist(), strict=True))


def _without(text: bytes, runs: list[tuple[int, int]], starts, ends) -> str:
    """The text without the bytes from the first to the last word of each run."""
    out, at = [], 0
    for first, last in runs:
        out.append(text[at : starts[first]])
        at = ends[last - 1]
    return b"".join([*out, text[at:]]).decode("utf-8")


def _blocks(items: DataFrame, id_col: str, text_col: str, block_bytes: int) -> Iterator[list[tuple[str, bytes]]]:
    """The items in groups of at most `block_bytes` of text (or one item), one group at a time."""
    named = items.filter(col(text_col).isNotNull()).select(
        F.coalesce(col(id_col).cast("string"), F.lit("null")).alias("name"), col(text_col).cast("string").alias("text")
    ).distinct()
    block, held = [], 0
    for row in named.orderBy("name", "text").toLocalIterator():
        text = row.text.encode("utf-8")
        if block and held + len(text) > block_bytes:
            yield block
            block, held = [], 0
        block.append((row.name, text))
        held += len(text)
    if block:
        yield block


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    n: int = NGRAM,
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    block_bytes: int = BLOCK_BYTES,
    keep: list[str] | None = None,
    cleaned: bool = True,
) -> DataFrame:
    """The documents with what they share with a benchmark.

    Adds `n_words` (long), `n_hit` (long, words inside an occurrence of a window), `items` (ids of
    the items with windows that occur, as sorted strings), `runs` (first word and end of every run
    of hit words) and `clean_text` (the text without those runs, unless `cleaned` is false). Input columns of these names are
    replaced; `keep` names the others to pass on, all by default.

    Null texts have no words and a null `clean_text`; a null item id is called "null", and items
    without words never occur. Repeated rows and items change nothing else. Without items nothing is
    hit. One pass over the documents serves `block_bytes` of benchmark text, which is what is
    broadcast; a larger benchmark takes more passes, with the hits so far stored between them.
    """
    schema = "n_words long, n_hit long, items array<string>, runs array<struct<first:int,end:int>>"
    schema += ", clean_text string" if cleaned else ""
    carried = "__hits array<struct<first:int,end:int>>, __items array<string>"
    spark = docs.sparkSession
    passed = [c for c in (docs.columns if keep is None else keep)]
    work = docs
    blocks = _blocks(benchmark, item_id, item_text, block_bytes)
    block, after = next(blocks, []), next(blocks, None)
    again = False
    while True:
        shared = spark.sparkContext.broadcast(window_set(block, n))
        last = after is None

        def compute(texts, *before, shared=shared, last=last):
            table = shared.value
            rows = []
            old = [c.to_pylist() for c in before] or None
            for k, text in enumerate(words.texts(texts)):
                data, starts, ends, hashed = _cut(text)
                marked, names = scan(table, data, starts, ends, hashed)
                if old:
                    names.update(old[1][k])
                    for run in old[0][k]:
                        marked[run["first"] : run["end"]] = True
                runs = _runs(marked)
                spans = [{"first": a, "end": b} for a, b in runs]
                if last:
                    row = (len(starts), int(marked.sum()), sorted(names), spans)
                    if cleaned:
                        row += (None if text is None else _without(text, runs, starts, ends),)
                    rows.append(row)
                else:
                    rows.append((spans, sorted(names)))
            width = 4 + cleaned if last else 2
            return list(zip(*rows, strict=True)) if rows else [[] for _ in range(width)]

        needs = [text_col, "__hits", "__items"] if again else [text_col]
        if last:
            return add_columns(work, schema, needs, compute, passed)
        work = add_columns(work, carried, needs, compute, list(dict.fromkeys([*passed, text_col])))
        work = store(work, "leaks")
        again, block, after = True, after, next(blocks, None)


def remove_leaks(docs: DataFrame, benchmark: DataFrame, mode: str = "document", text_col: str = "text", **options) -> DataFrame:
    """The documents without contaminated ones ("document") or without their hit runs ("span").

    Columns are those of `docs`; options are those of `find_leaks`.
    """
    if mode not in ("document", "span"):
        raise ValueError(f"mode is document or span, not {mode}")
    own = ["n_words", "n_hit", "items", "runs", "clean_text"]
    clash = {c: f"__own_{c}" for c in docs.columns if c.lower() in own}
    found = find_leaks(
        docs.withColumnsRenamed(clash), benchmark, text_col=text_col, cleaned=mode == "span", **options
    )
    if mode == "document":
        found = found.filter("n_hit = 0")
    return found.select(
        *(
            F.col("clean_text").alias(c) if mode == "span" and c == text_col else col(clash.get(c, c)).alias(c)
            for c in docs.columns
        )
    )


def digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return found.select(
        col(id_col),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.encode(F.array_join("items", ","), "UTF-8"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
