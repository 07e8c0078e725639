"""Near-duplicate documents by DartMinHash signatures, banded joining and exact verification.

A document is a weighted set: its five-word shingles with their counts. Every unit of an element's
weight is a region of the plane (weight x rank) into which a hashed Poisson process throws darts; the
same element throws the same darts in every document. Only darts below a rank bound are thrown, with
the bound chosen so that all coordinates together get about `k ln k + 2 k` of them: the work is that
of the darts, not of `k` hashes for every element. Each dart falls on a coordinate; the earliest on
each is the signature, and two documents agree on a coordinate with the probability of their
weighted Jaccard similarity.

Equal texts are one document until the end; of each, the row of the least id lends its text, which is
read from the input where it is needed, so whole texts are neither stored nor shuffled to find equal
ones. Documents that agree on a band of coordinates meet; in a bucket everyone is compared with one
pivot, not with everyone: the member that meets most others over all bands. Of copies that were each
changed a little, the original is nearest to all, so most of them join its class at once.

What remains are buckets whose members are in several classes, as copies that were changed too much.
Comparing all of them would grow with the square of a group, so they meet again by their rarest
shingles, which loses no pair at the threshold: two weighted sets of sizes n and m at similarity t
share t / (1 + t) * (n + m) of their counts, so in the order from rare to common the first shingle they
share lies before that much is left of either. Shingles of one document alone can't be shared; a
document with more than 1 - t of them has no partner at all. All comparisons are exact.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakequality.llm import words
from lakequality.llm.tables import Scratch, add_columns, col, maybe_in, release, store

SHINGLE = 5
SIMILARITY = 0.8
# 24 bands of 4: a pair at similarity 0.8 shares no band with probability (1 - 0.8**4)**24 = 3e-6.
BANDS = 24
ROWS = 4
# Sizes of documents that meet by rare shingles differ by less than this ratio within a class of sizes.
SIZE_RATIO = 1.05


def shingles(text: bytes | None, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles, sorted, with their counts.

    A text of fewer than `n` words, but not none, is one shingle.
    """
    data = words.as_bytes(text, lower=True)
    starts, ends = words.spans(data, words.ALNUM)
    if not len(starts):
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    hashed = words.hashes(data, starts, ends)
    return np.unique(words.windows(hashed, min(n, len(starts))), return_counts=True)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard: the shared counts over all counts."""
    _, at_a, at_b = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = np.minimum(a[1][at_a], b[1][at_b]).sum()
    total = a[1].sum() + b[1].sum() - both
    return float(both / total) if total else 0.0


def _uniform(x: np.ndarray) -> np.ndarray:
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)


def signature(elements: np.ndarray, counts: np.ndarray, k: int) -> np.ndarray:
    """The earliest dart of each coordinate, as 64-bit ids; empty for an empty set."""
    if not len(elements):
        return np.zeros(0, dtype=np.uint64)
    # One column of unit weight for each count; the darts of a column arrive at rate one by rank.
    copy = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    columns = words.mix(np.repeat(elements, counts) + copy.astype(np.uint64) * np.uint64(words.BASE))
    bound = (k * np.log(k) + 2 * k) / len(columns)
    while True:
        # Darts are thrown a few at a time at each column, until the next one lies beyond the bound.
        some = int(bound) + 3
        ids, ranks, thrown = [], [], 0
        at, rank = columns, np.zeros(len(columns))
        while len(at):
            number = np.arange(thrown + 1, thrown + some + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)
            one = words.mix(at[:, None] ^ number)
            arrival = rank[:, None] - np.cumsum(np.log(_uniform(one)), axis=1)
            below = arrival < bound
            ids.append(one[below])
            ranks.append(arrival[below])
            more = below[:, -1]
            at, rank, thrown = at[more], arrival[more, -1], thrown + some
        ids, ranks = words.mix(np.concatenate(ids)), np.concatenate(ranks)
        late_first = np.argsort(ranks)[::-1]
        ids = ids[late_first]
        place = ((ids >> np.uint64(40)) % np.uint64(k)).astype(np.int64)
        out = np.zeros(k, dtype=np.uint64)
        out[place] = ids  # of several darts on a coordinate the last written, the earliest, stays
        if np.bincount(place, minlength=k).all():
            return out
        bound *= 2


def bands(sign: np.ndarray, n_bands: int = BANDS, n_rows: int = ROWS) -> list[int]:
    """One key for each band of the signature."""
    if not len(sign):
        return []
    folded = sign.reshape(n_bands, n_rows)
    key = words.mix(np.arange(n_bands, dtype=np.uint64) + np.uint64(1))
    for r in range(n_rows):
        key = words.mix(key * np.uint64(words.BASE) + folded[:, r])
    return key.view(np.int64).tolist()


def _likely(parts, threshold: float):
    """The pairs whose signatures agree nearly as often as those of texts at the threshold.

    Six standard errors below it: a linked pair is lost with probability 1e-9.
    """
    import pyarrow as pa

    for part in parts:
        a, b = (b"".join(part.column(k).to_pylist()) for k in (2, 3))
        if not a:
            continue
        k = len(a) // part.num_rows
        agree = (np.frombuffer(a, np.uint8) == np.frombuffer(b, np.uint8)).reshape(part.num_rows, k).mean(axis=1)
        least = threshold - 6 * np.sqrt(threshold * (1 - threshold) / k)
        yield pa.RecordBatch.from_arrays(part.columns[:2], names=["pivot", "other"]).filter(pa.array(agree >= least))


def _verify(pairs: DataFrame, texts: DataFrame, reps: DataFrame, threshold: float, salts: int = 64) -> DataFrame:
    """The pairs (pivot, other) whose texts reach the threshold.

    `texts` holds (id, h, text), `reps` the id to take for each `h` of the pairs.
    Members come to their pivot, sorted behind it, in streams: one pivot's shingles are held at a
    time. A pivot with many members is spread over `salts` streams, each with a copy of its text.
    """
    salted = pairs.withColumn("salt", F.pmod(F.xxhash64("other"), F.lit(salts)))
    heads = salted.select("pivot", "salt", F.lit(None).cast("bigint").alias("other"), F.col("pivot").alias("h")).distinct()
    members = salted.select("pivot", "salt", "other", F.col("other").alias("h"))
    asked = heads.unionByName(members).join(reps, "h").withColumnRenamed("h", "said_h")
    wanted = pairs.select(F.explode(F.array("pivot", "other")).alias("h")).distinct()
    rows = asked.join(
        maybe_in(texts, F.col("h"), wanted), (F.col("h") == F.col("said_h")) & F.col("id").eqNullSafe(F.col("rep"))
    ).select("pivot", "salt", "other", "text")
    rows = rows.repartition("pivot", "salt").sortWithinPartitions(
        "pivot", "salt", F.col("other").asc_nulls_first()
    )

    def check(parts):
        import pyarrow as pa

        head, held = None, None
        for part in parts:
            pivots, others = part.column(0).to_pylist(), part.column(1).to_pylist()
            out = []
            for pivot, other, text in zip(pivots, others, words.texts(part.column(2)), strict=True):
                if other is None:
                    head, held = pivot, shingles(text)
                elif pivot == head and similarity(held, shingles(text)) >= threshold:
                    out.append((pivot, other))
            a, b = zip(*out, strict=True) if out else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["pivot", "other"])

    return rows.select("pivot", "other", "text").mapInArrow(check, "pivot bigint, other bigint")


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root): the least node of each connected set of the edges (a, b).

    Large and small stars alternate, which takes a number of rounds logarithmic in the longest
    chain. Neighbours are only aggregated to their least, never gathered.
    """
    held = Scratch(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "edges")
    seen = None
    for _ in range(rounds):
        edges = held.rows
        # Large star: every larger neighbour of a node links to the least of its neighbourhood.
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("root"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("root").alias("b"))
        large = large.filter("a <> b").distinct()
        # Small star: the node and its smaller neighbours link to the least of them.
        least = large.groupBy("a").agg(F.min("b").alias("root"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("root").alias("b"))
        small = small.unionByName(least.select("a", F.col("root").alias("b"))).filter("a <> b").distinct()
        small = Scratch(small, "edges")
        held.remove()
        held = small
        mark = small.rows.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if mark == seen:
            return small.rows.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = mark
    raise RuntimeError(f"no stable components after {rounds} rounds")


def _rare_keys(h: int, n: int, elements: np.ndarray, counts: np.ndarray, seen: np.ndarray, threshold: float):
    """Keys of the shingles by which a document of `n` counts can meet a partner, and what is left from each on.

    `seen` tells how many documents have a shingle; those of this document alone are not among the
    elements. A key is a shingle and the size classes of both documents, so a partner of nearly the
    same size, which must share more, is met by fewer shingles.
    """
    order = np.lexsort((elements, seen))
    elements, counts = elements[order], counts[order]
    left = counts.sum() - np.cumsum(counts) + counts
    step = np.log(SIZE_RATIO)
    own = int(np.floor(np.log(n) / step + 1e-9))
    keys, rest = [], []
    for other in range(int(np.floor(np.log(n * threshold) / step)) - 1, int(np.floor(np.log(n / threshold) / step)) + 2):
        least = SIZE_RATIO**other * (1 - 1e-6)
        need = max(threshold / (1 + threshold) * (n + least), threshold * n) - 1e-6
        first = elements[left >= need].astype(np.uint64)
        # Classes of tiny documents may be negative.
        pair = np.uint64((min(own, other) + (1 << 20)) << 32 | max(own, other) + (1 << 20))
        keys.append(words.mix(first ^ words.mix(np.full(len(first), pair, dtype=np.uint64))))
        rest.append(left[: len(first)])
    return np.concatenate(keys).view(np.int64).tolist(), np.concatenate(rest).tolist()


def _rare_pairs(open_: DataFrame, texts: DataFrame, threshold: float) -> tuple[DataFrame, list[Scratch]]:
    """Pairs (pivot, other) of different `root` that may reach the threshold, and the tables they are read from.

    `open_` holds (h, root, rep). No pair at the threshold is missing. Shingles are counted map-side,
    and only those of two documents or more travel again. Within a key, documents of its most
    frequent root are only compared with those of other roots.
    """

    def compute(column):
        said = [shingles(text) for text in words.texts(column)]
        return [[e.view(np.int64).tolist() for e, _ in said], [c.tolist() for _, c in said], [int(c.sum()) for _, c in said]] if said else ([], [], [])

    wanted = open_.select(F.col("h").alias("said_h"), "root", "rep")
    rows = maybe_in(texts, F.col("h"), open_.select("h")).join(
        wanted, (F.col("h") == F.col("said_h")) & F.col("id").eqNullSafe(F.col("rep"))
    )
    held = Scratch(add_columns(rows, "elements array<bigint>, counts array<bigint>, n bigint", ["text"], compute, ["h", "root"]), "open-shingles")
    flat = held.rows.select("h", F.explode(F.arrays_zip("elements", "counts")).alias("x")).select("h", "x.elements", "x.counts")
    seen = flat.groupBy("elements").agg(
        F.count(F.lit(1)).alias("seen"), F.min("h").alias("low"), F.max("h").alias("high"), F.first("counts").alias("counts")
    )
    alone = F.col("low") == F.col("high")
    # `at` is the document of a shingle that no other has, else the shingle.
    seen = Scratch(seen.select(F.when(alone, F.col("low")).otherwise(F.col("elements")).alias("at"), F.when(alone, 1).otherwise(F.col("seen")).alias("seen"), "counts", alone.alias("alone")), "seen")
    lone = seen.rows.filter("alone").groupBy(F.col("at").alias("h")).agg(F.sum("counts").alias("lone"))
    able = held.rows.select("h", "n").distinct().join(lone, "h", "left").filter(
        F.col("n") - F.coalesce("lone", F.lit(0)) >= threshold * F.col("n") - 1e-6
    )
    able = Scratch(able.select("h"), "able")
    shared = seen.rows.filter("NOT alone").select(F.col("at").alias("elements"), "seen")
    mine = maybe_in(held.rows, F.col("h"), able.rows).join(able.rows, "h", "left_semi")
    flat = mine.select("h", "root", "n", F.explode(F.arrays_zip("elements", "counts")).alias("x"))
    flat = flat.select("h", "root", "n", "x.elements", "x.counts").join(shared, "elements")
    # One list holds the shingles of one document.
    listed = flat.groupBy("h", "root", "n").agg(F.collect_list(F.struct("elements", "counts", "seen")).alias("said"))

    def meet(hs, ns, said):
        keys, left = [], []
        starts = said.offsets.to_numpy() - said.offsets[0].as_py()
        inner = said.flatten()
        columns = [np.asarray(c) for c in inner.flatten()]
        for k, (h, n) in enumerate(zip(hs.to_pylist(), ns.to_pylist(), strict=True)):
            some = slice(starts[k], starts[k + 1])
            made = _rare_keys(h, n, *(c[some] for c in columns), threshold)
            keys.append(made[0])
            left.append(made[1])
        return keys, left

    met = add_columns(listed, "keys array<bigint>, rest array<bigint>", ["h", "n", "said"], meet, ["h", "root", "n"])
    met = met.select("h", "root", "n", F.explode(F.arrays_zip("keys", "rest")).alias("x")).select(
        F.col("x.keys").alias("key"), "h", "root", "n", F.col("x.rest").alias("rest")
    )
    met = Scratch(met, "rare-shingles")
    by_root = met.rows.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n_root"))
    main = by_root.groupBy("key").agg(F.max(F.struct("n_root", "root")).alias("main"), F.count(F.lit(1)).alias("n_roots"))
    main = main.filter("n_roots > 1").select("key", F.col("main.root").alias("main"))
    outer = met.rows.join(main, "key").filter("root <> main").toDF("key", "a", "a_root", "a_n", "a_rest", "main")
    pairs = outer.join(met.rows, "key").filter(
        (F.col("a_root") != F.col("root"))
        & ((F.col("root") == F.col("main")) | (F.col("a") < F.col("h")))
        & (F.least("a_rest", "rest") >= threshold / (1 + threshold) * (F.col("a_n") + F.col("n")) - 1e-6)
    )
    pairs = pairs.select(F.least("a", "h").alias("pivot"), F.greatest("a", "h").alias("other")).distinct()
    return pairs, [held, seen, able, met]


def near_links(texts: DataFrame, threshold: float = SIMILARITY, n_bands: int = BANDS, n_rows: int = ROWS) -> tuple[DataFrame | None, DataFrame | None]:
    """Links (a, b) between distinct texts that connect every class, and the classes.

    `texts` holds (id, h, text), where equal texts have an equal `h`.

    The members of a bucket are compared with its pivot. Members of buckets that are then in several
    classes are compared where their rarest shingles leave a link possible, so no link between classes
    is missed among texts that share a band.
    """
    spark = texts.sparkSession

    def compute(column):
        made, out = {}, []
        for text in words.texts(column):  # equal texts of a batch are signed once
            if text not in made:
                sign = signature(*shingles(text), n_bands * n_rows)
                made[text] = bands(sign, n_bands, n_rows), (sign & np.uint64(255)).astype(np.uint8).tobytes()
            out.append(made[text])
        return list(zip(*out, strict=True)) if out else ([], [])

    signs = add_columns(texts, "keys array<bigint>, sketch binary", ["text"], compute, ["h", "id"])
    signs = signs.groupBy("h").agg(F.first("keys").alias("keys"), F.first("sketch").alias("sketch"), F.min("id").alias("rep"))
    signed = Scratch(signs, "signatures")
    keyed = signed.rows.select("h", F.explode("keys").alias("key"))
    full = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("met")).filter("met > 1")
    met = Scratch(keyed.join(full, "key"), "met")
    degrees = met.rows.groupBy("h").agg(F.sum("met").alias("degree"))
    known = Scratch(signed.rows.select("h", "sketch", "rep").join(degrees, "h"), "sketches")
    members = Scratch(met.rows.select("key", "h").join(known.rows.select("h", "degree"), "h"), "buckets")
    reps = known.rows.select("h", "rep")
    sketches = known.rows.select("h", "sketch")
    for done in (signed, met):
        done.remove()
    release(spark)

    def confirmed(pairs: DataFrame) -> DataFrame:
        """Links (a, b): the pairs that reach the threshold."""
        sketched = (
            pairs.join(sketches.toDF("pivot", "pivot_sketch"), "pivot")
            .join(sketches.toDF("other", "sketch"), "other")
            .select("pivot", "other", "pivot_sketch", "sketch")
        )
        likely = Scratch(sketched.mapInArrow(lambda parts: _likely(parts, threshold), "pivot bigint, other bigint"), "likely")
        links = store(_verify(likely.rows, texts, reps, threshold).select(F.col("pivot").alias("a"), F.col("other").alias("b")), "links")
        likely.remove()
        return links

    pivots = members.rows.groupBy("key").agg(F.min(F.struct((-F.col("degree")).alias("order"), "h")).alias("pivot"))
    pivots = pivots.select("key", F.col("pivot.h").alias("pivot"))
    pairs = members.rows.join(pivots, "key").filter("h <> pivot").select("pivot", F.col("h").alias("other")).distinct()
    links = confirmed(pairs)
    if links.isEmpty():
        classes = None
        rooted = members.rows.select("key", "h", F.col("h").alias("root"))
    else:
        classes = components(links)
        rooted = members.rows.join(classes, F.col("h") == F.col("node"), "left").select(
            "key", "h", F.coalesce("root", "h").alias("root")
        )
    release(spark)
    mixed = rooted.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high")
    open_ = Scratch(rooted.join(mixed.select("key"), "key", "left_semi").select("h", "root").distinct().join(reps, "h"), "open")
    members.remove()
    if not open_.rows.isEmpty():
        pairs, tables = _rare_pairs(open_.rows, texts, threshold)
        more = confirmed(pairs)
        for done in tables:
            done.remove()
        release(spark)
        if not more.isEmpty():
            joined = more if classes is None else more.unionByName(classes.select(F.col("node").alias("a"), F.col("root").alias("b")))
            classes = components(joined)
            links = links.unionByName(more)
    open_.remove()
    return (None, None) if classes is None else (links, classes)


def near_classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = SIMILARITY,
    n_bands: int = BANDS,
    n_rows: int = ROWS,
) -> DataFrame:
    """Every row's id with the class of its text.

    Result: `id`, `text_hash`, `class_id` (the least id in the class), `class_size` (rows) and
    `keep` (true on one row's id and text for each class: the least id, then the least hash).

    Texts are linked when their shingle counts have a weighted Jaccard similarity of `threshold` or
    more, and classes are the connected sets. Equal texts always share a class; null is equal to
    null only. Texts without words have no links. Null ids come first; rows equal in id and text
    share all results, so `remove_near` keeps one of them. An empty table gives no rows.
    """
    rows = docs.select(
        col(id_col).alias("id"),
        col(text_col).alias("text"),
        F.when(col(text_col).isNull(), F.xxhash64(F.lit("null"), F.lit(0))).otherwise(F.xxhash64(col(text_col))).alias("h"),
    )
    _, classes = near_links(rows.filter("text IS NOT NULL"), threshold, n_bands, n_rows)
    named = rows.select("id", F.col("h").alias("text_hash"), F.col("h").alias("root"))
    if classes is not None:
        named = rows.select("id", "h").join(classes, F.col("h") == F.col("node"), "left").select(
            "id", F.col("h").alias("text_hash"), F.coalesce("root", "h").alias("root")
        )
    named = store(named, "classed")
    least = named.groupBy("root").agg(
        F.min(F.struct("id", "text_hash")).alias("least"), F.count("*").alias("class_size")
    )
    return named.join(least, "root").select(
        "id",
        "text_hash",
        F.col("least.id").alias("class_id"),
        "class_size",
        (F.col("id").eqNullSafe(F.col("least.id")) & (F.col("text_hash") == F.col("least.text_hash"))).alias("keep"),
    )


def remove_near(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One document of each class, with the columns of `docs`: the least id."""
    kept = near_classes(docs, id_col, text_col, **options).filter("keep").select(
        F.col("id").alias("__near_id"), F.col("text_hash").alias("__near_hash")
    ).distinct()
    text = col(text_col)
    hashed = docs.withColumn(
        "__near_text_hash", F.when(text.isNull(), F.xxhash64(F.lit("null"), F.lit(0))).otherwise(F.xxhash64(text))
    )
    joined = hashed.join(kept, col(id_col).eqNullSafe(F.col("__near_id")) & (F.col("__near_text_hash") == F.col("__near_hash")))
    # Rows equal in id and text: one of them stays.
    unique = joined.dropDuplicates(["__near_text_hash", id_col])
    return unique.select(*(col(c) for c in docs.columns))
