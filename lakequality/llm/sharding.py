"""Shards of near equal size from sampled splitters.

A key is the hash of a text, so equal texts are neighbours and stay together unless they outgrow a
range. Splitters come from a sample of keys drawn with weight by size; ranges between them are then
measured, the overfull ones are cut finer, and whole ranges are dealt to the shards, largest first.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakequality.llm.tables import col, small, store

KEY_BITS = 64


def record_size(text: Column) -> Column:
    return (F.octet_length(F.coalesce(text, F.lit(""))) + 1).cast("long")


def uniform(*parts: Column) -> Column:
    """A repeatable number in (0, 1) from the values of columns."""
    top = F.shiftrightunsigned(F.xxhash64(*parts), 11)
    return (top.cast("double") + 0.5) / float(1 << 53)


def splitters(rows: DataFrame, total: int, n_ranges: int, samples: int) -> list[int]:
    """Boundaries of ranges with near equal sums of `size`, from a weighted sample of `key`.

    Each row draws an exponential time divided by its size; the earliest `samples` rows are a sample
    without replacement in which a row's chance follows its size. `samples` bounds what the driver
    holds, whatever the input. Before a time that follows from `total`, the sum of sizes, about twice
    as many rows come, so tasks send no more than those.
    """
    time = -F.ln(uniform(F.col("key"), F.col("tie"))) / F.col("size")
    early = rows.select("key", time.alias("t")).filter(F.col("t") < 2.0 * samples / max(1, total))
    drawn = [r.key for r in early.orderBy("t", "key").limit(samples).collect()]
    drawn.sort()
    cuts = {drawn[len(drawn) * k // n_ranges] for k in range(1, n_ranges)} if drawn else set()
    return sorted(cuts)


def _range_of(cuts: list[int]) -> Column:
    """The number of boundaries at or below the key."""
    if not cuts:
        return F.lit(0)
    bounds = F.split(F.lit(",".join(map(str, cuts))), ",").cast("array<bigint>")
    return F.size(F.filter(bounds, lambda b: b <= F.col("key")))


def _deal(sizes: dict, n_shards: int) -> dict:
    """Ranges to shards, largest first, each to the shard that is smallest so far."""
    heap = [(0, shard) for shard in range(n_shards)]
    place = {}
    for name, size in sorted(sizes.items(), key=lambda item: (-item[1], item[0])):
        filled, shard = heapq.heappop(heap)
        place[name] = shard
        heapq.heappush(heap, (filled + size, shard))
    return place


def _bundles(sizes: dict, full: int) -> dict:
    """Pieces by what is dealt whole: the pieces of one text together while they fit in a shard."""
    out, filled, last = {}, 0, None
    for name, size in sorted(sizes.items()):
        kind, key, _ = name.split(":")
        if kind == "r":
            out[name] = [name]
            continue
        if key != last or filled + size > full:
            bundle, filled = [], 0
            out[name], last = bundle, key
        bundle.append(name)
        filled += size
    return out


def assign(
    docs: DataFrame,
    n_shards: int = 8,
    ranges_per_shard: int = 64,
    samples_per_range: int = 32,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Every record with its size, shard and slot.

    Result: the id column, `size` (UTF-8 bytes of the text plus one), `text_crc32`, `key`, `piece`
    (the range, cut finer where it was overfull), `shard` and `slot` (0, 1, ... in each shard, by
    piece, key and id).

    The driver holds `n_shards * ranges_per_shard * samples_per_range` keys, and at most a few sizes
    for each range: heavy texts, those that fill half a range, number at most twice the ranges. Equal
    texts stay in one shard while they fit in one; a group beyond that is cut by id into as many shards
    as it fills. Groups over a quarter of a shard are ranked in several pieces. Null texts count
    as empty, null ids are ordinary values that come first, repeated rows each get a slot of their
    own, an empty table gives no rows, and other columns are not read.
    """
    spark = docs.sparkSession
    text = F.coalesce(col(text_col), F.lit(""))
    rows = store(
        docs.select(
            col(id_col).alias("id"),
            record_size(col(text_col)).alias("size"),
            F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
            F.xxhash64(text).alias("key"),
            F.xxhash64(col(id_col).cast("string"), F.lit("tie")).alias("tie"),
        ),
        "records",
    )
    n_ranges = n_shards * ranges_per_shard
    total = rows.agg(F.sum("size").alias("s")).first().s or 0
    cuts = splitters(rows, total, n_ranges, n_ranges * samples_per_range)
    fair = max(1, total // n_ranges)
    full = max(1, total // n_shards)

    # Texts that fill half a range or more, all copies taken together, become ranges of their own;
    # large ones are cut into pieces by id, so no task ranks a whole shard.
    heavy = rows.groupBy("key").agg(F.sum("size").alias("s")).filter(F.col("s") * 2 >= fair)
    alone = {r.key: -(-r.s // fair) if r.s > full // 4 else 1 for r in heavy.collect()}
    ranged = rows.withColumn("range", _range_of(cuts))
    if alone:
        named = [{"key": k, "heavy_parts": n} for k, n in sorted(alone.items())]
        table = small(spark, named, "key: bigint, heavy_parts: bigint")
        ranged = ranged.join(table, "key", "left")
    else:
        ranged = ranged.withColumn("heavy_parts", F.lit(None).cast("bigint"))

    # Light rows: a range over its fair size is cut into equal stretches of keys.
    light = ranged.filter("heavy_parts IS NULL").groupBy("range").agg(F.sum("size").alias("s"))
    low, high = -(1 << (KEY_BITS - 1)), (1 << (KEY_BITS - 1)) - 1
    edges = [low, *cuts, high]
    parts = {r.range: -(-r.s // fair) for r in light.collect()}
    steps = [(edges[k + 1] - edges[k]) // parts.get(k, 1) + 1 for k in range(len(cuts) + 1)]
    starts = F.split(F.lit(",".join(map(str, edges[:-1]))), ",").cast("array<decimal(20,0)>")
    step = F.split(F.lit(",".join(map(str, steps))), ",").cast("array<decimal(20,0)>")
    at = F.col("range") + 1
    finer = F.floor(
        (F.col("key").cast("decimal(20,0)") - F.element_at(starts, at)) / F.element_at(step, at)
    ).cast("bigint")
    piece = F.when(
        F.col("heavy_parts").isNull(), F.concat_ws(":", F.lit("r"), "range", finer)
    ).otherwise(
        F.concat_ws(":", F.lit("t"), "key", F.pmod("tie", F.col("heavy_parts")))
    )
    ranged = ranged.select("id", "size", "text_crc32", "key", "tie", piece.alias("piece"))

    sizes = {r.piece: (r.s, r.n) for r in ranged.groupBy("piece").agg(F.sum("size").alias("s"), F.count("*").alias("n")).collect()}
    bundles = _bundles({p: s for p, (s, _) in sizes.items()}, full)
    dealt = _deal({b: sum(sizes[p][0] for p in some) for b, some in bundles.items()}, n_shards)
    place = {p: dealt[b] for b, some in bundles.items() for p in some}
    used, table = [0] * n_shards, []
    for name in sorted(place):
        table.append({"piece": name, "shard": place[name], "first_slot": used[place[name]]})
        used[place[name]] += sizes[name][1]
    where = small(spark, table, "piece: string, shard: int, first_slot: bigint")
    in_piece = Window.partitionBy("piece").orderBy("key", "id", "text_crc32")
    return (
        ranged.withColumn("rank", F.row_number().over(in_piece))
        .join(where, "piece")
        .select(
            F.col("id").alias(id_col),
            "size",
            "text_crc32",
            "key",
            "piece",
            "shard",
            (F.col("first_slot") + F.col("rank") - 1).alias("slot"),
        )
    )
