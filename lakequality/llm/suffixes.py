"""Bytes that repeat 50 bytes of an earlier document, by external suffix sorting.

A byte goes when it lies in a string of `length` bytes that also starts in a document of smaller id.
Sorting every suffix of a corpus would move many times its size, so an exact filter comes first:

1. Every string of `length` bytes has an anchor, the least hash of its 20-byte substrings, so equal
   strings have equal anchors. Neighbouring strings mostly share one; a text has an anchor for about
   every seventeen bytes. Anchors travel packed, about seven bytes each, and the documents learn which
   of theirs another document has too. Anchors that meet in one packet need no answer, so a passage
   in very many documents is one entry for each packet.
2. Only stretches of text around shared anchors move on, each to the shard of its anchor, so that
   all places of a string meet in one shard. Equal stretches are one, with their least id.
3. An anchor with one stretch alone needs no sort: its strings have the least id of that stretch. Of
   the others, a shard sorts the suffixes of its stretches by induced sorting (`induced.py`), in
   memory, and gives every string the least id it occurs with. One sort holds less than twice
   `SHARD_BYTES` of text and `SHARD_ROWS` stretches, with its places and prefixes. An anchor of more stretches than that is
   no group of its own: its strings are, each with the least id it occurs with.
4. Places with a larger id than that are removed.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakequality.llm import words
from lakequality.llm.induced import sorted_suffixes
from lakequality.llm.tables import Scratch, add_columns, col, small, store

LENGTH = 50
GRAM = 20  # longer ones are shared by chance less often; shorter ones make fewer anchors
PACKET = 1 << 18  # anchors in one packet
SHARD_BYTES = 6 << 20  # text of one suffix sort; a shard of more is sorted in several, cut between anchors
ANCHOR_GROUPS = 1 << 16  # groups of anchors whose text is summed to find those of more than SHARD_BYTES
PART_BYTES = 64 << 20  # text whose anchors meet in one part
ANSWER_RANGES = 32  # ranges of hashes into which a part is cut while its anchors meet
CHUNK_BYTES, CHUNK_TEXTS = 4 << 20, 1 << 15  # texts worked on at once, and their numbers beside an anchor in 64 bits
SHARD_ROWS = 1 << 13  # stretches told apart by anchor at once
PIECE = 1 << 18  # bytes of a text hashed at once
LONGEST = 64  # places in one stretch
_HASH_BITS = 48


def _least_in_windows(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every `width` consecutive values."""
    out, span = values, 1
    while 2 * span <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    if span < width:
        out = np.minimum(out[: span - width], out[width - span :])
    return out


def anchors(text: bytes | None, length: int = LENGTH) -> np.ndarray:
    """The anchor of every string of `length` bytes, in order of its start."""
    data, gram = words.as_bytes(text), min(GRAM, length)
    out = np.empty(max(0, len(data) - length + 1), dtype=np.uint64)
    # A string's hash depends on its bytes alone, so a long text is hashed in overlapping pieces.
    for first in range(0, len(out), PIECE):
        piece = data[first : first + PIECE + length - 1]
        sums = np.zeros(len(piece) + 1, dtype=np.uint64)
        np.cumsum((piece.astype(np.uint64) + np.uint64(1)) * words.powers(words.BASE, len(piece)), out=sums[1:])
        count = len(piece) - gram + 1
        grams = words.mix((sums[gram:] - sums[:count]) * words.powers(words.INVERSE, count))
        out[first : first + PIECE] = _least_in_windows(grams, length - gram + 1) >> np.uint64(64 - _HASH_BITS)
    return out


def _names(text: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The hash of each stretch, piece by piece of the text; starts and ends ascend."""
    data = words.as_bytes(text)
    cuts = np.searchsorted(starts, np.arange(0, len(data) + PIECE, PIECE))
    some = [(a, b) for a, b in zip(cuts[:-1], cuts[1:], strict=True) if a < b]
    found = [words.hashes(data[starts[a] : ends[b - 1]], starts[a:b] - starts[a], ends[a:b] - starts[a]) for a, b in some]
    return np.concatenate(found).view(np.int64)


def _planes(values: np.ndarray, width: int) -> bytes:
    """Integers byte plane by byte plane: equal high bytes stand together and compress away."""
    raw = np.ascontiguousarray(values.astype("<u8")).view(np.uint8).reshape(-1, 8)
    return np.ascontiguousarray(raw[:, :width].T).tobytes()


def _unplaned(raw, width: int, first: int = 0, end: int | None = None) -> np.ndarray:
    planes = np.frombuffer(raw, dtype=np.uint8).reshape(width, -1)[:, first:end]
    out = np.zeros((planes.shape[1], 8), dtype=np.uint8)
    out[:, :width] = planes.T
    return out.reshape(-1).view("<u8").astype(np.uint64)


def _chunks(texts: list[bytes | None]) -> Iterator[tuple[int, int, bytes, np.ndarray]]:
    """Texts joined to one of about CHUNK_BYTES: (first, end, joined, edges), where text k of them is edges[k] to edges[k + 1].

    NumPy then works on many texts at once. A text of more bytes may be a chunk of its own.
    """
    first, held = 0, 0
    for k, text in enumerate(texts):
        size = len(text or b"")
        if k > first and (held + size > CHUNK_BYTES or k - first == CHUNK_TEXTS):
            yield _joined(texts, first, k)
            first, held = k, 0
        held += size
    if first < len(texts):
        yield _joined(texts, first, len(texts))


def _joined(texts: list[bytes | None], first: int, end: int) -> tuple[int, int, bytes, np.ndarray]:
    some = [text or b"" for text in texts[first:end]]
    return first, end, b"".join(some), np.cumsum([0, *map(len, some)], dtype=np.int64)


def _runs(found: np.ndarray, edges: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of strings with one anchor in the texts of a chunk: first string, end, and the text's number."""
    ends = np.maximum(edges[1:] - length + 1, edges[:-1])  # strings from here on reach into the next text
    new = np.ones(len(found) + 1, dtype=bool)
    np.not_equal(found[1:], found[:-1], out=new[1:-1])
    borders = np.concatenate((edges[:-1], ends))
    new[borders[borders < len(found)]] = True
    at = np.flatnonzero(new)
    starts, stops = at[:-1], at[1:]
    of = np.searchsorted(edges, starts, side="right") - 1
    inside = starts < ends[of]
    return starts[inside], stops[inside], of[inside]


def _keys(of: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """A text's number in its chunk and an anchor as one integer."""
    return of.astype(np.uint64) << np.uint64(_HASH_BITS) | hashes.astype(np.uint64)


def _bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """Where the values of an Arrow column of bytes begin and the last ends, and all their bytes."""
    import pyarrow as pa

    column = (column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).cast(pa.large_binary())
    if not len(column):
        return np.zeros(1, dtype=np.int64), np.zeros(0, dtype=np.uint8)
    _, edges, data = column.buffers()
    edges = np.frombuffer(edges, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data or b"", dtype=np.uint8)[edges[0] : edges[-1]]
    return edges - edges[0], data


def _binary(edges: np.ndarray, data: np.ndarray):
    """The Arrow column of bytes that `_bytes` takes apart."""
    import pyarrow as pa

    parts = [None, pa.py_buffer(edges.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))]
    return pa.Array.from_buffers(pa.binary(), len(edges) - 1, parts)


def _packets(parts, n_parts: int, length: int):
    """Packed anchors by part: (part, known, rows, places, hashes)."""
    import pyarrow as pa

    waiting: list[tuple[np.ndarray, np.ndarray]] = []
    held = 0

    def flush():
        rows = np.concatenate([r for r, _ in waiting])
        before = np.cumsum([0, *(len(r) for r, _ in waiting)], dtype=np.uint64)
        at = np.concatenate([(k >> np.uint64(_HASH_BITS)) + n for (_, k), n in zip(waiting, before, strict=False)])
        hashes = np.concatenate([k for _, k in waiting]) & np.uint64((1 << _HASH_BITS) - 1)
        order = np.argsort(hashes)
        at, hashes = at[order], hashes[order]
        same = np.zeros(len(hashes) + 1, dtype=bool)
        same[1:-1] = hashes[1:] == hashes[:-1]
        again = same[:-1]  # a later document of the packet
        met = again | same[1:]
        asked = ~again
        out = []
        for known, take in ((False, asked), (True, met)):
            h, p = hashes[take], at[take]
            if known:  # these meet nobody, so any part may carry them back
                part = (words.mix(p + np.uint64(1)) % np.uint64(n_parts)).astype(np.int64)
                order = np.argsort(part, kind="stable")
                h, p, part = h[order], p[order], part[order]
            else:
                part = ((h >> np.uint64(_HASH_BITS - 32)) * np.uint64(n_parts) >> np.uint64(32)).astype(np.int64)
            cuts = np.searchsorted(part, np.arange(n_parts + 1))
            for k in np.flatnonzero(np.diff(cuts)).tolist():
                a, b = cuts[k], cuts[k + 1]
                used, place = np.unique(p[a:b], return_inverse=True)
                out.append((k, known, rows[used.astype(np.int64)].tobytes(), _planes(place, 3), _planes(h[a:b], 6)))
        columns = list(zip(*out, strict=True))
        kinds = [pa.int32(), pa.bool_(), pa.binary(), pa.binary(), pa.binary()]
        for first in range(0, len(out), 64):
            yield pa.RecordBatch.from_arrays(
                [pa.array(c[first : first + 64], k) for c, k in zip(columns, kinds, strict=True)],
                names=["part", "known", "rows", "places", "hashes"],
            )

    for part in parts:
        rows = part.column(0).to_numpy()
        for first, end, text, edges in _chunks(words.texts(part.column(1))):
            found = anchors(text, length)
            starts, _, of = _runs(found, edges, length)
            keys = np.sort(_keys(of, found[starts]))
            if len(keys):
                keys = keys[np.concatenate(([True], keys[1:] != keys[:-1]))]
                waiting.append((rows[first:end], keys))
                held += len(keys)
                if held >= PACKET:
                    yield from flush()
                    waiting, held = [], 0
    if waiting:
        yield from flush()


def _answers(parts, n_parts: int):
    """The anchors of each part that several documents have: (row, hashes).

    A part is held as it came, packed, about nine bytes an anchor.
    """
    import pyarrow as pa

    def rows_of(rows: np.ndarray, hashes: np.ndarray):
        order = np.argsort(rows, kind="stable")
        rows, hashes = rows[order], hashes[order]
        heads = np.concatenate(([0], np.flatnonzero(rows[1:] != rows[:-1]) + 1))
        bounds = np.append(heads, len(rows)).astype(np.int32)
        for first in range(0, len(heads), 4096):
            cut = bounds[first : first + 4097]
            values = pa.array(hashes[cut[0] : cut[-1]].astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows[cut[:-1]]), pa.ListArray.from_arrays(pa.array(cut - cut[0]), values)],
                names=["row", "hashes"],
            )

    def met(pieces):
        # One range of hashes after another, so what is unpacked is a bounded share of the part.
        for k in range(ANSWER_RANGES):
            who, what = [], []
            for rows, places, hashes, cuts in pieces:
                a, b = cuts[k], cuts[k + 1]
                if a < b:
                    who.append(np.frombuffer(rows, dtype=np.int64)[_unplaned(places, 3, a, b).astype(np.int64)])
                    what.append(_unplaned(hashes, 6, a, b))
            if what:
                who, what = np.concatenate(who), np.concatenate(what)
                twice = words.repeated(what)
                if twice.any():
                    yield from rows_of(who[twice], what[twice])

    now, pieces = None, []
    for part in parts:
        for number, known, rows, places, hashes in zip(*(c.to_pylist() for c in part.columns), strict=True):
            if number != now:
                yield from met(pieces)
                now, pieces = number, []
            what = _unplaned(hashes, 6)
            if known:
                yield from rows_of(np.frombuffer(rows, dtype=np.int64)[_unplaned(places, 3).astype(np.int64)], what)
            else:  # a piece comes in the order of its hashes
                low, high = (-(-(k << 32) // n_parts) << _HASH_BITS - 32 for k in (number, number + 1))
                edges = [low + (high - low) * k // ANSWER_RANGES for k in range(1, ANSWER_RANGES)]
                cuts = [0, *np.searchsorted(what, np.array(edges, dtype=np.uint64)).tolist(), len(what)]
                pieces.append((rows, places, hashes, cuts))
    yield from met(pieces)


def _stretches(parts, length: int):
    """Text around shared anchors, each once for a chunk, and where it stands.

    Rows with `said` hold a stretch with the least and largest id of its places; rows without hold
    one place. Columns: anchor, name, said, least, most, row, id, at.
    """
    import pyarrow as pa

    names = ["anchor", "name", "said", "least", "most", "row", "id", "at"]
    for part in parts:
        rows, ids = part.column(0).to_numpy(), part.column(1).to_numpy()
        lists = part.column(3)
        asked, cuts = lists.values.to_numpy(), lists.offsets.to_numpy()
        for first, end, text, edges in _chunks(words.texts(part.column(2))):
            found = anchors(text, length)
            # Runs of strings with one anchor that is shared, cut to a bounded length.
            starts, stops, of = _runs(found, edges, length)
            shared = np.repeat(np.arange(end - first), np.diff(cuts[first : end + 1]))
            shared = np.sort(_keys(shared, asked[cuts[first] : cuts[end]]))
            keys = _keys(of, found[starts])
            wanted = np.append(shared, ~np.uint64(0))[np.searchsorted(shared, keys)] == keys
            starts, stops, of = starts[wanted], stops[wanted], of[wanted]
            pieces = -(-(stops - starts) // LONGEST)
            nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            starts = np.repeat(starts, pieces) + nth * LONGEST
            ends = np.minimum(starts + LONGEST, np.repeat(stops, pieces)) - 1 + length
            if not len(starts):
                continue
            of = np.repeat(of, pieces)
            name, anchor, id_ = _names(text, starts, ends), found[starts].astype(np.int64), ids[first:end][of]
            # Equal stretches are one row, in the order of the text, where neighbours overlap and compress.
            order = np.argsort(name, kind="stable")
            differ = (name[order][1:] != name[order][:-1]) | (anchor[order][1:] != anchor[order][:-1])
            heads = np.concatenate(([0], np.flatnonzero(differ) + 1))
            by_text = np.argsort(order[heads])
            once = order[heads][by_text]
            least, most = np.minimum.reduceat(id_[order], heads)[by_text], np.maximum.reduceat(id_[order], heads)[by_text]
            data = words.as_bytes(text)
            for k in range(0, len(once), 10000):
                cut, some = slice(k, k + 10000), once[k : k + 10000]
                sizes = ends[some] - starts[some]
                at = np.append(0, np.cumsum(sizes))
                said = _binary(at, data[np.repeat(starts[some] - at[:-1], sizes) + np.arange(at[-1])])
                columns = [pa.array(anchor[some]), pa.array(name[some]), said, pa.array(least[cut]), pa.array(most[cut])]
                nothing = [pa.nulls(len(some), kind) for kind in (pa.int64(), pa.int64(), pa.int32())]
                yield pa.RecordBatch.from_arrays(columns + nothing, names=names)
            row, at = rows[first:end][of], (starts - edges[of]).astype(np.int32)
            for k in range(0, len(starts), 10000):
                cut = slice(k, k + 10000)
                nothing = [pa.nulls(len(at[cut]), kind) for kind in (pa.binary(), pa.int64(), pa.int64())]
                columns = [pa.array(anchor[cut]), pa.array(name[cut]), *nothing, pa.array(row[cut]), pa.array(id_[cut]), pa.array(at[cut])]
                yield pa.RecordBatch.from_arrays(columns, names=names)


def _sort_shard(said, least: np.ndarray, most: np.ndarray, length: int):
    """For each stretch the runs of its strings: first, last, and the least id each occurs with."""
    edges, data = _bytes(said)
    sizes = np.diff(edges)
    first = edges[:-1] + np.arange(len(sizes))
    # UTF-8 has no byte 255, so bytes move up by one and zero ends a stretch.
    text = np.zeros(len(data) + len(sizes), dtype=np.uint8)
    body = np.ones(len(text), dtype=bool)
    body[first + sizes] = False
    text[body] = data + np.uint8(1)
    of = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes + 1)
    # Of each stretch the places where a whole string starts; the others and the separator are `length`.
    counts = np.column_stack((sizes - length + 1, np.full(len(sizes), length))).ravel()
    whole = np.repeat(np.tile([True, False], len(sizes)), counts)
    places, groups, group = [], [], 0
    for place, common in sorted_suffixes(text, length):
        number = group + np.cumsum(common < length)
        group = int(number[-1])
        take = whole[place]
        places.append(place[take])
        groups.append(number[take])
    places, groups = np.concatenate(places), np.concatenate(groups)
    heads = np.concatenate(([0], np.flatnonzero(groups[1:] != groups[:-1]) + 1))
    smallest = np.minimum.reduceat(least[of[places]], heads)
    best = np.empty(len(text), dtype=np.int64)
    best[places] = np.repeat(smallest, np.diff(np.append(heads, len(places))))
    order = np.flatnonzero(whole)
    # Runs of neighbouring strings of a stretch with one least id.
    cut = np.concatenate(([True], (of[order][1:] != of[order][:-1]) | (best[order][1:] != best[order][:-1])))
    begin = order[cut]
    end = order[np.append(np.flatnonzero(cut)[1:], len(order)) - 1]
    whose, least_id = of[begin], best[begin]
    useful = least_id < most[whose]
    return whose[useful], (begin - first[whose])[useful], (end - first[whose])[useful], least_id[useful]


def _shards(parts, length: int):
    """Sorted stretches in, (anchor, name, first, last, least) out."""
    import pyarrow as pa

    def ranges(anchor, name, first, last, least):
        columns = [anchor, name, first.astype(np.int32), last.astype(np.int32), least]
        for k in range(0, len(anchor), 10000):
            yield pa.RecordBatch.from_arrays(
                [pa.array(c[k : k + 10000]) for c in columns], names=["anchor", "name", "first", "last", "least_id"]
            )

    def flush(tables):
        rows = pa.concat_tables(tables).combine_chunks()
        anchor, name, least, most = (rows.column(c).to_numpy() for c in ("anchor", "name", "least", "most"))
        whose, begin, end, least = _sort_shard(rows.column("said"), least, most, length)
        return ranges(anchor[whose], name[whose], begin, end, least)

    waiting, n_waiting, rows, held, alone, n_alone = [], 0, [], 0, [], 0
    for part in itertools.chain(parts, [None]):
        if part is not None:
            waiting.append(pa.Table.from_batches([part]))
            n_waiting += part.num_rows
            if n_waiting < SHARD_ROWS:
                continue
        some = pa.concat_tables(waiting).combine_chunks() if waiting else None
        waiting, n_waiting = [], 0
        if some is not None and len(some):
            anchor = some.column("anchor").to_numpy()
            cut = np.concatenate(([0], np.flatnonzero(anchor[1:] != anchor[:-1]) + 1, [len(anchor)]))
            if part is not None:  # the last anchor may go on
                waiting, cut = [some.slice(cut[-2])], cut[:-1]
            several = np.repeat(np.diff(cut) > 1, np.diff(cut))
            some = some.slice(0, cut[-1])
            more = some.filter(pa.array(several))
            if len(more):
                rows.append(more)
                held += len(_bytes(more.column("said"))[1])
            # The only stretch of its anchor: its strings occur nowhere else, so nothing is to sort.
            one = some.filter(pa.array(~several))
            anchor, name, least, most = (one.column(c).to_numpy() for c in ("anchor", "name", "least", "most"))
            take = least < most
            size = np.diff(_bytes(one.column("said"))[0])
            alone.append([c[take] for c in (anchor, name, np.zeros(len(take)), size - length, least)])
            n_alone += int(take.sum())
        if rows and (held >= SHARD_BYTES or part is None):
            yield from flush(rows)
            rows, held = [], 0
        if n_alone >= 10000 or (part is None and n_alone):
            yield from ranges(*map(np.concatenate, zip(*alone, strict=True)))
            alone, n_alone = [], 0


def _heavy(said: DataFrame, limit: int) -> DataFrame | None:
    """Anchors with more than `limit` bytes of stretches, of which there are few; None without any.

    Sums of groups of anchors come first, a bounded number of rows for each task. A stretch that
    several batches hold counts for each, so some anchors may be heavy that need not be.
    """
    group, size = F.pmod(F.xxhash64("anchor"), F.lit(ANCHOR_GROUPS)), F.sum(F.octet_length("said"))
    sums = said.groupBy(group.alias("group")).agg(size.alias("n")).filter(F.col("n") > limit)
    groups = [r.group for r in sums.select("group").collect()]
    if not groups:
        return None
    maybe = said.join(small(said.sparkSession, [{"group": g} for g in groups], "group: bigint"), group == F.col("group"), "left_semi")
    return store(maybe.groupBy("anchor").agg(size.alias("n")).filter(F.col("n") > limit).select("anchor"), "heavy-anchors")


def _least_by_string(said: DataFrame, length: int) -> DataFrame:
    """What `_shards` gives, from an aggregate by whole strings; no group holds more than a stretch."""
    one = said.groupBy("anchor", "name").agg(F.first("said").alias("said"), F.min("least").alias("least"), F.max("most").alias("most"))
    starts = F.sequence(F.lit(1), F.octet_length("said") - length + 1)
    strings = one.select("anchor", "name", "least", "most", "said", F.explode(starts).alias("at")).select(
        "anchor", "name", "least", "most", (F.col("at") - 1).cast("int").alias("first"), F.expr(f"substring(said, at, {length})").alias("string")
    )
    strings = store(strings, "strings-of-heavy-anchors")
    found = strings.groupBy("string").agg(F.min("least").alias("least_id"))
    found = strings.join(found, "string").filter("least_id < most").select("anchor", "name", "first", "least_id")
    # Runs of neighbouring strings of a stretch with one least id.
    place = F.row_number().over(Window.partitionBy("anchor", "name", "least_id").orderBy("first"))
    runs = found.withColumn("run", F.col("first") - place).groupBy("anchor", "name", "least_id", "run")
    return runs.agg(F.min("first").alias("first"), F.max("first").alias("last")).select("anchor", "name", "first", "last", "least_id")


def find_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, heavy_bytes: int = SHARD_BYTES) -> DataFrame:
    """Byte ranges to remove: (row, spans), unmerged, for rows that lose any.

    An anchor with more than `heavy_bytes` of stretches is resolved string by string.

    `row` is the hash of a row's id and text.
    """
    text = F.coalesce(col(text_col).cast("string"), F.lit(""))
    rows = docs.select(
        F.xxhash64(col(id_col), text).alias("row"),
        F.coalesce(col(id_col).cast("bigint"), F.lit(-(1 << 63))).alias("id"),
        text.alias("text"),
    ).filter(F.octet_length("text") >= length)
    total = rows.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    n_parts = max(8, -(-total // PART_BYTES))
    packets = rows.select("row", "text").mapInArrow(
        lambda parts: _packets(parts, n_parts, length), "part int, known boolean, rows binary, places binary, hashes binary"
    )
    answers = (
        packets.repartition(n_parts, "part").sortWithinPartitions("part").mapInArrow(
            lambda parts: _answers(parts, n_parts), "row bigint, hashes array<bigint>"
        )
    )
    answers = Scratch(answers, "answers", clean=True)
    shared = answers.rows.groupBy("row").agg(F.flatten(F.collect_list("hashes")).alias("hashes"))
    stretches = Scratch(
        rows.join(shared, "row").select("row", "id", "text", "hashes").mapInArrow(
            lambda parts: _stretches(parts, length),
            "anchor bigint, name bigint, said binary, least bigint, most bigint, row bigint, id bigint, at int",
        ),
        "stretches",
        clean=True,
    )
    answers.remove()
    # Partitioned by anchor alone, so the sums below need no other exchange and come in its order.
    every = stretches.rows.filter("said IS NOT NULL").select("anchor", "name", "said", "least", "most")
    heavy = _heavy(every, heavy_bytes)
    light = every if heavy is None else every.join(heavy, "anchor", "left_anti")
    said = (
        light.repartition("anchor")
        .groupBy("anchor", "name")
        .agg(F.first("said").alias("said"), F.min("least").alias("least"), F.max("most").alias("most"))
        .sortWithinPartitions("anchor", "name")
    )
    found = said.mapInArrow(
        lambda parts: _shards(parts, length), "anchor bigint, name bigint, first int, last int, least_id bigint"
    )
    if heavy is not None:
        found = found.unionByName(_least_by_string(every.join(heavy, "anchor", "left_semi"), length))
    # Stored before the places move, so the text of a stretch and its places are never on the way at once.
    found = Scratch(found, "least-ids", clean=True)
    places = stretches.rows.filter("said IS NULL").select("anchor", "name", "row", "id", "at")
    spans = (
        places.join(found.rows, ["anchor", "name"])
        .filter("least_id < id")
        .select("row", F.struct((F.col("at") + F.col("first")).alias("start"), (F.col("at") + F.col("last") + length).alias("end")).alias("span"))
        .groupBy("row")
        .agg(F.collect_set("span").alias("spans"))
    )
    spans = Scratch(spans, "repeat-spans", clean=True).rows
    found.remove()
    stretches.remove()
    return spans


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, keep: list[str] | None = None
) -> DataFrame:
    """The documents with the bytes that stay.

    Adds `n_bytes`, `removed` (start and end of every maximal removed run of bytes) and `kept` (the
    remaining bytes, which may cut a character); input columns of these names are replaced. Strings
    are judged on the input, and matches never cross documents.

    Ids are integers, null the smallest; rows of one id do not remove from each other, and rows equal
    in id and text share a result. Null texts are empty, texts shorter than `length` stay whole, an
    empty table gives no rows, and texts of any length are read whole.
    """
    spans = find_repeats(docs, id_col, text_col, length)
    passed = [c for c in (docs.columns if keep is None else keep)]
    text = F.coalesce(col(text_col).cast("string"), F.lit(""))
    rows = docs.withColumn("__row", F.xxhash64(col(id_col), text)).withColumn("__text", text)
    joined = rows.join(spans.select(F.col("row").alias("__row"), F.col("spans").alias("__spans")), "__row", "left")

    def compute(texts, found):
        import pyarrow as pa

        edges, data = _bytes(texts)
        # A place for the end of each text keeps ranges of neighbouring texts apart.
        places = edges[:-1] + np.arange(len(texts))
        cuts = found.offsets.to_numpy()
        spans = found.values.slice(cuts[0], cuts[-1] - cuts[0])
        shift = np.repeat(places, np.diff(cuts))
        starts, ends = (spans.field(k).to_numpy().astype(np.int64) + shift for k in (0, 1))
        order = np.argsort(starts)
        starts, ends = starts[order], np.maximum.accumulate(ends[order])
        # Maximal runs: ranges that overlap or touch are one.
        new = np.flatnonzero(starts[1:] > ends[:-1]) + 1
        heads, lasts = np.append(0, new)[: len(order)], np.append(new, len(order))[: len(order)] - 1
        starts, ends = starts[heads], ends[lasts]
        of = np.searchsorted(places, starts, side="right") - 1
        turns = np.zeros(len(data) + 1, dtype=np.int8)
        turns[starts - of] += 1
        turns[ends - of] -= 1
        kept = np.cumsum(turns[:-1], dtype=np.int8) == 0
        gone = np.bincount(of, ends - starts, len(texts)).astype(np.int64)
        sizes = np.diff(edges)
        removed = pa.StructArray.from_arrays([pa.array((x - places[of]).astype(np.int32)) for x in (starts, ends)], ["start", "end"])
        bounds = np.searchsorted(of, np.arange(len(texts) + 1)).astype(np.int32)
        return [
            pa.array(sizes),
            pa.ListArray.from_arrays(pa.array(bounds), removed),
            _binary(np.concatenate(([0], np.cumsum(sizes - gone))), data[kept]),
        ]

    return add_columns(joined, "n_bytes long, removed array<struct<start:int,end:int>>, kept binary", ["__text", "__spans"], compute, passed)


def digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    lengths = F.transform("removed", lambda r: (r["end"] - r["start"]).cast("long"))
    return found.select(
        col(id_col),
        "n_bytes",
        F.aggregate(lengths, F.lit(0).cast("long"), lambda a, x: a + x).alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
