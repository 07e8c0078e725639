"""Lines that repeat an earlier line, exactly or within one edit, by a deletion-neighbourhood join.

Two lines are within one edit when they share a deletion variant: both lose the character at the
same place (a replacement), or one loses a character and becomes the other. A variant for each
character of each line would be far more data than the text, so exact steps come first:

1. equal lines become one content with its earliest place;
2. a single edit leaves one half of a line unchanged, so contents meet first by hashes of their
   halves, which travel without any text. Those that meet nobody have no partner;
3. the others meet again by hashes of what lies before and after a window, first wide windows, then
   narrow ones inside those that met. Only a window of 32 to 63 characters is varied.

Variants are joined as hashed keys by grouping: a group keeps its earliest member, so no pairs are
formed. The edit distance of every line and the earlier line found for it is verified.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakequality.llm.tables import Scratch, col, maybe_in, release, store, without

WINDOW = 32
# Shorter lines have to be equal: one edit turns short words into others.
MIN_EDIT_CHARS = 16


def _half_keys(line: Column) -> Column:
    """Hashes of both halves, for a line as the shorter and as the longer of two that may meet."""
    size = F.length(line)
    keys = []
    for shorter in (size, size - 1):
        head = F.shiftright(shorter, 1)
        tail = shorter - head
        keys.append(F.xxhash64(shorter, F.lit(0), F.substr(line, F.lit(1), head)))
        keys.append(F.xxhash64(shorter, F.lit(1), F.substr(line, size - tail + 1, tail)))
    return F.array(*keys)


def _wide(shorter: Column) -> Column:
    """A window of some square roots of the line: about as many of them as narrow ones in each."""
    root = F.floor(F.log2(F.greatest(shorter, F.lit(2)).cast("double")) / 2) + 2
    return F.greatest(F.lit(WINDOW), F.pow(F.lit(2.0), root)).cast("int")


def window_keys(line: Column, shorter: Column, width: Column, first: Column | None = None, end: Column | None = None) -> Column:
    """What lies outside each window: an array of (before, after, key).

    `shorter` is the length of the shorter of two lines that may meet. `before` and `after` count
    the unchanged characters on both sides, multiples of `width`; between them lie fewer than two
    widths of the shorter line. An edit anywhere falls into one of the windows; `first` and `end`
    ask only for the windows that an edit at those characters of the shorter line may fall into.
    """
    last = F.greatest(F.floor(shorter / width).cast("int") - 1, F.lit(0))

    def key(i):
        before, after = i * width, (last - i) * width
        head = F.xxhash64(F.substr(line, F.lit(1), before))
        tail = F.xxhash64(F.substr(line, F.length(line) - after + 1, after))
        return F.struct(
            before.alias("before"), after.alias("after"), F.xxhash64(width, i, last, head, tail).alias("key")
        )

    low = F.lit(0) if first is None else F.least(last, F.floor(first / width).cast("int"))
    high = last if end is None else F.least(last, F.floor(end / width).cast("int"))
    return F.transform(F.sequence(low, high), key)


def _variants(middle: Column) -> Column:
    """The middle itself (place -1) and without each of its characters, as hashes."""
    size = F.length(middle)
    whole = F.array(F.struct(F.lit(-1).alias("place"), F.xxhash64(middle).alias("variant")))
    cut = F.transform(
        F.sequence(F.lit(1), size),
        lambda i: F.struct(
            i.alias("place"),
            F.xxhash64(F.concat(F.substr(middle, F.lit(1), i - 1), F.substr(middle, i + 1))).alias("variant"),
        ),
    )
    return F.when(size > 0, F.concat(whole, cut)).otherwise(whole)


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Every line that is not blank, as (at, said); `at` orders lines by id, hash of the text, number."""
    text = col(text_col)
    split = docs.filter(text.isNotNull()).select(
        col(id_col).alias("id"), F.xxhash64(text).alias("text_hash"), F.posexplode(F.split(text, "\n", -1)).alias("line", "said")
    )
    return split.filter(F.ltrim("said", F.lit(" \t\n\v\f\r")) != "").select(F.struct("id", "text_hash", "line").alias("at"), "said")


def _shared(keyed: DataFrame) -> DataFrame:
    """Keys that two different contents have, summed map-side."""
    both = keyed.groupBy("key").agg(F.min("h1").alias("low"), F.max("h1").alias("high"))
    return both.filter("low <> high").select("key")


def find_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_edit_chars: int = MIN_EDIT_CHARS,
) -> DataFrame:
    """Lines with an earlier line that is equal or one edit away: (id, text_hash, line, kind).

    Lines are the `\\n`-separated parts of a text; blank ones are never repeats. Order is by id
    (null first), then the hash of the text, then the line's number from 0. Rows equal in id and
    text are one document here, so copies of a row do not remove each other's lines. Lines of fewer
    than `min_edit_chars` characters have to be equal. `kind` is "equal" or "edit". Null texts have
    no lines; an empty table gives no rows; no other column is read.
    """
    spark = docs.sparkSession
    lines = _lines(docs, id_col, text_col)
    said = F.col("said")
    contents = lines.select(
        "at",
        F.xxhash64(said).alias("h1"),
        F.xxhash64(said, F.lit("second")).alias("h2"),
        F.when(F.length(said) >= min_edit_chars, _half_keys(said)).alias("halves"),
    )
    contents = Scratch(
        contents.groupBy("h1", "h2").agg(F.min("at").alias("at"), F.count("*").alias("times"), F.first("halves").alias("halves")),
        "line-contents",
    )
    release(spark)

    # First meeting: halves that two different contents have.
    keyed = contents.rows.select("h1", F.explode("halves").alias("key"))
    ids = store(keyed.join(_shared(keyed), "key", "left_semi").select("h1").distinct(), "lines-that-meet")
    release(spark)
    spots = contents.rows.join(ids, "h1", "left_semi").select("h1", "h2", F.col("at.id").alias("i"), F.col("at.text_hash").alias("t"), F.col("at.line").alias("n"))
    long = lines.filter(F.length(said) >= min_edit_chars)
    close = maybe_in(long, F.xxhash64(said), ids.select("h1")).join(
        spots, F.col("at.id").eqNullSafe(F.col("i")) & (F.col("at.text_hash") == F.col("t")) & (F.col("at.line") == F.col("n"))
    )
    close = store(close.select("h1", "h2", "at", "said").dropDuplicates(["h1", "h2"]), "lines-met")
    release(spark)

    # Second meeting: wide windows, and narrow ones inside those that met.
    roles = close.select("h1", "h2", "said", F.explode(F.array(F.length(said), F.length(said) - 1)).alias("shorter"))
    shorter = F.col("shorter")
    wide = roles.select("h1", "h2", "shorter", F.inline(window_keys(said, shorter, _wide(shorter))))
    wide = wide.join(_shared(wide), "key", "left_semi").select(
        "h1", "h2", "shorter", F.col("before").alias("first"), (shorter - F.col("after")).alias("end")
    )
    narrow = wide.join(close, ["h1", "h2"]).select(
        "h1", "h2", "at", "said", F.inline(window_keys(said, shorter, F.lit(WINDOW), F.col("first"), F.col("end")))
    )
    windows = store(
        narrow.select("h1", "h2", "at", "key", F.substr("said", F.col("before") + 1, F.length("said") - F.col("before") - F.col("after")).alias("middle")).distinct(),
        "line-windows",
    )
    met = _shared(windows)

    # Third meeting: the variants of the windows that still meet.
    varied = windows.join(met, "key", "left_semi").select(
        "h1", "h2", "at", "key", F.explode(_variants(F.col("middle"))).alias("v")
    ).select("h1", "h2", "at", F.xxhash64("key", "v.variant").alias("variant"), F.col("v.place").alias("place"))
    varied = store(varied, "line-variants")
    member = F.struct("at", "h1", "h2")
    first = varied.groupBy("variant", "place").agg(F.min(member).alias("first"))
    whole, cut = first.filter("place < 0"), first.filter("place >= 0")
    # One longer than another: a variant that equals a whole window, seen from both sides.
    shorter = whole.select("variant", F.col("first").alias("near"))
    longer = cut.groupBy("variant").agg(F.min("first").alias("near"))
    found = (
        varied.filter("place >= 0").join(shorter, "variant").select("h1", "h2", "at", "near")
        .unionByName(varied.filter("place < 0").join(longer, "variant").select("h1", "h2", "at", "near"))
        .unionByName(
            varied.filter("place >= 0")
            .join(cut.select("variant", "place", F.col("first").alias("near")), ["variant", "place"])
            .select("h1", "h2", "at", "near")
        )
        .filter(F.col("near.at") < F.col("at"))
        .select("h1", "h2", F.col("near.h1").alias("n1"), F.col("near.h2").alias("n2"))
        .distinct()
    )
    other = close.select(F.col("h1").alias("n1"), F.col("h2").alias("n2"), F.col("said").alias("near_said"))
    near = (
        close.select("h1", "h2", "said").join(found, ["h1", "h2"]).join(other, ["n1", "n2"])
        .filter(F.levenshtein("said", "near_said", 1) >= 0)
        .select("h1", "h2").distinct().withColumn("edit", F.lit(True))
    )
    near = store(near, "lines-near")
    release(spark)
    # Contents that lose a line: those said again, and those near an earlier one.
    again = contents.rows.select("h1", "h2", F.col("at").alias("first_at"), "times").join(near, ["h1", "h2"], "left")
    again = store(again.filter("times > 1 OR edit").select("h1", "h2", "first_at", "edit"), "lines-again")
    repeats = (
        lines.select("at", F.xxhash64(said).alias("h1"), F.xxhash64(said, F.lit("second")).alias("h2"))
        .join(again, ["h1", "h2"])
        .filter(F.col("edit") | (F.col("first_at") < F.col("at")))
        .select(
            F.col("at.id").alias("id"),
            F.col("at.text_hash").alias("text_hash"),
            F.col("at.line").alias("line"),
            F.when(F.col("first_at") < F.col("at"), "equal").otherwise("edit").alias("kind"),
        )
    )
    repeats = store(repeats, "line-repeats")
    contents.remove()
    release(spark)
    return repeats


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents without the lines that `find_repeats` names.

    Text is replaced by the lines kept; `n_lines`, `n_equal` and `n_edit` count the lines of the
    input and those removed (columns of these names are replaced). A null text stays null, with no
    lines, and a document whose lines all go keeps an empty text.
    """
    repeats = find_repeats(docs, id_col, text_col, **options)
    gone = repeats.groupBy("id", "text_hash").agg(
        F.collect_set("line").alias("__line_gone"),
        F.count_if(F.col("kind") == "equal").alias("__line_equal"),
        F.count_if(F.col("kind") == "edit").alias("__line_edit"),
    ).select(F.col("id").alias("__line_id"), F.col("text_hash").alias("__line_hash"), "__line_gone", "__line_equal", "__line_edit")
    text = col(text_col)
    rows = docs.withColumn("__line_own_hash", F.xxhash64(text))
    joined = rows.join(gone, col(id_col).eqNullSafe(F.col("__line_id")) & (F.col("__line_own_hash") == F.col("__line_hash")), "left")
    parts = F.split(text, "\n", -1)
    spots = F.coalesce("__line_gone", F.array().cast("array<int>"))
    marked = F.map_from_arrays(spots, F.transform(spots, lambda i: F.lit(True)))
    kept = F.array_join(F.filter(parts, lambda s, i: ~F.map_contains_key(marked, i)), "\n")
    new = ["n_lines", "n_equal", "n_edit"]
    return joined.select(
        *(F.when(F.size(spots) > 0, kept).otherwise(text).alias(c) if c == text_col else col(c) for c in without(docs, new)),
        F.when(text.isNull(), 0).otherwise(F.size(parts)).cast("long").alias("n_lines"),
        F.coalesce("__line_equal", F.lit(0)).cast("long").alias("n_equal"),
        F.coalesce("__line_edit", F.lit(0)).cast("long").alias("n_edit"),
    )
