"""The main text of web pages, by structure and by differencing pages with neighbouring addresses.

A page is cut into blocks of text. Markup that names its purpose (navigation, footers, adverts,
forms, scripts, comments, ...) is left out. Every page is paired with the page of the nearest address
on the same host that is no copy of it: their blocks are aligned by longest common subsequence, and
the blocks that both have are the site's, not the page's, and are deleted. Where a page marks its
article, that is checked last: blocks that stand there are restored. A page without another one to
compare with has its article, or all its blocks if it marks none.
"""

from __future__ import annotations

import html as entities
import os.path
import re
from collections import Counter

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakequality.llm import words
from lakequality.llm.tables import add_columns, col, store

# Elements whose content is no text of the page.
_HIDDEN = frozenset("script style noscript template svg math iframe object canvas audio video title select option textarea button datalist map".split())
_BOILER = frozenset("nav footer aside form menu dialog header".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary "
    "table tbody td tfoot th thead tr ul".split()
)
_MAIN = frozenset("article main".split())
# Words in class, id or role that name a purpose other than the page's own text (fixed values).
_NAMES = frozenset(
    "ad ads advert adverts advertisement advertisements advertising adsense banner sponsor sponsors sponsored promo promos nav navbar "
    "navigation menu menus breadcrumb breadcrumbs sidebar sidebars footer footers header headers masthead cookie cookies consent notice "
    "notices gdpr popup popups modal modals newsletter newsletters subscribe signup login comment comments disqus replies related "
    "recommended share sharing social search toolbar pagination complementary contentinfo alert dialog".split()
)
# Words that say nothing beside one of those; with any other word, as in "share-price", a name means something else (fixed values).
_NEUTRAL = frozenset(
    "area articles banner bar block body bottom box button buttons col column container content form frame global group holder icon icons "
    "inner item items js label left line link links list main message outer overlay page panel posts primary region right row secondary "
    "section side site slot small space stories text thread title top unit widget widgets wrap wrapper".split()
)
# Inside an article a header holds its heading, and an id marks a place in the text.
_HEADS = frozenset("header headers masthead".split())
_SAID = frozenset("a b dd dt em h1 h2 h3 h4 h5 h6 i li p pre span strong td th".split())
_RAW = frozenset("script style textarea title".split())
_NAME = re.compile(r"[a-zA-Z][a-zA-Z0-9:-]*")
# From a place inside a tag to its end, or past the next value of an attribute.
_STEP = re.compile(r"[^>=]*(?:(>)|=\s*(?:\"[^\"]*\"?|'[^']*'?)?|\Z)")
_PURPOSE = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)


def _names_purpose(value: str, main: int) -> bool:
    """Whether one of the blank-separated names is made of purposes and neutral words alone."""
    for name in value.lower().split():
        parts = {part for part in re.split(r"[-_]+", name) if part and not part.isdigit()}
        if main:
            parts -= _HEADS
        if parts & _NAMES and parts <= _NAMES | _NEUTRAL:
            return True
    return False


def _named_boiler(element: str, attributes: str, main: int) -> bool:
    for name, value in _PURPOSE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name in ("class", "id", "role"):
            if not (main and name == "id" and element in _SAID) and _names_purpose(value, main):
                return True
        elif name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return True
        elif name == "style" and re.search(r"display\s*:\s*none", value, re.I):
            return True
    return False


def _tags(source: str):
    """(start, end, closing, name, attributes) of what is no text, by one scan forward.

    Comments, declarations and the contents of scripts and the like have the name "". Quotes count
    where they hold a value. What never ends takes the rest of the page, so no place is read twice.
    """
    at, size = 0, len(source)
    while True:
        start = source.find("<", at)
        if start < 0 or start + 1 >= size:
            return
        if source.startswith("<!--", start):
            end = source.find("-->", start + 4)
            at = size if end < 0 else end + 3
            yield start, at, False, "", ""
            continue
        closing = source[start + 1] == "/"
        named = _NAME.match(source, start + 1 + closing)
        if not named:
            if closing and start + 2 < size or source[start + 1] in "!?":
                end = source.find(">", start)
                at = size if end < 0 else end + 1
                yield start, at, False, "", ""
            else:
                at = start + 1
            continue
        at = named.end()
        while at < size:
            step = _STEP.match(source, at)
            at = step.end()
            if step.group(1):
                break
        ended = source[at - 1] == ">" and at > named.end()
        name = named.group().lower()
        if name in _RAW and not closing:
            close = re.compile(rf"</{name}(?=[\s/>])", re.I).search(source, at) if ended else None
            end = source.find(">", close.end()) if close else -1
            at = size if end < 0 else end + 1
            yield start, at, False, "", ""
            continue
        yield start, at, closing, name, source[named.end() : at - ended]


def blocks(html: str | None) -> tuple[list[str], list[bool]]:
    """The blocks of text outside marked boilerplate, and whether each stands in an article.

    Character references are decoded, white space inside a block is one space, blocks without text
    are left out. Unclosed elements end with their parent, or at the end of the page; an unclosed tag
    ends with the page. Time is linear in the length, whatever the markup.
    """
    texts: list[str] = []
    inside: list[bool] = []
    if not html:
        return texts, inside
    open_: list[tuple[str, bool, bool]] = []  # name, skipped, main
    n_open: Counter[str] = Counter()
    skipping = main = 0
    parts: list[str] = []

    def end_block():
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            if text:
                texts.append(text)
                inside.append(main > 0)
            parts.clear()

    at = 0
    for start, end, closing, name, attributes in _tags(html):
        if not skipping and start > at:
            parts.append(html[at:start])
        at = end
        if not name:
            continue
        if name in _VOID:
            if not skipping:
                if name == "hr":
                    end_block()
                else:
                    parts.append(" " if name == "br" else "")
            continue
        if name in _BLOCK and not skipping:
            end_block()
        if closing:
            while n_open[name]:
                last, skip, is_main = open_.pop()
                n_open[last] -= 1
                skipping -= skip
                main -= is_main
                if last == name:
                    break
            continue
        if attributes.rstrip().endswith("/") and name not in _BLOCK and name not in _HIDDEN:
            continue
        if name in ("p", "li", "dt", "dd", "tr", "td", "th", "option") and open_ and open_[-1][0] == name:
            _, skip, is_main = open_.pop()
            n_open[name] -= 1
            skipping -= skip
            main -= is_main
        # An article's own header holds its heading; a page's header does not.
        boiler = name in _BOILER and not (name == "header" and main)
        named = name not in ("html", "body", "article", "main") and _named_boiler(name, attributes, main)
        skip = name in _HIDDEN or boiler or named
        open_.append((name, skip, name in _MAIN))
        n_open[name] += 1
        skipping += skip
        main += name in _MAIN
    if not skipping and at < len(html):
        parts.append(html[at:])
    end_block()
    return texts, inside


def page_text(html: str | None, deleted: set[int] | None) -> str:
    """The blocks that are not deleted, and all of the article.

    Without a page to compare with (`deleted` is None) the article, or every block if none is marked.
    """
    texts, inside = blocks(html)
    if deleted is None:
        marked = any(inside)
        kept = [i or not marked for i in inside]
    else:
        kept = [i or k not in deleted for k, i in enumerate(inside)]
    return "\n".join(t for t, k in zip(texts, kept, strict=True) if k)


def block_hashes(html: str | None) -> tuple[list[int], int]:
    """Hashes of the blocks of a page, in their order, and how many stand in an article."""
    texts, inside = blocks(html)
    said = [text.encode("utf-8", "replace") for text in texts]
    if not said:
        return [], 0
    ends = np.cumsum([len(text) for text in said])
    found = words.hashes(words.as_bytes(b"".join(said)), np.append(0, ends[:-1]), ends)
    return found.view(np.int64).tolist(), sum(inside)


def shared(a: list[int], b: list[int]) -> list[int]:
    """Places in `a` that a longest common subsequence with `b` uses.

    Equal ends are matched first. What lies between is aligned row by row; a row is one vector
    operation. The way back needs every row, so some are kept, a square root of their number, and
    those between two of them are made again.
    """
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    used = [*range(head), *range(len(a) - tail, len(a))]
    left, right = a[head : len(a) - tail], b[head : len(b) - tail]
    known = set(right)
    places = [i for i, x in enumerate(left) if x in known]
    known = {left[i] for i in places}
    other = np.array([x for x in right if x in known], dtype=np.int64)
    if not places:
        return used

    def after(row, k):
        matched = np.where(other == left[places[k]], row[:-1] + 1, row[1:])
        return np.maximum.accumulate(np.concatenate((row[:1], matched)))

    step = int(len(places) ** 0.5) + 1
    row, kept = np.zeros(len(other) + 1, dtype=np.int32), []
    for k in range(len(places)):
        if k % step == 0:
            kept.append(row)
        row = after(row, k)
    j, middle = len(other), []
    for first in range((len(kept) - 1) * step, -1, -step):
        rows = [kept.pop()]
        for k in range(first, min(first + step, len(places))):
            rows.append(after(rows[-1], k))
        k = len(rows) - 1
        while k and j:
            if rows[k][j] == rows[k - 1][j]:
                k -= 1
            elif rows[k][j] == rows[k][j - 1]:
                j -= 1
            else:
                middle.append(head + places[first + k - 1])
                k, j = k - 1, j - 1
    return sorted([*used, *middle])


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host in lower case, and path without query and fragment."""
    rest = F.regexp_replace(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://", "")
    place = F.regexp_replace(rest, r"[?#].*$", "")
    host = F.lower(F.substring_index(place, "/", 1))
    return host, F.substr(place, F.length(F.substring_index(place, "/", 1)) + 1)


def ranked_pages(lines: DataFrame) -> DataFrame:
    """Pages (host, path, list, lines) with `rank`, their place by host and path, and `part`, their range.

    All pages are sorted once by range, so one host may be of any size: ranks come from the sizes of
    the ranges, and neighbours meet by rank. Only hashes of lines move.
    """
    order = ["host", "path", "list"]
    placed = store(
        lines.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("mark", F.monotonically_increasing_id()),
        "ordered-pages",
    )
    part = F.shiftright("mark", 33)
    sizes = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    # One row for each range, a number set by the cluster, not by the data.
    before = sizes.withColumn("first", F.sum("n").over(Window.orderBy("part")) - F.col("n")).select("part", "first")
    ranked = placed.withColumn("part", part).join(before, "part").withColumn(
        "rank", F.col("first") + F.col("mark").bitwiseAND(F.lit((1 << 33) - 1))
    )
    # Ranks inside a range follow the order in which its rows were written.
    return store(ranked.select("rank", "part", *order, "lines"), "ranked-pages")


def compare(asked: DataFrame, ranked: DataFrame, copy_share: float) -> DataFrame:
    """The best of the pages `other_ranks` for each asked one: (rank, usable, other_rank, best).

    `usable` says that it is no copy; `best` ends with the blocks to delete. A page that has all
    blocks of the asked one is a copy whatever the share, and deletes nothing.
    """
    other = ranked.select(
        F.col("rank").alias("other_rank"), F.col("host").alias("other_host"), F.col("path").alias("other_path"), F.col("lines").alias("other")
    )
    pairs = asked.select("rank", "host", "path", "lines", F.explode("other_ranks").alias("other_rank"))
    pairs = pairs.join(other, "other_rank").filter("host = other_host")
    def align(mine, theirs, path, other_path):
        usable, n_shared, deleted = [], [], []
        paths = zip(path.to_pylist(), other_path.to_pylist(), strict=True)
        common = [len(os.path.commonprefix(both)) for both in paths]  # characters at the start of both
        for a, b in zip(mine.to_pylist(), theirs.to_pylist(), strict=True):
            both = shared(a, b)
            usable.append(len(both) <= copy_share * len(a) and len(both) < len(a))
            n_shared.append(len(both))
            deleted.append(both if len(both) < len(a) else None)
        return usable, n_shared, common, deleted

    aligned = add_columns(
        pairs,
        "usable boolean, n_shared int, common int, deleted array<int>",
        ["lines", "other", "path", "other_path"],
        align,
        ["rank", "other_rank"],
    )
    fewest = F.when(F.col("usable"), 0).otherwise(-F.col("n_shared")).alias("fewest")
    order = F.struct("usable", fewest, "common", (-F.col("other_rank")).alias("before"))
    best = F.max(F.struct(order.alias("order"), "deleted")).alias("best")
    return aligned.groupBy("rank").agg(best).select(
        "rank", F.col("best.order.usable").alias("usable"), (-F.col("best.order.before")).alias("other_rank"), "best"
    )


def beyond_copies(ranked: DataFrame, answers: DataFrame) -> DataFrame:
    """Pages between copies with `other_ranks`: what the nearest pages with a usable answer were paired with.

    These stand where the copies end, before and after. Windows are over one range of ranks each.
    """
    paired = F.when(F.col("usable"), F.struct("host", "other_rank"))
    marked = ranked.join(answers.select("rank", "usable", "other_rank"), "rank", "left").withColumn("paired", paired)
    ends = marked.groupBy("part").agg(
        F.min_by("paired", F.when(F.col("usable"), F.col("rank"))).alias("first"),
        F.max_by("paired", F.when(F.col("usable"), F.col("rank"))).alias("last"),
    )
    # One row for each range.
    up = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    down = Window.orderBy("part").rowsBetween(1, Window.unboundedFollowing)
    ends = ends.select("part", F.last("last", True).over(up).alias("earlier"), F.first("first", True).over(down).alias("later"))
    # Both run from the start of an order: a frame that ends with the range is read anew for each row.
    inside = Window.partitionBy("part").rowsBetween(Window.unboundedPreceding, 0)
    before = F.last("paired", True).over(inside.orderBy("rank"))
    after = F.last("paired", True).over(inside.orderBy(F.desc("rank")))
    near = marked.select("rank", "part", "host", "usable", before.alias("before"), after.alias("after")).filter("NOT usable").join(ends, "part")
    sides = F.array(F.coalesce("before", "earlier"), F.coalesce("after", "later"))
    here = F.transform(F.filter(sides, lambda x: x["host"] == F.col("host")), lambda x: x["other_rank"])
    asked = near.select("rank", F.array_distinct(here).alias("other_ranks")).filter(F.size("other_ranks") > 0)
    return ranked.join(asked, "rank")


def find_shared(pages: DataFrame, url_col: str = "url", html_col: str = "html", copy_share: float = 0.5) -> DataFrame:
    """Blocks to delete, by page: (key, deleted), for pages that have another one to compare with.

    Pages that look the same without a row, by what `page_text` restores, have none.

    `key` is the hash of a row's address and html. Equal pages of a host are one, at the first of
    their addresses. Of the pages before and after it on its host a page is paired with the one whose
    path has the longer start in common, or the one before. A page that shares more than `copy_share`
    of the blocks may be a copy: the nearest pages beyond such copies are asked then, and after them
    those at distances of 2, 4, ... to the ends of the host. If all share as much, what is shared is
    the site's, and the page is paired with the one that shares least.
    """
    host, path = url_parts(col(url_col))

    def compute(column):
        return tuple(zip(*(block_hashes(h) for h in column.to_pylist()), strict=True)) or ((), ())

    named = pages.select(
        F.xxhash64(col(url_col), col(html_col)).alias("key"), host.alias("host"), path.alias("path"), col(html_col).alias("html")
    )
    lines = add_columns(named, "lines array<bigint>, n_inside int", ["html"], compute, ["key", "host", "path"])
    lines = lines.filter(F.size("lines") > 0).withColumn("list", F.xxhash64("lines"))
    lines = store(lines, "page-lines")
    first = lines.groupBy("host", "list").agg(F.min_by(F.struct("path", "lines"), "path").alias("first"))
    ranked = ranked_pages(first.select("host", "first.path", "list", "first.lines"))

    def at(distance):
        return F.array(F.col("rank") - distance, F.col("rank") + distance)

    answers = [store(compare(ranked.withColumn("other_ranks", at(1)), ranked, copy_share), "compared-1")]
    copies = answers[0].filter("NOT usable").select("rank")
    if not copies.isEmpty():
        answers.append(store(compare(beyond_copies(ranked, answers[0]), ranked, copy_share), "compared-beyond"))
        copies = store(copies.join(answers[1].filter("usable"), "rank", "left_anti"), "copies-1")
    distance = 2
    while not copies.isEmpty():
        asked = ranked.join(copies, "rank", "left_semi").withColumn("other_ranks", at(distance))
        answers.append(store(compare(asked, ranked, copy_share), f"compared-{distance}"))
        copies = answers[-1].filter("NOT usable").select("rank")
        distance *= 2
    found = answers[0]
    for more in answers[1:]:
        found = found.unionByName(more)
    found = found.groupBy("rank").agg(F.max("best").alias("best")).filter("best.deleted IS NOT NULL")
    found = ranked.select("rank", "host", "list").join(found, "rank").select("host", "list", "best.deleted")
    # The check by the article: pages that stand in it whole get all blocks back, and need no row.
    open_ = lines.filter(F.col("n_inside") < F.size("lines")).select("key", "host", "list", "n_inside").dropDuplicates(["key"])
    return open_.join(found, ["host", "list"]).filter((F.col("n_inside") > 0) | (F.size("deleted") > 0)).select("key", "deleted")


def extract(pages: DataFrame, url_col: str = "url", html_col: str = "html", keep: list[str] | None = None, **options) -> DataFrame:
    """The pages with `text`, their main text; an input column of that name is replaced.

    Null and blank pages have an empty text. A page without an address is on the host "", repeated
    rows are one page when neighbours are looked for, an empty table gives no rows, and markup of
    any length is read whole.
    """
    deleted = store(find_shared(pages, url_col, html_col, **options), "shared-blocks")
    passed = [c for c in (pages.columns if keep is None else keep) if c.lower() != "text"]
    source = pages.withColumn("__key", F.xxhash64(col(url_col), col(html_col)))
    source = source.join(deleted.select(F.col("key").alias("__key"), F.col("deleted").alias("__deleted")), "__key", "left")

    def compute(htmls, gone):
        pairs = zip(htmls.to_pylist(), gone.to_pylist(), strict=True)
        return ([page_text(h, None if d is None else set(d)) for h, d in pairs],)

    return add_columns(source, "text string", [html_col, "__deleted"], compute, passed)
