"""Conversations as training text with turn marks, checked by reading every text back.

Grammar of a rendered conversation, read from left to right without choice:

    conversation := turn*
    turn         := START role "\\n" text END

`START` and `END` are control strings. A role or text that would not come back equal when the
grammar is read is escaped until it does: one backslash goes into each control string in it, and
into each that has backslashes already. Reading takes one backslash out again. Escaping therefore
has an exact inverse, leaves no control string in a text, and touches only turns that need it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakequality.llm.tables import col

START = "<|im_start|>"
END = "<|im_end|>"
# Inside roles, which end at the first line feed, a third mark stands for a line feed.
LINE_FEED = "<|nl|>"
_MARKS = "im_start|im_end"
_CONTROL = rf"<(\\*)\|({_MARKS})\|>"


def escape(text: Column, marks: str = _MARKS) -> Column:
    return F.regexp_replace(text, rf"<(\\*)\|({marks})\|>", r"<\\$1|$2|>")


def unescape(text: Column, marks: str = _MARKS) -> Column:
    return F.regexp_replace(text, rf"<\\(\\*)\|({marks})\|>", r"<$1|$2|>")


def _escape_role(role: Column) -> Column:
    return F.replace(escape(role, _MARKS + "|nl"), F.lit("\n"), F.lit(LINE_FEED))


def _unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit(LINE_FEED), F.lit("\n")), _MARKS + "|nl")


def _segments(rendered: Column) -> Column:
    """The turns of a rendered text, without their end marks; nothing follows the last mark."""
    parts = F.split(rendered, r"<\|im_end\|>", -1)
    return F.slice(parts, F.lit(1), F.greatest(F.size(parts) - 1, F.lit(0)))


def _head(segment: Column) -> Column:
    return F.substring_index(segment, "\n", 1)


def parse(rendered: Column) -> Column:
    """Turns read back from a rendered text: an array of (role, text).

    Text that the grammar does not describe gives null: something after the last end mark, a turn
    without a start mark, or a turn without a line feed.
    """
    segments = _segments(rendered)
    turns = F.transform(
        segments,
        lambda s: F.struct(
            _unescape_role(F.substr(_head(s), F.lit(len(START) + 1))).alias("role"),
            unescape(F.substr(s, F.length(_head(s)) + 2)).alias("text"),
        ),
    )
    fits = F.forall(
        segments,
        lambda s: s.startswith(START)
        & s.contains("\n")
        & ~F.substr(s, F.lit(len(START) + 1)).contains(START),
    )
    whole = (rendered == "") | rendered.endswith(END)
    return F.when(whole & fits, turns)


def _render(role: Column, text: Column) -> Column:
    return F.concat(F.lit(START), role, F.lit("\n"), text, F.lit(END))


def _round_trip(role: Column, text: Column, rendered: Column) -> Column:
    back = parse(rendered)
    return F.coalesce((F.size(back) == 1) & (back[0]["role"] == role) & (back[0]["text"] == text), F.lit(False))


def format_chats(
    turns: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    learn: str = "assistant",
) -> DataFrame:
    """One row for each conversation: its rendered text, and where the text to learn from stands.

    Result: the `conv` column, `formatted`, `turns` (roles and texts of the source in order),
    `loss_spans` (start and length in code points, from 0, of the texts of role `learn` inside
    `formatted`), `n_escaped` (turns that needed escaping) and `exact` (whether reading `formatted`
    gives `turns` again; always true).

    Null roles and texts count as empty, rows of a null conversation form one conversation, an
    empty table gives no rows, a null turn number comes first, and turns of one number are ordered
    by role and text, so repeated rows give repeated turns. Other columns are not read. A
    conversation is one sample and becomes one row; turns are rendered and checked before the one
    shuffle, and only aggregated after it.
    """
    rows = turns.select(
        col(conv).alias("conv"),
        col(turn).alias("turn"),
        F.coalesce(col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(col(text).cast("string"), F.lit("")).alias("text"),
    )
    # Only texts that hold a control string, plain or escaped, or an odd role can fail to come back.
    plain = _render(F.col("role"), F.col("text"))
    odd = (
        F.col("text").rlike(_CONTROL) | F.col("role").rlike(r"\n|<\\*\|")
    )
    rows = rows.withColumn(
        "escaped", F.when(odd, ~_round_trip(F.col("role"), F.col("text"), plain)).otherwise(False)
    )
    rows = rows.withColumn(
        "written_role", F.when(F.col("escaped"), _escape_role(F.col("role"))).otherwise(F.col("role"))
    ).withColumn(
        "written", F.when(F.col("escaped"), escape(F.col("text"))).otherwise(F.col("text"))
    )
    size = F.length("written_role") + F.length("written") + F.lit(len(START) + 1 + len(END))
    order = Window.partitionBy("conv").orderBy("turn", "role", "text")
    rows = rows.withColumn("end", F.sum(size).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    one = F.struct("end", "role", "text", "escaped", "written_role", "written")
    chats = rows.groupBy("conv").agg(F.array_sort(F.collect_list(one)).alias("rows"))
    formatted = F.array_join(
        F.transform("rows", lambda r: _render(r["written_role"], r["written"])), ""
    )
    chats = chats.select("conv", "rows", formatted.alias("formatted")).select(
        "conv",
        "formatted",
        F.transform("rows", lambda r: F.struct(r["role"].alias("role"), r["text"].alias("text"))).alias("turns"),
        F.transform(
            F.filter("rows", lambda r: r["role"] == learn),
            lambda r: F.struct(
                (r["end"] - F.lit(len(END)) - F.length(r["written"])).cast("int").alias("start"),
                F.length(r["written"]).alias("length"),
            ),
        ).alias("loss_spans"),
        F.size(F.filter("rows", lambda r: r["escaped"])).alias("n_escaped"),
    )
    return chats.withColumn(
        "exact", F.coalesce(parse(F.col("formatted")) == F.col("turns"), F.lit(False))
    ).withColumnRenamed("conv", conv)


def loss_text(formatted: Column, loss_spans: Column) -> Column:
    """The text under the mask, read from the rendered text and unescaped."""
    return F.array_join(
        F.transform(
            loss_spans,
            lambda s: unescape(F.substr(formatted, s["start"] + 1, s["length"])),
        ),
        "",
    )


def digests(chats: DataFrame, conv: str = "conv_id") -> DataFrame:
    """Counts and digests of what reading the rendered texts gives."""
    back = parse(F.col("formatted"))
    read = chats.select(
        col(conv), "formatted", "n_escaped", back.alias("back"),
        loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"),
    )
    said = F.array_join(
        F.transform("back", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    return read.select(
        col(conv),
        F.size("back").cast("long").alias("n_turns"),
        F.sha2(F.encode(said, "UTF-8"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.encode("loss", "UTF-8"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        F.col("n_escaped").cast("long").alias("n_escaped"),
    )
