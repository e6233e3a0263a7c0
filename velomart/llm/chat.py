"""Chat formatting by a grammar round trip.

    conversation := turn*
    turn         := "<s>" "[INST]" role "[/INST]" text "</s>"

The four quoted strings are the control strings. Each turn is first written as it is and read
back by the parser of this grammar; a turn that comes back different has its control strings
escaped. The whole conversation is then read back, and if any turn still differs, all are
escaped. What is returned has always been read back identical.

An escape puts a backslash after the first character of a control string, and also after that
of one that already has backslashes there; reading takes one away again. Control strings
cannot overlap, so both directions act on the same places and undo each other.

Everything is an expression over rows of turns and then one row per conversation, as its text
and digests need all of its turns together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END, ROLE_OPEN, ROLE_CLOSE = "<s>", "</s>", "[INST]", "[/INST]"
_CONTROL = r"(/?s>|/?INST\])"
_HEAD = START + ROLE_OPEN


def _escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])(\\*)" + _CONTROL, r"$1\\$2$3")


def _unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])\\(\\*)" + _CONTROL, "$1$2$3")


def _render(role: Column, text: Column) -> Column:
    return F.concat(F.lit(_HEAD), role, F.lit(ROLE_CLOSE), text, F.lit(END))


def _segments(formatted: Column) -> Column:
    """What stands before each end of a turn."""
    parts = F.split(formatted, END, -1)
    return F.slice(parts, 1, F.size(parts) - 1)


def _role_chars(segment: Column) -> Column:
    """Characters up to the text of a segment."""
    return F.length(F.substring_index(segment, ROLE_CLOSE, 1)) + len(ROLE_CLOSE)


def parse(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of (role, text)."""

    def turn(segment: Column) -> Column:
        head = F.substring_index(segment, ROLE_CLOSE, 1)
        role = F.substring(head, len(_HEAD) + 1, F.length(head))
        text = F.substring(segment, _role_chars(segment) + 1, F.length(segment))
        return F.struct(_unescape(role).alias("role"), _unescape(text).alias("text"))

    return F.transform(_segments(formatted), turn)


def format_conversations(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    loss_role: str = "assistant",
) -> DataFrame:
    """(conv, formatted, loss_runs), one row per conversation.

    ``loss_runs`` gives for each turn ``skip`` and ``take``, the characters before its text and
    of its text as written, and ``loss``, whether a model learns from the text. Turns stand in
    the order of turn (nulls last), role and text, so ties and repeated rows have one order and
    all are kept. Null roles and texts are empty; an empty text is a turn. Rows with a null
    conversation id are one conversation. An empty table gives no rows; other columns are not
    read.
    """
    role = F.coalesce(F.col(f"`{role_col}`").cast("string"), F.lit(""))
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = turns.select(
        F.col(f"`{conv_col}`").alias("conv"),
        F.col(f"`{turn_col}`").alias("turn"),
        role.alias("role"),
        text.alias("text"),
    )
    escaped = _render(_escape(F.col("role")), _escape(F.col("text")))
    plain = _render(F.col("role"), F.col("text"))
    same = parse(plain) == F.array(F.struct("role", "text"))
    rows = rows.withColumn("escaped", escaped).withColumn("written", F.when(same, plain).otherwise(escaped))
    in_order = F.array_sort(
        F.collect_list(F.struct(F.col("turn").isNull().alias("none"), "turn", "role", "text", "written", "escaped"))
    )
    whole = rows.groupBy("conv").agg(in_order.alias("turns")).select(
        "conv",
        F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("source"),
        F.array_join(F.col("turns.written"), "").alias("first_try"),
        F.array_join(F.col("turns.escaped"), "").alias("all_escaped"),
    )
    chosen = F.when(parse(F.col("first_try")) == F.col("source"), F.col("first_try")).otherwise(F.col("all_escaped"))
    whole = whole.select("conv", "source", chosen.alias("formatted"))
    checked = F.when(parse(F.col("formatted")) == F.col("source"), F.col("formatted")).otherwise(
        F.raise_error(F.lit("a conversation was read back differently"))
    )
    whole = whole.select("conv", "source", checked.alias("formatted"))
    runs = F.zip_with(
        "source",
        _segments(F.col("formatted")),
        lambda t, s: F.struct(
            _role_chars(s).alias("skip"),
            (F.length(s) - _role_chars(s)).alias("take"),
            (t["role"] == loss_role).alias("loss"),
        ),
    )
    return whole.select(F.col("conv").alias(conv_col), "formatted", runs.alias("loss_runs"))


def read_back(formatted: DataFrame) -> DataFrame:
    """``formatted`` with ``turns``, parsed, and ``loss_text``: the unescaped text under the mask."""
    under = F.zip_with(
        _segments(F.col("formatted")),
        "loss_runs",
        lambda s, r: F.when(r["loss"], _unescape(F.substring(s, r["skip"] + 1, r["take"]))).otherwise(""),
    )
    return formatted.withColumn("turns", parse(F.col("formatted"))).withColumn("loss_text", F.array_join(under, ""))
