"""Chat formatting with a grammar round trip, in DataFrame functions only.

A turn is rendered as ``<|im_start|>{role}\\n{text}<|im_end|>\\n``. The parser is
deterministic: ``<|`` always opens a control string, so a turn has exactly two; split at
``<|im_end|>\\n``, take the role up to the first line feed, undo one level of escaping.
Each role and text is rendered into a trial turn of its own and parsed; it stays as it
is if the trial has one turn that gives the source back, else it is escaped, which adds
one backslash inside every ``<|`` (after any backslashes already there).
An escaped piece holds no ``<|`` at all and always comes back, so one round of
escaping reaches the fixed point and no loop is needed; ``round_trip`` compares the parsed
conversation with its source once more.

Defined cases: null text or role is the empty string; rows are ordered by turn
(null first), ties by role, then text; repeated rows are repeated turns; null
``conv_id`` is a conversation of its own; an empty table gives no rows; columns
besides ``conv_id, turn, role, text`` are not read. A conversation's digest is
one value over all its turns, so its turns meet in one row; the table's rows
are spread by conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"
LOSS_ROLE = "assistant"


def _escape(c: Column) -> Column:
    return F.regexp_replace(c, r"<(\\*)\|", r"<$1\\|")


def _unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"<\\(\\*)\|", r"<$1|")


def _escape_role(c: Column) -> Column:
    return _escape(F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def _unescape_role(c: Column) -> Column:
    parts = F.split(_unescape(c), r"\\\\", -1)
    return F.array_join(F.transform(parts, lambda p: F.replace(p, F.lit("\\n"), F.lit("\n"))), "\\")


def _parse(formatted: Column) -> Column:
    """Formatted text -> array of (raw, role, text, start): ``raw`` is the text as
    it stands, ``start`` its offset within its turn."""
    segments = F.split(formatted, r"<\|im_end\|>\n", -1)
    return F.transform(F.slice(segments, 1, F.size(segments) - 1), _parse_turn)


def _parse_turn(seg: Column) -> Column:
    role = F.substring_index(F.substr(seg, F.lit(len(START) + 1)), "\n", 1)
    start = F.length(role) + len(START) + 1
    raw = F.substr(seg, start + 1)
    return F.struct(raw.alias("raw"), _unescape_role(role).alias("role"), _unescape(raw).alias("text"),
                    start.alias("start"), F.length(seg).alias("chars"))


def _render(role: Column, text: Column) -> Column:
    return F.concat(F.lit(START), role, F.lit("\n"), text, F.lit(END))


def _comes_back(role: Column, text: Column) -> Column:
    """Whether the parser reads one turn of this role and text from their rendering."""
    trial = _render(role, text)
    turn = _parse_turn(F.element_at(F.split(trial, r"<\|im_end\|>\n", -1), 1))
    return (F.size(F.split(trial, r"<\|", -1)) == 3) & (turn["role"] == role) & (turn["text"] == text)


def _role(source: Column) -> Column:
    return F.when(_comes_back(source, F.lit("")), source).otherwise(_escape_role(source))


def _text(source: Column) -> Column:
    return F.when(_comes_back(F.lit(""), source), source).otherwise(_escape(source))


def format_conversations(conversations: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, formatted, turns (as parsed back),
    loss_spans (start, end in code points of ``formatted``) and round_trip."""
    rows = conversations.select(
        F.col("conv_id"),
        F.col("turn"),
        F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    turns = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("source"))
    rendered = turns.select(
        "conv_id",
        "source",
        F.array_join(
            F.transform("source", lambda t: _render(_role(t["role"]), _text(t["text"]))), "",
        ).alias("formatted"),
    )
    parsed = rendered.select("conv_id", "source", "formatted", _parse(F.col("formatted")).alias("parsed"))
    placed = F.aggregate(
        "parsed",
        F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<start:int,end:int>>)").alias("spans")),
        lambda acc, t: F.struct(
            (acc["at"] + t["chars"] + len(END)).alias("at"),
            F.when(t["role"] == LOSS_ROLE, F.concat(acc["spans"], F.array(F.struct(
                (acc["at"] + t["start"]).alias("start"), (acc["at"] + t["chars"]).alias("end")))))
            .otherwise(acc["spans"]).alias("spans"),
        ),
        lambda acc: acc["spans"],
    )
    return parsed.select(
        "conv_id",
        "formatted",
        F.transform("parsed", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"),
        placed.alias("loss_spans"),
        (F.transform("parsed", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
         == F.transform("source", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))))
        .alias("round_trip"),
    )


def digest(formatted: DataFrame) -> DataFrame:
    """Digest columns read back from formatted conversations."""
    under = F.array_join(F.transform("loss_spans", lambda s: _unescape(
        F.substr("formatted", s["start"] + 1, s["end"] - s["start"]))), "")
    return formatted.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""),
               256).alias("turns_sha256"),
        F.length(under).cast("long").alias("loss_chars"),
        F.sha2(under, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "round_trip",
    )
