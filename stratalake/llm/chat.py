"""Chat formatting with typed content parts (operator 8), DataFrame functions only.

A visitor, one branch per part type, turns a turn's parts into text and
placeholders in order. Control strings inside texts are escaped so that the
output can be read back without loss.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.llm.common import let

# --- fixed values: the marks of the template ------------------------------------
START = "<|im_start|>"
END = "<|im_end|>"
PLACEHOLDERS = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}
# ----------------------------------------------------------------------------------

PARTS = (
    "array<struct<type:string,text:string,ref:string,"
    "width:int,height:int,seconds:double,pages:int>>"
)


def escape(text: Column) -> Column:
    r"""``<``, any backslashes, ``|`` gets one backslash more, so no ``<|`` is left."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


_SEEN = "array<struct<shown:string,is_text:boolean,tokens:bigint,type:string,ref:string,part:int>>"


def join_texts(seen: Column) -> Column:
    """Visited parts with texts that stand side by side made one.

    A control string may begin in one part and end in a later one, so texts are
    escaped as they will be read.
    """

    def add(done: Column, part: Column) -> Column:
        last = F.get(done, F.size(done) - 1)
        longer = last.withField("shown", F.concat(last["shown"], part["shown"]))
        goes_on = part["is_text"] & F.coalesce(last["is_text"], F.lit(False))
        return F.when(
            goes_on, F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(longer))
        ).otherwise(F.concat(done, F.array(part)))

    return F.aggregate(seen, F.array().cast(_SEEN), add)


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\\\|", "<$1|")


def escape_role(role: Column) -> Column:
    """A role ends at the line break, so it holds none; ``%`` marks its code."""
    coded = F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A"))
    return escape(coded)


def unescape_role(role: Column) -> Column:
    coded = F.replace(unescape(role), F.lit("%0A"), F.lit("\n"))
    return F.replace(coded, F.lit("%25"), F.lit("%"))


def image_tokens(part: Column, patch: int = 28) -> Column:
    """One token per begun patch of the image."""
    sides = [
        F.greatest(F.lit(1), F.ceil(F.coalesce(part[s], F.lit(patch)) / patch))
        for s in ("width", "height")
    ]
    return (sides[0] * sides[1]).cast("long")


def audio_tokens(part: Column, per_second: float = 25.0) -> Column:
    length = F.coalesce(part["seconds"], F.lit(0.0)) * per_second
    return F.greatest(F.lit(1), F.ceil(length)).cast("long")


def document_tokens(part: Column, per_page: int = 800) -> Column:
    return (F.greatest(F.lit(1), F.coalesce(part["pages"], F.lit(1))) * per_page).cast("long")


COUNTERS: dict[str, Callable[[Column], Column]] = {
    "image": image_tokens,
    "audio": audio_tokens,
    "document": document_tokens,
}


def text_part(text: Column) -> Column:
    """A content list of one text part."""
    empty = F.lit(None)
    return F.array(
        F.struct(
            F.lit("text").alias("type"), text.alias("text"), empty.cast("string").alias("ref"),
            empty.cast("int").alias("width"), empty.cast("int").alias("height"),
            empty.cast("double").alias("seconds"), empty.cast("int").alias("pages"),
        )
    ).cast(PARTS)


def visit(part: Column, counters: Mapping[str, Callable[[Column], Column]]) -> Column:
    """What a part leaves in the output: its string (a text not escaped yet), whether it
    is text, its tokens.

    A type that is neither text nor known is kept as text.
    """
    shown = F.coalesce(part["text"], F.lit(""))
    is_text, tokens = F.lit(True), F.lit(0).cast("long")
    for kind, count in counters.items():
        hit = F.coalesce(part["type"] == kind, F.lit(False))
        shown = F.when(hit, F.lit(PLACEHOLDERS[kind])).otherwise(shown)
        is_text = F.when(hit, F.lit(False)).otherwise(is_text)
        tokens = F.when(hit, count(part)).otherwise(tokens)
    return F.struct(
        shown.alias("shown"), is_text.alias("is_text"), tokens.alias("tokens"),
        part["type"].alias("type"), part["ref"].alias("ref"),
    )


def format_chat(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    parts_col: str = "parts",
    learn_from: str = "assistant",
    counters: Mapping[str, Callable[[Column], Column]] | None = None,
) -> DataFrame:
    """One row per conversation: the formatted string and what belongs to it.

    Returns the conversation's id, ``formatted``, ``loss_spans`` (start and length
    in code points of the texts of role ``learn_from``, adjacent text parts as one),
    ``attachments``
    (turn and part number from 0, type, reference, expanded tokens, in order) and
    ``attachment_tokens``.

    Turns are ordered by turn, then role, then content; null turns come first. A
    null role or content is empty, rows of a null id are one conversation, and
    repeated rows are repeated turns. Other columns are ignored. Spans come from a
    running sum of lengths, so one shuffle on the conversation serves both that
    and the gathering. A conversation is one string and so is built in one task.
    """
    counters = COUNTERS if counters is None else counters
    content = F.coalesce(F.col(parts_col), F.array().cast(PARTS))
    flat = turns.select(
        F.col(conv_col).alias("_conv"),
        F.col(turn_col).alias("_turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("_role"),
        join_texts(
            F.transform(
                content, lambda part, i: visit(part, counters).withField("part", i.cast("int"))
            )
        ).alias("_seen"),
    ).withColumn(
        "_seen",
        F.transform(
            "_seen",
            lambda s: s.withField(
                "shown", F.when(s["is_text"], escape(s["shown"])).otherwise(s["shown"])
            ),
        ),
    )
    body = F.array_join(F.col("_seen.shown"), "")
    flat = flat.withColumn("_head", F.concat(F.lit(START), escape_role("_role"), F.lit("\n")))
    flat = flat.withColumn("_body", body)
    flat = flat.withColumn("_piece", F.concat("_head", "_body", F.lit(f"{END}\n")))
    in_order = Window.partitionBy("_conv").orderBy("_turn", "_role", "_body")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    placed = flat.withColumn(
        "_at", F.coalesce(F.sum(F.length("_piece")).over(before), F.lit(0)) + F.length("_head")
    ).withColumn("_no", F.row_number().over(in_order) - 1)
    lengths = F.transform("_seen", lambda s: F.length(s["shown"]))
    spans = F.transform(
        "_seen",
        lambda s, i: F.struct(
            (
                F.col("_at")
                + F.aggregate(F.slice(lengths, 1, i), F.lit(0), lambda total, n: total + n)
            ).cast("long").alias("start"),
            F.length(s["shown"]).cast("long").alias("length"),
            s["is_text"].alias("is_text"),
        ),
    )
    learned = F.when(
        F.col("_role") == learn_from, F.filter(spans, lambda s: s["is_text"])
    ).otherwise(F.array().cast("array<struct<start:bigint,length:bigint,is_text:boolean>>"))
    attached = F.filter(
        F.transform(
            "_seen",
            lambda s: F.struct(
                F.col("_no").alias("turn"), s["part"].alias("part"), s["type"].alias("type"),
                s["ref"].alias("ref"), s["tokens"].alias("tokens"), s["is_text"].alias("is_text"),
            ),
        ),
        lambda a: ~a["is_text"],
    )
    gathered = placed.groupBy("_conv").agg(
        F.array_sort(
            F.collect_list(
                F.struct("_no", "_piece", learned.alias("learned"), attached.alias("attached"))
            )
        ).alias("_all")
    )
    tidy = gathered.select(
        F.col("_conv").alias(conv_col),
        F.array_join(F.col("_all._piece"), "").alias("formatted"),
        F.transform(
            F.flatten("_all.learned"), lambda s: F.struct(s["start"], s["length"])
        ).alias("loss_spans"),
        F.transform(
            F.flatten("_all.attached"), lambda a: a.dropFields("is_text")
        ).alias("attachments"),
    )
    total = F.aggregate("attachments", F.lit(0).cast("long"), lambda n, a: n + a["tokens"])
    return tidy.withColumn("attachment_tokens", total)


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation: role, content unescaped (``text``), and the
    content as it stands (``content``), which :func:`read_parts` takes apart.

    Placeholders stay in the text as they are.
    """

    def turn(raw: Column) -> Column:
        cut = F.instr(raw, "\n")
        inner = F.length(raw) - cut - len(END) - 1
        body = F.substring(raw, cut + 1, inner)
        return F.struct(
            unescape_role(F.substring(raw, F.lit(1), cut - 1)).alias("role"),
            unescape(body).alias("text"),
            body.alias("content"),
        )

    pieces = F.split(formatted, START.replace("|", "\\|"))
    return let(pieces, lambda p: F.transform(F.slice(p, 2, F.size(p)), turn))


def read_parts(content: Column) -> Column:
    """Content as it stands between a turn's marks, as parts in order: type and text.

    Adjacent texts come back as one, unescaped. A placeholder is one only where it is
    not escaped, so a text that says ``<|image|>`` stays a text.
    """
    names = "|".join(re.escape(mark) for mark in PLACEHOLDERS.values())
    pieces = F.filter(
        F.split(content, f"(?={names})|" + "|".join(f"(?<={re.escape(m)})" for m in PLACEHOLDERS.values())),
        lambda piece: piece != "",
    )

    def part(piece: Column) -> Column:
        kind = F.lit("text")
        for name, mark in PLACEHOLDERS.items():
            kind = F.when(piece == mark, F.lit(name)).otherwise(kind)
        text = F.when(kind == "text", unescape(piece))
        return F.struct(kind.alias("type"), text.alias("text"))

    return F.transform(pieces, part)


def read_loss(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.array_join(
        F.transform(
            spans,
            lambda s: unescape(
                F.substring(
                    formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")
                )
            ),
        ),
        "",
    )


def chat_digest(formatted: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """Counts and digests read back from the output of :func:`format_chat`."""
    seen = formatted.select(
        conv_col,
        read_turns(F.col("formatted")).alias("turns"),
        read_loss(F.col("formatted"), F.col("loss_spans")).alias("learned"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        F.size("attachments").cast("long").alias("n_attachments"),
        "attachment_tokens",
    )
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return seen.select(
        conv_col,
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, "").cast("binary"), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2(F.col("learned").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
        "n_attachments",
        "attachment_tokens",
    )
