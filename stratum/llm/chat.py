"""Chat formatting (9): typed content parts rendered into one training string.

A turn's content is an array of typed parts (text, image, audio, document).  A
visitor, one branch per kind, flattens each part into text or an ordered
placeholder, records the attachment it refers to and counts the tokens the
placeholder expands to.  Only DataFrame functions are used.

Template: ``<|im_start|>`` role ``\\n`` body ``<|im_end|>`` ``\\n`` per turn.
Inside roles and texts a back-slash becomes two and ``<|`` becomes ``<\\|``; in
roles a line break becomes back-slash and ``n``, so that the first line break
always ends the header.  Both are undone by ``read_back``.

Defined results: null text or null parts are empty; null role is the empty
role; turns are ordered by turn (nulls first), ties by role, then content, so
repeated rows stay and their order is fixed; rows with a null conv_id form one
conversation; an empty table gives no rows; other columns are ignored.
A conversation is one output row, so its turns meet in one row by nature of the
result; nothing else is gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, placed, span_texts

START, END = "<|im_start|>", "<|im_end|>"
PART = ("struct<kind:string,text:string,ref:string,width:int,height:int,"
        "seconds:double,pages:int>")
PARTS = f"array<{PART}>"

# Expanded token counts of attachments: parameters of the model family served.
IMAGE_PATCH = 28
AUDIO_TOKENS_PER_SECOND = 25
DOCUMENT_TOKENS_PER_PAGE = 512


def escape(text: Column) -> Column:
    return F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\")),
                     F.lit("<|"), F.lit("<\\|"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape(text: Column) -> Column:
    """Undo ``escape``: each back-slash gives way to the character after it."""
    return F.regexp_replace(text, r"\\([\\|])", "$1")


def unescape_role(role: Column) -> Column:
    """Undo ``escape_role``; escaped back-slashes are set apart first."""
    parts = F.split(role, r"\\\\", -1)
    return F.array_join(F.transform(parts, lambda p: F.replace(F.replace(
        p, F.lit("\\n"), F.lit("\n")), F.lit("\\|"), F.lit("|"))), "\\")


def text_part(text: Column) -> Column:
    """A content array of one text part."""
    null = F.lit(None)
    return F.array(F.struct(
        F.lit("text").alias("kind"), text.cast("string").alias("text"),
        null.cast("string").alias("ref"), null.cast("int").alias("width"),
        null.cast("int").alias("height"), null.cast("double").alias("seconds"),
        null.cast("int").alias("pages")))


def visit(part: Column) -> Column:
    """One part flattened: rendered text, attachment reference, token count."""
    kind = F.coalesce(part["kind"], F.lit("text"))

    def patches(side: Column) -> Column:
        return F.ceil(F.coalesce(side, F.lit(0)) / F.lit(IMAGE_PATCH)).cast("long")

    tokens = (F.when(kind == "image", patches(part["width"]) * patches(part["height"]))
              .when(kind == "audio", F.ceil(F.coalesce(part["seconds"], F.lit(0.0))
                                            * AUDIO_TOKENS_PER_SECOND).cast("long"))
              .when(kind == "document", F.coalesce(part["pages"], F.lit(0)).cast("long")
                    * DOCUMENT_TOKENS_PER_PAGE)
              .otherwise(F.lit(0).cast("long")))
    attached = kind.isin("image", "audio", "document")
    shown = F.when(attached, F.concat(F.lit("<|"), kind, F.lit("|>"))).otherwise(escape(part["text"]))
    return F.struct(shown.alias("shown"), attached.alias("attached"), kind.alias("kind"),
                    part["ref"].alias("ref"), tokens.alias("n_tokens"))


def format_chats(turns: DataFrame, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """Turn rows (conv_id, turn, role, parts) to one row per conversation.

    Result: conv_id, n_turns, formatted, ``loss`` (spans of formatted under the
    loss mask, code points), ``attachments`` (placeholder number, kind, ref,
    n_tokens in order of appearance).
    """
    body = F.transform(F.coalesce(F.col("parts"), F.array().cast(PARTS)), visit)
    seen = turns.select(
        F.col("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), body.alias("body"))
    grouped = seen.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(
        F.coalesce(F.col("turn"), F.lit(-(1 << 62))).alias("turn"), "role",
        F.array_join(F.transform("body", lambda b: b["shown"]), "").alias("shown"),
        F.filter("body", lambda b: b["attached"]).alias("attached")))).alias("turns"))

    def piece(t: Column) -> Column:
        head = F.concat(F.lit(START), escape_role(t["role"]), F.lit("\n"))
        return F.struct(head.alias("head"), t["shown"].alias("shown"),
                        t["role"].isin(*loss_roles).alias("loss"))

    def spoken(at: Column, p: Column) -> tuple[Column, Column, Column]:
        start = at + F.length(p["head"])
        end = start + F.length(p["shown"])
        return end + len(END) + 1, p["loss"], F.struct(start.alias("start"), end.alias("end"))

    attachments = F.transform(
        F.flatten(F.transform("turns", lambda t: t["attached"])),
        lambda a, i: F.struct(i.alias("placeholder"), a["kind"].alias("kind"),
                              a["ref"].alias("ref"), a["n_tokens"].alias("n_tokens")))
    with_pieces = grouped.select("conv_id", attachments.alias("attachments"),
                                 F.transform("turns", piece).alias("pieces"))
    return with_pieces.select(
        "conv_id", F.size("pieces").cast("long").alias("n_turns"),
        F.array_join(F.transform("pieces", lambda p: F.concat(
            p["head"], p["shown"], F.lit(END + "\n"))), "").alias("formatted"),
        placed(F.col("pieces"), "struct<start:bigint,end:bigint>", spoken).alias("loss"), "attachments")


def read_back(formatted: Column) -> Column:
    """``array<struct<role,text>>`` read from a formatted string alone."""
    chunks = F.split(formatted, r"<\|im_end\|>\n", -1)
    def turn(c: Column) -> Column:
        inner = F.substr(c, F.lit(len(START) + 1))
        head = F.substring_index(inner, "\n", 1)
        return F.struct(unescape_role(head).alias("role"),
                        unescape(F.substr(inner, F.length(head) + 2)).alias("text"))

    return let(chunks, lambda cs: F.transform(
        F.slice(cs, F.lit(1), F.size(cs) - 1), turn))


def loss_text(formatted: Column, loss: Column) -> Column:
    """The unescaped text under the loss mask, nothing between the spans."""
    return F.array_join(F.transform(span_texts(formatted, loss), unescape), "")
