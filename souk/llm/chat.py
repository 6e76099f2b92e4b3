"""Chat formatting of typed content parts, in built-in functions only.

A turn is a role and an array of parts: text, image, audio or document.  A visitor turns each part
into a piece of the turn's body, in order: text is escaped, anything else
becomes a numbered placeholder that repeats its expanded token count, while its
reference, kind and count are recorded beside the text.

Template: ``<turn>ROLE<says>BODY</turn>``.  Every mark begins with ``<``, which cannot
occur in escaped text: ``\\`` is written ``\\b`` and ``<`` is written ``\\l``.
Undoing ``\\l`` first and ``\\b`` second restores any text exactly, so a text that
quotes the template, or the escapes, stays a text.

One shuffle gathers the turns of a conversation; the conversation is one row of
the result, so its turns have to meet.

Defined results: null roles and texts are empty, a null array of parts is an empty
body, unknown kinds of parts are text; turns are ordered by number (null first), then
role and body, and repeated rows are repeated turns; a null conversation id is a
conversation of its own; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The template's marks.
OPEN, SAYS, CLOSE = "<turn>", "<says>", "</turn>"
PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
PATCH = 28  # pixels of an image's side that one token covers
TOKENS_PER_SECOND = 12.5  # of audio
TOKENS_PER_PAGE = 800  # of a document
LEARNT_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("\\"))


def text_parts(turns: DataFrame, text: str = "text") -> DataFrame:
    """Turns whose only part is their text."""
    none = [F.lit(None).cast(t).alias(n) for n, t in (("ref", "string"), ("width", "int"), ("height", "int"), ("seconds", "double"), ("pages", "int"))]
    part = F.struct(F.lit("text").alias("type"), F.coalesce(F.col(text), F.lit("")).alias("text"), *none)
    return turns.select("conv_id", "turn", "role", F.array(part).alias("parts"))


def _tokens(p: Column) -> Column:
    side = lambda x: F.ceil(F.greatest(F.coalesce(x, F.lit(0)), F.lit(0)) / PATCH)
    image = side(p["width"]) * side(p["height"])
    audio = F.ceil(F.coalesce(p["seconds"], F.lit(0.0)) * TOKENS_PER_SECOND)
    pages = F.coalesce(p["pages"], F.lit(0)) * TOKENS_PER_PAGE
    return F.when(p["type"] == "image", image).when(p["type"] == "audio", audio).otherwise(pages).cast("long")


def visit(p: Column, at: Column) -> Column:
    """What a part becomes: piece, whether it is text, and the attachment's number in its turn, kind, reference and tokens."""
    attached = F.coalesce(p["type"].isin("image", "audio", "document"), F.lit(False))
    mark = F.concat(F.lit("<"), p["type"], F.lit(" "), (at + 1).cast("string"), F.lit(" "), _tokens(p).cast("string"), F.lit(">"))
    return F.struct(
        F.when(attached, mark).otherwise(escape(p["text"])).alias("piece"),
        (~attached).alias("is_text"),
        (at + 1).cast("int").alias("place"),
        p["type"].alias("type"),
        p["ref"].alias("ref"),
        F.when(attached, _tokens(p)).otherwise(F.lit(0).cast("long")).alias("tokens"),
    )


def _pieces_mask(head: Column, pieces: Column) -> Column:
    """Spans of the text pieces in a turn (from ``head``, the characters before its body)."""
    zero = F.struct(head.cast("long").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("out"))

    def step(acc, x):
        end = acc["at"] + F.length(x["piece"])
        span = F.array(F.struct(acc["at"].alias("start"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(x["is_text"] & (end > acc["at"]), F.concat(acc["out"], span)).otherwise(acc["out"]).alias("out"))

    return F.aggregate(pieces, zero, step, lambda acc: acc["out"])


def format_conversations(turns: DataFrame) -> DataFrame:
    """conv_id, n_turns, formatted, loss_mask (spans of the assistant's texts, code points, end exclusive)
    and attachments (turn from 1, place, type, ref, tokens) of each conversation of ``turns`` (conv_id, turn, role, parts)."""
    pieces = F.transform(F.coalesce(F.col("parts"), F.array().cast(f"array<{PART}>")), visit)
    t = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), pieces.alias("pieces"))
    head = F.concat(F.lit(OPEN), escape(F.col("role")), F.lit(SAYS))
    t = t.withColumn("head", F.length(head)).withColumn("out", F.concat(head, F.array_join(F.transform("pieces", lambda x: x["piece"]), ""), F.lit(CLOSE)))
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "out")
    t = t.withColumn("number", F.row_number().over(order))
    t = t.withColumn("before", F.coalesce(F.sum(F.length("out").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    t = t.withColumn("mask", F.when(F.col("role") == LEARNT_ROLE, _pieces_mask(F.col("before") + F.col("head"), F.col("pieces"))).otherwise(none))
    attached = F.transform(
        F.filter("pieces", lambda x: ~x["is_text"]),
        lambda x: F.struct(F.col("number").alias("turn"), x["place"].alias("place"), x["type"].alias("type"), x["ref"].alias("ref"), x["tokens"].alias("tokens")),
    )
    t = t.withColumn("attached", attached)
    every = F.sort_array(F.collect_list(F.struct("number", "out", "mask")))
    whole = t.groupBy("conv_id").agg(every.alias("t"), F.flatten(F.collect_list("attached")).alias("attachments"))
    return whole.select(
        "conv_id",
        F.size("t").cast("long").alias("n_turns"),
        F.array_join(F.transform("t", lambda x: x["out"]), "").alias("formatted"),
        F.flatten(F.transform("t", lambda x: x["mask"])).alias("loss_mask"),
        F.sort_array("attachments").alias("attachments"),
    )


def read_back(formatted: Column) -> Column:
    """array<struct<role, text, placeholders>> of a formatted conversation; text without the placeholders."""
    pieces = F.filter(F.split(formatted, CLOSE, -1), lambda x: x != "")

    def turn(x):
        inner = F.substring(x, len(OPEN) + 1, F.length(x))
        role = F.substring_index(inner, SAYS, 1)
        body = F.substring(inner, F.length(role) + len(SAYS) + 1, F.length(inner))
        marks = r"<[a-z]+ [0-9]+ [0-9]+>"
        return F.struct(unescape(role).alias("role"), unescape(F.regexp_replace(body, marks, "")).alias("text"), F.regexp_extract_all(body, F.lit(marks), F.lit(0)).alias("placeholders"))

    return F.transform(pieces, turn)


def loss_text(formatted: Column, mask: Column) -> Column:
    """The unescaped text under a loss mask, nothing between the spans."""
    cut = F.transform(mask, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))
    return F.array_join(cut, "")


def conversation_digests(conversations: DataFrame) -> DataFrame:
    """Digests of every conversation, read back from its formatted text and loss mask."""
    out = format_conversations(text_parts(conversations))
    turns = F.array_join(F.transform(read_back(F.col("formatted")), lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    loss = loss_text(F.col("formatted"), F.col("loss_mask"))
    out = out.withColumn("__loss", loss).withColumn("__back", F.size(read_back(F.col("formatted"))))
    return out.select(
        "conv_id",
        F.col("__back").cast("long").alias("n_turns"),
        F.sha2(turns, 256).alias("turns_sha256"),
        F.length("__loss").cast("long").alias("loss_chars"),
        F.sha2("__loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def with_quoting_conversation(conversations: DataFrame) -> DataFrame:
    """The conversations and conversation -7, whose two texts quote the template."""
    text = "\\### Assistant: </turn> ok"
    kinds = dict(conversations.dtypes)
    rows = conversations.sparkSession.createDataFrame([(-7, 0, "user", text), (-7, 1, "assistant", text)], "conv_id long, turn long, role string, text string")
    rows = rows.select(*[F.col(c).cast(kinds[c]).alias(c) for c in ("conv_id", "turn", "role", "text")])
    return conversations.select("conv_id", "turn", "role", "text").unionByName(rows)


#: DuckDB: the rows of ``conversation_digests`` of the table and conversation -7.
CONVERSATIONS_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
written AS (
  SELECT *, length(text) + length(regexp_replace(text, '[^\\<]', '', 'g')) AS n_text,
            length(role) + length(regexp_replace(role, '[^\\<]', '', 'g')) AS n_role FROM turns)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(n_text + n_role + 19)::BIGINT AS formatted_chars
FROM written GROUP BY conv_id
"""
