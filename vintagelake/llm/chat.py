r"""Chat formatting: typed content parts to one string per conversation.

A turn is written ``### <role>: <content></turn>\n``.  Its content is a list of
typed parts.  Text is escaped; an image, audio or document part becomes an
ordered placeholder ``<|kind:n|>``, n counting the conversation's attachments
from 0, and is recorded in ``attachments`` with its reference and the tokens
it takes when expanded.

Escaping is reversible: a backslash becomes ``\b``, and the strings that begin
a control, ``###``, ``</turn>`` and ``<|``, become ``\h``, ``\e`` and ``\p``; in
a role a colon becomes ``\c``.  Every backslash in the output thus begins a
two-character code, and no control string can come from a text.

Only DataFrame functions run here.  Turns are numbered by one window per
conversation, which also gives every turn's place in the string, so reading
back needs no search from the beginning.

Defined results: null texts and roles are empty; rows are ordered by turn
(nulls first), then role, then content, so ties have one order and repeated
rows are all kept; rows with a null conversation id form one conversation; a
conversation is one string, so one task holds it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

END = "</turn>\n"
PART = "struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
# order matters for reading: the backslash is restored last, and escaped first
CODES = [("\\", r"\b"), ("###", r"\h"), ("</turn>", r"\e"), ("<|", r"\p")]


def escape(text: Column) -> Column:
    for plain, code in CODES:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    for plain, code in reversed(CODES):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def text_part(text: Column) -> Column:
    """A content list of one text part."""
    null = F.lit(None)
    return F.array(F.struct(
        F.lit("text").alias("kind"), F.coalesce(text, F.lit("")).alias("text"), null.cast("string").alias("ref"),
        null.cast("int").alias("width"), null.cast("int").alias("height"), null.cast("double").alias("seconds"),
        null.cast("int").alias("pages")))


def expanded_tokens(part: Column, patch: int = 14, per_second: float = 25.0, per_page: int = 256) -> Column:
    """Tokens that an attachment takes: patches of an image, frames of audio, pages of a document."""
    def side(c: str) -> Column:
        return F.ceil(F.coalesce(part[c], F.lit(0)) / F.lit(patch))

    return (F.when(part["kind"] == "image", side("width") * side("height"))
            .when(part["kind"] == "audio", F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * F.lit(per_second)))
            .when(part["kind"] == "document", F.coalesce(part["pages"], F.lit(0)) * F.lit(per_page))
            .otherwise(F.lit(0))).cast("long")


def visit(part: Column, number: Column) -> Column:
    """What one part leaves in the output: escaped text, or the placeholder of attachment ``number``."""
    return F.when(part["kind"] == "text", escape(F.coalesce(part["text"], F.lit("")))).otherwise(
        F.concat(F.lit("<|"), F.coalesce(part["kind"], F.lit("unknown")), F.lit(":"), number.cast("string"), F.lit("|>")))


def format_turns(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                 parts: str = "parts", learn_from: str = "assistant") -> DataFrame:
    """One row per conversation: conv_id, n_turns, formatted, turn_starts,
    loss_spans and attachments.

    Places are code points from 0.  ``turn_starts`` has each turn's beginning;
    ``loss_spans`` (turn, start, length) covers the content of the turns to
    learn from and nothing else; ``attachments`` lists turn, kind, number,
    place of the placeholder's turn, reference and expanded token count.
    """
    def other(p: Column) -> Column:
        return ~p["kind"].eqNullSafe(F.lit("text"))

    own = rows.select(rows[conv].alias("conv_id"), rows[turn].alias("turn"),
                      F.coalesce(rows[role], F.lit("")).alias("role"),
                      F.coalesce(rows[parts], F.array().cast(f"array<{PART}>")).alias("parts"))
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.to_json("parts")]
    by_turn = Window.partitionBy("conv_id").orderBy(*order)
    before = by_turn.rowsBetween(Window.unboundedPreceding, -1)
    own = own.withColumn("n_other", F.size(F.filter("parts", other)))
    own = own.withColumn("first_other", F.coalesce(F.sum("n_other").over(before), F.lit(0)))
    own = own.withColumn("number", F.row_number().over(by_turn) - 1)
    # the number of a part among the turn's attachments is that of attachments before it
    flat = F.transform("parts", lambda p, i: visit(
        p, F.col("first_other") + F.size(F.filter(F.slice("parts", F.lit(1), i), other))))
    content = F.when(F.col("n_other") == 0, F.array_join(F.transform("parts", lambda p: visit(p, F.lit(0))), ""))
    content = content.otherwise(F.array_join(flat, ""))
    head = F.concat(F.lit("### "), F.replace(escape(F.col("role")), F.lit(":"), F.lit(r"\c")), F.lit(": "))
    own = own.select("conv_id", "number", "role", "parts", "first_other", "n_other",
                     head.alias("head"), content.alias("content"))
    own = own.withColumn("piece", F.concat("head", "content", F.lit(END)))
    by_number = Window.partitionBy("conv_id").orderBy("number")
    own = own.withColumn("start", F.coalesce(
        F.sum(F.char_length("piece").cast("long")).over(by_number.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    others = F.filter("parts", other)
    attached = F.when(F.col("n_other") > 0, F.transform(others, lambda p, i: F.struct(
        F.col("number").alias("turn"), p["kind"].alias("kind"), (F.col("first_other") + i).alias("number"),
        F.col("start").alias("turn_start"), p["ref"].alias("ref"), expanded_tokens(p).alias("n_tokens"))))
    turns = own.select("conv_id", F.struct(
        "number", "piece", "start",
        F.when(F.col("role") == learn_from, F.struct(
            F.col("number").alias("turn"),
            (F.col("start") + F.char_length("head")).alias("start"),
            F.char_length("content").cast("long").alias("length"))).alias("loss"),
        attached.alias("attached")).alias("t"))
    grouped = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return grouped.select(
        "conv_id", F.size("t").cast("long").alias("n_turns"),
        F.array_join("t.piece", "").alias("formatted"),
        F.col("t.start").alias("turn_starts"),
        F.filter("t.loss", lambda x: x.isNotNull()).alias("loss_spans"),
        F.flatten(F.filter("t.attached", lambda x: x.isNotNull())).alias("attachments"))


def read_back(formatted: DataFrame) -> DataFrame:
    """The turns (role, text) and the texts under the loss mask, from the formatted strings."""
    pieces = F.split("formatted", F.lit(r"</turn>\n"), -1)
    out = formatted.withColumn("pieces", F.slice(pieces, 1, F.size(pieces) - 1))  # nothing follows the last end

    def turn(p: Column) -> Column:
        colon = F.instr(p, ": ")
        return F.struct(
            unescape(F.replace(p.substr(F.lit(5), colon - 5), F.lit(r"\c"), F.lit(":"))).alias("role"),
            unescape(p.substr(colon + 2, F.char_length(p))).alias("text"))

    # a span's place in its own turn's piece, so that no string is walked from its beginning again
    loss = F.transform("loss_spans", lambda s: unescape(F.get("pieces", s["turn"]).substr(
        (s["start"] - F.get("turn_starts", s["turn"]) + 1).cast("int"), s["length"].cast("int"))))
    return out.withColumn("turns", F.transform("pieces", turn)).withColumn("loss_texts", loss).drop("pieces")


def digest(formatted: DataFrame) -> DataFrame:
    """The digest columns of the contract, read back from the operator's output."""
    back = read_back(formatted)
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", "n_turns",
        F.sha2(F.encode(turns, "UTF-8"), 256).alias("turns_sha256"),
        F.char_length(F.array_join("loss_texts", "")).cast("long").alias("loss_chars"),
        F.sha2(F.encode(F.array_join("loss_texts", ""), "UTF-8"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"))
