"""Conversations of typed content parts as one marked-up string each, with a loss mask.

A turn is `<|turn|>role`, a line feed, its content, `<|end|>`. The content is what a visitor makes of the turn's
parts, in order: text is escaped; an image, audio or document part becomes a placeholder, and its reference with
the number of tokens that the placeholder stands for is recorded; the k-th placeholder of a conversation belongs to
its k-th attachment. Control strings inside texts get a backslash after their first character, and a backslash is
doubled, so that one pass over `\\x` pairs restores every text. In a role, a line feed gets a backslash before it.

The mask covers each assistant text. A span names its turn, the code points before it in the whole string and in
its turn's piece, and its length. Texts of several parts give a span each.

Turns are ordered by `turn`, role and text (nulls first), so ties and repeated rows give a fixed result, each row
being a turn. Null role or text is empty; a null list of parts is no content; an unknown kind of part is kept as a
`<|file|>` placeholder. A null conversation id is one conversation. An empty table gives none. One conversation is one
row, so one task must hold its string; nothing larger than that meets in a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURN, END = "<|turn|>", "<|end|>"
CONTROLS = ("<|", "</s>", "<s>", "[INST]", "[/INST]")
PLACEHOLDERS = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}
PART = ("struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>")
#: Tokens for a square of an image, a second of audio, a page.
PATCH, PER_SECOND, PER_PAGE = 28, 25, 256


def escaped(text: Column) -> Column:
    text = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    for control in CONTROLS:
        text = F.replace(text, F.lit(control), F.lit(control[0] + "\\" + control[1:]))
    return text


def escaped_role(role: Column) -> Column:
    """As a text, on one line: its first line feed without a backslash ends it."""
    return F.replace(escaped(role), F.lit("\n"), F.lit("\\\n"))


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def text_parts(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role and a single text part of each row of plain conversations."""
    part = F.named_struct(F.lit("kind"), F.lit("text"), F.lit("text"), F.col("text"))
    rest = [x.split(":") for x in PART[len("struct<"):-1].split(",")[2:]]
    whole = F.struct(part["kind"].alias("kind"), part["text"].alias("text"),
                     *[F.lit(None).cast(kind).alias(name) for name, kind in rest])
    return turns.select("conv_id", "turn", "role", F.array(whole).alias("parts"))


def tokens_of(part: Column) -> Column:
    """Tokens that an attachment's placeholder is expanded to; unknown sizes count as one."""
    image = F.ceil(part["width"] / F.lit(PATCH)) * F.ceil(part["height"] / F.lit(PATCH))
    return F.coalesce(F.when(part["kind"] == "image", image).when(
        part["kind"] == "audio", F.ceil(part["seconds"] * PER_SECOND)).when(
        part["kind"] == "document", part["pages"] * PER_PAGE), F.lit(1)).cast("long")


def visited(part: Column) -> Column:
    """A part's piece of the string; attachment and its tokens where it is one."""
    mark = F.lit("<|file|>")
    for kind, placeholder in PLACEHOLDERS.items():
        mark = F.when(part["kind"] == kind, F.lit(placeholder)).otherwise(mark)
    is_text = part["kind"].eqNullSafe(F.lit("text"))
    return F.struct(
        F.when(is_text, escaped(part["text"])).otherwise(mark).alias("piece"), is_text.alias("is_text"),
        F.when(~is_text, F.struct(part["kind"].alias("kind"), part["ref"].alias("ref"),
                                  tokens_of(part).alias("n_tokens"))).alias("attachment"))


def formatted(turns: DataFrame, learned_role: str = "assistant") -> DataFrame:
    """conv_id, `formatted`, `loss_spans` and `attachments` of rows conv_id, turn, role, parts."""
    flat = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.transform(
        F.coalesce("parts", F.array().cast(f"array<{PART}>")), visited).alias("seen"))
    content = F.array_join(F.transform("seen", lambda x: x["piece"]), "")
    head = F.concat(F.lit(TURN), escaped_role(F.col("role")), F.lit("\n"))
    flat = flat.select("conv_id", "turn", "role", "seen", F.concat(head, content, F.lit(END)).alias("piece"),
                       F.char_length(head).alias("head"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "piece")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    placed = flat.withColumns({
        "number": F.row_number().over(order) - 1,
        "start": F.coalesce(F.sum(F.char_length("piece").cast("long")).over(before), F.lit(0))})
    # A part's place in its turn is the length of the parts before it.
    ahead = lambda i: F.aggregate(F.slice("seen", 1, i), F.lit(0), lambda a, x: a + F.char_length(x["piece"]))
    spans = F.transform(F.col("seen"), lambda x, i: F.struct(
        F.col("number").alias("turn"), (F.col("start") + F.col("head") + ahead(i)).alias("start"),
        (F.col("head") + ahead(i)).alias("head"), F.char_length(x["piece"]).alias("length"),
        x["is_text"].alias("is_text")))
    placed = placed.withColumn("spans", F.when(F.col("role") == learned_role, F.filter(
        spans, lambda x: x["is_text"])).otherwise(F.filter(spans, lambda x: F.lit(False))))
    rows = placed.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(
        "number", "piece", "spans", F.filter("seen", lambda x: ~x["is_text"]).alias("files")))).alias("turns"))
    pick = lambda name: F.transform("turns", lambda x: x[name])
    return rows.select(
        "conv_id", F.array_join(pick("piece"), "").alias("formatted"),
        F.transform(F.flatten(pick("spans")), lambda x: F.struct(
            x["turn"].alias("turn"), x["start"].alias("start"), x["head"].alias("head"),
            x["length"].alias("length"))).alias("loss_spans"),
        F.transform(F.flatten(pick("files")), lambda x: x["attachment"]).alias("attachments"))


def read_turns(text: Column) -> Column:
    """Array of (role, text) read from a formatted string, unescaped; placeholders stay in the text."""
    pieces = F.filter(F.split(text, r"<\|end\|>", -1), lambda x: x != "")
    head = lambda x: F.regexp_extract(x, r"(?s)^<\|turn\|>(?:\\.|[^\\\n])*\n", 0)
    return F.transform(pieces, lambda x: F.struct(
        unescaped(F.substr(head(x), F.lit(len(TURN) + 1), F.char_length(head(x)) - len(TURN) - 1)).alias("role"),
        unescaped(F.substr(x, F.char_length(head(x)) + 1)).alias("text")))


def masked_text(text: Column, spans: Column) -> Column:
    """All text under the mask, unescaped: each span is cut from its own turn's piece."""
    pieces = F.split(text, r"<\|end\|>", -1)
    cut = F.transform(F.arrays_zip(F.transform(spans, lambda x: F.get(pieces, x["turn"])).alias("piece"),
                                   spans.alias("span")),
                      lambda x: unescaped(F.substr(x["piece"], x["span"]["head"] + 1, x["span"]["length"])))
    return F.array_join(cut, "")


def digests(conversations: DataFrame) -> DataFrame:
    """What a reader of the formatted strings finds: turns, loss text and lengths per conversation."""
    rows = formatted(text_parts(conversations)).withColumns({
        "turns": read_turns(F.col("formatted")), "loss": masked_text(F.col("formatted"), F.col("loss_spans"))})
    said = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return rows.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"))
