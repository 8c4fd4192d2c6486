"""Chat formatting of conversations with typed content parts, in built-in expressions only.

A visitor flattens the parts of each turn (text, image, audio, document) into one string: text is escaped, every other
part leaves a placeholder at its place, with a row in ``attachments`` (kind, reference, byte offset of the placeholder,
tokens it expands to). Turns are marked by control strings; a control string inside a text gets one backslash after its
first character (one more where it has some already), which ``unescape`` takes away again.

Defined cases: null text is empty; null role counts as an empty role name; turns are ordered by (turn, role, parts) with
null turns first, so ties and repeated rows keep one fixed order; a null conv_id is one conversation of its own; an
unknown or null kind is a text part; a turn with no parts is an empty turn; sizes that are null count as zero tokens.
Other columns of the input are ignored. One conversation becomes one row, as its digest and mask need it whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BOS = "<s>"
TURNS = {"system": ("[SYS]", "[/SYS]"), "user": ("[INST]", "[/INST]"), "assistant": ("[ANS]", "</s>")}
OTHER = ("[ROLE]", "[:]", "[/ROLE]")
PLACEHOLDERS = {"image": "[IMG]", "audio": "[AUDIO]", "document": "[DOC]"}
PART = "struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
BODY = r"(/?s>|/?INST\]|/?SYS\]|ANS\]|/?ROLE\]|:\]|IMG\]|AUDIO\]|DOC\])"
ESCAPE = r"([<\[])(\\*)" + BODY
UNESCAPE = r"([<\[])(\\*)\\" + BODY
TURN = r"(?s)\[SYS\].*?\[/SYS\]|\[INST\].*?\[/INST\]|\[ANS\].*?</s>|\[ROLE\].*?\[:\].*?\[/ROLE\]"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPE, r"$1$2\\$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, UNESCAPE, "$1$2$3")


def text_part(text: Column) -> Column:
    """A one-part turn out of a plain text column."""
    return F.array(F.struct(F.lit("text").alias("kind"), text.alias("text")))


def _field(part: Column, kind, name: str) -> Column:
    return part[name] if name in kind.fieldNames() else F.lit(None)


def format_chats(
    df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", parts: str = "parts",
    patch: int = 14, audio_rate: float = 12.5, page_tokens: int = 256,
) -> DataFrame:
    """One row a conversation: conv_id, formatted, loss_spans (byte start and length of each assistant text),
    attachments, attachment_tokens, n_turns.

    An image expands to one token for each ``patch`` x ``patch`` square, audio to ``audio_rate`` tokens a second, a
    document to ``page_tokens`` a page.
    """
    part_type = df.schema[parts].dataType.elementType
    base = df.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.col(parts).alias("parts"))
    by_conv = Window.partitionBy("conv_id")
    order = by_conv.orderBy("turn", "role", F.to_json("parts"))
    numbered = base.withColumn("no", F.row_number().over(order))
    flat = numbered.select("conv_id", "no", "role", F.posexplode_outer("parts").alias("at_part", "part"))
    part = F.col("part")
    kind = F.coalesce(_field(part, part_type, "kind"), F.lit("text"))
    tokens = (
        F.when(kind == "image", F.ceil(_field(part, part_type, "width") / patch) * F.ceil(_field(part, part_type, "height") / patch))
        .when(kind == "audio", F.ceil(_field(part, part_type, "seconds") * audio_rate))
        .when(kind == "document", _field(part, part_type, "pages") * page_tokens)
    )
    opening = F.coalesce(*[F.when(F.col("role") == r, F.lit(o)) for r, (o, _) in TURNS.items()], F.concat(F.lit(OTHER[0]), escape(F.col("role")), F.lit(OTHER[1])))
    closing = F.coalesce(*[F.when(F.col("role") == r, F.lit(c)) for r, (_, c) in TURNS.items()], F.lit(OTHER[2]))
    typed = flat.select(
        "conv_id", "no", "role", F.coalesce("at_part", F.lit(0)).alias("at_part"),
        F.when(kind.isin(*PLACEHOLDERS), kind).alias("kind"),
        F.coalesce(_field(part, part_type, "text").cast("string"), F.lit("")).alias("text"),
        _field(part, part_type, "ref").cast("string").alias("ref"),
        F.coalesce(tokens.cast("long"), F.lit(0)).alias("tokens"),
    )
    # neighbouring text parts are one segment, each placeholder is its own: even numbers are text, odd ones placeholders
    in_turn = Window.partitionBy("conv_id", "no")
    before = F.sum(F.col("kind").isNotNull().cast("int")).over(in_turn.orderBy("at_part"))
    segments = typed.withColumn("segment", 2 * before - F.col("kind").isNotNull().cast("int")).groupBy("conv_id", "no", "role", "segment").agg(
        F.max("kind").alias("kind"), F.max("ref").alias("ref"), F.max("tokens").alias("tokens"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at_part", "text"))), lambda p: p["text"]), "").alias("text"),
    )
    shown = F.coalesce(*[F.when(F.col("kind") == k, F.lit(v)) for k, v in PLACEHOLDERS.items()], escape(F.col("text")))
    pieces = segments.select(
        "conv_id", "no", "role", "segment", "kind", "ref", "tokens", shown.alias("shown"),
        F.when(F.col("segment") == F.min("segment").over(in_turn), opening).otherwise("").alias("head"),
        F.when(F.col("segment") == F.max("segment").over(in_turn), closing).otherwise("").alias("tail"),
    )
    piece = F.concat("head", "shown", "tail")
    running = by_conv.orderBy("no", "segment").rowsBetween(Window.unboundedPreceding, -1)
    placed = pieces.withColumn("piece", piece).withColumn("at", F.coalesce(F.sum(F.octet_length("piece")).over(running), F.lit(0)) + len(BOS) + F.octet_length("head"))
    gathered = placed.groupBy("conv_id").agg(
        F.max("no").cast("long").alias("n_turns"),
        F.sum("tokens").alias("attachment_tokens"),
        F.array_sort(F.collect_list(F.struct("no", "segment", "piece"))).alias("pieces"),
        F.array_sort(F.collect_list(F.when((F.col("role") == "assistant") & (F.octet_length("shown") > 0), F.struct(F.col("at").alias("start"), F.octet_length("shown").cast("long").alias("length"))))).alias("loss_spans"),
        F.array_sort(F.collect_list(F.when(F.col("kind").isNotNull(), F.struct(F.col("at").alias("start"), "kind", "ref", "tokens")))).alias("attachments"),
    )
    formatted = F.concat(F.lit(BOS), F.array_join(F.transform("pieces", lambda p: p["piece"]), ""))
    return gathered.select("conv_id", formatted.alias("formatted"), "loss_spans", "attachments", "attachment_tokens", "n_turns")


def parse_turns(formatted: Column) -> Column:
    """Turns (role, text) of a formatted conversation, unescaped. Placeholders stay as they stand."""
    def one(t: Column) -> Column:
        cases = None
        for name, (o, c) in TURNS.items():
            value = F.struct(F.lit(name).alias("role"), unescape(t.substr(F.lit(len(o) + 1), F.length(t) - len(o) - len(c))).alias("text"))
            cases = F.when(t.startswith(o), value) if cases is None else cases.when(t.startswith(o), value)
        end = F.locate(OTHER[1], t)
        rest = F.struct(
            unescape(t.substr(F.lit(len(OTHER[0]) + 1), end - len(OTHER[0]) - 1)).alias("role"),
            unescape(t.substr(end + len(OTHER[1]), F.length(t) - end - len(OTHER[1]) - len(OTHER[2]) + 1)).alias("text"),
        )
        return cases.otherwise(rest)

    return F.transform(F.regexp_extract_all(formatted, F.lit(TURN), F.lit(0)), one)


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    raw = formatted.cast("binary")
    return F.array_join(F.transform(spans, lambda s: unescape(F.decode(F.substring(raw, s["start"].cast("int") + 1, s["length"].cast("int")), "UTF-8"))), "")
