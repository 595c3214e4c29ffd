"""Chat formatting with typed content parts, in DataFrame functions only.

A message holds an array of parts (type, text, ref, and sizes). A visitor has
one method per part type; each returns the expression of the placeholder that
the part becomes and of the tokens it will be expanded to. Parts are flattened
in order, turns are joined by the template, and attachments are recorded with
their place, reference and tokens. Texts are escaped so that no control string
can come from them, and the escape is reversed when the output is read back.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n`` for each turn. In texts and
roles ``&`` becomes ``&amp;``, and ``<`` becomes ``&lt;`` before ``|`` and at the
end, where the next part could go on with ``|``; a line break in a role becomes
``&#10;``. The loss mask is an array of spans of the formatted string, in code
points: the texts of the learnt role, without markers or placeholders.

Defined cases: null text and null roles are empty; null parts are dropped, and
unknown part types are read as text; turns are ordered by ``turn``, nulls
first, then by role and parts, so ties have one order; repeated rows are
repeated turns; rows without a conversation id form one conversation; an empty
table gives an empty result; other columns are ignored. A conversation is one
row of the output, so its turns are gathered; nothing else is. Places are
running sums over its turns, so work grows with its length only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

START, END = "<|im_start|>", "<|im_end|>"
PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"


def escape(x: Column) -> Column:
    return F.regexp_replace(F.replace(x, F.lit("&"), F.lit("&amp;")), r"<(?=\||\z)", "&lt;")


def unescape(x: Column) -> Column:
    return F.replace(F.replace(F.replace(x, F.lit("&#10;"), F.lit("\n")), F.lit("&lt;"), F.lit("<")), F.lit("&amp;"), F.lit("&"))


class PartVisitor:
    """What each type of part becomes: a pair of its placeholder or escaped text and its expanded tokens (0: none known)."""

    def __init__(self, patch: int = 28, audio_rate: float = 25.0, page_tokens: int = 512):
        self.patch, self.audio_rate, self.page_tokens = patch, audio_rate, page_tokens

    def image(self, part: Column) -> tuple[Column, Column]:
        side = lambda n: F.ceil(F.coalesce(part[n], F.lit(0)) / F.lit(float(self.patch)))
        return F.lit("<|image|>"), side("width") * side("height")

    def audio(self, part: Column) -> tuple[Column, Column]:
        return F.lit("<|audio|>"), F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * self.audio_rate)

    def document(self, part: Column) -> tuple[Column, Column]:
        return F.lit("<|document|>"), F.coalesce(part["pages"], F.lit(0)) * self.page_tokens

    def text(self, part: Column) -> tuple[Column, Column]:
        return escape(F.coalesce(part["text"], F.lit(""))), F.lit(0)

    def visit(self, part: Column) -> Column:
        """struct(kind, body, tokens, ref) of one part."""
        kinds = ("image", "audio", "document")
        body, tokens = (x for x in self.text(part))
        for kind in kinds:
            own, size = getattr(self, kind)(part)
            body, tokens = F.when(part["type"] == kind, own).otherwise(body), F.when(part["type"] == kind, size).otherwise(tokens)
        kind = F.when(part["type"].isin(*kinds), part["type"]).otherwise(F.lit("text"))
        return F.struct(kind.alias("kind"), body.alias("body"), tokens.cast("long").alias("tokens"), part["ref"].alias("ref"))


def text_part(text: Column | str) -> Column:
    """An array of one text part, for tables whose messages are plain texts."""
    text = F.col(text) if isinstance(text, str) else text
    none = {"ref": "string", "width": "int", "height": "int", "seconds": "double", "pages": "int"}
    return F.array(F.struct(F.lit("text").alias("type"), F.coalesce(text, F.lit("")).alias("text"), *(F.lit(None).cast(t).alias(n) for n, t in none.items())))


def format_chats(messages: DataFrame, visitor: PartVisitor | None = None, learnt: str = "assistant") -> DataFrame:
    """``messages(conv_id, turn, role, parts)`` → one row per conversation.

    Columns: conv_id, formatted, loss_spans (array of start and end, with the number and the start of their turn),
    attachments (array of turn_no, type, ref, tokens, position) and expanded_tokens.
    """
    visitor = visitor or PartVisitor()
    parts = F.transform(F.filter(F.coalesce(F.col("parts"), F.array().cast(f"array<{PART}>")), lambda p: p.isNotNull()), visitor.visit)
    role = F.coalesce(F.col("role"), F.lit(""))
    head = F.concat(F.lit(START), F.replace(escape(role), F.lit("\n"), F.lit("&#10;")), F.lit("\n"))
    turns = messages.select("conv_id", "turn", role.alias("role"), head.alias("head"), parts.alias("visited"))
    # of each part what is told of it, and its place in the turn
    told = F.transform("visited", lambda p: F.struct(p["kind"].alias("kind"), p["ref"].alias("ref"), p["tokens"].alias("tokens"), F.length(p["body"]).cast("long").alias("size")))
    body = F.concat(F.col("head"), F.array_join(F.transform("visited", lambda p: p["body"]), ""), F.lit(END + "\n"))
    turns = turns.select("conv_id", "turn", "role", body.alias("body"), _placed(told, F.length("head").cast("long")).alias("marks"), F.length(body).cast("long").alias("size"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "body", "marks")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    turns = turns.withColumns({"at": F.coalesce(F.sum("size").over(before), F.lit(0)), "turn_no": F.row_number().over(order).cast("long") - 1})
    spans = F.transform(F.filter("marks", lambda m: (m["kind"] == "text") & (F.col("role") == learnt)), lambda m: F.struct((F.col("at") + m["at"]).alias("start"), (F.col("at") + m["at"] + m["size"]).alias("end"), F.col("turn_no").alias("turn_no"), F.col("at").alias("turn_start")))
    found = F.transform(F.filter("marks", lambda m: m["kind"] != "text"), lambda m: F.struct(F.col("turn_no").alias("turn_no"), m["kind"].alias("type"), m["ref"].alias("ref"), m["tokens"].alias("tokens"), (F.col("at") + m["at"]).alias("position")))
    turn = F.struct("turn_no", "body", spans.alias("spans"), found.alias("found"))
    chats = turns.select("conv_id", turn.alias("t")).groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("ts"))
    every = lambda name: F.flatten(F.transform("ts", lambda t: t[name]))
    chats = chats.select("conv_id", F.array_join(F.transform("ts", lambda t: t["body"]), "").alias("formatted"), every("spans").alias("loss_spans"), every("found").alias("attachments"))
    return chats.withColumn("expanded_tokens", F.aggregate("attachments", F.lit(0).cast("long"), lambda a, x: a + x["tokens"]))


def _placed(parts: Column, first: Column) -> Column:
    """A message's parts, each with its place ``at`` behind the ``first`` code points, by one pass over them."""
    kind = "struct<kind:string,ref:string,tokens:bigint,size:bigint,at:bigint>"
    keep = lambda p, at: F.struct(*(p[n].alias(n) for n in ("kind", "ref", "tokens", "size")), at.alias("at"))
    step = lambda acc, p: F.struct((acc["at"] + p["size"]).alias("at"), F.concat(acc["out"], F.array(keep(p, acc["at"]))).alias("out"))
    return F.aggregate(parts, F.struct(first.alias("at"), F.array().cast(f"array<{kind}>").alias("out")), step)["out"]


def _pieces(formatted: str) -> Column:
    """What stands before the first start mark, and behind each."""
    return F.split(formatted, r"<\|im_start\|>")


def read_turns(formatted: str) -> Column:
    """The turns of a formatted string as an array of (role, text), unescaped; placeholders stay in the text."""
    pieces = F.filter(_pieces(formatted), lambda p, i: i > 0)
    text = lambda p: F.substring(p, F.length(F.substring_index(p, "\n", 1)) + 2, F.length(p))
    role = lambda p: unescape(F.substring_index(p, "\n", 1))
    return F.transform(pieces, lambda p: F.struct(role(p).alias("role"), unescape(F.substring_index(text(p), END, 1)).alias("text")))


def read_loss(formatted: str, spans: str) -> Column:
    """The texts under the loss mask, unescaped, in order, as an array; each is read within its turn."""
    within = lambda piece, s: F.substring(piece, (s["start"] - s["turn_start"] - len(START)).cast("int") + 1, (s["end"] - s["start"]).cast("int"))
    read = lambda pieces: F.transform(spans, lambda s: unescape(within(F.element_at(pieces, (s["turn_no"] + 2).cast("int")), s)))
    return F.transform(F.array(_pieces(formatted)), read)[0]  # the array binds the pieces, which are cut once
