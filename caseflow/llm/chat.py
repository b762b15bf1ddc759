"""Chat formatting with typed content parts, in DataFrame functions only.

A message's content is a list of typed parts. A visitor (one column function a
type) turns every part into a piece of text: a text part into its escaped text,
an image, audio or document part into a placeholder, with a reference to the
attachment and the number of tokens that the placeholder stands for. The pieces
of a message stay in order; a turn is its role, its pieces and the template's
marks, and a conversation is its turns in order.

All work on texts is done row by row before the one exchange by conversation;
a running window gives every turn its number and its place in the whole text.
The loss mask says which characters are learned: spans (turn, start inside the
turn, length), one for each text piece of a learned role, with
``turn_starts`` for places in the whole text.

Escaping: a backslash is doubled, and every string that the template or a
placeholder uses gets a backslash after its first character, so no text ever
holds a control string. ``read_back`` cuts a formatted text at its marks and
undoes this.

Defined results: a null text, part, content list or role is empty; a part of
an unknown or null type counts as text; a negative or null size counts as 0 tokens; turns of one
number are ordered by role, then by content, then by what was formatted; repeated rows are turns of their own; a null
turn number comes first; rows with a null conversation id are one conversation;
an empty table gives an empty result. A conversation is one row of the result
and must fit into one.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .arrow import quoted

PART_FIELDS = ("type", "text", "ref", "width", "height", "seconds", "pages")
PART_TYPE = "array<struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>>"
#: What placeholders expand to: pixels a side of an image patch, audio tokens a second, tokens a page.
PATCH, AUDIO_RATE, PAGE_TOKENS = 28, 25, 600


@dataclass(frozen=True)
class Template:
    """Marks around turns; each is one of ``<...>`` or ``[...]`` without inner
    brackets or backslashes. Learned roles have marks of their own."""

    open: str = "[INST]"
    close: str = "[/INST]"
    learned_open: str = "<s>"
    learned_close: str = "</s>"
    learned: tuple[str, ...] = ("assistant",)
    placeholders: dict[str, str] = field(default_factory=lambda: {
        "image": "<image>", "audio": "<audio>", "document": "<document>"})

    def controls(self) -> list[str]:
        return [self.open, self.close, self.learned_open, self.learned_close, *self.placeholders.values()]


def _literal(text: str) -> str:
    return "\\Q" + text + "\\E"


def escape(text: Column, template: Template) -> Column:
    """No control string is left in the text; ``unescape`` undoes it."""
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for control in template.controls():
        text = F.replace(text, F.lit(control), F.lit(control[0] + "\\" + control[1:]))
    return text


def unescape(text: Column) -> Column:
    """A pair of backslashes is one, a single one goes."""
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def _escape_role(role: Column, template: Template) -> Column:
    """As ``escape``; line ends, which end a role, become backslash and n."""
    return F.replace(escape(role, template), F.lit("\n"), F.lit("\\n"))


def _unescape_role(role: Column) -> Column:
    between = F.transform(F.split(role, r"\\\\"), lambda x: F.replace(F.replace(x, F.lit("\\n"), F.lit("\n")), F.lit("\\"), F.lit("")))
    return F.array_join(between, "\\")


# ------------------------------------------------------------ the visitor

def _whole(value: Column) -> Column:
    return F.greatest(F.coalesce(value, F.lit(0)), F.lit(0))


def image_tokens(part: Column) -> Column:
    return (F.ceil(_whole(part["width"]) / PATCH) * F.ceil(_whole(part["height"]) / PATCH)).cast("long")


def audio_tokens(part: Column) -> Column:
    return F.ceil(_whole(part["seconds"]) * AUDIO_RATE).cast("long")


def document_tokens(part: Column) -> Column:
    return _whole(part["pages"]).cast("long") * PAGE_TOKENS


EXPANSIONS: dict[str, Callable[[Column], Column]] = {
    "image": image_tokens, "audio": audio_tokens, "document": document_tokens}


def visit(part: Column, template: Template, expansions: dict[str, Callable[[Column], Column]]) -> Column:
    """(piece, kind, ref, tokens) of one part; kind is null for text."""
    attached = part["type"].isin(*template.placeholders)
    piece, tokens = escape(F.coalesce(part["text"], F.lit("")), template), F.lit(None).cast("long")
    for kind, mark in template.placeholders.items():
        piece = F.when(part["type"] == kind, F.lit(mark)).otherwise(piece)
        tokens = F.when(part["type"] == kind, expansions[kind](part)).otherwise(tokens)
    return F.struct(piece.alias("piece"), F.when(attached, part["type"]).alias("kind"),
                    F.when(attached, part["ref"]).alias("ref"), tokens.alias("tokens"))


def text_parts(text: Column) -> Column:
    """A plain text as a list of one part."""
    fields = {"type": F.lit("text"), "text": text.cast("string"), "ref": F.lit(None)}
    return F.array(F.struct(*[fields.get(c, F.lit(None)).alias(c) for c in PART_FIELDS])).cast(PART_TYPE)


# ------------------------------------------------------------- formatting

def format_turns(messages: DataFrame, template: Template, content: str, role: str, keep: Sequence[Column],
                 expansions: dict[str, Callable[[Column], Column]] = EXPANSIONS) -> DataFrame:
    """Row by row: the turn's text, its loss spans and its attachments, places
    counted from the turn's start."""
    parts = F.coalesce(F.col(content), F.array().cast(PART_TYPE))
    speaker = F.coalesce(F.col(role).cast("string"), F.lit(""))
    t = messages.select(*keep, speaker.alias("__role"), F.transform(
        F.filter(parts, lambda p: p.isNotNull()), lambda p: visit(p, template, expansions)).alias("__pieces"))
    learned = F.col("__role").isin(*template.learned)
    head = F.concat(F.when(learned, template.learned_open).otherwise(template.open),
                    _escape_role(F.col("__role"), template), F.lit("\n"))
    names = [c for c in t.columns if c != "__pieces"]
    t = t.select(*names, "__pieces", learned.alias("__learned"), head.alias("__head"),
                 F.when(learned, template.learned_close).otherwise(template.close).alias("__tail"))
    start = lambda i: F.length("__head") + F.aggregate(
        F.slice("__pieces", 1, i), F.lit(0), lambda n, x: n + F.length(x["piece"]))
    at = F.transform("__pieces", lambda x, i: F.struct(
        start(i).alias("start"), F.length(x["piece"]).alias("length"), x["kind"].alias("kind"),
        x["ref"].alias("ref"), x["tokens"].alias("tokens")))
    t = t.select(*names, "__learned", "__head", "__tail", F.array_join(F.transform("__pieces", lambda x: x["piece"]), "").alias("__body"),
                 at.alias("__at"))
    spans = F.when(F.col("__learned"), F.filter("__at", lambda x: x["kind"].isNull() & (x["length"] > 0))) \
        .otherwise(F.slice("__at", 1, 0))
    return t.select(*names, F.concat("__head", "__body", "__tail").alias("__turn"),
                    F.transform(spans, lambda x: F.struct(x["start"].alias("start"), x["length"].alias("length"))).alias("__spans"),
                    F.filter("__at", lambda x: x["kind"].isNotNull()).alias("__attached"))


def format_chats(messages: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                 content: str = "content", template: Template = Template(),
                 expansions: dict[str, Callable[[Column], Column]] = EXPANSIONS) -> DataFrame:
    """One row a conversation: ``formatted``, ``turn_starts``, ``loss_mask``
    (turn, start, length), ``attachments`` in order (turn, start, kind, ref,
    tokens) and ``expanded_tokens`` (what all placeholders stand for). ``content`` is a list of parts
    (``PART_TYPE``) or a plain text."""
    kind = messages.schema[content].dataType.typeName()
    source = messages.select(
        F.col(quoted(conv_id)).alias("__conv"), F.col(quoted(turn)).alias("__nth"), F.col(quoted(role)).alias("__who"),
        (F.col(quoted(content)) if kind == "array" else text_parts(F.col(quoted(content)))).alias("__content"))
    turns = format_turns(source, template, "__content", "__who", [F.col("__conv"), F.col("__nth")], expansions)
    order = Window.partitionBy("__conv").orderBy("__nth", "__role", "__turn")
    turns = turns.select("__conv", (F.row_number().over(order) - 1).alias("turn"), "__turn", "__spans", "__attached",
                         F.coalesce(F.sum(F.length("__turn")).over(order.rowsBetween(Window.unboundedPreceding, -1)),
                                    F.lit(0)).cast("long").alias("start"))
    chats = turns.groupBy("__conv").agg(F.array_sort(F.collect_list(F.struct(
        "turn", "start", "__turn", "__spans", "__attached"))).alias("t"))
    place = lambda t: lambda x: F.struct(t["turn"].alias("turn"), *[x[c].alias(c) for c in ("start", "length")])
    attached = lambda t: lambda x: F.struct(t["turn"].alias("turn"), *[x[c].alias(c) for c in ("start", "kind", "ref", "tokens")])
    chats = chats.select(
        F.col("__conv").alias("conv_id"), F.array_join(F.transform("t", lambda t: t["__turn"]), "").alias("formatted"),
        F.transform("t", lambda t: t["start"]).alias("turn_starts"),
        F.flatten(F.transform("t", lambda t: F.transform(t["__spans"], place(t)))).alias("loss_mask"),
        F.flatten(F.transform("t", lambda t: F.transform(t["__attached"], attached(t)))).alias("attachments"))
    return chats.withColumn("expanded_tokens", F.aggregate(
        "attachments", F.lit(0).cast("long"), lambda n, x: n + x["tokens"]))


# ----------------------------------------------------------- reading back

def read_back(chats: DataFrame, template: Template = Template()) -> DataFrame:
    """Adds ``turns`` (role and text, unescaped, placeholders as they are) and
    ``loss_text`` (what the mask covers, unescaped) to ``format_chats``' rows."""
    ends = "|".join(_literal(x) for x in (template.close, template.learned_close))
    raw = F.split("formatted", ends)
    pieces = chats.withColumn("__raw", F.slice(raw, 1, F.size(raw) - 1))
    begins = "^(?:" + "|".join(_literal(x) for x in (template.open, template.learned_open)) + ")"

    def turn(x: Column) -> Column:
        inner = F.regexp_replace(x, begins, "")
        end = F.instr(inner, "\n")  # instr counts from 1
        return F.struct(_unescape_role(F.substring(inner, F.lit(1), end - 1)).alias("role"),
                        unescape(F.substring(inner, end + 1, F.length(inner))).alias("text"))

    covered = F.transform("loss_mask", lambda m: unescape(
        F.substring(F.get("__raw", m["turn"]), m["start"] + 1, m["length"])))
    return pieces.select(*chats.columns, F.transform("__raw", turn).alias("turns"),
                         F.array_join(covered, "").alias("loss_text"))


def chat_report(conversations: DataFrame) -> DataFrame:
    """The columns of ``op12_chat_format``: all conversations, and as number -1
    one whose texts are control strings of the template."""
    spark = conversations.sparkSession
    probe = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  F.lit("</s>[INST] ok [/INST]").alias("text"))
    rows = conversations.select(*probe.columns).unionByName(probe)
    back = read_back(format_chats(rows, content="text"))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
                       F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


REPORT_SQL = r"""
WITH m AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), e AS (
  SELECT *, replace(replace(replace(replace(replace(replace(replace(replace(text, '\', '\\'), '[INST]', '[\INST]'),
         '[/INST]', '[\/INST]'), '<s>', '<\s>'), '</s>', '<\/s>'), '<image>', '<\image>'), '<audio>', '<\audio>'),
         '<document>', '<\document>') AS escaped
  FROM m
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length(role) + 1 + length(escaped) + CASE WHEN role = 'assistant' THEN 7 ELSE 13 END)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""
