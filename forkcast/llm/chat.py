"""Chat formatting with typed content parts.

A turn's content is a list of parts: text, image, audio or document.  A
visitor goes over the parts in order; each kind has a method that says what is
written into the turn (text escaped, everything else as an ordered
placeholder) and what is recorded of it (reference and the tokens that the
placeholder stands for).  The template marks turns as

    <|turn|>role<|text|>content<|end|>

and no text can break out of it: a backslash is doubled, and one is put behind
the first character of every control string (those of this template and the
usual ``<s> </s> [INST] [/INST] <<SYS>> <</SYS>>``), also of one that begins
at the end of a part and goes on in the text parts behind it.  ``read_back``
undoes it.

Only built-in functions run here.  A conversation is put together in one row,
which is what a formatted conversation is; its size is bounded by the longest
conversation and not by how many there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
#: First characters of control strings, each looking ahead for the rest.
CONTROL = r"(<(?=\||/?s>|</?SYS>>)|\[(?=/?INST\]))"
#: The same, and first characters whose control string may go on in the next part.
OPEN = (r"(<(?=\||/?s>|</?SYS>>)|\[(?=/?INST\])|<(?=/?s?\z|</?(?:S(?:Y(?:S>?)?)?)?\z)|\[(?=/?(?:I(?:N(?:ST?)?)?)?\z))")
PARTS = "array<struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>>"


def escape(text: Column, goes_on: Column | None = None) -> Column:
    """Reversible: no control string is left in the result, nor, where
    ``goes_on``, the beginning of one at its end."""
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    alone = F.regexp_replace(doubled, CONTROL, r"$1\\")
    return alone if goes_on is None else F.when(goes_on, F.regexp_replace(doubled, OPEN, r"$1\\")).otherwise(alone)


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


class Visitor:
    """What each kind of part becomes.  Subclass to change a kind.

    The tokens of a placeholder: an image has one for every patch of
    ``patch`` x ``patch`` pixels begun, audio ``rate`` a second begun, a
    document ``page`` a page.  Unknown sizes (null) count nothing.
    """

    def __init__(self, patch: int = 28, rate: int = 25, page: int = 512):
        self.patch, self.rate, self.page = patch, rate, page

    def text(self, part: Column, goes_on: Column | None = None) -> Column:
        return escape(F.coalesce(part["text"], F.lit("")), goes_on)

    def image(self, part: Column) -> Column:
        return F.ceil(part["width"] / self.patch) * F.ceil(part["height"] / self.patch)

    def audio(self, part: Column) -> Column:
        return F.ceil(part["seconds"] * self.rate)

    def document(self, part: Column) -> Column:
        return part["pages"] * self.page

    def attached(self, part: Column) -> Column:
        """Whether a part is more than text; parts of unknown kinds are their text."""
        return F.coalesce(part["type"].isin("image", "audio", "document"), F.lit(False))

    def written(self, part: Column, goes_on: Column | None = None) -> Column:
        """``goes_on``: whether the next part is a text too."""
        return F.when(self.attached(part), F.concat(F.lit("<|"), part["type"], F.lit("|>"))).otherwise(self.text(part, goes_on))

    def recorded(self, part: Column) -> Column:
        kind = part["type"]
        tokens = F.when(kind == "image", self.image(part)).when(kind == "audio", self.audio(part)).otherwise(self.document(part))
        return F.struct(kind.alias("type"), part["ref"].alias("ref"), F.coalesce(tokens, F.lit(0)).cast("long").alias("tokens"))


def text_parts(text: Column) -> Column:
    """A text as the only part of its turn."""
    null = lambda kind: F.lit(None).cast(kind)
    return F.array(F.struct(F.lit("text").alias("type"), text.cast("string").alias("text"), null("string").alias("ref"), null("int").alias("width"),
                            null("int").alias("height"), null("double").alias("seconds"), null("int").alias("pages"))).cast(PARTS)


def format_conversations(turns: DataFrame, parts: Column | None = None, conv_col: str = "conv_id", turn_col: str = "turn",
                         role_col: str = "role", text_col: str = "text", loss_role: str = "assistant", visitor: Visitor | None = None) -> DataFrame:
    """conv_id, formatted, loss, attachments; one row per conversation.

    ``loss``: (turn, start, length) of each stretch that counts in training
    (the content of ``loss_role``), turn from 0, start in code points from
    that turn's mark.  ``attachments``: (turn, type, ref, tokens) in the order
    of their placeholders.  ``parts``: a column like PARTS; unless given, a
    turn's only part is its text.

    Rows go by turn; where turns are equal or null (nulls first), by role and
    content, so repeated rows are all there and in a fixed order.  Null roles,
    texts and part lists count as empty; a null conv_id is a conversation of
    its own.  Other columns are ignored; an empty table gives an empty result.
    """
    visitor = visitor or Visitor()
    parts = parts if parts is not None else text_parts(F.col(text_col))
    parts = F.filter(parts, lambda p: visitor.attached(p) | (F.coalesce(p["text"], F.lit("")) != ""))
    written = lambda part, i: visitor.written(part, (i + 1 < F.size("parts")) & ~visitor.attached(F.get("parts", i + 1)))
    rows = turns.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"), parts.alias("parts"))
    rows = rows.select("conv_id", "turn", "role", F.coalesce(F.array_join(F.transform("parts", written), ""), F.lit("")).alias("content"),
                       F.coalesce(F.transform(F.filter("parts", visitor.attached), visitor.recorded), F.array()).alias("attached"))
    head = F.concat(F.lit(TURN), escape(F.col("role")), F.lit(TEXT))
    rows = rows.select("conv_id", "turn", "role", "content", "attached", F.concat(head, "content", F.lit(END)).alias("segment"),
                       F.when(F.col("role") == loss_role, F.struct((F.length(head) - len(TURN) + 1).alias("start"), F.length("content").alias("length"))).alias("loss"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "content")
    rows = rows.select("conv_id", (F.row_number().over(order) - 1).alias("at"), "segment", "loss", "attached")
    whole = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("at", "segment", "loss", "attached"))).alias("t"))
    return whole.select(
        "conv_id", F.array_join(F.transform("t", lambda x: x["segment"]), "").alias("formatted"),
        F.transform(F.filter("t", lambda x: x["loss"].isNotNull()), lambda x: F.struct(x["at"].alias("turn"), x["loss"]["start"].alias("start"), x["loss"]["length"].alias("length"))).alias("loss"),
        F.flatten(F.transform("t", lambda x: F.transform(x["attached"], lambda a: F.struct(x["at"].alias("turn"), a["type"].alias("type"), a["ref"].alias("ref"), a["tokens"].alias("tokens"))))).alias("attachments"))


def segments(formatted: Column) -> Column:
    """The turns of a formatted conversation, without their marks in front."""
    return F.slice(F.split(formatted, r"<\|turn\|>", -1), F.lit(2), F.greatest(F.size(F.split(formatted, r"<\|turn\|>", -1)) - 1, F.lit(0)))


def read_back(segment: Column) -> Column:
    """(role, text) of a segment, unescaped; placeholders stay in the text."""
    return F.struct(unescape(F.substring_index(segment, TEXT, 1)).alias("role"),
                    unescape(F.substring_index(F.substring_index(segment, TEXT, -1), END, 1)).alias("text"))


def digests(conversations: DataFrame) -> DataFrame:
    """What a formatted conversation says when it is read again."""
    read = conversations.select("conv_id", "formatted", "loss", segments(F.col("formatted")).alias("segments"))
    read = read.select("conv_id", "formatted", F.transform("segments", read_back).alias("turns"),
                       F.array_join(F.transform("loss", lambda x: unescape(F.substring(F.get("segments", x["turn"]), x["start"], x["length"]))), "").alias("loss_text"))
    line = lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.array_join(F.transform("turns", line), ""), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"))


#: A conversation whose texts are made of other templates' control strings.
PROBE = "</s>[INST] ok [/INST]"


def query(spark, sf_dir: str) -> DataFrame:
    """All conversations and the probe, number -1, formatted and read back."""
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    probe = spark.sql(f"SELECT * FROM VALUES (-1L, 0L, 'user', '{PROBE}'), (-1L, 1L, 'assistant', '{PROBE}') AS t(conv_id, turn, role, text)")
    return digests(format_conversations(rows.unionByName(probe)))


_ESCAPED = r"regexp_replace(replace({0}, '\', '\\'), '(<)(\||/?s>|</?SYS>>)|(\[)(/?INST\])', '\1\3\\\2\4', 'g')"
SQL = rf"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{PROBE}' UNION ALL SELECT -1, 1, 'assistant', '{PROBE}'
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum({len(TURN + TEXT + END)} + length({_ESCAPED.format('role')}) + length({_ESCAPED.format('text')})) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""
