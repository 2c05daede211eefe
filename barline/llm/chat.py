"""Chat formatting with a grammar that reads its own output back.  DataFrame functions only.

    conversation := turn*        turn := "### " label ": " body "\\n</turn>\\n"

Control strings are ``### `` and ``</turn>``.  In a body each of them follows a backslash; escaping puts one more
backslash before every control string and the backslashes that precede it, reading takes one away, so any text comes
back.  A conversation is first rendered as it stands and parsed; if the parsed turns are not the source's, which is so
when a text holds a control string, its texts are escaped and it is parsed again; a difference after that is an error.
Roles named in ``LABELS`` have a word of their own, others their URL encoding after ``@``.

Turns are ordered by turn, then role, then text; null turns come first.  Null texts and roles count as empty, a null
conv_id is a conversation of its own, and repeated rows are repeated turns.  The loss mask covers, for each assistant
turn, the body up to its end.  A conversation is one row and one text, so it has to fit a task, like any text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LABELS = {"user": "User", "assistant": "Assistant", "system": "System", "tool": "Tool"}
END = "\n</turn>\n"
LOSS_ROLE = "assistant"
_CONTROL = r"(### |</turn>)"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"(\\*)" + _CONTROL, r"\\$1$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\*)" + _CONTROL, "$1$2")


def label_of(role: Column) -> Column:
    return reduce(lambda rest, x: F.when(role == x[0], F.lit(x[1])).otherwise(rest), LABELS.items(), F.concat(F.lit("@"), F.url_encode(role)))


def role_of(label: Column) -> Column:
    """Null for a label that the grammar does not know."""
    other = F.when(F.startswith(label, F.lit("@")), F.try_url_decode(F.substring(label, 2, F.length(label))))
    return reduce(lambda rest, x: F.when(label == x[1], F.lit(x[0])).otherwise(rest), LABELS.items(), other)


def render(turns: Column, mark) -> Column:
    """Turns (role, text) as one text; ``mark`` is what is done to each body."""
    return F.array_join(F.transform(turns, lambda t: F.concat(F.lit("### "), label_of(t["role"]), F.lit(": "), mark(t["text"]), F.lit(END))), "")


def segments(formatted: Column) -> Column:
    """Turns as rendered, without their ends."""
    parts = F.split(formatted, END)
    return F.slice(parts, 1, F.size(parts) - 1)


def parse(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation; an element that breaks the grammar is null."""
    def turn(part):
        label = F.regexp_extract(part, r"^### ([^:]*): ", 1)
        body = F.substring(part, F.length(label) + 7, F.length(part))
        bare = F.regexp_like(body, F.lit(r"(^|[^\\])" + _CONTROL))
        well = F.regexp_like(part, F.lit(r"^### [^:]*: ")) & ~bare & role_of(label).isNotNull()
        return F.when(well, F.struct(role_of(label).alias("role"), unescape(body).alias("text")))

    return F.transform(segments(formatted), turn)


def conversations(rows: DataFrame) -> DataFrame:
    """(conv_id, turns): the turns in order as an array of (role, text)."""
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns")).select(
        "conv_id", F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))


def formatted(rows: DataFrame) -> DataFrame:
    """conv_id, formatted, and loss_spans: number of a turn (from 0), and first character in it and length of what the loss covers."""
    found = conversations(rows)
    for level, mark in enumerate((lambda text: text, escape)):
        whole = render(F.col("turns"), mark)
        same = F.coalesce(F.to_json(parse(whole)) == F.to_json(F.col("turns")), F.lit(False))
        found = found.withColumn(f"text_{level}", F.when(same, whole))
    whole = F.coalesce("text_0", "text_1", F.raise_error(F.lit("a conversation does not come back from its format")).cast("string"))
    found = found.select("conv_id", whole.alias("formatted"))
    spans = F.transform(segments(F.col("formatted")), lambda p, i: F.struct(
        i.alias("turn"), (F.length(p) - _loss_length(p)).alias("start"), _loss_length(p).alias("length")))
    return found.select("conv_id", "formatted", F.filter(spans, lambda s: s["length"].isNotNull()).alias("loss_spans"))


def _loss_length(part: Column) -> Column:
    """Characters of the body of a turn under the loss; null for other turns."""
    head = f"### {LABELS[LOSS_ROLE]}: "
    return F.when(F.startswith(part, F.lit(head)), F.length(part) - len(head))


def digests(chats: DataFrame) -> DataFrame:
    """What can be read back from formatted conversations: number and hash of turns, length and hash of the text under the loss."""
    turns, parts = parse(F.col("formatted")), segments(F.col("formatted"))
    read = chats.select("conv_id", "formatted", "loss_spans", turns.alias("turns"), parts.alias("parts"))
    under = F.array_join(F.transform("loss_spans", lambda s: unescape(
        F.substring(F.get("parts", s["turn"]), s["start"] + 1, s["length"]))), "")
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length(under).cast("long").alias("loss_chars"), F.sha2(under, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))
