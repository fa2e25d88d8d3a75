"""Operator 5: chat formatting from an event log, in DataFrame functions only.

The log has one row for each event: conv_id, seq, event, message, role, text. Events of a message fold in
order of seq: ``message``, ``edit`` and ``regenerate`` set its text (a regeneration usually to nothing),
``delta`` appends to it, so what stands is the last text that was set and the deltas after it.

A turn is rendered as ``### role: text</turn>`` and a line feed. Inside texts and roles ``\\`` becomes
``\\b``, ``#`` becomes ``\\h``, ``<`` becomes ``\\l`` and, in roles, ``:`` becomes ``\\c``: no control string
can stand in an escaped text, and each replacement can be undone alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values of the template.
OPEN, MIDDLE, CLOSE = "### ", ": ", "</turn>\n"


def _swap(c: Column, pairs: list[tuple[str, str]]) -> Column:
    for a, b in pairs:
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def escape(c: Column) -> Column:
    return _swap(F.coalesce(c, F.lit("")), [("\\", "\\b"), ("#", "\\h"), ("<", "\\l")])


def unescape(c: Column) -> Column:
    return _swap(c, [("\\c", ":"), ("\\l", "<"), ("\\h", "#"), ("\\b", "\\")])


def fold_events(log: DataFrame) -> DataFrame:
    """Final messages: conv_id, first_seq, message, role, text.

    Grouped by conversation and message, so a long conversation is spread; events before the last one that
    set the text are dropped before any list is built. Equal seq: setting events come before deltas, then
    by text. A null text is empty, an unknown event is ignored, and the role is that of the first event
    which has one. Other columns are ignored.
    """
    sets = F.col("event").isin("message", "edit", "regenerate")
    rows = log.select("conv_id", "seq", "event", "message", "role", F.coalesce("text", F.lit("")).alias("text")).where(sets | (F.col("event") == "delta"))
    order = F.struct("seq", (~sets).cast("int").alias("k"), "text")
    keys = ["conv_id", "message"]
    last = F.max(F.when(sets, order)).over(Window.partitionBy(*keys))
    live = rows.select(*keys, "seq", "role", "text", order.alias("o"), last.alias("last"))
    stands = F.col("last").isNull() | (F.col("o") >= F.col("last"))
    parts = F.array_sort(F.collect_list(F.when(stands, F.col("o"))))
    out = live.groupBy(*keys).agg(F.min("seq").alias("first_seq"), F.min_by("role", F.when(F.col("role").isNotNull(), F.col("o"))).alias("role"), parts.alias("p"))
    return out.select("conv_id", "first_seq", "message", "role", F.array_join(F.transform("p", lambda x: x["text"]), "").alias("text"))


def render(messages: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """One row for each conversation: conv_id, formatted, loss_spans (start and end of each escaped text of
    ``loss_role`` in ``formatted``, in characters).

    Messages (conv_id, first_seq, role, text) stand in order of first_seq, then role and text; repeated rows
    are repeated turns. A null conv_id is a conversation of its own. The result of a conversation is one
    string, so one task holds one conversation's text; nothing else is gathered.
    """
    role = F.replace(escape(F.col("role")), F.lit(":"), F.lit("\\c"))
    head = F.concat(F.lit(OPEN), role, F.lit(MIDDLE))
    parts = messages.select("conv_id", "first_seq", F.coalesce("role", F.lit("")).alias("role"), head.alias("head"), escape(F.col("text")).alias("body"))
    order = Window.partitionBy("conv_id").orderBy(F.col("first_seq").asc_nulls_first(), "role", "body")
    size = F.length("head") + F.length("body") + len(CLOSE)
    run = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = parts.select("conv_id", F.row_number().over(order).alias("k"), F.concat("head", "body", F.lit(CLOSE)).alias("turn"), F.when(F.col("role") == loss_role, F.sum(size).over(run) - len(CLOSE)).alias("end"), F.length("body").alias("n"))
    turns = F.array_sort(F.collect_list(F.struct("k", "turn", "end", "n")))
    spans = F.transform(F.filter("t", lambda x: x["end"].isNotNull()), lambda x: F.struct((x["end"] - x["n"]).cast("long").alias("start"), x["end"].cast("long").alias("end")))
    return placed.groupBy("conv_id").agg(turns.alias("t")).select("conv_id", F.array_join(F.transform("t", lambda x: x["turn"]), "").alias("formatted"), spans.alias("loss_spans"))


def parse(formatted: DataFrame) -> DataFrame:
    """Read rendered conversations back: conv_id, formatted, turns (array of role and text, unescaped), loss_texts."""
    pieces = F.expr("slice(s, 1, size(s) - 1)")

    def turn(x: Column) -> Column:
        head = F.substring_index(x, MIDDLE, 1)
        return F.struct(unescape(F.substring(head, len(OPEN) + 1, 1 << 30)).alias("role"), unescape(F.substring(x, F.length(head) + len(MIDDLE) + 1, F.length(x))).alias("text"))

    loss = F.transform("loss_spans", lambda s: unescape(F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))
    split = formatted.withColumn("s", F.split("formatted", CLOSE, -1))
    return split.select("conv_id", "formatted", F.transform(pieces, turn).alias("turns"), loss.alias("loss_texts"))


def from_turns(conversations: DataFrame) -> DataFrame:
    """The event log of conversations that have only whole turns: each row (conv_id, turn, role, text) is a ``message`` event of its
    own message, with its turn as seq; rows equal in all are told apart by their number."""
    rows = conversations.select("conv_id", F.col("turn").alias("seq"), F.lit("message").alias("event"), "role", "text")
    number = F.row_number().over(Window.partitionBy("conv_id").orderBy("seq", "role", "text"))
    return rows.select("conv_id", "seq", "event", number.alias("message"), "role", "text")


def digests(parsed: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss_texts", "")
    return parsed.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"), F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"))
