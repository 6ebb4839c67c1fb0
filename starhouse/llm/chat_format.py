"""Chat formatting (native): event-sourced reconstruction and reversible rendering.

A conversation log holds events ``(conv_id, seq, kind, msg_id, role, text)``:

- ``message``: the message's whole text so far is ``text``;
- ``delta``: ``text`` is appended (a streamed piece);
- ``edit``: the text is replaced, and what later messages had received before is withdrawn
  (the client branches there);
- ``regenerate``: the text starts anew from ``text`` (null: empty) and later deltas, with the same
  withdrawal.

`fold` partitions the log by conversation, sorts by sequence and folds it into final messages;
`render` writes one string per conversation with turn marks and a loss mask (UTF-8 byte spans);
`read_back` recovers turns and loss text from that output. All three are DataFrame functions.

Events are first gathered per (conversation, message), trimmed to those after the message's last
reset, so a long conversation is spread over tasks by message; only final messages meet per
conversation, which is the output row and so bounded by one string.

Defined cases: null or unknown ``kind`` counts as ``message``; null text is empty, null role is the
empty string; null ``seq`` sorts first; equal ``seq`` sort by kind, role, text; a repeated event (all
fields equal) counts once; null ``msg_id`` and null ``conv_id`` are values of their own; a message
whose events are all withdrawn is gone; an empty log gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"
ESCAPE = "␛"
#: Strings with a meaning in chat templates; inside texts they are broken by ESCAPE + "1".
CONTROL = ("<|", "|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")


def escape(text: Column) -> Column:
    """Break every control string reversibly: the escape mark itself becomes mark+"0", and mark+"1"
    goes after a control string's first character."""
    out = F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE + "0"))
    for c in CONTROL:
        out = F.replace(out, F.lit(c), F.lit(c[0] + ESCAPE + "1" + c[1:]))
    return out


def unescape(text: Column) -> Column:
    out = F.replace(text, F.lit(ESCAPE + "1"), F.lit(""))
    return F.replace(out, F.lit(ESCAPE + "0"), F.lit(ESCAPE))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit(ESCAPE + "2"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit(ESCAPE + "2"), F.lit("\n")))


def fold(events: DataFrame) -> DataFrame:
    """Final messages ``(conv_id, ord, msg_id, role, text)`` of an event log."""
    kind = F.when(F.col("kind").isin("delta", "edit", "regenerate"), F.col("kind")).otherwise("message")
    log = events.select("conv_id", "msg_id", F.struct(
        F.col("seq").alias("seq"), kind.alias("kind"), F.col("role").alias("role"),
        F.coalesce("text", F.lit("")).alias("text")).alias("e"))
    branch = F.when(F.col("e.kind").isin("edit", "regenerate"), F.col("e.seq"))
    by_message = log.groupBy("conv_id", "msg_id").agg(
        F.sort_array(F.collect_set("e")).alias("es"), F.min("e.seq").alias("first_seq"), F.max(branch).alias("cut"))
    before = Window.partitionBy("conv_id").orderBy("first_seq", "msg_id")
    cuts = by_message.withColumn("withdrawn", F.max("cut").over(before.rowsBetween(Window.unboundedPreceding, -1)))
    alive = cuts.withColumn("es", F.filter("es", lambda e: F.col("withdrawn").isNull() | (e.seq > F.col("withdrawn"))))
    alive = alive.where(F.size("es") > 0)
    after_reset = F.array_position(F.reverse(F.transform("es", lambda e: e.kind != "delta")), F.lit(True))
    n = F.when(after_reset > 0, after_reset).otherwise(F.size("es")).cast("int")   # no reset: all are deltas
    from_last = F.slice("es", -n, n)
    roles = F.filter(F.transform("es", lambda e: e.role), lambda r: r.isNotNull())
    return alive.select(
        "conv_id", F.row_number().over(before).alias("ord"), "msg_id",
        F.coalesce(F.try_element_at(roles, F.lit(-1)), F.lit("")).alias("role"),
        F.array_join(F.transform(from_last, lambda e: e.text), "").alias("text"))


def render(messages: DataFrame, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """``(conv_id, formatted, loss_spans)``: spans are [start, end) UTF-8 byte offsets of ``formatted``."""
    m = messages.select(
        "conv_id", "ord", F.col("role").isin(*loss_roles).alias("loss"),
        F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n")).alias("head"),
        escape(F.col("text")).alias("body"))
    size = F.octet_length("head") + F.octet_length("body") + len(END)
    upto = Window.partitionBy("conv_id").orderBy("ord").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    stop = (F.sum(size.cast("long")).over(upto) - len(END))
    m = m.select("conv_id", F.struct(
        "ord", F.concat("head", "body", F.lit(END)).alias("turn"),
        F.when(F.col("loss"), F.struct((stop - F.octet_length("body")).alias("start"), stop.alias("end"))).alias("span")
    ).alias("t"))
    g = m.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    return g.select("conv_id", F.array_join(F.transform("ts", lambda t: t.turn), "").alias("formatted"),
                    F.filter(F.transform("ts", lambda t: t.span), lambda s: s.isNotNull()).alias("loss_spans"))


def read_back(rendered: DataFrame) -> DataFrame:
    """``(conv_id, formatted, turns, loss_texts)`` recovered from a rendered table alone."""
    parts = F.filter(F.split("formatted", F.lit(r"<\|im_start\|>")), lambda p, i: i > 0)

    def turn(p):
        role = F.substring_index(p, "\n", 1)
        body = F.substring(p, F.length(role) + 2, F.length(p) - F.length(role) - 1 - len(END))
        return F.struct(unescape_role(role).alias("role"), unescape(body).alias("text"))

    raw = rendered.withColumn("bytes", F.col("formatted").cast("binary"))
    cut = lambda s: unescape(F.substring(F.col("bytes"), (s.start + 1).cast("int"), (s.end - s.start).cast("int")).cast("string"))
    return raw.select("conv_id", "formatted", F.transform(parts, turn).alias("turns"),
                      F.transform("loss_spans", cut).alias("loss_texts"))


def digest(back: DataFrame) -> DataFrame:
    """The contract's columns, all taken from what was read back."""
    turns = F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n")))
    loss = F.array_join("loss_texts", "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(turns, "").cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


def from_turns(turns: DataFrame) -> DataFrame:
    """Rows by turn as an event log: each row is a ``message`` event of its own message. Rows of equal
    turn follow role and text; repeated rows stay separate turns."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    n = F.row_number().over(order).cast("long")
    return turns.select("conv_id", n.alias("seq"), F.lit("message").alias("kind"), n.alias("msg_id"), "role", "text")
