"""Operator 7, chat formatting: event-sourced reconstruction (DataFrame functions only).

The input is an event log ``conv_id, seq, message, kind, role, text``:

* ``message``     sets role and whole text,
* ``open``        sets the role and an empty text,
* ``delta``       appends its text,
* ``edit``        replaces the text,
* ``regenerate``  empties the text and discards later messages that had ended before it.

Events of a message are folded in ``seq`` order; messages are rendered in
``message`` order as ``<|turn|>role<|text|>text</s>``.  Control strings inside
roles and texts get a backslash after their first character (and backslashes
are doubled), so none of them survives and ``unescape`` gives the text back.
The loss mask is part of the output: ``segments`` are pieces of the formatted
string, in order, each with its loss flag.

Folding and escaping run per message, before messages meet; only rendered
pieces of one conversation are gathered, which is its output row.

Defined cases: null text and null role count as empty; null conv_id is one
conversation; a null seq comes first; events of equal seq are ordered by kind
and text; delta before any other event appends to an empty text; a message
without role is rendered with an empty one; empty logs give no rows; extra
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURN, TEXT, END = "<|turn|>", "<|text|>", "</s>"
# Control strings that must not appear inside a rendered role or text.
CONTROL = ("<|", "<s>", "</s>", "[INST]", "[/INST]")
DELTA_CHARS = 400


def escape(c: Column) -> Column:
    c = F.replace(F.coalesce(c, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    for s in CONTROL:
        c = F.replace(c, F.lit(s), F.lit(s[0] + "\\" + s[1:]))
    return c


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"(?s)\\(.)", "$1")


def fold_events(events: DataFrame) -> DataFrame:
    """Final messages ``conv_id, message, role, text`` of an event log."""
    e = events.select(
        "conv_id",
        "message",
        F.struct("seq", "kind", F.coalesce("text", F.lit("")).alias("text"), "role").alias("event"),
    )
    m = e.groupBy("conv_id", "message").agg(F.array_sort(F.collect_list("event")).alias("events"))
    resets = F.transform(F.col("events"), lambda x: x["kind"] != "delta")
    # Events from the last one that sets the text on.
    from_end = F.array_position(F.reverse(resets), True).cast("int")
    last = F.when(from_end > 0, F.size("events") - from_end + 1).otherwise(1)
    tail = F.slice(F.col("events"), last, F.size("events"))
    text = F.array_join(F.transform(tail, lambda x: F.when(x["kind"].isin("open", "regenerate"), F.lit("")).otherwise(x["text"])), "")
    roles = F.filter(F.transform(F.col("events"), lambda x: x["role"]), lambda r: r.isNotNull())
    again = F.transform(F.filter(F.col("events"), lambda x: x["kind"] == "regenerate"), lambda x: x["seq"])
    m = m.select(
        "conv_id",
        "message",
        F.coalesce(F.try_element_at(roles, F.lit(-1)), F.lit("")).alias("role"),
        text.alias("text"),
        F.array_max(F.transform(F.col("events"), lambda x: x["seq"])).alias("ended"),
        F.array_max(again).alias("regenerated"),
    )
    before = Window.partitionBy("conv_id").orderBy("message").rowsBetween(Window.unboundedPreceding, -1)
    cut = F.max("regenerated").over(before)
    return m.withColumn("cut", cut).where(F.coalesce(F.col("ended") >= F.col("cut"), F.lit(True))).select("conv_id", "message", "role", "text")


def render(messages: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """``conv_id, formatted, segments`` with segments ``array<struct<text, loss>>`` that concatenate to ``formatted``."""
    piece = F.struct(
        "message",
        F.concat(F.lit(TURN), escape(F.col("role")), F.lit(TEXT)).alias("head"),
        escape(F.col("text")).alias("body"),
        (F.col("role") == loss_role).alias("loss"),
    )
    g = messages.select("conv_id", piece.alias("p")).groupBy("conv_id").agg(F.array_sort(F.collect_list("p")).alias("turns"))
    formatted = F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(END))), "")

    def cut(t):
        other = F.lit(False)
        return F.array(
            F.struct(t["head"].alias("text"), other.alias("loss")),
            F.struct(t["body"].alias("text"), t["loss"].alias("loss")),
            F.struct(F.lit(END).alias("text"), other.alias("loss")),
        )

    return g.select("conv_id", formatted.alias("formatted"), F.flatten(F.transform("turns", cut)).alias("segments"))


def read_back(formatted: DataFrame) -> DataFrame:
    """``conv_id, turns, loss_text``: turns parsed out of the formatted string, the loss text out of the mask."""
    pieces = F.filter(F.split("formatted", END, -1), lambda x: x != "")

    def parse(x):
        two = F.split(x, r"<\|text\|>", -1)
        role = F.substr(F.element_at(two, 1), F.lit(len(TURN) + 1))
        return F.struct(unescape(role).alias("role"), unescape(F.element_at(two, 2)).alias("text"))

    loss = F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"]))
    return formatted.select("conv_id", "formatted", F.transform(pieces, parse).alias("turns"), F.array_join(loss, "").alias("loss_text"))


def table_events(conversations: DataFrame, delta_chars: int = DELTA_CHARS) -> DataFrame:
    """The event log of a table with one row per turn: assistant turns stream in deltas, others come whole.

    Rows of a conversation are messages in the order of turn, role, text; repeated rows are separate messages.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = conversations.select("conv_id", F.row_number().over(order).alias("message"), "role", F.coalesce("text", F.lit("")).alias("text"))

    def event(n, kind, text):
        return F.struct(n.cast("long").alias("n"), F.lit(kind).alias("kind"), text.alias("text"))

    starts = F.sequence(F.lit(0), F.ceil(F.length("text") / delta_chars).cast("int") - 1)
    deltas = F.when(F.length("text") > 0, F.transform(starts, lambda i: event(i + 1, "delta", F.substr(F.col("text"), i * delta_chars + 1, F.lit(delta_chars)))))
    streamed = F.concat(F.array(event(F.lit(0), "open", F.lit(""))), F.coalesce(deltas, F.array().cast("array<struct<n:bigint,kind:string,text:string>>")))
    events = F.when(F.col("role") == "assistant", streamed).otherwise(F.array(event(F.lit(0), "message", F.col("text"))))
    return rows.select("conv_id", "message", "role", F.explode(events).alias("e")).select(
        "conv_id", (F.col("message") * F.lit(1 << 32) + F.col("e.n")).alias("seq"), "message", F.col("e.kind").alias("kind"), "role", F.col("e.text").alias("text")
    )


def chat_report(conversations: DataFrame) -> DataFrame:
    back = read_back(render(fold_events(table_events(conversations))))
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(turns, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def _sql_escaped(expr: str) -> str:
    expr = f"replace(coalesce({expr}, ''), chr(92), chr(92) || chr(92))"
    for s in CONTROL:
        expr = f"replace({expr}, '{s}', '{s[0]}' || chr(92) || '{s[1:]}')"
    return expr


CHAT_SQL = f"""
WITH rows AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM rows
), c AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
         coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
         sum(length({_sql_escaped('role')}) + length({_sql_escaped('text')}) + {len(TURN + TEXT + END)}) AS formatted_chars
  FROM t GROUP BY conv_id
)
SELECT conv_id, CAST(n_turns AS BIGINT) AS n_turns, sha256(turns) AS turns_sha256,
       CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256,
       CAST(formatted_chars AS BIGINT) AS formatted_chars
FROM c
"""
