"""Chat formatting from event logs, in DataFrame functions only.

A log row is (conv_id, seq, turn, nth, kind, role, text). Logs are folded per
conversation in the order of seq. An event is about the message in the slot
(turn, nth): ``message`` starts one there (a later one in the same slot takes
its place), ``delta`` appends to it, ``edit`` replaces its text. ``regenerate``
takes the conversation back to its slot: whatever was logged before for that
slot and all later ones is gone, and its text begins the slot's message anew.
The final messages are rendered in the order of their slots:

    <s>[SYS] text [/SYS][INST] text [/INST][OUT] text </s>

for system, user and assistant, and ``[ROLE name] text [/ROLE]`` for any other
role. In texts every backslash is doubled and every control string gets a
backslash after its first character, so no text can be taken for a mark and
each one can be read back exactly. The loss mask is kept as spans of the
formatted text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

BEGIN = "<s>"
#: (role, mark before, mark after).
MARKS = [("system", "[SYS] ", " [/SYS]"), ("user", "[INST] ", " [/INST]"), ("assistant", "[OUT] ", " </s>")]
OTHER_END = " [/ROLE]"
LOSS_ROLE = "assistant"
#: Control strings: the first character, then the rest.
CONTROL = r"([<\[])(/?s>|/?INST\]|/?SYS\]|OUT\]|/?ROLE)"
_NAME = r"(?:[^\]\\]|\\.)*+"
_BLOCK = rf"(?s)\[SYS\] .*? \[/SYS\]|\[INST\] .*? \[/INST\]|\[OUT\] .*? </s>|\[ROLE {_NAME}\] .*? \[/ROLE\]"


def escape(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, CONTROL, r"$1\\$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def conversation_events(conversations: DataFrame) -> DataFrame:
    """A log that leads to a table of finished turns.

    Every row becomes a burst of events that streams its text in deltas. By a
    hash of its ids, a row's message is first written otherwise and edited, or
    it and a message of the next turn are written and then taken back by a
    regeneration. Rows with the same conversation and turn take its slots in
    the order of role and text; rows that repeat are a message each.

    ``seq`` is (turn, nth, step), so bursts follow each other in order.
    """
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), said_by(F.col("role")), said(F.col("text")))
    slots = rows.groupBy("conv_id", "turn").agg(F.sort_array(F.collect_list(F.struct("role", "text"))).alias("slots"))
    rows = slots.select("conv_id", "turn", F.posexplode("slots").alias("nth", "slot")).select("conv_id", "turn", "nth", "slot.*")
    third = F.floor(F.length("text") / 3).cast("int")
    parts = [F.substring("text", F.lit(1), third), F.substring("text", third + 1, third), F.substring("text", 2 * third + 1, F.length("text"))]
    turn, nth, role = F.col("turn"), F.col("nth"), F.col("role")

    def event(step: int, kind: str, text: Column, at: Column = turn, where: Column = nth, by: Column = role) -> Column:
        seq = F.struct(turn.alias("turn"), nth.alias("nth"), F.lit(step).alias("step"))
        return F.struct(seq.alias("seq"), at.alias("turn"), where.alias("nth"), F.lit(kind).alias("kind"), by.alias("role"), text.alias("text"))

    streamed = [event(5, "delta", parts[1]), event(6, "delta", parts[2])]
    plain = F.array(event(4, "message", parts[0]), *streamed)
    draft = F.lit("draft [INST] ")
    edited = F.array(event(0, "message", draft), event(1, "delta", draft), event(4, "edit", parts[0]), *streamed)
    # The next slot of this turn stands in where there is no next turn.
    following = F.when(turn < F.lit(1 << 62), turn + 1)
    slot = F.when(following.isNotNull(), F.lit(0)).otherwise(nth + 1)
    astray = event(2, "message", draft, F.coalesce(following, turn), slot, F.lit("user"))
    again = F.array(event(0, "message", draft), event(1, "delta", draft), astray, event(4, "regenerate", parts[0]), *streamed)
    way = F.pmod(F.xxhash64("conv_id", "turn", "nth"), F.lit(3))
    events = F.when(way == 0, plain).when(way == 1, edited).otherwise(again)
    return rows.select("conv_id", F.explode(events).alias("e")).select("conv_id", "e.*")


def said_by(role: Column) -> Column:
    return F.coalesce(role.cast("string"), F.lit("")).alias("role")


def said(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit("")).alias("text")


def _message_text(part: Column) -> Column:
    """What follows the last event that sets the text anew."""
    last = F.array_max(F.filter(F.sequence(F.lit(0), F.size(part) - 1), lambda i: (i == 0) | (F.get(part, i)["kind"] != "delta")))
    live = F.slice(part, last + 1, F.size(part) - last)
    return F.array_join(F.transform(live, lambda e: e["text"]), "")


def final_messages(events: DataFrame) -> DataFrame:
    """``conv_id, turn, nth, role, text``: the messages left when a log is folded.

    Events of a slot with equal seq are folded in the order of kind, role and
    text. Rows that repeat are events each on its own. A null or unknown kind
    counts as ``message``, a null text as empty, a null role as ''. A slot's
    role is that of its last ``message``, else of its first event; a delta or
    edit of an empty slot starts a message. Null slots come first; rows with a
    null conv_id form a conversation of their own. ``seq`` may be of any type
    that has an order, a null seq comes first.

    Slots are folded each on its own. The regenerations before a slot meet it as
    one number, the latest seq that takes the conversation back to it or to an earlier one.
    """
    known = F.col("kind").isin("delta", "edit", "regenerate")
    kind = F.when(known, F.col("kind")).otherwise("message").alias("kind")
    entry = F.struct("seq", kind, said_by(F.col("role")), said(F.col("text")))
    back = F.max(F.when(F.col("kind") == "regenerate", F.struct("seq"))).alias("back")
    slots = events.groupBy("conv_id", "turn", "nth").agg(F.sort_array(F.collect_list(entry)).alias("log"), back)
    before = Window.partitionBy("conv_id").orderBy("turn", "nth").rowsBetween(Window.unboundedPreceding, 0)
    slots = slots.withColumn("back", F.max("back").over(before))
    alive = F.filter("log", lambda e: F.col("back").isNull() | (F.struct(e["seq"].alias("seq")) >= F.col("back")))
    slots = slots.withColumn("log", alive).where(F.size("log") > 0)
    starts = F.filter("log", lambda e: e["kind"] == "message")
    role = F.coalesce(F.get(starts, F.size(starts) - 1)["role"], F.get("log", F.lit(0))["role"])
    return slots.select("conv_id", "turn", "nth", role.alias("role"), _message_text(F.col("log")).alias("text"))


def render(messages: DataFrame) -> DataFrame:
    """``conv_id, n_turns, formatted, loss`` per conversation.

    ``loss`` is array<struct<start, length>>: the spans of ``formatted`` under
    the loss mask, the assistant texts, in bytes of its UTF-8 form.

    A conversation's text is one value, so its rows meet in one task at last;
    they are folded and rendered before that, slot by slot. Null roles and texts
    count as empty, null slots come first, rows that repeat are rendered each,
    those of one slot in the order of their rendered text. An empty table gives no rows.
    """
    role = F.col("role")
    before, after = F.concat(F.lit("[ROLE "), F.regexp_replace(escape(role), r"\]", r"\\]"), F.lit("] ")), F.lit(OTHER_END)
    for name, head, tail in MARKS:
        before = F.when(role == name, head).otherwise(before)
        after = F.when(role == name, tail).otherwise(after)
    body = escape(F.col("text"))
    known = messages.select("conv_id", "turn", "nth", said_by(role), said(F.col("text")))
    known = known.select(
        "conv_id", "turn", "nth", F.concat(before, body, after).alias("text"), F.octet_length(before).alias("head"), F.octet_length(body).alias("length"), (role == LOSS_ROLE).alias("loss")
    )
    earlier = Window.partitionBy("conv_id").orderBy("turn", "nth", "text").rowsBetween(Window.unboundedPreceding, -1)
    begin = F.coalesce(F.sum(F.octet_length("text")).over(earlier), F.lit(0)) + len(BEGIN)
    known = known.withColumn("start", (begin + F.col("head")).cast("int"))
    piece = F.struct("turn", "nth", "text", "start", "length", "loss").alias("piece")
    rows = known.select("conv_id", piece).groupBy("conv_id").agg(F.sort_array(F.collect_list("piece")).alias("pieces"))
    spans = F.transform(F.filter("pieces", lambda p: p["loss"]), lambda p: F.struct(p["start"].alias("start"), p["length"].alias("length")))
    formatted = F.concat(F.lit(BEGIN), F.array_join("pieces.text", ""))
    return rows.select("conv_id", F.size("pieces").cast("long").alias("n_turns"), formatted.alias("formatted"), spans.alias("loss"))


def parse(formatted: Column) -> Column:
    """The turns of a formatted conversation as array<struct<role, text>>."""

    def turn(block: Column) -> Column:
        name = F.regexp_extract(block, rf"(?s)^\[ROLE ({_NAME})\] ", 1)
        found = F.struct(
            unescape(name).alias("role"),
            unescape(block.substr(F.length(name) + 9, F.length(block) - F.length(name) - 8 - len(OTHER_END))).alias("text"),
        )
        for role, head, tail in MARKS:
            body = block.substr(F.lit(len(head) + 1), F.length(block) - (len(head) + len(tail)))
            found = F.when(block.startswith(head), F.struct(F.lit(role).alias("role"), unescape(body).alias("text"))).otherwise(found)
        return found

    return F.transform(F.regexp_extract_all(formatted, F.lit(_BLOCK), F.lit(0)), turn)


def loss_text(formatted: Column, loss: Column) -> Column:
    """The text under the loss mask, cut out of the formatted text and unescaped."""
    # The bytes are bound once; a cut copies no more than its span.
    cut = F.transform(F.array(formatted.cast("binary")), lambda raw: F.transform(loss, lambda x: F.substring(raw, x["start"] + 1, x["length"]).cast("string")))
    return unescape(F.array_join(F.get(cut, F.lit(0)), ""))


def digests(chats: DataFrame) -> DataFrame:
    """What the formatted output holds, read back from it."""
    turns = parse(F.col("formatted"))
    loss = loss_text(F.col("formatted"), F.col("loss"))
    rows = chats.select("conv_id", turns.alias("turns"), loss.alias("loss"), F.length("formatted").cast("long").alias("formatted_chars"))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return rows.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(lines, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )


#: DuckDB SQL for the digests of a relation ``turns(conv_id, turn, role, text)``.
DIGEST_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), e AS (
  SELECT *, regexp_replace(replace(text, '\', '\\'), '([<\[])(/?s>|/?INST\]|/?SYS\]|OUT\]|/?ROLE)', '\1\\\2', 'g') AS escaped,
    CASE role WHEN 'system' THEN 13 WHEN 'user' THEN 15 WHEN 'assistant' THEN 11
      ELSE 16 + length(replace(regexp_replace(replace(role, '\', '\\'), '([<\[])(/?s>|/?INST\]|/?SYS\]|OUT\]|/?ROLE)', '\1\\\2', 'g'), ']', '\]')) END AS marks
  FROM t
), g AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS lines,
    coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
    cast(3 + sum(marks + length(escaped)) AS bigint) AS formatted_chars
  FROM e GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(lines) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM g
"""
