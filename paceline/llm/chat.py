"""Chat formatting by event sourcing, in DataFrame functions only.

A conversation is a log of events. Folding it in sequence order gives the final messages:

* ``message`` starts message ``msg`` with a role and a first text,
* ``delta`` appends streamed text to it,
* ``edit`` replaces its text,
* ``regenerate`` drops its text (the deltas that follow stream a new one).

The messages are then rendered with turn markers. Control strings inside a text are broken up by a
backslash in a way that can be undone, so a text never opens or closes a turn.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
#: The role whose texts are trained on.
LEARNED = "assistant"
#: First characters of control strings, each followed by what makes it one: the markers above, and the markers of other
#: public templates, which a tokenizer might treat as special as well.
_CONTROL = r"(<(?=\||/?s>|/?SYS>|<SYS>>|</SYS>>)|\[(?=/?INST\]))"


def escape(text: Column) -> Column:
    """Double every backslash, then put one behind the first character of each control string."""
    return F.regexp_replace(F.regexp_replace(text, r"\\", r"\\\\"), _CONTROL, r"$1\\")


def unescape(text: Column) -> Column:
    """A backslash stands for the character after it: the exact inverse of :func:`escape`."""
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def escape_role(role: Column) -> Column:
    """A role ends at a line break, so its own line breaks are written as backslash and n."""
    return F.regexp_replace(escape(role), "\n", r"\\n")


def unescape_role(role: Column) -> Column:
    pieces = F.split(role, r"\\\\", -1)  # doubled backslashes apart, so that an n after one is a plain n
    return F.array_join(F.transform(pieces, lambda p: unescape(F.regexp_replace(p, r"\\n", "\n"))), "\\")


def fold(events: DataFrame, conv: str, seq: str, msg: str, kind: str, role: str, text: str) -> DataFrame:
    """(conv, msg, role, text): the final messages of every conversation.

    Each message is folded by itself: the deltas after its last reset (message, edit or regenerate)
    follow the text of that reset. One event log of a message meets in one task, never that of a
    conversation. NULL texts are empty, a NULL role is an empty one, the latest role given counts.
    Events with equal sequence numbers apply in the order of kind, role and text, so repeated rows
    give the same result in every run. Events of unknown kind change nothing. A message that was
    never started (its first event is a delta) starts empty.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    reset = F.col(kind).isin("message", "edit", "regenerate")
    event = F.struct(F.col(seq).alias("seq"), F.col(kind).alias("kind"), F.coalesce(F.col(role), F.lit("")).alias("role"), body.alias("text"))
    folded = (events.where(reset | (F.col(kind) == "delta")).groupBy(F.col(conv).alias("conv"), F.col(msg).alias("msg"))
              .agg(F.array_sort(F.collect_list(event)).alias("log")))
    last = F.greatest(F.array_max(F.transform("log", lambda e, i: F.when(e["kind"] != "delta", i).otherwise(-1))), F.lit(0))
    kept = F.filter("log", lambda e, i: i >= F.col("_last"))
    texts = F.transform(kept, lambda e: F.when(e["kind"] == "regenerate", "").otherwise(e["text"]))
    roles = F.filter(F.transform("log", lambda e: e["role"]), lambda r: r != "")
    return (folded.withColumn("_last", last)
            .select("conv", "msg", F.coalesce(F.try_element_at(roles, F.lit(-1)), F.lit("")).alias("role"),
                    F.array_join(texts, "").alias("text")))


def render(messages: DataFrame, learned: str = LEARNED) -> DataFrame:
    """(conv, formatted, loss_spans) from (conv, msg, role, text), one row per conversation.

    Every message is rendered on its own; a conversation then joins its turns in order of ``msg``.
    ``loss_spans`` has (turn, start, length) in characters of that turn for each text that is
    trained on; turns end at the closing marker.
    """
    head = F.concat(F.lit(OPEN), escape_role(F.col("role")), F.lit("\n"))
    body = escape(F.col("text"))
    turn = F.struct("msg", F.concat(head, body, F.lit(CLOSE)).alias("piece"), (F.col("role") == learned).alias("loss"),
                    F.char_length(head).alias("start"), F.char_length(body).alias("length"))
    joined = messages.groupBy("conv").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    spans = F.filter(F.transform("turns", lambda t, i: F.struct(i.alias("turn"), t["start"].alias("start"), t["length"].alias("length"),
                                                              t["loss"].alias("loss"))), lambda s: s["loss"])
    return joined.select("conv", F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("formatted"),
                         F.transform(spans, lambda s: s.dropFields("loss")).alias("loss_spans"))


def read_back(formatted: Column) -> Column:
    """Array of (role, text) that a formatted conversation says."""
    pieces = F.split(formatted, r"<\|im_end\|>\n", -1)
    pieces = F.filter(pieces, lambda p: p.startswith(OPEN))
    def parts(p):
        rest = F.substr(p, F.lit(len(OPEN) + 1))
        cut = F.locate("\n", rest)
        return F.struct(unescape_role(F.substr(rest, F.lit(1), cut - 1)).alias("role"), unescape(F.substr(rest, cut + 1)).alias("text"))
    return F.transform(pieces, parts)


def learned_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, with nothing between."""
    pieces = F.split(formatted, r"<\|im_end\|>\n", -1)
    return F.array_join(F.transform(spans, lambda s: unescape(F.substr(F.get(pieces, s["turn"]), s["start"] + 1, s["length"]))), "")


def format_log(events: DataFrame, conv: str = "conv_id", seq: str = "seq", msg: str = "msg", kind: str = "kind", role: str = "role",
               text: str = "text") -> DataFrame:
    """(conv, formatted, loss_spans) of every conversation of an event log.

    Rows with a NULL conversation form one of their own. Other columns are ignored. An empty log gives an empty result.
    """
    return render(fold(events, conv, seq, msg, kind, role, text)).withColumnRenamed("conv", conv)


def turns_as_events(conversations: DataFrame) -> DataFrame:
    """Event log of finished turns (conv_id, turn, role, text): each turn is started, and its text streamed as one delta.

    Turns that repeat a number are turns of their own, in the order of role and text.
    """
    order = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    nth = F.row_number().over(Window.partitionBy("conv_id", "turn").orderBy(order))
    rows = conversations.select("conv_id", F.struct(F.col("turn"), nth.alias("nth")).alias("msg"), "role", "text")
    return rows.select("conv_id", "msg", "role", F.posexplode(F.array(
        F.struct(F.lit("message").alias("kind"), F.lit("").alias("text")),
        F.struct(F.lit("delta").alias("kind"), F.coalesce("text", F.lit("")).alias("text")))).alias("seq", "e")).select(
            "conv_id", "seq", "msg", "e.kind", "role", "e.text")
