"""Chat formatting: event-sourced reconstruction of conversations, then rendering.

Main path: DataFrame functions only. An event log holds, per conversation, streamed ``delta``
events (text is appended to a message), ``edit`` events (text replaces what the message holds so
far) and ``regenerate`` events (the message starts anew, empty). A message is a (conversation,
turn); its events are folded in order of ``seq``. Both folds go through buckets (of sequence numbers,
then of turns), so a message or conversation with a third of all rows is pre-aggregated by many
tasks; only its finished text or string is a single row.

The template writes a turn as ``<|im_start|>role\\ntext<|im_end|>\\n``. In roles and texts a backslash is
put behind each backslash and behind the first character of each control string (``<|name|>``,
``<s>``, ``</s>``, ``[INST]``, ``[/INST]``, ``<<SYS>>``, ``<</SYS>>``), and before a line end inside a
role. So no control string occurs in them, and dropping each backslash while keeping the character
behind it reverses that.

Defined cases: a null text, role or event kind is empty text, the empty role and ``message`` (which
replaces, as an edit does); a null conversation is a conversation of its own; null sequence
numbers and turns come first; events that tie in all of (turn, seq) are folded by kind, then text,
and rows of ``messages`` that tie in turn are turns of their own, by role, then text, with repeated rows kept;
an empty table gives no conversation; further columns are ignored; texts of any length are kept whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from graniteloom.llm.common import cut, let, pieces, running_totals

START, END = "<|im_start|>", "<|im_end|>\n"
#: After which a backslash is put: a backslash, or the first character of a control string.
CONTROL = r"\\|<(?=\|[A-Za-z_]*\|>|/?s>|</?SYS>>)|\[(?=/?INST\])"
BUCKET, SEQ_BUCKET = 64, 1024
#: Characters of an event of a message that is streamed.
STREAMED = 256


def escape(text: Column) -> Column:
    return F.regexp_replace(text, f"({CONTROL})", r"$1\\")


def escape_role(role: Column) -> Column:
    return F.regexp_replace(escape(role), "\n", "\\\\\n")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def fold_events(events: DataFrame, conv: str = "conv_id", turn: str = "turn", seq: str = "seq", kind: str = "event", role: str = "role", text: str = "text") -> DataFrame:
    """Final messages (conv_id, turn, role, text) of an event log.

    The role is that of the message's first event that has one. Only what follows the last event
    that starts the text anew is joined, so a message that is edited often stays small.
    """
    e = events.select(
        F.col(conv).alias("conv_id"), F.col(turn).alias("turn"),
        F.struct(F.col(seq).alias("seq"), F.coalesce(F.lower(F.col(kind)), F.lit("message")).alias("kind"), F.coalesce(F.col(text), F.lit("")).alias("text"), F.col(role).alias("role")).alias("e"),
    )

    def fold(xs: Column, anew: Column) -> Column:
        """Whether a list of events starts the text anew, and the text from there on."""
        last = F.aggregate(F.sequence(F.lit(1), F.size(xs)), F.lit(0), lambda at, i: F.when(anew(F.get(xs, i - 1)), i).otherwise(at))
        live = lambda at: F.slice(xs, F.greatest(at, F.lit(1)), F.size(xs))
        text = lambda at: F.array_join(F.transform(live(at), lambda x: F.when(x["kind"] == "regenerate", F.lit("")).otherwise(x["text"])), "")
        return let(last, lambda at: F.struct(F.when(at > 0, F.lit("edit")).otherwise(F.lit("delta")).alias("kind"), text(at).alias("text")))

    by = ("conv_id", "turn")
    first = F.min(F.when(F.col("e.role").isNotNull(), F.struct("e.seq", "e.role"))).alias("role")
    part = e.groupBy(*by, F.floor(F.col("e.seq") / SEQ_BUCKET).alias("bucket")).agg(F.array_sort(F.collect_list("e")).alias("es"), first)
    part = part.select(*by, "role", F.struct("bucket", fold(F.col("es"), lambda x: x["kind"] != "delta").alias("p")).alias("b"))
    whole = part.groupBy(*by).agg(F.transform(F.array_sort(F.collect_list("b")), lambda b: b["p"]).alias("ps"), F.min("role").alias("role"))
    return whole.select(*by, F.coalesce("role.role", F.lit("")).alias("role"), fold(F.col("ps"), lambda x: x["kind"] == "edit")["text"].alias("text"))


def render(messages: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", learn: str = "assistant") -> DataFrame:
    """One row per conversation: ``formatted`` and ``loss_mask``.

    ``loss_mask`` lists the code point ranges (start, end exclusive) of the escaped texts of role ``learn``.
    """
    role_text = F.coalesce(F.col(role), F.lit(""))
    head = F.concat(F.lit(START), escape_role(role_text), F.lit("\n"))
    body = escape(F.coalesce(F.col(text), F.lit("")))
    turns = messages.select(F.col(conv).alias("conv_id"), F.col(turn).cast("long").alias("turn"), role_text.alias("role"), head.alias("head"), body.alias("body"))
    turns = turns.withColumn("learns", F.col("role") == learn)
    one = F.struct("turn", "role", F.col("body").alias("by"), F.concat("head", "body", F.lit(END)).alias("s"), F.length("head").alias("h"), F.length("body").alias("b"), "learns")
    parts = turns.groupBy("conv_id", F.floor(F.col("turn") / BUCKET).alias("bucket")).agg(F.array_sort(F.collect_list(one)).alias("ts"))
    parts = parts.select(
        "conv_id", "bucket", F.array_join(F.transform("ts", lambda t: t["s"]), "").alias("s"),
        F.transform("ts", lambda t: F.struct(F.length(t["s"]).cast("long").alias("n"), t["h"].cast("long").alias("h"), t["b"].cast("long").alias("b"), t["learns"].alias("learns"))).alias("spans"),
    )
    whole = parts.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("bucket", "s", "spans"))).alias("ps"))
    whole = whole.select("conv_id", F.array_join(F.transform("ps", lambda p: p["s"]), "").alias("formatted"), F.flatten(F.transform("ps", lambda p: p["spans"])).alias("spans"))
    starts = running_totals(F.transform("spans", lambda x: x["n"]))
    placed = lambda at: F.transform("spans", lambda x, i: F.struct((F.get(at, i) + x["h"]).alias("start"), (F.get(at, i) + x["h"] + x["b"]).alias("end"), x["learns"].alias("learns")))
    learnt = F.filter(let(starts, placed), lambda m: m["learns"])
    return whole.select("conv_id", "formatted", F.transform(learnt, lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"))).alias("loss_mask"))


def parse(formatted: Column) -> Column:
    """The turns (role, text) that a rendered string holds, read back from it alone."""
    pieces = F.split(formatted, r"<\|im_end\|>\n", -1)
    role = r"(?s)^<\|im_start\|>((?:[^\\\n]++|\\.)*+)\n"

    def turn(p: Column) -> Column:
        r = F.regexp_extract(p, role, 1)
        return F.struct(unescape(r).alias("role"), unescape(F.substring(p, F.length(r) + len(START) + 2, F.length(p))).alias("text"))

    return let(pieces, lambda ps: F.transform(F.slice(ps, F.lit(1), F.size(ps) - 1), turn))


def masked_text(formatted: Column, mask: Column) -> Column:
    """The unescaped text under a loss mask, nothing between its ranges."""
    return let(pieces(formatted), lambda ps: F.array_join(F.transform(mask, lambda m: unescape(cut(ps, m["start"], m["end"]))), ""))


def event_log(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text), each a whole message, as the events that stream them: a ``message`` event with the first piece, then ``delta`` events.

    The turn is paired with a number of the row, so that rows that tie in a turn stay messages of their own.
    """
    tied = F.struct(F.col("turn"), F.monotonically_increasing_id().alias("tie"))
    text = F.coalesce(F.col("text"), F.lit(""))
    streamed = F.when(F.length(text) > 0, pieces(text, STREAMED)).otherwise(F.array(F.lit("")))
    told = rows.select("conv_id", tied.alias("turn"), "role", "text")  # numbered before rows are streamed
    events = told.select("conv_id", "turn", "role", F.posexplode(streamed).alias("seq", "text"))
    return events.select("conv_id", "turn", "seq", F.when(F.col("seq") == 0, "message").otherwise("delta").alias("event"), F.when(F.col("seq") == 0, F.col("role")).alias("role"), "text")


def messages(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) through their event log and its fold."""
    return fold_events(event_log(rows)).select("conv_id", "turn.turn", "role", "text")


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -1, rendered and read back.

    Each row of the table is streamed as events of up to ``STREAMED`` characters, which the fold puts together again.
    """
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    planted = spark.range(1).select(F.lit(-1).cast("long").alias("conv_id"), F.explode(F.array(F.struct(F.lit(0).cast("long").alias("turn"), F.lit("user").alias("role")), F.struct(F.lit(1).cast("long").alias("turn"), F.lit("assistant").alias("role")))).alias("m"))
    planted = planted.select("conv_id", "m.turn", "m.role", F.lit("</s>[INST] ok [/INST]").alias("text"))
    out = render(messages(rows.unionByName(planted))).select("conv_id", "formatted", parse(F.col("formatted")).alias("turns"), masked_text(F.col("formatted"), F.col("loss_mask")).alias("loss"))
    flat = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(flat, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )


OP6_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
x AS (
  SELECT *, length(regexp_replace(text, '(\\|<\|[A-Za-z_]*\|>|</?s>|\[/?INST\]|<</?SYS>>)', '\\\1', 'g'))
          + length(regexp_replace(role, '(\\|<\|[A-Za-z_]*\|>|</?s>|\[/?INST\]|<</?SYS>>|\n)', '\\\1', 'g')) + 24 AS n
  FROM c)
SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(n) AS BIGINT) AS formatted_chars
FROM x GROUP BY conv_id
"""
