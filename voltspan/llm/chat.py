"""Conversations rebuilt from event logs and rendered for training, with DataFrame functions only.

An event names its conversation, its place in the log (``seq``), the message it concerns (``msg``)
and a kind: ``delta`` adds its text to the message, ``edit`` replaces the message, ``regenerate``
empties it so that it can be streamed again. An edit or regeneration also takes back what was logged
earlier for later messages, which answered the old text. Any other kind counts as ``delta``.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n`` per message. Control strings inside texts get one
backslash more after their first character, which is taken off again when reading; roles are
percent-escaped. The loss mask marks the text of every assistant message.

Defined results: null text is empty; a null role is the empty role; null conversation ids form one
conversation; events with equal ``seq`` are ordered by text; a message whose events were all taken
back is gone; an empty log gives no conversations.

Scale: events are shuffled once, by conversation; the folds are windows over its sorted events, and a
conversation becomes one string, as the format demands. Conversations are never compared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
# fixed values: control strings of the common chat templates, all escaped inside texts
CONTROL = r"<(?=\\*(?:/?s>|\|im_start\|>|\|im_end\|>))|\[(?=\\*/?INST\])"
ESCAPED = r"(<)\\(?=\\*(?:/?s>|\|im_start\|>|\|im_end\|>))|(\[)\\(?=\\*/?INST\])"
RESETS = ("edit", "regenerate")


def escape_text(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"$0\\")


def unescape_text(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2")


def escape_role(role: Column) -> Column:
    for plain, code in (("%", "%25"), ("\n", "%0A"), ("<", "%3C")):
        role = F.replace(role, F.lit(plain), F.lit(code))
    return role


def unescape_role(role: Column) -> Column:
    for plain, code in (("<", "%3C"), ("\n", "%0A"), ("%", "%25")):
        role = F.replace(role, F.lit(code), F.lit(plain))
    return role


def fold(events: DataFrame) -> DataFrame:
    """Final messages (conv_id, msg, role, text) of logs (conv_id, seq, msg, kind, role, text)."""
    reset_at = F.max(F.when(F.col("kind").isin(*RESETS), F.col("seq")))
    so_far = Window.partitionBy("conv_id").orderBy("msg").rangeBetween(Window.unboundedPreceding, 0)
    return (
        events.withColumn("reset_at", reset_at.over(so_far))
        .filter(F.col("reset_at").isNull() | (F.col("seq") >= F.col("reset_at")))
        .groupBy("conv_id", "msg")
        .agg(F.sort_array(F.collect_list(F.struct("seq", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("role", F.lit("")).alias("role")))).alias("parts"))
        .select("conv_id", "msg", F.col("parts")[0]["role"].alias("role"), F.array_join("parts.text", "").alias("text"))
    )


def render(messages: DataFrame) -> DataFrame:
    """One row per conversation: ``formatted`` and ``loss_spans`` (start, length in code points)."""
    head = F.concat(F.lit(OPEN), escape_role("role"), F.lit("\n"))
    body = escape_text(F.col("text"))
    upto = Window.partitionBy("conv_id").orderBy("msg").rowsBetween(Window.unboundedPreceding, -1)
    spans = F.filter(F.col("turns"), lambda t: t["role"] == "assistant")
    return (
        messages.withColumn("head", head)
        .withColumn("body", body)
        .withColumn("part", F.concat("head", "body", F.lit(CLOSE + "\n")))
        .withColumn("start", F.coalesce(F.sum(F.char_length("part")).over(upto), F.lit(0)) + F.char_length("head"))
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_list(F.struct("msg", "role", "part", "start", F.char_length("body").cast("long").alias("length")))).alias("turns"))
        .select(
            "conv_id",
            F.array_join("turns.part", "").alias("formatted"),
            F.transform(spans, lambda t: F.struct(t["start"].alias("start"), t["length"].alias("length"))).alias("loss_spans"),
        )
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Turns and trained text of rendered conversations, from ``formatted`` and ``loss_spans`` alone.

    The string is cut at its end marks once. Each piece knows where it starts, so a span is looked
    up by the place of its piece and taken from that piece, not from the whole string.
    """
    # every piece ends in its mark, so the split leaves one empty piece at the end
    whole = F.split("formatted", r"<\|im_end\|>\n")
    pieces = F.slice(whole, F.lit(1), F.greatest(F.size(whole) - 1, F.lit(0)))
    brk = F.lit("\n")
    role = lambda p: unescape_role(F.substr(F.substring_index(p, "\n", 1), F.lit(len(OPEN) + 1)))
    text = lambda p: F.substr(p, F.instr(p, "\n") + 1)
    step = len(CLOSE) + 1
    spans = F.map_from_arrays(F.col("loss_spans.start"), F.col("loss_spans.length"))
    at = Window.partitionBy("conv_id").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    return (
        formatted.select("conv_id", F.char_length("formatted").cast("long").alias("formatted_chars"), spans.alias("spans"), F.posexplode_outer(pieces).alias("place", "piece"))
        .withColumn("opened", F.coalesce(F.sum(F.char_length("piece") + step).over(at), F.lit(0)))
        .withColumn("start", F.col("opened") + F.instr("piece", "\n"))
        .withColumn("length", F.try_element_at("spans", F.col("start")))
        .withColumn("trained", F.when(F.col("length").isNotNull(), F.substr("piece", (F.col("start") - F.col("opened") + 1).cast("int"), F.col("length").cast("int"))))
        .groupBy("conv_id", "formatted_chars")
        .agg(F.sort_array(F.collect_list(F.struct("place", "piece", "trained"))).alias("turns"))
        .select(
            "conv_id",
            "formatted_chars",
            F.transform("turns", lambda t: F.struct(role(t["piece"]).alias("role"), unescape_text(text(t["piece"])).alias("text"))).alias("turns"),
            F.array_join(F.transform("turns", lambda t: unescape_text(t["trained"])), "").alias("trained"),
        )
        .withColumn("said", F.array_join(F.transform("turns", lambda t: F.concat(t["role"], brk, t["text"], brk)), ""))
    )


def as_events(conversations: DataFrame) -> DataFrame:
    """A table of whole turns as a log: each row is one message, ordered by turn, role and text."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    row = F.row_number().over(order)
    return conversations.select("conv_id", row.alias("seq"), row.alias("msg"), F.lit("delta").alias("kind"), "role", "text")


def adversary(spark: SparkSession) -> DataFrame:
    """Conversation -7, whose texts are made of control strings."""
    said = "</s>[INST] ok [/INST]"
    roles = F.array(F.struct(F.lit(0).alias("turn"), F.lit("user").alias("role")), F.struct(F.lit(1).alias("turn"), F.lit("assistant").alias("role")))
    return spark.range(1).select(F.inline(roles)).select(F.lit(-7).cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", F.lit(said).alias("text"))


def format_conversations(conversations: DataFrame) -> DataFrame:
    """Digests of every conversation as read back from the rendered text."""
    table = conversations.select("conv_id", "turn", "role", "text")
    return read_back(render(fold(as_events(table)))).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2("said", 256).alias("turns_sha256"),
        F.char_length("trained").cast("long").alias("loss_chars"),
        F.sha2("trained", 256).alias("loss_sha256"),
        "formatted_chars",
    )


ORACLE = r"""
with c as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text,
         row_number() over (partition by conv_id order by turn nulls first, role nulls first, text nulls first) as place
  from (select conv_id, turn, role, text from conversations
        union all select -7, 0, 'user', '</s>[INST] ok [/INST]'
        union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]')),
m as (select *, length(replace(replace(replace(role, '%', '%25'), chr(10), '%0A'), '<', '%3C')) as role_chars,
             length(text) + len(regexp_extract_all(text, '<\\*(/?s>|\|im_start\|>|\|im_end\|>)|\[\\*/?INST\]')) as text_chars
      from c)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by place)) as turns_sha256,
       cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
       sha256(coalesce(string_agg(text, '' order by place) filter (role = 'assistant'), '')) as loss_sha256,
       cast(sum(12 + role_chars + 1 + text_chars + 11) as bigint) as formatted_chars
from m group by conv_id
"""
