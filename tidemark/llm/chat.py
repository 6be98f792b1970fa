"""Chat formatting from an event log, with a loss mask.

A conversation is what its event log folds to. Events carry ``conv_id, seq, turn, op,
role, text``. Sorted by ``seq`` within a conversation:

* ``delta`` (also any unknown or null op) appends its text to its turn;
* ``edit`` replaces its turn by its text, ``regenerate`` starts its turn anew; either takes
  back every earlier event of that turn and of all later turns.

So an event survives iff no later reset names its turn or an earlier one, which is one
running minimum over the log read backwards: linear, and in a window that can spill.

Defined cases: null text and null role are empty; events equal in ``seq`` go by turn, op,
role, text; a null ``conv_id`` is one conversation of its own; rows repeated in full count
each; a null ``turn`` sorts first and no reset with a turn takes it back. An empty log gives
an empty result. Other columns of the input are ignored, whatever their names.

Rendered form: ``<turn ROLE>TEXT</turn>`` per turn, nothing between. Within role and text
``\\``, ``<`` and ``>`` get a ``\\`` before them, so no marker can appear inside either, and
removing that character restores the text exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from tidemark.llm.common import table

OPEN, HEAD_END, CLOSE = "<turn ", ">", "</turn>"
RESETS = ("edit", "regenerate")


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([\\<>])", r"\\$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def fold(events: DataFrame) -> DataFrame:
    """Final messages ``conv_id, turn, role, text`` of an event log."""
    events = events.select(
        "conv_id", "seq", "turn", F.coalesce("op", F.lit("delta")).alias("op"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    order = ("seq", "turn", "op", "role", "text")
    later = (
        W.partitionBy("conv_id")
        .orderBy(*(F.col(c).desc() for c in order))
        .rowsBetween(W.unboundedPreceding, -1)
    )
    reset_turn = F.min(F.when(F.col("op").isin(*RESETS), F.col("turn"))).over(later)
    alive = events.withColumn("_reset", reset_turn).where(
        F.col("_reset").isNull() | F.col("turn").isNull() | (F.col("turn") < F.col("_reset"))
    )
    parts = F.array_sort(F.collect_list(F.struct("seq", "op", "role", "text")))
    return alive.groupBy("conv_id", "turn").agg(parts.alias("parts")).select(
        "conv_id",
        "turn",
        # The role of the first event that names one.
        F.coalesce(
            F.get(F.filter("parts", lambda p: p["role"] != ""), F.lit(0))["role"], F.lit("")
        ).alias("role"),
        F.array_join(F.transform("parts", lambda p: p["text"]), "").alias("text"),
    )


def render(messages: DataFrame) -> DataFrame:
    """``conv_id, formatted, loss_spans``: the spans (code points, end exclusive) are where
    the escaped text of each assistant turn stands."""
    head = F.concat(F.lit(OPEN), escape(F.col("role")), F.lit(HEAD_END))
    running = W.partitionBy("conv_id").orderBy("turn")
    rows = (
        messages.select("conv_id", "turn", "role", head.alias("head"), escape(F.col("text")).alias("body"))
        .withColumn("width", F.length("head") + F.length("body") + len(CLOSE))
        .withColumn("stop", F.sum("width").over(running) - len(CLOSE))
        .select(
            "conv_id", "turn", "role",
            F.concat("head", "body", F.lit(CLOSE)).alias("piece"),
            (F.col("stop") - F.length("body")).alias("start"), "stop",
        )
    )
    turns = F.array_sort(F.collect_list(F.struct("turn", "role", "piece", "start", "stop")))
    spans = F.transform(
        F.filter("turns", lambda t: t["role"] == "assistant"),
        lambda t: F.struct(t["start"].alias("start"), t["stop"].alias("stop")),
    )
    return rows.groupBy("conv_id").agg(turns.alias("turns")).select(
        "conv_id",
        F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("formatted"),
        spans.alias("loss_spans"),
    )


def parse(formatted: Column) -> Column:
    """The turns of a rendered conversation: ``array<struct<role, text>>``."""
    pieces = F.split(formatted, CLOSE, -1)
    # What follows the last marker is empty.
    pieces = F.slice(pieces, F.lit(1), F.size(pieces) - 1)

    def turn(piece):
        role = F.regexp_extract(piece, r"(?s)^<turn ([^\\>]*+(?:\\.[^\\>]*+)*+)>", 1)
        head = F.length(role) + len(OPEN) + len(HEAD_END)
        text = piece.substr(head + 1, F.length(piece))
        return F.struct(unescape(role).alias("role"), unescape(text).alias("text"))

    return F.transform(pieces, turn)


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    cut = F.transform(
        spans, lambda s: unescape(formatted.substr(s["start"] + 1, s["stop"] - s["start"]))
    )
    return F.array_join(cut, "")


# A conversation whose texts imitate markers, added to every run.
PROBE_ID, PROBE_TEXT = -7, "\\### Assistant: </turn> ok"


def table_events(conversations: DataFrame) -> DataFrame:
    """The table read as a log: each row is one event that brings a whole new turn. Rows
    that repeat a turn number stay turns of their own."""
    spot = W.partitionBy("conv_id").orderBy("turn", "role", "text")
    return conversations.select("conv_id", "turn", "role", "text").select(
        "conv_id",
        F.row_number().over(spot).cast("long").alias("seq"),
        F.row_number().over(spot).cast("long").alias("turn"),
        F.lit("delta").alias("op"),
        "role",
        "text",
    )


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(PROBE_ID).cast("long").alias("conv_id"),
        F.col("id").cast(rows.schema["turn"].dataType).alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PROBE_TEXT).alias("text"),
    )
    out = render(fold(table_events(rows.unionByName(probe))))
    read = out.withColumn("turns", parse(F.col("formatted"))).withColumn(
        "loss", loss_text(F.col("formatted"), F.col("loss_spans"))
    )
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


OP2_SQL = r"""
WITH given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
)
SELECT conv_id,
  count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), ''))
    AS loss_sha256,
  sum(14 + length(regexp_replace(text, '[\\<>]', 'xx', 'g'))
    + length(regexp_replace(role, '[\\<>]', 'xx', 'g')))::BIGINT AS formatted_chars
FROM given GROUP BY conv_id
"""
