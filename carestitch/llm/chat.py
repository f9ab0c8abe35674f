"""Chat formatting in budgeted windows, by DataFrame functions only.

Prefix sums of turn tokens place each turn on a grid of the budget that is left beside the system turn and repeated
history. Turns inside one cell make a span; a turn across a border is a span of its own: so every turn finds its span
alone, and a span never exceeds the budget unless a single turn does. A window is the system turn, turns repeated
from before the span up to the history budget, and the span. Only turns that are not repeated bear loss.

Prefix sums run over blocks of turns and then inside blocks, so a conversation of any length is spread over tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>\n"


@dataclass(frozen=True)
class Windows:
    """``budget`` and ``history`` in tokens; a turn counts ``overhead`` and one token for each ``chars`` code points."""

    budget: int = 2048
    history: int = 256
    chars: int = 4
    overhead: int = 4
    block: int = 256


def escape(text: Column) -> Column:
    """Backslashes doubled and one put between < and |, so that no marker can occur."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _turns(conversations: DataFrame, rule: Windows) -> DataFrame:
    """Turns with their position, the tokens before and after them (the system turn left out) and their span."""
    text = F.coalesce("text", F.lit(""))
    turns = conversations.select(
        F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("c"), "conv_id", "turn",
        F.coalesce("role", F.lit("")).alias("role"), text.alias("text"),
        (F.ceil(F.length(text) / rule.chars) + rule.overhead).cast("long").alias("tokens"),
        F.coalesce(F.floor(F.col("turn") / rule.block), F.lit(-(1 << 62))).alias("block"),
    )
    order = Window.partitionBy("c").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    head = F.first("head").over(order.rowsBetween(Window.unboundedPreceding, 0))
    blocks = turns.groupBy("c", "block").agg(F.sum("tokens").alias("t"), F.count("*").alias("n"), F.min(F.struct("turn", "role", "text", "tokens")).alias("head"))
    blocks = blocks.select("c", "block", F.coalesce(F.sum("t").over(before), F.lit(0)).alias("t0"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n0"),
                           F.when(head["role"] == "system", head["tokens"]).otherwise(0).alias("system"))
    inside = Window.partitionBy("c", "block").orderBy("turn", "role", "text")
    running = inside.rowsBetween(Window.unboundedPreceding, 0)
    turns = turns.withColumn("to", F.sum("tokens").over(running)).withColumn("at", F.row_number().over(inside))
    turns = turns.join(blocks, ["c", "block"]).withColumn("at", F.col("n0") + F.col("at"))
    cell = F.greatest(F.lit(rule.budget - rule.history) - F.col("system"), F.lit(max(1, rule.budget // 4)))
    turns = turns.withColumn("cell", cell).withColumn("to", F.col("t0") + F.col("to") - F.col("system")).withColumn("fro", F.col("to") - F.col("tokens"))
    first, last = F.floor(F.col("fro") / F.col("cell")), F.floor((F.col("to") - 1) / F.col("cell"))
    is_head = (F.col("system") > 0) & (F.col("at") == 1)
    span = F.when(is_head, 0).otherwise(2 * first + (first != last).cast("long"))
    return turns.select("c", "conv_id", "at", "role", "text", "tokens", "fro", "to", "cell", is_head.alias("is_head"), span.cast("long").alias("span"))


def chat_windows(conversations: DataFrame, rule: Windows = Windows()) -> DataFrame:
    """One row for each window: conv_id, span, formatted, loss_spans, n_turns, n_repeated, n_tokens, over_budget.

    ``loss_spans`` are (start, length) in code points of ``formatted``; repeated turns stand before the others and
    bear none. Turns order by number (null first), role and text, repeated rows are turns of their own. Null roles and
    texts are empty ones; rows without a conv_id are one conversation. A leading system turn is repeated in every
    window, other system turns are ordinary. A window with a turn above the budget is ``over_budget``. Other columns
    are not looked at; an empty table gives an empty result.
    """
    turns = _turns(conversations, rule)
    own = turns.select("c", "conv_id", "span", "at", F.lit(False).alias("repeated"), "role", "text", "tokens")
    spans = turns.groupBy("c", "span").agg(F.min(F.greatest("fro", F.lit(0))).alias("start"), F.first("cell").alias("s_cell")).where("span > 0")
    spans = spans.withColumn("near", F.floor(F.col("start") / F.col("s_cell")))
    past = turns.where(~F.col("is_head"))
    past = past.withColumn("near", F.explode(F.sequence(F.floor(F.col("fro") / F.col("cell")), F.floor((F.col("fro") + rule.history) / F.col("cell")))))
    past = past.drop("span").join(spans, ["c", "near"]).where((F.col("to") <= F.col("start")) & (F.col("start") - F.col("fro") <= rule.history))
    head = turns.where("is_head").drop("span").join(spans.select("c", "span"), "c")
    again = [x.select("c", "conv_id", "span", "at", F.lit(True).alias("repeated"), "role", "text", "tokens") for x in (past, head)]
    rows = own.unionAll(again[0]).unionAll(again[1])

    role, text = escape(F.col("role")), escape(F.col("text"))
    rows = rows.withColumn("piece", F.concat(F.lit(TURN), role, F.lit(TEXT), text, F.lit(END)))
    before = Window.partitionBy("c", "span").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.length("piece")).over(before), F.lit(0)) + F.length(role) + (len(TURN) + len(TEXT))
    rows = rows.select("c", "conv_id", "span", "at", "piece", "tokens", F.col("repeated").cast("long").alias("repeated"),
                       F.when((F.col("role") == "assistant") & ~F.col("repeated"), F.struct(start.alias("start"), F.length(text).cast("long").alias("length"))).alias("loss"))
    found = rows.groupBy("c", "span").agg(
        F.first("conv_id").alias("conv_id"), F.sort_array(F.collect_list(F.struct("at", "piece"))).alias("pieces"),
        F.sort_array(F.collect_list("loss")).alias("loss_spans"), F.count("*").alias("n_turns"), F.sum("repeated").alias("n_repeated"), F.sum("tokens").alias("n_tokens"))
    return found.select("conv_id", "span", F.array_join(F.col("pieces.piece"), "").alias("formatted"), "loss_spans", "n_turns", "n_repeated", "n_tokens",
                        (F.col("n_tokens") > rule.budget).alias("over_budget"))


def read_windows(windows: DataFrame) -> DataFrame:
    """conv_id, span, turns (role and text of each turn that isn't repeated), loss (texts under the mask), from ``formatted``."""
    part = F.split("formatted", r"<\|end\|>\n", -1)
    part = F.slice(part, F.col("n_repeated").cast("int") + 1, (F.col("n_turns") - F.col("n_repeated")).cast("int"))
    turns = F.transform(part, lambda x: F.struct(
        unescape(F.regexp_extract(x, r"(?s)\A<\|turn\|>(.*?)<\|text\|>", 1)).alias("role"), unescape(F.regexp_extract(x, r"(?s)<\|text\|>(.*)\z", 1)).alias("text")))
    loss = F.transform("loss_spans", lambda s: unescape(F.substring(F.col("formatted"), s["start"].cast("int") + 1, s["length"].cast("int"))))
    return windows.select("conv_id", "span", turns.alias("turns"), loss.alias("loss"), F.length("formatted").cast("long").alias("formatted_chars"))


def conversation_digests(windows: DataFrame) -> DataFrame:
    """What the windows say of each conversation: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    A digest is of a whole conversation, so its text meets in one row here (and only here)."""
    read = read_windows(windows).select(
        "conv_id", "span", F.size("turns").alias("n"), F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").alias("said"),
        F.array_join("loss", "").alias("lost"), "formatted_chars")
    whole = read.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("span", "said", "lost"))).alias("w"), F.sum("n").alias("n_turns"), F.sum("formatted_chars").alias("formatted_chars"))
    said, lost = F.array_join(F.col("w.said"), ""), F.array_join(F.col("w.lost"), "")
    return whole.select("conv_id", F.col("n_turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"), F.length(lost).cast("long").alias("loss_chars"),
                        F.sha2(lost, 256).alias("loss_sha256"), "formatted_chars")


def hostile_conversation(conversations: DataFrame) -> DataFrame:
    """``conversations`` and conversation -7, whose texts look like control strings of other templates."""
    spark = conversations.sparkSession
    said = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                 F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("\\### Assistant: </turn> ok").alias("text"))
    return conversations.select("conv_id", "turn", "role", "text").unionByName(said)


#: The digests in DuckDB's SQL, with the default windows.
SQL = r"""
WITH raw AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), sized AS (
  SELECT *, CAST(ceil(length(text) / 4.0) AS BIGINT) + 4 AS tokens,
    24 + length(replace(replace(role, '\', '\\'), '<|', '<\|')) + length(replace(replace(text, '\', '\\'), '<|', '<\|')) AS chars,
    row_number() OVER o AS pos
  FROM raw WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), summed AS (
  SELECT *, sum(tokens) OVER (PARTITION BY conv_id ORDER BY pos) AS upto,
    max(CASE WHEN pos = 1 AND role = 'system' THEN tokens ELSE 0 END) OVER (PARTITION BY conv_id) AS head
  FROM sized
), placed AS (
  SELECT *, upto - head AS b, upto - head - tokens AS a, greatest(1792 - head, 512) AS cell, head > 0 AND pos = 1 AS is_head FROM summed
), spanned AS (
  SELECT *, CASE WHEN is_head THEN 0 ELSE 2 * CAST(floor(a / cell) AS BIGINT)
    + CAST(floor(a / cell) <> floor((b - 1) / cell) AS BIGINT) END AS span FROM placed
), spans AS (SELECT conv_id, span, min(greatest(a, 0)) AS s FROM spanned WHERE span > 0 GROUP BY ALL),
again AS (
  SELECT t.conv_id, sum(t.chars) AS chars FROM spanned t JOIN spans s ON t.conv_id IS NOT DISTINCT FROM s.conv_id
    AND (t.is_head OR t.b <= s.s AND s.s - t.a <= 256) GROUP BY ALL
), whole AS (
  SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
    coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY pos), '') AS lost, sum(chars) AS chars
  FROM spanned GROUP BY conv_id
)
SELECT w.conv_id, n_turns, turns_sha256, CAST(length(lost) AS BIGINT) AS loss_chars, sha256(lost) AS loss_sha256,
  CAST(w.chars + coalesce(a.chars, 0) AS BIGINT) AS formatted_chars
FROM whole w LEFT JOIN again a ON w.conv_id IS NOT DISTINCT FROM a.conv_id
"""
