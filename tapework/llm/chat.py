"""Chat formatting by perspective rotation, in DataFrame functions only.

Every participant of a conversation gets the whole dialogue rendered with that participant as the assistant and the
others as named users; the mask marks the assistant's words, which are what a model is trained on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A turn is rendered as <|im_start|>ROLE name=NAME, a line break, the text, <|im_end|> and a line break.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
#: What opens a mark, and what stands for it inside texts and names, so that none can end a turn or begin another.
MARK, PLAIN = "<|", "< |"
#: Turns of one conversation that are rendered in one row; a longer conversation goes on in a row for each such block, which begins with its first system turn again.
TURNS_PER_BLOCK = 512


def _head(speaker: Column, me: Column, system: str) -> Column:
    return (
        F.when(speaker == system, F.lit(f"{OPEN}system\n"))
        .when(speaker == me, F.lit(f"{OPEN}assistant\n"))
        .otherwise(F.concat(F.lit(f"{OPEN}user name="), speaker, F.lit("\n")))
    )


def rotations(turns: DataFrame, system: str = "system", block: int = TURNS_PER_BLOCK) -> DataFrame:
    """A row for each conversation, participant and block of turns: the rendered text and the trainable character spans.

    turns: conv_id, turn, role (the speaker), text; other columns are ignored. Null text is empty; a null speaker is
    the participant "unknown"; rows without conv_id are left out, as they belong to no dialogue. Null turns come first. Ties on
    turn are ordered by speaker and text; repeated rows stay. The system speaker is context, never a participant,
    so a conversation of system turns only has no row. Spans are start-end in code points of the
    block's text, end exclusive, and cover the speaker's text with its closing tag.

    A later block of a long conversation repeats the conversation's first system turn as context, which n_turns leaves out. Marks of the format inside texts and names are
    written apart, and line breaks in names are spaces, so neither can forge a turn.
    """
    name = F.regexp_replace(F.replace(F.coalesce("role", F.lit("unknown")), F.lit(MARK), F.lit(PLAIN)), "[\\r\\n]+", " ")
    clean = turns.filter("conv_id IS NOT NULL").select(
        "conv_id", "turn", name.alias("role"), F.replace(F.coalesce("text", F.lit("")), F.lit(MARK), F.lit(PLAIN)).alias("text"), F.coalesce(F.floor(F.col("turn") / block), F.lit(0)).cast("long").alias("block")
    )
    people = clean.filter(F.col("role") != system).select("conv_id", F.col("role").alias("participant")).distinct()
    # Blocks are keyed by turn number, so a very long conversation is spread over tasks.
    blocks = clean.groupBy("conv_id", "block").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    first = clean.filter(F.col("role") == system).groupBy("conv_id").agg(F.min(F.struct("block", "turn", "role", "text")).alias("c"))
    context = F.struct("c.turn", "c.role", "c.text")
    blocks = blocks.join(first, "conv_id", "left").withColumn("own", F.size("turns")).withColumn("turns", F.when(F.col("c.block") < F.col("block"), F.concat(F.array(context), F.col("turns"))).otherwise(F.col("turns")))
    seen = blocks.join(people, "conv_id")
    me = F.col("participant")
    parts = F.transform("turns", lambda t: F.struct((t["role"] == me).alias("own"), _head(t["role"], me, system).alias("head"), F.concat(t["text"], F.lit(CLOSE)).alias("body")))
    seen = seen.select("conv_id", "participant", "block", F.col("own").cast("long").alias("n_turns"), parts.alias("parts"))
    lengths = F.transform("parts", lambda p: F.struct(p["own"].alias("own"), F.char_length(p["head"]).alias("head"), F.char_length(p["body"]).alias("body")))
    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(acc: Column, p: Column) -> Column:
        start = acc["at"] + p["head"]
        span = F.struct(start.alias("start"), (start + p["body"]).alias("end"))
        return F.struct((start + p["body"]).alias("at"), F.when(p["own"], F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"))

    spans = F.aggregate("lengths", empty, step, lambda acc: acc["spans"])
    return seen.withColumn("lengths", lengths).select("conv_id", "participant", "block", "n_turns", F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["body"])), "").alias("text"), spans.alias("spans"))


def rotation_report(turns: DataFrame) -> DataFrame:
    """The rotations with their spans as text and the masked length."""
    spans = F.array_join(F.transform("spans", lambda s: F.concat_ws("-", s["start"].cast("string"), s["end"].cast("string"))), ",")
    masked = F.aggregate("spans", F.lit(0), lambda acc, s: acc + s["end"] - s["start"]).cast("long")
    return rotations(turns).select("conv_id", "participant", "block", "n_turns", "text", F.char_length("text").cast("long").alias("n_chars"), spans.alias("spans"), masked.alias("n_trainable"))


ROTATION_SQL = r"""
WITH clean AS (
  SELECT conv_id, turn, regexp_replace(replace(coalesce(role, 'unknown'), '<|', '< |'), '[\r\n]+', ' ', 'g') AS role, replace(coalesce(text, ''), '<|', '< |') AS text,
         coalesce(CAST(floor(turn / 512.0) AS BIGINT), 0) AS block
  FROM conversations WHERE conv_id IS NOT NULL),
people AS (SELECT DISTINCT conv_id, role AS participant FROM clean WHERE role <> 'system'),
first AS (
  SELECT conv_id, turn, role, text, block AS at FROM clean WHERE role = 'system'
  QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY block, turn NULLS FIRST, text) = 1),
every AS (
  SELECT *, 1 AS own_turn FROM clean UNION ALL
  SELECT f.conv_id, f.turn, f.role, f.text, b.block, 0 FROM first AS f JOIN (SELECT DISTINCT conv_id, block FROM clean) AS b ON b.conv_id = f.conv_id AND b.block > f.at),
parts AS (
  SELECT c.conv_id, p.participant, c.block, c.turn, c.role, c.text, c.own_turn, c.role = p.participant AS own,
         CASE WHEN c.role = 'system' THEN '<|im_start|>system' || chr(10)
              WHEN c.role = p.participant THEN '<|im_start|>assistant' || chr(10)
              ELSE '<|im_start|>user name=' || c.role || chr(10) END AS head,
         c.text || '<|im_end|>' || chr(10) AS body
  FROM every c JOIN people p USING (conv_id)),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, participant, block ORDER BY own_turn, turn NULLS FIRST, role, text) AS k FROM parts),
placed AS (
  SELECT *, coalesce(sum(length(head) + length(body)) OVER (PARTITION BY conv_id, participant, block ORDER BY k
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + length(head) AS start FROM numbered)
SELECT conv_id, participant, block, CAST(sum(own_turn) AS BIGINT) AS n_turns, string_agg(head || body, '' ORDER BY k) AS text,
       CAST(sum(length(head) + length(body)) AS BIGINT) AS n_chars,
       coalesce(string_agg(CAST(start AS BIGINT) || '-' || CAST(start + length(body) AS BIGINT), ',' ORDER BY k) FILTER (WHERE own), '') AS spans,
       CAST(coalesce(sum(length(body)) FILTER (WHERE own), 0) AS BIGINT) AS n_trainable
FROM placed GROUP BY conv_id, participant, block
"""
