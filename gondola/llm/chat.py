"""Chat formatting with perspective rotation.

For every participant of a conversation (each role but the system's) the dialogue is rendered once, with that participant as the assistant and all
others as named users. The mask marks what the participant said, with the end mark, as spans of characters; only that is to be learned.

A rendering is cut into parts of ``PART`` turn numbers, so a row never holds a conversation of any length; the parts in order are the whole. Spans
count from the beginning of their part. Whoever speaks in some part of the conversation has a row for each of its parts.

Cases: a null role speaks as ``unknown``; null text is empty; null turns come first, in the order of role and text; repeated turns stand in the order
of role and text, repeated rows are all rendered; a conversation of system turns alone has no row; null conversation ids are one conversation; an
empty table gives an empty result; other columns are not kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SYSTEM = "system"
UNKNOWN = "unknown"
BEGIN, END = "<|im_start|>", "<|im_end|>"
PART = 1024


def rotate(turns: DataFrame, part: int = PART) -> DataFrame:
    """(conv_id, speaker, part, n_turns, text, spans): ``spans`` an array of (begin, end) in characters, end excluded."""
    rows = turns.select(
        F.struct("conv_id").alias("conv"),
        F.coalesce(F.floor(F.col("turn") / part), F.lit(0)).cast("long").alias("part"),
        "turn",
        F.coalesce("role", F.lit(UNKNOWN)).alias("role"),
        F.coalesce("text", F.lit("")).alias("said"),
    )
    speakers = rows.where(F.col("role") != SYSTEM).select("conv", F.col("role").alias("speaker")).distinct()
    seen = rows.join(speakers, "conv")
    own = F.col("role") == F.col("speaker")
    head = F.when(own, F.lit(f"{BEGIN}assistant\n")).when(F.col("role") == SYSTEM, F.lit(f"{BEGIN}system\n"))
    head = head.otherwise(F.concat(F.lit(f"{BEGIN}user name="), "role", F.lit("\n")))
    order = [F.col("turn").asc_nulls_first(), "role", "said"]
    before = Window.partitionBy("conv", "speaker", "part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    body = F.concat("said", F.lit(END))
    seen = seen.withColumns({"own": own, "head": head, "body": body}).withColumn("piece", F.concat("head", "body", F.lit("\n")))
    length = F.char_length("piece").cast("long")
    seen = seen.withColumns({"start": F.sum(length).over(before) - length, "place": F.row_number().over(before)})
    begin = F.col("start") + F.char_length("head")
    span = F.when(F.col("own"), F.struct(begin.alias("begin"), (begin + F.char_length("body")).alias("end")))
    pieces = F.array_sort(F.collect_list(F.struct("place", "piece")))
    grouped = seen.withColumn("span", span).groupBy("conv", "speaker", "part").agg(
        F.count("*").alias("n_turns"), pieces.alias("pieces"), F.array_sort(F.collect_list("span")).alias("spans")
    )
    return grouped.select("conv.conv_id", "speaker", "part", "n_turns", F.array_join(F.col("pieces.piece"), "").alias("text"), "spans")


ORACLE = """
with rows as (
  select conv_id, coalesce(cast(floor(turn / 1024) as bigint), 0) as part, turn, coalesce(role, 'unknown') as role, coalesce(text, '') as said
  from conversations
), speakers as (
  select distinct conv_id, role as speaker from rows where role <> 'system'
), pieces as (
  select r.conv_id, s.speaker, r.part, r.turn, r.role, r.said,
         case when r.role = s.speaker then '<|im_start|>assistant' || chr(10)
              when r.role = 'system' then '<|im_start|>system' || chr(10)
              else '<|im_start|>user name=' || r.role || chr(10) end as head
  from rows r join speakers s on r.conv_id is not distinct from s.conv_id
), placed as (
  select *, head || said || '<|im_end|>' || chr(10) as piece,
         sum(length(head || said || '<|im_end|>' || chr(10))) over (
           partition by conv_id, speaker, part order by turn nulls first, role, said rows between unbounded preceding and current row) as stop
  from pieces
)
select conv_id, speaker, part, count(*) as n_turns, string_agg(piece, '' order by turn nulls first, role, said) as text,
       coalesce(string_agg(cast(stop - length(piece) + length(head) as bigint) || '-' || cast(stop - 1 as bigint), ',' order by turn nulls first, role, said)
         filter (role = speaker), '') as spans
from placed group by conv_id, speaker, part
"""
