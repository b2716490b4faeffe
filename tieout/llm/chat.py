"""Chat formatting by perspective rotation, in DataFrame functions alone.

Every participant of a dialogue is once the assistant; the others are users with a name. Only what
the assistant says is learnt: masks name its character ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Turns of one rendered row, so that a dialogue of any length never has to fit in one.
CHUNK_TURNS = 1_024
SYSTEM = "system"
#: Characters that a name shows as % and their code.
NAME_ESCAPES = {"%": "%25", "|": "%7C", "<": "%3C", "\n": "%0A"}


def escaped_text(text: Column) -> Column:
    """No text reads as a marker: each `<|` becomes `<||`, which turns back without loss."""
    return F.replace(text, F.lit("<|"), F.lit("<||"))


def escaped_name(name: Column) -> Column:
    for char, code in NAME_ESCAPES.items():  # the % itself first
        name = F.replace(name, F.lit(char), F.lit(code))
    return name


def perspectives(
    conversations: DataFrame,
    chunk_turns: int = CHUNK_TURNS,
    conv_column: str = "conv_id",
    turn_column: str = "turn",
    role_column: str = "role",
    text_column: str = "text",
) -> DataFrame:
    """(conv_id, perspective, chunk, first_turn, n_turns, text, mask): a rendering per participant.

    A turn is `<|assistant|>`, `<|user name=...|>` or `<|system|>`, a line end, its text,
    `<|end|>` and a line end; names and texts are escaped, so neither can forge a marker. `mask`
    lists the ranges to learn, `start-end` in characters from 0, end excluded, joined by commas:
    the assistant's texts with their `<|end|>`; it is empty where there are none. A system turn is
    shown to all and is nobody's perspective.

    A dialogue of up to `chunk_turns` turns is one row, whatever its turns are numbered; a longer
    one is cut by place into rows of so many turns, which follow each other by `chunk`, and
    `first_turn` is the place of a row's first turn, from 0. A null conv_id is a dialogue of its
    own, a null role is a participant without a name (`<|user|>`, perspective null), a null text is
    empty, and a null turn comes before all others. Turns of equal number go by role, null first,
    then text; repeated rows are repeated turns. A dialogue of system turns alone has no rows; an
    empty table gives an empty table.
    """
    rows = conversations.select(
        F.col(conv_column).alias("conv_id"),
        F.col(turn_column).cast("bigint").alias("turn"),
        F.col(role_column).alias("role"),
        F.coalesce(text_column, F.lit("")).alias("text"),
    )
    # Places are counted within blocks of turn numbers, after all turns of the blocks before, so
    # that a long dialogue is never sorted as a whole.
    rows = rows.withColumn("block", F.floor(F.col("turn") / chunk_turns).cast("bigint"))
    blocks = rows.groupBy("conv_id", "block").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    blocks = blocks.select(
        F.col("conv_id").alias("_conv"), F.col("block").alias("_block"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
    )
    order = Window.partitionBy("conv_id", "block").orderBy("turn", "role", "text")
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & F.col("block").eqNullSafe(F.col("_block"))
    turns = (
        rows.withColumn("in_block", F.row_number().over(order))
        .join(blocks, same)
        .withColumn("place", F.col("before") + F.col("in_block") - 1)
        .withColumn("chunk", F.floor(F.col("place") / chunk_turns).cast("bigint"))
        .select("conv_id", "chunk", "place", "role", "text")
    )
    speakers = (
        rows.where(F.coalesce(F.col("role") != SYSTEM, F.lit(True)))
        .select(F.col("conv_id").alias("of"), F.col("role").alias("perspective"))
        .distinct()
    )
    seen = turns.join(speakers, F.col("conv_id").eqNullSafe(F.col("of"))).drop("of")
    own = F.col("role").eqNullSafe(F.col("perspective"))
    head = (
        F.when(own, F.lit("<|assistant|>"))
        .when(F.col("role") == SYSTEM, F.lit("<|system|>"))
        .when(F.col("role").isNull(), F.lit("<|user|>"))
        .otherwise(F.concat(F.lit("<|user name="), escaped_name(F.col("role")), F.lit("|>")))
    )
    head = F.concat(head, F.lit("\n"))
    text = escaped_text(F.col("text")).alias("text")
    said = F.struct("place", head.alias("head"), text, own.alias("own"))
    grouped = seen.groupBy("conv_id", "perspective", "chunk").agg(
        F.array_sort(F.collect_list(said)).alias("turns")
    )
    end = "<|end|>"
    whole = F.concat_ws(
        "", F.transform("turns", lambda t: F.concat(t["head"], t["text"], F.lit(end + "\n")))
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("ranges"))

    def walk(state, t):
        first = state["at"] + F.length(t["head"])
        last = first + F.length(t["text"]) + len(end)
        ranges = F.when(
            t["own"], F.concat(state["ranges"], F.array(F.concat(first, F.lit("-"), last)))
        ).otherwise(state["ranges"])
        return F.struct((last + 1).alias("at"), ranges.alias("ranges"))

    mask = F.aggregate("turns", start, walk, lambda s: F.concat_ws(",", s["ranges"]))
    return grouped.select(
        "conv_id", "perspective", "chunk",
        (F.col("chunk") * chunk_turns).alias("first_turn"),
        F.size("turns").cast("bigint").alias("n_turns"), whole.alias("text"), mask.alias("mask"),
    )


PERSPECTIVES_SQL = """
WITH t AS (
  SELECT conv_id, role, replace(coalesce(text, ''), '<|', '<||') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST,
                            coalesce(text, '')) - 1 AS place
  FROM conversations),
s AS (
  SELECT DISTINCT conv_id, role AS perspective FROM conversations
  WHERE role IS DISTINCT FROM 'system'),
r AS (
  SELECT t.conv_id, perspective, place // 1024 AS chunk, place,
         role IS NOT DISTINCT FROM perspective AS own, text,
         CASE WHEN role IS NOT DISTINCT FROM perspective THEN '<|assistant|>'
              WHEN role = 'system' THEN '<|system|>' WHEN role IS NULL THEN '<|user|>'
              ELSE '<|user name=' || replace(replace(replace(replace(
                role, '%', '%25'), '|', '%7C'), '<', '%3C'), chr(10), '%0A') || '|>' END
           || chr(10) AS head
  FROM t JOIN s ON t.conv_id IS NOT DISTINCT FROM s.conv_id),
o AS (
  SELECT *, length(head) + length(text) + 8 AS size,
         CAST(sum(length(head) + length(text) + 8) OVER (
           PARTITION BY conv_id, perspective, chunk ORDER BY place) AS BIGINT) AS until
  FROM r)
SELECT conv_id, perspective, chunk, chunk * 1024 AS first_turn, count(*) AS n_turns,
       string_agg(head || text || '<|end|>' || chr(10), '' ORDER BY place) AS text,
       coalesce(string_agg((until - size + length(head)) || '-' || (until - 1), ',' ORDER BY place)
                FILTER (WHERE own), '') AS mask
FROM o GROUP BY conv_id, perspective, chunk
"""
