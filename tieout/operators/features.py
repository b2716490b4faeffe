"""Point-in-time features: what was known about an entity just before a moment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tieout.durable import materialise


def as_of(
    moments: DataFrame,
    observations: DataFrame,
    entity: str,
    at: str,
    values: Sequence[str],
    block: str | int = "hour",
    strictly_before: bool = True,
) -> DataFrame:
    """Each moment with the last observation of its entity before it (or at it).

    An entity's history is cut into blocks, so one that holds a third of all rows is spread over
    as many tasks as it has blocks. Each block starts with the last observation of the blocks
    before it, found from one row per (entity, block).

    `block` names a unit of time; that needs no sort of the whole, but an entity's rows of one
    unit share a task. A number cuts all rows, in order of entity and time, into that many ranges
    of about equal size instead, written once: also an entity whose rows all lie in one hour, or
    at one instant, spreads over the ranges that it fills.
    """
    last = "_last"
    seen = observations.select(
        entity, at, F.struct(F.col(at).alias("observed_at"), *values).alias(last)
    )
    asked = moments.withColumn("_moment", F.struct(*moments.columns))
    if isinstance(block, str):
        seen, asked = (f.withColumn("_block", F.date_trunc(block, at)) for f in (seen, asked))
    else:
        seen, asked = _in_ranges(seen, asked, entity, at, last, block, strictly_before)

    ends = seen.groupBy(entity, "_block").agg(F.max(last).alias(last))
    wanted = asked.select(entity, "_block").distinct()
    per_block = ends.join(wanted, [entity, "_block"], "full_outer")
    before = Window.partitionBy(entity).orderBy("_block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    carried = per_block.withColumn("_carry", F.last(last, ignorenulls=True).over(before)).where(
        F.col("_carry").isNotNull()
    )

    rank = _ranks(strictly_before)
    rows = (
        seen.withColumn("_rank", F.lit(rank["seen"]))
        .unionByName(
            carried.select(
                entity,
                "_block",
                F.lit(None).cast(seen.schema[at].dataType).alias(at),
                F.col("_carry").alias(last),
                F.lit(rank["carry"]).alias("_rank"),
            )
        )
        .unionByName(
            asked.select(entity, "_block", at, "_moment", F.lit(rank["asked"]).alias("_rank")),
            allowMissingColumns=True,
        )
    )
    # What is carried in has no time of its own and comes first.
    within = Window.partitionBy(entity, "_block").orderBy(F.asc_nulls_first(at), "_rank", last)
    known = F.last(last, ignorenulls=True).over(
        within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        rows.withColumn("_known", known)
        .where(F.col("_moment").isNotNull())
        .select(
            "_moment.*",
            F.col("_known.observed_at").alias("observed_at"),
            *(F.col(f"_known.{v}").alias(v) for v in values),
        )
    )


def _ranks(strictly_before: bool) -> dict[str, int]:
    """Ties at one instant: an observation counts for a moment at the same instant unless only
    strictly earlier ones do."""
    return {"carry": -1, "seen": 1 if strictly_before else 0, "asked": 0 if strictly_before else 1}


def _in_ranges(
    seen: DataFrame,
    asked: DataFrame,
    entity: str,
    at: str,
    last: str,
    ranges: int,
    strictly_before: bool,
) -> tuple[DataFrame, DataFrame]:
    """Both frames with `_block`, the range of (entity, time, tie) that a row lies in."""
    rank = _ranks(strictly_before)
    both = seen.withColumn("_rank", F.lit(rank["seen"])).unionByName(
        asked.select(entity, at, "_moment").withColumn("_rank", F.lit(rank["asked"])),
        allowMissingColumns=True,
    )
    # The hash parts rows that nothing else tells apart, so no range has to hold them all.
    tie = F.xxhash64(last, "_moment", F.monotonically_increasing_id())
    dealt = both.withColumn("_tie", tie).repartitionByRange(
        ranges, entity, at, "_rank", last, "_tie"
    )
    placed = materialise(dealt.withColumn("_block", F.spark_partition_id()).drop("_rank", "_tie"))
    is_asked = F.col("_moment").isNotNull()
    return (
        placed.where(~is_asked).drop("_moment"),
        placed.where(is_asked).drop(last).select("_moment.*", "_moment", "_block"),
    )
