"""Application events: one row per event, checked, and never merged into a closed date."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tieout.operators.bronze import UNPARSED, land_flagged


def dedup(events: DataFrame, arrival: Sequence[str], key: str = "event_id") -> DataFrame:
    """The first arrival of each event. Copies combine on the map side before the shuffle."""
    first = F.min_by(F.struct(*events.columns), F.struct(*arrival))
    return events.groupBy(key).agg(first.alias("first")).select("first.*")


def late_exceptions(
    events: DataFrame, closed_dates: DataFrame, day: str | Column
) -> tuple[DataFrame, DataFrame]:
    """(accepted, exceptions): events of a date that is closed are recorded, not merged."""
    dated = events.withColumn("event_date", day if isinstance(day, Column) else F.col(day))
    closed = closed_dates.select(F.col("business_date").alias("event_date"))
    return (
        dated.join(closed, "event_date", "left_anti"),
        dated.join(closed, "event_date", "left_semi").withColumn(
            "exception", F.lit("late for a closed date")
        ),
    )


#: What becomes of an event that arrives: it counts, it was here before, or it is recorded.
ACCEPTED, DUPLICATE, EXCEPTION = "accepted", "duplicate", "exception"


def settle(
    batch: DataFrame,
    seen: DataFrame,
    closed_before: datetime | Column | None = None,
    closed_dates: DataFrame | None = None,
    key: str = "event_id",
    time: str = "event_ts",
    arrival: Sequence[str] = ("position",),
) -> DataFrame:
    """One row per event of a batch of arrivals: its first copy, `fate`, `reason` and `copies`.

    `seen` has (event_date, key) of what was settled before; `batch` carries `event_date`. An event
    that was seen is a duplicate, whenever it comes. One before `closed_before`, or of one of the
    `closed_dates`, is an exception, as is each row without a key or a time. The rest is accepted.
    Nothing is lost: `copies` sums up to the rows of the batch. Copies are folded before the
    shuffle, so an event that holds a third of the batch sends one row per task. Copies carry the
    same time; an event sent with times of two dates is two events.
    """
    content = F.struct(*batch.columns)
    unknown = F.col(key).isNull() | F.col(time).isNull()
    once = (
        batch.where(~unknown)
        .groupBy(key, "event_date")
        .agg(
            F.min_by(content, F.struct(*arrival)).alias("first"),
            F.count(F.lit(1)).alias("copies"),
        )
        .select("first.*", "copies")
    )
    before = seen.select("event_date", key).distinct().withColumn("known", F.lit(True))
    met = once.join(before, ["event_date", key], "left")
    late = F.lit(False) if closed_before is None else F.col(time) < _instant(closed_before)
    if closed_dates is not None:
        closed = closed_dates.select(F.col("business_date").alias("event_date")).distinct()
        met = met.join(closed.withColumn("closed", F.lit(True)), "event_date", "left")
        reason = F.when(F.col("closed"), "late for a closed date").when(late, "late for its window")
    else:
        reason = F.when(late, "late for its window")
    known = F.coalesce("known", F.lit(False))
    settled = met.withColumn("reason", F.when(~known, reason)).withColumn(
        "fate",
        F.when(known, DUPLICATE).when(F.col("reason").isNotNull(), EXCEPTION).otherwise(ACCEPTED),
    )
    columns = [*batch.columns, "fate", "reason", "copies"]
    nameless = batch.where(unknown).withColumns(
        {
            "fate": F.lit(EXCEPTION),
            "reason": F.lit("without an event id or time"),
            "copies": F.lit(1).cast("bigint"),
        }
    )
    return settled.select(*columns).unionByName(nameless.select(*columns))


def _instant(at: datetime | Column) -> Column:
    return at if isinstance(at, Column) else F.lit(at)


def validate(
    raw: DataFrame, schema: T.StructType, required: Sequence[str], text: str = "value"
) -> DataFrame:
    """Parsed events with an id and their problems.

    An event without an id gets one from its own fields, so a replay gets the same id.
    """
    parsed = land_flagged(raw, schema, text)
    fields = [F.coalesce(F.col(f.name).cast("string"), F.lit("\\N")) for f in schema.fields]
    own = F.sha2(F.concat_ws("|", *fields, F.col(UNPARSED)), 256)
    problems = F.array_compact(
        F.array(
            F.when(F.col(UNPARSED).isNotNull(), "not valid JSON for its schema"),
            *(F.when(F.col(c).isNull(), F.lit(f"{c} is missing")) for c in required),
        )
    )
    return parsed.withColumns(
        {
            "event_key": F.coalesce(F.col("event_id").cast("string"), own),
            "problems": F.array_join(problems, "; "),
        }
    )
