"""Application events as a stream: one row per event, and fast signals from them.

`dedup` alone keeps its state in the engine, which drops what comes after the watermark without a
word. `settle_stream` keeps the watermark itself, so that every row that was sent is found again:
accepted, a duplicate, or an exception. Signals are scored from the events it accepted.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tieout.operators import events as batch_events
from tieout.operators import signals

PARTITIONS = ("batch", "event_date", "fate")


def dedup(events: DataFrame, delay: str = "1 hour", key: str = "event_id") -> DataFrame:
    """One row per event id among copies that arrive within the delay; state is bounded by it."""
    return events.withWatermark("event_ts", delay).dropDuplicatesWithinWatermark([key])


def score_stream(
    events: DataFrame, reference: DataFrame, delay: str = "1 hour", window: str = "1 hour"
) -> DataFrame:
    """Unverified signals per user and window, each sent once its window is over.

    `events` is a stream of complete facts; `reference` is a static frame, read again for each
    micro-batch, so an announced update takes effect with the next one.
    """
    return signals.score(dedup(events, delay), reference, window)


def settled_schema(events: T.StructType) -> T.StructType:
    """What `settle_stream` writes: the events with their fate, one row per event of a batch."""
    more = "reason string, copies bigint, batch bigint, event_date date, fate string"
    return T.StructType([*events.fields, *T.StructType.fromDDL(more).fields])


def settled(spark: SparkSession, path: str, events: T.StructType) -> DataFrame:
    """Every event settled so far, by the micro-batches that are done."""
    rows = spark.read.schema(settled_schema(events)).parquet(f"{path}/rows")
    done = spark.read.schema(_DONE).parquet(f"{path}/done")
    return rows.join(done.select("batch"), "batch", "left_semi").select(*rows.columns)


def accepted_stream(spark: SparkSession, path: str, events: T.StructType) -> DataFrame:
    """The accepted events as a stream, for `score_stream`; a batch that was written twice after a
    crash is taken once there, as it removes copies itself."""
    rows = spark.readStream.schema(settled_schema(events)).parquet(f"{path}/rows")
    return rows.where(F.col("fate") == batch_events.ACCEPTED).select(*events.names)


_DONE = "high bigint, batch bigint"


def settle_batch(
    batch: DataFrame,
    batch_id: int,
    path: str,
    delay: timedelta,
    closed_dates: Callable[[], DataFrame] | None = None,
    key: str = "event_id",
    time: str = "event_ts",
    arrival: tuple[str, ...] = ("position",),
) -> None:
    """One micro-batch settled and written under its number, then noted as done.

    An event is late if it lies `delay` behind the newest one of all batches before this. Only
    batches below this number are looked at, and everything is written over what an attempt that
    died left, so running a batch again gives the same rows. Earlier events are looked up only on
    the dates that the batch has.
    """
    spark = batch.sparkSession
    dated = batch.withColumn("event_date", F.to_date(time))
    found = dated.agg(
        F.unix_micros(F.max(time)).alias("high"), F.collect_set("event_date").alias("dates")
    ).first()
    done = spark.read.schema(_DONE).parquet(f"{path}/done").where(F.col("batch") < batch_id)
    high = done.agg(F.max("high")).first()[0]
    closed = None
    if high is not None:
        closed = F.timestamp_micros(F.lit(high - delay // timedelta(microseconds=1)))
    before = spark.read.schema(settled_schema(batch.schema)).parquet(f"{path}/rows").where(
        (F.col("batch") < batch_id) & F.col("event_date").isin(list(found["dates"]))
    ).where(F.col("fate") != batch_events.DUPLICATE)
    out = batch_events.settle(
        dated, before, closed, closed_dates() if closed_dates else None, key, time, arrival
    )
    out.write.mode("overwrite").partitionBy("event_date", "fate").parquet(
        f"{path}/rows/batch={batch_id}"
    )
    highs = [h for h in (high, found["high"]) if h is not None]
    newest = spark.createDataFrame([(max(highs, default=None),)], "high bigint")
    newest.coalesce(1).write.mode("overwrite").parquet(f"{path}/done/batch={batch_id}")


def settle_stream(
    events: DataFrame,
    path: str,
    checkpoint: str,
    delay: timedelta = timedelta(hours=1),
    closed_dates: Callable[[], DataFrame] | None = None,
    key: str = "event_id",
    time: str = "event_ts",
    arrival: tuple[str, ...] = ("position",),
    trigger: dict | None = None,
) -> StreamingQuery:
    """Settle a stream of events; `closed_dates` is asked again for every micro-batch."""
    spark = events.sparkSession
    nothing = spark.createDataFrame([], settled_schema(events.schema))
    nothing.write.mode("append").partitionBy(*PARTITIONS).parquet(f"{path}/rows")
    spark.createDataFrame([], _DONE).write.mode("append").partitionBy("batch").parquet(
        f"{path}/done"
    )

    def one(batch: DataFrame, batch_id: int) -> None:
        settle_batch(batch, batch_id, path, delay, closed_dates, key, time, arrival)

    return (
        events.writeStream.foreachBatch(one)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 minute"}))
        .start()
    )
