"""The change stream: envelopes to bronze, and bronze into current state, continuously."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tieout.model import MANIFEST, MergeSpec
from tieout.operators import bronze, cdc
from tieout.plans import merge


def land(
    envelopes: DataFrame,
    row: T.StructType,
    incarnation: int,
    tables: Sequence[str],
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Append flattened changes to bronze, split by the captured table and ingest hour.

    Folders are named by `tables` alone, never by what a record says: a record of another table,
    and one that did not parse and so has none, lands in `unrouted` with its own fields.
    """
    flat = bronze.route(bronze.flatten_changes(envelopes, row, incarnation), tables)
    return (
        bronze.with_ingest_hour(flat)
        .writeStream.format("parquet")
        .partitionBy("routed_to", "ingest_hour")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 minute"}))
        .start()
    )


def merge_stream(
    changes: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Append checked changes to one plain output, each exactly once.

    Nothing is rewritten while changes arrive: `merged` folds them when the state is read, or
    when a batch job writes the state anew with `plans.merge.merge_batch`. An unsupported change
    stops the stream before its micro-batch becomes visible.
    """
    return (
        cdc.reject_unsupported(changes)
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 minute"}))
        .start()
    )


def merged(
    appended: DataFrame, spec: MergeSpec, now: datetime, state: DataFrame | None = None
) -> DataFrame:
    """The state with everything the stream appended since it was written."""
    before = cdc.empty_target(appended, spec) if state is None else state
    return cdc.apply_changes(before, appended, spec, now)


# ---- the state itself, merged batch by batch


def merge_state_batch(
    batch: DataFrame, batch_id: int, spec: MergeSpec, path: str, now: datetime | None = None
) -> None:
    """One micro-batch merged into the key buckets it touches.

    Its buckets are written as the release of this number, over whatever an attempt that died
    left there. The manifest, one row per bucket, is written last and makes them readable. Only
    releases below this number are merged into, so running a batch again gives the same state.
    """
    spark = batch.sparkSession
    manifest = _manifest(spark, path, batch_id)
    stored = _stored(spark, path, cdc.empty_target(batch, spec).schema)
    merged = merge.merge_buckets(stored, manifest, spec, batch, batch_id, now)
    rows = merged.rows.drop("release_id")
    rows.write.mode("overwrite").partitionBy("slice").parquet(f"{path}/rows/release_id={batch_id}")
    merged.manifest.coalesce(1).write.mode("overwrite").parquet(
        f"{path}/manifest/batch={batch_id}"
    )


def merge_state_stream(
    changes: DataFrame,
    spec: MergeSpec,
    path: str,
    checkpoint: str,
    now: datetime | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Merge a change stream into current state, each micro-batch once however often it runs.

    A batch reads and writes only the buckets of its keys. `state` reads each bucket from the one
    release that holds it, so what a read costs does not grow with the batches before it. An
    unsupported change stops the stream before its micro-batch becomes visible.
    """
    spark = changes.sparkSession
    state = cdc.empty_target(spark.createDataFrame([], changes.schema), spec).schema
    nothing = spark.createDataFrame([], _stored_schema(state))
    nothing.write.mode("append").partitionBy("release_id", "slice").parquet(f"{path}/rows")
    spark.createDataFrame([], _BATCHES).write.mode("append").partitionBy("batch").parquet(
        f"{path}/manifest"
    )

    def one(batch: DataFrame, batch_id: int) -> None:
        merge_state_batch(batch, batch_id, spec, path, now)

    return (
        changes.writeStream.foreachBatch(one)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 minute"}))
        .start()
    )


def state(spark: SparkSession, changes: T.StructType, spec: MergeSpec, path: str) -> DataFrame:
    """The table as it is after the last finished micro-batch."""
    like = cdc.empty_target(spark.createDataFrame([], changes), spec).schema
    held = merge.held_buckets(_manifest(spark, path), spec)
    return merge.of_buckets(_stored(spark, path, like), held).select(*like.names)


_BATCHES = f"{MANIFEST}, batch bigint"


def _stored_schema(state: T.StructType) -> T.StructType:
    return T.StructType(
        [*state.fields, *T.StructType.fromDDL("release_id bigint, slice string").fields]
    )


def _stored(spark: SparkSession, path: str, state: T.StructType) -> DataFrame:
    return spark.read.schema(_stored_schema(state)).parquet(f"{path}/rows")


def _manifest(spark: SparkSession, path: str, below: int | None = None) -> DataFrame:
    """The manifest that the last finished batch wrote, or the last one below a number."""
    all_of_them = spark.read.schema(_BATCHES).parquet(f"{path}/manifest")
    if below is not None:
        all_of_them = all_of_them.where(F.col("batch") < below)
    last = all_of_them.agg(F.max("batch")).first()[0]
    newest = all_of_them.where(F.col("batch") == F.lit(-1 if last is None else last))
    return newest.drop("batch")
