"""Merging a batch of changes into current state.

Both forms return frames; where they are stored is the caller's business.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tieout.durable import materialise
from tieout.model import MANIFEST, MergeSpec
from tieout.operators import cdc, release


def target_schema(changes: DataFrame, spec: MergeSpec) -> T.StructType:
    return cdc.empty_target(changes, spec).schema


def folded(changes: DataFrame, spec: MergeSpec) -> DataFrame:
    """The batch as one kept row per key. An unsupported change fails here, before any merge."""
    return materialise(cdc.fill_unchanged(cdc.reject_unsupported(changes), spec))


def merge_batch(
    target: DataFrame, spec: MergeSpec, changes: DataFrame, now: datetime
) -> DataFrame:
    """The whole next state, for a target that is written anew.

    The batch is folded on its way into the join, so that its keys are dealt out once; it is
    looked through for unsupported changes before.
    """
    refuse_unsupported(changes)
    return cdc.apply_changes(target, changes, spec, now)


def refuse_unsupported(changes: DataFrame) -> None:
    """Fail before any merge if there is a change that must fail the batch."""
    cdc.reject_unsupported(changes).agg(F.count(F.lit(1))).first()


def upserts(target: DataFrame, spec: MergeSpec, changes: DataFrame, now: datetime) -> DataFrame:
    """Only the rows of the batch's keys, as they are afterwards: what a MERGE by key writes.

    The target is read through the batch's keys, so its other rows are never shuffled when the
    batch is small, and a large table is not rewritten for a few changes. A target that is stored
    by `bucket` (see `cdc.bucketed`) is read only where the batch's keys can be.
    """
    batch = folded(changes, spec)
    if "bucket" in target.columns:
        hit = touched_buckets(batch, spec)
        return bucketed_upserts(target.where(F.col("bucket").isin(hit)), spec, batch, now)
    touched = target.join(batch.select(*spec.keys), list(spec.keys), "left_semi")
    return cdc.apply_folded(touched.select(*target.columns), batch, spec, now)


def bucketed_upserts(
    target: DataFrame, spec: MergeSpec, batch: DataFrame, now: datetime | None
) -> DataFrame:
    """`upserts` of a folded batch into the buckets it touches, with the bucket of each row."""
    keys = [*spec.keys, "bucket"]
    placed = cdc.bucketed(batch, spec)
    touched = target.join(placed.select(*keys), keys, "left_semi")
    return cdc.bucketed(cdc.apply_folded(touched.select(*spec.columns), batch, spec, now), spec)


def touched_buckets(batch: DataFrame, spec: MergeSpec) -> list[int]:
    """Which buckets a batch has keys in; at most `spec.buckets` numbers."""
    found = cdc.bucketed(batch.select(*spec.keys), spec).select("bucket").distinct().collect()
    return sorted(r["bucket"] for r in found)


@dataclass(frozen=True)
class Merged:
    rows: DataFrame  # the touched buckets whole, with `release_id` and `slice`
    manifest: DataFrame  # which release holds each bucket now


def held_buckets(manifest: DataFrame, spec: MergeSpec) -> dict[str, int]:
    """The release that holds each bucket; at most `spec.buckets` pairs."""
    held = release.wanted(manifest, spec.name).collect()
    return {r["slice"]: r["release_id"] for r in held}


def of_buckets(stored: DataFrame, held: dict[str, int]) -> DataFrame:
    """Rows of the named buckets, chosen by literals of the partition columns alone."""
    releases: dict[int, list[str]] = {}
    for bucket, release_id in held.items():
        releases.setdefault(release_id, []).append(bucket)
    chosen = F.lit(False)
    for release_id, buckets in sorted(releases.items()):
        chosen |= (F.col("release_id") == release_id) & F.col("slice").isin(sorted(buckets))
    return stored.where(chosen)


def merge_buckets(
    stored: DataFrame,
    manifest: DataFrame,
    spec: MergeSpec,
    changes: DataFrame,
    release_id: int,
    now: datetime | None = None,
) -> Merged:
    """The buckets that a batch touches as they are afterwards, as a release of their own.

    `stored` holds the rows of all releases by (release_id, slice); `manifest` says which of them
    is the state the batch meets. Buckets without a key of the batch are neither read nor written.
    """
    batch = folded(changes, spec)
    hit = set(map(str, touched_buckets(batch, spec)))
    held = {b: r for b, r in held_buckets(manifest, spec).items() if b in hit}
    before = of_buckets(stored, held).select(*spec.columns)
    after = cdc.bucketed(cdc.apply_folded(before, batch, spec, now), spec)
    rows = after.withColumns(
        {"release_id": F.lit(release_id).cast("bigint"), "slice": F.col("bucket").cast("string")}
    ).drop("bucket")
    spark = stored.sparkSession
    moved = spark.createDataFrame(
        [(spec.name, b, release_id) for b in sorted(hit)],
        "table_name string, slice string, release_id bigint",
    )
    at = F.current_timestamp() if now is None else F.lit(now).cast("timestamp")
    kept = manifest.where((F.col("table_name") != spec.name) | ~F.col("slice").isin(sorted(hit)))
    opened = moved.withColumns({"valid_from": at, "valid_to": F.lit(None).cast("timestamp")})
    names = T.StructType.fromDDL(MANIFEST).names
    return Merged(rows, kept.select(*names).unionByName(opened.select(*names)))
