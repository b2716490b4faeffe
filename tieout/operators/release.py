"""Versions of a table held as rows: a release log, and a manifest of which release holds a slice.

Data files carry the release that wrote them and are never rewritten. A slice is the unit that a
release replaces: a business date of a fact, a key bucket of a current-state table. The manifest
names every slice a release replaced, also one that became empty.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tieout import fixed_values as V
from tieout.operators import pointer

SLICE = ("table_name", "slice")


def publish(manifest: DataFrame, slices: DataFrame, valid_at: datetime | Column) -> DataFrame:
    """The manifest after releases went live. `slices` has (table_name, slice, release_id)."""
    return pointer.flip(manifest, slices, valid_at, SLICE, "release_id")


def wanted(manifest: DataFrame, table: str, release: int | Column | None = None) -> DataFrame:
    """Which release holds each slice: of the head, or of the table as it stood at a release."""
    mine = manifest.where(F.col("table_name") == table)
    if release is None:
        return mine.where(pointer.is_open()).select("slice", "release_id")
    at = release if isinstance(release, Column) else F.lit(release)
    return (
        mine.where(F.col("release_id") <= at)
        .groupBy("slice")
        .agg(F.max("release_id").alias("release_id"))
    )


def known_at(manifest: DataFrame, table: str, moment: datetime) -> DataFrame:
    mine = manifest.where((F.col("table_name") == table) & pointer.held_at(moment))
    return mine.select("slice", "release_id")


def read(
    rows: DataFrame,
    manifest: DataFrame,
    table: str,
    release: int | Column | None = None,
    between: tuple[str, str] | None = None,
) -> DataFrame:
    """Rows of the head, or of the table exactly as it stood at one release."""
    return of_slices(rows, wanted(manifest, table, release), between)


def read_known_at(
    rows: DataFrame,
    manifest: DataFrame,
    table: str,
    moment: datetime,
    between: tuple[str, str] | None = None,
) -> DataFrame:
    return of_slices(rows, known_at(manifest, table, moment), between)


def of_slices(
    rows: DataFrame, slices: DataFrame, between: tuple[str, str] | None = None
) -> DataFrame:
    """Rows of the named (slice, release_id) pairs.

    `between` bounds the slices with literals, first and last included: where rows are stored by
    slice, only those partitions are listed and read.
    """
    if between is not None:
        rows, slices = (f.where(F.col("slice").between(*between)) for f in (rows, slices))
    return rows.join(slices, ["slice", "release_id"], "left_semi")


def head(releases: DataFrame) -> DataFrame:
    """The newest published release of each table."""
    return (
        releases.where(F.col("state") == V.PUBLISHED)
        .groupBy("table_name")
        .agg(F.max("release_id").alias("release_id"))
    )


def publishable(candidates: DataFrame, heads: DataFrame) -> DataFrame:
    """Candidates built on the release that is still the head, at most one per table.

    A candidate whose parent is no longer the head would overwrite another writer's release.
    """
    now = heads.select("table_name", F.col("release_id").alias("head"))
    fresh = candidates.join(now, "table_name", "left").where(
        F.col("parent_release").eqNullSafe(F.col("head"))
    )
    first = F.min(F.struct("created_at", "release_id")).alias("first")
    return (
        fresh.groupBy("table_name", "parent_release")
        .agg(first)
        .select("table_name", F.col("first.release_id").alias("release_id"), "parent_release")
    )


def label(releases: DataFrame) -> DataFrame:
    """The positions a release was built from, one row per source."""
    return releases.select("table_name", "release_id", F.explode("label").alias("source", "at"))


def tag(tags: DataFrame, releases: DataFrame, name: str, tagged_at: datetime) -> DataFrame:
    """Name the published head of each table. A name that exists is never moved."""
    at = F.lit(tagged_at).cast("timestamp")
    new = head(releases).select(
        "table_name",
        F.lit(name).alias("tag"),
        "release_id",
        at.alias("tagged_at"),
        F.expr(f"tagged_at + make_ym_interval({V.MONTH_END_TAG_YEARS})").alias("keep_until"),
    )
    return tags.unionByName(new.join(tags, ["table_name", "tag"], "left_anti"))
