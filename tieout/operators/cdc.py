"""Current state of a table from its change stream, in the source's own order.

A batch is first folded to one row per key with plain aggregates, so a key that holds a third
of the batch is combined on the map side and never sits in one window. The folded batch is then
joined with the target, one row against one row.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tieout import fixed_values as V
from tieout.functions import newer, position
from tieout.model import MergeSpec

_POSITION = ("source_incarnation", "source_lsn")


def latest_per_key(changes: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """The newest change of each key. Equal positions are replays; a row hash breaks the tie."""
    newest = F.max_by(F.struct(*changes.columns), _order(changes))
    return changes.groupBy(*keys).agg(newest.alias("newest")).select("newest.*")


def is_newer(source_prefix: str = "s_", target_prefix: str = "t_") -> Column:
    """Whether the change applies to the row it meets."""
    return newer(position(source_prefix), position(target_prefix))


def unsupported_changes(changes: DataFrame) -> DataFrame:
    """Changes that must fail the batch, with the reason."""
    return changes.withColumn("problem", _problem()).where(F.col("problem").isNotNull())


def reject_unsupported(changes: DataFrame) -> DataFrame:
    """Fail as soon as any row of the batch is unsupported, also one that a newer row hides."""
    raised = F.raise_error(_problem()).cast("boolean")
    return changes.where(F.when(_problem().isNotNull(), raised).otherwise(F.lit(True)))


def fill_unchanged(changes: DataFrame, spec: MergeSpec) -> DataFrame:
    """Fold a batch to one row per key, keeping what is needed to fill unchanged large columns.

    `newest` is the last change. `deleted_at` is the position of the last delete. For each large
    column, `real_<column>` is the last value the source really sent (NULL included) and where.
    A real value before the last delete belongs to a row that is gone; the merge ignores it.
    """
    order = _order(changes)
    carried = ("op", "source_incarnation", "source_lsn", *spec.values)
    # The largest (position, tie, rest): a position written once makes narrower rows than max_by's.
    rest = [c for c in carried if c not in _POSITION]
    newest = F.max(F.struct(*_POSITION, _tie(changes).alias("tie"), *rest))
    real = [
        F.max_by(
            F.struct(F.col(c).alias("value"), position().alias("at")),
            F.when((F.col("op") != V.DELETE) & ~_is_unchanged(c), order),
        ).alias(f"real_{c}")
        for c in spec.large
    ]
    folded = changes.groupBy(*spec.keys).agg(
        newest.alias("newest"),
        F.max(F.when(F.col("op") == V.DELETE, position())).alias("deleted_at"),
        *real,
    )
    return folded.withColumn("newest", F.struct(*(F.col(f"newest.{c}") for c in carried)))


def apply_changes(
    target: DataFrame, changes: DataFrame, spec: MergeSpec, updated_at: datetime | None = None
) -> DataFrame:
    """The next state of the target. Replays and late arrivals change nothing.

    Equal to applying the changes one at a time in source order. A delete clears the values and
    keeps the key; a delete of an unknown key is stored; an unchanged large column keeps the
    last value the source sent since the row was last deleted.
    """
    return apply_folded(
        target, fill_unchanged(reject_unsupported(changes), spec), spec, updated_at
    )


def apply_folded(
    target: DataFrame, folded: DataFrame, spec: MergeSpec, updated_at: datetime | None = None
) -> DataFrame:
    """`apply_changes` for a batch that was folded before, one row per key on either side."""
    instant = F.current_timestamp() if updated_at is None else F.lit(updated_at)
    current = target.withColumn("at", position()).alias("t")
    both = current.join(folded.alias("s"), list(spec.keys), "full_outer")

    new_at = F.struct("s.newest.source_incarnation", "s.newest.source_lsn")
    applies = F.col("s.newest").isNotNull() & _since_target(new_at)
    cleared = F.col("s.newest.op") == V.DELETE

    def column(name: str) -> Column:
        incoming = _large_value(name) if name in spec.large else F.col(f"s.newest.{name}")
        value = F.when(~cleared, incoming)
        return F.when(applies, value).otherwise(F.col(f"t.{name}")).alias(name)

    return both.select(
        *spec.keys,
        *(column(c) for c in spec.values),
        *(
            F.when(applies, F.col(f"s.newest.{c}")).otherwise(F.col(f"t.{c}")).alias(c)
            for c in ("source_incarnation", "source_lsn")
        ),
        F.when(applies, cleared).otherwise(F.col("t.is_deleted")).alias("is_deleted"),
        F.when(applies, instant).otherwise(F.col("t.updated_at")).alias("updated_at"),
    )


def empty_target(like: DataFrame, spec: MergeSpec) -> DataFrame:
    """A target without rows, typed like the changes that will be merged into it."""
    return like.limit(0).select(
        *spec.keys,
        *spec.values,
        F.col("source_incarnation").cast("int"),
        F.col("source_lsn").cast("bigint"),
        F.lit(False).alias("is_deleted"),
        F.lit(None).cast("timestamp").alias("updated_at"),
    )


def live_rows(target: DataFrame) -> DataFrame:
    return target.where(~F.col("is_deleted"))


def bucketed(rows: DataFrame, spec: MergeSpec) -> DataFrame:
    """Adds `bucket`, the part of the table that a row's key is stored in."""
    hashed = F.xxhash64(*(F.col(k) for k in spec.keys))
    return rows.withColumn("bucket", F.pmod(hashed, F.lit(spec.buckets)).cast("int"))


def lineage(target: DataFrame, spec: MergeSpec) -> DataFrame:
    """Where each row came from: the position that wrote it, and whether that was a delete."""
    return target.select(*spec.keys, "source_incarnation", "source_lsn", "is_deleted", "updated_at")


def base_load(export: DataFrame, slot_position: int, incarnation: int) -> DataFrame:
    """Exported rows as snapshot reads at the position where the change stream will start.

    Zero would lose every conflict for good, so it is refused.
    """
    if slot_position <= 0:
        raise ValueError("tag an export with the slot's real starting position, never zero")
    return export.withColumns(
        {
            "op": F.lit(V.SNAPSHOT_READ),
            "source_incarnation": F.lit(incarnation).cast("int"),
            "source_lsn": F.lit(slot_position).cast("bigint"),
        }
    )


def sweep(
    target: DataFrame,
    spec: MergeSpec,
    incarnation: int,
    slot_position: int,
    updated_at: datetime | None = None,
) -> DataFrame:
    """Tombstone the rows that a finished re-snapshot did not contain.

    Every row of an older incarnation, also one deleted before, takes the new incarnation's
    starting position, so that no leftover change of an older incarnation can revive it.
    """
    instant = F.current_timestamp() if updated_at is None else F.lit(updated_at)
    older = F.col("source_incarnation") < incarnation
    gone = older & ~F.col("is_deleted")
    return target.withColumns(
        {
            **{c: F.when(~gone, F.col(c)) for c in spec.values},
            "updated_at": F.when(gone, instant).otherwise(F.col("updated_at")),
            "is_deleted": F.col("is_deleted") | gone,
            "source_lsn": F.when(older, F.lit(slot_position).cast("bigint")).otherwise(
                F.col("source_lsn")
            ),
            "source_incarnation": F.when(older, F.lit(incarnation).cast("int")).otherwise(
                F.col("source_incarnation")
            ),
        }
    )


def _order(changes: DataFrame) -> Column:
    return F.struct(*_POSITION, _tie(changes).alias("tie"))


def _tie(changes: DataFrame) -> Column:
    return F.xxhash64(*(F.col(c) for c in sorted(changes.columns)))


def _problem() -> Column:
    unknown = ~F.coalesce(F.col("op").isin(*V.OPERATIONS), F.lit(False))
    unplaced = F.col("source_incarnation").isNull() | F.col("source_lsn").isNull()
    operation = F.concat(
        F.lit("unsupported change operation: "), F.coalesce(F.col("op"), F.lit("none"))
    )
    return F.when(unknown, operation).when(unplaced, F.lit("change without a source position"))


def _is_unchanged(column: str) -> Column:
    return F.col(column).eqNullSafe(V.UNCHANGED)


def _since_target(at: Column) -> Column:
    """Newer than the target row, or no target row."""
    return F.col("t.at").isNull() | newer(at, F.col("t.at"))


def _large_value(column: str) -> Column:
    real_at = F.col(f"s.real_{column}.at")
    deleted_at = F.col("s.deleted_at")
    usable = (
        real_at.isNotNull()
        & _since_target(real_at)
        & (deleted_at.isNull() | newer(real_at, deleted_at))
    )
    emptied = deleted_at.isNotNull() & _since_target(deleted_at)
    return (
        F.when(usable, F.col(f"s.real_{column}.value"))
        .when(emptied, F.lit(None))
        .otherwise(F.col(f"t.{column}"))
    )
