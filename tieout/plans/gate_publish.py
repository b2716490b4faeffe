"""Building a candidate nobody can read yet, then publishing or holding it.

A candidate's rows are stored under its release; the manifest alone decides what readers see.
Every job takes the control frames and returns the next ones. One writer per table is assumed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tieout import fixed_values as V
from tieout.durable import materialise
from tieout.model import RELEASES
from tieout.operators import gate, release


class HeadMoved(RuntimeError):
    """Another release went live after this candidate was built; it must be built again."""


@dataclass(frozen=True)
class Candidate:
    release_id: int
    rows: DataFrame  # under (slice, release_id)
    releases: DataFrame


@dataclass(frozen=True)
class GateResult:
    published: bool
    reasons: DataFrame  # one column, `reason`; no rows when published
    releases: DataFrame
    manifest: DataFrame


def head_of(releases: DataFrame, table: str) -> int | None:
    row = release.head(releases).where(F.col("table_name") == table).first()
    return None if row is None else row["release_id"]


def build_candidate(
    releases: DataFrame,
    table: str,
    rows: DataFrame,
    dates: Sequence[date],
    label: dict[str, str],
    now: datetime,
) -> Candidate:
    """The rows of the window under a new release. Readers keep the published ones.

    The release lists every date of the window, so a date without rows becomes empty when it
    goes live.
    """
    mine = releases.where(F.col("table_name") == table)
    release_id = (mine.agg(F.max("release_id")).first()[0] or 0) + 1
    built = gate.in_window(rows, dates).withColumns(
        {"slice": F.col("business_date").cast("string"), "release_id": F.lit(release_id).cast("bigint")}
    )
    slices = sorted(str(d) for d in dates)
    row = (
        table, release_id, head_of(releases, table), slices, label, V.CANDIDATE, "", now, None, False
    )
    logged = releases.unionByName(releases.sparkSession.createDataFrame([row], RELEASES))
    return Candidate(release_id, built, logged)


def publish_or_hold(
    releases: DataFrame,
    manifest: DataFrame,
    table: str,
    release_id: int,
    built: DataFrame,
    keys: Sequence[str],
    inputs: DataFrame,
    reference: DataFrame,
    now: datetime,
) -> GateResult:
    """Publish the candidate if its inputs are complete and it ties to the pinned reference."""
    this = (F.col("table_name") == table) & (F.col("release_id") == release_id)
    mine = releases.where(this).first()
    dates = [date.fromisoformat(s) for s in mine["slices"]]
    # Incomplete inputs come alone, without the costly comparison.
    reasons = materialise(gate.reasons(built, gate.in_window(reference, dates), inputs, keys))
    if not reasons.isEmpty():
        return GateResult(False, reasons, _moved(releases, this, V.HELD, None), manifest)
    if head_of(releases, table) != mine["parent_release"]:
        raise HeadMoved(f"{table}: release {release_id} was built on {mine['parent_release']}")
    pointed = releases.where(this).select(
        "table_name", F.explode("slices").alias("slice"), "release_id"
    )
    return GateResult(
        True,
        reasons,
        _moved(releases, this, V.PUBLISHED, now),
        release.publish(manifest, pointed, now),
    )


def reconcile(
    rows: DataFrame,
    releases: DataFrame,
    manifest: DataFrame,
    table: str,
    keys: Sequence[str],
    control_totals: DataFrame,
    closed_dates: DataFrame,
) -> tuple[DataFrame, DataFrame]:
    """Tie the live rows of closed dates to the sources' own totals: (status per cell, releases).

    A release is marked reconciled once every date it still holds is closed and ties.
    """
    slices = release.wanted(manifest, table)
    live = release.of_slices(rows, slices)
    status = materialise(
        gate.reconcile_closed(gate.cell_totals(live, keys), control_totals, closed_dates)
    )
    closed = closed_dates.select(F.col("business_date").cast("string").alias("slice"))
    open_slices = slices.join(closed, "slice", "left_anti").select("release_id")
    untied = status.where(F.col("status") != "reconciled").select(
        F.col("business_date").cast("string").alias("slice")
    )
    untied_slices = slices.join(untied, "slice", "left_semi").select("release_id")
    done = (
        slices.select("release_id")
        .distinct()
        .join(open_slices.unionByName(untied_slices), "release_id", "left_anti")
        .withColumn("tied", F.lit(True))
    )
    marked = F.coalesce((F.col("table_name") == table) & F.col("tied"), F.lit(False))
    log = releases.join(done, "release_id", "left")
    log = log.withColumn("reconciled", F.col("reconciled") | marked)
    return status, log.select(*releases.columns)


def tag_month_end(
    tags: DataFrame, releases: DataFrame, table: str, month_end: date, now: datetime
) -> DataFrame:
    """Name the published release of a month; corrections never change it."""
    mine = releases.where(F.col("table_name") == table)
    return release.tag(tags, mine, f"month_end_{month_end:%Y_%m}", now)


def _moved(releases: DataFrame, this, state: str, at: datetime | None) -> DataFrame:
    published_at = F.when(this, F.lit(at).cast("timestamp")).otherwise(F.col("published_at"))
    return releases.withColumns(
        {
            "state": F.when(this, F.lit(state)).otherwise(F.col("state")),
            "published_at": published_at,
        }
    )
