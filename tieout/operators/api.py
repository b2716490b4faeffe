"""Records pulled from an API, landed raw pull by pull."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pull_from(last_pull: datetime | None, lookback: timedelta) -> datetime | None:
    """Where the next pull starts: a lookback before the last one, for records shown late."""
    return None if last_pull is None else last_pull - lookback


def merge_pulls(landed: DataFrame, key: str = "record_id") -> DataFrame:
    """The latest copy of each record over overlapping pulls."""
    tie = F.xxhash64(*(F.col(c) for c in landed.columns))
    newest = F.max_by(F.struct(*landed.columns), F.struct("pull_id", tie))
    return landed.groupBy(key).agg(newest.alias("newest")).select("newest.*")


def sweep_gaps(merged: DataFrame, sweep: DataFrame, key: str = "record_id") -> DataFrame:
    """What a full sweep shows that the pulls missed, and what has vanished from the source."""
    ours, theirs = merged.select(key), sweep.select(key)
    missed = theirs.join(ours, key, "left_anti").withColumn("gap", F.lit("missed by the pulls"))
    vanished = ours.join(theirs, key, "left_anti").withColumn(
        "gap", F.lit("vanished from the source")
    )
    return missed.unionByName(vanished)
