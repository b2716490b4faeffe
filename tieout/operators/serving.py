"""Copies and answers that always say which published version they are."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tieout import fixed_values as V
from tieout.operators import pointer as P
from tieout.operators import release
from tieout.model import VERSION


def load_copy(
    rows: DataFrame,
    manifest: DataFrame,
    releases: DataFrame,
    table: str,
    release_id: int,
    loaded_at: datetime,
) -> tuple[DataFrame, DataFrame]:
    """(the whole copy, its row in loaded_versions). Only a published version can be loaded.

    An unpublished release gives an empty log row set and no rows, so nothing is swapped in.
    """
    chosen = releases.where(
        (F.col("table_name") == table)
        & (F.col("release_id") == release_id)
        & (F.col("state") == V.PUBLISHED)
    )
    label = label_text("label")
    version = chosen.agg(F.max(label)).scalar()
    copy = (
        release.read(rows, manifest, table, release_id)
        .withColumn("version_label", version)
        .where(F.col("version_label").isNotNull())
    )
    log = chosen.select(
        "table_name",
        "release_id",
        label.alias("version_label"),
        F.lit(loaded_at).cast("timestamp").alias("loaded_at"),
    )
    return copy, log


def label_text(label: Column | str) -> Column:
    """'source@position' pairs in source order."""
    entries = F.array_sort(F.map_entries(label))
    return F.array_join(
        F.transform(entries, lambda e: F.concat(e["key"], F.lit("@"), e["value"])), ", "
    )


def copy_lag(loaded_versions: DataFrame, heads: DataFrame) -> DataFrame:
    """The version each copy holds against the published head."""
    held = loaded_versions.groupBy("table_name").agg(
        F.max_by("release_id", "loaded_at").alias("loaded_release"),
        F.max("loaded_at").alias("loaded_at"),
    )
    now = heads.select("table_name", F.col("release_id").alias("head_release"))
    behind = ~F.col("loaded_release").eqNullSafe(F.col("head_release"))
    return now.join(held, "table_name", "left").withColumn("behind", behind)


def pinned_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_release: int,
    right_release: int,
    how: str = "inner",
) -> DataFrame:
    """Two tables joined at the versions they were read at, which the answer carries."""
    return left.join(right, list(keys), how).withColumns(
        {
            "left_release": F.lit(left_release).cast("bigint"),
            "right_release": F.lit(right_release).cast("bigint"),
        }
    )


def _measures() -> list[Column]:
    settled = F.col("status") == V.GMV_STATUS
    return [
        F.sum(F.when(settled, F.col("amount_paise"))).alias("gmv_paise"),
        F.count(F.lit(1)).alias("transaction_count"),
    ]


def metrics(fact: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The governed measures, by any dimension of the fact."""
    return fact.groupBy(*by).agg(*_measures())


def daily_rollup(fact: DataFrame) -> DataFrame:
    return metrics(fact.withColumn("day", F.col("business_date")), ("business_line", "day"))


def with_label(
    answer: DataFrame, releases: DataFrame, table: str, release_id: int, now: datetime
) -> DataFrame:
    """The answer with its version, its age and whether it was verified."""
    one = releases.where((F.col("table_name") == table) & (F.col("release_id") == release_id))

    def of(value: Column) -> Column:
        return one.agg(F.max(value)).scalar()

    age = F.unix_seconds(F.lit(now).cast("timestamp")) - F.unix_seconds("published_at")
    verified = F.col("state") == V.PUBLISHED
    return answer.withColumns(
        {
            "version": F.lit(release_id).cast("bigint"),
            "version_label": of(label_text("label")),
            "age_seconds": of(age),
            "verified": F.coalesce(of(verified), F.lit(False)),
            "reconciled": F.coalesce(of(F.col("reconciled")), F.lit(False)),
        }
    )


def trace(
    manifest: DataFrame,
    releases: DataFrame,
    cuts: DataFrame,
    pointer: DataFrame,
    register: DataFrame,
) -> DataFrame:
    """Where the published rows of each slice came from.

    A slice leads to its release, the release's label to a position per source: for a database
    the transaction of that cut, for a feed (`partner.feed` at an instant) the files of the
    version that was current then. One row per origin. The slice is a business date.
    """
    live = manifest.where(P.is_open()).select("table_name", "slice", "release_id")
    sources = live.join(release.label(releases), ["table_name", "release_id"])
    databases = sources.join(
        cuts.select("source", F.col("position").cast("string").alias("at"), "transaction_id")
        .distinct(),
        ["source", "at"],
    ).select(*live.columns, "source", "at", F.col("transaction_id").alias("origin"))

    files = register.where(F.col("state").isin(V.PUBLISHED, V.SUPERSEDED)).select(
        *VERSION, "file_id"
    )
    history = pointer.join(files, list(VERSION)).select(
        F.concat_ws(".", "partner", "feed").alias("source"),
        F.col("posting_date").cast("string").alias("slice"),
        "valid_from",
        "valid_to",
        "file_id",
    )
    at = F.col("at").try_cast("timestamp")
    valid = (F.col("valid_from") <= at) & (F.col("valid_to").isNull() | (F.col("valid_to") > at))
    feeds = (
        sources.join(history, ["source", "slice"])
        .where(valid)
        .select(*live.columns, "source", "at", F.col("file_id").alias("origin"))
    )
    return databases.unionByName(feeds)


