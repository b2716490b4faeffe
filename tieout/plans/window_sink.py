"""Replacing a window of dates in a stored table, also the dates that have no rows any more."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tieout.durable import materialise


_MODE = "spark.sql.sources.partitionOverwriteMode"


def create(
    spark: SparkSession,
    table: str,
    like: DataFrame,
    date_column: str = "business_date",
    path: str | None = None,
) -> None:
    """The table, stored by date, if it is not there; under `path`, or in the warehouse."""
    location = "" if path is None else f" LOCATION '{path}'"
    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}"
        for f in sorted(like.schema.fields, key=lambda f: f.name == date_column)
    )
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet PARTITIONED BY "
        f"(`{date_column}`){location}"
    )


def replace_window(
    spark: SparkSession,
    table: str,
    rows: DataFrame,
    dates: Sequence[date],
    date_column: str = "business_date",
) -> list[date]:
    """Make `rows` all that the table holds of these dates; other dates are not touched.

    Dates with rows are overwritten partition by partition. A window date without rows is a date
    whose rows are gone: its partition is dropped, which an overwrite alone would leave as it was.
    A row outside the window fails the write before anything changes. `rows` may read the table
    itself. A run that died is run again; running twice changes nothing. Returns the dropped dates.
    """
    kept = materialise(rows)
    inside = F.coalesce(F.col(date_column).isin(list(dates)), F.lit(False))
    stray = kept.where(~inside).select(date_column).first()
    if stray is not None:
        raise ValueError(f"{table}: a row outside the window, of {stray[0]}")
    found = {r[0] for r in kept.select(date_column).distinct().collect()}
    if found:
        before = spark.conf.get(_MODE)
        spark.conf.set(_MODE, "dynamic")
        try:
            target = spark.table(table).columns
            kept.select(*target).write.insertInto(table, overwrite=True)
        finally:
            spark.conf.set(_MODE, before)
    emptied = [d for d in sorted(set(dates)) if d not in found]
    for d in emptied:
        spark.sql(
            f"ALTER TABLE {table} DROP IF EXISTS PARTITION (`{date_column}` = DATE '{d}')"
        )
    return emptied
