"""Lag and layout of the tables, from the control frames and the files read."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tieout import fixed_values as V


def report(
    now: datetime,
    tables: Mapping[str, tuple[DataFrame, str]],
    cuts: DataFrame | None = None,
    releases: DataFrame | None = None,
) -> DataFrame:
    """(subject, measure, value) rows: table lag, cut lag, open holds.

    `tables` maps a name to its rows and the column with their ingest time.
    """
    def lag(instant: Column) -> Column:
        return F.unix_seconds(F.lit(now).cast("timestamp")) - F.unix_seconds(instant)

    found = [
        rows.agg(lag(F.max(at)).alias("value")).select(
            F.lit(name).alias("subject"), F.lit("lag_seconds").alias("measure"), "value"
        )
        for name, (rows, at) in tables.items()
    ]
    if cuts is not None:
        per_source = cuts.groupBy("source").agg(lag(F.max("committed_at")).alias("value"))
        found.append(
            per_source.select(
                F.col("source").alias("subject"), F.lit("cut_lag_seconds").alias("measure"), "value"
            )
        )
    if releases is not None:
        held = releases.groupBy("table_name").agg(
            F.count_if(F.col("state") == V.HELD).alias("value")
        )
        found.append(
            held.select(
                F.col("table_name").alias("subject"), F.lit("open_holds").alias("measure"), "value"
            )
        )
    return reduce(DataFrame.unionByName, found)


def files_per_partition(rows: DataFrame, *partition: str) -> DataFrame:
    """Rows and files of each partition of a table that was read from files."""
    placed = rows.select(*partition, F.col("_metadata.file_path").alias("path"))
    per_file = placed.groupBy(*partition, "path").agg(F.count(F.lit(1)).alias("rows"))
    return per_file.groupBy(*partition).agg(
        F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("files")
    )
