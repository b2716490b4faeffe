"""Which version of a thing is current, and which was current at any past instant.

Used for partner deliveries and for the releases of a table. A pointer row is valid over a
half-open interval; the open one has no end.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def is_open() -> Column:
    return F.col("valid_to").isNull()


def held_at(moment: datetime) -> Column:
    if moment.tzinfo is None:
        raise ValueError("the moment needs a time zone, as every stored instant is UTC")
    at = F.lit(moment)
    return (F.col("valid_from") <= at) & (is_open() | (F.col("valid_to") > at))


def current(pointer: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    return pointer.where(is_open()).groupBy(*keys).agg(F.max(version).alias(version))


def flip(
    pointer: DataFrame,
    requests: DataFrame,
    valid_at: datetime | Column,
    keys: Sequence[str],
    version: str,
    extra: Sequence[str] = (),
) -> DataFrame:
    """The whole next pointer: the highest requested version of each key begins if it is higher
    than the current one, and rows it replaces end at the same instant.

    The result does not depend on the order of the requests, and repeating them changes nothing.
    History is passed through untouched; only open rows meet the requests.
    """
    keys = list(keys)
    instant = valid_at if isinstance(valid_at, Column) else F.lit(valid_at)
    wanted = (
        requests.groupBy(*keys)
        .agg(F.max(F.struct(version, *extra)).alias("wanted"))
        .where(F.col("wanted")[version] > -1)
    )
    ended, live = pointer.where(~is_open()), pointer.where(is_open())
    replaced = F.col(version) < F.col("wanted")[version]
    live = live.join(wanted, keys, "left").withColumn(
        "valid_to", F.when(replaced, instant).otherwise(F.col("valid_to"))
    )
    begun = (
        wanted.join(current(pointer, keys, version).withColumnRenamed(version, "now"), keys, "left")
        .where(F.col("wanted")[version] > F.coalesce("now", F.lit(-1)))
        .select(*keys, "wanted.*")
        .withColumns({"valid_from": instant, "valid_to": F.lit(None).cast("timestamp")})
    )
    columns = pointer.columns
    return ended.unionByName(live.select(*columns)).unionByName(begun.select(*columns))
