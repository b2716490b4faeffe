"""Up to which source transaction has every event on every table landed?

Everything stays distributed: transactions and events are compared per (transaction, table), and
only the position of the first incomplete transaction, a scalar, bounds the cut.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tieout import fixed_values as V
from tieout.functions import business_day_end, instant_text
from tieout.operators import release

_END = ("position", "transaction_id", "committed_at")


def new_ends(transactions: DataFrame, after_position: int = -1) -> DataFrame:
    return transactions.where(
        (F.col("status") == V.END) & (F.col("position") > F.lit(after_position))
    )


def expected_counts(ends: DataFrame, tracked: Collection[str] | None = None) -> DataFrame:
    """One row per (transaction, table) it declares; a transaction without tables gives none.

    `tracked` names the tables that are loaded. Captured tables that nobody loads, such as a
    heartbeat, could otherwise never land and would stall the cut for good.
    """
    rows = ends.select(*_END, F.inline("data_collections")).select(
        *_END,
        F.col("data_collection").alias("source_table"),
        F.col("event_count").alias("expected"),
    )
    return rows if tracked is None else rows.where(F.col("source_table").isin(*tracked))


def landed_since(
    bronze: DataFrame,
    since: datetime | None,
    allowance: timedelta = timedelta(minutes=V.CLOCK_ALLOWANCE_MINUTES),
) -> DataFrame:
    """Bronze rows that can belong to a transaction committed after `since`.

    The bound is on the stored ingest time, so partition pruning or row-group statistics skip
    the history.
    """
    if since is None:
        return bronze
    oldest = F.lit(since) - F.lit(allowance)
    recent = bronze.where(F.col("ingest_ts") >= oldest)
    if "ingest_hour" in bronze.columns:  # the partition column says the same, hour by hour
        recent = recent.where(F.col("ingest_hour") >= F.date_format(oldest, "yyyy-MM-dd-HH"))
    return recent


def only_transactions(changes: DataFrame, ends: DataFrame) -> DataFrame:
    return changes.join(ends.select("transaction_id"), "transaction_id", "left_semi")


def landed_counts(changes: Mapping[str, DataFrame]) -> DataFrame:
    """Distinct events per (transaction, table); distinct because delivery repeats."""
    tagged = [
        rows.select("transaction_id", F.lit(table).alias("source_table"), "source_lsn")
        for table, rows in changes.items()
    ]
    return distinct_numbers(
        reduce(DataFrame.unionByName, tagged), ("transaction_id", "source_table"), "source_lsn",
        "landed",
    )


def distinct_numbers(
    rows: DataFrame, keys: Collection[str], number: str, name: str
) -> DataFrame:
    """How many different whole numbers each key has, as `name`; NULL does not count.

    64 neighbouring numbers are bits of one mask, so the rows of a key that lie together travel as
    one, and a key of any size spreads over its masks.
    """
    at = F.col(number).cast("bigint")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), at.bitwiseAND(63).cast("int"))
    masks = rows.groupBy(*keys, F.shiftright(at, 6).alias("block")).agg(F.bit_or(bit).alias("mask"))
    counted = F.coalesce(F.sum(F.bit_count("mask")), F.lit(0).cast("bigint"))
    return masks.groupBy(*keys).agg(counted.alias(name))


def mismatches(
    ends: DataFrame, landed: DataFrame, tracked: Collection[str] | None = None
) -> DataFrame:
    """(transaction, table) pairs that have not landed exactly: more is as wrong as fewer."""
    return (
        expected_counts(ends, tracked)
        .join(landed, ["transaction_id", "source_table"], "left")
        .withColumn("landed", F.coalesce("landed", F.lit(0).cast("bigint")))
        .where(F.col("landed") != F.col("expected"))
    )


def longest_complete_prefix(
    ends: DataFrame, landed: DataFrame, tracked: Collection[str] | None = None
) -> DataFrame:
    """The last transaction before the first incomplete one: one row, or none."""
    before = ends.where(F.col("position") < _first_bad(mismatches(ends, landed, tracked)))
    return (
        before.agg(F.max_by(F.struct(*_END), "position").alias("cut"))
        .where(F.col("cut").isNotNull())
        .select("cut.*")
    )


def changes_in_cut(changes: DataFrame, ends: DataFrame, cut: DataFrame) -> DataFrame:
    """Changes of the transactions at or before the cut; none when there is no cut."""
    last = cut.agg(F.max("position").alias("position")).scalar()
    return only_transactions(changes, ends.where(F.col("position") <= last))


def first_incomplete(
    ends: DataFrame, landed: DataFrame, tracked: Collection[str] | None = None
) -> DataFrame:
    """Which tables of the transaction that stops the cut are short, and by how much."""
    short = mismatches(ends, landed, tracked)
    columns = [c for c in short.columns if c != "position"]
    # One row per transaction holds its few tables, so the first is found without a second pass.
    per_position = short.groupBy("position").agg(F.collect_list(F.struct(*columns)).alias("tables"))
    first = per_position.agg(F.min_by(F.struct("position", "tables"), "position").alias("first"))
    return first.select("first.position", F.inline("first.tables")).select(*short.columns)


def input_status(cut: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """A business date of a source is complete once the cut was committed at or after its end.

    `cut` has (source, committed_at), at most one row per source. `cutoffs` has (source,
    business_date, cutoff). Sources without a cut are reported as incomplete.
    """
    reached = cut.select("source", "committed_at")
    complete = F.coalesce(F.col("committed_at") >= F.col("cutoff"), F.lit(False))
    shown = F.coalesce(instant_text("committed_at"), F.lit("nothing yet"))
    return cutoffs.join(reached, "source", "left").select(
        F.col("source").alias("name"),
        "business_date",
        complete.alias("complete"),
        F.when(complete, "").otherwise(F.concat(F.lit("cut has reached "), shown)).alias("detail"),
    )


def cutoffs(dates: DataFrame, zone: Column | str = V.BUSINESS_ZONE) -> DataFrame:
    """The instant that ends each business date, in UTC."""
    return dates.withColumn("cutoff", business_day_end("business_date", zone))


def tag_name(source: Column | str, position: Column | str) -> Column:
    return F.format_string("cut_%s_%d", source, position)


def release_at(cuts: DataFrame, table: str, source: str, position: int | Column) -> Column:
    """The release of a table that a cut names, as a scalar; a cut that is not there is refused."""
    at = position if isinstance(position, Column) else F.lit(position)
    named = cuts.where(
        (F.col("table_name") == table) & (F.col("source") == source) & (F.col("position") == at)
    )
    where = F.concat(F.lit(f"no cut of {source} is kept for {table} at "), at.cast("string"))
    refused = F.raise_error(where).cast("bigint")
    return named.agg(F.coalesce(F.max("release_id"), refused)).scalar()


def read_at(
    rows: DataFrame,
    manifest: DataFrame,
    cuts: DataFrame,
    table: str,
    source: str,
    position: int,
    now: datetime,
) -> DataFrame:
    """The rows of the release that the cut recorded for this table; later merges do not show.

    A cut that was never recorded, or is no longer kept at `now`, is refused when the rows are
    read: its release may have been swept away, so an empty answer would be a wrong one.
    """
    named = release_at(unexpired(cuts, now), table, source, position)
    return release.read(rows, manifest, table, named)


def unexpired(cuts: DataFrame, now: datetime, days: int = V.CUT_RETENTION_DAYS) -> DataFrame:
    """Cuts that are still kept for reading."""
    kept = F.col("cut_at") + F.make_dt_interval(F.lit(days))
    return cuts.where(kept > F.lit(now))


def _first_bad(short: DataFrame) -> Column:
    beyond_all = F.lit(V.BIGINT_MAX)
    return F.coalesce(short.agg(F.min("position").alias("position")).scalar(), beyond_all)
