"""Receiving partner files and publishing versions, many at a time.

Each job takes the control frames and returns the next ones. Rows are stored first and the
register last: a run that died in between is run again under the same load number.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tieout import fixed_values as V
from tieout.durable import materialise
from tieout.model import DELIVERY, FeedContract
from tieout.operators import deliveries as D


@dataclass(frozen=True)
class Received:
    parts: DataFrame  # every arriving part with `state` and `problems`
    rows: DataFrame  # rows of the accepted parts under `load_id`, to replace that load
    register: DataFrame


@dataclass(frozen=True)
class Published:
    verdicts: DataFrame
    register: DataFrame
    pointer: DataFrame
    missing: DataFrame  # deliveries whose arrival window has closed without a version
    announced: DataFrame  # reference feeds whose current version moved, never ahead of the flip


def receive(
    register: DataFrame,
    contract: FeedContract,
    parts: DataFrame,
    rows: DataFrame,
    now: datetime,
) -> Received:
    """Check, tag and register arriving parts.

    Rows carry the number of their load, and the register names the load that holds each file,
    so a load that nobody registered is never read. Store rows by posting date and partner, so
    that readers of some dates read only those.
    """
    load_id = (register.agg(F.max("load_id")).first()[0] or 0) + 1
    checked = D.refuse(D.check_parts(rows, parts, contract), register, V.IDENTIFIERS)
    decided = materialise(D.classify_arrivals(checked, register))
    staged = decided.where(F.col("state") == V.STAGED)
    tagged = D.tag_rows(rows, staged).withColumn("load_id", F.lit(load_id).cast("bigint"))
    # A refused part never replaces the accepted file whose id it used.
    accepted = register.where(F.col("state").isin(*V.RECEIVED)).select("file_id").unionByName(
        staged.select("file_id")
    )
    news = staged.unionByName(
        decided.where(F.col("state") == V.REJECTED)
        .join(accepted, "file_id", "left_anti")
        .dropDuplicates(["file_id"])
        .select(*decided.columns)
    )
    recorded = news.withColumns(
        {
            "reason": F.col("problems"),
            "registered_at": F.lit(now),
            "load_id": F.when(F.col("state") == V.STAGED, F.lit(load_id).cast("bigint")),
        }
    )
    return Received(decided, tagged, D.record(register, recorded))


def loaded_rows(rows: DataFrame, register: DataFrame) -> DataFrame:
    """Every row of every version. Read through `current_rows` or `as_known_at`."""
    named = register.select("file_id", "load_id")
    return rows.join(named, ["file_id", "load_id"], "left_semi").select(
        *(c for c in rows.columns if c != "load_id")
    )


def publish(
    register: DataFrame,
    pointer: DataFrame,
    contract: FeedContract,
    requests: DataFrame,
    now: datetime,
) -> Published:
    """A verdict per requested version, with the pointer and the register moved accordingly.

    A backlog builds its own history: what an earlier date publishes counts as usual for the same
    weekday of the weeks after it, in this same call. Each feed is looked after from the first
    posting date that was ever registered or requested: dates since then whose arrival window has
    closed at `now` and that have no version are `missing`, as a declared gap if the contract
    calls the feed optional.
    """
    asked = requests.select(*DELIVERY, "sequence_number", "approved_by")
    usual = D.usual_rows_in_turn(asked, register, pointer, contract.truncation_threshold)
    verdicts = materialise(
        D.publish_verdicts(asked, register, pointer, contract.truncation_threshold, usual)
    )
    flipped = D.flip(pointer, verdicts.where(F.col("verdict") == V.PUBLISHED), now)
    feeds = feeds_since(register.select(*DELIVERY).unionByName(asked.select(*DELIVERY)), contract)
    to_now = feeds.withColumn("last_date", F.greatest("first_date", F.lit(now).cast("date")))
    return Published(
        verdicts,
        D.settle_register(register, verdicts, flipped),
        flipped,
        D.missing(to_now, flipped, now),
        D.announcements(pointer, flipped, feeds),
    )


def feeds_since(deliveries: DataFrame, contract: FeedContract) -> DataFrame:
    """The feeds of these deliveries, since when they exist, and what their contract says."""
    return (
        deliveries.where(F.col("posting_date").isNotNull())
        .groupBy("partner", "feed")
        .agg(F.min("posting_date").alias("first_date"))
        .withColumns(
            {"optional": F.lit(contract.optional), "reference": F.lit(contract.reference)}
        )
    )
