"""Fast signals from complete facts only, always labelled unverified."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tieout import fixed_values as V


SALTS = 32


def score(
    events: DataFrame, reference: DataFrame, window: str = "1 hour", salts: int = SALTS
) -> DataFrame:
    """Count and sum per user and tumbling window, with the input positions behind them.

    Works on a batch and, after a watermark, on a stream. `events` are deduplicated and carry
    event_ts, user_id, event_type, amount_paise and position; `reference` says which event
    types are watched, and joins as the static side. The join is salted, because a few types
    hold most events and a stream has no adaptive plan that would split them.
    """
    salted = events.withColumn("salt", F.pmod(F.xxhash64("position"), F.lit(salts)))
    copies = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint")))
    watched = salted.join(reference.withColumn("salt", copies), ["event_type", "salt"])
    return (
        watched.groupBy("user_id", F.window("event_ts", window).alias("w"))
        .agg(
            F.count(F.lit(1)).alias("events"),
            F.sum("amount_paise").alias("amount_paise"),
            F.min("position").alias("first_position"),
            F.max("position").alias("last_position"),
        )
        .select(
            "user_id",
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            "events",
            "amount_paise",
            "first_position",
            "last_position",
            F.lit(V.SIGNAL_SOURCE).alias("source"),
            F.lit(False).alias("verified"),
        )
    )


def drift(signals: DataFrame, gold: DataFrame) -> DataFrame:
    """Per user and day, where the signals' totals differ from what gold shows.

    `gold` has user_id, business_date, amount_paise.
    """
    keys = ["user_id", "business_date"]
    fast = signals.groupBy("user_id", F.to_date("window_start").alias("business_date")).agg(
        F.sum("amount_paise").alias("signal_paise"), F.sum("events").alias("signal_events")
    )
    true = gold.groupBy(*keys).agg(
        F.sum("amount_paise").alias("gold_paise"), F.count(F.lit(1)).alias("gold_events")
    )
    same = F.col("signal_paise").eqNullSafe(F.col("gold_paise")) & F.col(
        "signal_events"
    ).eqNullSafe(F.col("gold_events"))
    gap = F.coalesce("signal_paise", F.lit(0)) - F.coalesce("gold_paise", F.lit(0))
    return fast.join(true, keys, "full_outer").where(~same).withColumn("drift_paise", gap)
