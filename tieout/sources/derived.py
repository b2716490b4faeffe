"""Domain inputs derived from the given tables, for the registered queries and the bench.

Every derivation covers its whole table and grows with it. The SQL oracles state the same
derivations independently.
"""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tieout import fixed_values as V
from tieout.durable import materialise
from tieout.functions import paise
from tieout.model import MANIFEST, POINTER, FeedContract, MergeSpec
from tieout.operators import cdc, cut, deliveries, release
from tieout.sources.tables import given

LOAN = MergeSpec(
    keys=("loan_id",), values=("status", "principal_paise", "loan_terms"), large=("loan_terms",)
)
MERGED_AT = datetime(2024, 2, 1, tzinfo=UTC)
RESTORE = datetime(2024, 1, 16)  # the source restarts its log positions here
TARGET_UNTIL = datetime(2024, 1, 11)
BATCH_FROM = datetime(2024, 1, 6)  # overlaps the target, so part of the batch is replays

HORIZON = datetime(2001, 7, 1)  # nothing that lands later is there yet
TRACKED = ("public.orders", "public.lineitem")

FEED = FeedContract(keys=("settlement_id",))
FIRST_PUBLISH = datetime(2001, 9, 1, tzinfo=UTC)
SECOND_PUBLISH = datetime(2001, 9, 2, tzinfo=UTC)

FACT_KEYS = ("txn_id",)


# ---- change stream, from events


def changes(spark: SparkSession, folder: str) -> DataFrame:
    return changes_of(given(spark, folder, "events"))


def changes_of(events: DataFrame) -> DataFrame:
    restored = F.col("ts") >= F.lit(RESTORE)
    terms = (
        F.when(F.col("event_type").isin("view", "click"), V.UNCHANGED)
        .when(F.col("value") < 5, None)
        .otherwise(F.col("props"))
    )
    op = F.when(F.col("event_type") == "signup", "c").when(
        F.col("event_type") == "error", "d"
    ).otherwise("u")
    return events.select(
        F.col("user_id").cast("string").alias("loan_id"),
        F.col("event_type").alias("status"),
        paise("value").alias("principal_paise"),
        terms.alias("loan_terms"),
        op.alias("op"),
        F.when(restored, 2).otherwise(1).alias("source_incarnation"),
        F.when(restored, F.col("event_id")).otherwise(2 * F.col("event_id")).alias("source_lsn"),
        F.col("ts").cast("timestamp").alias("ingest_ts"),
    )


def early_changes(spark: SparkSession, folder: str) -> DataFrame:
    return changes(spark, folder).where(F.col("ingest_ts") < F.lit(TARGET_UNTIL))


def later_changes(spark: SparkSession, folder: str) -> DataFrame:
    return changes(spark, folder).where(F.col("ingest_ts") >= F.lit(BATCH_FROM))


def target(spark: SparkSession, folder: str) -> DataFrame:
    early = early_changes(spark, folder)
    return cdc.apply_changes(cdc.empty_target(early, LOAN), early, LOAN, MERGED_AT)


# ---- transactions, from orders and their lines


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    orders = given(spark, folder, "orders")
    lines = given(spark, folder, "lineitem")
    numbered = lines.select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber")
    per_order = cut.distinct_numbers(numbered, ("o_orderkey",), "l_linenumber", "lines")
    day = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1995-01-01").cast("date"))

    def collection(name: str, count):
        return F.struct(
            F.lit(name).alias("data_collection"), count.cast("bigint").alias("event_count")
        )

    declared = F.array(
        collection("public.orders", F.lit(1)),
        F.when(F.col("lines").isNotNull(), collection("public.lineitem", F.col("lines"))),
        collection("public.heartbeat", F.lit(1)),
    )
    return orders.join(per_order, "o_orderkey", "left").select(
        (day.cast("bigint") * F.lit(10_000_000_000) + F.col("o_orderkey")).alias("position"),
        _transaction_id("o_orderkey").alias("transaction_id"),
        F.when(F.col("o_orderdate") <= F.lit(HORIZON), V.END).otherwise("BEGIN").alias("status"),
        F.array_compact(declared).alias("data_collections"),
        F.col("o_orderdate").cast("timestamp").alias("committed_at"),
    )


def bronze_orders(spark: SparkSession, folder: str) -> DataFrame:
    landed = F.col("o_orderdate").cast("timestamp")
    return _landed(
        given(spark, folder, "orders").select(
            F.col("o_orderkey").cast("string").alias("order_id"),
            F.col("o_orderstatus").alias("status"),
            paise("o_totalprice").alias("amount_paise"),
            F.lit("c").alias("op"),
            F.lit(1).alias("source_incarnation"),
            F.col("o_orderkey").alias("source_lsn"),
            _transaction_id("o_orderkey").alias("transaction_id"),
            landed.alias("ingest_ts"),
        )
    )


def bronze_lineitem(spark: SparkSession, folder: str) -> DataFrame:
    """Lines land as many days after their order as they have units; repeats are redeliveries."""
    when = given(spark, folder, "orders").select(F.col("o_orderkey").alias("l_orderkey"),
                                                 "o_orderdate")
    landed = F.col("o_orderdate").cast("timestamp") + F.make_dt_interval(
        F.col("l_quantity").cast("int")
    )
    return _landed(
        given(spark, folder, "lineitem").join(when, "l_orderkey").select(
            F.concat_ws("-", "l_orderkey", "l_linenumber").alias("line_id"),
            paise("l_extendedprice").alias("amount_paise"),
            F.lit("c").alias("op"),
            F.lit(1).alias("source_incarnation"),
            F.col("l_linenumber").cast("bigint").alias("source_lsn"),
            _transaction_id("l_orderkey").alias("transaction_id"),
            landed.alias("ingest_ts"),
        )
    )


def captured(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {
        "public.orders": bronze_orders(spark, folder),
        "public.lineitem": bronze_lineitem(spark, folder),
    }


def _transaction_id(key: str):
    return F.concat(F.lit("tx-"), F.col(key).cast("string"))


def _landed(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("ingest_ts") <= F.lit(HORIZON))


# ---- deliveries, from orders


def file_rows(spark: SparkSession, folder: str) -> DataFrame:
    sequence, part = 1 + F.col("o_orderkey") % 2, 1 + F.col("o_custkey") % 2
    date = F.col("o_orderdate").cast("date")
    return given(spark, folder, "orders").select(
        F.col("o_orderstatus").alias("partner"),
        F.lit("orders").alias("feed"),
        date.alias("posting_date"),
        sequence.alias("sequence_number"),
        part.cast("int").alias("part_number"),
        F.format_string("%s-%s-v%d-p%d", "o_orderstatus", date.cast("string"), sequence, part)
        .alias("file_id"),
        F.col("o_orderkey").cast("string").alias("settlement_id"),
        paise("o_totalprice").alias("amount_paise"),
    )


def file_parts(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as their trailers describe them. A version has as many parts as its highest one."""
    rows = file_rows(spark, folder)
    version = ["partner", "feed", "posting_date", "sequence_number"]
    parts = rows.groupBy("file_id", *version, "part_number").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("amount_paise").alias("amount_paise")
    )
    manifest = parts.groupBy(*version).agg(F.max("part_number").alias("part_count"))
    content = F.concat_ws("|", "file_id", "row_count", "amount_paise")
    return parts.join(manifest, version).withColumn("file_hash", F.md5(content))


def staged_register(spark: SparkSession, folder: str) -> DataFrame:
    return file_parts(spark, folder).select(
        "file_id", "file_hash", "partner", "feed", "posting_date", "sequence_number",
        "part_number", "part_count", "row_count", "amount_paise",
        F.lit(V.STAGED).alias("state"),
        F.lit("").alias("reason"),
        F.lit(FIRST_PUBLISH).alias("registered_at"),
    )


def requests(register: DataFrame, sequence: int | None = None, approver: str | None = None):
    asked = register.select("partner", "feed", "posting_date", "sequence_number").distinct()
    if sequence is not None:
        asked = asked.where(F.col("sequence_number") == sequence)
    return asked.withColumn("approved_by", F.lit(approver).cast("string"))


def first_published(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """(register, pointer) once every whole first version was published with approval."""
    register = materialise(staged_register(spark, folder))
    nothing = spark.createDataFrame([], POINTER)
    verdicts = materialise(
        deliveries.publish_verdicts(requests(register, 1, "start"), register, nothing)
    )
    wins = verdicts.where(F.col("verdict") == V.PUBLISHED)
    moved = materialise(deliveries.flip(nothing, wins, FIRST_PUBLISH))
    return materialise(deliveries.settle_register(register, verdicts, moved)), moved


def second_published(spark: SparkSession, folder: str) -> DataFrame:
    """The pointer after every whole second version was published too."""
    register, before = first_published(spark, folder)
    verdicts = deliveries.publish_verdicts(requests(register, 2, "again"), register, before)
    wins = verdicts.where(F.col("verdict") == V.PUBLISHED)
    return deliveries.flip(before, wins, SECOND_PUBLISH)


# ---- the gate, from orders


def fact(spark: SparkSession, folder: str) -> DataFrame:
    status = (
        F.when(F.col("o_orderstatus") == "F", "SETTLED")
        .when(F.col("o_orderstatus") == "O", "INITIATED")
        .otherwise("PARTIALLY_SETTLED")
    )
    return given(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("txn_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("o_orderpriority").alias("business_line"),
        paise("o_totalprice").alias("amount_paise"),
        status.alias("status"),
        F.col("o_orderdate").cast("date").alias("business_date"),
    )


def faulty_fact(spark: SparkSession, folder: str) -> DataFrame:
    """A candidate with one fault of each kind.

    Small amounts are dropped; signs are flipped on large initiated amounts of one line; money of
    another line's partly settled rows goes to the wrong key; the newest rows of a third line
    move to days the reference does not have.
    """
    low = (F.col("business_line") == "5-LOW") & (F.col("status") == "INITIATED")
    urgent = (F.col("business_line") == "1-URGENT") & (F.col("status") == "PARTIALLY_SETTLED")
    medium = (F.col("business_line") == "3-MEDIUM") & (
        F.col("business_date") >= F.lit("2001-07-25").cast("date")
    )
    return (
        fact(spark, folder)
        .where(F.col("amount_paise") >= 200_000)
        .withColumns(
            {
                "txn_id": F.when(urgent, F.concat(F.lit("x"), "txn_id")).otherwise(
                    F.col("txn_id")
                ),
                "amount_paise": F.when(
                    low & (F.col("amount_paise") > 40_000_000), -F.col("amount_paise")
                ).otherwise(F.col("amount_paise")),
                "business_date": F.when(medium, F.date_add("business_date", 30)).otherwise(
                    F.col("business_date")
                ),
            }
        )
    )


# ---- releases, from orders

TABLE = "fact_transaction"
CORRECTED_FROM = "1998-01-01"


def released_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Release 1 holds every date; release 2 replaces later dates without partly settled rows."""
    rows = fact(spark, folder).withColumn("slice", F.col("business_date").cast("string"))
    corrected = (F.col("business_date") >= F.lit(CORRECTED_FROM).cast("date")) & (
        F.col("status") != "PARTIALLY_SETTLED"
    )
    return rows.withColumn("release_id", F.lit(1).cast("bigint")).unionByName(
        rows.where(corrected).withColumn("release_id", F.lit(2).cast("bigint"))
    )


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    dates = fact(spark, folder).select("business_date").distinct()
    slices = dates.select(
        F.lit(TABLE).alias("table_name"), F.col("business_date").cast("string").alias("slice")
    )
    first = slices.withColumn("release_id", F.lit(1).cast("bigint"))
    second = slices.where(F.col("slice") >= CORRECTED_FROM).withColumn(
        "release_id", F.lit(2).cast("bigint")
    )
    nothing = spark.createDataFrame([], MANIFEST)
    once = materialise(release.publish(nothing, first, FIRST_PUBLISH))
    return release.publish(once, second, SECOND_PUBLISH)


def release_log(spark: SparkSession, folder: str) -> DataFrame:
    """One release per line and year; the last year of some lines is held."""
    orders = given(spark, folder, "orders").withColumn("year", F.year("o_orderdate"))
    per_year = orders.groupBy(F.col("o_orderpriority").alias("table_name"), "year").agg(
        F.min("o_orderdate").cast("timestamp").alias("created_at"),
        F.max("o_orderdate").cast("timestamp").alias("last_at"),
        F.max("o_orderkey").cast("string").alias("orders_at"),
        F.max("o_custkey").cast("string").alias("customers_at"),
        F.collect_set(F.col("o_orderdate").cast("date").cast("string")).alias("slices"),
    )
    held = (F.col("year") == 2001) & F.col("table_name").isin("1-URGENT", "5-LOW")
    return per_year.select(
        "table_name",
        F.col("year").cast("bigint").alias("release_id"),
        F.when(F.col("year") > 1995, F.col("year") - 1).cast("bigint").alias("parent_release"),
        F.array_sort("slices").alias("slices"),
        F.create_map(
            F.lit("orders"), "orders_at", F.lit("customers"), "customers_at"
        ).alias("label"),
        F.when(held, V.HELD).otherwise(V.PUBLISHED).alias("state"),
        F.lit("").alias("reason"),
        "created_at",
        F.when(~held, F.col("last_at")).alias("published_at"),
        F.lit(False).alias("reconciled"),
    )

