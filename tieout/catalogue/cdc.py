from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tieout.catalogue.registry import ctes, query, shown, sql_shown
from tieout.functions import paise
from tieout.model import MergeSpec
from tieout.operators import cdc
from tieout.sources import derived as S
from tieout.sources.tables import given

CHANGES = """changes AS (
  SELECT CAST(user_id AS VARCHAR) AS loan_id,
         event_type AS status,
         CAST(round(value * 100) AS BIGINT) AS principal_paise,
         CASE WHEN event_type IN ('view', 'click') THEN '__debezium_unavailable_value'
              WHEN value < 5 THEN NULL ELSE props END AS loan_terms,
         CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS op,
         CASE WHEN ts >= TIMESTAMP '2024-01-16' THEN 2 ELSE 1 END AS source_incarnation,
         CASE WHEN ts >= TIMESTAMP '2024-01-16' THEN event_id ELSE 2 * event_id END AS source_lsn,
         ts AS ingest_ts
  FROM events)"""


def state_after(condition: str, name: str = "state", source: str = "changes") -> str:
    """The table after replaying the chosen changes one by one, written with windows."""
    return f"""{name}_epochs AS (
  SELECT *,
         sum(CASE WHEN op = 'd' THEN 1 ELSE 0 END) OVER seq AS epoch,
         row_number() OVER (PARTITION BY loan_id
                            ORDER BY source_incarnation DESC, source_lsn DESC) AS rn
  FROM {source} WHERE {condition}
  WINDOW seq AS (PARTITION BY loan_id ORDER BY source_incarnation, source_lsn)),
{name}_carried AS (
  SELECT *,
         last_value(CASE WHEN op <> 'd'
                          AND loan_terms IS DISTINCT FROM '__debezium_unavailable_value'
                         THEN {{'v': loan_terms}} END IGNORE NULLS)
           OVER (PARTITION BY loan_id, epoch ORDER BY source_incarnation, source_lsn
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS real
  FROM {name}_epochs),
{name} AS (
  SELECT loan_id,
         CASE WHEN op <> 'd' THEN status END AS status,
         CASE WHEN op <> 'd' THEN principal_paise END AS principal_paise,
         CASE WHEN op <> 'd' THEN real.v END AS loan_terms,
         source_incarnation, source_lsn, op = 'd' AS is_deleted
  FROM {name}_carried WHERE rn = 1)"""


STATE = "loan_id, status, principal_paise, loan_terms, source_incarnation, source_lsn, is_deleted"
ALL = state_after("true")
EARLY = state_after("ingest_ts < TIMESTAMP '2024-01-11'", "early")


@query(
    "cdc_latest_per_key",
    ctes(CHANGES)
    + f"""SELECT loan_id, status, principal_paise, loan_terms, op, source_incarnation, source_lsn,
       {sql_shown("ingest_ts")} AS ingest_ts
FROM changes
QUALIFY row_number() OVER (PARTITION BY loan_id
                           ORDER BY source_incarnation DESC, source_lsn DESC) = 1""",
)
def latest_per_key(spark, sf):
    return cdc.latest_per_key(S.changes(spark, sf), S.LOAN.keys).withColumns(shown("ingest_ts"))


@query(
    "cdc_is_newer",
    ctes(CHANGES, EARLY)
    + """SELECT c.loan_id, c.source_incarnation, c.source_lsn,
       c.source_incarnation > e.source_incarnation
       OR (c.source_incarnation = e.source_incarnation AND c.source_lsn > e.source_lsn) AS applies
FROM changes c JOIN early e USING (loan_id)""",
)
def is_newer(spark, sf):
    position = ("source_incarnation", "source_lsn")
    source = S.changes(spark, sf).select("loan_id", *(F.col(c).alias(f"s_{c}") for c in position))
    target = S.target(spark, sf).select("loan_id", *(F.col(c).alias(f"t_{c}") for c in position))
    return source.join(target, "loan_id").select(
        "loan_id",
        *(F.col(f"s_{c}").alias(c) for c in position),
        cdc.is_newer().alias("applies"),
    )


def _merged(spark, sf):
    return cdc.apply_changes(
        S.target(spark, sf), S.later_changes(spark, sf), S.LOAN, S.MERGED_AT
    )


@query("cdc_apply_changes", ctes(CHANGES, ALL) + f"SELECT {STATE} FROM state")
def apply_changes(spark, sf):
    return _merged(spark, sf).drop("updated_at")


@query(
    "cdc_deletes_clear_values",
    ctes(CHANGES, ALL)
    + """SELECT source_incarnation, count(*) AS deleted_keys,
       count(status) + count(principal_paise) + count(loan_terms) AS values_left
FROM state WHERE is_deleted GROUP BY source_incarnation""",
)
def deletes_clear_values(spark, sf):
    left = sum((F.count(c) for c in S.LOAN.values), F.lit(0))
    deleted = _merged(spark, sf).where("is_deleted")
    return deleted.groupBy("source_incarnation").agg(
        F.count(F.lit(1)).alias("deleted_keys"), left.cast("bigint").alias("values_left")
    )


@query(
    "cdc_tombstones_for_unseen_keys",
    ctes(CHANGES)
    + """SELECT loan_id, source_incarnation, source_lsn
FROM changes WHERE op = 'd'
QUALIFY row_number() OVER (PARTITION BY loan_id
                           ORDER BY source_incarnation DESC, source_lsn DESC) = 1""",
)
def tombstones_for_unseen_keys(spark, sf):
    """Deletes alone, merged into an empty table: each key is stored as a tombstone."""
    deletes = S.changes(spark, sf).where("op = 'd'")
    merged = cdc.apply_changes(cdc.empty_target(deletes, S.LOAN), deletes, S.LOAN, S.MERGED_AT)
    return merged.where("is_deleted").select("loan_id", "source_incarnation", "source_lsn")


@query(
    "cdc_unsupported_changes",
    ctes(CHANGES)
    + """SELECT loan_id, source_incarnation, source_lsn,
       CASE WHEN op = 'd' AND principal_paise > 20000
            THEN 'unsupported change operation: t'
            ELSE 'unsupported change operation: none' END AS problem
FROM changes
WHERE (op = 'd' AND principal_paise > 20000) OR (op = 'c' AND principal_paise > 25000)""",
)
def unsupported_changes(spark, sf):
    """Large deletes stand for truncates, large creates for records without an operation."""
    op = (
        F.when((F.col("op") == "d") & (F.col("principal_paise") > 20000), "t")
        .when((F.col("op") == "c") & (F.col("principal_paise") > 25000), None)
        .otherwise(F.col("op"))
    )
    return cdc.unsupported_changes(S.changes(spark, sf).withColumn("op", op)).select(
        "loan_id", "source_incarnation", "source_lsn", "problem"
    )


@query(
    "cdc_fill_unchanged",
    ctes(CHANGES)
    + """, newest AS (
  SELECT * FROM changes QUALIFY row_number() OVER (
    PARTITION BY loan_id ORDER BY source_incarnation DESC, source_lsn DESC) = 1),
deleted AS (
  SELECT * FROM changes WHERE op = 'd' QUALIFY row_number() OVER (
    PARTITION BY loan_id ORDER BY source_incarnation DESC, source_lsn DESC) = 1),
real AS (
  SELECT * FROM changes
  WHERE op <> 'd' AND loan_terms IS DISTINCT FROM '__debezium_unavailable_value'
  QUALIFY row_number() OVER (
    PARTITION BY loan_id ORDER BY source_incarnation DESC, source_lsn DESC) = 1)
SELECT n.loan_id, n.op, n.source_lsn, d.source_incarnation AS deleted_incarnation,
       d.source_lsn AS deleted_lsn, r.loan_terms AS real_terms, r.source_lsn AS real_lsn
FROM newest n LEFT JOIN deleted d USING (loan_id) LEFT JOIN real r USING (loan_id)""",
)
def fill_unchanged(spark, sf):
    return cdc.fill_unchanged(S.changes(spark, sf), S.LOAN).select(
        "loan_id",
        "newest.op",
        "newest.source_lsn",
        F.col("deleted_at.source_incarnation").alias("deleted_incarnation"),
        F.col("deleted_at.source_lsn").alias("deleted_lsn"),
        F.col("real_loan_terms.value").alias("real_terms"),
        F.col("real_loan_terms.at.source_lsn").alias("real_lsn"),
    )


@query(
    "cdc_lineage",
    ctes(CHANGES, ALL)
    + "SELECT loan_id, source_incarnation, source_lsn, is_deleted FROM state",
)
def lineage(spark, sf):
    return cdc.lineage(_merged(spark, sf), S.LOAN).drop("updated_at")


@query("cdc_replay_changes_nothing", ctes(CHANGES, ALL) + f"SELECT {STATE} FROM state")
def replay_changes_nothing(spark, sf):
    """The whole stream merged once more into the finished table."""
    return cdc.apply_changes(
        _merged(spark, sf), S.changes(spark, sf), S.LOAN, S.MERGED_AT
    ).drop("updated_at")


@query(
    "cdc_live_rows",
    ctes(CHANGES, ALL)
    + "SELECT loan_id, status, principal_paise, loan_terms FROM state WHERE NOT is_deleted",
)
def live_rows(spark, sf):
    return cdc.live_rows(_merged(spark, sf)).select("loan_id", *S.LOAN.values)


@query(
    "cdc_base_load",
    """WITH base AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id, o_orderstatus AS status,
         CAST(round(o_totalprice * 100) AS BIGINT) AS amount_paise, 1000 AS lsn
  FROM orders),
stream AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS order_id, l_linestatus AS status,
         CAST(round(l_extendedprice * 100) AS BIGINT) AS amount_paise,
         990 + CAST(l_quantity AS BIGINT) AS lsn, l_linenumber, l_partkey, l_suppkey
  FROM lineitem),
best AS (
  SELECT order_id, max(lsn) AS lsn FROM stream GROUP BY order_id)
SELECT b.order_id,
       CASE WHEN coalesce(best.lsn, 0) > 1000 THEN best.lsn ELSE 1000 END AS source_lsn,
       CASE WHEN coalesce(best.lsn, 0) > 1000 THEN 'stream' ELSE 'export' END AS won
FROM base b LEFT JOIN best USING (order_id)""",
)
def base_load(spark, sf):
    """Orders as the export at position 1000, their lines as a stream that overlaps it."""
    spec = MergeSpec(("order_id",), ("status", "amount_paise"))
    export = given(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.lit("export").alias("status"),
        paise("o_totalprice").alias("amount_paise"),
    )
    stream = given(spark, sf, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.lit("stream").alias("status"),
        paise("l_extendedprice").alias("amount_paise"),
        F.lit("u").alias("op"),
        F.lit(1).alias("source_incarnation"),
        (990 + F.col("l_quantity").cast("bigint")).alias("source_lsn"),
    )
    loaded = cdc.base_load(export, slot_position=1000, incarnation=1)
    target = cdc.apply_changes(cdc.empty_target(loaded, spec), loaded, spec, S.MERGED_AT)
    merged = cdc.apply_changes(target, stream, spec, S.MERGED_AT)
    return merged.select("order_id", "source_lsn", F.col("status").alias("won"))


@query(
    "cdc_sweep",
    ctes(CHANGES, state_after("ingest_ts < TIMESTAMP '2024-01-17'", "before_sweep"))
    + """, with_sweep AS (
  SELECT loan_id, status, principal_paise, loan_terms, op, source_incarnation, source_lsn
  FROM changes
  UNION ALL
  SELECT loan_id, NULL, NULL, NULL, 'd', 2, 1
  FROM before_sweep WHERE source_incarnation < 2),
"""
    + state_after("true", "swept", "with_sweep")
    + f" SELECT {STATE} FROM swept",
)
def sweep(spark, sf):
    """A re-snapshot that finished a day after the restore, then the rest of the stream."""
    changes, finished = S.changes(spark, sf), F.lit(datetime(2024, 1, 17))
    first = changes.where(F.col("ingest_ts") < finished)
    rest = changes.where(F.col("ingest_ts") >= finished)
    state = cdc.apply_changes(cdc.empty_target(first, S.LOAN), first, S.LOAN, S.MERGED_AT)
    swept = cdc.sweep(state, S.LOAN, incarnation=2, slot_position=1, updated_at=S.MERGED_AT)
    return cdc.apply_changes(swept, rest, S.LOAN, S.MERGED_AT).drop("updated_at")
