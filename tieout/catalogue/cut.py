from __future__ import annotations

from datetime import UTC, datetime, timedelta

from pyspark.sql import functions as F

from tieout.catalogue.registry import ctes, query, shown, sql_shown
from tieout.durable import materialise
from tieout.model import MergeSpec
from tieout.operators import cdc
from tieout.operators import cut as C
from tieout.sources import derived as S
from tieout.sources.tables import given

HORIZON = "TIMESTAMP '2001-07-01'"
TX = f"""tx AS (
  SELECT date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) * 10000000000
           + o_orderkey AS position,
         'tx-' || o_orderkey AS transaction_id, o_orderdate AS committed_at,
         o_orderdate <= {HORIZON} AS ended, n AS lines
  FROM orders LEFT JOIN (SELECT l_orderkey, count(DISTINCT l_linenumber) AS n
                         FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey)"""
BRONZE = f"""bronze AS (
  SELECT 'public.orders' AS source_table, 'tx-' || o_orderkey AS transaction_id,
         CAST(o_orderkey AS VARCHAR) AS key, o_orderkey AS source_lsn, o_orderdate AS ingest_ts
  FROM orders WHERE o_orderdate <= {HORIZON}
  UNION ALL
  SELECT 'public.lineitem', 'tx-' || l_orderkey, l_orderkey || '-' || l_linenumber, l_linenumber,
         o_orderdate + to_days(CAST(l_quantity AS INTEGER))
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey
  WHERE o_orderdate + to_days(CAST(l_quantity AS INTEGER)) <= {HORIZON})"""
EXPECTED = """expected AS (
  SELECT position, transaction_id, committed_at, 'public.orders' AS source_table, 1 AS expected
  FROM tx WHERE ended
  UNION ALL
  SELECT position, transaction_id, committed_at, 'public.lineitem', lines
  FROM tx WHERE ended AND lines IS NOT NULL)"""
LANDED = """landed AS (
  SELECT transaction_id, source_table, count(DISTINCT source_lsn) AS landed
  FROM bronze GROUP BY ALL)"""
SHORT = """short AS (
  SELECT e.*, coalesce(l.landed, 0) AS landed
  FROM expected e LEFT JOIN landed l USING (transaction_id, source_table)
  WHERE coalesce(l.landed, 0) <> e.expected)"""
CUT = """cut AS (
  SELECT position, transaction_id, committed_at FROM tx
  WHERE ended AND position < (SELECT coalesce(min(position), 9223372036854775807) FROM short)
  ORDER BY position DESC LIMIT 1)"""
UP_TO_CUT = ctes(TX, BRONZE, EXPECTED, LANDED, SHORT, CUT)


def _ends(spark, sf):
    return C.new_ends(S.transactions(spark, sf))


def _landed(spark, sf):
    return C.landed_counts(S.captured(spark, sf))


def _cut(spark, sf):
    return C.longest_complete_prefix(_ends(spark, sf), _landed(spark, sf), S.TRACKED)


def found_cut(spark, sf):
    """The cut as later steps take it: one row that was decided before."""
    return materialise(_cut(spark, sf))


@query(
    "cut_new_ends",
    ctes(TX)
    + f"""SELECT position, transaction_id, {sql_shown("committed_at")} AS committed_at FROM tx
WHERE ended AND position > 10000000000000""",
)
def new_ends(spark, sf):
    found = C.new_ends(S.transactions(spark, sf), 10_000_000_000_000)
    return found.select("position", "transaction_id", "committed_at").withColumns(
        shown("committed_at")
    )


@query(
    "cut_expected_counts",
    ctes(TX, EXPECTED)
    + "SELECT position, transaction_id, source_table, CAST(expected AS BIGINT) AS expected "
    "FROM expected",
)
def expected_counts(spark, sf):
    return C.expected_counts(_ends(spark, sf), S.TRACKED).drop("committed_at")


@query(
    "cut_landed_since",
    ctes(BRONZE)
    + f"""SELECT key AS line_id, source_lsn, {sql_shown("ingest_ts")} AS ingest_ts FROM bronze
WHERE source_table = 'public.lineitem' AND ingest_ts >= TIMESTAMP '1999-12-31 23:55:00'""",
)
def landed_since(spark, sf):
    rows = C.landed_since(S.bronze_lineitem(spark, sf), datetime(2000, 1, 1, 0, 5))
    return rows.select("line_id", "source_lsn", "ingest_ts").withColumns(shown("ingest_ts"))


@query(
    "cut_only_transactions",
    ctes(TX, BRONZE)
    + """SELECT key AS line_id, source_lsn FROM bronze
WHERE source_table = 'public.lineitem'
  AND transaction_id IN (SELECT transaction_id FROM tx WHERE ended
                         AND position > 10000000000000)""",
)
def only_transactions(spark, sf):
    ends = C.new_ends(S.transactions(spark, sf), 10_000_000_000_000)
    return C.only_transactions(S.bronze_lineitem(spark, sf), ends).select("line_id", "source_lsn")


@query("cut_landed_counts", ctes(BRONZE, LANDED) + "SELECT * FROM landed")
def landed_counts(spark, sf):
    return _landed(spark, sf)


@query(
    "cut_longest_complete_prefix",
    UP_TO_CUT + f"SELECT position, transaction_id, {sql_shown('committed_at')} AS committed_at "
    "FROM cut",
)
def longest_complete_prefix(spark, sf):
    return _cut(spark, sf).withColumns(shown("committed_at"))


@query(
    "cut_changes_in_cut",
    UP_TO_CUT
    + """SELECT key AS line_id, source_lsn FROM bronze
WHERE source_table = 'public.lineitem' AND transaction_id IN (
  SELECT transaction_id FROM tx WHERE ended AND position <= (SELECT position FROM cut))""",
)
def changes_in_cut(spark, sf):
    rows = C.changes_in_cut(S.bronze_lineitem(spark, sf), _ends(spark, sf), found_cut(spark, sf))
    return rows.select("line_id", "source_lsn")


@query(
    "cut_advance_all_tables",
    UP_TO_CUT
    + """SELECT source_table, count(DISTINCT key) AS current_rows,
       (SELECT position FROM cut) AS position
FROM bronze
WHERE transaction_id IN (
  SELECT transaction_id FROM tx WHERE ended AND position <= (SELECT position FROM cut))
GROUP BY source_table""",
)
def advance_all_tables(spark, sf):
    """Every table of the source merged up to the same cut."""
    cut, ends = found_cut(spark, sf), _ends(spark, sf)
    specs = {
        "public.orders": MergeSpec(("order_id",), ("status", "amount_paise")),
        "public.lineitem": MergeSpec(("line_id",), ("amount_paise",)),
    }
    merged = None
    for name, rows in S.captured(spark, sf).items():
        changes = C.changes_in_cut(rows, ends, cut)
        empty = cdc.empty_target(rows, specs[name])
        state = cdc.apply_changes(empty, changes, specs[name], S.MERGED_AT)
        one = state.agg(F.count(F.lit(1)).alias("current_rows")).select(
            F.lit(name).alias("source_table"), "current_rows"
        )
        merged = one if merged is None else merged.unionByName(one)
    return merged.withColumn("position", cut.agg(F.max("position")).scalar())


@query(
    "cut_read_at",
    """SELECT CAST(o_orderkey AS VARCHAR) AS txn_id,
       CAST(round(o_totalprice * 100) AS BIGINT) AS amount_paise FROM orders""",
)
def read_at(spark, sf):
    """The fact as it stood at the cut that named its first release, although a second is live."""
    cut = found_cut(spark, sf)
    cuts = cut.select(
        F.lit("sales").alias("source"),
        "position",
        F.lit(S.TABLE).alias("table_name"),
        F.lit(1).cast("bigint").alias("release_id"),
        F.lit(S.SECOND_PUBLISH).alias("cut_at"),
    )
    position = cut.first()["position"]
    rows = C.read_at(
        S.released_rows(spark, sf), S.manifest(spark, sf), cuts, S.TABLE, "sales", position,
        S.SECOND_PUBLISH + timedelta(days=6),
    )
    return rows.select("txn_id", "amount_paise")


@query(
    "cut_kept_for_reading",
    """SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS cut_day, count(*) AS cuts FROM orders
WHERE o_orderdate + INTERVAL 7 DAY > TIMESTAMP '1998-01-01 12:00:00' GROUP BY ALL""",
)
def kept_for_reading(spark, sf):
    """Every order as a cut taken when it was placed; those kept at noon of New Year's Day."""
    cuts = given(spark, sf, "orders").select(
        F.col("o_orderkey").alias("position"), F.col("o_orderdate").cast("timestamp").alias("cut_at")
    )
    kept = C.unexpired(cuts, datetime(1998, 1, 1, 12, tzinfo=UTC))
    day = F.col("cut_at").cast("date").cast("string").alias("cut_day")
    return kept.groupBy(day).agg(F.count(F.lit(1)).alias("cuts"))


def _source_dates(spark, sf):
    dates = given(spark, sf, "orders").select(
        F.col("o_orderdate").cast("date").alias("business_date")
    )
    sources = F.explode(F.array(F.lit("sales"), F.lit("returns")))
    return dates.distinct().select(sources.alias("source"), "business_date")


@query(
    "cut_input_status",
    UP_TO_CUT
    + """, days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS business_date FROM orders),
ready AS (
  SELECT business_date,
         (SELECT committed_at FROM cut)
           >= business_date + INTERVAL 1 DAY - INTERVAL 330 MINUTE AS complete
  FROM days)
SELECT 'sales' AS name, business_date, complete,
       CASE WHEN complete THEN '' ELSE 'cut has reached '
         || (SELECT strftime(committed_at, '%Y-%m-%dT%H:%M:%S') FROM cut) END AS detail
FROM ready
UNION ALL
SELECT 'returns', business_date, false, 'cut has reached nothing yet' FROM days""",
)
def input_status(spark, sf):
    """One source has a cut; the other has none yet."""
    cut = found_cut(spark, sf).withColumn("source", F.lit("sales"))
    return C.input_status(cut, C.cutoffs(_source_dates(spark, sf)))


@query(
    "cut_first_incomplete",
    UP_TO_CUT
    + """SELECT position, transaction_id, source_table, CAST(expected AS BIGINT) AS expected, landed
FROM short WHERE position = (SELECT min(position) FROM short)""",
)
def first_incomplete(spark, sf):
    return C.first_incomplete(_ends(spark, sf), _landed(spark, sf), S.TRACKED).drop("committed_at")


@query(
    "cut_cutoffs",
    """SELECT DISTINCT CAST(o_orderdate AS DATE) AS business_date,
       strftime(CAST(o_orderdate AS DATE) + INTERVAL 1 DAY - INTERVAL 330 MINUTE,
                '%Y-%m-%d %H:%M:%S') AS cutoff
FROM orders""",
)
def cutoffs(spark, sf):
    dates = _source_dates(spark, sf).select("business_date").distinct()
    return C.cutoffs(dates).withColumns(shown("cutoff"))
