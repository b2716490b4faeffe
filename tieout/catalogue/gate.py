from __future__ import annotations

from datetime import UTC, date, datetime, timedelta

from pyspark.sql import functions as F

from tieout import fixed_values as V
from tieout.catalogue.cut import UP_TO_CUT, found_cut
from tieout.catalogue.deliveries import (
    FIRST,
    PARTS,
    POINTERS,
    ROWS,
    SECOND,
    SECOND_OPEN,
    VERSIONS,
)
from tieout.catalogue.registry import ctes, query, shown
from tieout.functions import paise
from tieout.model import TAGS
from tieout.operators import cut as C
from tieout.operators import deliveries as D
from tieout.operators import gate, gold, release
from tieout.sources import derived as S
from tieout.sources.tables import given

FACT = """fact AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS txn_id, CAST(o_custkey AS VARCHAR) AS customer_id,
         o_orderpriority AS business_line, CAST(round(o_totalprice * 100) AS BIGINT) AS amount_paise,
         CASE o_orderstatus WHEN 'F' THEN 'SETTLED' WHEN 'O' THEN 'INITIATED'
              ELSE 'PARTIALLY_SETTLED' END AS status,
         CAST(o_orderdate AS DATE) AS business_date
  FROM orders)"""
FAULTY = """faulty AS (
  SELECT CASE WHEN business_line = '1-URGENT' AND status = 'PARTIALLY_SETTLED'
              THEN 'x' || txn_id ELSE txn_id END AS txn_id,
         customer_id, business_line,
         CASE WHEN business_line = '5-LOW' AND status = 'INITIATED' AND amount_paise > 40000000
              THEN -amount_paise ELSE amount_paise END AS amount_paise,
         status,
         CASE WHEN business_line = '3-MEDIUM' AND business_date >= DATE '2001-07-25'
              THEN business_date + 30 ELSE business_date END AS business_date
  FROM fact WHERE amount_paise >= 200000)"""


def totals(source: str, name: str) -> str:
    return f"""{name} AS (
  SELECT business_line, business_date, count(*) AS row_count,
         CAST(sum(amount_paise) AS BIGINT) AS amount_paise,
         count(DISTINCT txn_id) AS distinct_keys,
         CAST(sum(('0x' || substr(md5(txn_id || '|' || amount_paise), 1, 8))::BIGINT) AS BIGINT)
           AS fingerprint
  FROM {source} GROUP BY ALL)"""


MEASURES = ("row_count", "amount_paise", "distinct_keys", "fingerprint")
SIDES = ", ".join(f"{s}.{m} AS {s}_{m}" for m in MEASURES for s in "cr")
BOTH = f"""compared AS (
  SELECT business_line, business_date, {SIDES}
  FROM candidate c FULL JOIN reference r USING (business_line, business_date)),
broken AS (
  SELECT * FROM compared
  WHERE {" OR ".join(f"c_{m} IS DISTINCT FROM r_{m}" for m in MEASURES)})"""
REASON = (
    "business_line || ' ' || business_date || ': ' || "
    + " || ', ' || ".join(
        f"'{m} ' || coalesce(CAST(c_{m} AS VARCHAR), 'None') || ' vs ' || "
        f"coalesce(CAST(r_{m} AS VARCHAR), 'None')"
        for m in MEASURES
    )
)
BROKEN = ctes(FACT, FAULTY, totals("faulty", "candidate"), totals("fact", "reference"), BOTH)


def _totals(rows):
    return gate.cell_totals(rows, S.FACT_KEYS)


def _breaks(spark, sf):
    return gate.breaks(_totals(S.faulty_fact(spark, sf)), _totals(S.fact(spark, sf)))


@query(
    "gate_fingerprint",
    ctes(FACT)
    + """SELECT txn_id, ('0x' || substr(md5(txn_id || '|' || amount_paise), 1, 8))::BIGINT
         AS fingerprint FROM fact""",
)
def fingerprint(spark, sf):
    return gate.fingerprint(S.fact(spark, sf), S.FACT_KEYS).select("txn_id", "fingerprint")


@query("gate_cell_totals", ctes(FACT, totals("fact", "cells")) + "SELECT * FROM cells")
def cell_totals(spark, sf):
    return _totals(S.fact(spark, sf))


@query("gate_breaks", BROKEN + f"SELECT *, {REASON} AS reason FROM broken")
def breaks(spark, sf):
    return _breaks(spark, sf)


@query(
    "gate_breaks_of_status",
    ctes(FACT)
    + """SELECT DISTINCT business_line, business_date, 'fingerprint' AS differs FROM fact
WHERE status = 'PARTIALLY_SETTLED' AND business_line <> '1-URGENT'
   OR status = 'INITIATED' AND business_line = '1-URGENT' AND amount_paise < 2000000""",
)
def breaks_of_status(spark, sf):
    """Some statuses lost, some changed: rows, amounts and keys still tie."""
    fact = S.fact(spark, sf)
    part = (F.col("status") == "PARTIALLY_SETTLED") & (F.col("business_line") != "1-URGENT")
    small = (F.col("status") == "INITIATED") & (F.col("amount_paise") < 2_000_000)
    urgent = small & (F.col("business_line") == "1-URGENT")
    wrong = F.when(urgent, "SETTLED").when(~part, F.col("status"))
    extra = ("customer_id", "status")
    sides = [
        gate.cell_totals(side, S.FACT_KEYS, extra=extra)
        for side in (fact.withColumn("status", wrong), fact)
    ]
    measures = [
        F.when(~F.col(f"c_{m}").eqNullSafe(F.col(f"r_{m}")), F.lit(m)) for m in V.MEASURES
    ]
    return gate.breaks(*sides).select(
        "business_line", "business_date", F.concat_ws(",", *measures).alias("differs")
    )


@query(
    "gate_classify",
    BROKEN
    + """SELECT business_line, business_date,
       CASE WHEN c_row_count IS DISTINCT FROM r_row_count THEN 'rows dropped or added'
            WHEN c_amount_paise IS DISTINCT FROM r_amount_paise THEN 'units, sign or rounding'
            WHEN c_distinct_keys IS DISTINCT FROM r_distinct_keys THEN 'duplicate keys'
            ELSE 'money on the wrong key' END AS fault
FROM broken""",
)
def classify(spark, sf):
    return gate.classify(_breaks(spark, sf)).select("business_line", "business_date", "fault")


@query(
    "gate_cells_compared",
    BROKEN
    + """SELECT (SELECT count(*) FROM compared) AS cells_compared,
       (SELECT count(*) FROM broken) AS breaks""",
)
def cells_compared(spark, sf):
    """How much a verdict rests on: a comparison of nothing passes too, and says so."""
    candidate, reference = _totals(S.faulty_fact(spark, sf)), _totals(S.fact(spark, sf))
    return gate.cells_compared(candidate, reference)


@query(
    "gate_row_diff",
    ctes(FACT, FAULTY)
    + """SELECT txn_id, CASE WHEN c.txn_id IS NOT NULL THEN CAST(1 AS BIGINT) END AS c_rows,
       c.amount_paise AS c_amount_paise,
       CASE WHEN r.txn_id IS NOT NULL THEN CAST(1 AS BIGINT) END AS r_rows, r.amount_paise AS r_amount_paise,
       CASE WHEN c.txn_id IS NULL THEN 'missing in candidate'
            WHEN r.txn_id IS NULL THEN 'only in candidate' ELSE 'amount differs' END AS difference
FROM faulty c FULL JOIN fact r USING (txn_id)
WHERE c.amount_paise IS DISTINCT FROM r.amount_paise""",
)
def row_diff(spark, sf):
    return gate.row_diff(S.faulty_fact(spark, sf), S.fact(spark, sf), S.FACT_KEYS)


@query(
    "gate_row_diff_of_repeated_keys",
    """WITH c AS (
  SELECT l_orderkey, l_linenumber, count(*) AS n,
         CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS paise
  FROM lineitem GROUP BY ALL),
r AS (
  SELECT l_orderkey, l_linenumber, count(*) AS n,
         CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS paise
  FROM lineitem WHERE l_returnflag <> 'R' GROUP BY ALL)
SELECT l_orderkey, l_linenumber, c.n AS c_rows, c.paise AS c_amount_paise,
       r.n AS r_rows, r.paise AS r_amount_paise,
       CASE WHEN r.n IS NULL THEN 'only in candidate' ELSE 'row count differs' END AS difference
FROM c FULL JOIN r USING (l_orderkey, l_linenumber) WHERE c.n IS DISTINCT FROM r.n""",
)
def row_diff_of_repeated_keys(spark, sf):
    """Line numbers repeat within orders; the reference lacks the returned lines."""
    lines = given(spark, sf, "lineitem").withColumn("amount_paise", paise("l_extendedprice"))
    return gate.row_diff(
        lines, lines.where("l_returnflag <> 'R'"), ("l_orderkey", "l_linenumber")
    )


# The dates of a build: a late change touched partly settled rows; dates before 1996 are closed.
WINDOW = """touched AS (
  SELECT business_date FROM fact WHERE status = 'PARTIALLY_SETTLED'
  UNION SELECT DATE '2001-08-02' UNION SELECT DATE '2001-08-03'),
rebuilt AS (
  SELECT business_date FROM touched
  WHERE business_date NOT IN (
    SELECT business_date FROM fact WHERE business_date < DATE '1996-01-01'
    EXCEPT SELECT business_date FROM fact WHERE business_line = '1-URGENT'))"""


def rebuilt(spark, sf):
    fact = S.fact(spark, sf)
    closed = fact.where(F.col("business_date") < F.lit(date(1996, 1, 1)))
    return gate.rebuild_window(
        fact.where("status = 'PARTIALLY_SETTLED'"),
        date(2001, 8, 3),
        closed.select("business_date").distinct(),
        fact.where("business_line = '1-URGENT'").select("business_date").distinct(),
    )


def rebuilt_dates(spark, sf) -> list[date]:
    """At most one entry per date of the calendar."""
    return sorted(r[0] for r in rebuilt(spark, sf).collect())


@query(
    "gate_candidate_window",
    ctes(FACT, WINDOW)
    + """SELECT *, 'orders@2001-07-31' AS version_label FROM fact
WHERE business_date IN (SELECT business_date FROM rebuilt)""",
)
def candidate_window(spark, sf):
    built = gold.PinnedInput("orders", "2001-07-31", S.fact(spark, sf))
    rows = gate.in_window(gold.build_fact([built]), rebuilt_dates(spark, sf))
    return rows.withColumn("version_label", F.lit(_text(gold.version_label([built]))))


def _text(label: dict[str, str]) -> str:
    return ", ".join(f"{k}@{v}" for k, v in sorted(label.items()))


def _delivery_inputs(spark, sf):
    required = S.file_rows(spark, sf).select("partner", "feed", "posting_date").distinct()
    return D.input_status(required, S.second_published(spark, sf))


@query(
    "gate_incomplete_inputs",
    POINTERS
    + f""", {SECOND_OPEN}
SELECT DISTINCT 'input not complete: ' || d.partner || '.' || d.feed || ' (no version for '
       || CAST(d.posting_date AS VARCHAR) || ')' AS reason
FROM versions d LEFT JOIN opened o USING (partner, feed, posting_date) WHERE o.partner IS NULL""",
)
def incomplete_inputs(spark, sf):
    return gate.incomplete_inputs(_delivery_inputs(spark, sf)).select("reason")


@query(
    "gate_reasons_inputs_first",
    ctes(
        ROWS, PARTS, VERSIONS, FIRST, SECOND, SECOND_OPEN, FACT, FAULTY,
        totals("faulty", "candidate"), totals("fact", "reference"), BOTH,
        """waiting AS (
  SELECT DISTINCT 'input not complete: ' || d.partner || '.' || d.feed || ' (no version for '
         || CAST(d.posting_date AS VARCHAR) || ')' AS reason
  FROM versions d LEFT JOIN opened o USING (partner, feed, posting_date)
  WHERE o.partner IS NULL)""",
    )
    + f"""SELECT reason FROM waiting
UNION ALL
SELECT {REASON} FROM broken WHERE NOT EXISTS (SELECT 1 FROM waiting)""",
)
def reasons_inputs_first(spark, sf):
    """While inputs are missing the faulty candidate is not even compared."""
    return gate.reasons(
        S.faulty_fact(spark, sf), S.fact(spark, sf), _delivery_inputs(spark, sf), S.FACT_KEYS
    )


@query(
    "gate_reasons_unusable",
    ctes(FACT)
    + """SELECT 'candidate: ' || count(*) || ' rows without amount_paise' AS reason
FROM fact WHERE status = 'PARTIALLY_SETTLED' HAVING count(*) > 0
UNION ALL
SELECT 'reference: ' || count(*) || ' rows without business_date' FROM fact
WHERE business_line = '5-LOW' HAVING count(*) > 0""",
)
def reasons_unusable(spark, sf):
    """Rows without an amount, and rows whose missing date would leave every window."""
    fact = S.fact(spark, sf)
    amount = F.when(F.col("status") != "PARTIALLY_SETTLED", F.col("amount_paise"))
    day = F.when(F.col("business_line") != "5-LOW", F.col("business_date"))
    found = gate.reasons(
        fact.withColumn("amount_paise", amount), fact.withColumn("business_date", day),
        _delivery_inputs(spark, sf).where("complete"), S.FACT_KEYS,
    )
    return found.where(F.col("reason").rlike("^(candidate|reference): "))


@query("gate_reasons", BROKEN + f"SELECT {REASON} AS reason FROM broken")
def reasons(spark, sf):
    """Every input is there; the candidate holds because it does not tie."""
    arrived = _delivery_inputs(spark, sf).where("complete")
    return gate.reasons(S.faulty_fact(spark, sf), S.fact(spark, sf), arrived, S.FACT_KEYS)


@query(
    "gate_reconcile_closed",
    ctes(
        FACT, FAULTY, totals("fact", "candidate"),
        "reported AS (SELECT * FROM faulty WHERE business_line <> '2-HIGH')",
        totals("reported", "reference"),
    )
    + f"""SELECT business_line, business_date, {SIDES},
       CASE WHEN business_date >= DATE '2001-06-01' THEN 'checked against silver'
            WHEN r.row_count IS NULL THEN 'no control totals'
            WHEN c.row_count = r.row_count AND c.amount_paise = r.amount_paise
             AND c.distinct_keys = r.distinct_keys AND c.fingerprint = r.fingerprint
            THEN 'reconciled' ELSE 'break' END AS status
FROM candidate c FULL JOIN reference r USING (business_line, business_date)""",
)
def reconcile_closed(spark, sf):
    """One line's source reports nothing; the others report totals with faults in them."""
    totals = _totals(S.fact(spark, sf))
    reported = _totals(S.faulty_fact(spark, sf).where("business_line <> '2-HIGH'"))
    closed = (
        S.fact(spark, sf)
        .select("business_date")
        .distinct()
        .where(F.col("business_date") < F.lit(date(2001, 6, 1)))
    )
    return gate.reconcile_closed(totals, reported, closed)


@query(
    "gate_overflow_cells",
    ctes(FACT)
    + """SELECT business_line, business_date, count(*) AS row_count,
       CAST(sum(CAST(amount_paise AS HUGEINT) * 100000000000) AS VARCHAR) AS total,
       CAST(max(CAST(amount_paise AS HUGEINT) * 100000000000) AS VARCHAR) AS largest
FROM fact GROUP BY ALL
HAVING sum(CAST(amount_paise AS HUGEINT) * 100000000000) > 9223372036854775807""",
)
def overflow_cells(spark, sf):
    """Amounts converted once too often: each still fits, many cells do not."""
    rows = S.fact(spark, sf).withColumn("amount_paise", F.col("amount_paise") * 100_000_000_000)
    found = gate.overflow_cells(rows)
    return found.withColumns({c: F.col(c).cast("string") for c in ("total", "largest")})


HOLDS_AT = datetime(2001, 1, 9, 12, tzinfo=UTC)


@query(
    "gate_open_holds",
    """WITH held AS (
  SELECT o_orderpriority AS table_name, 2001 AS release_id, min(o_orderdate) AS created_at
  FROM orders WHERE year(o_orderdate) = 2001 AND o_orderpriority IN ('1-URGENT', '5-LOW')
  GROUP BY ALL)
SELECT table_name, CAST(release_id AS BIGINT) AS release_id,
       strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at,
       CAST(floor(date_diff('second', created_at, TIMESTAMP '2001-01-09 12:00:00') / 3600)
            AS BIGINT) AS age_hours,
       CASE WHEN date_diff('second', created_at, TIMESTAMP '2001-01-09 12:00:00') > 1209600
            THEN 'expired'
            WHEN date_diff('second', created_at, TIMESTAMP '2001-01-09 12:00:00') > 86400
            THEN 'escalate' ELSE 'open' END AS status
FROM held""",
)
def open_holds(spark, sf):
    found = gate.open_holds(S.release_log(spark, sf), HOLDS_AT)
    return found.withColumns(shown("created_at"))


@query("gate_rebuild_window", ctes(FACT, WINDOW) + "SELECT business_date FROM rebuilt")
def rebuild_window(spark, sf):
    return rebuilt(spark, sf)


# ---- releases


@query(
    "release_read_head",
    ctes(FACT)
    + """SELECT txn_id, amount_paise FROM fact
WHERE business_date < DATE '1998-01-01' OR status <> 'PARTIALLY_SETTLED'""",
)
def read_head(spark, sf):
    """A date whose rows were all corrected away is empty, not left as it was."""
    rows = release.read(S.released_rows(spark, sf), S.manifest(spark, sf), S.TABLE)
    return rows.select("txn_id", "amount_paise")


@query(
    "release_read_pinned",
    ctes(FACT) + "SELECT txn_id, amount_paise FROM fact",
)
def read_pinned(spark, sf):
    rows = release.read(S.released_rows(spark, sf), S.manifest(spark, sf), S.TABLE, 1)
    return rows.select("txn_id", "amount_paise")


@query(
    "release_read_known_at",
    ctes(FACT) + "SELECT txn_id, amount_paise FROM fact",
)
def read_known_at(spark, sf):
    moment = datetime(2001, 9, 1, 6, tzinfo=UTC)
    rows = S.released_rows(spark, sf)
    return release.read_known_at(rows, S.manifest(spark, sf), S.TABLE, moment).select(
        "txn_id", "amount_paise"
    )


@query(
    "release_publish",
    """SELECT DISTINCT 'fact_transaction' AS table_name,
       CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS slice, CAST(r AS BIGINT) AS release_id,
       CASE WHEN r = 1 THEN '2001-09-01 00:00:00' ELSE '2001-09-02 00:00:00' END AS valid_from,
       CASE WHEN r = 1 AND o_orderdate >= DATE '1998-01-01' THEN '2001-09-02 00:00:00' END
         AS valid_to
FROM orders, (VALUES (1), (2)) v(r)
WHERE r = 1 OR o_orderdate >= DATE '1998-01-01'""",
)
def publish(spark, sf):
    return S.manifest(spark, sf).withColumns(shown("valid_from", "valid_to"))


@query(
    "release_head",
    """SELECT o_orderpriority AS table_name, CAST(max(year(o_orderdate)) AS BIGINT) AS release_id
FROM orders
WHERE NOT (year(o_orderdate) = 2001 AND o_orderpriority IN ('1-URGENT', '5-LOW'))
GROUP BY ALL""",
)
def head(spark, sf):
    return release.head(S.release_log(spark, sf))


@query(
    "release_publishable",
    """WITH candidates AS (
  SELECT o_orderpriority AS table_name, year(o_orderdate) * 100 + month(o_orderdate) AS release_id,
         CASE WHEN month(o_orderdate) <= 3 THEN year(o_orderdate) ELSE year(o_orderdate) - 1 END
           AS parent_release,
         min(o_orderdate) AS created_at
  FROM orders GROUP BY ALL),
heads AS (
  SELECT o_orderpriority AS table_name, max(year(o_orderdate)) AS head FROM orders
  WHERE NOT (year(o_orderdate) = 2001 AND o_orderpriority IN ('1-URGENT', '5-LOW'))
  GROUP BY ALL)
SELECT table_name, CAST(release_id AS BIGINT) AS release_id,
       CAST(parent_release AS BIGINT) AS parent_release
FROM candidates JOIN heads USING (table_name) WHERE parent_release = head
QUALIFY row_number() OVER (PARTITION BY table_name ORDER BY created_at, release_id) = 1""",
)
def publishable(spark, sf):
    """A candidate a month; those of a year's first months were built on a newer release."""
    year, month = F.year("o_orderdate"), F.month("o_orderdate")
    parent = F.when(month <= 3, year).otherwise(year - 1)
    candidates = (
        given(spark, sf, "orders")
        .groupBy(
            F.col("o_orderpriority").alias("table_name"),
            (year * 100 + month).cast("bigint").alias("release_id"),
            parent.cast("bigint").alias("parent_release"),
        )
        .agg(F.min("o_orderdate").alias("created_at"))
    )
    return release.publishable(candidates, release.head(S.release_log(spark, sf)))


@query(
    "release_label",
    """WITH years AS (
  SELECT o_orderpriority AS table_name, CAST(year(o_orderdate) AS BIGINT) AS release_id,
         CAST(max(o_orderkey) AS VARCHAR) AS o, CAST(max(o_custkey) AS VARCHAR) AS c
  FROM orders GROUP BY ALL)
SELECT table_name, release_id, 'orders' AS source, o AS at FROM years
UNION ALL SELECT table_name, release_id, 'customers', c FROM years""",
)
def label(spark, sf):
    return release.label(S.release_log(spark, sf))


@query(
    "release_tag",
    """SELECT o_orderpriority AS table_name, 'month_end_2001_08' AS tag,
       CAST(CASE WHEN o_orderpriority = '3-MEDIUM' THEN 1999
            ELSE max(year(o_orderdate)) END AS BIGINT) AS release_id,
       CASE WHEN o_orderpriority = '3-MEDIUM' THEN '2006-08-30 00:00:00'
            ELSE '2006-09-01 00:00:00' END AS keep_until
FROM orders
WHERE NOT (year(o_orderdate) = 2001 AND o_orderpriority IN ('1-URGENT', '5-LOW'))
GROUP BY o_orderpriority""",
)
def tag(spark, sf):
    """One table was tagged before; its tag does not move."""
    log = S.release_log(spark, sf)
    earlier = log.where("table_name = '3-MEDIUM' AND release_id <= 1999")
    nothing = spark.createDataFrame([], TAGS)
    name = "month_end_2001_08"
    before = release.tag(nothing, earlier, name, datetime(2001, 8, 30, tzinfo=UTC))
    after = release.tag(before, log, name, datetime(2001, 9, 1, tzinfo=UTC))
    return after.drop("tagged_at").withColumns(shown("keep_until"))


@query(
    "gold_build_fact",
    UP_TO_CUT
    + f""", {FACT}, versions AS (
  SELECT o_orderstatus AS partner, CAST(o_orderdate AS DATE) AS posting_date,
         1 + o_orderkey % 2 AS seq
  FROM orders GROUP BY ALL
  HAVING count(DISTINCT o_custkey % 2) >= max(1 + o_custkey % 2)),
built AS (
  SELECT txn_id, customer_id, business_line, amount_paise, status, business_date FROM fact
  WHERE 'tx-' || txn_id IN (SELECT transaction_id FROM tx
                            WHERE ended AND position <= (SELECT position FROM cut))
  UNION ALL
  SELECT 'file-' || o_orderkey, partner, 'orders', CAST(round(o_totalprice * 100) AS BIGINT),
         'SETTLED', posting_date
  FROM orders JOIN versions ON partner = o_orderstatus
   AND posting_date = CAST(o_orderdate AS DATE) AND seq = 1 + o_orderkey % 2
  WHERE seq = 1),
sources AS (
  SELECT DISTINCT o_orderstatus || '.orders@2001-09-01 12:00:00' AS read_at FROM orders
  UNION ALL SELECT 'sales@' || position FROM cut)
SELECT *, (SELECT string_agg(read_at, ', ' ORDER BY read_at) FROM sources) AS version_label
FROM built""",
)
def build_fact(spark, sf):
    """A database at its cut and partner files as known at one instant, under one label."""
    (cut,) = found_cut(spark, sf).collect()
    moment = S.FIRST_PUBLISH + timedelta(hours=12)
    inputs = pinned_inputs(spark, sf, cut, S.second_published(spark, sf), moment)
    label = _text(gold.version_label(inputs))
    return gold.build_fact(inputs).withColumn("version_label", F.lit(label))


def pinned_inputs(spark, sf, cut, pointer, moment) -> list[gold.PinnedInput]:
    """What the fact is built from: orders up to a cut, each partner feed at one instant."""
    orders = S.fact(spark, sf).withColumn(
        "transaction_id", F.concat(F.lit("tx-"), F.col("txn_id"))
    )
    files = S.file_rows(spark, sf)
    # One input per feed that a contract declares.
    feeds = sorted(tuple(r) for r in files.select("partner", "feed").distinct().collect())
    partners = [
        gold.at_instant(
            f"{partner}.{feed}",
            files.where((F.col("partner") == partner) & (F.col("feed") == feed)),
            pointer,
            moment,
        ).shaped(_settlements)
        for partner, feed in feeds
    ]
    ends = C.new_ends(S.transactions(spark, sf))
    return [gold.at_cut("sales", orders, ends, cut), *partners]


def _settlements(files):
    return files.select(
        F.concat(F.lit("file-"), "settlement_id").alias("txn_id"),
        F.col("partner").alias("customer_id"),
        F.col("feed").alias("business_line"),
        "amount_paise",
        F.lit("SETTLED").alias("status"),
        F.col("posting_date").alias("business_date"),
    )
