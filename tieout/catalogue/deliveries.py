from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import functions as F

from tieout import fixed_values as V
from tieout.catalogue.registry import ctes, query, shown
from tieout.durable import materialise
from tieout.functions import paise
from tieout.model import DELIVERY, VERSION, FeedContract
from tieout.operators import deliveries as D
from tieout.sources import derived as S
from tieout.sources.tables import given

ROWS = """file_rows AS (
  SELECT o_orderstatus AS partner, 'orders' AS feed, CAST(o_orderdate AS DATE) AS posting_date,
         1 + o_orderkey % 2 AS sequence_number, CAST(1 + o_custkey % 2 AS INTEGER) AS part_number,
         o_orderstatus || '-' || CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || '-v'
           || (1 + o_orderkey % 2) || '-p' || (1 + o_custkey % 2) AS file_id,
         CAST(o_orderkey AS VARCHAR) AS settlement_id,
         CAST(round(o_totalprice * 100) AS BIGINT) AS amount_paise
  FROM orders)"""
PARTS = """parts AS (
  SELECT file_id, partner, feed, posting_date, sequence_number, part_number,
         count(*) AS row_count, CAST(sum(amount_paise) AS BIGINT) AS amount_paise,
         min(amount_paise) AS smallest
  FROM file_rows GROUP BY ALL)"""
VERSIONS = """versions AS (
  SELECT partner, feed, posting_date, sequence_number, count(DISTINCT part_number) AS parts,
         max(part_number) AS part_count, CAST(sum(row_count) AS BIGINT) AS row_count
  FROM parts GROUP BY ALL)"""
FIRST = """first_pointer AS (
  SELECT * FROM versions WHERE sequence_number = 1 AND parts >= part_count)"""
SECOND = """second_pointer AS (
  SELECT partner, feed, posting_date, sequence_number, '2001-09-02 00:00:00' AS valid_from,
         NULL AS valid_to, 'again' AS approved_by
  FROM versions WHERE sequence_number = 2 AND parts >= part_count
  UNION ALL
  SELECT f.partner, f.feed, f.posting_date, f.sequence_number, '2001-09-01 00:00:00',
         CASE WHEN s.partner IS NOT NULL THEN '2001-09-02 00:00:00' END, 'start'
  FROM first_pointer f LEFT JOIN versions s
    ON s.partner = f.partner AND s.feed = f.feed AND s.posting_date = f.posting_date
   AND s.sequence_number = 2 AND s.parts >= s.part_count)"""
USUAL = """usual AS (
  SELECT d.partner, d.feed, d.posting_date, median(p.row_count) AS usual_rows
  FROM (SELECT DISTINCT partner, feed, posting_date FROM versions) d
  JOIN first_pointer p ON p.partner = d.partner AND p.feed = d.feed
   AND d.posting_date - p.posting_date IN (7, 14, 21, 28)
  GROUP BY ALL)"""
POINTERS = ctes(ROWS, PARTS, VERSIONS, FIRST, SECOND)
SECOND_OPEN = """opened AS (
  SELECT partner, feed, posting_date, sequence_number FROM second_pointer
  WHERE valid_to IS NULL)"""


# ---- receiving


@query(
    "deliveries_receive_refuses",
    ctes(ROWS, PARTS)
    + """SELECT file_id, partner, 1 AS attempt,
       CASE WHEN sequence_number = 2 THEN 'unsafe partner' ELSE '' END AS problems FROM
  (SELECT file_id, sequence_number,
          CASE WHEN sequence_number = 2 THEN partner || ' x' ELSE partner END AS partner FROM parts)
UNION ALL
SELECT file_id, partner, 2,
       CASE WHEN sequence_number = 2 THEN '' ELSE 'file id is taken by another file' END
FROM parts""",
)
def receive_refuses(spark, sf):
    """Every part twice, the second time with other bytes; first second versions are misnamed."""
    parts = S.file_parts(spark, sf).withColumn("problems", F.lit(""))
    odd = F.col("sequence_number") == 2
    misnamed = F.when(odd, F.concat("partner", F.lit(" x"))).otherwise(F.col("partner"))
    first = parts.withColumns({"partner": misnamed, "attempt": F.lit(1)})
    first = first.withColumn("problems", F.when(odd, "of old").otherwise(F.lit("")))
    again = parts.withColumns({"file_hash": F.md5("file_hash"), "attempt": F.lit(2)})
    both = first.unionByName(again).withColumn(
        "arrival", F.concat_ws("#", F.col("attempt").cast("string"), "file_id")
    )
    nothing = S.staged_register(spark, sf).limit(0)
    refused = D.refuse(both, nothing, V.IDENTIFIERS)
    text = F.regexp_replace("problems", "^of old(; )?", "")
    return refused.select("file_id", "partner", "attempt", text.alias("problems"))


LINE_FEED = FeedContract(keys=("settlement_id",))


def _line_files(spark, sf):
    """Line items as a partner would send them: one file per flag, status and ship date.

    Some amounts are missing, some rows carry another date, and suppliers repeat within a file.
    """
    date = F.col("l_shipdate").cast("date")
    absent = (F.col("l_discount") == 0.1) & (F.col("l_tax") == 0.08)
    rows = given(spark, sf, "lineitem").select(
        F.concat_ws("-", "l_returnflag", "l_linestatus", date.cast("string")).alias("file_id"),
        F.col("l_suppkey").cast("string").alias("settlement_id"),
        F.when(~absent, paise("l_extendedprice")).alias("amount_paise"),
        F.when(F.col("l_quantity") == 50, F.date_add(date, 1))
        .when(F.col("l_quantity") == 49, None)
        .otherwise(date)
        .alias("posting_date"),
        date.alias("sent_for"),
    )
    parts = rows.groupBy("file_id", F.col("sent_for").alias("posting_date")).agg(
        F.count_if(F.col("amount_paise") > 200_000).alias("row_count"),
        F.coalesce(F.sum("amount_paise"), F.lit(0)).alias("amount_paise"),
    )
    return rows.drop("sent_for"), parts


@query(
    "deliveries_check_parts",
    """WITH line_files AS (
  SELECT l_returnflag || '-' || l_linestatus || '-' || CAST(CAST(l_shipdate AS DATE) AS VARCHAR)
           AS file_id,
         l_suppkey, CAST(l_shipdate AS DATE) AS sent_for,
         CASE WHEN l_discount = 0.1::DOUBLE AND l_tax = 0.08::DOUBLE THEN NULL
              ELSE CAST(round(l_extendedprice * 100) AS BIGINT) END AS amount, l_quantity
  FROM lineitem),
totals AS (
  SELECT file_id, sent_for, count(*) AS n, sum(amount) AS paise,
         count(DISTINCT l_suppkey) AS keys, count(*) - count(amount) AS no_amount,
         count(*) FILTER (l_quantity IN (49, 50)) AS elsewhere,
         count(*) FILTER (amount > 200000) AS claimed
  FROM line_files GROUP BY ALL)
SELECT file_id, sent_for AS posting_date,
       concat_ws('; ',
         CASE WHEN n <> claimed THEN 'row_count is ' || n || ' instead of ' || claimed END,
         CASE WHEN keys <> n THEN 'distinct settlement_id is ' || keys || ' instead of ' || n END,
         CASE WHEN no_amount > 0
              THEN 'rows without amount_paise is ' || no_amount || ' instead of 0' END,
         CASE WHEN elsewhere > 0
              THEN 'rows of another posting_date is ' || elsewhere || ' instead of 0' END
       ) AS problems
FROM totals""",
)
def check_parts(spark, sf):
    rows, parts = _line_files(spark, sf)
    return D.check_parts(rows, parts, LINE_FEED).select("file_id", "posting_date", "problems")


@query(
    "deliveries_unsafe_identifiers",
    """SELECT CAST(c_custkey AS VARCHAR) AS file_id,
       concat_ws(', ', 'name', CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'segment' END) AS unsafe
FROM customer
UNION ALL
SELECT 'S' || s_suppkey, 'name' FROM supplier""",
)
def unsafe_identifiers(spark, sf):
    """Names carry '#'; some segments end in a line break or a space, which is not safe either."""
    customers = given(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("file_id"),
        F.col("c_name").alias("name"),
        F.when(
            F.col("c_mktsegment") == "HOUSEHOLD", F.concat("c_mktsegment", F.lit("\n"))
        ).otherwise(F.col("c_mktsegment")).alias("segment"),
    )
    suppliers = given(spark, sf, "supplier").select(
        F.concat(F.lit("S"), F.col("s_suppkey")).alias("file_id"),
        F.col("s_name").alias("name"),
        F.lit("supplier").alias("segment"),
    )
    found = D.unsafe_identifiers(customers.unionByName(suppliers), ("file_id", "name", "segment"))
    return found.select("file_id", "unsafe")


def _arrivals(spark, sf):
    """All parts, then those of one partner again. Parts before 1996 are already registered."""
    parts = S.file_parts(spark, sf)
    first = parts.withColumn("arrival", F.concat(F.lit("1-"), "file_id"))
    again = parts.where("partner = 'F'").withColumn("arrival", F.concat(F.lit("2-"), "file_id"))
    register = S.staged_register(spark, sf).where(F.year("posting_date") < 1996)
    return first.unionByName(again), register


@query(
    "deliveries_split_duplicates",
    ctes(ROWS, PARTS)
    + """SELECT '1-' || file_id AS arrival, file_id, year(posting_date) < 1996 AS duplicate
FROM parts
UNION ALL
SELECT '2-' || file_id, file_id, true FROM parts WHERE partner = 'F'""",
)
def split_duplicates(spark, sf):
    taken, duplicates = D.split_duplicates(*_arrivals(spark, sf))
    kept = taken.withColumn("duplicate", F.lit(False))
    return kept.unionByName(duplicates.withColumn("duplicate", F.lit(True))).select(
        "arrival", "file_id", "duplicate"
    )


@query(
    "deliveries_receive",
    ctes(ROWS, PARTS)
    + """, first AS (
  SELECT *, CASE WHEN year(posting_date) < 1996 THEN 'DUPLICATE'
                 WHEN smallest < 1000000 THEN 'REJECTED' ELSE 'STAGED' END AS state
  FROM parts),
problems AS (
  SELECT file_id, CASE WHEN sum(amount_paise) FILTER (amount_paise >= 1000000)
                         IS DISTINCT FROM sum(amount_paise)
    THEN 'amount_paise is ' || CAST(sum(amount_paise) AS BIGINT) || ' instead of '
      || coalesce(CAST(sum(amount_paise) FILTER (amount_paise >= 1000000) AS BIGINT), 0)
    ELSE '' END AS problems
  FROM file_rows GROUP BY file_id)
SELECT '1-' || file_id AS arrival, state, problems FROM first JOIN problems USING (file_id)
UNION ALL
SELECT '2-' || file_id, CASE state WHEN 'REJECTED' THEN 'REJECTED' ELSE 'DUPLICATE' END, problems
FROM first JOIN problems USING (file_id) WHERE partner = 'F'""",
)
def receive(spark, sf):
    """Duplicates first, then the whole-part check. Trailers leave out small amounts."""
    arriving, register = _arrivals(spark, sf)
    rows = S.file_rows(spark, sf)
    small = F.coalesce(F.sum(F.when(F.col("amount_paise") >= 1_000_000, F.col("amount_paise"))),
                       F.lit(0))
    trailers = rows.groupBy("file_id").agg(small.alias("amount_paise"))
    parts = arriving.drop("amount_paise").join(trailers, "file_id")
    checked = D.check_parts(
        rows.select("file_id", "settlement_id", "amount_paise", "posting_date"), parts, S.FEED
    )
    return D.classify_arrivals(checked, register).select("arrival", "state", "problems")


@query(
    "deliveries_tag_rows",
    ctes(ROWS)
    + """SELECT partner, feed, sequence_number, file_id, settlement_id, amount_paise, posting_date
FROM file_rows""",
)
def tag_rows(spark, sf):
    rows = S.file_rows(spark, sf).select(
        "file_id", "settlement_id", "amount_paise", "posting_date"
    )
    return D.tag_rows(rows, S.file_parts(spark, sf))


@query(
    "deliveries_replace_file_rows",
    ctes(ROWS)
    + """SELECT file_id, settlement_id,
       CASE WHEN posting_date >= DATE '1999-01-01' THEN amount_paise + 1
            ELSE amount_paise END AS amount_paise
FROM file_rows""",
)
def replace_file_rows(spark, sf):
    """Stored files up to 2000, files from 1999 arriving again: the overlap is replaced."""
    rows = S.file_rows(spark, sf)
    wanted = ("file_id", "settlement_id", "amount_paise", "posting_date")
    stored = rows.where(F.year("posting_date") <= 2000).select(*wanted)
    incoming = (
        rows.where(F.year("posting_date") >= 1999)
        .withColumn("amount_paise", F.col("amount_paise") + 1)
        .select(*wanted)
    )
    files = incoming.select("file_id").distinct()
    return D.replace_file_rows(stored, incoming, files).drop("posting_date")


@query(
    "deliveries_record",
    ctes(ROWS, PARTS)
    + """SELECT file_id,
       CASE WHEN year(posting_date) >= 1999 THEN 'REJECTED' ELSE 'STAGED' END AS state,
       CASE WHEN year(posting_date) >= 1999 THEN row_count + 1 ELSE row_count END AS row_count
FROM parts""",
)
def record(spark, sf):
    register = S.staged_register(spark, sf)
    resent = register.where(F.year("posting_date") >= 1999).withColumns(
        {"state": F.lit(V.REJECTED), "row_count": F.col("row_count") + 1}
    )
    known = register.where(F.year("posting_date") <= 2000)
    return D.record(known, resent).select("file_id", "state", "row_count")


# ---- publishing


@query(
    "deliveries_version_completeness",
    ctes(ROWS, PARTS, VERSIONS)
    + """SELECT partner, feed, posting_date, sequence_number, parts, part_count, row_count,
       parts >= part_count AS whole,
       CASE WHEN parts >= part_count THEN '' ELSE parts || ' of ' || part_count || ' parts' END
         AS reason
FROM versions""",
)
def version_completeness(spark, sf):
    return D.version_completeness(S.staged_register(spark, sf))


@query("deliveries_usual_rows", ctes(ROWS, PARTS, VERSIONS, FIRST, USUAL) + "SELECT * FROM usual")
def usual_rows(spark, sf):
    register, pointer = S.first_published(spark, sf)
    return D.usual_rows(register.select(*DELIVERY).distinct(), pointer, register)


@query(
    "deliveries_truncation_holds",
    ctes(ROWS, PARTS, VERSIONS, FIRST, USUAL)
    + """SELECT v.partner, v.feed, v.posting_date, v.sequence_number, v.row_count, u.usual_rows,
       coalesce(v.partner <> 'O' AND u.usual_rows > 0
                AND v.row_count < u.usual_rows * 0.8::DOUBLE, false) AS held
FROM versions v LEFT JOIN usual u USING (partner, feed, posting_date)""",
)
def truncation_holds(spark, sf):
    """Versions of one partner are approved beforehand."""
    register, pointer = S.first_published(spark, sf)
    versions = D.version_completeness(register).withColumn(
        "approved_by", F.when(F.col("partner") == "O", "ops")
    )
    usual = D.usual_rows(register.select(*DELIVERY).distinct(), pointer, register)
    return D.truncation_holds(versions, usual).select(
        *VERSION, "row_count", "usual_rows", "held"
    )


@query("deliveries_flip", POINTERS + "SELECT * FROM second_pointer")
def flip(spark, sf):
    return S.second_published(spark, sf).withColumns(shown("valid_from", "valid_to"))


@query(
    "deliveries_flip_again",
    POINTERS + "SELECT partner, feed, posting_date, sequence_number, valid_to FROM second_pointer",
)
def flip_again(spark, sf):
    """Every version requested twice more, in one batch: the pointer stays as it is."""
    pointer = S.second_published(spark, sf)
    asked = pointer.select(*VERSION, "approved_by")
    later = datetime(2001, 9, 3, tzinfo=UTC)
    again = D.flip(pointer, asked.unionByName(asked), later)
    return again.select(*VERSION, "valid_to").withColumns(shown("valid_to"))


VERDICTS = """judged AS (
  SELECT v.*, u.usual_rows, f.sequence_number AS present,
         v.parts >= v.part_count AS whole,
         coalesce(u.usual_rows > 0 AND v.row_count < u.usual_rows * 0.8::DOUBLE, false) AS held
  FROM versions v LEFT JOIN usual u USING (partner, feed, posting_date)
  LEFT JOIN first_pointer f USING (partner, feed, posting_date)),
verdicts AS (
  SELECT *, max(CASE WHEN whole AND NOT held THEN sequence_number END)
              OVER (PARTITION BY partner, feed, posting_date) AS best,
         CASE WHEN NOT whole THEN 'INCOMPLETE' WHEN held THEN 'HELD_FOR_APPROVAL'
              WHEN sequence_number >= best AND sequence_number >= coalesce(present, -1)
              THEN 'PUBLISHED' ELSE 'SUPERSEDED' END AS verdict
  FROM judged)"""


def _judged(spark, sf):
    register, pointer = S.first_published(spark, sf)
    verdicts = D.publish_verdicts(S.requests(register), register, pointer)
    return register, pointer, verdicts


@query(
    "deliveries_publish_verdicts",
    ctes(ROWS, PARTS, VERSIONS, FIRST, USUAL, VERDICTS)
    + "SELECT partner, feed, posting_date, sequence_number, row_count, usual_rows, verdict "
    "FROM verdicts",
)
def publish_verdicts(spark, sf):
    """Every version requested, against a pointer that holds the whole first versions."""
    verdicts = _judged(spark, sf)[2]
    return verdicts.select(*VERSION, "row_count", "usual_rows", "verdict")


@query(
    "deliveries_settle_register",
    ctes(ROWS, PARTS, VERSIONS, FIRST, USUAL, VERDICTS)
    + """, settled AS (
  SELECT DISTINCT partner, feed, posting_date, best,
         greatest(coalesce(present, -1), coalesce(best, -1)) AS current
  FROM verdicts)
SELECT p.file_id,
       CASE WHEN s.best IS NOT NULL AND p.sequence_number <= s.best
            THEN CASE WHEN p.sequence_number = s.current THEN 'PUBLISHED' ELSE 'SUPERSEDED' END
            WHEN p.sequence_number = 1 AND f.sequence_number = 1 THEN 'PUBLISHED'
            ELSE 'STAGED' END AS state
FROM parts p JOIN settled s USING (partner, feed, posting_date)
LEFT JOIN first_pointer f USING (partner, feed, posting_date)""",
)
def settle_register(spark, sf):
    register, pointer, verdicts = _judged(spark, sf)
    verdicts = materialise(verdicts)
    after = D.flip(pointer, verdicts.where(F.col("verdict") == V.PUBLISHED), S.SECOND_PUBLISH)
    return D.settle_register(register, verdicts, after).select("file_id", "state")


# ---- reading

ROW = "file_id, settlement_id, amount_paise"


@query(
    "deliveries_current_rows",
    POINTERS
    + f", {SECOND_OPEN} SELECT {ROW} FROM file_rows "
    "JOIN opened USING (partner, feed, posting_date, sequence_number)",
)
def current_rows(spark, sf):
    rows = D.current_rows(S.file_rows(spark, sf), S.second_published(spark, sf))
    return rows.select("file_id", "settlement_id", "amount_paise")


@query(
    "deliveries_as_known_at",
    POINTERS
    + f"SELECT {ROW} FROM file_rows "
    "JOIN first_pointer USING (partner, feed, posting_date, sequence_number)",
)
def as_known_at(spark, sf):
    """Between the two publishes, when only first versions were known."""
    moment = datetime(2001, 9, 1, 12, tzinfo=UTC)
    rows = D.as_known_at(S.file_rows(spark, sf), S.second_published(spark, sf), moment)
    return rows.select("file_id", "settlement_id", "amount_paise")


@query(
    "deliveries_input_status",
    POINTERS
    + f""", {SECOND_OPEN}
SELECT DISTINCT d.partner || '.' || d.feed AS name, d.posting_date,
       o.partner IS NOT NULL AS complete,
       CASE WHEN o.partner IS NOT NULL THEN ''
            ELSE 'no version for ' || CAST(d.posting_date AS VARCHAR) END AS detail
FROM versions d LEFT JOIN opened o USING (partner, feed, posting_date)""",
)
def input_status(spark, sf):
    required = S.file_rows(spark, sf).select(*DELIVERY).distinct()
    return D.input_status(required, S.second_published(spark, sf))


@query(
    "deliveries_contiguous_prefix",
    """WITH sent AS (
  SELECT DISTINCT o_orderstatus AS partner, o_orderpriority AS feed,
         date_diff('month', DATE '1995-01-01', CAST(o_orderdate AS DATE)) * 31
           + day(o_orderdate) - 1 AS sequence_number
  FROM orders),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY partner, feed ORDER BY sequence_number) - 1 AS rank
  FROM sent WHERE sequence_number > 4)
SELECT partner, feed, sequence_number FROM numbered WHERE sequence_number = rank + 5""",
)
def contiguous_prefix(spark, sf):
    """Daily numbers per line; a day without an order, or a short month, is a missing number."""
    date = F.col("o_orderdate").cast("date")
    month = (F.year(date) - 1995) * 12 + F.month(date) - 1
    sent = given(spark, sf, "orders").select(
        F.col("o_orderstatus").alias("partner"),
        F.col("o_orderpriority").alias("feed"),
        (month * 31 + F.dayofmonth(date) - 1).cast("bigint").alias("sequence_number"),
    ).distinct()
    applied = sent.select("partner", "feed").distinct().withColumn(
        "sequence_number", F.lit(4).cast("bigint")
    )
    return D.contiguous_prefix(sent, applied)


@query(
    "deliveries_missing",
    POINTERS
    + f""", {SECOND_OPEN},
feeds AS (
  SELECT partner, feed, min(posting_date) AS a, max(posting_date) + 10 AS b
  FROM versions GROUP BY ALL),
expected AS (
  SELECT partner, feed, CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE)
           AS posting_date FROM feeds)
SELECT e.partner, e.feed, e.posting_date,
       CASE WHEN e.partner = 'P' THEN 'declared gap' ELSE 'incomplete input' END AS effect
FROM expected e LEFT JOIN opened o USING (partner, feed, posting_date)
WHERE o.partner IS NULL
  AND e.posting_date + INTERVAL 1 DAY - INTERVAL 330 MINUTE + INTERVAL 8 HOUR
      <= TIMESTAMP '2001-08-05 03:00:00'""",
)
def missing(spark, sf):
    feeds = S.file_rows(spark, sf).groupBy("partner", "feed").agg(
        F.min("posting_date").alias("first_date"),
        F.date_add(F.max("posting_date"), 10).alias("last_date"),
        F.first(F.col("partner") == "P").alias("optional"),
    )
    now = datetime(2001, 8, 5, 3, tzinfo=UTC)
    return D.missing(feeds, S.second_published(spark, sf), now).drop("optional")


@query(
    "deliveries_announcements",
    POINTERS
    + """SELECT partner, feed, posting_date, sequence_number, valid_from AS announced_at,
       'reference ' || partner || '.' || feed || ' is at version ' || sequence_number AS message
FROM second_pointer WHERE sequence_number = 2 AND partner = 'F'""",
)
def announcements(spark, sf):
    before = S.first_published(spark, sf)[1]
    feeds = S.file_rows(spark, sf).select("partner", "feed").distinct().withColumn(
        "reference", F.col("partner") == "F"
    )
    found = D.announcements(before, S.second_published(spark, sf), feeds)
    return found.withColumns(shown("announced_at"))


@query(
    "deliveries_independent_check",
    """WITH base AS (
  SELECT CASE WHEN o_totalprice >= 1500
              THEN 'U' || o_custkey || '-' || CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS utr,
         CAST(round(o_totalprice * 100) AS BIGINT) AS amount_paise,
         o_orderstatus, o_orderpriority
  FROM orders),
sides AS (
  SELECT utr, amount_paise, 1 AS p, 0 AS l, 0 AS b FROM base
  UNION ALL
  SELECT utr, amount_paise, 0, 1, 0 FROM base
  WHERE NOT (o_orderstatus = 'P' AND o_orderpriority = '1-URGENT')
  UNION ALL
  SELECT utr, amount_paise + CASE WHEN o_orderpriority = '5-LOW' AND amount_paise > 40000000
                                  THEN 1 ELSE 0 END, 0, 0, 1 FROM base),
counts AS (
  SELECT utr, amount_paise, CAST(sum(p) AS BIGINT) AS partner_rows,
         CAST(sum(l) AS BIGINT) AS ledger_rows, CAST(sum(b) AS BIGINT) AS bank_rows
  FROM sides GROUP BY ALL)
SELECT *, CASE WHEN utr IS NULL THEN 'no payment reference'
               WHEN partner_rows = 0 THEN 'not in partner file'
               WHEN ledger_rows = 0 THEN 'not in ledger'
               WHEN bank_rows = 0 THEN 'not in bank statement' ELSE 'counts differ' END AS finding
FROM counts
WHERE utr IS NULL OR partner_rows <> ledger_rows OR partner_rows <> bank_rows""",
)
def independent_check(spark, sf):
    date = F.col("o_orderdate").cast("date").cast("string")
    utr = F.concat(F.lit("U"), "o_custkey", F.lit("-"), date)
    base = given(spark, sf, "orders").select(
        F.when(F.col("o_totalprice") >= 1500, utr).alias("utr"),
        paise("o_totalprice").alias("amount_paise"),
        "o_orderstatus",
        "o_orderpriority",
    )
    ledger = base.where(
        ~((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "1-URGENT"))
    )
    charged = (F.col("o_orderpriority") == "5-LOW") & (F.col("amount_paise") > 40_000_000)
    bank = base.withColumn(
        "amount_paise", F.when(charged, F.col("amount_paise") + 1).otherwise(F.col("amount_paise"))
    )
    return D.independent_check(base, ledger, bank)


@query(
    "deliveries_legacy_sequence",
    ctes(ROWS, PARTS)
    + """SELECT file_id, row_number() OVER (
         PARTITION BY partner, feed, posting_date
         ORDER BY sequence_number + part_number, file_id) AS sequence_number,
       'legacy' AS checked
FROM parts""",
)
def legacy_sequence(spark, sf):
    """Files archived some days after their posting date, without numbers of their own."""
    days = F.make_dt_interval((F.col("sequence_number") + F.col("part_number")).cast("int"))
    files = S.file_parts(spark, sf).select(
        "file_id", *DELIVERY, (F.col("posting_date").cast("timestamp") + days).alias("archived_at")
    )
    return D.legacy_sequence(files).select("file_id", "sequence_number", "checked")


@query(
    "deliveries_mapping_changes",
    """WITH old AS (
  SELECT 'C' || c_custkey AS key, c_mktsegment AS account, c_nationkey AS nation FROM customer),
new AS (
  SELECT 'C' || c_custkey AS key,
         CASE WHEN c_acctbal < 0 THEN 'CLOSED' WHEN c_acctbal < 1000 THEN NULL
              ELSE c_mktsegment END AS account, c_nationkey AS nation
  FROM customer WHERE c_nationkey <> 3
  UNION ALL SELECT 'S' || s_suppkey, 'SUPPLIER', s_nationkey FROM supplier)
SELECT coalesce(old.key, new.key) AS key,
       CASE WHEN old.key IS NULL THEN 'added' WHEN new.key IS NULL THEN 'removed'
            ELSE 'changed' END AS change,
       old.account AS old_account, old.nation AS old_nation,
       new.account AS new_account, new.nation AS new_nation, 'waiting for approval' AS status
FROM old FULL JOIN new USING (key)
WHERE old.key IS NULL OR new.key IS NULL OR old.account IS DISTINCT FROM new.account""",
)
def mapping_changes(spark, sf):
    old = given(spark, sf, "customer").select(
        F.concat(F.lit("C"), "c_custkey").alias("key"),
        F.col("c_mktsegment").alias("account"),
        F.col("c_nationkey").alias("nation"),
        "c_acctbal",
    )
    account = (
        F.when(F.col("c_acctbal") < 0, "CLOSED")
        .when(F.col("c_acctbal") < 1000, None)
        .otherwise(F.col("account"))
    )
    kept = old.where("nation <> 3").withColumn("account", account).drop("c_acctbal")
    added = given(spark, sf, "supplier").select(
        F.concat(F.lit("S"), "s_suppkey").alias("key"),
        F.lit("SUPPLIER").alias("account"),
        F.col("s_nationkey").alias("nation"),
    )
    return D.mapping_changes(old.drop("c_acctbal"), kept.unionByName(added), ("key",))


@query(
    "deliveries_parse_strict",
    """SELECT CAST(o_orderkey AS VARCHAR) AS settlement_id,
       CASE WHEN o_orderstatus <> 'P' THEN CAST(round(o_totalprice * 100) AS BIGINT) END
         AS amount_paise,
       CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_orderdate AS DATE) END AS posting_date,
       concat_ws('; ', CASE WHEN o_orderstatus = 'P' THEN 'amount_paise is not bigint' END,
                 CASE WHEN o_orderpriority = '5-LOW' THEN 'posting_date is not date' END)
         AS problems
FROM orders""",
)
def parse_strict(spark, sf):
    """One partner sends rupees or padded paise, one line sends dates the other way round."""
    text = paise("o_totalprice").cast("string")
    rupees = F.when(F.col("o_totalprice") > 250_000, F.col("o_totalprice").cast("string"))
    date = F.col("o_orderdate").cast("date")
    rows = given(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("settlement_id"),
        F.when(
            F.col("o_orderstatus") == "P", F.coalesce(rupees, F.concat(text, F.lit("\n")))
        ).otherwise(text).alias("amount_paise"),
        F.when(
            F.col("o_orderpriority") == "5-LOW", F.date_format(date, "dd/MM/yyyy")
        ).otherwise(date.cast("string")).alias("posting_date"),
    )
    return D.parse_strict(
        rows, {"settlement_id": "string", "amount_paise": "bigint", "posting_date": "date"}
    )
