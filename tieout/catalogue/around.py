"""Queries around the core jobs: landing, events, personal data, serving, features, quality."""

from __future__ import annotations

from datetime import UTC, date, datetime, timedelta

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tieout import fixed_values as V
from tieout.catalogue.cdc import CHANGES
from tieout.catalogue.cut import UP_TO_CUT
from tieout.catalogue.gate import FACT, FAULTY, pinned_inputs
from tieout.catalogue.registry import ctes, query, shown, sql_shown
from tieout.durable import materialise, scratch
from tieout.functions import paise
from tieout.model import ColumnRule, DataContract
from tieout.operators import (
    api,
    bronze,
    events,
    features,
    gold,
    health,
    privacy,
    quality,
    release,
    serving,
    signals,
)
from tieout.operators import cut as C
from tieout.sources import derived as S
from tieout.sources.tables import given

# ---- bronze

LOAN_ROW = (
    T.StructType()
    .add("loan_id", T.StringType())
    .add("status", T.StringType())
    .add("principal_paise", T.LongType())
    .add("loan_terms", T.StringType())
)


def envelopes(changes):
    """The change stream as its source writes it: JSON with the images before and after."""
    image = F.struct(*LOAN_ROW.names)
    deleted = F.col("op") == V.DELETE
    envelope = F.struct(
        F.when(deleted, image).alias("before"),
        F.when(~deleted, image).alias("after"),
        "op",
        F.struct(F.col("source_lsn").alias("lsn"), F.lit("loan").alias("table")).alias("source"),
        F.struct(F.concat(F.lit("tx-"), "source_lsn").alias("id")).alias("transaction"),
    )
    return changes.select("ingest_ts", F.to_json(envelope).alias("value"))


@query(
    "bronze_flatten_changes",
    ctes(CHANGES)
    + f"""SELECT {sql_shown("ingest_ts")} AS ingest_ts, loan_id, status, principal_paise,
       loan_terms, op, 'loan' AS source_table, 1 AS source_incarnation, source_lsn,
       'tx-' || source_lsn AS transaction_id
FROM changes""",
)
def flatten_changes(spark, sf):
    flat = bronze.flatten_changes(envelopes(S.changes(spark, sf)), LOAN_ROW, incarnation=1)
    return flat.drop("unparsed").withColumns(shown("ingest_ts"))


@query(
    "bronze_route",
    """SELECT CASE WHEN event_type IN ('signup', 'view', 'click') THEN event_type
            ELSE 'unrouted' END AS routed_to, strftime(ts, '%Y-%m-%d-%H') AS ingest_hour,
       count(*) AS changes
FROM events GROUP BY ALL""",
)
def route(spark, sf):
    """Some tables are not captured, and errors carry no table at all."""
    table = F.when(F.col("status") != "error", F.col("status"))
    changes = S.changes(spark, sf).withColumn("source_table", table)
    routed = bronze.with_ingest_hour(bronze.route(changes, ("signup", "view", "click")))
    return routed.groupBy("routed_to", "ingest_hour").agg(F.count(F.lit(1)).alias("changes"))


def _raw_props(spark, sf):
    """Event properties as sent; those of error events are cut off."""
    cut_off = F.expr("substring(props, 1, length(props) - 1)")
    return given(spark, sf, "events").select(
        "event_id",
        F.when(F.col("event_type") == "error", cut_off).otherwise(F.col("props")).alias("value"),
    )


@query(
    "bronze_land_flagged",
    """SELECT event_id,
       CASE WHEN event_type <> 'error' THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS k,
       CASE WHEN event_type = 'error' THEN substr(props, 1, length(props) - 1) END AS unparsed
FROM events""",
)
def land_flagged(spark, sf):
    return bronze.land_flagged(_raw_props(spark, sf), T.StructType().add("k", T.LongType()))


# ---- events


def _events(spark, sf):
    return app_events(given(spark, sf, "events"))


def app_events(rows):
    return rows.select(
        "event_id",
        F.col("ts").cast("timestamp").alias("event_ts"),
        "user_id",
        "event_type",
        paise("value").alias("amount_paise"),
        F.col("event_id").alias("position"),
    )


@query(
    "events_dedup",
    """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS event_ts, event_type, 1 AS attempt
FROM events""",
)
def dedup(spark, sf):
    """Every event sent twice and purchases three times; the first attempt stays."""
    once = _events(spark, sf)
    attempts = F.when(F.col("event_type") == "purchase", 3).otherwise(2)
    sent = once.withColumn("attempt", F.explode(F.sequence(F.lit(1), attempts)))
    return events.dedup(sent, ("attempt",)).select(
        "event_id", "event_ts", "event_type", "attempt"
    ).withColumns(shown("event_ts"))


@query(
    "events_late_exceptions",
    """SELECT event_id, CAST(ts AS DATE) AS event_date,
       CASE WHEN ts < TIMESTAMP '2024-01-10' THEN 'late for a closed date' ELSE '' END AS exception
FROM events""",
)
def late_exceptions(spark, sf):
    found = _events(spark, sf)
    days = found.select(F.to_date("event_ts").alias("business_date")).distinct()
    closed = days.where(F.col("business_date") < F.lit(date(2024, 1, 10)))
    accepted, late = events.late_exceptions(found, closed, F.to_date("event_ts"))
    both = accepted.withColumn("exception", F.lit("")).unionByName(late)
    return both.select("event_id", "event_date", "exception")


@query(
    "events_validate",
    """WITH sent AS (
  SELECT event_id AS own_id, event_type,
         CASE WHEN event_type = 'click' THEN NULL ELSE event_id END AS event_id,
         CASE WHEN event_type = 'view' AND value > 50 THEN NULL ELSE user_id END AS user_id
  FROM events)
SELECT own_id, event_type = 'error' OR event_id IS NULL AS given_an_id,
       concat_ws('; ',
         CASE WHEN event_type = 'error' THEN 'not valid JSON for its schema' END,
         CASE WHEN event_type = 'error' OR user_id IS NULL THEN 'user_id is missing' END
       ) AS problems
FROM sent""",
)
def validate(spark, sf):
    """Clicks come without an id, errors come cut off, some views without a user."""
    schema = T.StructType.fromDDL("event_id bigint, user_id bigint, at string, props string")
    e = given(spark, sf, "events")
    no_user = (F.col("event_type") == "view") & (F.col("value") > 50)
    body = F.to_json(
        F.struct(
            F.when(F.col("event_type") != "click", F.col("event_id")).alias("event_id"),
            F.when(~no_user, F.col("user_id")).alias("user_id"),
            F.col("ts").cast("string").alias("at"),
            "props",
        )
    )
    sent = e.select(
        F.col("event_id").alias("own_id"),
        F.when(F.col("event_type") == "error", F.left(body, F.length(body) - 1))
        .otherwise(body)
        .alias("value"),
    )
    found = events.validate(sent, schema, ("user_id",))
    return found.select(
        "own_id", (F.length("event_key") == 64).alias("given_an_id"), "problems"
    )


# ---- personal data


@query(
    "privacy_tokenise",
    """SELECT n.n_name, count(*) AS customers, count(DISTINCT lower(trim(c.c_name))) AS tokens
FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey GROUP BY ALL""",
)
def tokenise(spark, sf):
    """Names tokenised against a vault that knows the customers of one segment already."""
    customers = given(spark, sf, "customer").select(
        "c_nationkey", F.col("c_name").alias("name"), "c_mktsegment"
    )
    vault = customers.where("c_mktsegment = 'BUILDING'").select(
        F.lit("email").alias("kind"),
        F.lower("name").alias("value"),
        F.concat(F.lit("known-"), F.md5("name")).alias("token"),
    )
    tokens, _ = privacy.tokenise(customers, "name", "email", vault)
    nation = given(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return tokens.join(nation, "c_nationkey").groupBy("n_name").agg(
        F.count(F.lit(1)).alias("customers"), F.count_distinct("name").alias("tokens")
    )


def _customer_changes(spark, sf):
    """Customers as changes: the key and both images carry the same phone, and some an email."""
    c = given(spark, sf, "customer")
    number = (F.lit(9_000_000_000) + F.col("c_custkey") % 700).cast("string")
    mail = F.concat("c_mktsegment", (F.col("c_custkey") % 40).cast("string"), F.lit("@Example.com"))
    row = [F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment")]
    before = F.struct(
        *row, F.concat(F.lit("0"), number).alias("phone"),
        F.struct(mail.alias("email")).alias("contact"),
    )
    after = F.struct(
        *row, F.concat(F.lit("+91 "), number).alias("phone"),
        F.struct(F.when(F.col("c_acctbal") > 0, F.lower(mail)).alias("email")).alias("contact"),
    )
    return c.select(
        "c_nationkey",
        F.struct(number.alias("phone")).alias("key"),
        F.when(F.col("c_custkey") % 3 > 0, before).alias("before"),
        F.when(F.col("c_custkey") % 5 > 0, after).alias("after"),
        F.lit("u").alias("op"),
    )


CUSTOMER_FIELDS = {"segment": None, "phone": "phone", "contact.email": "email", "op": None}


@query(
    "privacy_tokenise_envelopes",
    """WITH c AS (
  SELECT c_nationkey, c_custkey % 700 AS phone, c_mktsegment || (c_custkey % 40) AS mail,
         c_custkey % 3 > 0 AS b, c_custkey % 5 > 0 AS a, c_acctbal > 0 AS known FROM customer)
SELECT c_nationkey, count(*) AS changes, count(DISTINCT phone) AS phones,
       count(DISTINCT phone) FILTER (a) AS phones_after,
       count(DISTINCT mail) FILTER (b OR (a AND known)) AS emails,
       count(*) FILTER (a AND b) AS same_phone, 0::BIGINT AS clear_values
FROM c GROUP BY ALL""",
)
def tokenise_envelopes(spark, sf):
    """One token per value over the key and both images, and no clear value left in any column."""
    changes = _customer_changes(spark, sf)
    vault = changes.where("c_nationkey < 5").select(
        F.lit("phone").alias("kind"),
        F.concat(F.lit("+91"), "key.phone").alias("value"),
    ).distinct().withColumn("token", F.concat(F.lit("known-"), F.md5("value")))
    rows, _ = privacy.tokenise_envelopes(changes, CUSTOMER_FIELDS, vault)
    text = F.to_json(F.struct("key", "before", "after"))
    clear = text.rlike(r"9000000\d{3}|@[Ee]xample")
    mails = F.array_compact(F.array("before.contact.email", "after.contact.email"))
    per_mail = rows.select("c_nationkey", F.explode(mails).alias("mail")).groupBy("c_nationkey").agg(
        F.count_distinct("mail").alias("emails")
    )
    same = (F.col("before.phone") == F.col("after.phone")) & (
        F.col("key.phone") == F.col("after.phone")
    )
    counts = rows.groupBy("c_nationkey").agg(
        F.count(F.lit(1)).alias("changes"),
        F.count_distinct("key.phone").alias("phones"),
        F.count_distinct("after.phone").alias("phones_after"),
        F.count_if(same).alias("same_phone"),
        F.count_if(clear).alias("clear_values"),
    )
    return counts.join(per_mail, "c_nationkey", "left").select(
        "c_nationkey", "changes", "phones", "phones_after",
        F.coalesce("emails", F.lit(0).cast("bigint")).alias("emails"), "same_phone", "clear_values",
    )


@query(
    "privacy_normalise",
    """SELECT c_custkey,
       CASE c_mktsegment WHEN 'FURNITURE' THEN '+1' || (9000000000 + c_custkey)
                         WHEN 'HOUSEHOLD' THEN (c_custkey % 1000) || ' 12'
                         ELSE '+91' || (9000000000 + c_custkey) END AS phone,
       c_mktsegment = 'HOUSEHOLD' AS phone_unreadable,
       lower(c_name) || '@example.com' AS email, upper(c_name) AS pan
FROM customer""",
)
def normalise(spark, sf):
    """Phones, also foreign and short ones, emails and PANs as people write them."""
    number = (F.lit(9_000_000_000) + F.col("c_custkey")).cast("string")
    local = F.concat(F.lit(" "), F.left(number, F.lit(5)), F.lit("-"), F.right(number, F.lit(5)))
    segment = F.col("c_mktsegment")
    written = (
        F.when(segment == "BUILDING", F.concat(F.lit("+91"), local))
        .when(segment == "MACHINERY", F.concat(F.lit("0"), number))
        .when(segment == "FURNITURE", F.concat(F.lit("+1"), local))
        .when(segment == "HOUSEHOLD", F.concat((F.col("c_custkey") % 1000).cast("string"), F.lit(" 12 ")))
        .otherwise(local)
    )
    return given(spark, sf, "customer").select(
        "c_custkey",
        privacy.normalise("phone", written).alias("phone"),
        privacy.is_unreadable("phone", written).alias("phone_unreadable"),
        privacy.normalise("email", F.concat("c_name", F.lit("@Example.COM "))).alias("email"),
        privacy.normalise("pan", F.lower("c_name")).alias("pan"),
    )


CANARIES = ("@mail5.example.com", "@mail6.example.com")


def _hits(table: str, columns: tuple[str, ...]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, count(*) FILTER ("
        + " OR ".join(f"contains({c}, '{canary}')" for canary in CANARIES)
        + f") AS hits FROM {table}"
        for c in columns
    )


@query(
    "privacy_canary_hits",
    "\nUNION ALL\n".join(
        (
            _hits("documents", ("text", "lang", "source")),
            _hits("pages", ("url", "html")),
            _hits("conversations", ("role", "text")),
        )
    ),
)
def canary_hits(spark, sf):
    tables = {t: given(spark, sf, t) for t in ("documents", "pages", "conversations")}
    return privacy.canary_hits(tables, CANARIES)


def _erased(spark, sf):
    customers = given(spark, sf, "customer")
    vault = customers.select(
        F.lit("name").alias("kind"),
        F.col("c_name").alias("value"),
        F.md5("c_name").alias("token"),
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.col("c_mktsegment").alias("retention_class"),
        F.date_add(F.lit(date(2024, 1, 1)), F.col("c_nationkey")).alias("recorded_on"),
    )
    asked = customers.where("c_acctbal < 0").select(
        F.col("c_custkey").cast("string").alias("customer_id")
    )
    retention = spark.createDataFrame(
        [("BUILDING", 10), ("HOUSEHOLD", 365), ("MACHINERY", None)],
        "retention_class string, retain_days int",
    )
    return privacy.erase(vault, asked, retention, date(2024, 1, 20))


DECIDED = """decided AS (
  SELECT CAST(c_custkey AS VARCHAR) AS customer_id, md5(c_name) AS token, c_acctbal < 0 AS asked,
         DATE '2024-01-01' + c_nationkey + CASE c_mktsegment WHEN 'BUILDING' THEN 10
           WHEN 'HOUSEHOLD' THEN 365 END AS until
  FROM customer)"""


@query(
    "privacy_erase",
    ctes(DECIDED)
    + """SELECT customer_id, token,
       CASE WHEN until > DATE '2024-01-20' THEN 'erasure pending' ELSE 'deleted' END AS decision,
       CASE WHEN until > DATE '2024-01-20' THEN until END AS keep_until
FROM decided WHERE asked""",
)
def erase(spark, sf):
    return _erased(spark, sf)[1].select("customer_id", "token", "decision", "keep_until")


@query(
    "privacy_vault_after_erasure",
    ctes(DECIDED)
    + """SELECT token, asked AS masked FROM decided
WHERE NOT asked OR until > DATE '2024-01-20'""",
)
def vault_after_erasure(spark, sf):
    return _erased(spark, sf)[0].select("token", "masked")


# ---- API pulls


def _pulls(spark, sf):
    """Orders as records of their customer, one pull a day, each looking back a week."""
    day = F.col("o_orderdate").cast("date")
    orders = given(spark, sf, "orders").select(
        F.col("o_custkey").alias("record_id"),
        "o_orderkey",
        paise("o_totalprice").alias("amount_paise"),
        day.alias("seen_on"),
    )
    pulled = F.explode(F.sequence("seen_on", F.date_add("seen_on", 6))).alias("pulled_on")
    landed = orders.select("*", pulled)
    order = F.struct("pulled_on", "seen_on", "o_orderkey")
    return landed.withColumn("pull_id", order).drop("pulled_on")


@query(
    "api_merge_pulls",
    """SELECT o_custkey AS record_id, o_orderkey,
       CAST(round(o_totalprice * 100) AS BIGINT) AS amount_paise
FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
)
def merge_pulls(spark, sf):
    return api.merge_pulls(_pulls(spark, sf)).select("record_id", "o_orderkey", "amount_paise")


@query(
    "api_sweep_gaps",
    """SELECT c_custkey AS record_id, 'missed by the pulls' AS gap FROM customer
WHERE c_acctbal > 0 AND c_custkey NOT IN (SELECT o_custkey FROM orders)
UNION ALL
SELECT DISTINCT o_custkey, 'vanished from the source' FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)""",
)
def sweep_gaps(spark, sf):
    """A full sweep that shows the customers in credit."""
    sweep = given(spark, sf, "customer").where("c_acctbal > 0").select(
        F.col("c_custkey").alias("record_id")
    )
    return api.sweep_gaps(api.merge_pulls(_pulls(spark, sf)), sweep)


# ---- serving


def _releases(spark, sf):
    """The log of the fact's two releases, from its manifest."""
    at = F.when(F.col("release_id") == 1, F.lit(S.FIRST_PUBLISH)).otherwise(
        F.lit(S.SECOND_PUBLISH)
    )
    return S.manifest(spark, sf).groupBy("table_name", "release_id").agg(
        F.create_map(F.lit("orders"), F.count(F.lit(1)).cast("string")).alias("label")
    ).select(
        "*",
        F.lit(V.PUBLISHED).alias("state"),
        at.alias("published_at"),
        (F.col("release_id") == 1).alias("reconciled"),
    )


@query(
    "serving_load_copy",
    ctes(FACT)
    + """SELECT txn_id, amount_paise,
       'orders@' || (SELECT count(DISTINCT business_date) FROM fact) AS version_label
FROM fact""",
)
def load_copy(spark, sf):
    """The first release, loaded whole although the second is live."""
    copy, _ = serving.load_copy(
        S.released_rows(spark, sf), S.manifest(spark, sf), _releases(spark, sf), S.TABLE, 1,
        datetime(2001, 9, 3, tzinfo=UTC),
    )
    return copy.select("txn_id", "amount_paise", "version_label")


@query(
    "serving_copy_lag",
    """WITH log AS (
  SELECT o_orderpriority AS table_name, year(o_orderdate) AS release_id,
         max(o_orderdate) AS last_at,
         year(o_orderdate) = 2001 AND o_orderpriority IN ('1-URGENT', '5-LOW') AS held
  FROM orders GROUP BY ALL),
heads AS (
  SELECT table_name, max(release_id) AS head_release FROM log WHERE NOT held GROUP BY ALL),
copies AS (
  SELECT table_name, max(release_id) AS loaded_release, max(last_at) AS loaded_at
  FROM log WHERE release_id <= 2000 AND table_name <> '2-HIGH' GROUP BY ALL)
SELECT table_name, CAST(head_release AS BIGINT) AS head_release,
       CAST(loaded_release AS BIGINT) AS loaded_release,
       strftime(loaded_at, '%Y-%m-%d %H:%M:%S') AS loaded_at,
       loaded_release IS DISTINCT FROM head_release AS behind
FROM heads LEFT JOIN copies USING (table_name)""",
)
def copy_lag(spark, sf):
    """Copies were loaded up to the releases of 2000; one table has no copy at all."""
    log = S.release_log(spark, sf)
    loaded = log.where("release_id <= 2000 AND table_name <> '2-HIGH'").select(
        "table_name", "release_id", F.col("published_at").alias("loaded_at")
    )
    return serving.copy_lag(loaded, release.head(log)).withColumns(shown("loaded_at"))


@query(
    "serving_pinned_join",
    ctes(FACT)
    + """SELECT txn_id, amount_paise AS first_paise,
       CASE WHEN business_date < DATE '1998-01-01' OR status <> 'PARTIALLY_SETTLED'
            THEN amount_paise END AS live_paise,
       CAST(1 AS BIGINT) AS left_release, CAST(2 AS BIGINT) AS right_release
FROM fact""",
)
def pinned_join(spark, sf):
    rows, manifest = S.released_rows(spark, sf), S.manifest(spark, sf)
    first = release.read(rows, manifest, S.TABLE, 1).select(
        "txn_id", F.col("amount_paise").alias("first_paise")
    )
    live = release.read(rows, manifest, S.TABLE, 2).select(
        "txn_id", F.col("amount_paise").alias("live_paise")
    )
    return serving.pinned_join(first, live, ("txn_id",), 1, 2, "left")


GOVERNED = """CAST(sum(amount_paise) FILTER (status = 'SETTLED') AS BIGINT) AS gmv_paise,
       count(*) AS transaction_count"""


@query(
    "serving_metrics",
    ctes(FACT) + f"SELECT business_line, status, {GOVERNED} FROM fact GROUP BY ALL",
)
def metrics(spark, sf):
    return serving.metrics(S.fact(spark, sf), ("business_line", "status"))


@query(
    "serving_daily_rollup",
    ctes(FACT)
    + f"SELECT business_line, business_date AS day, {GOVERNED} FROM fact GROUP BY ALL",
)
def daily_rollup(spark, sf):
    return serving.daily_rollup(S.fact(spark, sf))


@query(
    "serving_with_label",
    ctes(FACT)
    + f"""SELECT business_line, {GOVERNED}, CAST(2 AS BIGINT) AS version,
       'orders@' || (SELECT count(DISTINCT business_date) FROM fact
                     WHERE business_date >= DATE '1998-01-01') AS version_label,
       CAST(7200 AS BIGINT) AS age_seconds, true AS verified, false AS reconciled
FROM fact WHERE business_date < DATE '1998-01-01' OR status <> 'PARTIALLY_SETTLED'
GROUP BY business_line""",
)
def with_label(spark, sf):
    live = release.read(S.released_rows(spark, sf), S.manifest(spark, sf), S.TABLE)
    now = S.SECOND_PUBLISH + timedelta(hours=2)
    answer = serving.metrics(live, ("business_line",))
    return serving.with_label(answer, _releases(spark, sf), S.TABLE, 2, now)


@query(
    "serving_trace",
    UP_TO_CUT
    + """, early AS (
  SELECT position, transaction_id FROM tx
  WHERE ended AND position <= (SELECT position FROM cut) AND committed_at < TIMESTAMP '2000-01-01'
  ORDER BY position DESC LIMIT 1),
days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders),
whole AS (
  SELECT o_orderstatus AS partner, CAST(o_orderdate AS DATE) AS d, 1 + o_orderkey % 2 AS seq
  FROM orders GROUP BY ALL HAVING count(DISTINCT o_custkey % 2) >= max(1 + o_custkey % 2)),
known AS (
  SELECT partner, d, CASE WHEN d < DATE '1998-01-01' THEN min(seq) ELSE max(seq) END AS seq
  FROM whole GROUP BY partner, d
  HAVING d >= DATE '1998-01-01' OR min(seq) = 1)
SELECT 'fact_transaction' AS table_name, CAST(d AS VARCHAR) AS slice,
       CAST(CASE WHEN d >= DATE '1998-01-01' THEN 2 ELSE 1 END AS BIGINT) AS release_id,
       'sales' AS source,
       CAST(CASE WHEN d >= DATE '1998-01-01' THEN cut.position ELSE early.position END AS VARCHAR)
         AS at,
       CASE WHEN d >= DATE '1998-01-01' THEN cut.transaction_id ELSE early.transaction_id END
         AS origin
FROM days, cut, early
UNION ALL
SELECT DISTINCT 'fact_transaction', CAST(d AS VARCHAR),
       CASE WHEN d >= DATE '1998-01-01' THEN 2 ELSE 1 END, partner || '.orders',
       CASE WHEN d >= DATE '1998-01-01' THEN '2001-09-02 12:00:00' ELSE '2001-09-01 12:00:00' END,
       partner || '-' || CAST(d AS VARCHAR) || '-v' || seq || '-p' || (1 + o_custkey % 2)
FROM known JOIN orders ON o_orderstatus = partner AND CAST(o_orderdate AS DATE) = d
 AND 1 + o_orderkey % 2 = seq""",
)
def trace(spark, sf):
    """From each live date of the fact back to a transaction and to partner files.

    The releases carry the labels of their builds: the first was built at an earlier cut.
    """
    register, _ = S.first_published(spark, sf)
    after = materialise(S.second_published(spark, sf))
    settled = register.join(
        after.select("partner", "feed", "posting_date", "sequence_number"),
        ["partner", "feed", "posting_date", "sequence_number"],
        "left_semi",
    ).withColumn("state", F.lit(V.PUBLISHED))
    ends = C.new_ends(S.transactions(spark, sf))
    landed = materialise(C.landed_counts(S.captured(spark, sf)))
    before_2000 = ends.where(F.col("committed_at") < F.lit(datetime(2000, 1, 1)))
    found = [
        C.longest_complete_prefix(known, landed, S.TRACKED).first() for known in (before_2000, ends)
    ]
    published = (S.FIRST_PUBLISH, S.SECOND_PUBLISH)
    labels = [
        gold.version_label(pinned_inputs(spark, sf, cut, after, at + timedelta(hours=12)))
        for cut, at in zip(found, published, strict=True)
    ]
    releases = spark.createDataFrame(
        [(S.TABLE, i + 1, label) for i, label in enumerate(labels)],
        "table_name string, release_id bigint, label map<string, string>",
    )
    cuts = spark.createDataFrame(
        [("sales", cut["position"], cut["transaction_id"]) for cut in found],
        "source string, position bigint, transaction_id string",
    )
    return serving.trace(S.manifest(spark, sf), releases, cuts, after, settled)


# ---- features and signals


def _of_type(kind: str, source: str = "events") -> str:
    return f"SELECT * FROM {source} WHERE event_type = '{kind}'"


@query(
    "features_as_of",
    f"""WITH purchases AS ({_of_type("purchase")}), clicks AS ({_of_type("click")})
SELECT p.event_id, CAST(round(c.value * 100) AS BIGINT) AS click_paise,
       {sql_shown("c.ts")} AS observed_at
FROM purchases p ASOF LEFT JOIN clicks c ON p.user_id = c.user_id AND p.ts > c.ts""",
)
def as_of(spark, sf):
    """Each purchase with the user's last click strictly before it."""
    all_events = _events(spark, sf)
    moments = all_events.where("event_type = 'purchase'").select(
        "event_id", "user_id", "event_ts"
    )
    clicks = all_events.where("event_type = 'click'").select(
        "user_id", "event_ts", F.col("amount_paise").alias("click_paise")
    )
    found = features.as_of(moments, clicks, "user_id", "event_ts", ("click_paise",))
    return found.select("event_id", "click_paise", "observed_at").withColumns(
        shown("observed_at")
    )


@query(
    "features_as_of_hot_entity",
    f"""WITH hot AS (
  SELECT event_id, event_type, value, CASE WHEN user_id % 3 = 0 THEN 0 ELSE user_id END AS user_id,
         date_trunc('hour', TIMESTAMP '2024-01-01') + to_seconds(event_id % 3000) AS ts FROM events),
purchases AS ({_of_type("purchase", "hot")}),
clicks AS (
  SELECT user_id, ts, max(value) AS value FROM ({_of_type("click", "hot")}) GROUP BY ALL)
SELECT p.event_id, CAST(round(c.value * 100) AS BIGINT) AS click_paise
FROM purchases p ASOF LEFT JOIN clicks c ON p.user_id = c.user_id AND p.ts >= c.ts""",
)
def as_of_hot_entity(spark, sf):
    """A third of all rows are one user's, all within one hour: cut into ranges, not into hours."""
    e = _events(spark, sf)
    hot = e.withColumns(
        {
            "user_id": F.when(F.col("user_id") % 3 == 0, 0).otherwise(F.col("user_id")),
            "event_ts": F.timestamp_seconds(F.lit(1704067200) + F.col("event_id") % 3000),
        }
    )
    moments = hot.where("event_type = 'purchase'").select("event_id", "user_id", "event_ts")
    clicks = hot.where("event_type = 'click'").select(
        "user_id", "event_ts", F.col("amount_paise").alias("click_paise")
    )
    found = features.as_of(
        moments, clicks, "user_id", "event_ts", ("click_paise",), 16, strictly_before=False
    )
    return found.select("event_id", "click_paise")


def watched(spark, sf):
    """Event types worth watching, from the events themselves."""
    types = given(spark, sf, "events").select("event_type").distinct()
    return types.where(F.col("event_type").isin("purchase", "error"))


SIGNALS = """signals AS (
  SELECT user_id, date_trunc('hour', ts) AS window_start, count(*) AS events,
         CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS amount_paise,
         min(event_id) AS first_position, max(event_id) AS last_position
  FROM events WHERE event_type IN ('purchase', 'error') GROUP BY ALL)"""
SIGNAL_COLUMNS = f"""user_id, {sql_shown("window_start")} AS window_start,
       {sql_shown("window_start + INTERVAL 1 HOUR")} AS window_end, events, amount_paise,
       first_position, last_position, 'fast_signal' AS source, false AS verified"""


@query("signals_score", ctes(SIGNALS) + f"SELECT {SIGNAL_COLUMNS} FROM signals")
def score(spark, sf):
    once = events.dedup(_events(spark, sf), ("position",))
    return signals.score(once, watched(spark, sf)).withColumns(
        shown("window_start", "window_end")
    )


@query(
    "signals_drift",
    ctes(SIGNALS)
    + """, fast AS (
  SELECT user_id, CAST(window_start AS DATE) AS business_date,
         CAST(sum(amount_paise) AS BIGINT) AS signal_paise, CAST(sum(events) AS BIGINT) AS signal_events
  FROM signals GROUP BY ALL),
gold AS (
  SELECT user_id, CAST(ts AS DATE) AS business_date,
         CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS gold_paise, count(*) AS gold_events
  FROM events WHERE event_type = 'purchase' OR (event_type = 'error' AND value < 200) GROUP BY ALL)
SELECT *, coalesce(signal_paise, 0) - coalesce(gold_paise, 0) AS drift_paise
FROM fast FULL JOIN gold USING (user_id, business_date)
WHERE signal_paise IS DISTINCT FROM gold_paise OR signal_events IS DISTINCT FROM gold_events""",
)
def drift(spark, sf):
    """Gold leaves out large errors, which the fast lane had counted."""
    found = _events(spark, sf)
    gold_rows = found.where(
        "event_type = 'purchase' OR (event_type = 'error' AND amount_paise < 20000)"
    ).select("user_id", F.to_date("event_ts").alias("business_date"), "amount_paise")
    return signals.drift(signals.score(found, watched(spark, sf)), gold_rows)


# ---- quality and health

FACT_CONTRACT = DataContract(
    "gold.fact_transaction",
    (
        ColumnRule("txn_id", required=True, primary_key=True),
        ColumnRule("customer_id", required=True),
        ColumnRule("business_line", required=True),
        ColumnRule("business_date", "date", required=True),
        ColumnRule("amount_paise", "bigint", required=True),
        ColumnRule("status", required=True, allowed=V.TRANSACTION_STATUSES),
    ),
    {"gmv_paise": ("status", V.GMV_STATUS)},
)
LINE_CONTRACT = DataContract(
    "lines",
    (
        ColumnRule("l_orderkey", "bigint", required=True, primary_key=True),
        ColumnRule("l_linenumber", "int", required=True, primary_key=True),
        ColumnRule("l_linestatus", required=True, allowed=("O",)),
        ColumnRule("l_partkey", "bigint", required=True, unique=True),
        ColumnRule("amount_paise", "bigint", required=True),
    ),
)


@query(
    "quality_evaluate",
    """SELECT 'required:l_orderkey' AS "check", count(*) - count(l_orderkey) AS failures
FROM lineitem
UNION ALL SELECT 'required:l_linenumber', count(*) - count(l_linenumber) FROM lineitem
UNION ALL SELECT 'required:l_linestatus', count(*) - count(l_linestatus) FROM lineitem
UNION ALL SELECT 'invalidValues:l_linestatus', count(*) FILTER (l_linestatus <> 'O') FROM lineitem
UNION ALL SELECT 'required:l_partkey', count(*) - count(l_partkey) FROM lineitem
UNION ALL SELECT 'primaryKey', count(*) - (SELECT count(*) FROM (
    SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) FROM lineitem
UNION ALL SELECT 'duplicateValues:l_partkey', count(*) - count(DISTINCT l_partkey) FROM lineitem
UNION ALL SELECT 'missing:amount_paise', count(*) FROM lineitem""",
)
def evaluate(spark, sf):
    return quality.evaluate(given(spark, sf, "lineitem"), LINE_CONTRACT)


@query(
    "quality_evaluate_fact",
    ctes(FACT, FAULTY, """holed AS (
  SELECT CASE WHEN amount_paise % 7 <> 0 THEN txn_id END AS txn_id,
         CASE WHEN amount_paise % 11 <> 0 THEN customer_id END AS customer_id,
         CASE WHEN amount_paise % 13 <> 0 THEN business_line END AS business_line,
         CASE WHEN amount_paise % 17 <> 0 THEN business_date END AS business_date,
         CASE WHEN amount_paise % 23 <> 0 THEN amount_paise END AS amount_paise,
         CASE WHEN amount_paise % 29 = 0 THEN 'LOST'
              WHEN amount_paise % 19 <> 0 THEN status END AS status
  FROM faulty)""")
    + """SELECT 'required:txn_id' AS "check", count(*) - count(txn_id) AS failures FROM holed
UNION ALL SELECT 'required:customer_id', count(*) - count(customer_id) FROM holed
UNION ALL SELECT 'required:business_line', count(*) - count(business_line) FROM holed
UNION ALL SELECT 'required:business_date', count(*) - count(business_date) FROM holed
UNION ALL SELECT 'required:amount_paise', count(*) - count(amount_paise) FROM holed
UNION ALL SELECT 'required:status', count(*) - count(status) FROM holed
UNION ALL SELECT 'invalidValues:status', count(*) FILTER (
  status NOT IN ('INITIATED', 'AUTHORISED', 'SETTLED', 'PARTIALLY_SETTLED', 'REVERSED', 'FAILED'))
  FROM holed
UNION ALL SELECT 'primaryKey', count(*) - count(DISTINCT txn_id) FROM holed""",
)
def evaluate_fact(spark, sf):
    """Every column lacks its value in some rows, and one status is not in the contract."""
    amount = F.col("amount_paise")
    gaps = {
        "txn_id": 7, "customer_id": 11, "business_line": 13, "business_date": 17,
        "amount_paise": 23, "status": 19,
    }
    holed = {c: F.when(amount % n != 0, F.col(c)) for c, n in gaps.items()}
    holed["status"] = F.when(amount % 29 == 0, "LOST").otherwise(holed["status"])
    return quality.evaluate(S.faulty_fact(spark, sf).withColumns(holed), FACT_CONTRACT)


@query(
    "quality_value_drift",
    """SELECT 'status' AS column_name, event_type AS value, count(*) AS rows
FROM events WHERE event_type IS NULL OR event_type NOT IN ('view', 'click') GROUP BY ALL""",
)
def value_drift(spark, sf):
    """Event types stand for loan statuses; the contract knows two of them."""
    known = ColumnRule("status", required=True, allowed=(*V.LOAN_STATUSES, "view", "click"))
    return quality.value_drift(S.changes(spark, sf), DataContract("lending.loan", (known,)))


@query(
    "health_report",
    """SELECT 'events' AS subject, 'lag_seconds' AS measure,
       CAST(epoch(TIMESTAMP '2024-02-01') - floor(epoch(max(ts))) AS BIGINT) AS value FROM events
UNION ALL
SELECT 'orders', 'lag_seconds',
       CAST(epoch(TIMESTAMP '2024-02-01') - epoch(max(o_orderdate)) AS BIGINT) FROM orders
UNION ALL
SELECT 'sales', 'cut_lag_seconds',
       CAST(epoch(TIMESTAMP '2024-02-01') - epoch(max(o_orderdate)) AS BIGINT) FROM orders
WHERE o_orderdate <= TIMESTAMP '2001-07-01'
UNION ALL
SELECT DISTINCT o_orderpriority, 'open_holds',
       CASE WHEN o_orderpriority IN ('1-URGENT', '5-LOW') THEN 1 ELSE 0 END FROM orders""",
)
def report(spark, sf):
    orders = given(spark, sf, "orders").withColumn(
        "o_orderdate", F.col("o_orderdate").cast("timestamp")
    )
    ends = C.new_ends(S.transactions(spark, sf)).withColumn("source", F.lit("sales"))
    return health.report(
        datetime(2024, 2, 1, tzinfo=UTC),
        {"events": (_events(spark, sf), "event_ts"), "orders": (orders, "o_orderdate")},
        ends,
        S.release_log(spark, sf),
    )


@query(
    "health_files_per_partition",
    """SELECT l_returnflag, count(*) AS rows,
       count(DISTINCT strftime(l_shipdate, '%Y-%m')) AS files
FROM lineitem GROUP BY ALL""",
)
def files_per_partition(spark, sf):
    """Lines stored with one file per flag and month of shipping."""
    layout = ("l_returnflag", "month")
    month = F.date_format("l_shipdate", "yyyy-MM").alias("month")
    lines = given(spark, sf, "lineitem").select("l_orderkey", "l_returnflag", month)
    path = scratch(spark, "lines-by-month")
    lines.repartition(*layout).write.partitionBy(*layout).parquet(path)
    return health.files_per_partition(spark.read.parquet(path), "l_returnflag")


