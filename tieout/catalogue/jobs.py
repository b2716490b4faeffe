"""Whole jobs, with what they store, and the streaming forms, over whole tables.

They write under the session's checkpoint folder and return what a reader sees afterwards.
"""

from __future__ import annotations

import uuid
from dataclasses import replace
from datetime import UTC, date, datetime, timedelta

from pyspark.sql import functions as F

from tieout.catalogue.around import LOAN_ROW, SIGNAL_COLUMNS, SIGNALS, app_events, envelopes, watched
from tieout.catalogue.cdc import ALL, CHANGES, STATE
from tieout.catalogue.cut import UP_TO_CUT
from tieout.catalogue.deliveries import PARTS, ROWS, VERSIONS
from tieout.catalogue.gate import FACT, WINDOW, rebuilt_dates
from tieout.catalogue.registry import ctes, query, shown
from tieout.durable import scratch
from tieout.model import CUTS, MANIFEST, POINTER, REGISTER, RELEASES, MergeSpec
from tieout.operators import cdc, release
from tieout.operators import deliveries as D
from tieout.plans import cut_advance, file_delivery, gate_publish, merge, window_sink
from tieout.sources import derived as S
from tieout.sources.stream import given_stream
from tieout.sources.tables import given
from tieout.streaming import changes as change_stream
from tieout.streaming import events as event_stream

NOW = datetime(2001, 9, 1, tzinfo=UTC)
AVAILABLE = {"availableNow": True}


def _none(spark, schema: str):
    return spark.createDataFrame([], schema)


def _written_to(spark, frame, name: str):
    """What a job's caller does with a frame: one plain table."""
    path = scratch(spark, name)
    frame.write.parquet(path, compression="zstd")
    return spark.read.schema(frame.schema).parquet(path)


@query(
    "job_merge_batches",
    ctes(CHANGES, ALL) + f"SELECT {STATE} FROM state",
)
def merge_batches(spark, sf):
    """Two overlapping batches: the first written as the state, the second merged by its keys."""
    first, second = S.early_changes(spark, sf), S.later_changes(spark, sf)
    state = merge.merge_batch(cdc.empty_target(first, S.LOAN), S.LOAN, first, S.MERGED_AT)
    state = _written_to(spark, state, "loan")
    put = _written_to(spark, merge.upserts(state, S.LOAN, second, S.MERGED_AT), "upserts")
    kept = state.join(put, list(S.LOAN.keys), "left_anti")
    return kept.unionByName(put).drop("updated_at")


@query(
    "job_advance_source",
    UP_TO_CUT
    + """SELECT source_table, key FROM bronze WHERE transaction_id IN (
  SELECT transaction_id FROM tx WHERE ended AND position <= (SELECT position FROM cut))
GROUP BY ALL""",
)
def advance_source(spark, sf):
    """Both tables of the source advanced in two runs, as they are at the second cut."""
    orders = MergeSpec(("order_id",), ("status", "amount_paise"))
    lines = MergeSpec(("line_id",), ("amount_paise",))
    specs = {"public.orders": ("orders", orders), "public.lineitem": ("lines", lines)}
    # What has landed is a stored table: both runs read it, neither derives it again.
    bronze = {
        name: _written_to(spark, rows, f"bronze-{name}")
        for name, rows in S.captured(spark, sf).items()
    }
    transactions = _written_to(spark, S.transactions(spark, sf), "transactions")
    cuts = _none(spark, CUTS)
    states = {t: cdc.empty_target(bronze[name], spec) for name, (t, spec) in specs.items()}
    for run, until in enumerate((datetime(1999, 1, 1), None), 1):
        tables = {
            name: cut_advance.CapturedTable(
                rows if until is None else rows.where(F.col("ingest_ts") <= F.lit(until)),
                specs[name][0],
                specs[name][1],
                states[specs[name][0]],
            )
            for name, rows in bronze.items()
        }
        moved = cut_advance.advance(
            cuts, "sales", transactions, tables, run, NOW, S.TRACKED
        )
        states = {t: _written_to(spark, state, t) for t, state in moved.states.items()}
        cuts = moved.cuts
    found = [
        cdc.live_rows(states[t]).select(
            F.lit(name).alias("source_table"), F.col(spec.keys[0]).alias("key")
        )
        for name, (t, spec) in specs.items()
    ]
    return found[0].unionByName(found[1])


# Dates of one weekday, in order: each is judged by what the four weeks before it published.
IN_TURN = """dates AS (
  SELECT partner, feed, posting_date, isodow(posting_date) AS weekday,
         coalesce(list({'s': sequence_number, 'n': row_count}) FILTER (WHERE parts >= part_count),
                  []) AS asked,
         row_number() OVER (PARTITION BY partner, feed, isodow(posting_date)
                            ORDER BY posting_date) AS turn
  FROM versions GROUP BY partner, feed, posting_date),
walk AS (
  SELECT DISTINCT partner, feed, weekday, 0::BIGINT AS turn,
         CAST([] AS STRUCT(d DATE, s BIGINT, n BIGINT)[]) AS done
  FROM dates
  UNION ALL
  SELECT partner, feed, weekday, turn,
         list_append(done[-4:], {'d': posting_date, 's': best.s, 'n': best.n})
  FROM (
    SELECT *, list_sort([v FOR v IN asked IF NOT coalesce(
                usual > 0 AND v.n < usual * 0.8::DOUBLE, false)])[-1] AS best
    FROM (
      SELECT d.partner, d.feed, d.weekday, d.turn, d.posting_date, d.asked, w.done,
             list_aggregate([h.n FOR h IN w.done IF h.d >= d.posting_date - 28], 'median') AS usual
      FROM walk w JOIN dates d
        ON d.partner = w.partner AND d.feed = w.feed AND d.weekday = w.weekday
       AND d.turn = w.turn + 1)))"""


@query(
    "job_deliver_files",
    ctes(ROWS, PARTS, VERSIONS, IN_TURN).replace("WITH ", "WITH RECURSIVE ", 1)
    + """SELECT f.file_id, f.settlement_id, f.amount_paise
FROM file_rows f JOIN walk w
  ON f.partner = w.partner AND f.feed = w.feed AND f.posting_date = w.done[-1].d
 AND f.sequence_number = w.done[-1].s""",
)
def deliver_files(spark, sf):
    """Every part received twice, every version requested without approval, current rows read.

    Whatever is far smaller than the weeks before it is held, so its rows do not show.
    """
    stored, done = _delivered(spark, sf, S.FEED, NOW)
    loaded = file_delivery.loaded_rows(stored, done.register)
    return D.current_rows(loaded, done.pointer).select("file_id", "settlement_id", "amount_paise")


@query(
    "job_closed_windows",
    ctes(ROWS, PARTS, VERSIONS, IN_TURN).replace("WITH ", "WITH RECURSIVE ", 1)
    + """, published AS (
  SELECT partner, feed, w.done[-1].d AS posting_date, w.done[-1].s AS sequence_number
  FROM walk w WHERE len(w.done) > 0 AND w.done[-1].s IS NOT NULL),
feeds AS (SELECT partner, feed, min(posting_date) AS a FROM parts GROUP BY ALL),
expected AS (
  SELECT partner, feed, CAST(unnest(generate_series(a, DATE '2001-08-05', INTERVAL 1 DAY)) AS DATE)
         AS posting_date FROM feeds)
SELECT partner, feed, posting_date, 'incomplete input' AS report
FROM expected ANTI JOIN published USING (partner, feed, posting_date)
WHERE posting_date + INTERVAL 1 DAY - INTERVAL 330 MINUTE + INTERVAL 8 HOUR
      <= TIMESTAMP '2001-08-05 03:00:00'
UNION ALL
SELECT partner, feed, posting_date,
       'reference ' || partner || '.' || feed || ' is at version ' || sequence_number
FROM published""",
)
def closed_windows(spark, sf):
    """What a publish reports: windows that closed without a version, and reference feeds moved."""
    now = datetime(2001, 8, 5, 3, tzinfo=UTC)
    _, done = _delivered(spark, sf, replace(S.FEED, reference=True), now)
    missing = done.missing.select(*D.DELIVERY, F.col("effect").alias("report"))
    return missing.unionByName(done.announced.select(*D.DELIVERY, F.col("message").alias("report")))


def _delivered(spark, sf, contract, now):
    """The rows that were loaded, and the publish of every version they make up."""
    rows = S.file_rows(spark, sf).select(
        "file_id", "settlement_id", "amount_paise", "posting_date"
    )
    parts = S.file_parts(spark, sf).withColumn("arrival", F.col("file_id"))
    register, stored = _none(spark, REGISTER), None
    for _ in range(2):
        got = file_delivery.receive(register, contract, parts, rows, NOW)
        load = _written_to(spark, got.rows, "load")
        stored = load if stored is None else stored.unionByName(load)
        register = _written_to(spark, got.register, "register")
    asked = S.requests(register)
    done = file_delivery.publish(register, _none(spark, POINTER), contract, asked, now)
    return stored, done


@query(
    "job_publish_fact",
    ctes(FACT, WINDOW)
    + """SELECT 1 AS attempt, txn_id, amount_paise FROM fact WHERE false
UNION ALL
SELECT 2, txn_id, amount_paise FROM fact
WHERE business_date IN (SELECT business_date FROM rebuilt)""",
)
def publish_fact(spark, sf):
    """A faulty build is held and stays invisible; a clean one goes live."""
    fact, dates = S.fact(spark, sf), rebuilt_dates(spark, sf)
    inputs = spark.createDataFrame(
        [("sales", True, "")], "name string, complete boolean, detail string"
    )
    releases, manifest, stored, seen = _none(spark, RELEASES), _none(spark, MANIFEST), None, None
    for attempt, build in ((1, S.faulty_fact(spark, sf)), (2, fact)):
        made = gate_publish.build_candidate(
            releases, S.TABLE, build, dates, {"sales": str(attempt)}, NOW
        )
        rows = _written_to(spark, made.rows, "fact")
        gated = gate_publish.publish_or_hold(
            made.releases, manifest, S.TABLE, made.release_id, rows, S.FACT_KEYS, inputs, fact, NOW
        )
        releases, manifest = gated.releases, gated.manifest
        stored = rows if stored is None else stored.unionByName(rows)
        live = release.read(stored, manifest, S.TABLE).select(
            F.lit(attempt).alias("attempt"), "txn_id", "amount_paise"
        )
        seen = live if seen is None else seen.unionByName(live)
    return seen


@query(
    "job_replace_window",
    ctes(FACT)
    + """SELECT CAST(date_trunc('month', business_date) AS DATE) AS business_month,
       count(*) AS rows, CAST(sum(amount_paise) AS BIGINT) AS amount_paise
FROM fact
WHERE year(business_date) <> 1998 OR (month(business_date) % 3 > 0 AND status <> 'INITIATED')
GROUP BY ALL""",
)
def replace_window(spark, sf):
    """A fact stored by month, of which one year is rebuilt, twice; a third of it is emptied."""
    month = F.col("business_month")
    fact = S.fact(spark, sf).withColumn(
        "business_month", F.trunc("business_date", "month")
    )
    table = f"fact_{uuid.uuid4().hex}"
    window_sink.create(spark, table, fact, "business_month", scratch(spark, table))
    months = [r[0] for r in fact.select(month).distinct().collect()]
    window_sink.replace_window(spark, table, fact, months, "business_month")
    window = [date(1998, m, 1) for m in range(1, 13)]
    for _ in range(2):
        rebuilt = spark.table(table).where(
            month.isin(window) & (F.month(month) % 3 > 0) & (F.col("status") != "INITIATED")
        )
        window_sink.replace_window(spark, table, rebuilt, window, "business_month")
    return spark.table(table).groupBy("business_month").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("amount_paise").alias("amount_paise")
    )


# ---- streams


@query("stream_merge", ctes(CHANGES, ALL) + f"SELECT {STATE} FROM state")
def stream_merge(spark, sf):
    """Changes appended as they come, and folded when the state is read."""
    path = scratch(spark, "changes")
    changes = S.changes_of(given_stream(spark, sf, "events"))
    running = change_stream.merge_stream(changes, path, scratch(spark, "checkpoint"), AVAILABLE)
    running.awaitTermination()
    appended = spark.read.schema(changes.schema).parquet(path)
    return change_stream.merged(appended, S.LOAN, S.MERGED_AT).drop("updated_at")


@query("stream_merge_state", ctes(CHANGES, ALL) + f"SELECT {STATE} FROM state")
def stream_merge_state(spark, sf):
    """Changes merged in three micro-batches that overlap, each into the buckets it touches."""
    changes = S.changes(spark, sf)
    sent, at = scratch(spark, "changes"), F.col("ingest_ts")
    for low, high in ((1, 12), (10, 20), (18, 32)):
        days = F.dayofmonth(at).between(low, high)
        changes.where(days).coalesce(1).write.mode("append").parquet(sent)
    stream = spark.readStream.schema(changes.schema).option("maxFilesPerTrigger", 1).parquet(sent)
    path = scratch(spark, "state")
    change_stream.merge_state_stream(
        stream, S.LOAN, path, scratch(spark, "checkpoint"), S.MERGED_AT, AVAILABLE
    ).awaitTermination()
    return change_stream.state(spark, changes.schema, S.LOAN, path).drop("updated_at")


@query(
    "job_merge_pruned",
    ctes(CHANGES, ALL)
    + f"""SELECT {STATE} FROM state WHERE loan_id IN (
  SELECT loan_id FROM changes WHERE ingest_ts >= TIMESTAMP '2024-01-30')""",
)
def merge_pruned(spark, sf):
    """The last day's changes merged into a table stored by key bucket: the rows to put."""
    last = datetime(2024, 1, 30)
    changes = S.changes(spark, sf)
    before = changes.where(F.col("ingest_ts") < F.lit(last))
    state = merge.merge_batch(cdc.empty_target(before, S.LOAN), S.LOAN, before, S.MERGED_AT)
    path = scratch(spark, "loan")
    placed = cdc.bucketed(state, S.LOAN)
    placed.write.partitionBy("bucket").parquet(path)
    stored = spark.read.schema(placed.schema).parquet(path)
    after = changes.where(F.col("ingest_ts") >= F.lit(last))
    return merge.upserts(stored, S.LOAN, after, S.MERGED_AT).drop("updated_at", "bucket")


@query(
    "stream_land_changes",
    """SELECT 'loan' AS source_table, strftime(ts, '%Y-%m-%d-%H') AS ingest_hour,
       count(*) AS changes FROM events GROUP BY ALL""",
)
def stream_land_changes(spark, sf):
    path = scratch(spark, "bronze")
    raw = envelopes(S.changes_of(given_stream(spark, sf, "events")))
    running = change_stream.land(
        raw, LOAN_ROW, 1, ["loan"], path, scratch(spark, "checkpoint"), AVAILABLE
    )
    running.awaitTermination()
    landed = spark.read.option("mergeSchema", "false").parquet(path)
    return landed.groupBy(
        F.col("routed_to").alias("source_table"),
        F.col("ingest_hour").cast("string").alias("ingest_hour"),
    ).agg(F.count(F.lit(1)).alias("changes"))


@query(
    "stream_route_changes",
    """SELECT CASE WHEN event_type = 'view' THEN 'unrouted' WHEN event_type = 'click' THEN 'unrouted'
            ELSE 'loan' END AS routed_to,
       CASE WHEN event_type = 'view' THEN '../other' WHEN event_type <> 'click' THEN 'loan'
            END AS source_table,
       event_type = 'click' AS unparsed, count(*) AS changes
FROM events GROUP BY ALL""",
)
def stream_route_changes(spark, sf):
    """Views come from a table that is not captured, clicks arrive cut off."""
    path = scratch(spark, "routed")
    sent = envelopes(S.changes_of(given_stream(spark, sf, "events")))
    kind = F.get_json_object("value", "$.after.status")
    value = F.when(
        kind == "view", F.regexp_replace("value", '"table":"loan"', '"table":"../other"')
    ).when(kind == "click", F.expr("left(value, length(value) - 1)"))
    raw = sent.withColumn("value", F.coalesce(value, F.col("value")))
    running = change_stream.land(
        raw, LOAN_ROW, 1, ["loan"], path, scratch(spark, "checkpoint"), AVAILABLE
    )
    running.awaitTermination()
    landed = spark.read.option("mergeSchema", "false").parquet(path)
    return landed.groupBy(
        "routed_to", "source_table", F.col("unparsed").isNotNull().alias("unparsed")
    ).agg(F.count(F.lit(1)).alias("changes"))


def _written(spark, frame):
    path = scratch(spark, "stream")
    running = (
        frame.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", scratch(spark, "checkpoint"))
        .trigger(**AVAILABLE)
        .start()
    )
    running.awaitTermination()
    return spark.read.schema(frame.schema).parquet(path)


@query("stream_dedup", "SELECT event_id, event_type FROM events")
def stream_dedup(spark, sf):
    """Each event sent twice."""
    sent = app_events(given_stream(spark, sf, "events")).withColumn(
        "attempt", F.explode(F.array(F.lit(1), F.lit(2)))
    )
    return _written(spark, event_stream.dedup(sent)).select("event_id", "event_type")


@query(
    "stream_signals",
    ctes(SIGNALS)
    + f"""SELECT {SIGNAL_COLUMNS} FROM signals
WHERE window_start + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""",
)
def stream_signals(spark, sf):
    """Signals of every window that the stream has closed."""
    sent = app_events(given_stream(spark, sf, "events")).withColumn(
        "attempt", F.explode(F.array(F.lit(1), F.lit(2)))
    )
    scored = event_stream.score_stream(sent, watched(spark, sf))
    return _written(spark, scored).withColumns(shown("window_start", "window_end"))




# Errors arrive one wave after their neighbours, and every purchase is sent again a wave later.
WAVES = """waves AS (
  SELECT event_id, ts, event_type, 1 + CAST(ts >= TIMESTAMP '2024-01-08' AS INT)
         + CAST(ts >= TIMESTAMP '2024-01-15' AS INT) + CAST(event_type = 'error' AS INT) AS wave
  FROM events),
sent AS (
  SELECT event_id, ts, wave FROM waves
  UNION ALL SELECT event_id, ts, wave + 1 FROM waves WHERE event_type = 'purchase'),
high AS (
  SELECT wave, max(max(ts)) OVER (ORDER BY wave ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
         AS before
  FROM sent GROUP BY wave)"""


def sent_in_waves(spark, sf):
    """The folder of a stream that takes one wave after the other, and its schema."""
    ts, kind = F.col("event_ts"), F.col("event_type")
    first = app_events(given(spark, sf, "events")).withColumn(
        "wave",
        F.lit(1)
        + (ts >= F.lit(datetime(2024, 1, 8))).cast("int")
        + (ts >= F.lit(datetime(2024, 1, 15))).cast("int")
        + (kind == "error").cast("int"),
    )
    again = first.where(kind == "purchase").withColumn("wave", F.col("wave") + 1)
    sent = first.unionByName(again)
    path = scratch(spark, "sent")
    for wave in range(1, 5):
        one = sent.where(F.col("wave") == wave).drop("wave")
        one.coalesce(1).write.mode("append").parquet(path)
    return path, sent.drop("wave").schema


def _settled_waves(spark, sf):
    path, schema = sent_in_waves(spark, sf)
    waves = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    out = scratch(spark, "settled")
    event_stream.settle_stream(
        waves, out, scratch(spark, "checkpoint"), timedelta(days=1), trigger=AVAILABLE
    ).awaitTermination()
    return out, schema


@query(
    "stream_late_exceptions",
    ctes(WAVES)
    + """SELECT event_id, s.wave,
       CASE WHEN row_number() OVER (PARTITION BY event_id ORDER BY s.wave) > 1 THEN 'duplicate'
            WHEN ts < before - INTERVAL 1 DAY THEN 'exception' ELSE 'accepted' END AS fate,
       1::BIGINT AS copies
FROM sent s JOIN high USING (wave)""",
)
def stream_late_exceptions(spark, sf):
    """Every event that was sent, with the wave it came in and what became of it."""
    out, schema = _settled_waves(spark, sf)
    return event_stream.settled(spark, out, schema).select(
        "event_id", (F.col("batch") + 1).cast("int").alias("wave"), "fate", "copies"
    )


@query(
    "stream_signals_of_settled",
    ctes(WAVES)
    + """, settled AS (
  SELECT event_id, coalesce(ts < before - INTERVAL 1 DAY, false) AS late,
         row_number() OVER (PARTITION BY event_id ORDER BY s.wave) AS nth
  FROM sent s JOIN high USING (wave)),
signals AS (
  SELECT e.user_id, date_trunc('hour', e.ts) AS window_start, count(*) AS events,
         CAST(sum(CAST(round(e.value * 100) AS BIGINT)) AS BIGINT) AS amount_paise
  FROM settled JOIN events e USING (event_id)
  WHERE nth = 1 AND NOT late AND e.event_type IN ('purchase', 'error')
  GROUP BY ALL)
SELECT user_id, strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start, events, amount_paise
FROM signals
WHERE window_start + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 1 DAY""",
)
def stream_signals_of_settled(spark, sf):
    """Signals of closed windows, from all that was accepted and nothing else."""
    out, schema = _settled_waves(spark, sf)
    rows = event_stream.accepted_stream(spark, out, schema)
    scored = event_stream.score_stream(rows, watched(spark, sf), delay="1 day")
    return _written(spark, scored).select(
        "user_id", "window_start", "events", "amount_paise"
    ).withColumns(shown("window_start"))
