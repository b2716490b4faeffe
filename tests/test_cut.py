from __future__ import annotations

from dataclasses import replace
from datetime import UTC, date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tieout.catalogue import jobs
from tieout.durable import materialise
from tieout.model import CUTS, MANIFEST, TRANSACTIONS, MergeSpec
from tieout.operators import cdc, release
from tieout.operators import cut as C
from tieout.plans import cut_advance, merge

T0 = datetime(2026, 3, 1, 10)
NOW = datetime(2026, 3, 2, tzinfo=UTC)
LOAN, LEDGER = "public.loan", "public.ledger_entry"


def ends(spark, *rows):
    return spark.createDataFrame(
        [
            (p, t, "END", None if counts is None else list(counts.items()),
             T0 + timedelta(minutes=p))
            for p, t, counts in rows
        ],
        TRANSACTIONS,
    )


def landed(spark, *rows):
    return spark.createDataFrame(
        list(rows), "transaction_id string, source_table string, landed bigint"
    )


def cut_of(spark, e, found, tracked=None):
    row = C.longest_complete_prefix(ends(spark, *e), landed(spark, *found), tracked).first()
    return row and row["transaction_id"]


def test_a_transaction_counts_once_every_event_has_landed(spark):
    end = (1, "t1", {LOAN: 1, LEDGER: 2})
    assert cut_of(spark, [end], [("t1", LOAN, 1), ("t1", LEDGER, 1)]) is None
    assert cut_of(spark, [end], [("t1", LOAN, 1), ("t1", LEDGER, 2)]) == "t1"


def test_a_complete_transaction_after_an_incomplete_one_waits(spark):
    e = [(3, "t3", {LOAN: 1}), (1, "t1", {LOAN: 1}), (2, "t2", {LOAN: 2})]
    assert cut_of(spark, e, [("t1", LOAN, 1), ("t2", LOAN, 1), ("t3", LOAN, 1)]) == "t1"


def test_more_events_than_declared_block_too(spark):
    assert cut_of(spark, [(1, "t1", {LOAN: 1})], [("t1", LOAN, 2)]) is None


def test_tables_nobody_loads_do_not_stall_the_cut(spark):
    e = [(1, "t1", {LOAN: 1, "public.heartbeat": 1}), (2, "t2", {"public.heartbeat": 1})]
    found = [("t1", LOAN, 1)]
    assert cut_of(spark, e, found) is None
    assert cut_of(spark, e, found, (LOAN,)) == "t2"


def test_a_transaction_without_collections_is_complete(spark):
    assert cut_of(spark, [(1, "t1", None), (2, "t2", {})], [("x", LOAN, 1)]) == "t2"


def test_nothing_ended_gives_no_cut(spark):
    assert cut_of(spark, [], [("t1", LOAN, 1)]) is None


def test_more_landed_events_never_move_the_cut_back(spark):
    e = [(i, f"t{i}", {LOAN: 2}) for i in range(1, 6)]
    last = 0
    for n in range(6):
        found = [(f"t{i}", LOAN, 2) for i in range(1, n + 1)] + [("x", LOAN, 1)]
        got = cut_of(spark, e, found)
        at = int(got[1:]) if got else 0
        assert at >= last
        last = at
    assert last == 5


def test_redelivered_events_count_once(spark):
    rows = spark.createDataFrame(
        [("t1", 1), ("t1", 1), ("t1", 2), ("t1", None)], "transaction_id string, source_lsn bigint"
    )
    (row,) = C.landed_counts({LOAN: rows}).collect()
    assert row["landed"] == 2


def test_masks_count_like_a_distinct(spark):
    numbers = [None, 0, 1, 63, 64, 65, -1, -64, -65, 2**63 - 1, -(2**63), 10**12, 10**12 + 1]
    rows = [(k, n) for i, n in enumerate(numbers) for k in ("a", None) if k or i % 2 for _ in "ab"]
    rows = spark.createDataFrame([*rows, ("none", None)], "k string, n bigint")
    found = C.distinct_numbers(rows, ("k",), "n", "found")
    wanted = rows.groupBy("k").agg(F.count_distinct("n").alias("found"))
    assert found.dtypes == wanted.dtypes
    assert set(found.collect()) == set(wanted.collect())


def test_lines_of_a_transaction_travel_as_one(spark, tmp_path):
    lines = [(f"t{i}", n) for i in range(20) for n in range(50)]
    lines = spark.createDataFrame(lines, "transaction_id string, source_lsn bigint").coalesce(1)
    lines.write.parquet(str(tmp_path / "lines"))
    counts = C.landed_counts({LEDGER: spark.read.parquet(str(tmp_path / "lines"))})
    assert {r["landed"] for r in counts.collect()} == {50}
    assert max(shuffled_rows(counts)) == 20


def shuffled_rows(frame):
    """Rows that each exchange of a frame wrote when it was collected."""
    plan, found = frame._jdf.queryExecution().executedPlan(), []

    def walk(node):
        if "QueryStage" in node.getClass().getSimpleName():
            return walk(node.plan())
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if node.nodeName() == "Exchange":
            found.append(node.metrics().apply("shuffleRecordsWritten").value())
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    walk(plan)
    return found


def test_the_stuck_transaction_is_named(spark):
    e = ends(spark, (1, "t1", {LOAN: 1}), (2, "t2", {LOAN: 1, LEDGER: 2}), (3, "t3", {LOAN: 9}))
    rows = C.first_incomplete(e, landed(spark, ("t1", LOAN, 1), ("t2", LOAN, 1))).collect()
    assert [(r["transaction_id"], r["source_table"], r["expected"], r["landed"]) for r in rows] == [
        ("t2", LEDGER, 2, 0)
    ]


def test_a_date_is_complete_once_the_cut_passed_its_end(spark):
    dates = spark.createDataFrame([("db", date(2026, 3, 1))], "source string, business_date date")
    wanted = C.cutoffs(dates, "UTC")

    def status(at):
        rows = [("db", at)] if at else []
        cut = spark.createDataFrame(rows, "source string, committed_at timestamp")
        return C.input_status(cut, wanted).first()

    early = status(datetime(2026, 3, 1, 23, 58))
    assert not early["complete"]
    assert early["detail"] == "cut has reached 2026-03-01T23:58:00"
    assert status(datetime(2026, 3, 2, 0, 0, 10))["complete"]
    assert status(datetime(2026, 3, 2))["complete"]
    assert status(None)["detail"] == "cut has reached nothing yet"
    micro = status(datetime(2026, 3, 1, 1, 2, 3, 450))
    assert micro["detail"] == "cut has reached 2026-03-01T01:02:03.000450"


def test_business_days_end_at_midnight_in_their_zone(spark):
    dates = spark.createDataFrame([(date(2026, 3, 1),)], "business_date date")
    text = F.date_format("cutoff", "yyyy-MM-dd HH:mm")
    assert C.cutoffs(dates).select(text).first()[0] == "2026-03-01 18:30"


LOANS = MergeSpec(("loan_id",), ("status",))
LINES = MergeSpec(("entry_id",), ("amount_paise",))


class Lake:
    """Keeps what each advance returns, rows under their release."""

    def __init__(self, spark):
        self.spark = spark
        self.cuts, self.manifest = spark.createDataFrame([], CUTS), spark.createDataFrame([], MANIFEST)
        self.rows, self.number = {}, 0

    def tables(self, loans, lines):
        at = T0 + timedelta(minutes=1)
        tail = ("op string, source_incarnation int, source_lsn bigint, transaction_id string, "
                "ingest_ts timestamp")
        loan = self.spark.createDataFrame(
            [(k, "A", "c", 1, lsn, t, at) for k, lsn, t in loans],
            f"loan_id string, status string, {tail}")
        line = self.spark.createDataFrame(
            [(k, 100, "c", 1, lsn, t, at) for k, lsn, t in lines],
            f"entry_id string, amount_paise bigint, {tail}")
        return {
            name: cut_advance.CapturedTable(rows, table, spec, self.state(table, rows, spec))
            for name, rows, table, spec in (
                (LOAN, loan, "loan", LOANS), (LEDGER, line, "ledger", LINES))
        }

    def state(self, table, changes, spec):
        if table not in self.rows:
            return cdc.empty_target(changes, spec)
        head = release.read(self.rows[table], self.manifest, table)
        return head.drop("slice", "release_id")

    def keep(self, table, state):
        placed = state.withColumns(
            {"slice": F.lit("all"), "release_id": F.lit(self.number).cast("bigint")})
        old = self.rows.get(table)
        if old is not None:
            placed = old.where(F.col("release_id") != self.number).unionByName(placed)
        self.rows[table] = materialise(placed)
        pointed = self.spark.createDataFrame(
            [(table, "all", self.number)], "table_name string, slice string, release_id bigint")
        self.manifest = materialise(release.publish(self.manifest, pointed, NOW))

    def advance(self, e, loans, lines):
        moved = cut_advance.advance(
            self.cuts, "db", e, self.tables(loans, lines), self.number + 1, NOW)
        if moved is None:
            return None
        self.number += 1
        for table, state in moved.states.items():
            self.keep(table, state)
        self.cuts = moved.cuts
        return moved.cut


def test_tables_advance_together_and_past_cuts_stay_readable(spark):
    e = ends(spark, (1, "t1", {LOAN: 1, LEDGER: 2}), (2, "t2", {LOAN: 1, LEDGER: 1}))
    loans = [("L1", 10, "t1"), ("L2", 20, "t2")]
    lake = Lake(spark)

    def at(table, position):
        rows = C.read_at(lake.rows[table], lake.manifest, lake.cuts, table, "db", position, NOW)
        return cdc.live_rows(rows).count()

    assert lake.advance(e, loans, [("E1", 11, "t1")]) is None
    first = lake.advance(e, loans, [("E1", 11, "t1"), ("E2", 12, "t1")])
    assert first["transaction_id"] == "t1"
    everything = [("E1", 11, "t1"), ("E2", 12, "t1"), ("E3", 21, "t2"), ("E3", 21, "t2")]
    second = lake.advance(e, loans, everything)
    assert second["transaction_id"] == "t2"
    assert lake.advance(e, loans, everything) is None
    assert at("loan", 1) == 1
    assert at("ledger", 1) == 2
    assert at("loan", 2) == 2
    assert at("ledger", 2) == 3


def test_a_run_that_died_before_its_cut_was_recorded_is_run_again(spark):
    e = ends(spark, (1, "t1", {LOAN: 1, LEDGER: 1}))
    loans, lines = [("L1", 10, "t1")], [("E1", 11, "t1")]
    lake = Lake(spark)
    loan = lake.tables(loans, lines)[LOAN]
    lake.number = 1
    lake.keep("loan", merge.merge_batch(loan.state, LOANS, loan.bronze, NOW))  # then it died
    lake.number = 0
    assert lake.advance(e, loans, lines)["position"] == 1
    assert release.read(lake.rows["loan"], lake.manifest, "loan").count() == 1


def test_an_unsupported_change_fails_before_any_table_has_a_next_state(spark):
    e = ends(spark, (1, "t1", {LOAN: 1, LEDGER: 1}))
    lake = Lake(spark)
    tables = lake.tables([("L1", 10, "t1")], [("E1", 11, "t1")])
    bad = replace(tables[LEDGER], bronze=tables[LEDGER].bronze.withColumn("op", F.lit("t")))
    with pytest.raises(Exception, match="unsupported change operation: t"):
        cut_advance.advance(lake.cuts, "db", e, {**tables, LEDGER: bad}, 1, NOW)


def test_a_batch_is_dealt_out_by_key_once(spark, monkeypatch, tmp_path):
    """Its fold goes straight into the join; only the state is dealt out beside it."""
    monkeypatch.setattr(merge, "materialise", lambda frame: pytest.fail("the fold was stored"))
    loans = Lake(spark).tables([(f"L{i}", i, "t1") for i in range(100)], [])[LOAN].bronze
    loans.write.parquet(str(tmp_path / "loans"))
    batch = spark.read.parquet(str(tmp_path / "loans"))
    state = materialise(cdc.apply_changes(cdc.empty_target(batch, LOANS), batch, LOANS, NOW))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        after = merge.merge_batch(state, LOANS, batch, NOW)
        assert len(after.collect()) == 100
        assert sum(shuffled_rows(after)) == 200
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_both_runs_of_the_job_read_what_has_landed_from_where_it_is_stored(
    spark, monkeypatch, tmp_path
):
    read, real, folder = [], cut_advance.advance, f"{tmp_path}/given"
    spark.createDataFrame(
        [(k, "O", 10.5, datetime(1998 + k, 3, 1)) for k in (0, 1)],
        "o_orderkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp",
    ).write.parquet(f"{folder}/orders.parquet")
    spark.createDataFrame(
        [(k, n, 5.0, 1.25) for k in (0, 1) for n in (1, 2, 2)],
        "l_orderkey bigint, l_linenumber int, l_quantity double, l_extendedprice double",
    ).write.parquet(f"{folder}/lineitem.parquet")

    def advance(cuts, source, transactions, tables, *rest):
        for frame in (transactions, *(t.bronze for t in tables.values())):
            read.append(frame.inputFiles())
        return real(cuts, source, transactions, tables, *rest)

    monkeypatch.setattr(cut_advance, "advance", advance)
    keys = [r["key"] for r in jobs.advance_source(spark, folder).collect()]
    assert sorted(keys) == ["0", "0-1", "0-2", "1", "1-1", "1-2"]
    assert len(read) == 6
    assert read[:3] == read[3:]
    assert not [f for files in read for f in files if folder in f]


def test_a_cut_expires_after_a_week(spark):
    rows = [("db", i, f"t{i}", T0, "loan", i, NOW - timedelta(days=d, minutes=1))
            for i, d in enumerate((6, 7))]
    cuts = spark.createDataFrame(rows, CUTS)
    assert [r["position"] for r in C.unexpired(cuts, NOW).collect()] == [0]
    stored = spark.createDataFrame(
        [("a", "1", 0), ("b", "1", 1)], "id string, slice string, release_id bigint"
    )
    manifest = spark.createDataFrame(
        [("loan", "1", 0, T0, NOW), ("loan", "1", 1, NOW, None)], MANIFEST
    )

    def read(position, table="loan"):
        return C.read_at(stored, manifest, cuts, table, "db", position, NOW).collect()

    assert [r["id"] for r in read(0)] == ["a"]
    for position, table in ((1, "loan"), (7, "loan"), (0, "ledger")):
        with pytest.raises(Exception, match=f"no cut of db is kept for {table} at {position}"):
            read(position, table)
