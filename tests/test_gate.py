from __future__ import annotations

import hashlib
from datetime import UTC, date, datetime, timedelta

import pytest

from pyspark.sql import functions as F

from tieout.durable import materialise
from tieout.model import MANIFEST, RELEASES, TAGS
from tieout.operators import gate, gold, release, serving
from tieout.plans import gate_publish as jobs

NOW = datetime(2026, 3, 3, tzinfo=UTC)
DAY1, DAY2 = date(2026, 3, 1), date(2026, 3, 2)
FACT = "txn_id string, business_line string, business_date date, amount_paise bigint"
KEYS = ("txn_id",)
BASE = [("t1", DAY1, 5000), ("t2", DAY1, 7000), ("t3", DAY2, 9000)]


def fact(spark, rows):
    return spark.createDataFrame([(k, "lending", d, a) for k, d, a in rows], FACT)


def inputs(spark, *rows):
    return spark.createDataFrame(
        list(rows) or [("north.settlement", True, "")],
        "name string, complete boolean, detail string",
    )


class Gold:
    """Builds and gates one fact, and keeps what the jobs return."""

    def __init__(self, spark):
        self.spark = spark
        self.releases, self.manifest, self.tags = (
            spark.createDataFrame([], schema) for schema in (RELEASES, MANIFEST, TAGS)
        )
        self.rows = spark.createDataFrame([], f"{FACT}, slice string, release_id bigint")

    def build(self, rows, dates=(DAY1, DAY2), label=None):
        made = jobs.build_candidate(
            self.releases, "fact", fact(self.spark, rows), dates, label or {"db": "1"}, NOW
        )
        self.rows = materialise(self.rows.unionByName(made.rows))
        self.releases = materialise(made.releases)
        return made.release_id

    def candidate(self, release_id):
        return self.rows.where(F.col("release_id") == release_id)

    def check(self, release_id, reference, held_by=()):
        result = jobs.publish_or_hold(
            self.releases, self.manifest, "fact", release_id, self.candidate(release_id), KEYS,
            inputs(self.spark, *held_by), fact(self.spark, reference), NOW,
        )
        self.releases, self.manifest = materialise(result.releases), materialise(result.manifest)
        return result

    def read(self, release_id=None, between=None):
        return release.read(self.rows, self.manifest, "fact", release_id, between)

    def publish(self, rows, reference=None, **how):
        return self.check(self.build(rows, **how), rows if reference is None else reference)

    def live(self):
        rows = self.read().collect()
        return sorted((r["txn_id"], r["amount_paise"]) for r in rows)


@pytest.fixture
def golden(spark):
    return Gold(spark)


def reasons(result):
    return [r["reason"] for r in result.reasons.collect()]


def test_swapped_amounts_differ_only_in_the_fingerprint(golden):
    result = golden.publish([("t1", DAY1, 7000), ("t2", DAY1, 5000), BASE[2]], BASE)
    assert not result.published
    (reason,) = reasons(result)
    assert reason.startswith("lending 2026-03-01: row_count 2 vs 2, amount_paise 12000 vs 12000, "
                             "distinct_keys 2 vs 2, fingerprint ")
    assert golden.live() == []


def test_an_incomplete_input_holds_and_keeps_the_candidate(golden):
    golden.publish([("t0", DAY1, 1)])
    built = golden.build(BASE)
    result = golden.check(built, [], [("north.settlement", False, "no version for 2026-03-02")])
    assert reasons(result) == [
        "input not complete: north.settlement (no version for 2026-03-02)"
    ]
    assert golden.live() == [("t0", 1)]
    assert golden.candidate(built).count() == 3


def test_a_clean_build_goes_live_with_its_label(golden):
    assert golden.publish(BASE, label={"lending": "120"}).published
    assert len(golden.live()) == 3
    row = release.label(golden.releases).first()
    assert (row["source"], row["at"]) == ("lending", "120")


def test_the_reference_is_the_one_that_was_read(golden):
    built = golden.build(BASE)
    moved = [*BASE, ("t4", DAY2, 1)]
    assert not golden.check(built, moved).published
    assert golden.check(golden.build(BASE), BASE).published


def test_a_date_without_rows_becomes_empty(golden):
    golden.publish(BASE)
    assert golden.publish(BASE[:2]).published
    assert golden.live() == [("t1", 5000), ("t2", 7000)]


def test_a_cell_on_one_side_holds(golden):
    result = golden.publish(BASE, BASE[:2])
    (reason,) = reasons(result)
    assert reason.startswith("lending 2026-03-02: row_count 1 vs None")


def test_rows_outside_the_window_stay_out(golden):
    assert golden.publish(BASE, dates=(DAY1,)).published
    assert golden.live() == [("t1", 5000), ("t2", 7000)]


def test_a_build_on_an_old_head_is_refused(golden):
    golden.publish([("t0", DAY1, 1)])
    mine = golden.build(BASE)
    assert golden.publish([("rogue", DAY1, 2)]).published
    with pytest.raises(jobs.HeadMoved):
        golden.check(mine, BASE)
    assert golden.live() == [("rogue", 2)]


def test_a_pinned_release_is_read_as_it_was(golden):
    golden.publish(BASE)
    golden.publish(BASE[:1])
    assert golden.read(1).count() == 3
    assert golden.read().count() == 1


def test_a_pinned_read_of_some_dates_reads_only_their_partitions(golden, tmp_path):
    golden.publish(BASE)
    golden.rows.write.partitionBy("slice", "release_id").parquet(str(tmp_path / "rows"))
    stored = golden.spark.read.schema(golden.rows.schema).parquet(str(tmp_path / "rows"))
    some = release.read(stored, golden.manifest, "fact", 1, (str(DAY2), str(DAY2)))
    assert [r["txn_id"] for r in some.collect()] == ["t3"]
    plan = some._jdf.queryExecution().executedPlan().toString()
    scan = next(x for x in plan.splitlines() if "PartitionFilters" in x)
    assert "slice" in scan.split("PartitionFilters")[1].split("PushedFilters")[0]


@pytest.mark.parametrize("key, amount", [("t1", 5000), ("t2", -45000), ("ಕನ್ನಡ-7", 0),
                                         ("t4", 9_000_000_000_000)])
def test_every_engine_hashes_the_same_text(spark, key, amount):
    row = gate.fingerprint(fact(spark, [(key, DAY1, amount)]), KEYS).first()
    digest = hashlib.md5(f"{key}|{amount}".encode()).hexdigest()
    assert row["fingerprint"] == int(digest[:8], 16)
    if key == "t1":
        assert row["fingerprint"] == 980303557


def test_breaks_are_the_same_from_either_side(spark):
    a = gate.cell_totals(fact(spark, BASE), KEYS)
    b = gate.cell_totals(fact(spark, BASE[1:]), KEYS)
    one = {(r["business_date"], r["c_row_count"], r["r_row_count"]) for r in gate.breaks(a, b).collect()}
    two = {(r["business_date"], r["r_row_count"], r["c_row_count"]) for r in gate.breaks(b, a).collect()}
    assert one == two == {(DAY1, 2, 1)}


def test_a_duplicate_key_behind_a_dropped_row_is_classified(spark):
    candidate = fact(spark, [("t1", DAY1, 6000), ("t1", DAY1, 6000)])
    broken = gate.breaks(gate.cell_totals(candidate, KEYS), gate.cell_totals(fact(spark, BASE[:2]), KEYS))
    assert gate.classify(broken).first()["fault"] == "duplicate keys"


def test_a_sum_that_overflows_fails_and_is_found(spark):
    rows = fact(spark, [("t1", DAY1, 2**62), ("t2", DAY1, 2**62), ("t3", DAY2, 1)])
    with pytest.raises(Exception, match="OVERFLOW"):
        gate.cell_totals(rows, KEYS).collect()
    (cell,) = gate.overflow_cells(rows).collect()
    assert (cell["business_date"], int(cell["total"])) == (DAY1, 2**63)


def test_sums_that_could_wrap_are_refused(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(ValueError):
            gate.cell_totals(fact(spark, BASE), KEYS)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_rows_the_fingerprint_cannot_tell_apart_are_shown(spark):
    rows = fact(spark, [("t1", DAY1, 1), (None, DAY1, 1), ("t2", None, 1), ("t3", DAY1, None)])
    assert gate.unusable_rows(rows, KEYS).count() == 3


def test_repeated_keys_are_compared_without_pairing_them(spark):
    left = fact(spark, [("t1", DAY1, 1)] * 50)
    right = fact(spark, [("t1", DAY1, 1)] * 49)
    (row,) = gate.row_diff(left, right, KEYS).collect()
    assert (row["c_rows"], row["r_rows"], row["difference"]) == (50, 49, "row count differs")


def test_holds_age(spark):
    rows = [("a", i, None, [], {}, "HELD", "", NOW - timedelta(hours=h), None, False)
            for i, h in enumerate((1, 24, 25, 24 * 14 + 1))]
    found = gate.open_holds(spark.createDataFrame(rows, RELEASES), NOW).collect()
    assert [r["status"] for r in sorted(found, key=lambda r: r["release_id"])] == [
        "open", "open", "escalate", "expired"
    ]


def test_of_two_candidates_on_one_head_the_first_publishes(spark):
    schema = "table_name string, release_id bigint, parent_release bigint, created_at timestamp"
    candidates = spark.createDataFrame(
        [("a", 5, 3, NOW), ("a", 4, 3, NOW), ("a", 6, 2, NOW), ("b", 1, None, NOW)], schema)
    heads = spark.createDataFrame([("a", 3)], "table_name string, release_id bigint")
    got = release.publishable(candidates, heads).collect()
    assert sorted((r["table_name"], r["release_id"]) for r in got) == [("a", 4), ("b", 1)]


def test_a_month_end_tag_never_moves(golden):
    golden.publish(BASE)
    golden.tags = jobs.tag_month_end(golden.tags, golden.releases, "fact", DAY1, NOW)
    golden.publish(BASE[:1])
    golden.tags = jobs.tag_month_end(golden.tags, golden.releases, "fact", DAY1, NOW)
    (tag,) = golden.tags.collect()
    assert (tag["tag"], tag["release_id"]) == ("month_end_2026_03", 1)


def test_a_release_is_reconciled_once_its_closed_dates_tie(golden, spark):
    golden.publish(BASE)
    reported = gate.cell_totals(fact(spark, BASE), KEYS)

    def run(totals, *closed):
        dates = spark.createDataFrame([(d,) for d in closed], "business_date date")
        found, golden.releases = jobs.reconcile(
            golden.rows, golden.releases, golden.manifest, "fact", KEYS, totals, dates)
        status = found.collect()
        flag = golden.releases.first()["reconciled"]
        return sorted((r["business_date"], r["status"]) for r in status), flag

    assert run(reported, DAY1) == (
        [(DAY1, "reconciled"), (DAY2, "checked against silver")], False)
    wrong = gate.cell_totals(fact(spark, BASE[:2]), KEYS)
    assert run(wrong, DAY1, DAY2) == (
        [(DAY1, "reconciled"), (DAY2, "no control totals")], False)
    assert run(reported, DAY1, DAY2) == ([(DAY1, "reconciled"), (DAY2, "reconciled")], True)


def test_a_build_never_mixes_two_cuts_of_one_source(spark):
    rows = spark.range(1)
    with pytest.raises(ValueError):
        gold.version_label([gold.PinnedInput("db", "1", rows), gold.PinnedInput("db", "2", rows)])


def test_inputs_are_labelled_by_what_was_read(spark):
    changes = spark.createDataFrame([("t1", 1), ("t2", 2)], "transaction_id string, n int")
    ends = spark.createDataFrame([("t1", 5), ("t2", 6)], "transaction_id string, position bigint")
    found = gold.at_cut("db", changes, ends, ends.where("position = 5").first())
    assert (found.at, [r["n"] for r in found.rows.collect()]) == ("5", [1])

    rows = spark.createDataFrame(
        [("p", "f", DAY1, v, v) for v in (1, 2)],
        "partner string, feed string, posting_date date, sequence_number bigint, n bigint")
    later = NOW.replace(year=NOW.year + 1)
    pointer = spark.createDataFrame(
        [("p", "f", DAY1, 1, None, NOW, later), ("p", "f", DAY1, 2, None, later, None)],
        "partner string, feed string, posting_date date, sequence_number bigint, "
        "approved_by string, valid_from timestamp, valid_to timestamp")
    found = gold.at_instant("p.f", rows, pointer, NOW).shaped(lambda known: known.select("n"))
    assert [tuple(r) for r in found.rows.collect()] == [(1,)]
    assert found.at == NOW.astimezone(UTC).replace(tzinfo=None).isoformat(sep=" ")


def test_only_a_published_version_is_copied(spark):
    releases = spark.createDataFrame(
        [("fact", 1, None, ["a"], {"db": "7"}, "PUBLISHED", "", NOW, NOW, False),
         ("fact", 2, 1, ["a"], {"db": "8"}, "HELD", "", NOW, None, False)], RELEASES)
    manifest = spark.createDataFrame([("fact", "a", 1, NOW, None)], MANIFEST)
    rows = spark.createDataFrame([("x", "a", 1), ("y", "a", 2)],
                                 "txn_id string, slice string, release_id bigint")
    copy, log = serving.load_copy(rows, manifest, releases, "fact", 1, NOW)
    assert [(r["txn_id"], r["version_label"]) for r in copy.collect()] == [("x", "db@7")]
    assert log.count() == 1
    copy, log = serving.load_copy(rows, manifest, releases, "fact", 2, NOW)
    assert copy.count() == 0 and log.count() == 0


def test_rows_without_a_key_or_a_date_hold_a_build(spark):
    rows = fact(spark, BASE)
    undated = rows.withColumn("business_date", F.lit(None).cast("date"))
    assert {r[0] for r in gate.unusable_reasons(undated, KEYS, "reference").collect()} == {
        f"reference: {rows.count()} rows without business_date"
    }
    kept = gate.in_window(undated, [DAY1])
    assert kept.count() == rows.count()
    found = [r[0] for r in gate.reasons(kept, rows, inputs(spark), KEYS).collect()]
    assert f"candidate: {rows.count()} rows without business_date" in found
