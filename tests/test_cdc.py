"""The ordered merge, against a model that takes one change at a time."""

from __future__ import annotations

import random
from datetime import UTC, datetime

import pytest

from tieout.model import MergeSpec
from tieout.operators import cdc
from tieout.plans import merge

SPEC = MergeSpec(("loan_id",), ("status", "loan_terms"), ("loan_terms",))
SCHEMA = (
    "loan_id string, status string, loan_terms string, op string, source_incarnation int, "
    "source_lsn bigint"
)
NOW = datetime(2024, 1, 1, tzinfo=UTC)
HIDDEN = "__debezium_unavailable_value"


def change(op, lsn, status=None, terms=None, inc=1, key="L1"):
    return (key, status, terms, op, inc, lsn)


def after(spark, *batches):
    state = None
    for batch in batches:
        frame = spark.createDataFrame(batch, SCHEMA)
        state = cdc.empty_target(frame, SPEC) if state is None else state
        state = cdc.apply_changes(state, frame, SPEC, NOW)
        rows = [tuple(r) for r in state.collect()]
        state = spark.createDataFrame(rows, state.schema)
    return {r["loan_id"]: r for r in state.collect()}


def test_an_older_update_changes_nothing(spark):
    row = after(
        spark,
        [change("c", 10, "APPROVED")],
        [change("u", 30, "DISBURSED")],
        [change("u", 20, "REJECTED")],
    )["L1"]
    assert (row["status"], row["source_lsn"]) == ("DISBURSED", 30)


def test_a_deleted_row_stays_deleted(spark):
    row = after(
        spark, [change("c", 10, "APPROVED")], [change("d", 30)], [change("u", 20, "DISBURSED")]
    )["L1"]
    assert row["is_deleted"] and row["status"] is None


def test_a_delete_before_its_insert_wins(spark):
    assert after(spark, [change("d", 20)], [change("c", 10, "APPROVED")])["L1"]["is_deleted"]


@pytest.mark.parametrize("op", ["t", None])
def test_an_unsupported_operation_fails_the_batch(spark, op):
    with pytest.raises(Exception, match="unsupported change operation"):
        after(spark, [change("c", 10, "APPROVED")], [change(op, 20)])


def test_a_truncate_hidden_by_a_newer_change_still_fails(spark):
    with pytest.raises(Exception, match="unsupported change operation: t"):
        after(spark, [change("c", 10, "APPROVED"), change("t", 20), change("u", 30, "CLOSED")])


def test_a_change_without_a_position_fails(spark):
    with pytest.raises(Exception, match="without a source position"):
        after(spark, [change("c", None, "APPROVED")])


def test_a_new_incarnation_outranks_higher_positions(spark):
    row = after(
        spark,
        [change("c", 900, "DISBURSED")],
        [change("u", 5, "CLOSED", inc=2)],
        [change("u", 950, "REJECTED")],
    )["L1"]
    assert row["status"] == "CLOSED"


def test_an_unchanged_large_column_keeps_its_value(spark):
    first, second = change("c", 10, "APPROVED", "12 months"), change("u", 20, "DISBURSED", HIDDEN)
    for batches in ([[first], [second]], [[first, second]]):
        row = after(spark, *batches)["L1"]
        assert (row["status"], row["loan_terms"]) == ("DISBURSED", "12 months")


def test_a_null_large_column_clears_it(spark):
    row = after(
        spark,
        [change("c", 10, "A", "12 months"), change("u", 20, "B", None), change("u", 30, "C", HIDDEN)],
    )["L1"]
    assert row["loan_terms"] is None


def test_nothing_survives_a_delete_in_the_batch(spark):
    row = after(
        spark,
        [change("c", 10, "A", "12 months")],
        [change("d", 20), change("u", 30, "B", HIDDEN)],
    )["L1"]
    assert (row["status"], row["loan_terms"], row["is_deleted"]) == ("B", None, False)


def one_at_a_time(changes):
    state = {}
    for key, status, terms, op, inc, lsn in sorted(changes, key=lambda c: (c[4], c[5])):
        old = state.get(key)
        if op == "d":
            state[key] = (None, None, inc, lsn, True)
        else:
            if terms == HIDDEN:
                terms = old[1] if old else None
            state[key] = (status, terms, inc, lsn, False)
    return state


def random_changes(rng, n):
    positions = rng.sample(range(1, 10 * n), n)
    return [
        change(
            rng.choice("cuuurd"),
            lsn,
            rng.choice("ABCD"),
            rng.choice([HIDDEN, HIDDEN, None, "x", "y"]),
            inc=rng.choice([1, 2]),
            key=f"L{rng.randint(1, 6)}",
        )
        for lsn in positions
    ]


@pytest.mark.parametrize("seed", range(4))
def test_any_batch_equals_one_change_at_a_time(spark, seed):
    rng = random.Random(seed)
    changes = random_changes(rng, 60)
    ordered = sorted(changes, key=lambda c: (c[4], c[5]))
    cut = rng.randint(1, 59)
    first = ordered[:cut]
    second = ordered[cut:] + rng.sample(first, min(5, cut))  # replays among the new ones
    rng.shuffle(first)
    rng.shuffle(second)
    found = after(spark, first, second)
    got = {
        k: (r["status"], r["loan_terms"], r["source_incarnation"], r["source_lsn"], r["is_deleted"])
        for k, r in found.items()
    }
    assert got == one_at_a_time(changes)


@pytest.mark.parametrize("seed", range(2))
def test_arrival_order_does_not_matter_for_small_columns(spark, seed):
    rng = random.Random(100 + seed)
    changes = random_changes(rng, 40)
    shuffled = rng.sample(changes, len(changes))
    found = after(spark, shuffled[:13], shuffled[13:25], shuffled[25:])
    expected = one_at_a_time(changes)
    assert {k: (r["status"], r["is_deleted"]) for k, r in found.items()} == {
        k: (v[0], v[4]) for k, v in expected.items()
    }


def test_an_export_is_never_tagged_zero(spark):
    with pytest.raises(ValueError):
        cdc.base_load(spark.range(1), 0, 1)


def test_a_swept_row_is_not_revived_by_its_old_incarnation(spark):
    frame = spark.createDataFrame([change("c", 900, "A")], SCHEMA)
    state = cdc.apply_changes(cdc.empty_target(frame, SPEC), frame, SPEC, NOW)
    swept = cdc.sweep(state, SPEC, 2, 5, NOW)
    late = spark.createDataFrame([change("u", 950, "B")], SCHEMA)
    row = cdc.apply_changes(swept, late, SPEC, NOW).first()
    assert row["is_deleted"] and row["status"] is None and row["source_incarnation"] == 2


def test_a_row_deleted_before_the_sweep_is_not_revived_either(spark):
    first = spark.createDataFrame([change("c", 800, "A"), change("d", 900, None)], SCHEMA)
    state = cdc.apply_changes(cdc.empty_target(first, SPEC), first, SPEC, NOW)
    swept = cdc.sweep(state, SPEC, 2, 5, NOW)
    late = spark.createDataFrame([change("u", 950, "B")], SCHEMA)
    row = cdc.apply_changes(swept, late, SPEC, NOW).first()
    assert row["is_deleted"] and row["status"] is None and row["source_lsn"] == 5


def test_a_failed_batch_fails_before_there_is_a_next_state(spark):
    good = spark.createDataFrame([change("c", 10, "A", "x")], SCHEMA)
    bad = spark.createDataFrame([change("t", 20), change("u", 30, "B", key="L2")], SCHEMA)
    state = merge.merge_batch(cdc.empty_target(good, SPEC), SPEC, good, NOW)
    with pytest.raises(Exception, match="unsupported"):
        merge.merge_batch(state, SPEC, bad, NOW)
    with pytest.raises(Exception, match="unsupported"):
        merge.upserts(state, SPEC, bad, NOW)
    assert [(r["loan_id"], r["status"]) for r in state.collect()] == [("L1", "A")]


def test_upserts_are_the_rows_of_the_batch_alone(spark):
    many = spark.createDataFrame([change("c", 10, "A", key=f"L{i}") for i in range(50)], SCHEMA)
    state = merge.merge_batch(cdc.empty_target(many, SPEC), SPEC, many, NOW)
    some = [change("u", 20, "B", key="L7"), change("u", 5, "old", key="L8"),
            change("c", 1, "new", key="M1")]
    batch = spark.createDataFrame(some, SCHEMA)
    put = merge.upserts(state, SPEC, batch, NOW)
    assert {r["loan_id"]: r["status"] for r in put.collect()} == {"L7": "B", "L8": "A", "M1": "new"}
    whole = merge.merge_batch(state, SPEC, batch, NOW)
    rest = state.join(put, "loan_id", "left_anti")
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, rest.unionByName(put).collect()))
