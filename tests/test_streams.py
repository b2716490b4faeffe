"""Streams that lose nothing: late events, and a state that is merged batch by batch."""

from __future__ import annotations

import random
from collections import Counter
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tieout import fixed_values as V
from tieout.model import MergeSpec
from tieout.operators import cdc
from tieout.operators import events as E
from tieout.plans import merge
from tieout.streaming import changes as changes_stream
from tieout.streaming import events as streams

SCHEMA = "event_id int, event_ts timestamp, position int"
T0 = datetime(2026, 3, 1)


def at(hours):
    return T0 + timedelta(hours=hours)


def write(spark, folder, rows, schema=SCHEMA):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)


def settle(spark, tmp_path, batches, **options):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    for rows in batches:
        write(spark, folder, rows)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)
    streams.settle_stream(
        stream, out, str(tmp_path / "check"), trigger={"availableNow": True}, **options
    ).awaitTermination()
    return streams.settled(spark, out, stream.schema)


def one_by_one(batches, delay):
    """What becomes of each row, batch by batch: the model."""
    known, high, fates = set(), None, Counter()
    for rows in batches:
        first = {}
        for e, ts, p in rows:
            if e is None or ts is None:
                fates["exception"] += 1
            elif e not in first or p < first[e][1]:
                first[e] = (ts, p)
        sent = Counter(e for e, ts, _ in rows if e is not None and ts is not None)
        for e, (ts, _) in first.items():
            fates["duplicate"] += sent[e] - 1
            if e in known:
                fates["duplicate"] += 1
            elif high is not None and ts < high - delay:
                fates["exception"] += 1
            else:
                fates["accepted"] += 1
            known.add(e)
        highs = [ts for _, ts, _ in rows if ts is not None] + ([high] if high else [])
        high = max(highs, default=None)
    return fates


def counted(rows):
    fates = Counter()
    for r in rows:
        fates[r.fate] += 1
        fates["duplicate"] += r.copies - 1
    return fates


def test_what_comes_after_the_watermark_is_an_exception(spark, tmp_path):
    batches = [
        [(1, at(0), 1), (2, at(48), 2)],
        [(3, at(5), 3), (4, at(47.5), 4), (1, at(0), 5)],
        [(3, at(5), 6), (5, at(48), 7)],
    ]
    found = settle(spark, tmp_path, batches, delay=timedelta(hours=1)).collect()
    assert sorted((r.event_id, r.batch, r.fate, r.reason) for r in found) == [
        (1, 0, "accepted", None), (1, 1, "duplicate", None), (2, 0, "accepted", None),
        (3, 1, "exception", "late for its window"), (3, 2, "duplicate", None),
        (4, 1, "accepted", None), (5, 2, "accepted", None),
    ]


@pytest.mark.parametrize("seed", range(2))
def test_sent_is_accepted_and_duplicates_and_exceptions(spark, tmp_path, seed):
    draw = random.Random(seed)
    times = {e: at(draw.randrange(80)) for e in range(60)}
    sent = [(e, times[e], p) for p, e in enumerate(draw.choices(range(60), k=150))]
    sent += [(None, at(3), 900), (None, at(3), 900), (61, None, 901)]
    draw.shuffle(sent)
    batches = [sent[i::4] for i in range(4)]
    found = settle(spark, tmp_path, batches, delay=timedelta(hours=30)).collect()
    assert sum(r.copies for r in found) == len(sent)
    assert counted(found) == one_by_one(batches, timedelta(hours=30))
    assert counted(found)["exception"] > 3


def test_a_hot_event_comes_out_once(spark, tmp_path):
    rows = [(7, at(1), p) for p in range(400)] + [(p + 10, at(1), 1000 + p) for p in range(800)]
    found = settle(spark, tmp_path, [rows, rows[:50]]).collect()
    hot = sorted((r.batch, r.fate, r.copies, r.position) for r in found if r.event_id == 7)
    assert hot == [(0, "accepted", 400, 0), (1, "duplicate", 50, 0)]
    batch = spark.createDataFrame(rows, SCHEMA).withColumn("event_date", F.to_date("event_ts"))
    plan = E.settle(batch, batch.limit(0))._jdf.queryExecution().executedPlan().toString()
    # Copies are folded before anything is dealt out by event.
    assert plan.index("partial_min_by") > plan.index("hashpartitioning(event_id")


def test_a_batch_that_died_is_run_again(spark, tmp_path):
    batches = [[(1, at(0), 1), (2, at(48), 2)], [(3, at(5), 3), (2, at(48), 4), (4, at(48), 5)]]
    settled = settle(spark, tmp_path, batches)
    before = sorted(settled.collect())
    out, delay = str(tmp_path / "out"), timedelta(hours=1)
    batch = spark.createDataFrame(batches[1], SCHEMA)
    # Rows without a note of being done, as a killed attempt leaves them, are not read.
    stray = [(9, at(1), 9, None, 1, 7, date(2026, 3, 1), "accepted")]
    write_to = spark.createDataFrame(stray, streams.settled_schema(batch.schema))
    write_to.write.mode("append").partitionBy(*streams.PARTITIONS).parquet(f"{out}/rows")
    assert sorted(streams.settled(spark, out, batch.schema).collect()) == before
    # The last batch once more, over what it left: the same rows.
    streams.settle_batch(batch, 1, out, delay)
    assert sorted(streams.settled(spark, out, batch.schema).collect()) == before


def test_events_of_a_closed_date_and_empty_batches(spark, tmp_path):
    closed = spark.createDataFrame([(date(2026, 3, 1),)], "business_date date")
    batches = [[(1, at(1), 1)], [], [(2, at(30), 2), (3, at(2), 3)]]
    found = settle(
        spark, tmp_path, batches, delay=timedelta(days=9), closed_dates=lambda: closed
    ).collect()
    assert sorted((r.event_id, r.reason) for r in found) == [
        (1, "late for a closed date"), (2, None), (3, "late for a closed date"),
    ]


def test_signals_hold_every_accepted_event_of_a_closed_window(spark, tmp_path):
    folder, schema = str(tmp_path / "in"), "event_id int, event_ts timestamp, position int, user_id int, event_type string, amount_paise bigint"
    rows = [(e, at(e % 50), e, e % 3, "purchase", 5) for e in range(120)]
    for part in (rows[:70], rows[50:], [(500, at(200), 999, 9, "purchase", 1)], [(501, at(201), 1000, 9, "view", 1)]):
        write(spark, folder, part, schema)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    out = str(tmp_path / "out")
    streams.settle_stream(
        stream, out, str(tmp_path / "c1"), timedelta(days=3), trigger={"availableNow": True}
    ).awaitTermination()
    watched = spark.createDataFrame([("purchase",)], "event_type string")
    scored = streams.score_stream(
        streams.accepted_stream(spark, out, stream.schema), watched, "3 days"
    )
    running = (
        scored.writeStream.format("parquet").option("path", str(tmp_path / "signals"))
        .option("checkpointLocation", str(tmp_path / "c2")).trigger(availableNow=True).start()
    )
    running.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "signals"))
    assert got.agg(F.sum("events")).first()[0] == 120


# ---- the state stream

SPEC = MergeSpec(("k",), ("v", "big"), ("big",), buckets=16)
CHANGE = "k string, v int, big string, op string, source_incarnation int, source_lsn long"
NOW = datetime(2026, 3, 9)


def changes(draw, n, lsn=0):
    """Changes in the order of the source, a third of them of one key."""
    for i in range(n):
        k = "hot" if draw.random() < 0.33 else f"k{draw.randrange(40)}"
        op = draw.choice("cuuud")
        big = draw.choice([V.UNCHANGED, f"b{i}", None])
        yield (k, None if op == "d" else i, None if op == "d" else big, op, 1, lsn + i + 1)


def by_hand(rows):
    """The state after the changes one by one."""
    state = {}
    for k, v, big, op, _, lsn in sorted(rows, key=lambda r: r[-1]):
        if k in state and state[k][2] >= lsn:
            continue
        old = state.get(k, (None, None, 0, False))
        kept = old[1] if big == V.UNCHANGED else big
        state[k] = (None, None, lsn, True) if op == "d" else (v, kept, lsn, False)
    return state


def partitions_read(frame):
    """Partitions that the frame's one scan reads."""
    plan = frame._jdf.queryExecution().executedPlan()
    plan.executeCollect()
    return plan.collectLeaves().head().metrics().get("numPartitions").get().value()


def read_state(spark, path):
    schema = spark.createDataFrame([], CHANGE).schema
    found = changes_stream.state(spark, schema, SPEC, path)
    rows = {r.k: (r.v, r.big, r.source_lsn, r.is_deleted) for r in found.collect()}
    assert len(rows) == found.count()
    return rows, found


def test_a_state_merged_batch_by_batch(spark, tmp_path):
    draw = random.Random(5)
    rows = list(changes(draw, 240))
    batches = [rows[:100], rows[60:170], rows[170:171], rows[150:]]
    folder, path = str(tmp_path / "in"), str(tmp_path / "state")
    files = []
    for i, part in enumerate(batches):
        write(spark, folder, part, CHANGE)
        stream = spark.readStream.schema(CHANGE).option("maxFilesPerTrigger", 1).parquet(folder)
        running = changes_stream.merge_state_stream(
            stream, SPEC, path, str(tmp_path / "check"), NOW, {"availableNow": True}
        )
        running.awaitTermination()
        got, found = read_state(spark, path)
        assert got == by_hand([r for b in batches[: i + 1] for r in b])
        files.append(partitions_read(found))
    # Each bucket is read from one release, however many batches there were.
    assert max(files) <= SPEC.buckets
    # The batch of one change wrote one bucket.
    written = spark.read.parquet(f"{path}/rows").where("release_id = 2")
    assert written.select("slice").distinct().count() == 1


def test_a_merge_killed_before_its_manifest_is_run_again(spark, tmp_path, monkeypatch):
    draw = random.Random(6)
    rows = list(changes(draw, 120))
    path = str(tmp_path / "state")
    empty = spark.readStream.schema(CHANGE).parquet(str(tmp_path / "i[n]"))
    (tmp_path / "in").mkdir()
    changes_stream.merge_state_stream(
        empty, SPEC, path, str(tmp_path / "check"), NOW, {"availableNow": True}
    ).awaitTermination()
    first, second = (spark.createDataFrame(part, CHANGE) for part in (rows[:70], rows[50:]))
    changes_stream.merge_state_batch(first, 0, SPEC, path, NOW)
    before, _ = read_state(spark, path)
    whole = changes_stream.merge.merge_buckets

    def dies(*args):
        merged = whole(*args)
        return changes_stream.merge.Merged(merged.rows, None)

    monkeypatch.setattr(changes_stream.merge, "merge_buckets", dies)
    with pytest.raises(AttributeError):
        changes_stream.merge_state_batch(second, 1, SPEC, path, NOW)
    monkeypatch.setattr(changes_stream.merge, "merge_buckets", whole)
    # Its rows are there, but nothing shows them.
    assert spark.read.parquet(f"{path}/rows").where("release_id = 1").count() > 0
    assert read_state(spark, path)[0] == before == by_hand(rows[:70])
    for _ in range(2):
        changes_stream.merge_state_batch(second, 1, SPEC, path, NOW)
        assert read_state(spark, path)[0] == by_hand(rows)


def test_an_unsupported_change_leaves_the_state_as_it_was(spark, tmp_path):
    path = str(tmp_path / "state")
    (tmp_path / "in").mkdir()
    empty = spark.readStream.schema(CHANGE).parquet(str(tmp_path / "i[n]"))
    changes_stream.merge_state_stream(
        empty, SPEC, path, str(tmp_path / "check"), NOW, {"availableNow": True}
    ).awaitTermination()
    good = [("a", 1, None, "c", 1, 1)]
    changes_stream.merge_state_batch(spark.createDataFrame(good, CHANGE), 0, SPEC, path, NOW)
    with pytest.raises(Exception, match="unsupported change operation: t"):
        bad = spark.createDataFrame([("b", 1, None, "c", 1, 2), ("c", None, None, "t", 1, 3)], CHANGE)
        changes_stream.merge_state_batch(bad, 1, SPEC, path, NOW)
    assert read_state(spark, path)[0] == by_hand(good)


def test_a_small_batch_reads_only_its_buckets(spark, tmp_path):
    rows = [(f"k{i}", i, "x", "c", 1, 1) for i in range(400)]
    frame = spark.createDataFrame(rows, CHANGE)
    state = cdc.bucketed(cdc.apply_changes(cdc.empty_target(frame, SPEC), frame, SPEC, NOW), SPEC)
    state.write.partitionBy("bucket").parquet(str(tmp_path / "t"))
    stored = spark.read.schema(state.schema).parquet(str(tmp_path / "t"))
    batch = spark.createDataFrame(
        [("k3", 1, V.UNCHANGED, "u", 1, 2), ("new", 2, "y", "c", 1, 2)], CHANGE
    )
    put = merge.upserts(stored, SPEC, batch, NOW)
    plan = put._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.split("\n") if "PartitionFilters" in line)
    buckets = {r.bucket for r in cdc.bucketed(batch, SPEC).collect()}
    assert all(f"{b}" in scan.split("PartitionFilters")[1] for b in buckets) and "bucket" in scan
    hit = stored.where(F.col("bucket").isin(merge.touched_buckets(batch, SPEC)))
    assert partitions_read(hit) == len(buckets)
    got = {r.k: (r.v, r.big, r.bucket) for r in put.collect()}
    assert set(got) == {"k3", "new"} and got["k3"][:2] == (1, "x")
    assert {b for *_, b in got.values()} == buckets
    plain = merge.upserts(state.drop("bucket"), SPEC, batch, NOW)
    assert {r.k: (r.v, r.big) for r in plain.collect()} == {k: v[:2] for k, v in got.items()}
