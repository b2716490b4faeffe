from __future__ import annotations

import random
import statistics
from datetime import UTC, date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tieout import fixed_values as V
from tieout.durable import materialise
from tieout.model import POINTER, REGISTER, FeedContract
from tieout.operators import deliveries as D
from tieout.plans import file_delivery as jobs

MONDAY = date(2026, 3, 2)
NOW = datetime(2026, 3, 3, tzinfo=UTC)
FEED = FeedContract(keys=("settlement_id",))
PART = (
    "file_id string, file_hash string, partner string, feed string, posting_date date, "
    "sequence_number bigint, part_number int, part_count int, row_count bigint, "
    "amount_paise bigint, arrival bigint"
)
ROW = "file_id string, settlement_id string, amount_paise bigint, posting_date date"
VERSIONED = (
    "partner string, feed string, sequence_number bigint, file_id string, settlement_id string, "
    "amount_paise bigint, posting_date date"
)


class Feed:
    """Sends parts, publishes versions of one feed, and keeps what the jobs return."""

    def __init__(self, spark):
        self.spark, self.clock = spark, NOW
        self.register = spark.createDataFrame([], REGISTER)
        self.pointer = spark.createDataFrame([], POINTER)
        self.rows = spark.createDataFrame([], f"{VERSIONED}, load_id bigint")

    def part(self, amounts, day=MONDAY, version=1, part=1, parts=1, trailer=None, arrival=1):
        file_id = f"settlement-{day}-v{version}-p{part}"
        rows = [(file_id, f"S{part}-{i}", a, day) for i, a in enumerate(amounts)]
        n, total = trailer or (len(amounts), sum(amounts))
        head = (file_id, f"sha-{file_id}", "north", "settlement", day, version, part, parts, n,
                total, arrival)
        return head, rows

    def receive(self, *sent):
        parts = self.spark.createDataFrame([p for p, _ in sent], PART)
        rows = self.spark.createDataFrame([r for _, rs in sent for r in rs], ROW)
        self.clock += timedelta(minutes=1)
        got = jobs.receive(self.register, FEED, parts, rows, self.clock)
        self.keep_rows(got)
        self.register = materialise(got.register)
        return {(r["file_id"], r["arrival"]): r["state"] for r in got.parts.collect()}

    def keep_rows(self, got):
        load = (self.register.agg(F.max("load_id")).first()[0] or 0) + 1
        others = self.rows.where(F.col("load_id") != load)
        self.rows = materialise(others.unionByName(got.rows.select(*self.rows.columns)))

    def publish(self, version=1, day=MONDAY, approved=None):
        asked = self.spark.createDataFrame(
            [("north", "settlement", day, version, approved)],
            "partner string, feed string, posting_date date, sequence_number bigint, "
            "approved_by string",
        )
        self.clock += timedelta(minutes=1)
        return self.publish_all(asked)[0]["verdict"]

    def publish_all(self, asked):
        done = jobs.publish(self.register, self.pointer, FEED, asked, self.clock)
        self.register, self.pointer = materialise(done.register), materialise(done.pointer)
        return done.verdicts.collect()

    def loaded(self):
        return jobs.loaded_rows(self.rows, self.register)

    def current(self):
        rows = D.current_rows(self.loaded(), self.pointer).collect()
        return len(rows), sum(r["amount_paise"] for r in rows)

    def known_at(self, moment):
        rows = D.as_known_at(self.loaded(), self.pointer, moment).collect()
        return len(rows), sum(r["amount_paise"] for r in rows)


@pytest.fixture
def feed(spark):
    return Feed(spark)


def test_a_version_far_smaller_than_usual_is_held(feed):
    for week in range(4, 0, -1):
        day = MONDAY - timedelta(weeks=week)
        feed.receive(feed.part([100] * 10, day=day))
        assert feed.publish(day=day) == "PUBLISHED"
    feed.receive(feed.part([100] * 4))
    assert feed.publish() == "HELD_FOR_APPROVAL"
    assert feed.publish(approved="asha") == "PUBLISHED"


@pytest.mark.parametrize("order", [(1, 2), (2, 1)])
def test_the_highest_version_wins_in_any_order(feed, order):
    sent = {1: feed.part([100, 200], version=1), 2: feed.part([150, 200], version=2)}
    for version in order:
        feed.receive(sent[version])
        feed.publish(version)
    assert feed.current() == (2, 350)
    assert feed.publish(1) == "SUPERSEDED"
    assert feed.publish(2) == "PUBLISHED"


def test_a_version_publishes_only_when_every_part_is_in(feed):
    feed.receive(feed.part([100, 100]))
    feed.publish()
    for part in (1, 2):
        feed.receive(feed.part([60], version=2, part=part, parts=3))
    assert feed.publish(2) == "INCOMPLETE"
    assert feed.current() == (2, 200)
    feed.receive(feed.part([60], version=2, part=3, parts=3))
    assert feed.publish(2) == "PUBLISHED"
    assert feed.current() == (3, 180)


def test_what_was_known_before_a_correction_stays_readable(feed):
    other = MONDAY + timedelta(days=1)
    feed.receive(feed.part([100, 200]), feed.part([1000], day=other, arrival=2))
    feed.publish()
    feed.publish(day=other)
    before = feed.clock + timedelta(seconds=1)
    feed.receive(feed.part([150, 200], version=2))
    feed.publish(2)
    assert feed.current() == (3, 1350)
    assert feed.known_at(before) == (3, 1300)
    with pytest.raises(ValueError):
        feed.known_at(datetime(2026, 3, 3))


def test_a_load_that_died_before_it_was_registered_loads_once(feed):
    head, rows = sent = feed.part([100, 200])
    got = jobs.receive(
        feed.register, FEED, feed.spark.createDataFrame([head], PART),
        feed.spark.createDataFrame(rows, ROW), NOW,
    )
    feed.keep_rows(got)  # then it died
    assert feed.rows.count() == 2 and feed.loaded().count() == 0
    feed.receive(sent)
    feed.publish()
    assert feed.current() == (2, 300)


def test_the_same_part_twice_is_taken_once(feed):
    first, rows = feed.part([100, 200])
    again = (*first[:-1], 2)
    states = feed.receive((first, rows), (again, []))
    assert sorted(states.values()) == ["DUPLICATE", "STAGED"]
    assert set(feed.receive((first, rows)).values()) == {"DUPLICATE"}
    assert feed.loaded().count() == 2


def test_a_wrong_trailer_loads_nothing_and_can_be_resent(feed):
    assert set(feed.receive(feed.part([100], trailer=(1, 999))).values()) == {"REJECTED"}
    assert feed.register.first()["reason"] == "amount_paise is 100 instead of 999"
    assert set(feed.receive(feed.part([100, 300])).values()) == {"STAGED"}
    row = feed.register.first()
    assert (row["state"], row["row_count"], row["amount_paise"]) == ("STAGED", 2, 400)
    assert feed.loaded().count() == 2


@pytest.mark.parametrize("name", ["north'; DROP TABLE x; --", "north settlement", "", "a\n", None])
def test_unsafe_identifiers_are_found(spark, name):
    parts = spark.createDataFrame([("ok-1", name)], "file_id string, partner string")
    assert D.unsafe_identifiers(parts, ("file_id", "partner")).first()["unsafe"] == "partner"


def check(spark, rows, n, total):
    part = spark.createDataFrame([("f", MONDAY, n, total)],
                                 "file_id string, posting_date date, row_count bigint, "
                                 "amount_paise bigint")
    return D.check_parts(spark.createDataFrame(rows, ROW), part, FEED).first()["problems"]


def test_every_problem_of_a_part_is_listed(spark):
    rows = [("f", "a", 1, MONDAY), ("f", "a", None, MONDAY), ("f", None, 5, date(2026, 3, 3)),
            ("f", "b", 2, None)]
    assert check(spark, rows, 3, 9) == (
        "row_count is 4 instead of 3; amount_paise is 8 instead of 9; "
        "distinct settlement_id is 2 instead of 4; rows without amount_paise is 1 instead of 0; "
        "rows of another posting_date is 2 instead of 0"
    )
    assert check(spark, [("f", "a", -5, MONDAY)], 1, -5) == ""
    assert check(spark, [("other", "a", 1, MONDAY)], 0, 0) == ""


def greedy(parts):
    """Parts taken one by one: accepted unless an accepted one has the bytes or the place."""
    hashes, slots, states = set(), set(), {}
    for arrival, file_hash, slot, problems in sorted(parts):
        if file_hash in hashes or slot in slots:
            states[arrival] = "DUPLICATE"
        elif problems:
            states[arrival] = "REJECTED"
        else:
            states[arrival] = "STAGED"
            hashes.add(file_hash)
            slots.add(slot)
    return states


@pytest.mark.parametrize("seed", range(4))
def test_arrivals_are_decided_as_if_taken_one_by_one(spark, seed):
    rng = random.Random(seed)
    parts = [
        (i, f"h{rng.randint(1, 9)}", rng.randint(1, 9), rng.choice(["", "", "bad"]))
        for i in range(25)
    ]
    frame = spark.createDataFrame(
        [(f"f{a}", h, "p", "x", MONDAY, 1, s, a, q) for a, h, s, q in parts],
        "file_id string, file_hash string, partner string, feed string, posting_date date, "
        "sequence_number bigint, part_number int, arrival bigint, problems string",
    )
    empty = spark.createDataFrame([], REGISTER)
    got = D.classify_arrivals(frame, empty).collect()
    assert {r["arrival"]: r["state"] for r in got} == greedy(parts)


ARRIVING = (
    "file_id string, file_hash string, partner string, feed string, posting_date date, "
    "sequence_number bigint, part_number int, arrival bigint, problems string"
)


def arriving(spark, parts):
    return spark.createDataFrame(
        [(f"f{a}", h, "p", "x", MONDAY, 1, s, a, q) for a, h, s, q in parts], ARRIVING
    )


def decided(spark, parts):
    got = D.classify_arrivals(arriving(spark, parts), spark.createDataFrame([], REGISTER))
    return {r["arrival"]: r["state"] for r in got.collect()}


def test_a_long_chain_of_overlaps_settles_in_logarithmic_rounds(spark, monkeypatch):
    # Each part shares its bytes with the one before and its place with the one after.
    n = 10_000
    parts = [(i, f"h{(i + 1) // 2}", i // 2, "") for i in range(n)]
    rounds = []
    written = D.connected.materialise
    monkeypatch.setattr(
        D.connected, "materialise", lambda f: (rounds.append(1), written(f))[1]
    )
    assert decided(spark, parts) == greedy(parts)
    assert 3 < len(rounds) <= 20


@pytest.mark.parametrize("limit", [3, 1000])
def test_chains_and_components_over_the_limit(spark, monkeypatch, limit):
    monkeypatch.setattr(D, "DIRECT_ROUNDS", 1)
    monkeypatch.setattr(D, "FOLD_LIMIT", limit)
    rng = random.Random(8)
    places = list(range(60))
    parts = [(i, f"h{(i + 1) // 2}", i // 2, "") for i in range(9)]
    parts += [(100 + i, f"g{rng.randint(1, 25)}", 100 + rng.choice(places), rng.choice(["", "", "bad"]))
              for i in range(70)]
    if limit == 3:
        with pytest.warns(UserWarning, match="groups of overlapping parts, the largest of"):
            assert decided(spark, parts) == greedy(parts)
    else:
        assert decided(spark, parts) == greedy(parts)


def test_many_copies_need_no_component(spark, monkeypatch):
    monkeypatch.setattr(D, "_overlapping", None)
    parts = [(i, "same", i, "") for i in range(50)] + [(100 + i, f"h{i}", 200, "") for i in range(50)]
    assert decided(spark, parts) == greedy(parts)


def test_parts_without_bytes_or_a_place_block_nobody(spark):
    rows = [
        (f"f{a}", h, "p", "x", MONDAY, 1, s, a, "")
        for a, h, s in [(1, None, 1), (2, None, 2), (3, "a", None), (4, "b", None), (5, None, None), (6, "a", 9)]
    ]
    got = D.classify_arrivals(
        spark.createDataFrame(rows, ARRIVING), spark.createDataFrame([], REGISTER)
    ).collect()
    assert {r["arrival"] for r in got if r["state"] == "STAGED"} == {1, 2, 3, 4, 5}


@pytest.mark.parametrize("edges", [
    [], [(1, 1)], [(i, i + 1) for i in range(300)], [(0, i) for i in range(1, 90)],
    [(i, i * 7 % 201) for i in range(201)], [(5, 3), (3, 5), (9, 8), (8, 2), (70, 71)],
])
def test_components_are_the_reachable_ones(spark, edges):
    root = {n: n for e in edges for n in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    frame = spark.createDataFrame(edges, "a bigint, b bigint")
    got = {r["node"]: r["component"] for r in D.connected.components(frame).collect()}
    assert got == {n: find(n) for n in root}


def test_a_pointer_does_not_depend_on_the_order_of_requests(spark):
    asked = [("n", f"f{k}", MONDAY, v, None) for k in range(3) for v in (1, 2, 3)]
    schema = ("partner string, feed string, posting_date date, sequence_number bigint, "
              "approved_by string")
    results = set()
    for seed in range(3):
        rows = asked + asked[:4]
        random.Random(seed).shuffle(rows)
        pointer = D.flip(spark.createDataFrame([], POINTER), spark.createDataFrame(rows, schema), NOW)
        results.add(tuple(sorted((r["feed"], r["sequence_number"]) for r in pointer.collect())))
    assert results == {(("f0", 3), ("f1", 3), ("f2", 3))}


def test_old_and_new_version_meet_at_one_instant(spark):
    pointer = spark.createDataFrame([("n", "f", MONDAY, 1, NOW, None, None)], POINTER)
    asked = spark.createDataFrame([("n", "f", MONDAY, 2, "ops")],
                                  "partner string, feed string, posting_date date, "
                                  "sequence_number bigint, approved_by string")
    later = NOW + timedelta(hours=1)
    rows = {r["sequence_number"]: r for r in D.flip(pointer, asked, later).collect()}
    assert rows[1]["valid_to"] == rows[2]["valid_from"]
    assert rows[2]["valid_to"] is None and rows[2]["approved_by"] == "ops"


def register(spark, *rows):
    return spark.createDataFrame(
        [(f"f{i}", f"h{i}", "n", "f", day, seq, part, of, n, 0, state, "", NOW, None)
         for i, (day, seq, part, of, n, state) in enumerate(rows)], REGISTER)


def test_parts_that_disagree_on_their_number_leave_a_version_incomplete(spark):
    r = register(spark, (MONDAY, 1, 1, 2, 5, "STAGED"), (MONDAY, 1, 2, 3, 5, "STAGED"))
    row = D.version_completeness(r).first()
    assert not row["whole"] and row["reason"] == "parts disagree on the part count"


def test_the_usual_count_is_the_median_of_current_versions(spark):
    weeks = [MONDAY - timedelta(weeks=w) for w in range(1, 6)]
    counts = [10, 20, 40, 100, 7]
    r = register(spark, *((d, 1, 1, 1, n, "PUBLISHED") for d, n in zip(weeks, counts, strict=True)),
                 (weeks[0], 2, 1, 1, 999, "STAGED"))
    pointer = spark.createDataFrame([("n", "f", d, 1, NOW, None, None) for d in weeks], POINTER)
    asked = spark.createDataFrame([("n", "f", MONDAY)], "partner string, feed string, posting_date date")
    assert D.usual_rows(asked, pointer, r).first()["usual_rows"] == 30.0


def test_a_backlog_published_in_one_call_builds_its_own_history(feed):
    days = [MONDAY - timedelta(weeks=w) for w in (4, 3, 2, 1, 0)]
    sizes = [10, 10, 10, 10, 4]
    feed.receive(*(feed.part([1] * n, day=d, arrival=i)
                   for i, (d, n) in enumerate(zip(days, sizes, strict=True))))
    asked = feed.spark.createDataFrame(
        [("north", "settlement", d, 1, None) for d in days],
        "partner string, feed string, posting_date date, sequence_number bigint, approved_by string")
    got = {r["posting_date"]: r["verdict"] for r in feed.publish_all(asked)}
    assert [got[d] for d in days] == ["PUBLISHED"] * 4 + ["HELD_FOR_APPROVAL"]


def walked(days, sent, asked, before):
    """Verdict and usual count of each requested version, one date after the other."""
    published, found = dict(before), {}
    for day in days:
        past = [published[d][1] for d in (day - timedelta(weeks=w) for w in range(1, 5)) if d in published]
        usual = statistics.median(past) if past else None
        verdicts, best = {}, None
        for version, approved in asked.get(day, {}).items():
            parts, n = sent[day][version]
            if parts > 1:
                verdicts[version] = "INCOMPLETE"
            elif usual and n < usual * 0.8 and not approved:
                verdicts[version] = "HELD_FOR_APPROVAL"
            else:
                verdicts[version], best = None, max(best or 0, version)
        present = published.get(day, (-1, 0))[0]
        for version, verdict in verdicts.items():
            wins = "PUBLISHED" if version >= max(best or 0, present) else "SUPERSEDED"
            found[day, version] = (verdict or wins, usual)
        if best is not None and best >= present:
            published[day] = (best, sent[day][best][1])
    return found, {d: v for d, (v, _) in published.items()}


def test_a_backlog_in_one_call_equals_one_date_at_a_time(spark):
    rng = random.Random(7)
    days = sorted(rng.sample([MONDAY + timedelta(days=i) for i in range(120)], 70))
    # Per version: declared parts, of which only the first came, and rows.
    sent = {d: {v: (rng.choice((1, 1, 1, 2)), rng.choice((0, 3, 8, 10, 11)))
                for v in rng.sample((1, 2, 3), rng.randint(1, 3))} for d in days}
    asked = {d: {v: rng.choice((None, None, "asha")) for v in vs if rng.random() < 0.8}
             for d, vs in sent.items()}
    before = {d: (1, vs[1][1]) for d, vs in sent.items() if vs.get(1, (2,))[0] == 1 and rng.random() < 0.4}
    register = [
        (f"{d}-{v}", f"{d}-{v}", "north", "settlement", d, v, 1, parts, n, n,
         "PUBLISHED" if v == 1 and d in before else "STAGED", "", NOW, 1)
        for d, vs in sent.items() for v, (parts, n) in vs.items()]
    pointer = [("north", "settlement", d, 1, NOW, None, "start") for d in before]
    requests = [("north", "settlement", d, v, by) for d, vs in asked.items() for v, by in vs.items()]
    done = jobs.publish(
        spark.createDataFrame(register, REGISTER), spark.createDataFrame(pointer, POINTER), FEED,
        spark.createDataFrame(requests, "partner string, feed string, posting_date date, "
                                        "sequence_number bigint, approved_by string"),
        NOW + timedelta(days=1))
    verdicts, current = walked(days, sent, asked, before)
    got = {(r["posting_date"], r["sequence_number"]): (r["verdict"], r["usual_rows"])
           for r in done.verdicts.collect()}
    assert got == verdicts
    assert {v for v, _ in got.values()} == {"PUBLISHED", "HELD_FOR_APPROVAL", "INCOMPLETE", "SUPERSEDED"}
    opened = done.pointer.where("valid_to IS NULL").collect()
    assert {r["posting_date"]: r["sequence_number"] for r in opened} == current


def test_reading_some_dates_reads_only_their_partitions(feed, tmp_path):
    days = [MONDAY + timedelta(days=i) for i in range(4)]
    feed.receive(*(feed.part([i + 1], day=d, arrival=i) for i, d in enumerate(days)))
    for day in days:
        feed.publish(day=day)
    feed.rows.write.partitionBy("posting_date", "partner").parquet(str(tmp_path / "rows"))
    stored = jobs.loaded_rows(feed.spark.read.parquet(str(tmp_path / "rows")), feed.register)
    some = D.current_rows(stored, feed.pointer, (days[1], days[2]))
    assert sorted(r["amount_paise"] for r in some.collect()) == [2, 3]
    plan = some._jdf.queryExecution().executedPlan().toString()
    scan = next(x for x in plan.splitlines() if "PartitionFilters" in x)
    assert "posting_date" in scan.split("PartitionFilters")[1].split("PushedFilters")[0]
    known = D.as_known_at(stored, feed.pointer, feed.clock + timedelta(days=1), (days[1], days[1]))
    assert [r["amount_paise"] for r in known.collect()] == [2]


def test_a_change_only_feed_stops_at_the_first_missing_number(spark):
    versions = spark.createDataFrame([("n", "f", i) for i in (3, 4, 5, 7, 8)] + [("n", "g", 2)],
                                     "partner string, feed string, sequence_number bigint")
    applied = spark.createDataFrame([("n", "f", 3), ("n", "g", 0)],
                                    "partner string, feed string, sequence_number bigint")
    got = D.contiguous_prefix(versions, applied).collect()
    assert sorted((r["feed"], r["sequence_number"]) for r in got) == [("f", 4), ("f", 5)]


def test_text_is_typed_without_guessing(spark):
    values = ["12", "-7", "12.50", " 12", "12\n", "9" * 30, None]
    rows = spark.createDataFrame([(v,) for v in values], "amount string")
    got = D.parse_strict(rows, {"amount": "bigint"}).collect()
    assert [r["amount"] for r in got] == [12, -7, None, None, None, None, None]
    assert [r["problems"] == "" for r in got] == [True, True, False, False, False, False, True]


def test_unsafe_names_and_reused_file_ids_are_refused(spark):
    columns = (
        "arrival int, file_id string, file_hash string, partner string, feed string, "
        "posting_date date, sequence_number bigint, part_number int, problems string"
    )
    day = date(2026, 3, 2)
    parts = spark.createDataFrame(
        [
            (1, "f1", "a", "acme", "s", day, 1, 1, ""), (2, "f1", "b", "acme", "s", day, 1, 1, ""),
            (3, "f1", "a", "acme", "s", day, 1, 1, ""), (4, "f2", "c", "p q", "s", day, 1, 2, ""),
            (5, "f3", "d", "acme", "s", day, 1, 3, "bad"), (6, "f3", "e", "acme", "s", day, 1, 3, ""),
            (7, "f 4", "g", "acme", "", day, 1, 4, "bad"), (8, "f9", "h", "acme", "s", day, 1, 5, ""),
        ],
        columns,
    )
    register = spark.createDataFrame(
        [("f9", "old", "acme", "s", day, 1, 5, "PUBLISHED"), ("f2", "x", "acme", "s", day, 1, 9, "REJECTED")],
        "file_id string, file_hash string, partner string, feed string, posting_date date, "
        "sequence_number bigint, part_number int, state string",
    )
    found = {r["arrival"]: r["problems"] for r in D.refuse(parts, register, V.IDENTIFIERS).collect()}
    taken = "file id is taken by another file"
    assert found == {
        1: "", 2: taken, 3: "", 4: "unsafe partner", 5: "bad", 6: "", 7: "bad; unsafe feed, file_id",
        8: taken,
    }
