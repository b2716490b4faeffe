from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tieout.catalogue.around import FACT_CONTRACT
from tieout.durable import checkpoint_dir
from tieout.model import ColumnRule, DataContract, FeedContract
from tieout.operators import api, bronze, events, features, privacy, quality
from tieout.sources.tables import partner_file
from tieout.plans import window_sink
from tieout.streaming import events as streams

T0 = datetime(2026, 3, 1)


@pytest.mark.parametrize("strict", [True, False])
def test_features_never_leak_from_after_the_moment(spark, strict):
    rng = random.Random(7)

    def at():
        return T0 + timedelta(minutes=30 * rng.randint(0, 40))

    # One entity holds most rows; instants repeat on purpose.
    seen = [(rng.choice("aaaab"), at(), i) for i in range(60)]
    asked = [(i, rng.choice("aaaabc"), at()) for i in range(80)]
    observations = spark.createDataFrame(seen, "entity string, at timestamp, value int")
    moments = spark.createDataFrame(asked, "id int, entity string, at timestamp")
    got = features.as_of(
        moments, observations, "entity", "at", ("value",), "hour", strict
    ).collect()
    assert len(got) == len(asked)
    for r in got:
        before = [
            (t, v) for e, t, v in seen
            if e == r["entity"] and (t < r["at"] if strict else t <= r["at"])
        ]
        assert (r["observed_at"], r["value"]) == (max(before) if before else (None, None))


def test_one_row_per_event_and_the_first_arrival_stays(spark):
    rows = [(1, 2, "b"), (1, 1, "a"), (2, 5, "c"), (2, 5, "c")]
    frame = spark.createDataFrame(rows, "event_id int, arrival int, body string")
    got = {r["event_id"]: r["body"] for r in events.dedup(frame, ("arrival", "body")).collect()}
    assert got == {1: "a", 2: "c"}


def test_a_replayed_event_without_an_id_gets_the_same_id(spark):
    schema = T.StructType().add("event_id", T.LongType()).add("user", T.StringType())
    raw = spark.createDataFrame(
        [('{"user":"u"}',), ('{"user":"u"}',), ('{"user":"v"}',), ("{x",), ("{y",)], "value string"
    )
    rows = events.validate(raw, schema, ("user",)).collect()
    keys = [r["event_key"] for r in rows]
    assert keys[0] == keys[1] and len(set(keys)) == 4
    assert [r["problems"] for r in rows[:4]] == [
        "", "", "", "not valid JSON for its schema; user is missing"
    ]


def test_a_null_the_source_wrote_stays_null_and_a_delete_keeps_its_key(spark):
    row = T.StructType().add("id", T.StringType()).add("note", T.StringType())
    raw = spark.createDataFrame(
        [
            ('{"before":{"id":"1","note":"x"},"after":{"id":"1","note":null},"op":"u",'
             '"source":{"lsn":5,"table":"loan"},"transaction":{"id":"t"}}',),
            ('{"before":{"id":"2","note":"y"},"after":null,"op":"d",'
             '"source":{"lsn":6,"table":"loan"},"transaction":null}',),
            ("not json",),
        ],
        "value string",
    )
    a, b, c = bronze.flatten_changes(raw, row, 3).collect()
    assert (a["id"], a["note"], a["source_lsn"], a["source_incarnation"]) == ("1", None, 5, 3)
    assert (b["id"], b["op"], b["transaction_id"]) == ("2", "d", None)
    assert c["unparsed"] == "not json" and c["op"] is None


def test_the_same_value_always_gets_the_same_token(spark):
    vault = spark.createDataFrame([("email", "a@x", "tok-a")], "kind string, value string, token string")
    rows = spark.createDataFrame([(1, " A@x"), (2, "b@x"), (3, "B@X"), (4, None)], "id int, mail string")
    found, new = privacy.tokenise(rows, "mail", "email", vault)
    got = {r["id"]: r["mail"] for r in found.collect()}
    again = {r["id"]: r["mail"] for r in found.collect()}
    assert got == again
    assert got[1] == "tok-a" and got[2] == got[3] and got[4] is None and "@" not in got[2]
    assert new.count() == 1


def test_a_value_without_a_token_fails_the_read(spark):
    rows = spark.createDataFrame([("a@x",)], "mail string")
    vault = spark.createDataFrame([], "value string, token string")
    with pytest.raises(Exception, match="no token for a value of mail"):
        privacy.with_tokens(rows, "mail", vault).collect()


ENVELOPE = (
    "key struct<phone: string>, "
    "before struct<id: int, phone: string, home: struct<mail: string, city: string>>, "
    "after struct<id: int, phone: string, home: struct<mail: string, city: string>>, op string"
)
CLASSES = {"phone": "phone", "home.mail": "email", "home.city": None, "op": None}


def test_both_images_and_the_key_get_the_same_tokens(spark):
    rows = [
        (("98765 43210",), (1, "09876543210", ("A@x", "P")), (1, "+91 9876543210", ("a@x ", "Q")), "u"),
        (("98765 43210",), None, (2, None, ("b@x", "P")), "c"),
        (None, (3, "12 34", None), None, "d"),
        ((None,), (4, "98765-43210", (None, None)), None, "d"),
    ]
    frame = spark.createDataFrame(rows * 40, ENVELOPE).repartition(5)
    vault = spark.createDataFrame([("email", "b@x", "tok-b")], "kind string, value string, token string")
    found, new = privacy.tokenise_envelopes(frame, CLASSES, vault)
    assert found.schema.simpleString() == frame.schema.simpleString()
    got = found.collect()
    assert len(got) == 160 and new.count() == 3
    tokens = {(r["kind"], r["value"]): r["token"] for r in new.collect()}
    phone, mail = tokens[("phone", "+919876543210")], tokens[("email", "a@x")]
    seen = {
        (r.key and r.key.phone, r.before and r.before.phone, r.after and r.after.phone) for r in got
    }
    assert seen == {
        (phone, phone, phone), (phone, None, None), (None, tokens[("phone", "12 34")], None),
        (None, phone, None),
    }
    assert {r.after.home.mail for r in got if r.after} == {mail, "tok-b"}
    assert {r.before.home and r.before.home.mail for r in got if r.before} == {mail, None}
    assert {r.after.home.city for r in got if r.after} == {"P", "Q"}
    flat = found.select(F.to_json(F.struct("*")).alias("text"))
    hits = privacy.canary_hits({"t": flat}, ["9876543210", "43210", "@x", "12 34"]).collect()
    assert [h["hits"] for h in hits] == [0]


def test_a_window_is_replaced_with_its_emptied_dates(spark, tmp_path):
    days = [date(2026, 3, d) for d in range(1, 5)]
    rows = spark.createDataFrame(
        [(days[d], i) for i, d in enumerate((0, 1, 1, 2, 3))], "business_date date, id int"
    )
    window_sink.create(spark, "sink_test", rows, path=str(tmp_path / "sink"))
    assert window_sink.replace_window(spark, "sink_test", rows, days) == []

    def content():
        return sorted((r["business_date"].day, r["id"]) for r in spark.table("sink_test").collect())

    everything = [(1, 0), (2, 1), (2, 2), (3, 3), (4, 4)]
    assert content() == everything
    # A row outside the window changes nothing.
    with pytest.raises(Exception, match="a row outside the window, of 2026-03-04"):
        window_sink.replace_window(spark, "sink_test", rows, days[:3])
    assert content() == everything
    # The second day is empty now, the third has another row; others stay, also run twice.
    again = spark.createDataFrame([(9, days[2])], "id int, business_date date")
    for _ in range(2):
        assert window_sink.replace_window(spark, "sink_test", again, days[1:3]) == [days[1]]
        assert content() == [(1, 0), (3, 9), (4, 4)]
    # Rows may come from the table itself, and a whole window may be empty.
    own = spark.table("sink_test").where("id > 3")
    assert window_sink.replace_window(spark, "sink_test", own.where("id = 9"), days[2:3]) == []
    assert window_sink.replace_window(spark, "sink_test", own.limit(0), days) == days
    assert content() == []
    spark.sql("DROP TABLE sink_test")


def test_text_that_is_not_classified_is_refused(spark):
    frame = spark.createDataFrame([], ENVELOPE)
    vault = spark.createDataFrame([], "kind string, value string, token string")
    with pytest.raises(ValueError, match="without a classification: home.city, op"):
        privacy.tokenise_envelopes(frame, {"phone": "phone", "home.mail": "email"}, vault)
    listed = spark.createDataFrame([], "after struct<tags: array<string>>")
    with pytest.raises(ValueError, match="text inside after.tags"):
        privacy.tokenise_envelopes(listed, {"tags": "email"}, vault)
    found, new = privacy.tokenise_envelopes(frame, dict.fromkeys(CLASSES), vault)
    assert found.collect() == [] and new.collect() == []


@pytest.mark.parametrize("strict", [True, False])
def test_a_hot_entity_of_one_hour_spreads_over_ranges(spark, strict):
    rng = random.Random(9)

    def at():
        return T0 + timedelta(minutes=rng.randint(0, 5))

    seen = [(rng.choice("aaaaab"), at(), i) for i in range(150)]
    asked = [(i, rng.choice("aaaaabc"), at()) for i in range(150)]
    observations = spark.createDataFrame(seen, "entity string, at timestamp, value int")
    moments = spark.createDataFrame(asked, "id int, entity string, at timestamp")
    got = features.as_of(
        moments, observations, "entity", "at", ("value",), 8, strict
    ).collect()
    assert len(got) == len(asked)
    for r in got:
        before = [
            (t, v) for e, t, v in seen
            if e == r["entity"] and (t < r["at"] if strict else t <= r["at"])
        ]
        assert (r["observed_at"], r["value"]) == (max(before) if before else (None, None))
    shared = observations.select("entity", "at", F.struct("at", "value").alias("_last"))
    parts = features._in_ranges(
        shared, moments.withColumn("_moment", F.struct("*")), "entity", "at", "_last", 8, strict
    )
    sizes = parts[0].select("_block").union(parts[1].select("_block")).groupBy("_block").count()
    found = [r["count"] for r in sizes.collect()]
    assert len(found) >= 6 and max(found) < 100


def test_checks_of_any_number_read_the_rows_once(spark, tmp_path):
    contract = DataContract(
        "x",
        (
            ColumnRule("id", "bigint", True, True), ColumnRule("line", "bigint", False, True),
            ColumnRule("status", "string", True, unique=True, allowed=("A", "B")),
            ColumnRule("ref", "string", unique=True), ColumnRule("gone", "bigint"),
            ColumnRule("amount", "bigint", True),
        ),
    )
    rows = [(1, 1, "A", "r", 5), (1, 1, "B", "r", 5), (1, None, "C", None, 6), (None, 2, None, "s", 7)]
    path = str(tmp_path / "t")
    spark.createDataFrame(
        rows * 2, "id bigint, line bigint, status string, ref string, amount int"
    ).write.parquet(path)
    found = quality.evaluate(spark.read.parquet(path), contract)
    assert {r["check"]: r["failures"] for r in found.collect()} == {
        "required:id": 2, "required:status": 2, "invalidValues:status": 2, "required:amount": 0,
        "primaryKey": 7, "duplicateValues:status": 5, "duplicateValues:ref": 6, "missing:gone": 8,
        "type:amount": 8,
    }
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1
    empty = quality.evaluate(spark.read.parquet(path).limit(0), contract)
    assert {r["failures"] for r in empty.collect()} == {0}


@pytest.mark.parametrize(
    "kind, text, expected",
    [("phone", "98765 43210", "+919876543210"), ("phone", "+91-98765-43210", "+919876543210"),
     ("phone", "09876543210", "+919876543210"), ("phone", "+1 415 555 0100", "+14155550100"),
     ("phone", "+91 41555 50100", "+914155550100"), ("phone", "12 34", "12 34"), ("email", " A@B.in ", "a@b.in"),
     ("pan", "abcde1234f", "ABCDE1234F")],
)
def test_values_are_normalised(spark, kind, text, expected):
    rows = spark.createDataFrame([(text,)], "v string")
    assert rows.select(privacy.normalise(kind, "v")).first()[0] == expected
    flagged = rows.select(privacy.is_unreadable(kind, "v")).first()[0]
    assert flagged == (text == "12 34")


def test_overlapping_pulls_keep_the_latest_copy_and_a_sweep_finds_gaps(spark):
    landed = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")],
                                   "record_id int, pull_id int, body string")
    merged = api.merge_pulls(landed)
    assert {r["record_id"]: r["body"] for r in merged.collect()} == {1: "b", 2: "c"}
    sweep = spark.createDataFrame([(1,), (3,)], "record_id int")
    assert {r["record_id"]: r["gap"] for r in api.sweep_gaps(merged, sweep).collect()} == {
        3: "missed by the pulls", 2: "vanished from the source"
    }
    assert api.pull_from(T0, timedelta(days=2)) == T0 - timedelta(days=2)


def test_a_contract_is_read_and_checked(spark):
    document = {
        "name": "x",
        "schema": [{"properties": [
            {"name": "id", "logicalType": "string", "primaryKey": True, "required": True},
            {"name": "n", "logicalType": "integer", "physicalType": "bigint",
             "quality": [{"metric": "duplicateValues", "mustBe": 0}]},
            {"name": "s", "logicalType": "string", "quality": [
                {"metric": "invalidValues", "arguments": {"validValues": ["A", "B"]}}]},
        ]}],
    }
    contract = DataContract.from_document(document)
    rows = spark.createDataFrame([("1", 5, "A"), ("1", 5, "C"), (None, 6, None)],
                                 "id string, n int, s string")
    got = {r["check"]: r["failures"] for r in quality.evaluate(rows, contract).collect()}
    assert got == {"required:id": 1, "invalidValues:s": 1, "primaryKey": 2,
                   "duplicateValues:n": 1, "type:n": 3}


def test_a_feed_contract_is_read():
    document = {
        "schema": [{"properties": [{"name": "id", "primaryKey": True}, {"name": "n"}]}],
        "customProperties": [{"property": "truncationThreshold", "value": 0.3},
                             {"property": "reference", "value": True}],
    }
    assert FeedContract.from_document(document) == FeedContract(("id",), "amount_paise", 0.3, True)


def test_a_metric_may_filter_only_on_contracted_values():
    assert quality.metric_filter_problems(FACT_CONTRACT) == []
    bad = DataContract("x", (ColumnRule("status", allowed=("A",)),),
                       {"m": ("status", "B"), "n": ("state", "A")})
    assert len(quality.metric_filter_problems(bad)) == 2


def test_a_partner_file_is_read_as_text(spark, tmp_path):
    (tmp_path / "f.csv").write_text("id,amount_paise,posting_date\nS1,100,2026-03-01\nS2,1.5,01/03/2026\n")
    types = {"id": "string", "amount_paise": "bigint", "posting_date": "date"}
    rows = {r["id"]: r for r in partner_file(spark, str(tmp_path), types).collect()}
    assert (rows["S1"]["amount_paise"], rows["S1"]["posting_date"]) == (100, date(2026, 3, 1))
    assert rows["S2"]["problems"] == "amount_paise is not bigint; posting_date is not date"


def test_a_stream_gives_one_row_per_event_across_batches(spark, tmp_path):
    schema = "event_id int, event_ts timestamp"
    source = str(tmp_path / "in")
    for i in range(2):
        rows = [(n, T0 + timedelta(minutes=n)) for n in range(5 + i)]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    running = (
        streams.dedup(stream).writeStream.format("parquet")
        .option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "check"))
        .trigger(availableNow=True).start()
    )
    running.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 6


def test_the_checkpoint_folder_of_the_session_is_used(spark):
    assert checkpoint_dir(spark) == spark.sparkContext.getCheckpointDir()
    assert spark.range(3).agg(F.sum("id")).first()[0] == 3
