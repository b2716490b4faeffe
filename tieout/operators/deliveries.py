"""Partner deliveries: which version is the truth, is it whole, and what was known when?

A delivery is one (partner, feed, posting date); a version of it comes in numbered parts. All
pending parts and versions are handled in one plan. The register and the pointer grow with the
number of files; the rows grow with their content and are only aggregated, semi-joined or
written. No side is hinted as small: Spark broadcasts a side when its measured size allows it.
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from datetime import date, datetime

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tieout import fixed_values as V
from tieout.durable import materialise
from tieout.functions import business_day_end, is_safe_identifier, strict_bigint, strict_date
from tieout.model import DELIVERY, VERSION, FeedContract
from tieout.operators import connected
from tieout.operators import pointer as P

SLOT = (*VERSION, "part_number")
_RECEIVED = V.RECEIVED
_USABLE = (V.STAGED, V.PUBLISHED)


# ---- receiving parts ---------------------------------------------------------------------


def check_parts(rows: DataFrame, parts: DataFrame, contract: FeedContract) -> DataFrame:
    """Every problem of every part, against its trailer.

    `rows` carry file_id. They are reduced per file before they meet the parts, so a file that
    holds a third of the rows is combined on the map side; the exact key count spreads over
    (file, key).
    """
    amount = F.col(contract.amount)
    by_date = rows.groupBy("file_id", F.col("posting_date").alias("row_date")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(amount).alias("amount"),
        F.count_if(amount.isNull()).alias("null_amounts"),
    )
    elsewhere = ~F.col("row_date").eqNullSafe(F.col("posting_date"))
    totals = (
        by_date.join(parts.select("file_id", "posting_date").distinct(), "file_id")
        .groupBy("file_id", "posting_date")
        .agg(
            F.sum("n").alias("found_rows"),
            F.sum("amount").alias("found_paise"),
            F.sum("null_amounts").alias("null_amounts"),
            F.sum(F.when(elsewhere, F.col("n")).otherwise(0)).alias("other_dates"),
        )
    )
    keys = rows.groupBy("file_id").agg(
        F.count_distinct(*(F.col(k) for k in contract.keys)).alias("distinct_keys")
    )
    counts = ("found_rows", "null_amounts", "other_dates", "distinct_keys", "found_paise")
    checked = parts.join(totals, ["file_id", "posting_date"], "left").join(
        keys, "file_id", "left"
    )
    checked = checked.withColumns(
        {c: F.coalesce(c, F.lit(0).cast("bigint")) for c in counts}
    )
    key, none = "+".join(contract.keys), F.lit(0).cast("bigint")
    # What the rows have, and what they should have.
    measured = {
        "row_count": ("found_rows", F.col("row_count")),
        contract.amount: ("found_paise", F.col("amount_paise")),
        f"distinct {key}": ("distinct_keys", F.col("found_rows")),
        f"rows without {contract.amount}": ("null_amounts", none),
        "rows of another posting_date": ("other_dates", none),
    }
    listed = F.array_compact(
        F.array(*(_departure(what, F.col(found), due) for what, (found, due) in measured.items()))
    )
    return checked.select(*parts.columns, F.array_join(listed, "; ").alias("problems"))


def _departure(what: str, found: Column, due: Column) -> Column:
    """Text on a measure that is not what it should be, else NULL; no value counts as zero."""
    found = F.coalesce(found, F.lit(0).cast("bigint"))
    return F.when(~found.eqNullSafe(due), F.format_string(f"{what} is %s instead of %s", found, due))


def refuse(parts: DataFrame, register: DataFrame, identifiers: Sequence[str]) -> DataFrame:
    """Checked parts with two more problems: an unsafe identifier, and a file id already taken.

    A file id names one set of bytes in one place. It is taken by an accepted part of the register,
    or by the first whole part of this batch; under it, other bytes or another place are refused.
    """
    unsafe = F.array_compact(
        F.array(*(F.when(~is_safe_identifier(c), F.lit(c)) for c in identifiers))
    )
    content = F.struct("file_hash", *SLOT)
    held = register.where(F.col("state").isin(*_RECEIVED))
    held = held.groupBy("file_id").agg(F.max(content).alias("held"))
    first = (
        parts.where(F.col("problems") == "")
        .groupBy("file_id")
        .agg(F.min(F.struct("arrival", content.alias("content"))).alias("first"))
    )
    met = parts.join(held, "file_id", "left").join(first, "file_id", "left")
    after_first = F.col("arrival") > F.col("first.arrival")
    taken = (F.col("held").isNotNull() & (F.col("held") != content)) | (
        F.col("held").isNull() & after_first & (F.col("first.content") != content)
    )
    found = F.array_compact(
        F.array(
            F.when(F.col("problems") != "", F.col("problems")),
            F.when(F.size(unsafe) > 0, F.concat(F.lit("unsafe "), F.array_join(unsafe, ", "))),
            F.when(taken, F.lit("file id is taken by another file")),
        )
    )
    return met.withColumn("problems", F.array_join(found, "; ")).select(*parts.columns)


def unsafe_identifiers(parts: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Parts with an identifier outside the allowed characters, and which columns are bad."""
    bad = F.array_compact(F.array(*(F.when(~is_safe_identifier(c), F.lit(c)) for c in columns)))
    return parts.withColumn("unsafe", F.array_join(bad, ", ")).where(F.col("unsafe") != "")


def classify_arrivals(parts: DataFrame, register: DataFrame) -> DataFrame:
    """STAGED, REJECTED or DUPLICATE for each arriving part, as if taken one by one by `arrival`.

    `parts` carry `arrival` (unique, ascending) and `problems` (empty when the part is whole). A
    part is a duplicate if an earlier accepted part has its bytes or its place in a version; a
    rejected part blocks nobody. Acceptance can chain (a duplicate by bytes frees its place for
    a later part): see `_accepted`.
    """
    parts = materialise(parts)  # a row per arriving file; read several times
    known = register.where(F.col("state").isin(*_RECEIVED))
    known_hashes = known.select("file_hash").distinct()
    known_slots = known.select(*SLOT).distinct()
    fresh = parts.join(known_hashes, "file_hash", "left_anti").join(
        known_slots, list(SLOT), "left_anti"
    )
    accepted = _accepted(fresh.where(F.col("problems") == "").select(*_THIN))

    by_bytes = accepted.select("file_hash", F.col("arrival").alias("bytes_at"))
    by_slot = accepted.select(*SLOT, F.col("arrival").alias("slot_at"))
    later = F.least("bytes_at", "slot_at") < F.col("arrival")
    new = (
        fresh.join(by_bytes, "file_hash", "left")
        .join(by_slot, list(SLOT), "left")
        .withColumn(
            "state",
            F.when(F.coalesce(later, F.lit(False)), V.DUPLICATE)
            .when(F.col("problems") != "", V.REJECTED)
            .otherwise(V.STAGED),
        )
        .select(*parts.columns, "state")
    )
    old = parts.join(fresh.select("arrival"), "arrival", "left_anti").withColumn(
        "state", F.lit(V.DUPLICATE)
    )
    return new.unionByName(old)


_THIN = ("arrival", "file_hash", *SLOT)
#: Rounds that settle what overlaps a little, before components are worked out.
DIRECT_ROUNDS = 2
#: Parts of a component that one task takes in order, some 200 bytes each.
FOLD_LIMIT = 1_000_000


def _accepted(candidates: DataFrame) -> DataFrame:
    """Of parts that share bytes or places, those that are accepted when taken by `arrival`.

    A part that comes first among its bytes and in its place is accepted, and what it blocks
    leaves: two such rounds settle everything but chains of overlaps, whatever the number of
    copies. Parts left over that share bytes or places, also through others, form components,
    which do not touch each other; each is taken in order by one task. A component beyond
    `FOLD_LIMIT` parts is reported as a warning and goes on in rounds, as many as it needs.
    """
    # Bytes or a place that are not known are shared with nobody.
    own = F.concat(F.lit("\0"), F.col("arrival").cast("string"))
    no_place = F.greatest(*(F.col(c).isNull() for c in SLOT))
    undecided = materialise(
        candidates.withColumns(
            {
                "file_hash": F.coalesce("file_hash", own),
                "partner": F.when(no_place, own).otherwise(F.col("partner")),
            }
        )
    )
    accepted = undecided.limit(0)
    for _ in range(DIRECT_ROUNDS):
        accepted, undecided = _round(accepted, undecided)
    if undecided.isEmpty():
        return accepted
    grouped = materialise(_overlapping(undecided))
    sizes = grouped.groupBy("component").agg(F.count(F.lit(1)).alias("parts"))
    giants = sizes.where(F.col("parts") > FOLD_LIMIT)
    rest = grouped.join(giants, "component", "left_semi").select(*_THIN)
    folded = grouped.join(giants, "component", "left_anti")
    taken = folded.groupBy("component").applyInPandas(_in_order, "arrival bigint")
    accepted = materialise(
        accepted.unionByName(undecided.join(taken, "arrival", "left_semi").select(*_THIN))
    )
    largest = giants.agg(F.count(F.lit(1)), F.max("parts")).first()
    if largest[0]:
        warnings.warn(
            f"{largest[0]} groups of overlapping parts, the largest of {largest[1]}, are over "
            f"{FOLD_LIMIT} and are settled in rounds", stacklevel=2,
        )
        undecided = materialise(rest)
        while not undecided.isEmpty():
            accepted, undecided = _round(accepted, undecided)
    return accepted


def _round(accepted: DataFrame, undecided: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accept the parts that nothing earlier overlaps, and let go what they block."""
    first_of_bytes = undecided.groupBy("file_hash").agg(F.min("arrival").alias("arrival"))
    first_of_slot = undecided.groupBy(*SLOT).agg(F.min("arrival").alias("arrival"))
    won = materialise(
        undecided.join(first_of_bytes.select("arrival"), "arrival", "left_semi")
        .join(first_of_slot.select("arrival"), "arrival", "left_semi")
        .select(*_THIN)
    )
    left = undecided.join(won.select("file_hash"), "file_hash", "left_anti").join(
        won.select(*SLOT), list(SLOT), "left_anti"
    )
    return accepted.unionByName(won), materialise(left.select(*_THIN))


def _overlapping(undecided: DataFrame) -> DataFrame:
    """The parts with their component: each is tied to the first of its bytes and of its place."""
    ties = [
        undecided.join(
            undecided.groupBy(*shared).agg(F.min("arrival").alias("b")), list(shared)
        ).select(F.col("arrival").alias("a"), "b")
        for shared in (("file_hash",), SLOT)
    ]
    found = connected.components(ties[0].union(ties[1]))
    return undecided.join(found.withColumnRenamed("node", "arrival"), "arrival")


def _in_order(component: pd.DataFrame) -> pd.DataFrame:
    """Arrivals of one component that are accepted, one by one."""
    rows = component.sort_values("arrival")
    seen_bytes, seen_places, taken = set(), set(), []
    places = zip(*(rows[c] for c in SLOT), strict=True)
    for arrival, own, place in zip(rows["arrival"], rows["file_hash"], places, strict=True):
        if own not in seen_bytes and place not in seen_places:
            taken.append(arrival)
            seen_bytes.add(own)
            seen_places.add(place)
    return pd.DataFrame({"arrival": taken}, dtype="int64")


def split_duplicates(parts: DataFrame, register: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(parts to take, duplicates) among arriving parts, looking only at identity."""
    whole = parts if "problems" in parts.columns else parts.withColumn("problems", F.lit(""))
    decided = classify_arrivals(whole, register)
    duplicate = F.col("state") == V.DUPLICATE
    return (
        decided.where(~duplicate).select(*parts.columns),
        decided.where(duplicate).select(*parts.columns),
    )


def tag_rows(rows: DataFrame, parts: DataFrame) -> DataFrame:
    """Rows with the partner, feed and version of the file that brought them."""
    tags = parts.select("file_id", "partner", "feed", "sequence_number")
    content = [c for c in rows.columns if c != "file_id"]
    return rows.join(tags, "file_id").select(
        "partner", "feed", "sequence_number", "file_id", *content
    )


def replace_file_rows(stored: DataFrame, incoming: DataFrame, files: DataFrame) -> DataFrame:
    """Stored rows with all rows of the incoming files replaced; loading twice changes nothing.

    `files` lists the file ids, so that a file without rows replaces too.
    """
    kept = stored.join(files.select("file_id"), "file_id", "left_anti").select(*stored.columns)
    return kept.unionByName(incoming.select(*stored.columns))


def record(register: DataFrame, parts: DataFrame) -> DataFrame:
    """Upsert by file id. A resend replaces every column of its earlier attempt."""
    kept = register.join(parts.select("file_id"), "file_id", "left_anti").select(*register.columns)
    return kept.unionByName(parts.select(*register.columns))


# ---- publishing versions -----------------------------------------------------------------


def version_completeness(register: DataFrame) -> DataFrame:
    """Per version: distinct parts held, parts declared, rows, and whether it is whole.

    Parts that disagree on the part count leave the version incomplete.
    """
    per_version = (
        register.where(F.col("state").isin(*_USABLE))
        .groupBy(*VERSION)
        .agg(
            F.count_distinct("part_number").alias("parts"),
            F.max("part_count").alias("part_count"),
            F.min("part_count").alias("least_part_count"),
            F.sum("row_count").alias("row_count"),
        )
    )
    agreed = F.col("part_count") == F.col("least_part_count")
    whole = agreed & (F.col("parts") >= F.col("part_count"))
    reason = (
        F.when(~agreed, "parts disagree on the part count")
        .when(~whole, F.format_string("%d of %d parts", "parts", "part_count"))
        .otherwise("")
    )
    return per_version.select(
        *VERSION,
        "parts",
        "part_count",
        "row_count",
        whole.alias("whole"),
        reason.alias("reason"),
    )


def usual_rows(deliveries: DataFrame, pointer: DataFrame, register: DataFrame) -> DataFrame:
    """Median row count of the current versions on the same weekday of the weeks before."""
    published = (
        register.where(F.col("state") == V.PUBLISHED)
        .join(pointer.where(P.is_open()).select(*VERSION), list(VERSION), "left_semi")
        .groupBy(*DELIVERY)
        .agg(F.sum("row_count").alias("row_count"))
    )
    weeks = F.sequence(F.lit(1), F.lit(V.BASELINE_WEEKS))
    wanted = deliveries.select(
        *(F.col(c).alias(f"of_{c}") for c in DELIVERY),
        "partner",
        "feed",
        F.explode(F.transform(weeks, lambda w: F.date_sub("posting_date", w * 7))).alias(
            "posting_date"
        ),
    )
    return (
        wanted.join(published, list(DELIVERY))
        .groupBy(*(f"of_{c}" for c in DELIVERY))
        .agg(F.median("row_count").alias("usual_rows"))
        .select(*(F.col(f"of_{c}").alias(c) for c in DELIVERY), "usual_rows")
    )


def usual_rows_in_turn(
    requests: DataFrame,
    register: DataFrame,
    pointer: DataFrame,
    threshold: float = V.TRUNCATION_THRESHOLD,
) -> DataFrame:
    """`usual_rows` of requested deliveries when earlier requests publish first.

    The dates of one weekday of one feed are each other's history, so they are walked in order:
    a date looks back at what the weeks before it hold, be it published long ago or a moment ago
    in the walk. A walk has one entry per date of the calendar, however many rows a file has.
    """
    walk = ("partner", "feed", "weekday")
    whole = version_completeness(register).where(F.col("whole"))
    approved = F.col("approved_by").isNotNull().alias("approved")
    version = F.struct("sequence_number", "row_count", approved)
    asked = (
        requests.select(*VERSION, "approved_by")
        .join(whole.select(*VERSION, "row_count"), list(VERSION), "left")
        .groupBy(*DELIVERY)
        .agg(F.collect_list(F.when(F.col("row_count").isNotNull(), version)).alias("asked"))
    )
    current = (
        register.where(F.col("state") == V.PUBLISHED)
        .join(pointer.where(P.is_open()).select(*VERSION), list(VERSION), "left_semi")
        .groupBy(*DELIVERY)
        .agg(F.sum("row_count").alias("held"))
        .join(P.current(pointer, DELIVERY, "sequence_number"), list(DELIVERY), "left")
        .withColumnRenamed("sequence_number", "present")
    )
    # Only where something is requested is there anything to walk.
    dated = asked.join(current, list(DELIVERY), "full_outer").withColumn(
        "weekday", F.weekday("posting_date")
    )
    turn = F.struct("posting_date", "present", "held", "asked")
    turns = (
        dated.groupBy(*walk)
        .agg(F.array_sort(F.collect_list(turn)).alias("dates"), F.count("asked").alias("requests"))
        .where(F.col("requests") > 0)
    )

    def settled(done: Column, at: Column) -> Column:
        oldest = F.date_sub(at["posting_date"], 7 * V.BASELINE_WEEKS)
        counts = F.array_sort(
            F.transform(
                F.filter(done, lambda d: (d["posting_date"] >= oldest) & d["held"].isNotNull()),
                lambda d: d["held"],
            )
        )
        low = F.get(counts, F.floor((F.size(counts) - 1) / 2).cast("int"))
        high = F.get(counts, F.floor(F.size(counts) / 2).cast("int"))
        usual = F.when(F.size(counts) > 0, (low + high) / F.lit(2.0))
        few = F.coalesce(usual > 0, F.lit(False))
        may = F.filter(
            F.coalesce(at["asked"], F.array()),
            lambda v: v["approved"] | ~(few & (v["row_count"] < usual * F.lit(1 - threshold))),
        )
        best = F.array_max(may)
        wins = best["sequence_number"] >= F.coalesce(at["present"], F.lit(-1).cast("bigint"))
        held = F.when(F.coalesce(wins, F.lit(False)), best["row_count"]).otherwise(at["held"])
        entry = F.struct(
            at["posting_date"].alias("posting_date"),
            at["asked"].isNotNull().alias("requested"),
            usual.alias("usual_rows"),
            held.alias("held"),
        )
        return F.concat(done, F.array(entry))

    nothing = F.array().cast(
        "array<struct<posting_date: date, requested: boolean, usual_rows: double, held: bigint>>"
    )
    walked = turns.select("partner", "feed", F.inline(F.aggregate("dates", nothing, settled)))
    return walked.where(F.col("requested") & F.col("usual_rows").isNotNull()).select(
        *DELIVERY, "usual_rows"
    )


def truncation_holds(
    versions: DataFrame, usual: DataFrame, threshold: float = V.TRUNCATION_THRESHOLD
) -> DataFrame:
    """Adds `usual_rows` and `held`: far smaller than usual, and nobody approved it.

    No history, or a history of empty files, holds nothing.
    """
    few = (F.col("usual_rows") > 0) & (
        F.col("row_count") < F.col("usual_rows") * F.lit(1 - threshold)
    )
    approved = F.col("approved_by").isNotNull()
    return versions.join(usual, list(DELIVERY), "left").withColumn(
        "held", F.coalesce(few & ~approved, F.lit(False))
    )


def flip(pointer: DataFrame, requests: DataFrame, valid_at: datetime | Column) -> DataFrame:
    """The next pointer. `requests` are versions that may publish, with `approved_by`."""
    return P.flip(pointer, requests, valid_at, DELIVERY, "sequence_number", ("approved_by",))


def publish_verdicts(
    requests: DataFrame,
    register: DataFrame,
    pointer: DataFrame,
    threshold: float = V.TRUNCATION_THRESHOLD,
    usual: DataFrame | None = None,
) -> DataFrame:
    """One verdict per requested version, all judged against the same register and pointer.

    `usual` is the usual row count per delivery; without it, that of the published history.
    `requests` has the version columns and `approved_by`, at most one row per version. Of several
    publishable versions of a delivery only the highest publishes. `row_count` is that of the
    version and `reason` says what is missing.
    """
    asked = requests.select(*VERSION, "approved_by")
    have = version_completeness(register)
    present = P.current(pointer, DELIVERY, "sequence_number").withColumnRenamed(
        "sequence_number", "present"
    )
    if usual is None:
        usual = usual_rows(asked.select(*DELIVERY).distinct(), pointer, register)
    judged = truncation_holds(
        asked.join(have, list(VERSION), "left").join(present, list(DELIVERY), "left"),
        usual,
        threshold,
    )
    may = F.coalesce(F.col("whole"), F.lit(False)) & ~F.col("held")
    best = (
        judged.where(may).groupBy(*DELIVERY).agg(F.max("sequence_number").alias("best"))
    )
    wins = F.col("sequence_number") >= F.greatest("best", F.coalesce("present", F.lit(-1)))
    verdict = (
        F.when(
            F.col("parts").isNull(),
            F.when(F.col("present") >= F.col("sequence_number"), V.SUPERSEDED).otherwise(
                V.INCOMPLETE
            ),
        )
        .when(~F.col("whole"), V.INCOMPLETE)
        .when(F.col("held"), V.HELD_FOR_APPROVAL)
        .when(wins, V.PUBLISHED)
        .otherwise(V.SUPERSEDED)
    )
    return judged.join(best, list(DELIVERY), "left").select(
        *VERSION,
        "approved_by",
        "row_count",
        "usual_rows",
        F.when(F.col("parts").isNull(), "no parts").otherwise(F.col("reason")).alias("reason"),
        verdict.alias("verdict"),
    )


def settle_register(register: DataFrame, verdicts: DataFrame, pointer: DataFrame) -> DataFrame:
    """States after publishing: versions up to the highest one judged publishable are settled.

    `pointer` is the one after the flip. The current version becomes PUBLISHED, others at or
    below the judged one SUPERSEDED; later parts keep waiting.
    """
    reached = (
        verdicts.where(F.col("verdict").isin(V.PUBLISHED, V.SUPERSEDED))
        .where(F.col("reason") == "")
        .groupBy(*DELIVERY)
        .agg(F.max("sequence_number").alias("reached"))
    )
    now = P.current(pointer, DELIVERY, "sequence_number").withColumnRenamed(
        "sequence_number", "present"
    )
    settled = F.col("state").isin(*_USABLE) & (F.col("sequence_number") <= F.col("reached"))
    state = (
        F.when(~F.coalesce(settled, F.lit(False)), F.col("state"))
        .when(F.col("sequence_number") == F.col("present"), V.PUBLISHED)
        .otherwise(V.SUPERSEDED)
    )
    joined = register.join(reached.join(now, list(DELIVERY), "left"), list(DELIVERY), "left")
    return joined.withColumn("state", state).select(*register.columns)


# ---- reading -----------------------------------------------------------------------------


def current_rows(
    rows: DataFrame, pointer: DataFrame, between: tuple[date, date] | None = None
) -> DataFrame:
    """What counts now: of each delivery the version whose pointer row is open.

    `between` bounds the posting dates, first and last included. Rows stored by posting date are
    then read from those partitions alone.
    """
    return _of_versions(rows, pointer.where(P.is_open()), between)


def as_known_at(
    rows: DataFrame,
    pointer: DataFrame,
    moment: datetime,
    between: tuple[date, date] | None = None,
) -> DataFrame:
    """What counted then: versions whose pointer row covers `moment`, which needs a time zone."""
    return _of_versions(rows, pointer.where(P.held_at(moment)), between)


def input_status(required: DataFrame, pointer: DataFrame) -> DataFrame:
    """Required deliveries as inputs of the gate; one without an open pointer row is missing."""
    present = P.current(pointer, DELIVERY, "sequence_number")
    complete = F.col("sequence_number").isNotNull()
    missing = F.concat(F.lit("no version for "), F.col("posting_date").cast("string"))
    return required.join(present, list(DELIVERY), "left").select(
        F.concat_ws(".", "partner", "feed").alias("name"),
        "posting_date",
        complete.alias("complete"),
        F.when(complete, "").otherwise(missing).alias("detail"),
    )


def contiguous_prefix(versions: DataFrame, applied: DataFrame) -> DataFrame:
    """Versions of change-only feeds that may apply: no number is missing before them.

    `applied` has the last number applied per (partner, feed), or -1. The first gap is the
    smallest number whose successor is absent, an equi-join, so no feed is ordered in one task.
    """
    feed = ["partner", "feed"]
    start = applied.select(*feed, F.col("sequence_number").alias("applied"))
    ahead = versions.join(start, feed).where(F.col("sequence_number") > F.col("applied"))
    numbers = (
        ahead.select(*feed, "sequence_number")
        .unionByName(start.select(*feed, F.col("applied").alias("sequence_number")))
        .distinct()
    )
    predecessors = numbers.withColumn("sequence_number", F.col("sequence_number") - 1)
    last = (
        numbers.join(predecessors, [*feed, "sequence_number"], "left_anti")
        .groupBy(*feed)
        .agg(F.min("sequence_number").alias("last"))
    )
    return (
        ahead.join(last, feed)
        .where(F.col("sequence_number") <= F.col("last"))
        .select(*versions.columns)
    )


def missing(feeds: DataFrame, pointer: DataFrame, now: datetime) -> DataFrame:
    """Deliveries without a current version although their arrival window has closed.

    `feeds` has partner, feed, first_date, last_date, optional. An optional feed passes with a
    declared gap; any other holds what depends on it.
    """
    dates = F.explode(F.sequence("first_date", "last_date"))
    expected = feeds.select("partner", "feed", dates.alias("posting_date"), "optional")
    closes = business_day_end("posting_date") + F.make_dt_interval(
        hours=F.lit(V.ARRIVAL_CLOSES_HOUR)
    )
    here = pointer.where(P.is_open()).select(*DELIVERY)
    return (
        expected.where(closes <= F.lit(now))
        .join(here, list(DELIVERY), "left_anti")
        .withColumn(
            "effect", F.when(F.col("optional"), "declared gap").otherwise("incomplete input")
        )
    )


def announcements(before: DataFrame, after: DataFrame, feeds: DataFrame) -> DataFrame:
    """Reference feeds whose current version moved in a flip, never ahead of it."""
    reference = feeds.where(F.col("reference")).select("partner", "feed")
    moved = after.where(P.is_open()).join(
        before.where(P.is_open()).select(*VERSION), list(VERSION), "left_anti"
    )
    text = F.format_string(
        "reference %s.%s is at version %d", "partner", "feed", "sequence_number"
    )
    return moved.join(reference, ["partner", "feed"], "left_semi").select(
        *VERSION, F.col("valid_from").alias("announced_at"), text.alias("message")
    )


def independent_check(partner_rows: DataFrame, ledger: DataFrame, bank: DataFrame) -> DataFrame:
    """Payments that the partner, our ledger and the bank do not all show alike.

    Each side has `utr` and `amount_paise`. Sides are counted per (utr, amount) and the counts
    compared, which is one-to-one matching without pairing rows. Rows without a reference can
    never match and are reported as such.
    """
    sides = {"partner": partner_rows, "ledger": ledger, "bank": bank}
    tagged = None
    for side, rows in sides.items():
        one = rows.select("utr", "amount_paise", F.lit(side).alias("side"))
        tagged = one if tagged is None else tagged.unionByName(one)
    counts = tagged.groupBy("utr", "amount_paise").agg(
        *(F.count_if(F.col("side") == side).alias(f"{side}_rows") for side in sides)
    )
    alike = (F.col("partner_rows") == F.col("ledger_rows")) & (
        F.col("partner_rows") == F.col("bank_rows")
    )
    finding = (
        F.when(F.col("utr").isNull(), "no payment reference")
        .when(F.col("partner_rows") == 0, "not in partner file")
        .when(F.col("ledger_rows") == 0, "not in ledger")
        .when(F.col("bank_rows") == 0, "not in bank statement")
        .otherwise("counts differ")
    )
    return counts.where(F.col("utr").isNull() | ~alike).withColumn("finding", finding)


def legacy_sequence(files: DataFrame) -> DataFrame:
    """Sequence numbers for archived files that came without any, by business date.

    Dates are ordered by themselves; within one delivery a file's number is one more than the
    files archived before it. Counting is split by archive day, so a delivery with very many
    files is not ordered in one task.
    """
    day = F.to_date("archived_at")
    with_day = files.withColumn("archive_day", day)
    per_day = with_day.groupBy(*DELIVERY, "archive_day").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy(*DELIVERY).orderBy("archive_day").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = per_day.select(
        *DELIVERY, "archive_day", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    )
    within = Window.partitionBy(*DELIVERY, "archive_day").orderBy("archived_at", "file_id")
    return (
        with_day.withColumn("number", F.row_number().over(within))
        .join(offsets, [*DELIVERY, "archive_day"])
        .select(
            *files.columns,
            (F.col("before") + F.col("number")).alias("sequence_number"),
            F.lit("legacy").alias("checked"),
        )
    )


def mapping_changes(previous: DataFrame, now: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of an operations sheet that differ between two reads; each waits for approval."""
    columns = [c for c in now.columns if c not in keys]
    old = previous.select(*keys, F.struct(*columns).alias("old"))
    new = now.select(*keys, F.struct(*columns).alias("new"))
    kind = (
        F.when(F.col("old").isNull(), "added")
        .when(F.col("new").isNull(), "removed")
        .otherwise("changed")
    )
    return (
        old.join(new, list(keys), "full_outer")
        .where(~F.col("old").eqNullSafe(F.col("new")))
        .select(
            *keys,
            kind.alias("change"),
            *(F.col(f"old.{c}").alias(f"old_{c}") for c in columns),
            *(F.col(f"new.{c}").alias(f"new_{c}") for c in columns),
            F.lit("waiting for approval").alias("status"),
        )
    )


def parse_strict(rows: DataFrame, types: dict[str, str]) -> DataFrame:
    """Columns read as text, typed without guessing; `problems` names those that do not parse.

    `types` maps a column to bigint, date or string. An absent value is not a parse problem.
    """
    parsers = {"bigint": strict_bigint, "date": strict_date, "string": F.col}
    typed = {c: parsers[kind](c) for c, kind in types.items()}
    bad = [
        F.when(F.col(c).isNotNull() & typed[c].isNull(), F.lit(f"{c} is not {kind}"))
        for c, kind in types.items()
    ]
    return rows.select(
        *(c for c in rows.columns if c not in types),
        *(value.alias(c) for c, value in typed.items()),
        F.array_join(F.array_compact(F.array(*bad)), "; ").alias("problems"),
    )


def _of_versions(
    rows: DataFrame, versions: DataFrame, between: tuple[date, date] | None = None
) -> DataFrame:
    if between is not None:
        within = F.col("posting_date").between(*(F.lit(d) for d in between))
        rows, versions = rows.where(within), versions.where(within)
    joined = rows.join(versions.select(*VERSION), list(VERSION), "left_semi")
    return joined.select(*rows.columns)
