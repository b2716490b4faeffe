"""Personal data: random tokens issued once per value, canary scans, erasure."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tieout.durable import materialise


def normalise(kind: str, value: Column | str) -> Column:
    """One spelling per real value: phones with their country code, emails in lower case, PANs in
    upper case. A phone that `is_unreadable` keeps its text, so it never shares a token.
    """
    value = F.trim(F.col(value) if isinstance(value, str) else value)
    if kind == "phone":
        return F.coalesce(_international(value), value)
    if kind == "email":
        return F.lower(value)
    if kind == "pan":
        return F.upper(value)
    return value


def is_unreadable(kind: str, value: Column | str) -> Column:
    """Whether a value has no normal form and needs a person to look at it."""
    value = F.trim(F.col(value) if isinstance(value, str) else value)
    if kind == "phone":
        return value.isNotNull() & _international(value).isNull()
    return F.lit(False)


def _international(phone: Column) -> Column:
    """A national number, bare or after 0 or 91, under +91; any other country's as written."""
    digits = F.regexp_replace(phone, r"[^0-9]", "")
    national = F.regexp_extract(digits, r"^(?:0|91)?([0-9]{10})$", 1)
    abroad = F.startswith(phone, F.lit("+")) & ~F.startswith(digits, F.lit("91"))
    return F.when(
        abroad, F.when(F.length(digits).between(8, 15), F.concat(F.lit("+"), digits))
    ).when(national != "", F.concat(F.lit("+91"), national))


def tokenise(
    rows: DataFrame, column: str, kind: str, vault: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """(rows with tokens, entries to add to the vault).

    Tokens are random, so the new entries are materialised before anything reads them; the
    caller stores them in the vault before the rows. A value that still has no token fails the
    read: clear text never passes.
    """
    clear = rows.withColumn(column, normalise(kind, column))
    known = vault.where(F.col("kind") == kind).select("value", "token")
    new = materialise(
        clear.where(F.col(column).isNotNull())
        .select(F.col(column).alias("value"))
        .distinct()
        .join(known, "value", "left_anti")
        .select(F.lit(kind).alias("kind"), "value", F.expr("uuid()").alias("token"))
    )
    tokens = known.unionByName(new.select("value", "token"))
    return with_tokens(clear, column, tokens).select(*rows.columns), new


def with_tokens(rows: DataFrame, column: str, tokens: DataFrame) -> DataFrame:
    named = tokens.select(F.col("value").alias(column), F.col("token").alias("_token"))
    unresolved = F.col(column).isNotNull() & F.col("_token").isNull()
    token = F.when(
        unresolved, F.raise_error(F.lit(f"no token for a value of {column}")).cast("string")
    ).otherwise(F.col("_token"))
    return rows.join(named, column, "left").withColumn(column, token).drop("_token")


#: Parts of an envelope that hold a captured row, whose fields are classified once for all of them.
IMAGES = ("key", "before", "after")


def text_fields(schema: T.StructType, images: Sequence[str] = IMAGES) -> dict[str, str]:
    """Path of every text in a record, nested ones too, to the name it is classified under.

    In an image the name is the path within it. Text inside an array or a map has no path that a
    token could be put back by, and is refused.
    """
    found: dict[str, str] = {}

    def walk(struct: T.StructType, path: tuple[str, ...]) -> None:
        for f in struct.fields:
            at = (*path, f.name)
            if isinstance(f.dataType, T.StructType):
                walk(f.dataType, at)
            elif isinstance(f.dataType, T.StringType):
                within = at[1:] if at[0] in images and len(at) > 1 else at
                found[".".join(at)] = ".".join(within)
            elif "string" in f.dataType.simpleString():
                raise ValueError(f"text inside {'.'.join(at)} cannot be tokenised")

    walk(schema, ())
    return found


def tokenise_envelopes(
    envelopes: DataFrame,
    kinds: Mapping[str, str | None],
    vault: DataFrame,
    images: Sequence[str] = IMAGES,
) -> tuple[DataFrame, DataFrame]:
    """(envelopes with tokens in both images and the key, entries to add to the vault).

    `kinds` classifies every text field: the kind of personal value it holds, or None for none.
    One that is not classified is refused before anything is read. All personal values of a batch
    stand in one long frame, which meets the vault once; tokens go back by their path, so a value
    has one token wherever it stands. As with `tokenise`, the new entries are materialised and
    stored before the rows, and a value without a token fails the read.
    """
    paths = text_fields(envelopes.schema, images)
    unknown = sorted({name for name in paths.values() if name not in kinds})
    if unknown:
        raise ValueError(f"text fields without a classification: {', '.join(unknown)}")
    personal = {path: kinds[name] for path, name in paths.items() if kinds[name] is not None}
    if not personal:
        return envelopes, vault.select("kind", "value", "token").limit(0)
    # Numbered and kept, because rows are put together again by their number.
    rows = materialise(envelopes.withColumn("_row", F.monotonically_increasing_id()))
    values = F.array(
        *(
            F.struct(
                F.lit(path).alias("path"),
                F.lit(kind).alias("kind"),
                normalise(kind, F.col(path)).alias("value"),
            )
            for path, kind in personal.items()
        )
    )
    told = F.filter(values, lambda v: v["value"].isNotNull())
    long = rows.select("_row", F.inline(told))
    known = vault.select("kind", "value", "token")
    new = materialise(
        long.select("kind", "value")
        .distinct()
        .join(known, ["kind", "value"], "left_anti")
        .withColumn("token", F.expr("uuid()"))
    )
    tokens = known.unionByName(new)
    by_row = (
        long.join(tokens, ["kind", "value"])
        .groupBy("_row")
        .agg(F.map_from_entries(F.collect_list(F.struct("path", "token"))).alias("_tokens"))
    )
    out = rows.join(by_row, "_row", "left")
    for path in personal:
        token = F.try_element_at("_tokens", F.lit(path))
        refused = F.raise_error(F.lit(f"no token for a value of {path}")).cast("string")
        put = F.when(F.col(path).isNotNull(), F.coalesce(token, refused))
        top, _, rest = path.partition(".")
        if not rest:
            out = out.withColumn(top, put)
        else:
            out = out.withColumn(top, F.when(F.col(top).isNotNull(), F.col(top).withField(rest, put)))
    return out.select(*envelopes.columns), new


def canary_hits(tables: dict[str, DataFrame], canaries: Sequence[str]) -> DataFrame:
    """How often a seeded clear value shows up, per table and text column. Zero is the goal."""
    found = None
    for name, rows in tables.items():
        texts = [f.name for f in rows.schema.fields if isinstance(f.dataType, T.StringType)]

        def seen(column: str) -> Column:
            hit = F.lit(False)
            for canary in canaries:
                hit = hit | F.contains(F.col(column), F.lit(canary))
            return F.count_if(hit)

        counts = rows.agg(*(seen(c).alias(c) for c in texts))
        pairs = F.array(
            *(F.struct(F.lit(c).alias("column_name"), F.col(c).alias("hits")) for c in texts)
        )
        one = counts.select(F.lit(name).alias("table_name"), F.inline(pairs))
        found = one if found is None else found.unionByName(one)
    return found


def erase(
    vault: DataFrame, requests: DataFrame, retention: DataFrame, today: date
) -> tuple[DataFrame, DataFrame]:
    """(the vault afterwards, one logged decision per entry concerned).

    `requests` has customer_id; `retention` has retention_class and retain_days (NULL when no law
    keeps the record). An entry under retention is masked and stays until its period ends,
    counted from the entry's `recorded_on`.
    """
    asked = requests.select("customer_id").distinct()
    until = F.date_add("recorded_on", F.col("retain_days"))
    due = F.col("retain_days").isNull() | (until <= F.lit(today))
    concerned = vault.join(asked, "customer_id", "left_semi").join(
        retention, "retention_class", "left"
    )
    decisions = concerned.select(
        "customer_id",
        "kind",
        "token",
        "retention_class",
        F.when(due, "deleted").otherwise("erasure pending").alias("decision"),
        F.when(~due, until).alias("keep_until"),
        F.lit(today).alias("decided_on"),
    )
    marks = decisions.select("token", "decision")
    after = (
        vault.join(marks, "token", "left")
        .where(~F.col("decision").eqNullSafe("deleted"))
        .withColumn("masked", F.col("decision").isNotNull())
        .select(*vault.columns, "masked")
    )
    return after, decisions
